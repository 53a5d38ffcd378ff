import json

from stratal.plans import cli
from stratal.sources.standins import standin_tables
from stratal.sources.tables import load_tables

from conftest import SF_SMALL


def test_cli_family_and_landing(spark, tmp_out, capsys):
    base = load_tables(spark, SF_SMALL)
    for name, df in standin_tables(base).items():
        df.createOrReplaceTempView(name)
    cli.main(["family", "--out", f"{tmp_out}/fam",
              "--plant-map", json.dumps({"NATION_3": 1, "NATION_8": 2, "NATION_12": 3, "NATION_13": 4,
                                         "NATION_15": 5, "NATION_18": 6, "NATION_19": 7}),
              "--tx-types", "2,3,4,5,6", "--valid-after", "2000-01-01", "--sku-below", "1500",
              "--category", "STILL", "--as-of", "2000-06-30", "--stamp", "2000-06-30T12:00:00+00:00",
              "--stamp-tz", "UTC"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"families": 18, "id_overflow": 0}
    base["part"].createOrReplaceTempView("part_src")
    mapping = f"{tmp_out.replace('file:', '')}-mapping.json"
    with open(mapping, "w", encoding="utf-8") as fh:
        json.dump([["p_partkey", "bigint", "articulokey", "int"], ["p_name", "string", "nombre", "string"]], fh)
    cli.main(["landing", "--source", "part_src", "--mapping", mapping, "--out", f"{tmp_out}/land",
              "--stamp=2025-03-01T21:30:15-04:00", "--tz=-04:00"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"landed": 200}
    back = spark.read.schema("articulokey int, nombre string, raw_timestamp timestamp, "
                             "date_raw_partition date").json(f"{tmp_out}/land")
    assert back.count() == 200
    assert [str(r[0]) for r in back.select("date_raw_partition").distinct().collect()] == ["2025-03-01"]


def test_presets_are_complete():
    from stratal.plans.presets import SOURCE_PLANT_MAP, article_mapping, source_family_params

    maps = article_mapping()
    assert len(maps) == 27 and len({m.target for m in maps}) == 27
    assert sum(m.target_type == "int" for m in maps) == 2
    p = source_family_params(as_of="2025-06-30")
    assert sorted(SOURCE_PLANT_MAP.values()) == list(range(1, 8)) and p.category == "STILL"


def test_article_mapping_lands_a_catalog_like_table(spark):
    from stratal.plans.jobs import land
    from stratal.plans.presets import ARTICLE_MAPPING_ROWS, article_mapping

    cols = ", ".join(f"`{src}` {typ}" for src, typ, _, _ in ARTICLE_MAPPING_ROWS) + ", extra string"
    row = tuple(7 if typ == "int" else src for src, typ, _, _ in ARTICLE_MAPPING_ROWS) + ("dropped",)
    df = spark.createDataFrame([row], cols)
    out = land(df, article_mapping(), tz="-04:00")
    assert "extra" not in out.columns and "tamaño" in out.columns
    assert len(out.columns) == 29


def test_cli_family_with_source_preset(spark, tmp_out, capsys):
    base = load_tables(spark, SF_SMALL)
    for name, df in standin_tables(base).items():
        df.createOrReplaceTempView(name)
    # The source job's own settings (transaction types 9-13, validity after 2025-01-01) match nothing in the
    # test tables: the job must run through and report empty output rather than fail.
    cli.main(["family", "--preset", "source", "--as-of", "2000-06-30", "--out", f"{tmp_out}/fam",
              "--stamp", "2000-06-30T12:00:00+00:00", "--stamp-tz", "UTC"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"families": 0, "id_overflow": 0}
    # explicit settings override the preset
    cli.main(["family", "--preset", "source", "--as-of", "2000-06-30", "--out", f"{tmp_out}/fam2",
              "--tx-types", "2,3,4,5,6", "--valid-after", "2000-01-01", "--sku-below", "1500",
              "--plant-map", json.dumps({"NATION_3": 1, "NATION_8": 2, "NATION_12": 3, "NATION_13": 4,
                                         "NATION_15": 5, "NATION_18": 6, "NATION_19": 7}),
              "--stamp", "2000-06-30T12:00:00+00:00", "--stamp-tz", "UTC"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"families": 18, "id_overflow": 0}
