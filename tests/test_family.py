import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from stratal.plans.family import assign_families, family_relation, family_table
from stratal.plans.jobs import build_family, run_family
from stratal.plans.products import product_master
from stratal.plans.sales import recent_sales
from stratal.sources.standins import family_params, standin_tables
from stratal.sources.tables import load_tables

STAMP = dt.datetime(2000, 6, 30, 12, tzinfo=dt.timezone.utc)


def _chain(spark, sf):
    t = standin_tables(load_tables(spark, sf))
    p = family_params(stamp=STAMP, stamp_tz="UTC")
    pm = product_master(t, p.valid_after, p.sku_below)
    rs = recent_sales(t, p.as_of, p.months, p.tx_types, p.plant_map, p.valid_after, p.sku_below)
    asg = assign_families(rs, pm, p.category)
    fam = family_table(asg, p.stamp, p.stamp_tz)
    return t, p, pm, rs, fam, family_relation(fam)


def test_stage_counts_match_fixture_table(spark):
    for sf, expect in [(SF_SMALL, (400, 61, 42, 18, 10, 3, 14)), (SF_MID, (4000, 574, 437, 105, 70, 28, 66))]:
        t, p, pm, rs, fam, rel = _chain(spark, sf)
        got = (t["d_prod"].count(), pm.count(), rs.count(), fam.count(),
               fam.where(F.col("idplanta").isNull()).count(), fam.where(F.col("familyid").isNotNull()).count(),
               rel.count())
        assert got == expect, (sf, got)


def test_family_output_schema(spark):
    *_, fam, rel = _chain(spark, SF_SMALL)
    assert fam.dtypes == [("idplanta", "int"), ("articulokey", "int"), ("categoriamkt", "string"),
                          ("marcamkt", "string"), ("formato", "string"), ("formatomkt", "string"),
                          ("cantsubunidades", "int"), ("familyid", "int"), ("sku", "int"), ("parentid", "int"),
                          ("process_timestamp", "string"), ("planta", "string"), ("fecha", "string")]
    assert rel.dtypes == [("family_id", "int"), ("parentid", "int")]


def test_two_runs_same_output(spark):
    *_, fam1, _ = _chain(spark, SF_MID)
    *_, fam2, _ = _chain(spark, SF_MID)
    assert fam1.exceptAll(fam2).count() == 0 and fam2.exceptAll(fam1).count() == 0


def test_no_stale_snapshot_leaks(spark):
    _, _, pm, _, fam, rel = _chain(spark, SF_SMALL)
    assert pm.where(F.col("marcamkt").contains("STALE") | F.col("name_concat").contains("STALE")).count() == 0
    assert rel.where(F.col("parentid") == -1).count() == 0


def test_run_family_writes_and_counts(spark, tmp_out):
    t = standin_tables(load_tables(spark, SF_SMALL))
    p = family_params(stamp=STAMP, stamp_tz="UTC")
    rel_path = f"{tmp_out}/rel"
    counts = run_family(t, p, f"{tmp_out}/fam",
                        relation_sink=lambda df: df.write.mode("overwrite").parquet(rel_path), max_files=1)
    assert counts == {"families": 18, "relation": 14, "id_overflow": 0}
    fam_back = spark.read.parquet(f"{tmp_out}/fam")
    assert fam_back.count() == 18
    assert [r.fecha for r in fam_back.select("fecha").distinct().collect()] == [dt.date(2000, 6, 30)]
    families, _ = build_family(t, p)
    assert families.count() == 18


def test_sales_branch_evaluated_once(spark, capsys):
    """After assignment the plan reads only the materialised tables: the
    fact table and the dimensions are not scanned again."""
    t = standin_tables(load_tables(spark, SF_SMALL))
    p = family_params()
    pm = product_master(t, p.valid_after, p.sku_below)
    rs = recent_sales(t, p.as_of, p.months, p.tx_types, p.plant_map, p.valid_after, p.sku_below)
    assign_families(rs, pm, p.category).explain("formatted")
    plan = capsys.readouterr().out
    assert "lineitem.parquet" not in plan and "part.parquet" not in plan
    assert "stratal-scratch/family-rows" in plan


def test_no_unpartitioned_window_over_rows(spark, capsys):
    t = standin_tables(load_tables(spark, SF_SMALL))
    p = family_params()
    pm = product_master(t, p.valid_after, p.sku_below)
    rs = recent_sales(t, p.as_of, p.months, p.tx_types, p.plant_map, p.valid_after, p.sku_below)
    assign_families(rs, pm, p.category).explain("formatted")
    lines = capsys.readouterr().out.splitlines()
    windows = [i for i, line in enumerate(lines) if line.startswith("(") and ") Window" in line]
    assert windows  # the offsets window over per-partition counts
    for i in windows:
        spec = " ".join(lines[i:i + 6])
        assert "__rank_pid" in spec  # ordered by partition id: one row per partition


def test_family_semantics_on_hand_made_rows(spark):
    sales = spark.createDataFrame(
        [  # id_localidad, agru_local, id_prod, cajas, ultima, idplanta
            (1, "ORURO_X", 10, 1.0, None, None),   # unlisted city: plant null
            (2, "BETA_Y", 10, 2.0, None, None),    # another unlisted city, same product
            (3, "CITY_A", 10, 3.0, None, 2),
            (4, "CITY_B", 11, 4.0, None, 1),
            (5, "CITY_B", 12, 5.0, None, 1),
            (6, "CITY_B", 13, 6.0, None, 1),       # product 13 has a null category
        ],
        "id_localidad long, agru_local string, id_prod long, cajas_fisicas double, ultima_compra date, idplanta int")
    products = spark.createDataFrame(
        [  # id_prod, categoria, marcamkt, formato, formatomkt, cantsubunidades, sku, sku_padre, name
            (10, "STILL", "M1-X", "G1-C1", "E1-T1", 6, 10, 1, "M1 T1 E1"),
            (11, "STILL", "M2-X", "G1-C1", "E1-T1", 6, 11, 1, None),        # missed lookup: null name
            (12, "STILL", "M3-X", "G1-C1", "E1-T1", 6, 12, 2, "M3 T1 E1"),
            (13, None, "M4-X", "G1-C1", "E1-T1", 6, 13, 2, "M4 T1 E1"),
            (14, "OTHER", "M5-X", "G1-C1", "E1-T1", 6, 14, 3, "M5 T1 E1"),
        ],
        "id_prod long, categoria string, marcamkt string, formato string, formatomkt string, "
        "cantsubunidades int, sku long, sku_padre long, name_concat_general string")
    out = {(r.idplanta, r.id_prod): r for r in assign_families(sales, products, "STILL").collect()}
    # groups in order: (null,'M1 T1 E1')=1, (1,null)=2, (1,'M3 T1 E1')=3, (2,'M1 T1 E1')=4
    assert set(out) == {(None, 10), (1, 11), (1, 12), (2, 10)}
    assert out[(None, 10)].agru_local == "BETA_Y" and out[(None, 10)].familyid is None
    assert out[(1, 11)].familyid is None
    assert out[(1, 12)].familyid == 10003
    assert out[(2, 10)].familyid == 20004

    from pyspark.sql import Observation

    obs = Observation("overflow")
    small = assign_families(sales, products, "STILL", id_type="tinyint", overflow=obs).collect()
    assert obs.get["id_overflow"] == 2  # 10003 and 20004 do not fit a tinyint
    assert all(r.familyid is None for r in small)


def test_empty_sales_window_gives_empty_outputs(spark):
    t = standin_tables(load_tables(spark, SF_SMALL))
    families, relation = build_family(t, family_params(as_of="1990-01-01"))
    assert families.count() == 0 and relation.count() == 0
    assert families.columns[-1] == "fecha"


def test_wide_ids_survive_the_whole_job(spark, tmp_out):
    """Plant numbers so large that every id overflows an int."""
    t = standin_tables(load_tables(spark, SF_SMALL))
    wide = family_params(plant_map={k: 300_000 * v for k, v in family_params().plant_map.items()}, id_type="bigint")
    narrow = family_params(plant_map=wide.plant_map)
    out = run_family(t, wide, f"{tmp_out}/wide")
    back = spark.read.schema("idplanta int, familyid long, categoriamkt string").parquet(f"{tmp_out}/wide")
    ids = [r["familyid"] for r in back.where("familyid IS NOT NULL").collect()]
    assert out["id_overflow"] == 0 and ids and min(ids) > 2 ** 31
    lost = run_family(t, narrow, f"{tmp_out}/narrow")
    assert lost["id_overflow"] >= len(ids)
    assert spark.read.schema("familyid long").parquet(f"{tmp_out}/narrow").where("familyid IS NOT NULL").count() == 0


def test_stored_rows_are_unique_per_key_and_scratch_is_removed(spark, tmp_out, monkeypatch):
    from stratal.plans import family
    from stratal.session import glob_paths, shared_checkpoint_dir

    stored = {}
    real = family.materialize

    def spy(df, name):
        stored[name] = real(df, name)
        return stored[name]

    monkeypatch.setattr(family, "materialize", spy)
    t = standin_tables(load_tables(spark, SF_SMALL))
    build_family(t, family_params())
    rows = stored["family-rows"]
    assert rows.count() == rows.select(*family.ROW_KEYS).distinct().count() > 0
    monkeypatch.undo()
    run_family(t, family_params(), tmp_out)
    assert glob_paths(spark, f"{shared_checkpoint_dir(spark)}/stratal-scratch/family-run-*") == []


def test_a_cluster_without_a_shared_folder_is_refused():
    from stratal.session import shared_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = Context()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_checkpoint_dir(Session())
