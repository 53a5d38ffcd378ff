import datetime as dt

import pytest

from stratal.functions.stamps import load_stamps, stamp_load
from stratal.operators.mapping import Mapping, MissingColumnsError, apply_mapping, mappings_from_tuples

LOCAL = dt.timezone(dt.timedelta(hours=-4))
EVENING = dt.datetime(2025, 3, 1, 21, 30, 15, 123456, tzinfo=LOCAL)


def test_mapping_keeps_renames_casts_and_drops(spark):
    df = spark.createDataFrame([(1, "a", 2.5, "x")], "k bigint, n string, v double, junk string")
    out = apply_mapping(df, [Mapping("k", "bigint", "id", "int"), Mapping("n", "string", "name", "string"),
                             Mapping("v", "double", "val", "string")])
    assert out.columns == ["id", "name", "val"]
    assert dict(out.dtypes) == {"id": "int", "name": "string", "val": "string"}
    assert tuple(out.first()) == (1, "a", "2.5")


def test_mapping_missing_column(spark):
    df = spark.createDataFrame([(1,)], "k int")
    maps = mappings_from_tuples([("k", "int", "k", "int"), ("tamaño", "string", "tamaño", "string")])
    with pytest.raises(MissingColumnsError):
        apply_mapping(df, maps)
    out = apply_mapping(df, maps, strict=False)
    assert dict(out.dtypes)["tamaño"] == "string" and out.first()["tamaño"] is None


def test_non_ascii_column_name_round_trips(spark):
    df = spark.createDataFrame([("1L",)], "`tamaño` string")
    out = apply_mapping(df, [Mapping("tamaño", "string", "tamaño", "string")])
    assert out.columns == ["tamaño"]


def test_zone_shift_of_partition_date(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert stamp_load(df, EVENING).first()["date_raw_partition"] == dt.date(2025, 3, 2)
    assert stamp_load(df, EVENING, tz="-04:00").first()["date_raw_partition"] == dt.date(2025, 3, 1)


def test_text_stamps_from_one_instant(spark):
    df = spark.createDataFrame([(1,)], "k int")
    row = df.withColumns(load_stamps(EVENING, "-04:00")).first()
    assert row["process_timestamp"] == "2025-03-01 21:30:15" and row["fecha"] == "2025-03-01"
    row = df.withColumns(load_stamps(EVENING, "UTC")).first()
    assert row["process_timestamp"] == "2025-03-02 01:30:15" and row["fecha"] == "2025-03-02"


def test_naive_instant_rejected(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        stamp_load(df, dt.datetime(2025, 1, 1))


def test_default_instant_is_fixed_across_actions(spark):
    import time

    df = spark.createDataFrame([(1,)], "k int")
    stamped = stamp_load(df)
    first = stamped.first()["raw_timestamp"]
    time.sleep(1.1)
    assert stamped.first()["raw_timestamp"] == first
