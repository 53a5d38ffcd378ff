import datetime as dt
import glob
import os

from stratal.functions.stamps import stamp_load
from stratal.sinks.writers import jdbc_options, write_partitioned

UTC = dt.timezone.utc


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_out):
    a = spark.createDataFrame([(1, "2025-01-01")], "k int, fecha string")
    b = spark.createDataFrame([(2, "2025-01-02")], "k int, fecha string")
    a2 = spark.createDataFrame([(3, "2025-01-01")], "k int, fecha string")
    for df in (a, b, a2):
        write_partitioned(df, tmp_out, "fecha", "parquet", "uncompressed")
    back = spark.read.schema("k int, fecha string").parquet(tmp_out)
    assert sorted(tuple(r) for r in back.collect()) == [(2, "2025-01-02"), (3, "2025-01-01")]


def test_static_overwrite_replaces_everything(spark, tmp_out):
    a = spark.createDataFrame([(1, "2025-01-01")], "k int, fecha string")
    b = spark.createDataFrame([(2, "2025-01-02")], "k int, fecha string")
    write_partitioned(a, tmp_out, "fecha")
    write_partitioned(b, tmp_out, "fecha", dynamic=False)
    assert [r.k for r in spark.read.parquet(tmp_out).collect()] == [2]


def test_partition_text_reads_back_as_date_without_schema(spark, tmp_out):
    df = spark.createDataFrame([(1, "2025-01-01")], "k int, fecha string")
    write_partitioned(df, tmp_out, "fecha")
    assert dict(spark.read.parquet(tmp_out).dtypes)["fecha"] == "date"
    assert dict(spark.read.schema("k int, fecha string").parquet(tmp_out).dtypes)["fecha"] == "string"


def test_max_files_caps_files_per_partition(spark, tmp_out):
    df = spark.range(1000).selectExpr("id", "'2025-01-01' AS fecha").repartition(8)
    write_partitioned(df, tmp_out, "fecha", max_files=1)
    files = glob.glob(os.path.join(_local(tmp_out), "fecha=2025-01-01", "*.parquet"))
    assert len(files) == 1


def test_gzip_json_drops_null_fields_and_needs_schema(spark, tmp_out):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, name string")
    stamped = stamp_load(df, dt.datetime(2025, 3, 2, 1, 30, 15, 123456, tzinfo=UTC), "UTC")
    write_partitioned(stamped, tmp_out, "date_raw_partition", "json", "gzip")
    files = glob.glob(os.path.join(_local(tmp_out), "date_raw_partition=2025-03-02", "*.json.gz"))
    assert files
    import gzip
    text = "".join(gzip.open(f, "rt").read() for f in files)
    assert '"name"' in text and text.count('"name"') == 1  # null field omitted
    inferred = spark.read.json(tmp_out)
    assert dict(inferred.dtypes)["id"] == "bigint" and dict(inferred.dtypes)["raw_timestamp"] == "string"
    typed = spark.read.schema("id int, name string, raw_timestamp timestamp, date_raw_partition date").json(tmp_out)
    rows = sorted(typed.collect(), key=lambda r: r.id)
    assert rows[0].name is None and rows[1].name == "x"
    assert rows[0].raw_timestamp.microsecond == 123000  # millisecond precision in JSON


def test_jdbc_options():
    opts = jdbc_options("jdbc:postgresql://h:5432/db", "s.family", "u", "p", "org.postgresql.Driver",
                        num_partitions=4, batch_size=5000)
    assert opts == {"url": "jdbc:postgresql://h:5432/db", "dbtable": "s.family", "truncate": "true",
                    "user": "u", "password": "p", "driver": "org.postgresql.Driver",
                    "numPartitions": "4", "batchsize": "5000"}
