import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from stratal.operators.changes import (changed_items, content_hash, detect_changes, file_hashes, load_manifest,
                                       save_manifest)
from stratal.sinks.writers import write_partitioned
from stratal.streaming.incremental import batch_folder_writer, run_available_now
from stratal.suite.queries import QUERIES


def test_change_counts_on_documents(spark):
    out = QUERIES["detect_changes"](spark, SF_MID)
    counts = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert counts == {"new": 90, "changed": 117, "unchanged": 702}


def test_deleted_items_not_reported_unless_asked(spark):
    cur = spark.createDataFrame([("a", "x"), ("b", "y2")], "key string, text string")
    prev = spark.createDataFrame([("b", "y"), ("c", "z")], "key string, text string")
    cur_m, prev_m = content_hash(cur, "key", "text"), content_hash(prev, "key", "text")
    got = {r.key: r.status for r in detect_changes(cur_m, prev_m).collect()}
    assert got == {"a": "new", "b": "changed"}
    got = {r.key: r.status for r in detect_changes(cur_m, prev_m, include_deleted=True).collect()}
    assert got == {"a": "new", "b": "changed", "c": "deleted"}
    assert sorted(r.key for r in changed_items(detect_changes(cur_m, prev_m)).collect()) == ["a", "b"]


def test_manifest_refresh_drops_vanished_keys(spark, tmp_out):
    first = content_hash(spark.createDataFrame([("a", "1"), ("c", "3")], "key string, t string"), "key", "t")
    second = content_hash(spark.createDataFrame([("a", "1")], "key string, t string"), "key", "t")
    write_partitioned(first, tmp_out, None, dynamic=False)
    write_partitioned(second, tmp_out, None, dynamic=False)
    assert [r.key for r in spark.read.parquet(tmp_out).collect()] == ["a"]


def test_file_hashes_match_python(spark, tmp_out):
    import hashlib
    import os
    local = tmp_out[len("file:"):] if tmp_out.startswith("file:") else tmp_out
    os.makedirs(local)
    payload = "print('hola')\n".encode()
    with open(os.path.join(local, "job.py"), "wb") as fh:
        fh.write(payload)
    row = file_hashes(spark, tmp_out, "*.py").first()
    assert row.hash == hashlib.sha256(payload).hexdigest()


def _events(spark):
    return spark.read.parquet(f"{SF_MID}/events.parquet")


def test_incremental_reads_only_new_files(spark, tmp_out):
    ev = _events(spark)
    src, out, ckpt = f"{tmp_out}/src", f"{tmp_out}/out", f"{tmp_out}/ckpt"
    writer = batch_folder_writer(out)
    ev.where(F.col("event_id") % 2 == 0).write.parquet(src)
    run_available_now(spark, src, ev.schema, ckpt, writer)
    n1 = spark.read.parquet(out).count()
    ev.where(F.col("event_id") % 2 == 1).write.mode("append").parquet(src)
    run_available_now(spark, src, ev.schema, ckpt, writer)
    back = spark.read.parquet(out)
    assert n1 == ev.where(F.col("event_id") % 2 == 0).count()
    assert back.count() == ev.count()
    assert back.select("batch_id").distinct().count() == 2
    run_available_now(spark, src, ev.schema, ckpt, writer)  # nothing new
    assert spark.read.parquet(out).count() == ev.count()


def test_failed_batch_is_replayed(spark, tmp_out):
    ev = _events(spark).limit(50)
    src, out, ckpt = f"{tmp_out}/src", f"{tmp_out}/out", f"{tmp_out}/ckpt"
    ev.write.parquet(src)
    good = batch_folder_writer(out)

    def broken(df, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(Exception):
        run_available_now(spark, src, ev.schema, ckpt, broken)
    run_available_now(spark, src, ev.schema, ckpt, good)
    back = spark.read.parquet(out)
    assert back.count() == 50
    assert [r.batch_id for r in back.select("batch_id").distinct().collect()] == [0]


def test_statuses_partition_the_current_set(spark):
    from stratal.suite.queries import _manifests

    current, previous = _manifests(spark, SF_MID)
    out = detect_changes(current, previous)
    assert out.count() == current.count()
    assert out.select("key").distinct().count() == current.count()
    assert out.select("key", "hash").exceptAll(current).count() == 0


def test_same_manifest_on_both_sides_is_unchanged(spark):
    m = content_hash(spark.createDataFrame([("a", "x"), ("b", None)], "key string, t string"), "key", "t")
    assert {r.status for r in detect_changes(m, m).collect()} == {"unchanged"}


def test_incremental_landing_composes_mapping_and_stamps(spark, tmp_out):
    import datetime as dt

    from stratal.operators.mapping import Mapping
    from stratal.plans.jobs import land

    part = spark.read.parquet(f"{SF_MID}/part.parquet")
    src, out, ckpt = f"{tmp_out}/src", f"{tmp_out}/out", f"{tmp_out}/ckpt"
    part.where(F.col("p_size") <= 25).write.parquet(src)
    maps = [Mapping("p_partkey", "bigint", "articulokey", "int"), Mapping("p_name", "string", "nombre", "string")]
    instant = dt.datetime(2025, 3, 1, 21, 30, tzinfo=dt.timezone(dt.timedelta(hours=-4)))
    run_available_now(spark, src, part.schema, ckpt,
                      batch_folder_writer(out, "json", ["date_raw_partition"]),
                      transform=lambda df: land(df, maps, instant, "-04:00"), max_files_per_batch=1)
    part.where(F.col("p_size") > 25).write.mode("append").parquet(src)
    run_available_now(spark, src, part.schema, ckpt,
                      batch_folder_writer(out, "json", ["date_raw_partition"]),
                      transform=lambda df: land(df, maps, instant, "-04:00"))
    back = spark.read.schema("articulokey int, nombre string, raw_timestamp timestamp, "
                             "date_raw_partition date, batch_id int").json(out)
    assert back.count() == part.count()
    assert back.select("articulokey").distinct().count() == part.count()
    assert [str(r[0]) for r in back.select("date_raw_partition").distinct().collect()] == ["2025-03-01"]


def test_bucketed_manifest_is_not_reshuffled(spark, capsys):
    from stratal.operators.changes import load_manifest, save_manifest

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    save_manifest(content_hash(docs, "doc_id", "text"), "stratal_manifest_test", buckets=8)
    prev = load_manifest(spark, "stratal_manifest_test", bucketed=True)
    cur = content_hash(docs.where(F.col("doc_id") % 3 != 0), "doc_id", "text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = detect_changes(cur, prev)
        out.explain("formatted")
        plan = capsys.readouterr().out
        exchanges = [line for line in plan.splitlines() if line.startswith("(") and ") Exchange" in line]
        assert len(exchanges) == 1 and "Bucketed: true" in plan  # only the current side moves
        assert {r.status for r in out.collect()} == {"unchanged"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_manifest_path_round_trip(spark, tmp_out):
    from stratal.operators.changes import load_manifest, save_manifest

    m = content_hash(spark.createDataFrame([("a", "1"), ("b", "2")], "key string, t string"), "key", "t")
    save_manifest(m, tmp_out)
    assert sorted(r.key for r in load_manifest(spark, tmp_out).collect()) == ["a", "b"]


def test_first_run_relative_keys_and_replacement(spark, tmp_out, tmp_path):
    from stratal.operators.changes import file_hashes
    from stratal.session import glob_paths

    for folder in ("a", "b"):
        (tmp_path / "one" / folder).mkdir(parents=True)
        (tmp_path / "one" / folder / "j.py").write_text(folder)
    files = file_hashes(spark, str(tmp_path / "one"), "*.py", key="relative")
    assert sorted(r["key"] for r in files.collect()) == ["a/j.py", "b/j.py"]
    first = detect_changes(files, load_manifest(spark, tmp_out))
    assert {r["status"] for r in first.collect()} == {"new"}
    save_manifest(files, tmp_out)
    (tmp_path / "two").mkdir()
    (tmp_path / "one").rename(tmp_path / "two" / "moved")  # the root moves: nothing is new
    moved = file_hashes(spark, str(tmp_path / "two" / "moved"), "*.py", key="relative")
    assert {r["status"] for r in detect_changes(moved, load_manifest(spark, tmp_out)).collect()} == {"unchanged"}
    for text in ("x", "y", "z"):
        save_manifest(moved.limit(1).selectExpr("key", f"'{text}' AS hash"), tmp_out)
        assert [r["hash"] for r in load_manifest(spark, tmp_out).collect()] == [text]
    assert len(glob_paths(spark, f"{tmp_out}/version=*")) == 2  # the newest and the one before it
    # an unfinished version is not read
    moved.write.parquet(f"{tmp_out}/version=0000000099")
    (done,) = glob_paths(spark, f"{tmp_out}/version=0000000099/_SUCCESS")
    from stratal.session import remove_path

    remove_path(spark, done)
    assert load_manifest(spark, tmp_out).count() == 1


def test_repeated_keys_fail_the_comparison(spark):
    twice = spark.createDataFrame([("k", "1"), ("k", "2")], "key string, hash string")
    once = spark.createDataFrame([("k", "1")], "key string, hash string")
    for current, previous in ((twice, once), (once, twice)):
        with pytest.raises(Exception, match="occurs more than once: k"):
            detect_changes(current, previous).collect()


def test_incremental_landing_keeps_both_runs_and_replays(spark, tmp_out):
    from stratal.operators.mapping import Mapping
    from stratal.plans.jobs import land_incremental
    from stratal.session import glob_paths

    maps = [Mapping("id", "bigint", "n", "int")]
    src = f"{tmp_out}/src"
    schema = spark.range(1).schema

    def run():
        return land_incremental(spark, src, schema, maps, f"{tmp_out}/out", f"{tmp_out}/ckpt",
                                dt.datetime(2025, 3, 1, 12, tzinfo=dt.timezone.utc), "UTC")

    spark.range(0, 5).coalesce(1).write.mode("append").parquet(src)
    assert run() == 1
    spark.range(5, 9).coalesce(1).write.mode("append").parquet(src)
    assert run() == 1 and run() == 0
    back = spark.read.json(f"{tmp_out}/out")
    assert sorted(r["n"] for r in back.collect()) == list(range(9))
    assert [p.rsplit("/", 1)[1] for p in glob_paths(spark, f"{tmp_out}/out/*=*")] == ["date_raw_partition=2025-03-01"]
    # a replay of batch 1 after its commit was lost replaces it, also when the day has changed
    for lost in glob_paths(spark, f"{tmp_out}/ckpt/commits/1") + glob_paths(spark, f"{tmp_out}/ckpt/commits/.1.crc"):
        from stratal.session import remove_path

        remove_path(spark, lost)
    land_incremental(spark, src, schema, maps, f"{tmp_out}/out", f"{tmp_out}/ckpt",
                     dt.datetime(2025, 3, 2, 12, tzinfo=dt.timezone.utc), "UTC")
    back = spark.read.json(f"{tmp_out}/out")
    assert sorted(r["n"] for r in back.collect()) == list(range(9))
    assert back.where("date_raw_partition = '2025-03-02'").count() == 4
    with pytest.raises(RuntimeError, match="checkpoint"):
        land_incremental(spark, src, schema, maps, f"{tmp_out}/out", f"{tmp_out}/other", None, "UTC")


def test_timeout_stops_the_run_and_raises(spark, tmp_out):
    import time

    spark.range(3).write.parquet(f"{tmp_out}/src")
    with pytest.raises(TimeoutError):
        run_available_now(spark, f"{tmp_out}/src", spark.range(1).schema, f"{tmp_out}/ckpt",
                          lambda batch, i: time.sleep(20), timeout_s=1)
    assert not spark.streams.active
