import uuid

import pytest

from stratal.operators import changes
from stratal.operators.changes import detect_changes, drop_manifest, load_manifest, save_manifest


def manifest(spark, tag, n=20):
    return spark.range(n).selectExpr("CAST(id AS string) AS key", f"concat('{tag}', id) AS hash")


def tag_of(spark, name):
    """The tag all rows of the readable manifest carry; fails on a partial one."""
    rows = load_manifest(spark, name, bucketed=True).collect()
    assert len(rows) in (0, 20)
    return {r["hash"].rstrip("0123456789") for r in rows}


@pytest.fixture(params=["plain", "database"])
def name(spark, request):
    short = f"mf_{uuid.uuid4().hex[:8]}"
    if request.param == "plain":
        yield short
        drop_manifest(spark, short)
    else:
        spark.sql(f"CREATE DATABASE db_{short}")
        yield f"db_{short}.hashes"
        drop_manifest(spark, f"db_{short}.hashes")
        spark.sql(f"DROP DATABASE db_{short}")


def test_refreshes_replace_and_keep_one_version_before(spark, name, tmp_out):
    assert tag_of(spark, name) == set()
    for k, tag in enumerate(["a", "b", "c", "d"]):
        save_manifest(manifest(spark, tag), name, buckets=4, location=tmp_out if k % 2 else None)
        assert tag_of(spark, name) == {tag}
    assert [n for n, _ in changes._numbered(spark, name)] == [3, 4]
    drop_manifest(spark, name)
    assert tag_of(spark, name) == set() and changes._numbered(spark, name) == []


class Crash(Exception):
    pass


STEPS = ["adopt", "write", "view", "drop"]


def crashing(monkeypatch, spark, step):
    """Break the next save at one step."""
    if step == "adopt":
        monkeypatch.setattr(changes, "_adopt", lambda *a: (_ for _ in ()).throw(Crash()))
    elif step == "drop":
        monkeypatch.setattr(changes, "_drop", lambda *a: (_ for _ in ()).throw(Crash()))
    elif step == "view":
        real = type(spark).sql

        def sql(self, text, *a, **k):
            if text.startswith("CREATE OR REPLACE VIEW"):
                raise Crash
            return real(self, text, *a, **k)

        monkeypatch.setattr(type(spark), "sql", sql)


class HalfWritten:
    """A frame whose write fails in a task, after other tasks wrote."""

    @staticmethod
    def of(spark):
        return manifest(spark, "broken").selectExpr("key", "IF(key = '13', raise_error('lost'), hash) AS hash")


@pytest.mark.parametrize("saved_before", [0, 1, 3])
@pytest.mark.parametrize("step", STEPS)
def test_a_crash_at_each_step_leaves_a_complete_manifest(spark, monkeypatch, step, saved_before):
    name = f"mf_{uuid.uuid4().hex[:8]}"
    try:
        for k in range(saved_before):
            save_manifest(manifest(spark, f"old{'x' * k}_"), name, buckets=4)
        before = tag_of(spark, name)
        with monkeypatch.context() as m:
            crashing(m, spark, step)
            try:
                save_manifest(HalfWritten.of(spark) if step == "write" else manifest(spark, "new"), name, buckets=4)
            except Exception:
                pass
        # on a first save there is no older manifest: a complete new table may be read, or none
        assert tag_of(spark, name) in ([before, {"new"}] if step == "drop" or (step == "view" and not saved_before) else [before])
        # a second failure, then a whole save
        with monkeypatch.context() as m:
            crashing(m, spark, step)
            try:
                save_manifest(HalfWritten.of(spark) if step == "write" else manifest(spark, "again"), name, buckets=4)
            except Exception:
                pass
        assert len(tag_of(spark, name)) == 1 or not saved_before
        save_manifest(manifest(spark, "last"), name, buckets=4)
        assert tag_of(spark, name) == {"last"}
        assert len(changes._numbered(spark, name)) <= 2
    finally:
        drop_manifest(spark, name)


@pytest.mark.parametrize("left_over", ["", "__next"])
def test_a_manifest_saved_as_a_plain_table_moves_behind_the_view(spark, left_over, monkeypatch):
    name = f"mf_{uuid.uuid4().hex[:8]}"
    manifest(spark, "plain").write.bucketBy(4, "key").saveAsTable(name + left_over)
    assert tag_of(spark, name) == {"plain"}
    with monkeypatch.context() as m:  # breaks off behind the move
        crashing(m, spark, "view")
        with pytest.raises(Crash):
            save_manifest(manifest(spark, "next"), name, buckets=4)
    assert tag_of(spark, name) in ({"plain"}, {"next"})
    save_manifest(manifest(spark, "now"), name, buckets=4)
    assert tag_of(spark, name) == {"now"}
    drop_manifest(spark, name)


def test_the_saved_side_is_read_bucketed_through_the_view(spark):
    name = f"mf_{uuid.uuid4().hex[:8]}"
    for tag in "ab":
        save_manifest(manifest(spark, tag), name, buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = detect_changes(manifest(spark, "b"), load_manifest(spark, name, bucketed=True))._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        drop_manifest(spark, name)
    assert "SelectedBucketsCount: 8 out of 8" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the current side only
