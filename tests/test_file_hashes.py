"""file_hashes streams the files: any length, any name, nothing left open."""

import hashlib
import os

import pytest

from stratal.operators.changes import file_hashes


def _sha256(path):
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def test_a_file_longer_than_a_value_is_hashed_whole(spark, tmp_path):
    """Sparse: 2 GiB and a few bytes, which no single value (nor a small heap) holds."""
    big = tmp_path / "big.parquet"
    with open(big, "wb") as f:
        f.write(b"PAR1")
        f.truncate((1 << 31) + 3)
        f.seek(0, os.SEEK_END)
        f.write(b"PAR1")
    (tmp_path / "small.parquet").write_bytes(b"PAR1")
    found = file_hashes(spark, str(tmp_path), "*.parquet", key="name")
    assert {(r["key"], r["hash"]) for r in found.collect()} == {
        ("big.parquet", _sha256(big)), ("small.parquet", _sha256(tmp_path / "small.parquet"))}


def test_contents_are_no_column(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"a")
    for key in ("path", "relative", "name"):
        plan = file_hashes(spark, str(tmp_path), key=key)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<path:string>" in plan


@pytest.mark.parametrize("whole_stage", ["true", "false"])
def test_names_and_lengths(spark, tmp_path, whole_stage):
    names = ["one two.bin", "per%20cent.bin", "a#b?c.bin", "sub/deep/ñandú.bin", "sub/x=1/twice.bin", "twice.bin"]
    for i, name in enumerate(names):
        place = tmp_path / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(bytes([i]) * (1 + i * 100_003))
    spark.conf.set("spark.sql.codegen.wholeStage", whole_stage)
    try:
        rows = file_hashes(spark, str(tmp_path), key="relative").collect()
        named = file_hashes(spark, str(tmp_path), key="name").collect()
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")
    assert {(r["key"], r["hash"]) for r in rows} == {(n, _sha256(tmp_path / n)) for n in names}
    assert sorted(r["key"] for r in named) == sorted(os.path.basename(n) for n in names)


def test_streams_are_closed(spark, tmp_path):
    for i in range(50):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]))
    assert file_hashes(spark, str(tmp_path)).distinct().count() == 50
    fds = f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/fd"
    held = []
    for fd in os.listdir(fds):
        try:
            held.append(os.readlink(f"{fds}/{fd}"))
        except FileNotFoundError:  # closed meanwhile
            pass
    assert not [x for x in held if x.startswith(str(tmp_path))]


def test_unreadable_files_fail_or_are_left_out_as_the_session_says(spark, tmp_path):
    (tmp_path / "good.bin").write_bytes(b"good")
    (tmp_path / "broken.bin").write_bytes(b"broken")
    (tmp_path / ".broken.bin.crc").write_bytes(b"crc\0\0\0\x02\0" + b"\1\2\3\4")  # not its checksum
    with pytest.raises(Exception, match="[Cc]hecksum"):
        file_hashes(spark, str(tmp_path), "*.bin").collect()
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        rows = file_hashes(spark, str(tmp_path), "*.bin", key="name").collect()
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
    assert [(r["key"], r["hash"]) for r in rows] == [("good.bin", _sha256(tmp_path / "good.bin"))]
