"""Zip packages put together from members that tasks deflate, read by another program."""

import io
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.sources import packages


@pytest.mark.parametrize("apart", [True, False])
def test_a_package_is_whole(spark, tmp_path, apart):
    rows = [(f"n/é{i:04}.md", (f"text {i} " * (i % 50)).encode() if i else None) for i in range(700)]
    path = str(tmp_path / "out" / "p.zip")
    df = spark.createDataFrame(rows, "name string, content binary").repartition(7)
    for _ in range(2):  # the second time over the first package
        assert packages.pack(df, path, apart=apart) == 700
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and z.namelist() == sorted(n for n, _ in rows)
        assert {n: z.read(n) for n in z.namelist()} == {n: c or b"" for n, c in rows}
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["p.zip"]


def test_nothing_to_pack(spark, tmp_path):
    assert packages.pack(spark.createDataFrame([], "name string, content binary"), str(tmp_path / "e.zip")) == 0
    with zipfile.ZipFile(tmp_path / "e.zip") as z:
        assert z.namelist() == []


def test_names_of_packages(spark, tmp_path):
    (tmp_path / "tree" / "m").mkdir(parents=True)
    (tmp_path / "tree" / "m" / "a.md").write_text("a")
    (tmp_path / "tree" / "README").write_text("r")
    day = date(2026, 3, 9)
    local = packages.package(spark, str(tmp_path / "tree"), str(tmp_path / "p"), "docs", "/runs/2026-abc", hosted=False, today=day)
    hosted = packages.package(spark, str(tmp_path / "tree"), str(tmp_path / "p"), "docs", "/runs/2026-abc", hosted=True, today=day)
    assert (local, hosted) == (str(tmp_path / "p" / "docs-2026-03-09-abc.zip"), str(tmp_path / "p" / "docs-2026-03-09.zip"))
    assert zipfile.ZipFile(hosted).namelist() == ["docs/README", "docs/m/a.md"]


def test_far_offsets_and_many_members():
    """The 64-bit records, as another program reads them."""
    name = b"x"
    entry, crc, packed, size = packages.member(name, b"hello")
    far = 5 << 30
    listed = packages.record(name, crc, packed, size, far)

    class Sparse(io.RawIOBase):
        """Five gigabytes of nothing, then the package's end."""

        tail = entry + listed + packages.end(70_000, len(listed), far + len(entry))

        def __init__(self):
            self.at = 0

        def seekable(self):
            return True

        def seek(self, n, whence=0):
            self.at = n if whence == 0 else self.at + n if whence == 1 else far + len(self.tail) + n
            return self.at

        def tell(self):
            return self.at

        def read(self, n=-1):
            n = far + len(self.tail) - self.at if n < 0 else n
            out = (b"\0" * max(0, min(n, far - self.at)) + self.tail[max(0, self.at - far) : max(0, self.at + n - far)])[:n]
            self.at += len(out)
            return out

    z = zipfile.ZipFile(Sparse())
    assert z.namelist() == ["x"] and z.getinfo("x").header_offset == far and z.read("x") == b"hello"


def test_members_are_read_by_ranges(spark, tmp_path, monkeypatch):
    """Of every kind of packing, with bytes in front and a comment behind, names that look like records, and ranges of few records."""
    from siltstone.sources import packages

    monkeypatch.setattr(packages, "DIRECTORY_RANGE", 100)
    fake = packages.record(b"no", 1, 2, 3, 4).decode("latin-1").replace("\x00", "\x01")
    want = {f"d/{i}{fake if i % 3 == 0 else ''}": (f"text {i} " * (i % 50)).encode() for i in range(400)} | {"d/": b"", "dé": b"x"}
    path = str(tmp_path / "p.zip")
    with open(path, "wb") as f:
        f.write(b"in front of it")
        with zipfile.ZipFile(f, "a") as z:
            for i, (name, content) in enumerate(want.items()):
                z.writestr(name, content, compress_type=(zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)[i % 4])
            z.comment = b"a comment"
    with zipfile.ZipFile(path) as z:
        theirs = {n: z.read(n) for n in z.namelist()}
    rows = packages.unpacked(spark, path).select("name", "content", F.spark_partition_id().alias("task")).collect()
    assert {r["name"]: bytes(r["content"]) for r in rows} == theirs and len(rows) == len(want)
    monkeypatch.setattr(packages, "MEMBERS_RANGE", 4000)
    rows = packages.unpacked(spark, path).select("name", "content", F.spark_partition_id().alias("task")).collect()
    assert {r["name"]: bytes(r["content"]) for r in rows} == theirs and len({r["task"] for r in rows}) > 3
