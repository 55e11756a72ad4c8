"""CSV records that cross byte ranges, against Spark's own reader of whole files."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql.types import StringType, StructField, StructType

from kindred.sources import csv_ranges
from kindred.sources.articles import CSV_OPTIONS
from kindred.sources.csv_ranges import csv_records, read_csv_ranges

SCHEMA = StructType([StructField(c, StringType()) for c in ("id", "text", "more")])
KEY = "spark.sql.files.maxPartitionBytes"


def field(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') else text


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three files: short nasty records, records longer than many ranges, and one with CR LF without an end of line."""
    path = tmp_path_factory.mktemp("ranges")
    draw = random.Random(2)
    texts = ["p", "", "null", 's"o"', "t\nw", "\n", '"', "a,b", "É\nü,", 'x\n"y"\nz', " b "]
    rows = [(str(i), t, draw.choice(texts)) for i, t in enumerate(texts)]
    one = "id,text,more\n" + "".join(",".join(map(field, r)) + "\n" for r in rows)
    long = "id,text,more\n" + "".join(f'{i},{field("line " + str(i) + chr(10) + ("w, " * i + chr(10) * 2) * i)},end\n' for i in range(9))
    crlf = "id,text,more\r\n" + "\r\n".join(f'{i},{field("a" * i)},{field("q,r")}' for i in range(3))
    for name, body in (("one", one), ("long", long), ("crlf", crlf), ("head", 'id,"text\nwith ""break""",more\n'), ("nothing", "")):
        (path / f"{name}.csv").write_bytes(body.encode())
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def cut(spark):
    """Sets the bytes of a range; small files count as small ranges then."""
    yield lambda size: spark.conf.set(KEY, str(size))
    spark.conf.unset(KEY)


def by_ranges(body, size):
    """The records of one file in ranges of ``size`` bytes, put together as the reader does."""
    ranges, at = {}, 0
    for line in body.split(b"\n")[: None if body and not body.endswith(b"\n") else -1]:
        ranges.setdefault(at // size * size, []).append(line)
        at += len(line) + 1
    batch = lambda start, more: pa.RecordBatch.from_pydict({"file": ["f"] * len(ranges[start]), "start": [start] * len(ranges[start]), "line": pa.array(ranges[start], pa.binary()), **more})
    inside, before, records, open_parts = 0, None, [], {}
    for start in sorted(ranges):
        # lines in batches of two: a range is read in several
        cut = [b for x in [batch(start, {"inside": [inside] * len(ranges[start])})] for b in (x.slice(0, 2), x.slice(2)) if b.num_rows]
        for piece in csv_ranges._cut(b'"', True)(iter(cut)):
            for r in piece.to_pylist():
                open_parts.setdefault(start if r["own"] else before, []).append(r["record"])
        for piece in csv_ranges._cut(b'"', False)(iter(cut)):
            records += piece.column("record").to_pylist()
        found = [r for b in csv_ranges._parities(b'"')(iter(cut)) for r in b.to_pylist()]
        assert len(found) == 1
        before = start if inside == 0 or found[0]["turns"] else before
        inside = (inside + found[0]["parity"]) % 2
    records += ["\n".join(x) for x in open_parts.values()]
    return sorted(r.rstrip("\r") for r in records if r.rstrip("\r"))


@pytest.mark.parametrize("name", ["one", "long", "crlf", "head", "nothing"])
def test_borders_at_every_byte(folder, name):
    body = (folder / f"{name}.csv").read_bytes()
    whole = by_ranges(body, 10**9)
    for size in range(1, len(body) + 1):
        assert by_ranges(body, size) == whole


@pytest.mark.parametrize("name", ["one", "crlf", "head", "nothing"])
def test_rows_of_sparks_reader(spark, folder, cut, name):
    path = str(folder / f"{name}.csv")
    want = rows(spark.read.schema(SCHEMA).csv(path, multiLine=True, nullValue="null", **CSV_OPTIONS))
    cut(30)
    assert rows(read_csv_ranges(spark, path, SCHEMA, nullValue="null", **CSV_OPTIONS)) == want


@pytest.mark.parametrize(("size", "sent"), [(200, 100_000), (200, 0), (10**9, 0)])
def test_ranges_of_several_files(spark, folder, cut, size, sent):
    want = [r for name in ("one", "long") for r in rows(spark.read.schema(SCHEMA).csv(str(folder / f"{name}.csv"), multiLine=True, nullValue="null", **CSV_OPTIONS))]
    cut(size)
    got = read_csv_ranges(spark, str(folder / "[ol]*.csv"), SCHEMA, sent=sent, nullValue="null", **CSV_OPTIONS)
    assert rows(got) == sorted(want, key=str)


def test_as_many_tasks_as_ranges(spark, folder, cut):
    path = folder / "long.csv"
    cut(100)
    records = csv_records(spark, str(path))
    assert records.rdd.getNumPartitions() >= path.stat().st_size // 100
    # the header and nine records, each in the range that it starts in
    assert records.count() == records.select("file", "start", "number").distinct().count() == 10


def test_changed_ranges_are_an_error(spark, folder, cut):
    cut(64)
    records = csv_records(spark, str(folder / "long.csv"))
    cut(100)
    with pytest.raises(Exception, match="maxPartitionBytes"):
        # planned anew under the other setting
        records.select("record").where("record != 'x'").collect()
