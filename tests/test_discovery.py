"""Discovery as a streaming source: which files are taken, and which directories are listed."""

import os

import pytest
from pyspark.sql import functions as F

from lineflow.sources import discovery, files
from lineflow.sources.discovery import Discovery, Marks, NodeFiles
from lineflow.sources.stores import locate, read_file


def put(folder, name, at, text="x"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (at, at))
    return f"file:{path}"


def names(taken):
    return [f[0].rsplit("/", 1)[1] for f in taken]


def test_late_and_rewritten_files(tmp_path):
    """A file listed late by less than the offset is taken, a rewritten one again, others once."""
    scan = Discovery(str(tmp_path), offset_s=10).scan
    put(tmp_path, "b", 1000), put(tmp_path, "a", 995), put(tmp_path, ".hidden", 1000), put(tmp_path, "c._COPYING_", 1000)
    marks, taken = scan(Marks())
    assert names(taken) == ["a", "b"] and (marks.low, marks.high) == (990_000_000, 1000_000_000)
    put(tmp_path, "late", 992), put(tmp_path, "too-late", 989)
    marks, taken = scan(marks)
    assert names(taken) == ["late"]
    assert scan(marks) == (marks, [])
    put(tmp_path, "a", 1001), put(tmp_path, "new", 1020)
    marks, taken = scan(marks)
    assert names(taken) == ["a", "new"] and set(map(os.path.basename, marks.processed)) == {"new"}
    put(tmp_path, "a", 1012)
    assert names(scan(marks)[1]) == ["a"]


@pytest.mark.parametrize("seed", range(4))
def test_scans_take_what_the_batch_rule_takes(spark, tmp_path, seed):
    """The source and select_new_files() with advance_marks() agree, scan by scan."""
    from random import Random

    r, marks = Random(seed), Marks()
    find = Discovery(str(tmp_path), offset_s=5)
    low = high = -(10**9)
    processed = spark.createDataFrame([], "path string, mtime timestamp")
    second = lambda n: F.timestamp_seconds(F.lit(n))
    for step in range(4):
        for i in range(5):
            put(tmp_path, f"f{r.randrange(8)}", 1000 + 4 * step + r.randrange(12))
        listed = files.listing(spark, str(tmp_path))
        want = files.select_new_files(listed, processed, second(low), second(high)).select("path", "mtime")
        rows = [(x.path, x.mtime) for x in want.collect()]
        marks, taken = find.scan(marks)
        assert [f[0] for f in taken] == [p for p, _ in rows]
        new = spark.createDataFrame(rows, "path string, mtime timestamp")
        moved, kept = files.advance_marks(new, processed, second(low), second(high), F.expr("interval 5 seconds"))
        low, high = (int(x.timestamp()) for x in moved.select("low", "high").first())
        processed = spark.createDataFrame(kept.collect(), "path string, mtime timestamp")


FORMATS = "%Y%m%d/%H%M"


def test_only_directories_from_the_mark_on_are_listed(tmp_path):
    for day in range(1, 11):
        for hour in range(24):
            put(tmp_path, f"202401{day:02d}/{hour:02d}00/f{day}-{hour}", 1000 + day * 100 + hour)
    find = Discovery(str(tmp_path), offset_s=1e6, formats=FORMATS)
    marks, taken = find.scan(Marks())
    assert names(taken) == ["f1-0"] and len(find.listed) == 1 + 10 + 1  # the root, ten days, the first chunk
    seen = names(taken)
    while taken:
        marks, taken = find.scan(marks)
        seen += names(taken)
        assert len(taken) <= 1
    assert len(seen) == len(set(seen)) == 240
    assert [os.path.relpath(p, tmp_path) for p in find.listed] == [".", "20240110", "20240110/2300"]  # 2300 less 45 minutes is that directory alone
    put(tmp_path, "20240110/2300/more", 5000), put(tmp_path, "20240109/0000/behind", 5000), put(tmp_path, "20240112/0015/next", 5001)
    marks, taken = find.scan(marks)
    assert names(taken) == ["more", "next"]
    assert len(find.listed) == 1 + 2 + 2


def test_chunks_and_backlog(tmp_path):
    for minute in (0, 15, 30, 45):
        put(tmp_path, f"20240101/00{minute:02d}/f{minute}", 1000 + minute)
    (tmp_path / "20240101/0100").mkdir()
    put(tmp_path, "20240101/0500/late", 2000), put(tmp_path, "odd/deep/loose", 3000), put(tmp_path, "beside", 3000)
    find, every = (Discovery(str(tmp_path), offset_s=1e6, formats=FORMATS, chunk_s=1800, backlog=b) for b in (False, True))
    marks, taken = find.scan(Marks())
    assert names(taken) == ["f0", "f15", "beside", "loose"]
    marks, taken = find.scan(marks)
    assert names(taken) == ["f30", "f45"]
    marks, taken = find.scan(marks)
    assert names(taken) == ["late"]  # empty chunks are jumped over
    assert names(every.scan(Marks())[1]) == ["f0", "f15", "f30", "f45", "late", "beside", "loose"]


def test_stream(spark, tmp_path):
    """Each file once over restarts; a rewritten one again; a scan that Spark hadn't noted isn't lost."""
    spark.dataSource.register(NodeFiles)
    source, log, out = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "out")

    def run():
        stream = spark.readStream.format("node_files").option("log", log).option("offsetSeconds", 1000).option("filesPerPartition", 2).option("content", True).load(str(source))
        rows = stream.select("path", "length", F.col("content").cast("string").alias("content"))
        rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r.path.rsplit("/", 1)[1], r.content) for r in spark.read.schema(rows.schema).parquet(out).collect())

    for i in range(5):
        put(source, f"f{i}", 1000 + i, f"text {i}")
    first = [(f"f{i}", f"text {i}") for i in range(5)]
    assert run() == first
    assert run() == first
    put(source, "f1", 1100, "again"), put(source, "g", 900, "late")
    marks, taken = Discovery(str(source), 1000).scan(discovery.ScanLog(log).last())
    discovery.ScanLog(log).append(marks, taken)  # as if the driver had died here
    put(source, "h", 1200, "last")
    assert run() == sorted([*first, ("f1", "again"), ("g", "late"), ("h", "last")])
    rows = spark.read.format("node_files").option("glob", "f*").load(str(source))
    assert sorted(r.path for r in rows.collect()) == sorted(r.path for r in files.listing(spark, str(source), "f*").collect())


def test_paths_of_stores(tmp_path):
    path = put(tmp_path, "a b%.gz", 1, "text")
    assert read_file(path) == read_file(f"file://{tmp_path}/a b%25.gz") == b"text"
    assert locate("file:/x/y")[1:] == ("/x/y", "file:") == locate("/x/y")[1:]
