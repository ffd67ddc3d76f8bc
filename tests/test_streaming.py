"""Streams give what the batch operators give, in whatever order their files come."""

import os
import random
import shutil
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lineflow.operators import enrich, health, node_files, pairing, tables
from lineflow.plans import format_queries, line_job, node_fixtures, watch_job
from lineflow.plans.line_queries import toggles as batch_toggles
from lineflow.sources import archives
from lineflow.sources.discovery import NodeFiles
from lineflow.streaming import pairs, processors


def events_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def as_stream(df, folder, order, sentinel):
    """df cut in files by time, written in the given order, with a last file that moves the watermark."""
    spark = df.sparkSession
    bounds = [] if len(order) == 1 else df.approxQuantile("cut", [i / len(order) for i in range(1, len(order))], 0.0)
    cuts = F.lit(0)
    for b in bounds:
        cuts = cuts + (F.col("cut") > b).cast("int")
    parts = df.withColumn("part", cuts)
    for i in order:
        parts.where(F.col("part") == i).drop("part", "cut").coalesce(1).write.mode("append").parquet(folder)
    for row in sentinel:
        spark.createDataFrame([row], df.drop("cut").schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.drop("cut").schema).option("maxFilesPerTrigger", 1).parquet(folder)


FAR = datetime(2030, 1, 1)


@pytest.mark.parametrize("seed, seeded", [(None, False), (3, False), (4, True)])
def test_monitor_loop(spark, sf_dir, tmp_path, seed, seeded):
    rows = events_of(spark, sf_dir).where("user_id < 5")
    facts = rows.where(F.col("event_type").isin("click", "view", "signup"))
    facts = facts.select("event_id", "user_id", "ts", (F.col("event_id") % 7 == 0).cast("int").alias("reInit"), F.col("value").cast("int").alias("uas"), (F.col("event_id") % 5 != 0).alias("ifOperStatus"))
    switches = batch_toggles(spark, sf_dir).where("user_id < 5").withColumn("ts", F.col("ts").cast("timestamp"))
    want = {(str(r.user_id), r.event_id) for r in health.monitor_loop(facts, switches, ["user_id"], "ts", 3, 2, 2, 120, seeded).collect()}
    if seeded:
        switches = health.seed_toggles(switches, facts, ["user_id"], "ts", 3)
    tagged = processors.tagged_events(facts, switches, "user_id")
    order = list(range(3))
    if seed:
        random.Random(seed).shuffle(order)
    stream = as_stream(tagged.withColumn("cut", F.unix_seconds("ts")), str(tmp_path / "in"), order, [("z", FAR, 1, 0, None, 0, 0, True, None), ("z", FAR + timedelta(days=1), 1, 0, None, 0, 0, True, None)])
    processor = processors.MonitorLoopProcessor(tagged.schema, 3, 2, 2, 120)
    got = pairs.run_available(processors.process(stream, processor, "60 days"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert want and {(r.key, r.id) for r in got.collect() if r.key != "z"} == want


def test_pairs(spark, sf_dir, tmp_path):
    rows = events_of(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    side = lambda df, k: df.where(F.col("event_type") == k)
    paired, _ = pairing.pair_in_window(side(rows, "click"), side(rows, "view"), "user_id", "ts", "1 day", ["ts", "event_id"], ["event_id"])
    want = {(r.user_id, r.window_start): (r.left_event_id is None, r.right_event_id is None) for r in paired.collect()}
    stream = lambda name, kind: as_stream(side(rows, kind).withColumn("cut", F.unix_seconds("ts")), str(tmp_path / name), [0, 1], [(-1, -1, FAR, kind), (-2, -2, FAR + timedelta(days=1), kind)])
    found = pairs.pair_stream(stream("l", "click"), stream("r", "view"), "user_id", "ts", "1 day", "60 days", ["event_id"])
    got = pairs.run_available(found, str(tmp_path / "out"), str(tmp_path / "cp")).where("user_id >= 0").collect()
    both = {(r.user_id, r.window_start) for r in got if r.left_event_id is not None and r.right_event_id is not None}
    assert both == set(want)
    alone = {(r.user_id, r.window_start) for r in got if (r.left_event_id is None) != (r.right_event_id is None)}
    _, unmatched = pairing.pair_in_window(side(rows, "click"), side(rows, "view"), "user_id", "ts", "1 day", ["ts", "event_id"], ["event_id"])
    assert alone == {(r.user_id, r.window_start) for r in unmatched.collect()}


def test_enrichment(spark, sf_dir, tmp_path):
    rows = events_of(spark, sf_dir).where("user_id < 5")
    facts = rows.where("event_type <> 'signup'").select("event_id", "user_id", "ts")
    changes = rows.where("event_type = 'signup'").select("user_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("b"), F.lit(True).alias("present_b"))
    want = {r.event_id: (r.b, r.enriched) for r in enrich.enrich_asof(facts, changes, ["user_id"], "ts", ["b"]).collect()}
    tagged = facts.select(F.col("user_id").cast("string").alias("key"), "ts", F.lit(1).alias("kind"), F.col("event_id").alias("id"), F.lit("").alias("name"), F.lit(None).cast("string").alias("value"))
    tagged = tagged.unionByName(changes.select(F.col("user_id").cast("string").alias("key"), "ts", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit("b").alias("name"), F.col("b").alias("value")))
    stream = as_stream(tagged.withColumn("cut", F.unix_seconds("ts")), str(tmp_path / "in"), [1, 0], [("z", FAR, 1, 0, "", None), ("z", FAR + timedelta(days=1), 1, 0, "", None)])
    processor = processors.EnrichProcessor(tagged.schema)
    got = pairs.run_available(processors.process(stream, processor, "60 days"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {r.id: ((r.held or {}).get("b"), r.enriched) for r in got.collect() if r.key != "z"} == want


def test_latest_join_steps():
    processor = processors.LatestJoinProcessor(None)
    at = lambda d: datetime(2024, 1, d)
    state, out = processor.start, []
    for d, side, value in [(1, "left", "a"), (2, "right", "x"), (2, "tick", None), (3, "tick", None), (4, "right", "y"), (4, "tick", None), (5, "tick", None), (6, "tick", None), (7, "tick", None), (8, "left", "b"), (9, "right", "z")]:
        state, more = processor.apply(state, Row(key="k", ts=at(d), side=side, value=value))
        out += [(r.left, r.right, r.wiped) for r in more]
    assert out == [("a", "x", False), ("a", "y", False), ("a", None, True), ("b", "z", False)]


def test_restart_from_checkpoint(spark, tmp_path):
    """A watch that begins before a restart goes on after it."""
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    schema = "key string, ts timestamp, kind int, id long, flag boolean, reInit int, uas int, up boolean, held array<struct<reInit:int,uas:int,up:boolean>>"
    event = lambda m: ("a", at(m), 1, m, None, 0, 0, True, None)
    runs = [[("a", at(0), 0, None, True, None, None, None, None), event(1), event(2)], [event(3), event(4)], [("z", FAR, 1, 0, None, 0, 0, True, None)]]
    folder, found = str(tmp_path / "in"), []
    for rows in runs:
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        processor = processors.MonitorLoopProcessor(df.schema, 3, 2, 1, 1)
        got = pairs.run_available(processors.process(stream, processor, "1 minute"), str(tmp_path / "out"), str(tmp_path / "cp"))
        found.append({r.id for r in got.collect() if r.key == "a"})
    assert found[-1] == {3} and found[0] == set()


def test_latest_join_stream(spark, tmp_path):
    """The stream gives what the steps give, though its file holds the rows in another order."""
    at = lambda d: datetime(2024, 1, d)
    schema = "key string, ts timestamp, side string, value string"
    steps = [(1, "left", "a"), (2, "right", "x"), (2, "tick", None), (3, "tick", None), (4, "tick", None), (5, "left", "b"), (6, "right", "z")]
    rows = [("k", at(d), side, value) for d, side, value in steps]
    processor = processors.LatestJoinProcessor(spark.createDataFrame(rows, schema).schema)
    state, want = processor.start, []
    for row in rows:
        state, out = processor.apply(state, Row("key", "ts", "side", "value")(*row))
        want += [(r.left, r.right, r.wiped) for r in out]
    df = spark.createDataFrame(rows[::-1], schema).withColumn("cut", F.unix_seconds("ts"))
    stream = as_stream(df, str(tmp_path / "in"), [0], [("z", FAR, "left", "s"), ("z", FAR + timedelta(days=1), "left", "s")])
    got = pairs.run_available(processors.process(stream, processor, "1 day"), str(tmp_path / "out"), str(tmp_path / "cp")).where("key = 'k'").orderBy("ts").collect()
    assert sorted((r.left, r.right or "", r.wiped) for r in got) == sorted((a, b or "", w) for a, b, w in want)
    assert ("a", None, True) in want


def test_fan_out_and_continuous_run(spark, tmp_path):
    rows = spark.createDataFrame([("bad", 1), ("good", 2), ("good", 3)], "kind string, v int")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = {}
    sink = lambda name: lambda batch, _: got.setdefault(name, []).extend(r.v for r in batch.collect())
    pairs.fan_out(stream, {"good": sink("good"), "bad": sink("bad")}, "kind", str(tmp_path / "cp")).awaitTermination()
    assert {k: sorted(v) for k, v in got.items()} == {"good": [2, 3], "bad": [1]}
    query = pairs.run_continuous(stream, str(tmp_path / "out"), str(tmp_path / "cp2"), "1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def file_stream(spark, folder, log, **options):
    spark.dataSource.register(NodeFiles)
    return spark.readStream.format("node_files").options(log=str(log), **options).load(str(folder))


def rows_of(spark, path, drop=()):
    return sorted(repr(sorted(r.asDict().items())) for r in tables.live(spark, path).drop(*drop).collect())


def test_line_stream_equals_the_batch_job(spark, tmp_path):
    """Real node files in dated directories, two scans a batch apart; some have no partner, some are broken, some have odd names; a far pair moves the watermark."""
    sf_dir = "/root/testdata/sf0.01"
    folder, source = Path(node_fixtures.node_folder(spark, sf_dir).removeprefix("file:")), tmp_path / "in"
    reference = lambda: (format_queries._line_attributes(spark, sf_dir), format_queries._tables(spark, sf_dir))
    some = sorted(f for f in folder.rglob("*.tar.gz") if 1 <= int(f.name[1 : f.name.index("_")]) <= 4)  # the last two lack a partner, or have a broken one
    for i, f in enumerate(random.Random(1).sample(some, len(some))):
        target = source / f.relative_to(folder)
        target.parent.mkdir(parents=True, exist_ok=True)
        os.utime(shutil.copy(f, target), (1_700_000_000 + i, 1_700_000_000 + i))
    (source / "20240101" / "notes.txt").write_text("x")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(source))
    *outputs, bad_files = line_job.line_records(spark, archives.name_only(listed), reference)
    line_job.write_outputs(*outputs, bad_files, str(tmp_path / "batch"), 0)

    def far(year):
        for kind in ("Inst", "Hist"):
            path = source / "20240120" / "0000" / f"Z_{kind}_{year}-01-01-00-00.tar.gz"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(node_fixtures.pack_archive([f"Time stamp,{year}-01-01T00:00:00Z\nNE Name,Z\nObject ID,a\n"]))

    out = str(tmp_path / "stream")

    def run():
        files = file_stream(spark, source, tmp_path / "log", formats="%Y%m%d/%H%M", offsetSeconds=1e9)
        line_job.line_stream(spark, files, reference, out, str(tmp_path / "cp"), lateness="60 days").awaitTermination()

    for _ in range(4):  # a chunk of directories each
        run()
    for year in (2030, 2031):  # the second batch is behind the watermark that the first one moves
        far(year), run()
    drop = ["batch_id", "tsEnrich", "processingTime", "fileTime", "relativePath", "path"]
    for table in ("records", "metadata", "bad-rows"):
        other = lambda rows: [r for r in rows if "'Z'" not in r]
        want, got = (other(rows_of(spark, str(tmp_path / side / table), drop)) for side in ("batch", "stream"))
        assert want and got == want, table
    lines = lambda: sorted(r.value for r in tables.live(spark, f"{out}/unmatched", format="text").collect() if not r.value.startswith("Z"))
    want = sorted(r.value for r in tables.live(spark, str(tmp_path / "batch" / "unmatched"), format="text").collect())
    assert want and lines() == want
    errors = lambda side: sorted((r.path.rsplit("/", 1)[1], r.error) for r in tables.live(spark, str(tmp_path / side / "bad-files")).collect())
    assert errors("batch") == errors("stream") and {"notes.txt"} < {p for p, _ in errors("batch")}
    docs = {side: {r.id for r in tables.upserted(spark, str(tmp_path / side / "documents"), ["id"], "ts").collect()} for side in ("batch", "stream")}
    assert docs["batch"] and docs["batch"] == docs["stream"]

    kinds = {"records": "records", "bad_records": "bad-rows", "files": "metadata", "bad_files": "bad-files"}
    counts = lambda side: tables.live(spark, str(tmp_path / side / "quality")).agg(*(F.sum(k).alias(k) for k in kinds)).first().asDict()
    assert counts("batch") == {k: tables.live(spark, str(tmp_path / "batch" / table)).count() for k, table in kinds.items()}
    assert {**counts("stream"), "files": counts("stream")["files"] - 4} == counts("batch")  # the two far pairs have no line

    # a file behind the watermark is dropped by the pairing and listed once, over restarts
    late = source / "20240120" / "0000" / "N9_Inst_2024-01-05-00-00.tar.gz"
    late.write_bytes(b"never opened")
    run(), run()
    for year in (2032, 2033):
        far(year), run()
    assert lines() == sorted([*want, f"N9,{int(datetime(2024, 1, 5, tzinfo=timezone.utc).timestamp() * 1000)},2,file:{late}"])


def test_only_paired_files_are_opened_and_by_tasks(spark, tmp_path, sf_dir):
    """A hundred thousand pairs of paths: none is collected, each is opened once by a task, files without a partner never."""
    opened = tmp_path / "opened"
    opened.mkdir()
    archive = node_fixtures.pack_archive(["Time stamp,2024-01-01T00:00:00Z\nNE Name,N\nObject ID,a\np,1\n"])

    def open_file(path):
        with open(opened / str(os.getpid()), "a") as f:
            f.write(path + "\n")
        return archive

    n, at = 50_000, F.lit("2024-01-01 00:00").cast("timestamp")
    named = lambda kind: spark.range(n).select(F.concat(F.lit(f"/{kind}/"), "id").alias("path"), at.alias("mtime"), F.concat(F.lit("N"), "id").alias("name"), F.lit(kind).alias("dslam_type"), at.alias("ts"), F.lit(None).cast("string").alias("error"))
    lone = named(2).limit(100).select(F.concat(F.lit("/lone"), "path").alias("path"), "mtime", F.concat(F.lit("L"), "name").alias("name"), "dslam_type", "ts", "error")
    pairs, alone = node_files.pair_by_name(named(1).unionByName(named(2)).unionByName(lone))
    combined, unread, metadata, bad = node_files.read_pairs(spark, pairs, open_file)
    assert combined.count() == n and metadata.count() == 2 * n and alone.count() == 100 and unread.count() == bad.count() == 0
    paths = [line for f in opened.iterdir() for line in f.read_text().split()]
    assert len(paths) == len(set(paths)) == 2 * n and not any("lone" in p for p in paths)
    assert str(os.getpid()) not in {f.name for f in opened.iterdir()}


@pytest.mark.parametrize("seed", [1, 2])
def test_watch_loop_over_the_records_of_the_job(spark, sf_dir, tmp_path, seed):
    """Commands, look-up with retries, seeded gate, pattern and feedback: as the batch operators, for several orders of the records; then the exported list."""
    out = str(tmp_path / "out")
    events = events_of(spark, sf_dir).where("user_id < 12").select(
        F.unix_millis("ts").alias("ts"), F.concat(F.lit("N"), "user_id").alias("dslam"), F.lit("p").alias("port"), F.concat(F.lit("AVC"), F.lpad(F.col("user_id").cast("string"), 12, "0")).alias("avc"),
        (F.col("event_id") % 7 == 0).cast("int").alias("reInit"), F.col("value").cast("int").alias("uas"), (F.col("event_id") % 5 != 0).alias("ifOperStatus"),
    ).dropDuplicates(["ts", "dslam"]).cache()
    late_line = F.col("dslam") == "N3"
    parts = events.where(~late_line).withColumn("part", F.pmod(F.xxhash64("ts", F.lit(seed)), F.lit(3)))
    write = lambda rows, i: tables.write_batch_by_date(rows.withColumn("day", F.timestamp_millis("ts")), f"{out}/records", i, "day")
    for i in range(3):
        write(parts.where(F.col("part") == i).drop("part"), i)
    middle = events.agg(F.expr("timestamp_millis(percentile_approx(ts, 0.4))")).first()[0]
    switches = [(f"AVC{u:012d}", u % 4 != 2, middle + timedelta(hours=u)) for u in range(12)] + [("AVC000000000001", True, middle + timedelta(days=3)), ("AVC999999999999", True, middle)]
    commands = spark.createDataFrame(switches, "avc string, flag boolean, ts timestamp")
    commands.coalesce(1).write.parquet(str(tmp_path / "commands"))
    n, m, few, short = 3, 2, 2, 120
    look = lambda: watch_job.command_stream(spark, spark.readStream.schema(commands.schema).parquet(str(tmp_path / "commands")), out, str(tmp_path / "cp1"), n).awaitTermination()
    retries = lambda: {r.avc for r in tables.live(spark, f"{out}/retries").where(F.col("batch_id") == max(map(tables._batch_of, tables.live_folders(f"{out}/retries")))).collect()}
    look()
    assert retries() == {"AVC000000000003", "AVC999999999999"}
    write(events.where(late_line), 3)
    look()
    assert retries() == {"AVC999999999999"}
    write(events.where(F.col("dslam") == "N5"), 4)  # rows that come twice count once
    far = [(int(datetime(2030, 1, d, tzinfo=timezone.utc).timestamp() * 1000), "Z", "p", None, 0, 0, True) for d in (1, 2)]
    for i, row in enumerate(far):
        write(spark.createDataFrame([row], events.schema), 5 + i)
        watch_job.monitor_stream(spark, out, str(tmp_path / "cp2"), n, m, few, short, "60 days").awaitTermination()

    keyed = events.select(F.concat_ws(":", "dslam", "port").alias("key"), F.timestamp_millis("ts").alias("ts"), "reInit", "uas", "ifOperStatus")
    toggles = commands.where("avc < 'AVC9'").select(F.concat(F.lit("N"), F.substring("avc", 4, 12).cast("int"), F.lit(":p")).alias("key"), "ts", "flag")
    want = {(r.key, r.ts) for r in health.monitor_loop(keyed, toggles, ["key"], "ts", n, m, few, short, seeded=True).collect()}
    got = [(r.key, r.ts) for r in spark.read.parquet(f"{out}/matches").collect() if not r.key.startswith("Z")]
    assert want and len(got) == len(set(got)) and set(got) == want

    (tmp_path / "trigger").mkdir()
    export = lambda: watch_job.export_stream(spark, spark.readStream.text(str(tmp_path / "trigger")), str(tmp_path / "cp2"), out, str(tmp_path / "cp3")).awaitTermination()
    export()
    assert not os.path.exists(f"{out}/watch-list")
    (tmp_path / "trigger" / "now.txt").write_text("export\n")
    export()
    flags = {r.key: r.flag for r in tables.live(spark, f"{out}/watch-list").collect() if not r.key.startswith("Z")}
    # a match switches its line off, as if a toggle came with it
    ends = spark.createDataFrame([(k, t + timedelta(microseconds=1), False) for k, t in want], "key string, ts timestamp, flag boolean")
    known = {r.key: r.flag for r in health.export_watch_state(toggles.unionByName(ends), ["key"], "ts").collect()}
    assert {k: v for k, v in flags.items() if k in known} == known and not any(v for k, v in flags.items() if k not in known)


def test_toggles_are_seeded_with_the_newest_rows_before_them(spark):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    history = spark.createDataFrame([("a", at(m), m, None, None) for m in (5, 1, 3, 9)] + [("b", at(1), 7, 8, True)], "key string, ts timestamp, reInit int, uas int, ifOperStatus boolean")
    toggles = spark.createDataFrame([("a", at(4), True), ("a", at(5), True), ("a", at(0), True), ("a", at(9), False), ("b", at(2), True), ("c", at(2), True)], "key string, ts timestamp, flag boolean")
    held = {(r.key, r.ts): [h.reInit for h in r.held or []] for r in health.seed_toggles(toggles, history, ["key"], "ts", 2).collect()}
    assert held == {("a", at(4)): [1, 3], ("a", at(5)): [1, 3], ("a", at(0)): [], ("a", at(9)): [], ("b", at(2)): [7], ("c", at(2)): []}


def test_replayed_batch_replaces_all_it_wrote(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 2))], "id long, v string, ts timestamp")
    log = str(tmp_path / "log")
    assert tables.live(spark, log, "id long").count() == 0
    tables.upsert_by_key(rows, log, 1, "ts")
    tables.upsert_by_key(rows.where("id = 2"), log, 1, "ts")
    assert [r.id for r in tables.live(spark, log).collect()] == [2]


def test_readers_keep_their_version_over_replay_and_compaction(spark, tmp_path):
    at = lambda d: datetime(2024, 1, d)
    log = str(tmp_path / "log")
    batches = [[(1, "a", None, at(1)), (2, "b", "x", at(2))], [(1, None, "y", at(1))], [(2, "c", None, at(2)), (3, "d", None, at(3))]]
    frame = lambda b: spark.createDataFrame(b, "id long, v string, w string, ts timestamp")
    for i, b in enumerate(batches):
        tables.upsert_by_key(frame(b), log, i, "ts")
    view = lambda: sorted((r.id, r.v, r.w, r.ts) for r in tables.upserted(spark, log, ["id"], "ts").collect())
    before, want = tables.live(spark, log), [(1, "a", "y", at(1)), (2, "c", "x", at(2)), (3, "d", None, at(3))]
    assert view() == want
    tables.compact(spark, log, ["id"], "ts", 1)
    assert view() == want and tables.live(spark, log).count() == 4
    tables.upsert_by_key(frame(batches[2][:1]), log, 2, "ts")
    assert view() == want[:2]
    assert before.count() == 5  # what it began with is still there
    broken = frame(batches[1]).select(F.raise_error(F.lit("no")).alias("id"), "v", "w", "ts")
    with pytest.raises(Exception, match="no"):
        tables.upsert_by_key(broken, log, 2, "ts")
    assert view() == want[:2]  # a write that fails changes nothing
    assert tables.vacuum(log) >= 3 and view() == want[:2]


def test_small_files_by_date_become_few(spark, tmp_path):
    path, at = str(tmp_path / "t"), lambda d: datetime(2024, 1, d)
    for i in range(4):
        rows = spark.createDataFrame([(10 * i + d, at(d)) for d in (1, 2)], "id long, ts timestamp").repartition(2)
        tables.write_batch_by_date(rows, path, i, "ts")
    files = lambda: tables.live(spark, path).select("_metadata.file_path").distinct().count()
    ids = lambda: sorted(r.id for r in tables.live(spark, path).collect())
    want, before = ids(), files()
    tables.compact_by_date(spark, path, 2)
    assert ids() == want and files() == 4 < before


@pytest.mark.parametrize("order", [[0], [2, 0, 1], [1, 2, 0]])
def test_health_over_sql_on_streams(spark, sf_dir, tmp_path, order):
    rows = events_of(spark, sf_dir).where("user_id < 5").select(
        "event_id", "user_id", "ts", F.when(F.col("event_id") % 3 != 0, (F.col("event_id") % 40).cast("int")).alias("reInit"), F.when(F.col("event_id") % 4 != 0, (F.col("value") * 90).cast("int")).alias("uas")
    ).dropDuplicates(["user_id", "ts"])
    rows.select("ts", F.col("user_id").alias("dslam"), F.lit("p").alias("port"), F.lit("a").alias("avc"), "reInit", "uas").createOrReplaceTempView("compact_rows")
    want = {(str(r.dslam), r.ts, r.cnt, r.sum_reinit, r.sum_uas) for r in health.health_over_sql(spark, "compact_rows").collect()}
    tagged = rows.select(F.col("user_id").cast("string").alias("key"), "ts", F.col("event_id").alias("id"), "reInit", "uas")
    stream = as_stream(tagged.withColumn("cut", F.unix_seconds("ts")), str(tmp_path / "in"), order, [("z", FAR, 1, 0, 0), ("z", FAR + timedelta(days=1), 1, 0, 0)])
    got = pairs.run_available(processors.process(stream, processors.HealthOverProcessor(tagged.schema), "60 days"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert want and {(r.key, r.ts, r.cnt, r.sum_reinit, r.sum_uas) for r in got.collect() if r.key != "z"} == want


def test_plain_gate_on_streams(spark, sf_dir, tmp_path):
    rows = events_of(spark, sf_dir).where("user_id < 5")
    facts = rows.where(F.col("event_type").isin("click", "view", "signup")).select("event_id", "user_id", "ts", F.lit(1).alias("reInit"), F.lit(2).alias("uas"), F.lit(True).alias("ifOperStatus"))
    switches = batch_toggles(spark, sf_dir).where("user_id < 5").withColumn("ts", F.col("ts").cast("timestamp"))
    want = {(str(r.user_id), r.event_id) for r in health.watch_gate(facts, switches, ["user_id"], "ts").collect()}
    tagged = processors.tagged_events(facts, switches, "user_id")
    stream = as_stream(tagged.withColumn("cut", F.unix_seconds("ts")), str(tmp_path / "in"), [1, 0], [("z", FAR, 1, 0, None, 0, 0, True, None), ("z", FAR + timedelta(days=1), 1, 0, None, 0, 0, True, None)])
    got = pairs.run_available(processors.process(stream, processors.GateProcessor(tagged.schema), "60 days"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert want and {(r.key, r.id) for r in got.collect() if r.key != "z"} == want
