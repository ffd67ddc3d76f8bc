"""Golden rows, naive simulations and properties of the line operators."""

import io
import json
import math
import tarfile
from datetime import datetime, timedelta

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lineflow.functions import inventory, percentiles, ports
from lineflow.operators import decode, enrich, health, pairing, segments, tables, windows
from lineflow.plans import format_queries
from lineflow.sources import archives, files, text

EASY = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = datetime(2024, 1, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [
    ("R1.S1.LT3.P7", "R1.S1.LT3.P7"), ("R1.S1.LT3.P7.ITF1", "R1.S1.LT3.P7"), ("/x/rackNr=1/subrackNr=1/slotNr=5/portNr=7/..", "R1.S1.LT3.P7"), ("weird", None), ("", None), (None, None),
    ("/x/rackNr=12/subrackNr=1/slotNr=5/portNr=7", None), ("/x/rackNr=1/subrackNr=1/slotNr=123/portNr=7", None), ("/x/rackNr=1/subrackNr=1/slotNr=12/portNr=1234", "R1.S1.LT10.P12"), ("R12.S1.LT3.P7", None),
])
def test_ports(spark, raw, want):
    assert one(spark, ports.normalise_port(F.lit(raw).cast("string"))) == want


def test_dashes_and_ids(spark):
    assert one(spark, ports.rewrite_dashes(F.lit("a 1-1-3-7-9"))) == "a R1.S1.LT3.P7-9"
    assert tuple(one(spark, ports.split_id(F.lit("n:1:2")))) == ("n", "1:2") and tuple(one(spark, ports.split_id(F.lit("n")))) == ("n", "")
    got = one(spark, ports.parse_file_name(F.lit("/d/20240101/0015/N1_Inst_2024-01-01-00-15.tar.gz")))
    assert (got.name, got.dslam_type, got.ts) == ("N1", ports.INSTANT, datetime(2024, 1, 1, 0, 15))
    assert one(spark, ports.parse_file_name(F.lit("other.csv"))).name is None


def test_inventory_edges(spark):
    fls = [("a", "n", "UNI1", "Fibre To The Curb", T0, "D100_U40_Mbps_TC4"), ("b", "n", "UNI2", "Fibre To The Node", T0, "x_D25-50_U5-10_Mbps_TC4_P"), ("c", "n", "UNI3", "Fibre To The Building", T0, None)]
    rows = spark.createDataFrame(fls, "avc_id string, ntd_id string, uni_prid string, access_service_tech_type string, metrics_date timestamp, avc_bandwidth_profile string")
    assert [(r.avc, r.tech_type, r.tc4_ds, r.tc4_us) for r in inventory.decode_fls(rows).collect()] == [("b", "FTTN", "50", "10")]
    assert [one(spark, inventory.atten_index(F.lit(v).cast("float"))) for v in (-3.0, 23.5, 71.0, 70.0, 0.49)] == [0, 24, 70, 70, 0]
    nac = [(T0, "n", "1-1-3-7", "1.9", "-2.9", "ADP-VDSL_00dB", None), (T0, "n", "p", "", "3", None, "7"), (T0, "n", "p", "1", "2", None, "0.0"), (T0, "n", "p", "x", "2", None, "7")]
    rows = spark.createDataFrame(nac, "metrics_timestamp timestamp, dslam string, port string, max_additional_noise_margin_us string, max_additional_noise_margin_ds string, dpbo_profile_name string, rtx_attainable_net_data_rate_ds string")
    assert [tuple(r)[2:] for r in inventory.decode_nac(rows).collect()] == [("R1.S1.LT3.P7", -2, 1, 0), ("p", -1, -1, 1)]


def solved(spark, rate, table, tier="100", direction="ds", atten=20, tech="FTTN", margin=0, dpbo=1):
    row = (tech, atten, dpbo, margin, tier, rate, table, table)
    d = direction
    df = spark.createDataFrame([row], f"tech_type string, atten365 short, dpbo_profile byte, noise_margin_{d} short, tc4_{d} string, attndr_{d} int, current_{d} array<float>, expected_{d} array<float>")
    p = percentiles.rate_to_percentile(F.col("atten365"), F.col(f"attndr_{d}"), F.col(f"current_{d}"), d)
    return df.select(p).first()[0], percentiles.corrected_rate(df, d).select(f"corrected_{d}").first()[0]


def test_percentile_edges(spark):
    table = [float(1000 * (i + 1)) for i in range(34)]
    cases = {175000: 0.0, 0: -200.0, -5: -200.0, 400: 100.0, 1000: 99.5, 1500: 100 - 0.5 - (0.5**2.18) * 3, 34000: 100 - 0.5 - 99.0, 200000: 0.0, 134833: 0.0}
    for rate, want in cases.items():
        assert solved(spark, rate, table)[0] == pytest.approx(want, abs=1e-6), rate
    assert solved(spark, 5000, [5000.0] * 34)[0] == pytest.approx(100 - 0.5 - 32.5 * 3)
    assert solved(spark, 110000, [float(90000 + 1000 * i) for i in range(34)], margin=30)[1] == -1
    assert solved(spark, 60000, table, tier="50", tech="FTTB")[1] == -1
    assert solved(spark, 60000, table, tier="7")[1] == -1 and solved(spark, 60000, [])[1] == -1


@EASY
@given(rate=st.integers(28000, 100000), low=st.integers(1000, 60000), step=st.integers(1, 2500))
def test_rate_survives_the_round_trip(spark, rate, low, step):
    """From a rate to its percentile and back on the same contours; only up, never under the tier."""
    table = [float(low + step * i) for i in range(34)]
    p, rate_back = solved(spark, rate, table, tier="25")
    assert -200 <= p <= 100
    assert rate_back == -1 or rate <= rate_back <= 130000


def test_csv_rows(spark):
    names = [h for h, _, _ in decode.INSTANT_FIELDS + decode.HISTORICAL_FIELDS]
    good = ["up", "down", "1", "2", "3", "4", "235", "mac", *"123456789"]
    change = lambda **c: [c.get(n, v) for n, v in zip([f for _, f, _ in decode.INSTANT_FIELDS + decode.HISTORICAL_FIELDS], good)]
    rows = {1: good, 2: change(ifAdminStatus=""), 3: change(ses="x"), 4: change(attenuationDs=""), 5: change(actualDs="x"), 6: good[:8]}
    data = [(k, ",".join(names), ",".join(v)) for k, v in rows.items()] + [(7, ",".join(names[1:]), ",".join(good[1:])), (8, ",".join(names[::-1]), ",".join(good[::-1]))]
    ok, bad = decode.decode_csv(spark.createDataFrame(data, "id int, columns string, csv string"))
    got = {r.id: r for r in ok.collect()}
    assert sorted(got) == [1, 2, 3, 4, 6, 8] and {r.id: r.error.split(":")[0] for r in bad.collect()} == {5: "bad number", 7: "missing columns"}
    assert got[1].inst == got[8].inst and got[1].hist == got[8].hist and got[1].hist.reTransDs == 9
    assert tuple(got[2].inst) == (False, False, -1, -1, -1, -1, None, None)
    assert got[3].hist is None and got[6].hist is None and got[4].inst.attenuationDs is None
    assert [r.id for r in decode.active(ok).orderBy("id").collect()] == [1, 3, 4, 6, 8]


@EASY
@given(a=st.dictionaries(st.sampled_from("pqrs"), st.just("1,2")), b=st.dictionaries(st.sampled_from("pqrs"), st.just("3")))
def test_merged_rows_have_all_fields(spark, a, b):
    kind = "map<string,string>"
    df = spark.createDataFrame([(a, b)], f"a {kind}, b {kind}")
    got = df.select(pairing.merge_csv(F.lit("x,y"), F.col("a"), F.lit("z"), F.col("b"))).first()[0]
    assert got == archives.merge_rows("x,y", a, "z", b) and all(v.count(",") == 2 for v in got.values())


def tar(*members):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as out:
        for i, data in enumerate(members):
            info = tarfile.TarInfo(f"m{i}")
            info.size, info.mtime = len(data), 1_700_000_000 + i
            out.addfile(info, io.BytesIO(data))
    return buffer.getvalue()


def test_node_files(spark, tmp_path):
    member = lambda ne, columns, *rows: "\n".join(["Time stamp,2024-01-01T00:15:00Z", f"NE Name,{ne}", "", f"Object ID,{columns}", *rows]).encode()
    folder = tmp_path / "20240101" / "0015"
    folder.mkdir(parents=True)
    (folder / "N1_Inst_2024-01-01-00-15.tar.gz").write_bytes(tar(member("N1", "a,b", "p,1,2", "q,3,4", "q,5,6"), member("N1", "c", "q,7", "r,8")))
    (folder / "N1_Hist_2024-01-01-00-15.tar.gz").write_bytes(tar(member("N1", "d", "p,9")))
    (folder / "N2_Hist_2024-01-01-00-15.tar.gz").write_bytes(tar(member("N2", "d")))
    (folder / "N3_Hist_2024-01-01-00-15.tar.gz").write_bytes(tar(member("N3", "d", "p,9"))[:40])
    (folder / "N4_Inst_2024-01-01-00-15.tar.gz").write_bytes(tar(member("N4", "d"), member("N5", "e")))
    (folder / "readme.txt").write_bytes(b"x")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    got = archives.read_node_files(raw).collect()
    assert {(r.name, r.dslam_type, r.port, r.csv) for r in got if not r.error and r.port} == {("N1", 2, "p", "1,2,"), ("N1", 2, "q", "5,6,7"), ("N1", 2, "r", ",,8"), ("N1", 1, "p", "9")}
    assert sorted((r.name, r.dslam_type, r.records) for r in got if not r.error and not r.port) == [("N1", 1, 1), ("N1", 2, 3), ("N2", 1, 0)]
    assert len([r for r in got if r.error]) == 3
    assert {(r["name"], r.dslam_type) for r in archives.name_only(raw).where("error is null").collect()} == {("N1", 1), ("N1", 2), ("N2", 1), ("N3", 1), ("N4", 2)}
    plan = archives.name_only(raw)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert decode.file_metadata(archives.read_node_files(raw)).count() == 3
    assert files.listing(spark, str(tmp_path), "*.tar.gz").count() == 5


@EASY
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(1, 30)), max_size=5), min_size=1, max_size=4))
def test_discovery_takes_every_version_once(spark, scans):
    """Files come in any order, within the buffer of a scan; each (path, time) that is newest for its path is taken once."""
    kind = "path string, mtime timestamp"
    at = lambda n: T0 + timedelta(minutes=n)
    mark = lambda t: F.lit(t).cast("timestamp")
    low = high = at(0)
    processed, listed, taken = [], {}, []
    for scan in scans:
        for path, n in scan:
            listed[path] = max(at(n), listed.get(path, at(n)))
        new = files.select_new_files(spark.createDataFrame(list(listed.items()), kind), spark.createDataFrame(processed, kind), mark(low), mark(high))
        got = [tuple(r) for r in new.collect()]
        assert got == sorted(got, key=lambda r: (r[1], r[0]))
        taken += got
        marks, kept = files.advance_marks(spark.createDataFrame(got, kind), spark.createDataFrame(processed, kind), mark(low), mark(high), F.expr("interval 40 minutes"))
        low, high = tuple(marks.first())
        processed = [tuple(r) for r in kept.collect()]
    assert len(taken) == len(set(taken)) and {max(t for p, t in taken if p == path) for path in listed} == set(listed.values())


@EASY
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 12), st.booleans()), min_size=1, max_size=25))
def test_health_pattern_equals_naive_search(spark, rows):
    n, m, most_re, most_uas = 4, 2, 3, 15
    df = spark.createDataFrame([("a", i, re, uas, up) for i, (re, uas, up) in enumerate(rows)], "k string, ts int, reInit int, uas int, ifOperStatus boolean")
    want = []
    for i in range(n - 1, len(rows)):
        span, last = rows[i - n + 1 : i + 1], rows[i - m + 1 : i + 1]
        if sum(r[0] for r in span) < most_re and sum(r[1] for r in last) < most_uas and all(r[2] for r in last):
            want.append(i)
    assert [r.ts for r in health.health_pattern(df, ["k"], ["ts"], n, m, most_re, most_uas).orderBy("ts").collect()] == want
    with pytest.raises(ValueError):
        health.health_pattern(df, ["k"], ["ts"], 2, 2)


def test_wiped_attribute_wins_and_absent_one_stays(spark):
    facts = spark.createDataFrame([("k", 1, 10), ("k", 5, 11), ("k", 9, 12), ("j", 9, 13)], "k string, ts int, id int")
    attrs = spark.createDataFrame([("k", 2, "a", True, "x", True), ("k", 4, None, False, "y", True), ("k", 9, None, True, None, False)], "k string, ts int, a string, present_a boolean, b string, present_b boolean")
    got = {r.id: (r.a, r.b, r.enriched) for r in enrich.enrich_asof(facts, attrs, ["k"], "ts", ["a", "b"]).collect()}
    assert {k: v[:2] for k, v in got.items()} == {10: (None, None), 11: ("a", "y"), 12: (None, "y"), 13: (None, None)}
    assert got[11][2] and not got[10][2] and not got[13][2]
    assert tuple(enrich.attribute_merge(attrs, ["k"], "ts", ["a", "b"]).first()) == ("k", None, "y")


def test_text_lines(spark):
    lines = ["AVC000000000001", "AVC000000000001,on", "AVC000000000002 off\nAVC000000000003,true", "AVC1,on", ""]
    got = text.parse_watch_commands(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.avc[-1], r.flag) for r in got] == [("1", True), ("1", True), ("2", False), ("3", True)]
    js = ['{"Tier":"FTTN,100","Attenuation":23,"Percentiles":[1,2.5]}', "[1]", "nonsense", '{"Tier":"x"}', '{"Percentiles":[3]}']
    assert [(r.key, list(r.pctls)) for r in text.parse_percentiles(spark.createDataFrame([(x,) for x in js], "value string")).collect()] == [("FTTN,100,23", [1.0, 2.5]), (",0", [3.0])]


def test_typed_read_and_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", T0), (2, "b", T0 + timedelta(days=1))], "id long, v string, ts timestamp")
    tables.write_by_date(rows, path, "ts")
    assert sorted(p.name for p in (tmp_path / "t").glob("dt=*")) == ["dt=2024-01-01", "dt=2024-01-02"]
    assert files.read_typed(spark, path, StructType([StructField("id", LongType()), StructField("v", StringType())])).count() == 2
    with pytest.raises(ValueError, match="v"):
        files.read_typed(spark, path, StructType([StructField("v", LongType())]))
    tables.write_lines_by_date(rows.select("v"), str(tmp_path / "lines"))
    assert {r.value for r in spark.read.text(str(tmp_path / "lines")).select("value").collect()} == {"a", "b"}
    log = str(tmp_path / "log")
    for _ in range(2):
        tables.upsert_by_key(rows, log, 1, "ts")
        tables.upsert_by_key(rows.where("id = 1").withColumn("v", F.lit(None).cast("string")), log, 2, "ts")
    assert {r.id: r.v for r in tables.upserted(spark, log, ["id"], "ts").collect()} == {1: "a", 2: "b"}
    assert {r.id: r.v for r in tables.replaced(spark, log, ["id"], "ts").collect()} == {1: None, 2: "b"}


@pytest.mark.parametrize("days", [7, 3 * tables.OPEN_FILES])
def test_writes_by_date_sort_no_whole_task(spark, tmp_path, days):
    rows = spark.range(days * 40).repartition(2).select("id", F.timestamp_seconds(F.col("id") % days * 86400).alias("ts"))
    tables.write_by_date(rows, str(tmp_path / "t"), "ts")
    tables.upsert_by_key(rows, str(tmp_path / "log"), 1, "ts")
    store = spark._jsparkSession.sharedState().statusStore()
    ran = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsList().size())]
    writes = [plan for plan in ran if str(tmp_path) in plan and "WriteFiles" in plan]
    assert len(writes) == 2 and not any("Sort" in plan for plan in writes)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None
    got = spark.read.parquet(str(tmp_path / "t")).select("id", "ts", F.col("dt").cast("string")).collect()
    assert sorted(r.id for r in got) == list(range(days * 40)) and all(str(r.ts.date()) == r.dt for r in got)
    assert len(list((tmp_path / "t").glob("dt=*"))) == days and len(list((tmp_path / "t").glob("dt=*/*.parquet"))) <= 2 * days
    assert sorted(r.id for r in tables.live(spark, str(tmp_path / "log")).collect()) == list(range(days * 40))


def test_failed_writes_by_date_leave_the_session_alone(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"), F.lit(T0).alias("ts"))
    with pytest.raises(Exception, match="no"):
        tables.write_by_date(broken, str(tmp_path / "t"), "ts")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None


def test_documents_have_the_long_names(spark):
    inst = "inst struct<ifAdminStatus:boolean,ifOperStatus:boolean,actualDs:int,actualUs:int,attndrDs:int,attndrUs:int,attenuationDs:short,userMacAddress:string>"
    hist = "hist struct<ses:short,uas:short,lprFe:short,sesFe:short,reInit:short,unCorrDtuDs:long,unCorrDtuUs:long,reTransUs:long,reTransDs:long>"
    rows = [(9, "N", "P", (True, False, 1, 2, 3, 4, 235, "m"), tuple(range(11, 20)), (5, "AVC", "c", 6, -1)), (9, "N", "Q", (True, True, 1, 2, 3, 4, None, None), None, None)]
    df = spark.createDataFrame(rows, f"ts long, dslam string, port string, {inst}, {hist}, enrich struct<ts:long,avc:string,cpi:string,corrAttndrDs:int,corrAttndrUs:int>")
    got = {r.id: json.loads(r.doc) for r in decode.document(df).collect()}
    start = {"dslam": "N", "metrics_timestamp": 9, "ifAdminStatus": True, "xdslFarEndChannelActualNetDataRateDownstream": 1, "xdslChannelActualNetDataRateUpstream": 2, "xdslFarEndChannelAttainableNetDataRateDownstream": 3, "xdslChannelAttainableNetDataRateUpstream": 4}
    counters = ["xdslLinePreviousIntervalSESCounter", "xdslLinePreviousIntervalUASCounter", "xdslFarEndLinePreviousIntervalLPRCounter", "xdslFarEndLinePreviousIntervalSESCounter", "xdslLinePreviousIntervalReInitCounter", "xdslFarEndChannelPreviousIntervalUnCorrDtuCounterDS", "xdslChannelPreviousIntervalUnCorrDtuCounterUS", "xdslFarEndChannelPreviousIntervalRetransmDtuCounterUS", "xdslChannelPreviousIntervalRetransmDtuCounterDS"]
    assert got["N_P_9"] == {**start, "port": "P", "ifOperStatus": False, "xdslFarEndLineLoopAttenuationDownstream": 23.5, "macaddress": "m", **dict(zip(counters, range(11, 20))), "enrich_timestamp": 5, "avcid": "AVC", "cpid": "c", "correctedAttndrDs": 6, "correctedAttndrUs": -1}
    assert got["N_Q_9"] == {**start, "port": "Q", "ifOperStatus": True}


def test_rows_are_split_once(spark):
    """Whatever is asked of the decoded rows, a row's header and values are split once each."""
    names = ",".join(h for h, _, _ in [*decode.INSTANT_FIELDS, *decode.HISTORICAL_FIELDS])
    rows = spark.createDataFrame([(names, "up,up,1,2,3,4,5,m" + ",1" * 9), (names, "up,up,x,2,3,4,5,m"), ("a,b", "1,2")], "columns string, csv string")
    good, bad = decode.decode_csv(rows)
    for df in (good, bad, good.where("inst.actualDs > 0").select("hist.ses")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2
    assert [r.hist.ses for r in good.collect()] == [1]
    assert sorted(r.error.split(",")[0] for r in bad.collect()) == ["bad number", "missing columns: ifAdminStatus"]


def test_unreadable_files_are_reported(spark, tmp_path):
    path, schema = tmp_path / "t", StructType([StructField("id", LongType()), StructField("v", StringType())])
    for i in range(4):
        spark.createDataFrame([(j, "x" * 2000 + str(j)) for j in range(50)], schema).coalesce(1).write.parquet(str(path / f"p{i}"))
    spark.createDataFrame([], schema).coalesce(1).write.parquet(str(path / "none"))
    spark.createDataFrame([("a",)], "id string").coalesce(1).write.parquet(str(path / "other"))
    parts = {i: next((path / f"p{i}").glob("*.parquet")) for i in range(4)}
    for crc in path.rglob(".*.crc"):
        crc.unlink()
    parts[0].write_bytes(parts[0].read_bytes()[:100])
    data = bytearray(parts[1].read_bytes())
    data[20:400] = bytes(380)
    parts[1].write_bytes(data)
    (path / "p2" / "text.parquet").write_text("nothing")
    rows, report = files.read_reported(spark, str(path), schema)
    assert sorted({r.file_path.rsplit("/", 2)[1] for r in rows.collect()}) == ["p2", "p3"] and len(rows.collect()) == 100
    found = {tuple(r.path.rsplit("/", 2)[1:]): (r.rows_read, r.rows_held, r.error) for r in report.collect()}
    assert {k[0] if k[1] != "text.parquet" else "text": v[:2] for k, v in found.items()} == {"p0": (0, None), "p1": (0, 50), "text": (0, None), "other": (0, 1)}


ATTRIBUTE_ROWS = st.tuples(st.sampled_from(["k", "k", "k", "j", None]), st.integers(0, 60), st.one_of(st.none(), st.integers(0, 9)), st.booleans(), st.one_of(st.none(), st.integers(0, 9)), st.booleans())


@settings(EASY, max_examples=6)
@given(
    facts=st.lists(st.tuples(st.sampled_from(["k", "k", "k", "j", None]), st.integers(0, 60)), min_size=1, max_size=40),
    changes=st.lists(ATTRIBUTE_ROWS, max_size=25, unique_by=lambda r: r[:2]), size=st.sampled_from([1, 2, 5]),
)
def test_stretches_of_hot_keys_carry_what_is_known(spark, facts, changes, size):
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(facts)], "id int, k string, ts int")
    attrs = spark.createDataFrame(changes, "k string, ts int, a int, present_a boolean, b int, present_b boolean")
    want = {}
    for i, (k, ts) in enumerate(facts):
        a = b = None
        before = sorted((r for r in changes if r[0] == k and r[1] <= ts), key=lambda r: r[1])
        for _, _, a1, has_a, b1, has_b in before:
            a, b = a1 if has_a else a, b1 if has_b else b
        want[i] = (k, ts, a, b, bool(before))
    got = enrich.enrich_asof(df, attrs, ["k"], "ts", ["a", "b"], segment_rows=size).collect()
    assert len(got) == len(facts) and {r.id: (r.k, r.ts, r.a, r.b, bool(r.enriched)) for r in got} == want


def test_half_of_all_rows_under_one_key(spark):
    """Stretches and blocks of a hot key are bounded, and patterns across their ends are found."""
    n, size = 20_000, 500
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("p"), F.col("id") % 100)).alias("k"), (F.pow(F.col("id") / 100, 2) * 100).cast("long").alias("ts"), "id",
                               (F.xxhash64("id") % 5 == 0).cast("int").alias("reInit"), F.pmod(F.xxhash64("id"), F.lit(7)).cast("int").alias("uas"), (F.xxhash64("id") % 11 != 0).alias("ifOperStatus"))
    cuts = segments.hot_keys(df, ["k"], "ts", size)
    assert [r.k for r in cuts.collect()] == [None]
    sizes = [r["count"] for r in segments.segmented(df, cuts, ["k"], "ts").where("k is null").groupBy("__segment").count().collect()]
    assert sum(sizes) == n // 2 and max(sizes) <= 2 * size and len(sizes) >= n // 2 // size
    blocks = segments.overlapping_blocks(df, cuts, ["k"], ["ts", "id"], size, 7)
    assert blocks.groupBy("__block").count().agg(F.max("count")).first()[0] == size + 7 and blocks.where("__own").count() == n // 2
    run = lambda rows: {r.id for r in health.health_pattern(df, ["k"], ["ts", "id"], 8, 3, 3, 10, rows).collect()}
    assert run(size) == run(n) and len(run(n)) > 100
    toggles = df.where("id % 50 in (0, 1, 20)").select("k", "ts", (F.col("id") % 20 == 0).alias("flag"), "id").dropDuplicates(["k", "ts"]).drop("id")
    once = df.dropDuplicates(["k", "ts"])
    for seeded in (False, True):
        loop = lambda rows: {(r.k, r.ts) for r in health.monitor_loop(once, toggles, ["k"], "ts", 4, 2, 3, 10, seeded, rows).collect()}
        assert loop(3) == loop(n) and loop(n)
    with pytest.raises(ValueError):
        segments.overlapping_blocks(df, cuts, ["k"], ["ts"], 5, 6)


def test_median_delay_is_exact(spark):
    """A window of more rows than a sketch keeps; unknown delays count as rows only."""
    n = 40_000
    rows = spark.range(n, numPartitions=16).select(F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("d"), F.lit(T0).alias("measured"))
    rows = rows.select("measured", (F.col("measured") + F.make_interval(secs=F.col("d"))).alias("arrived"))
    rows = rows.unionByName(rows.limit(7).withColumn("arrived", F.lit(None).cast("timestamp")))
    want = sorted((r.arrived - r.measured).total_seconds() for r in rows.where("arrived is not null").collect())
    for share in (0.0, 0.5, 0.9, 1.0):
        got = windows.arrival_delay(rows, "arrived", "measured", "7 days", share).collect()[0]
        assert (got.n, got.longest_delay, got.percentile_delay) == (n + 7, want[-1], want[max(math.ceil(n * share), 1) - 1])
        assert got.average_delay == sum(want) / n


def test_percentiles_equal_their_sql_to_the_bit(spark):
    """A rate that comes back from its percentile is cut off to a whole number, so that the last bit counts."""
    data = spark.range(600).select(F.lit(20).cast("short").alias("atten"), (5000 + F.col("id") * 37).cast("int").alias("rate"), F.transform(F.sequence(F.lit(0), F.lit(33)), lambda i: (9000 + 577 * i).cast("float")).alias("ds"))
    got = data.select("rate", percentiles.rate_to_percentile(F.col("atten"), F.col("rate"), F.col("ds"), "ds").alias("p"))
    sql = format_queries._percentile_sql("rate", "ds", str(percentiles.PEAK["ds"][20]), 175000)
    want = duckdb.sql(f"select rate, {sql} from (select cast(5000 + i * 37 as integer) as rate, list_transform(range(34), lambda k: cast(9000 + 577 * k as float)) as ds from range(600) r(i))").fetchall()
    assert {r.rate: r.p for r in got.collect()} == dict(want)
