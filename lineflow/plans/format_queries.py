"""Queries of the decoders, projections, sources and sinks, with the SQL that they equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineflow.functions import inventory, percentiles, ports
from lineflow.operators import decode, enrich, node_files, tables, windows
from lineflow.plans import line_job
from lineflow.plans.line_queries import query, table
from lineflow.plans.node_fixtures import NODE_LINES, node_files_of
from lineflow.sources import archives, files, text
from lineflow.sources.scratch import scratch_path

# names ----------------------------------------------------------------------------

PORTS = """ports as (
  select p_partkey, case p_partkey % 5
    when 0 then 'R1.S' || (p_size % 10) || '.LT' || (p_partkey % 100) || '.P7'
    when 1 then 'R1.S1.LT3.P' || (p_size % 100) || '.ITF' || p_size
    when 2 then '/type=x/rackNr=1/subrackNr=1/slotNr=' || p_size || '/portNr=' || p_partkey || '/y'
    when 3 then 'weird' || p_partkey
    else p_name || ' ' || p_size || '-1-3-' || p_partkey || '-9' end as raw
  from part
)"""


def _choose(key: str, values: list[Column]) -> Column:
    """The (key mod n)-th of n columns."""
    chosen = F.when(F.col(key) % len(values) == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        chosen = chosen.when(F.col(key) % len(values) == i, v)
    return chosen


def _ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    raw = _choose("p_partkey", [
        F.concat(F.lit("R1.S"), size % 10, F.lit(".LT"), key % 100, F.lit(".P7")),
        F.concat(F.lit("R1.S1.LT3.P"), size % 100, F.lit(".ITF"), size),
        F.concat(F.lit("/type=x/rackNr=1/subrackNr=1/slotNr="), size, F.lit("/portNr="), key, F.lit("/y")),
        F.concat(F.lit("weird"), key),
        F.concat(F.col("p_name"), F.lit(" "), size, F.lit("-1-3-"), key, F.lit("-9")),
    ])
    return table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))


@query(f"""with {PORTS}
select p_partkey, case p_partkey % 5 when 0 then raw when 1 then split_part(raw, '.ITF', 1)
  when 2 then case when p_size < 100 then 'R1.S1.LT' || (p_size - 2) || '.P' || substr(cast(p_partkey as varchar), 1, 2) end end as port
from ports join part using (p_partkey)""")
def port_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ports(spark, sf_dir).select("p_partkey", ports.normalise_port(F.col("raw")).alias("port"))


@query(f"""with {PORTS}
select p_partkey, regexp_replace(raw, '([0-9]+)-([0-9]+)-([0-9]+)-([0-9]+)', 'R\\1.S\\2.LT\\3.P\\4') as port from ports""")
def port_dash_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ports(spark, sf_dir).select("p_partkey", ports.rewrite_dashes(F.col("raw")).alias("port"))


FILES = """files as (
  select event_id, ts, case when event_id % 9 = 0 then '/data/' || strftime(ts, '%Y%m%d/%H%M') || '/other' || event_id || '.csv'
    when event_id % 9 = 1 then '/data/' || strftime(ts, '%Y%m%d/%H%M') || '/.N' || user_id || '_Ix_' || strftime(ts, '%Y-%m-%d-%H-%M') || '.tar.gz'
    else '/data/' || strftime(ts, '%Y%m%d/%H%M') || '/N' || user_id || case when event_type = 'click' then '_Inst_' else '_hist_' end || strftime(ts, '%Y-%m-%d-%H-%M') || '.tar.gz' end as path
  from events
)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, stamp = F.concat(F.lit("/data/"), F.date_format("ts", "yyyyMMdd/HHmm")), F.date_format("ts", "yyyy-MM-dd-HH-mm")
    named = F.concat(folder, F.lit("/N"), "user_id", F.when(F.col("event_type") == "click", "_Inst_").otherwise("_hist_"), stamp, F.lit(".tar.gz"))
    hidden = F.concat(folder, F.lit("/.N"), "user_id", F.lit("_Ix_"), stamp, F.lit(".tar.gz"))
    other = F.concat(folder, F.lit("/other"), "event_id", F.lit(".csv"))
    path = F.when(F.col("event_id") % 9 == 0, other).when(F.col("event_id") % 9 == 1, hidden).otherwise(named)
    return table(spark, sf_dir, "events").select("event_id", "ts", path.alias("path"))


@query(f"""with {FILES}
select event_id, case when event_id % 9 > 1 then regexp_extract(path, '/(N[0-9]+)_', 1) end as name,
  case when event_id % 9 > 1 then case when path like '%_Inst_%' then 2 else 1 end end as dslam_type,
  case when event_id % 9 > 1 then date_trunc('minute', ts) end as file_ts
from files""")
def filename_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _files(spark, sf_dir).select("event_id", ports.parse_file_name(F.col("path")).alias("x"))
    return rows.select("event_id", "x.name", "x.dslam_type", F.col("x.ts").cast("timestamp_ntz").alias("file_ts"))


@query(f"""with {FILES}
select event_id from files
where event_id % 9 <> 1 and date_trunc('day', ts) >= timestamp '2024-01-20 00:00:00' - interval '6 days'
  and (event_id % 9 = 0 or date_trunc('minute', ts) >= timestamp '2024-01-20 00:00:00' - interval '5 days')""")
def path_age_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return _files(spark, sf_dir).where(ports.within_age(F.col("path"), now, 5 * 86400)).select("event_id")


@query("""
select event_id from events
where event_id % 10 = 0 or cast(ts as date) >= date '2024-01-20' - 3
""")
def dt_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    dt = F.when(F.col("event_id") % 10 == 0, "unknown").otherwise(F.date_format("ts", "yyyyMMdd"))
    rows = table(spark, sf_dir, "events").withColumn("dt", dt)
    return files.within_lookback(rows, "dt", F.to_date(F.lit("2024-01-20")), 3).select("event_id")


# text lines -------------------------------------------------------------------------


@query("""
with c as (
  select c_custkey, 'AVC' || lpad(cast(c_custkey as varchar), case when c_custkey % 7 = 0 then 11 else 12 end, '0') as avc,
    case c_custkey % 5 when 0 then '' when 1 then ',on' when 2 then ' off' when 3 then ',false' else ';on' end as tail from customer
)
select avc, c_custkey % 5 not in (2, 3) as flag from c where c_custkey % 7 <> 0 and c_custkey % 5 <> 4
""")
def watch_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    tail = _choose("c_custkey", [F.lit(x) for x in ("", ",on", " off", ",false", ";on")])
    avc = F.concat(F.lit("AVC"), F.when(key % 7 == 0, F.lpad(key.cast("string"), 11, "0")).otherwise(F.lpad(key.cast("string"), 12, "0")))
    return text.parse_watch_commands(table(spark, sf_dir, "customer").select(F.concat(avc, tail).alias("value")))


@query("""
select c_custkey as ts, 'N' || c_nationkey as dslam, 'P' || c_custkey as port, c_mktsegment as avc, cast(c_custkey as varchar) as cpi
from customer where c_custkey % 6 <> 0
""")
def csv_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("c_custkey") % 6 == 0, "bad").otherwise(F.col("c_custkey").cast("string"))
    line = F.concat_ws(",", F.lit("x"), F.concat(F.lit("N"), "c_nationkey"), F.concat(F.lit("P"), "c_custkey"), "c_mktsegment", number)
    return text.parse_inventory_csv(table(spark, sf_dir, "customer").select(line.alias("value")))


@query("""
select 'FTTN,' || (p_partkey % 4) || ',' || p_size as key, cast(p_size as float) + cast(0.5 as float) as first_value, 34 as n
from part where p_partkey % 5 > 1
""")
def json_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.transform(F.sequence(F.lit(0), F.lit(33)), lambda i: F.col("p_size") + i + 0.5)
    good = F.to_json(F.struct(F.concat(F.lit("FTTN,"), F.col("p_partkey") % 4).alias("Tier"), F.col("p_size").alias("Attenuation"), values.alias("Percentiles")))
    line = F.when(F.col("p_partkey") % 5 == 0, "[1, 2]").when(F.col("p_partkey") % 5 == 1, '{"Tier": "x"}').otherwise(good)
    found = text.parse_percentiles(table(spark, sf_dir, "part").select(line.alias("value")))
    return found.select("key", F.get("pctls", F.lit(0)).alias("first_value"), F.size("pctls").alias("n"))


# inventory --------------------------------------------------------------------------


@query("""
select o_orderdate as ts, 'N' || (o_custkey % 50) as dslam, case when o_orderkey % 5 = 1 then '' else 'R1.S1.LT1.P' || o_custkey end as port, 'UNI' || o_custkey as uni_prid
from orders where o_orderkey % 4 <> 0 and o_orderkey % 5 <> 0
""")
def ams_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    dslam = F.concat(F.lit("N"), F.col("o_custkey") % 50)
    name = F.when(key % 5 == 0, F.lit(":x")).when(key % 5 == 1, dslam).otherwise(F.concat(dslam, F.lit(":R1.S1.LT1.P"), "o_custkey"))
    customer = F.concat(F.when(key % 4 == 0, "BIZ").otherwise("UNI"), "o_custkey")
    return inventory.decode_ams(table(spark, sf_dir, "orders").select(name.alias("object_name"), customer.alias("customer_id"), F.col("o_orderdate").alias("metrics_date")))


@query("""
select o_orderdate as ts, 'UNI' || o_custkey as uni_prid, 'AVC' || o_orderkey as avc, 'NTD' || o_custkey as cpi,
  case o_orderkey % 3 when 0 then 'FTTN' else 'FTTB' end as tech_type,
  case o_orderkey % 4 when 0 then '50' else '100' end as tc4_ds, case o_orderkey % 4 when 0 then '10' else '40' end as tc4_us
from orders where o_orderkey % 3 < 2 and o_orderkey % 4 < 2
""")
def fls_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    tech = _choose("o_orderkey", [F.lit(x) for x in ("Fibre To The Node", "Fibre To The Building", "Fibre To The Curb")])
    profile = _choose("o_orderkey", [F.lit(x) for x in ("D25-50_U5-10_Mbps_TC4_P", "x_D100_U40_Mbps_TC4", "D100_U40_TC4", "")])
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("AVC"), "o_orderkey").alias("avc_id"), F.concat(F.lit("NTD"), "o_custkey").alias("ntd_id"), F.concat(F.lit("UNI"), "o_custkey").alias("uni_prid"),
        tech.alias("access_service_tech_type"), F.col("o_orderdate").alias("metrics_date"), profile.alias("avc_bandwidth_profile"),
    )
    return inventory.decode_fls(rows)


@query("""
select o_orderdate as ts, 'N' || (o_custkey % 50) as dslam, 'R1.S1.LT2.P' || o_custkey as port,
  cast(case when o_orderkey % 5 in (1, 2) then -1 else trunc(o_totalprice / 1000) end as smallint) as noise_margin_ds,
  cast(case when o_orderkey % 5 in (1, 2) then -1 else 7 end as smallint) as noise_margin_us,
  cast(case when o_orderkey % 2 = 0 then 0 else 1 end as tinyint) as dpbo_profile
from orders where o_orderkey % 7 <> 0 and o_orderkey % 5 <> 3
""")
def nac_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    margin = F.when(key % 5 == 1, "").when(key % 5 == 2, F.lit(None)).when(key % 5 == 3, "none").otherwise((F.floor(F.col("o_totalprice") / 1000).cast("string")))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("metrics_timestamp"), F.concat(F.lit("N"), F.col("o_custkey") % 50).alias("dslam"), F.concat(F.lit("1-1-2-"), "o_custkey").alias("port"),
        F.lit("7.9").alias("max_additional_noise_margin_us"), margin.alias("max_additional_noise_margin_ds"), F.when(key % 2 == 0, "ADP-VDSL_00dB").alias("dpbo_profile_name"),
        F.when(key % 7 == 0, "0.0").when(key % 7 == 1, F.lit(None)).otherwise("100.5").alias("rtx_attainable_net_data_rate_ds"),
    )
    return inventory.decode_nac(rows)


@query("""
select p_partkey, 'N' || p_size as dslam, 'R1.S1.LT3.P' || p_partkey as port,
  cast(case when v > 70 then 70 when v < 0 then 0 else floor(cast(v as double) + 0.5) end as smallint) as atten365
from (select *, cast(p_size * 1.7 - 5 as float) as v from part)
""")
def atten_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.current_timestamp().alias("metrics_timestamp"), F.concat(F.lit("N"), "p_size", F.lit(":1-1-3-"), "p_partkey").alias("id"), (F.col("p_size") * 1.7 - 5).cast("float").alias("value"))
    found = inventory.decode_feature(rows)
    return found.select(F.regexp_extract("port", r"P(\d+)$", 1).cast("long").alias("p_partkey"), "dslam", "port", "atten365")


# the corrected rate -------------------------------------------------------------------

SHARES = [round(0.005 + 0.03 * i, 3) for i in range(34)]
CONTOURS_SQL = """
tables_ as (
  select l_suppkey % 20 as g, quantile_cont(l_extendedprice, [SHARES]) as q from lineitem group by 1
),
contours as (
  select g, list_transform(q, lambda x: cast(round(x) as float)) as ds, list_transform(q, lambda x: cast(round(x / 2) as float)) as us from tables_
)""".replace("SHARES", ", ".join(map(str, SHARES)))
RATES_SQL = """
lines_ as (
  select p_partkey, case p_partkey % 3 when 0 then 'FTTN' when 1 then 'FTTB' else 'NotSupported' end as tech, p_partkey % 20 as g,
    ['100', '50', '25', '12'][p_partkey % 4 + 1] as tier_ds, ['40', '20', '10', '5'][p_partkey % 4 + 1] as tier_us, p_size as margin, p_partkey % 2 as dpbo,
    cast(trunc(p_partkey * 97 % 170000) as integer) as rate_ds, cast(trunc(p_partkey * 31 % 60000) as integer) as rate_us
  from part
)"""
LINES_SQL = f"{CONTOURS_SQL}, {RATES_SQL}"


def _percentile_sql(rate: str, table_: str, peak: str, top: int) -> str:
    """The percentile of a rate, as SQL over a list of contours."""
    single = lambda a, b: f"cast(cast(cast({a} as float) as double) / nullif(cast(cast({b} as float) as double), 0) as float)"
    tilt = f"[{', '.join(map(str, percentiles.TILT))}]"
    p = f"(1 + len(list_filter({table_}[2:33], lambda x: x <= {rate})))"
    low, high = f"{table_}[1]", f"{table_}[34]"
    return f"""case when {rate} >= {top} then 0.0 when {rate} <= 0 then -200.0
      when {rate} < {low} and ({low} <= 0 or {rate} <= {low} / 2.0) then 100.0
      when {rate} < {low} then 100.0 - 0.5 * greatest(0, least(1, pow(({rate} - cast({low} as double) / 2) / (cast({low} as double) / 2), {percentiles.TILT[0]})))
      when {rate} > {high} and ({rate} >= {peak} or {high} >= {peak}) then 0.0
      when {rate} > {high} then 0.5 * greatest(0, least(1, pow({single(f'{rate} - {high}', f'{peak} - {high}')}, {percentiles.TILT[-1]})))
      when {table_}[{p}] = {table_}[{p} + 1] then 100.0 - 0.5 - ({p} - 0.5) * 3
      else 100.0 - 0.5 - (pow({single(f'{rate} - {table_}[{p}]', f'{table_}[{p} + 1] - {table_}[{p}]')}, {tilt}[{p}]) + {p} - 1) * 3 end"""


def _rate_sql(table_: str, rate: str, percentile: str, tier: str, limit: int) -> str:
    """The rate at a percentile, as SQL."""
    tiers = " ".join(f"when '{k}' then {v}" for k, v in percentiles.TIER_RATE.items())
    power = lambda x, t: f"pow(case when {x} > 1 then 1.0 when {x} <= 0 then 0.000001 else {x} end, 1.0 / {t})"
    tilt = f"[{', '.join(map(str, percentiles.TILT))}]"
    steps = f"((99.5 - {percentile}) / 3.0)"
    p = f"(cast(trunc({steps}) as integer) + 1)"
    low, high = f"cast({table_}[1] as double)", f"{table_}[34]"
    upper, lower = f"{table_}[{p} + 1]", f"{table_}[{p}]"
    found = f"""cast(trunc(case when {percentile} >= 99.5 then {low} / 2 + {power(f'((100.0 - {percentile}) / 0.5)', percentiles.TILT[0])} * {low} / 2
      when {percentile} <= 0.5 then cast({high} as double) + case when {rate} > {limit} then 0.3333 else 1.0 end * {power(f'(1.0 - {percentile} / 0.5)', percentiles.TILT[-1])} * cast(cast({limit} as float) - {high} as double)
      else cast({lower} as double) + {power(f'({steps} - {p} + 1)', f'{tilt}[{p}]')} * cast({upper} - {lower} as double) end) as integer)"""
    return f"""(select case when {percentile} < 0 or top is null or {rate} < top or v is null or v < top or v < {rate} then -1 else v end
      from (select case {tier} {tiers} end as top, case when {percentile} >= 0 then {found} end as v))"""


def _contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(g, ds array<float>, us array<float>)"""
    rows = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("g")).agg(F.percentile("l_extendedprice", F.array(*map(F.lit, SHARES))).alias("q"))
    return rows.select("g", F.transform("q", lambda x: F.round(x).cast("float")).alias("ds"), F.transform("q", lambda x: F.round(x / 2).cast("float")).alias("us"))


def _rate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    chosen = lambda values: _choose("p_partkey", [F.lit(v) for v in values])
    return table(spark, sf_dir, "part").select(
        "p_partkey", chosen(["FTTN", "FTTB", "NotSupported"]).alias("tech_type"), (key % 20).cast("short").alias("atten365"),
        chosen(["100", "50", "25", "12"]).alias("tc4_ds"), chosen(["40", "20", "10", "5"]).alias("tc4_us"),
        F.col("p_size").cast("short").alias("noise_margin_ds"), F.col("p_size").cast("short").alias("noise_margin_us"), (key % 2).cast("byte").alias("dpbo_profile"),
        (key * 97 % 170000).cast("int").alias("attndr_ds"), (key * 31 % 60000).cast("int").alias("attndr_us"),
    )


@query(f"""with {RATES_SQL}
select p_partkey,
  case when tech = 'NotSupported' then '' else tech || ',' || tier_ds || ',' || g end as current_ds, case when tech = 'NotSupported' then '' else tech || ',' || tier_us || ',' || g end as current_us,
  case tech when 'FTTN' then 'FTTN,100,' || g when 'FTTB' then 'FTTB,50,' || g else '' end as expected_ds, case tech when 'FTTN' then 'FTTN,40,' || g when 'FTTB' then 'FTTB,20,' || g else '' end as expected_us
from lines_""")
def percentile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = percentiles.percentile_keys(F.col("tech_type"), F.col("atten365"), F.col("tc4_ds"), F.col("tc4_us"))
    return _rate_lines(spark, sf_dir).select("p_partkey", keys.alias("k")).select("p_partkey", "k.*")


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, pctls): downstream contours for the downstream tiers, upstream ones for the others."""
    sides = {"ds": ["100", "50", "25", "12"], "us": ["40", "20", "10", "5"]}
    tier = F.explode(F.array(*(F.struct(F.lit(d).alias("side"), F.lit(t).alias("tier")) for d, ts in sides.items() for t in ts)))
    rows = _contours(spark, sf_dir).select("g", "ds", "us", tier.alias("t"), F.explode(F.array(F.lit("FTTN"), F.lit("FTTB"))).alias("tech"))
    return rows.select(F.concat_ws(",", "tech", "t.tier", "g").alias("key"), F.when(F.col("t.side") == "ds", F.col("ds")).otherwise(F.col("us")).alias("pctls"))


@query(f"""with {LINES_SQL}
select p_partkey, case when tech <> 'NotSupported' then ds[1] end as first_ds, case when tech <> 'NotSupported' then us[34] end as last_us
from lines_ left join contours using (g)""")
def percentile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = percentiles.percentile_keys(F.col("tech_type"), F.col("atten365"), F.col("tc4_ds"), F.col("tc4_us"))
    rows = _rate_lines(spark, sf_dir).withColumn("k", keys)
    found = enrich.lookup_percentiles(rows, _tables(spark, sf_dir), {"ds": F.col("k.current_ds"), "us": F.col("k.current_us")})
    return found.select("p_partkey", F.get("ds", F.lit(0)).alias("first_ds"), F.get("us", F.lit(33)).alias("last_us"))


_PEAK_SQL = {d: f"[{', '.join(map(str, v))}][g + 1]" for d, v in percentiles.PEAK.items()}


@query(f"""with {LINES_SQL}
select p_partkey, round({_percentile_sql("rate_ds", "ds", _PEAK_SQL["ds"], 175000)}, 6) as percentile_ds, round({_percentile_sql("rate_us", "us", _PEAK_SQL["us"], 70000)}, 6) as percentile_us
from lines_ join contours using (g)""")
def rate_to_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rate_lines(spark, sf_dir).join(_contours(spark, sf_dir), F.col("atten365") == F.col("g"))
    found = lambda d: F.round(percentiles.rate_to_percentile(F.col("atten365"), F.col(f"attndr_{d}"), F.col(d), d), 6).alias(f"percentile_{d}")
    return rows.select("p_partkey", found("ds"), found("us"))


@query(f"""with {LINES_SQL}, asked as (select *, p_partkey % 1010 / 10.0::double - 0.5 as pct, rate_ds // 2 as half_ds from lines_)
select p_partkey, {_rate_sql("ds", "half_ds", "pct", "tier_ds", 130000)} as rate_ds, {_rate_sql("us", "rate_us", "pct", "tier_us", 45000)} as rate_us
from asked join contours using (g)""")
def percentile_to_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rate_lines(spark, sf_dir).join(_contours(spark, sf_dir), F.col("atten365") == F.col("g"))
    rows = rows.withColumns({"pct": F.col("p_partkey") % 1010 / F.lit(10.0) - 0.5, "half": F.floor(F.col("attndr_ds") / 2).cast("int")})
    found = lambda d, rate: percentiles.percentile_to_rate(F.col(d), F.col(rate), F.col("pct"), F.col(f"tc4_{d}"), d).alias(f"rate_{d}")
    return rows.select("p_partkey", found("ds", "half"), found("us", "attndr_us"))


@query(f"""with {LINES_SQL},
pct as (select *, {_percentile_sql("rate_ds", "ds", _PEAK_SQL["ds"], 175000)} as p_ds, {_percentile_sql("rate_us", "us", _PEAK_SQL["us"], 70000)} as p_us from lines_ left join contours using (g)),
found as (select *, {_rate_sql("ds", "rate_ds", "p_ds", "tier_ds", 130000)} as f_ds, {_rate_sql("us", "rate_us", "p_us", "tier_us", 45000)} as f_us from pct)
select p_partkey,
  cast(case when tech = 'NotSupported' or (tech = 'FTTN' and tier_ds = '100' and margin >= 30) or (tech = 'FTTB' and tier_ds in ('100', '50')) or f_ds < rate_ds then -1
    when dpbo = 0 then (f_ds - rate_ds) // 2 + rate_ds else f_ds end as integer) as corrected_ds,
  cast(case when tech = 'NotSupported' or (tech = 'FTTN' and tier_us = '40' and margin >= 30) or (tech = 'FTTB' and tier_us in ('40', '20')) or f_us < rate_us then -1 else f_us end as integer) as corrected_us
from found""")
def corrected_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.correct_rates(_rate_lines(spark, sf_dir), _tables(spark, sf_dir)).select("p_partkey", "corrected_ds", "corrected_us")


# CSV rows -----------------------------------------------------------------------------

_INSTANT = [("admin", "admin", "up"), ("oper", "oper", "up"), ("rate", "rate", "int"), ("atten", "atten", "tenths"), ("mac", "mac", "string")]
_HISTORICAL = [("ses", "ses", "short"), ("uas", "uas", "long")]


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    fields = {
        "admin": F.when(key % 13 == 0, "").when(F.col("l_returnflag") == "N", "up").otherwise("down"), "oper": F.when(F.col("l_linestatus") == "O", "up").otherwise("down"),
        "rate": F.when(F.col("l_partkey") % 50 == 0, "x").otherwise(F.col("l_partkey").cast("string")), "atten": F.when(F.col("l_suppkey") % 5 == 0, "bad").otherwise(F.col("l_suppkey").cast("string")),
        "mac": F.lit("m"), "ses": F.when(key % 7 == 0, "").otherwise(F.col("l_linenumber").cast("string")), "uas": F.col("l_suppkey").cast("string"),
    }
    names = list(fields)
    line = lambda order: F.concat_ws(",", *(fields[n] for n in order))
    even, columns = key % 2 == 0, lambda order: F.lit(",".join(order))
    short = [n for n in names if n != "oper"]
    header = F.when(key % 17 == 3, columns(short)).when(even, columns(names)).otherwise(columns(names[::-1]))
    csv = F.when(key % 17 == 3, line(short)).when(even, line(names)).otherwise(line(names[::-1]))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", header.alias("columns"), csv.alias("csv"))


@query("""
select l_orderkey, l_linenumber, l_partkey, off is false and l_returnflag = 'N' as admin, off is false and l_linestatus = 'O' as oper,
  case when off then -1 else cast(l_partkey as integer) end as rate, case when not off and l_suppkey % 5 <> 0 then cast(l_suppkey as smallint) end as atten, case when not off then 'm' end as mac,
  case when l_orderkey % 7 <> 0 then cast(l_linenumber as smallint) end as ses, case when l_orderkey % 7 <> 0 then l_suppkey end as uas
from (select *, l_orderkey % 13 = 0 as off from lineitem) where l_orderkey % 17 <> 3 and (off or l_partkey % 50 <> 0)
""")
def csv_header_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode.decode_csv(_csv(spark, sf_dir), "columns", "csv", _INSTANT, _HISTORICAL)
    return good.select("l_orderkey", "l_linenumber", "l_partkey", "inst.*", "hist.*")


@query("""
select l_linenumber, count(*) as records, count(*) filter (l_orderkey % 17 = 3 or (l_orderkey % 13 <> 0 and l_partkey % 50 = 0)) as bad_records from lineitem group by 1
""")
def bad_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.decoded(_csv(spark, sf_dir), "columns", "csv", _INSTANT, _HISTORICAL)
    return windows.quality_counts(rows, F.col("error").isNotNull(), ["l_linenumber"])


# typed records ------------------------------------------------------------------------


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as typed line records; every third without history, every fourth without enrichment."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    inst = {"ifAdminStatus": F.col("l_returnflag") != "R", "ifOperStatus": F.col("l_linestatus") == "O", "actualDs": F.col("l_partkey").cast("int"), "actualUs": F.col("l_suppkey").cast("int"), "attndrDs": (F.col("l_partkey") * 2).cast("int"), "attndrUs": (F.col("l_suppkey") * 2).cast("int"), "attenuationDs": F.when(line != 2, line.cast("short")), "userMacAddress": F.col("l_returnflag")}
    hist = {f: (line * (i + 1)).cast(k) for i, (_, f, k) in enumerate(decode.HISTORICAL_FIELDS)}
    enriched = {"ts": key, "avc": F.when(key % 8 != 1, F.concat(F.lit("AVC"), "l_suppkey")), "cpi": F.lit("c"), "corrAttndrDs": F.lit(-1), "corrAttndrUs": line}
    struct = lambda fields: F.struct(*(v.alias(k) for k, v in fields.items()))
    return table(spark, sf_dir, "lineitem").select((key * 1000 + line).alias("ts"), F.concat(F.lit("N"), "l_suppkey").alias("dslam"), F.col("l_partkey").cast("string").alias("port"), struct(inst).alias("inst"), F.when(key % 3 != 0, struct(hist)).alias("hist"), F.when(key % 4 != 0, struct(enriched)).alias("enrich"))


TYPED = """typed as (
  select l_orderkey * 1000 + l_linenumber as ts, 'N' || l_suppkey as dslam, cast(l_partkey as varchar) as port, l_returnflag <> 'R' as "ifAdminStatus", l_linestatus = 'O' as "ifOperStatus",
    cast(l_partkey as integer) as "actualDs", cast(l_suppkey as integer) as "actualUs", cast(l_partkey * 2 as integer) as "attndrDs", cast(l_suppkey * 2 as integer) as "attndrUs",
    case when l_linenumber <> 2 then cast(cast(l_linenumber as float) / 10 as float) end as "attenuationDs", l_returnflag as "userMacAddress",
    case when l_orderkey % 3 <> 0 then l_linenumber end as h, l_orderkey % 4 <> 0 as e, l_orderkey, l_suppkey, l_linenumber
  from lineitem
)"""


@query(f"with {TYPED} select ts, dslam, port from typed where \"ifAdminStatus\"")
def active_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.active(_typed(spark, sf_dir)).select("ts", "dslam", "port")


@query(f"""with {TYPED}
select ts, dslam, port, case when not e then 'UNKNOWN' when l_orderkey % 8 <> 1 then 'AVC' || l_suppkey end as avc, cast(h * 3 as smallint) as lpr, cast(h * 5 as smallint) as "reInit", cast(h * 2 as smallint) as uas,
  "attndrDs" as "attndrDS", "attndrUs" as "attndrUS", "ifOperStatus" from typed""")
def compact_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.compact(_typed(spark, sf_dir))


@query(f"""with {TYPED}
select ts, dslam, port, "ifAdminStatus", "ifOperStatus", "actualDs", "actualUs", "attndrDs", "attndrUs", "attenuationDs", "userMacAddress",
  h as ses, h * 2 as uas, h * 3 as "lprFe", h * 4 as "sesFe", h * 5 as "reInit", cast(h * 6 as bigint) as "unCorrDtuDs", cast(h * 7 as bigint) as "unCorrDtuUs", cast(h * 8 as bigint) as "reTransUs", cast(h * 9 as bigint) as "reTransDs",
  case when e then l_orderkey end as "tsEnrich", case when e and l_orderkey % 8 <> 1 then 'AVC' || l_suppkey end as avc, case when e then 'c' end as cpi, case when e then -1 end as "correctedAttndrDs", case when e then l_linenumber end as "correctedAttndrUs"
from typed""")
def flat_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by date and read back."""
    path = scratch_path(spark, "flat")
    dated = decode.flat(_typed(spark, sf_dir)).withColumn("day", F.timestamp_seconds(F.col("ts") % 10 * 86400))
    tables.write_by_date(dated, path, "day")
    return spark.read.parquet(path).drop("dt", "day")


@query(f"""with {TYPED}
select dslam || '_' || port || '_' || ts as id,
  '{{"dslam":"' || dslam || '","port":"' || port || '","metrics_timestamp":' || ts || ',"ifAdminStatus":' || "ifAdminStatus" || ',"ifOperStatus":' || "ifOperStatus"
  || ',"xdslFarEndChannelActualNetDataRateDownstream":' || "actualDs" || ',"xdslChannelActualNetDataRateUpstream":' || "actualUs"
  || ',"xdslFarEndChannelAttainableNetDataRateDownstream":' || "attndrDs" || ',"xdslChannelAttainableNetDataRateUpstream":' || "attndrUs"
  || case when "attenuationDs" is not null then ',"xdslFarEndLineLoopAttenuationDownstream":' || "attenuationDs" else '' end || ',"macaddress":"' || "userMacAddress" || '"'
  || case when h is not null then ',"xdslLinePreviousIntervalSESCounter":' || h || ',"xdslLinePreviousIntervalUASCounter":' || h * 2
     || ',"xdslFarEndLinePreviousIntervalLPRCounter":' || h * 3 || ',"xdslFarEndLinePreviousIntervalSESCounter":' || h * 4 || ',"xdslLinePreviousIntervalReInitCounter":' || h * 5
     || ',"xdslFarEndChannelPreviousIntervalUnCorrDtuCounterDS":' || h * 6 || ',"xdslChannelPreviousIntervalUnCorrDtuCounterUS":' || h * 7
     || ',"xdslFarEndChannelPreviousIntervalRetransmDtuCounterUS":' || h * 8 || ',"xdslChannelPreviousIntervalRetransmDtuCounterDS":' || h * 9 else '' end
  || case when e then ',"enrich_timestamp":' || l_orderkey || case when l_orderkey % 8 <> 1 then ',"avcid":"AVC' || l_suppkey || '"' else '' end
     || ',"cpid":"c","correctedAttndrDs":-1,"correctedAttndrUs":' || l_linenumber else '' end || '}}' as doc
from typed""")
def document_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.document(_typed(spark, sf_dir))


@query("""select cast(user_id as varchar) as key, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as value from events""")
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.stream_records(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "user_id")


@query("select o_orderkey, o_totalprice from orders where o_totalprice > 200000")
def parquet_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])
    return files.read_typed(spark, f"{sf_dir}/orders.parquet", schema).where("o_totalprice > 200000")


@query("""
select event_id as id, ts, event_type as kind, null as price from events
union all select o_orderkey, o_orderdate, null, o_totalprice from orders
""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts", F.col("event_type").alias("kind"))
    return decode.union_sources(events, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("price")))


# files ----------------------------------------------------------------------------------


def _mark(text_: str) -> Column:
    return F.lit(text_).cast("timestamp_ntz")


@query("""
with listed as (select 'f' || (event_id % 5000) as path, ts as mtime from events),
seen as (select path, max(mtime) as seen from listed where mtime <= timestamp '2024-01-20' and hash_(path) group by 1)
select path, mtime from listed left join seen using (path)
where mtime > timestamp '2024-01-10' and not (mtime <= timestamp '2024-01-20' and coalesce(mtime <= seen, false))
""".replace("hash_(path)", "cast(substr(path, 2) as integer) % 3 <> 0"))
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "events").select(F.concat(F.lit("f"), F.col("event_id") % 5000).alias("path"), F.col("ts").alias("mtime"))
    processed = listed.where((F.col("mtime") <= _mark("2024-01-20")) & (F.substring("path", 2, 9).cast("int") % 3 != 0))
    return files.select_new_files(listed, processed, _mark("2024-01-10"), _mark("2024-01-20"))


@query("select event_id as path, ts as mtime from events where ts > timestamp '2024-01-10' and ts <= timestamp '2024-01-20' - interval '1 hour'")
def new_files_deferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "events").select(F.col("event_id").alias("path"), F.col("ts").alias("mtime"))
    return files.select_new_files_deferred(listed, _mark("2024-01-10"), _mark("2024-01-20"), F.expr("interval 1 hour"))


@query(f"""with {FILES},
dirs as (select event_id, path, date_trunc('minute', ts) as dir_ts, greatest(ceil((epoch(date_trunc('minute', ts)) - epoch(timestamp '2024-01-10 00:00:00')) / 900), 0) as chunk from files
  where date_trunc('minute', ts) >= timestamp '2024-01-10 00:00:00' - interval '2700 seconds')
select event_id, dir_ts from dirs where chunk = 0 or chunk = (select min(chunk) from dirs where chunk > 0)""")
def dir_chunk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.scan_dir_chunk(_files(spark, sf_dir), F.lit("2024-01-10 00:00:00").cast("timestamp"))
    return found.select("event_id", F.col("dir_ts").cast("timestamp_ntz").alias("dir_ts"))


# node files -----------------------------------------------------------------------------

NODES = """raw_ as (
  select c_custkey as c, c_custkey // 50 as node, c_custkey % 50 as k, 'N' || (c_custkey // 50) as name, 'R1.S1.LT' || (c_custkey % 50 // 10) || '.P' || (c_custkey % 50) as line,
    timestamp '2024-01-01 00:00:00' + to_minutes(cast(c_custkey // 50 % 90 * 15 as integer)) as ts
  from customer
),
nodes as (
  select *, case when k % 20 = 19 then 'weird' || k when k % 4 = 1 then line || '.ITF1' when k % 4 = 2 then '/x/rackNr=1/subrackNr=1/slotNr=' || (k // 10 + 2) || '/portNr=' || k else line end as port,
    concat_ws(',', case when k % 13 = 0 then '' else 'up' end, case when c % 3 = 0 then 'down' else 'up' end, c * 7 % 100000, c * 3 % 40000, c * 97 % 170000, c * 31 % 60000,
      case when k % 9 = 0 then 'bad' else cast(k * 5 as varchar) end, 'm' || c) as csv_i,
    concat_ws(',', case when k % 11 = 0 then 'x' else cast(k as varchar) end, k * 2, k * 3, k * 4, k * 5, k * 6, k * 7, k * 8, k * 9) as csv_h
  from raw_
)"""


@query(f"""with {NODES}
select name, ts, 2 as dslam_type, port, csv_i as csv from nodes where k % 7 <> 0
union all select name, ts, 1, port, csv_h from nodes where k % 6 <> 0 and node % 5 < 3""")
def tar_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.read_node_files(node_files_of(spark, sf_dir)).where("error is null and port is not null")
    return found.select("name", F.col("ts").cast("timestamp_ntz").alias("ts"), "dslam_type", "port", "csv")


@query(f"""with {NODES}
select name, 2 as type, epoch_ms(ts) as "metricsTime", cast(count(*) filter (k % 7 <> 0) as integer) as "recordsCount", 'metadata_202401' as index, 'I_' || name || '_' || epoch_ms(ts) as id from nodes group by all
union all select name, 1, epoch_ms(ts), cast(count(*) filter (k % 6 <> 0) as integer), 'metadata_202401', 'H_' || name || '_' || epoch_ms(ts) from nodes where node % 5 < 3 group by all""")
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decode.metadata_documents(decode.file_metadata(archives.read_node_files(node_files_of(spark, sf_dir))), "metadata")
    return found.select("name", "type", "metricsTime", "recordsCount", "index", "id")


@query(f"""with {NODES}
select 'combined' as kind, name, port, case when k % 7 <> 0 then csv_i else ',,,,,,,' end || ',' || case when k % 6 <> 0 then csv_h else ',,,,,,,,' end as value
from nodes where node % 5 < 3 and (k % 7 <> 0 or k % 6 <> 0)
union all select distinct 'unmatched', name, null, '2,' || epoch_ms(ts) from nodes where node % 5 >= 3
union all select distinct 'unmatched', name, null, '1,' || epoch_ms(ts) from nodes where node % 5 = 4""")
def pair_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined rows of pairs, and the files that stay without a partner or have a bad one."""
    combined, unmatched, _, _ = node_files.pair_then_read(spark, archives.name_only(node_files_of(spark, sf_dir)))
    lone = unmatched.select(F.lit("unmatched").alias("kind"), "name", F.lit(None).cast("string").alias("port"), F.concat_ws(",", "dslam_type", F.unix_millis("ts")).alias("value"))
    return combined.select(F.lit("combined").alias("kind"), "name", "port", F.col("csv").alias("value")).unionByName(lone)


def _line_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the lines' attributes, decoded from inventory rows: some come after the files, some lines have none of a kind."""
    key = F.col("c_custkey")
    k = key % NODE_LINES
    node, at = F.concat(F.lit("N"), F.floor(key / NODE_LINES)), F.when(key % 10 == 8, "2030-01-01").otherwise("2023-12-31").cast("timestamp")
    dashed = F.concat(F.lit("1-1-"), F.floor(k / 10), F.lit("-"), k)
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    rows = rows.repartition(max(1, -(-rows.count() // 100_000)), "c_custkey")  # keys are short: by size, few tasks would decode all
    nodes = inventory.decode_ams(rows.where(key % 10 != 9).select(F.concat(node, F.lit(":R1.S1.LT"), F.floor(k / 10), F.lit(".P"), k).alias("object_name"), F.concat(F.lit("UNI"), key).alias("customer_id"), at.alias("metrics_date")))
    tech = _choose("c_custkey", [F.lit(x) for x in ("Fibre To The Node", "Fibre To The Building", "Fibre To The Curb")])
    profile = _choose("c_custkey", [F.lit(x) for x in ("D25-50_U5-10_Mbps_TC4_P", "x_D100_U40_Mbps_TC4", "D25_U5_Mbps_TC4", "none")])
    services = inventory.decode_fls(rows.select(F.concat(F.lit("AVC"), key).alias("avc_id"), F.concat(F.lit("NTD"), key).alias("ntd_id"), F.concat(F.lit("UNI"), key).alias("uni_prid"), tech.alias("access_service_tech_type"), at.alias("metrics_date"), profile.alias("avc_bandwidth_profile")))
    services = enrich.latest_join(nodes, services, "uni_prid", "ts", ["dslam", "port"], ["avc", "cpi", "tech_type", "tc4_ds", "tc4_us"])
    margin = (key % 40).cast("string")
    states = inventory.decode_nac(rows.where(key % 3 != 1).select(F.lit("2023-12-31").cast("timestamp").alias("metrics_timestamp"), node.alias("dslam"), dashed.alias("port"), margin.alias("max_additional_noise_margin_us"), margin.alias("max_additional_noise_margin_ds"), F.when(key % 2 == 0, "ADP-VDSL_00dB").alias("dpbo_profile_name"), F.lit("1").alias("rtx_attainable_net_data_rate_ds")))
    features = inventory.decode_feature(rows.where(key % 6 != 5).select(F.lit("2023-12-31").cast("timestamp").alias("metrics_timestamp"), F.concat(node, F.lit(":"), dashed).alias("id"), (k % 20 + 0.2).cast("float").alias("value")))
    return node_files.attribute_records(services, states, features)


@query(f"""with {NODES}, {CONTOURS_SQL},
lines_ as (
  select *, cast(c * 97 % 170000 as integer) as rate_ds, cast(c * 31 % 60000 as integer) as rate_us, k % 20 as g, c % 6 <> 5 as has_atten, c % 3 <> 1 as has_state,
    c % 10 < 8 and c % 3 < 2 and c % 4 < 3 as has_service, case c % 3 when 0 then 'FTTN' when 1 then 'FTTB' end as tech, ['50', '100', '25', ''][c % 4 + 1] as tier_ds, ['10', '40', '5', ''][c % 4 + 1] as tier_us,
    case when c % 3 <> 1 then c % 40 else -1 end as margin, case when c % 3 <> 1 and c % 2 = 0 then 0 else 1 end as dpbo
  from nodes where node % 5 < 3 and k % 7 <> 0 and k % 13 <> 0 and k % 20 <> 19
),
pct as (select *, {_percentile_sql("rate_ds", "ds", _PEAK_SQL["ds"], 175000)} as p_ds, {_percentile_sql("rate_us", "us", _PEAK_SQL["us"], 70000)} as p_us from lines_ left join contours using (g)),
found as (select *, {_rate_sql("ds", "rate_ds", "p_ds", "tier_ds", 130000)} as f_ds, {_rate_sql("us", "rate_us", "p_us", "tier_us", 45000)} as f_us from pct),
rated as (
  select *, has_service or has_state or has_atten as e, has_service and has_atten as able from found
)
select name as dslam, line as port, epoch_ms(ts) as ts, c % 3 <> 0 as "ifOperStatus", rate_ds as "attndrDs", rate_us as "attndrUs", case when k % 9 <> 0 then cast(cast(k * 5 as float) / 10 as float) end as "attenuationDs",
  case when k % 6 <> 0 and k % 11 <> 0 then cast(k as integer) end as ses, case when k % 6 <> 0 and k % 11 <> 0 then cast(k * 9 as bigint) end as "reTransDs",
  case when has_service then 'AVC' || c end as avc, case when has_service then 'NTD' || c end as cpi,
  case when e then cast(case when not able or (tech = 'FTTN' and tier_ds = '100' and margin >= 30) or (tech = 'FTTB' and tier_ds in ('100', '50')) or f_ds < rate_ds then -1
    when dpbo = 0 then (f_ds - rate_ds) // 2 + rate_ds else f_ds end as integer) end as "correctedAttndrDs",
  case when e then cast(case when not able or (tech = 'FTTN' and tier_us = '40' and margin >= 30) or (tech = 'FTTB' and tier_us in ('40', '20')) or f_us < rate_us then -1 else f_us end as integer) end as "correctedAttndrUs"
from rated""")
def line_job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over real files: pairs, reads, decodes, enriches, writes its sinks; the records as read from their sink."""
    named = archives.name_only(node_files_of(spark, sf_dir))
    outputs = line_job.line_records(spark, named, lambda: (_line_attributes(spark, sf_dir), _tables(spark, sf_dir)))
    out = scratch_path(spark, "job")
    line_job.write_outputs(*outputs, out, 0)
    return tables.live(spark, f"{out}/records").select("dslam", "port", "ts", "ifOperStatus", "attndrDs", "attndrUs", "attenuationDs", "ses", "reTransDs", "avc", "cpi", "correctedAttndrDs", "correctedAttndrUs")


# keyed tables -----------------------------------------------------------------------------


def _two_batches(spark: SparkSession, sf_dir: str, name: str) -> str:
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"), "props")
    path = scratch_path(spark, name)
    tables.upsert_by_key(events.where("event_id % 3 <> 0"), path, 1, "ts")
    second = events.where("event_id % 2 = 0").withColumns({"value": F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("double")), "props": F.when(F.col("event_id") % 6 != 0, F.lit("new"))})
    for _ in range(2):  # a replay changes nothing
        tables.upsert_by_key(second, path, 2, "ts")
    return path


BATCHES = """first_ as (select event_id, ts, case when event_id % 4 <> 0 then value end as value, props from events where event_id % 3 <> 0),
second_ as (select event_id, ts, case when event_id % 5 <> 0 then cast(event_id as double) end as value, case when event_id % 6 <> 0 then 'new' end as props from events where event_id % 2 = 0)"""


@query(f"""with {BATCHES}
select event_id, strftime(coalesce(b.ts, a.ts), '%Y%m%d') as day, coalesce(b.value, a.value) as value, coalesce(b.props, a.props) as props
from first_ a full join second_ b using (event_id)""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.upserted(spark, _two_batches(spark, sf_dir, "upsert"), ["event_id"], "ts")
    return found.select("event_id", F.col("day").cast("string").alias("day"), "value", "props")


@query(f"""with {BATCHES}
select event_id, case when b.ts is not null then b.value else a.value end as value, case when b.ts is not null then b.props else a.props end as props
from first_ a full join second_ b using (event_id)""")
def keyed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.replaced(spark, _two_batches(spark, sf_dir, "replace"), ["event_id"], "ts").select("event_id", "value", "props")
