"""Queries of the line operators over the event and order tables, with the SQL that they equal.

events stand in for line telemetry: user_id is the line, `error` a re-init, value the
unavailable time. Strings in the formats of node files and inventories are derived from
the columns of part, customer and events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.operators import enrich, health, pairing, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(c: str) -> Column:
    """A number cut off to int."""
    return F.col(c).cast("int")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as telemetry of lines."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.concat(F.lit("N"), F.col("user_id") % 10).alias("dslam"), F.col("user_id").cast("string").alias("port"),
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("AVC"), "user_id")).alias("avc"), "event_type",
        (F.col("event_type") == "error").cast("int").alias("reInit"), whole("value").alias("uas"), (F.col("event_type") != "error").alias("ifOperStatus"),
    )


LINES = """lines as (
  select event_id, ts, 'N' || (user_id % 10) as dslam, cast(user_id as varchar) as port,
         case when event_id % 11 <> 0 then 'AVC' || user_id end as avc, event_type,
         cast(event_type = 'error' as integer) as "reInit", cast(trunc(value) as integer) as uas, event_type <> 'error' as "ifOperStatus"
  from events
)"""

# health of lines --------------------------------------------------------------


@query(f"""
with {LINES}
select event_id, ts, dslam, port from lines
window n as (partition by dslam, port order by ts rows between 4 preceding and current row),
       m as (partition by dslam, port order by ts rows between 1 preceding and current row)
qualify count(*) over n = 5 and sum("reInit") over n < 3 and sum(uas) over m < 60 and min(cast("ifOperStatus" as integer)) over m = 1
""")
def health_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = health.health_pattern(lines(spark, sf_dir), ["dslam", "port"], ["ts"], n=5, m=2, max_reinit=3, max_uas=60)
    return found.select("event_id", "ts", "dslam", "port")


@query(f"""
with {LINES}
select * from (
  select ts, dslam, port, avc, count(ts) over w as cnt, cast(sum("reInit") over w as bigint) as sum_reinit, cast(sum(uas) over w as bigint) as sum_uas
  from lines where avc is not null
  window w as (partition by dslam, port order by ts rows between 2 preceding and current row)
) where cnt = 3 and sum_reinit <= 1 and sum_uas <= 180
""")
def health_over_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines(spark, sf_dir).createOrReplaceTempView("lineflow_lines")
    return health.health_over_sql(spark, "lineflow_lines", 3, 1, 180)


TOGGLES = """toggles as (
  select user_id, ts, event_type = 'purchase' as flag from events where event_type in ('purchase', 'error')
)"""


def toggles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "error"))
    return rows.select("user_id", "ts", (F.col("event_type") == "purchase").alias("flag"))


@query(f"""
with {TOGGLES}
select event_id, user_id, ts from (
  select e.event_id, e.user_id, e.ts, t.flag from (select * from events where event_type in ('click', 'view')) e
  asof join toggles t on e.user_id = t.user_id and e.ts >= t.ts
) where flag
""")
def watch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view")).select("event_id", "user_id", "ts")
    return health.watch_gate(events, toggles(spark, sf_dir), ["user_id"], "ts")


@query(f"with {TOGGLES} select user_id, arg_max(flag, ts) as flag from toggles group by user_id")
def watch_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.export_watch_state(toggles(spark, sf_dir), ["user_id"], "ts")


@query(f"""
with {TOGGLES},
watched as (
  select e.*, t.ts as since from (select event_id, user_id, ts, cast(event_id % 7 = 0 as integer) as re, cast(trunc(value) as integer) as uas, event_id % 5 <> 0 as up from events where event_type in ('click', 'view', 'signup')) e
  asof join toggles t on e.user_id = t.user_id and e.ts >= t.ts where t.flag
),
found as (
  select * from watched
  window n as (partition by user_id, since order by ts rows between 2 preceding and current row),
         m as (partition by user_id, since order by ts rows between 1 preceding and current row)
  qualify count(*) over n = 3 and sum(re) over n < 2 and sum(uas) over m < 120 and min(cast(up as integer)) over m = 1
)
select event_id, user_id, ts from found qualify row_number() over (partition by user_id, since order by ts) = 1
""")
def monitor_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view", "signup"))
    events = events.select("event_id", "user_id", "ts", (F.col("event_id") % 7 == 0).cast("int").alias("reInit"), whole("value").alias("uas"), (F.col("event_id") % 5 != 0).alias("ifOperStatus"))
    return health.monitor_loop(events, toggles(spark, sf_dir), ["user_id"], "ts", 3, 2, 2, 120).select("event_id", "user_id", "ts")


# pairing ------------------------------------------------------------------------

SIDES = """sides as (
  select *, time_bucket(interval '1 day', ts) as window_start from events where event_type in ('click', 'view')
),
firsts as (
  select event_type, user_id, window_start, arg_min(event_id, (ts, event_id)) as event_id, arg_min(value, (ts, event_id)) as value from sides group by all
),
paired as (
  select c.user_id, c.window_start, c.event_id as left_event_id, c.value as left_value, v.event_id as right_event_id, v.value as right_value
  from (select * from firsts where event_type = 'click') c join (select * from firsts where event_type = 'view') v using (user_id, window_start)
)"""
_ORDER, _VALUES = ["ts", "event_id"], ["event_id", "value"]


def _pairs(spark: SparkSession, sf_dir: str, values: list[str] = _VALUES) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    side = lambda kind: events.where(F.col("event_type") == kind)
    return pairing.pair_in_window(side("click"), side("view"), "user_id", "ts", "1 day", _ORDER, values)


@query(f"with {SIDES} select user_id, window_start, left_event_id, left_value, right_event_id, right_value from paired")
def pair_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)[0]


@query(f"with {SIDES} select user_id, window_start, left_event_id, left_value, right_event_id, right_value from paired")
def pair_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return pairing.pair_in_window_agg(table(spark, sf_dir, "events"), "user_id", "ts", "1 day", kind == "click", kind == "view", _ORDER, _VALUES)


@query(f"""with {SIDES}
select concat_ws(',', user_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), event_type, event_id) as value
from sides anti join paired using (user_id, window_start)""")
def unmatched_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, alone = _pairs(spark, sf_dir, ["ts", "event_type", "event_id"])
    return pairing.unmatched_lines(alone.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), "user_id", "ts", "event_type", "event_id")


@query(f"""with {SIDES}
select event_id, user_id, event_type from sides anti join paired using (user_id, window_start)
where window_start + interval '1 day' + interval '2 hours' < (select max(ts) from events)""")
def late_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    now = F.lit(events.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    metadata = events.where(F.col("event_type").isin("click", "view"))
    found = pairing.late_reconcile(metadata, _pairs(spark, sf_dir)[0], "user_id", "ts", "1 day", "2 hours", now)
    return found.select("event_id", "user_id", "event_type")


@query("""
select coalesce(p.k, l.k) as k, coalesce(p.csv, ',') || ',' || coalesce(l.csv, ',,') as csv
from (select p_partkey as k, p_brand || ',' || p_size as csv from part where p_partkey % 3 <> 0) p
full join (
  select l_partkey as k, count(*) || ',' || max(l_linenumber) || ',' || min(l_suppkey) as csv from lineitem where l_partkey % 2 = 0 group by 1
) l on p.k = l.k
""")
def merge_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("k"), F.concat_ws(",", "p_brand", "p_size").alias("csv"))
    right = table(spark, sf_dir, "lineitem").where("l_partkey % 2 = 0").groupBy(F.col("l_partkey").alias("k"))
    right = right.agg(F.concat_ws(",", F.count("*"), F.max("l_linenumber"), F.min("l_suppkey")).alias("csv"))
    return pairing.merge_csv_rows(left, right, ["k"], "csv", 2, 3)


# enrichment ---------------------------------------------------------------------

ATTRIBUTES = """attributes as (
  select user_id, ts, case when event_id % 5 <> 0 then value end as a, event_id % 2 = 0 as present_a, props as b, event_id % 3 <> 0 as present_b
  from events where event_type = 'signup'
)"""


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'signup'")
    return rows.select("user_id", "ts", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("a"), (F.col("event_id") % 2 == 0).alias("present_a"), F.col("props").alias("b"), (F.col("event_id") % 3 != 0).alias("present_b"))


@query(f"""
with {ATTRIBUTES},
rows_ as (
  select event_id, user_id, ts, 1 as kind, null as pa, null as pb from events where event_type <> 'signup'
  union all
  select null, user_id, ts, 0, case when present_a then {{'v': a}} end, case when present_b then {{'v': b}} end from attributes
),
held as (
  select event_id, user_id, ts, kind, last_value(pa ignore nulls) over w as pa, last_value(pb ignore nulls) over w as pb, max(kind = 0) over w as enriched
  from rows_ window w as (partition by user_id order by ts, kind rows between unbounded preceding and current row)
)
select event_id, user_id, ts, pa.v as a, pb.v as b, enriched from held where kind = 1
""")
def enrich_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "events").where("event_type <> 'signup'").select("event_id", "user_id", "ts")
    return enrich.enrich_asof(facts, _attributes(spark, sf_dir), ["user_id"], "ts", ["a", "b"])


HOT_ATTRIBUTES = ATTRIBUTES.replace("select user_id, ts", "select case when user_id % 3 = 0 then 0 else user_id end as user_id, ts")


@query(f"""
with {HOT_ATTRIBUTES},
rows_ as (
  select event_id, case when user_id % 3 = 0 then 0 else user_id end as user_id, ts, 1 as kind, null as pa, null as pb from events where event_type <> 'signup'
  union all
  select null, user_id, ts, 0, case when present_a then {{'v': a}} end, case when present_b then {{'v': b}} end from attributes
),
held as (
  select event_id, user_id, ts, kind, last_value(pa ignore nulls) over w as pa, last_value(pb ignore nulls) over w as pb, max(kind = 0) over w as enriched
  from rows_ window w as (partition by user_id order by ts, kind rows between unbounded preceding and current row)
)
select event_id, user_id, ts, pa.v as a, pb.v as b, enriched from held where kind = 1
""")
def enrich_asof_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows under one key, which is cut in stretches of 100 rows."""
    facts = table(spark, sf_dir, "events").where("event_type <> 'signup'").select("event_id", _third_in_one(), "ts")
    changes = _attributes(spark, sf_dir).withColumn("user_id", _third_in_one())
    return enrich.enrich_asof(facts, changes, ["user_id"], "ts", ["a", "b"], segment_rows=100)


def _third_in_one() -> Column:
    return F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id")).alias("user_id")


@query(f"""
with {LINES},
hot as (select * replace (case when cast(port as bigint) % 3 = 0 then '0' else port end as port, 'N' as dslam) from lines)
select event_id, ts, dslam, port from hot
window n as (partition by dslam, port order by ts rows between 4 preceding and current row),
       m as (partition by dslam, port order by ts rows between 1 preceding and current row)
qualify count(*) over n = 5 and sum("reInit") over n < 3 and sum(uas) over m < 60 and min(cast("ifOperStatus" as integer)) over m = 1
""")
def health_pattern_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows on one line, which is cut in blocks of 100 rows."""
    port = F.when(F.col("port").cast("long") % 3 == 0, "0").otherwise(F.col("port"))
    rows = lines(spark, sf_dir).withColumns({"port": port, "dslam": F.lit("N")})
    found = health.health_pattern(rows, ["dslam", "port"], ["ts"], n=5, m=2, max_reinit=3, max_uas=60, segment_rows=100)
    return found.select("event_id", "ts", "dslam", "port")


@query(f"""
with {ATTRIBUTES}
select user_id, first(a order by ts desc) filter (present_a) as a, first(b order by ts desc) filter (present_b) as b from attributes group by user_id
""")
def attribute_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.attribute_merge(_attributes(spark, sf_dir), ["user_id"], "ts", ["a", "b"])


@query("""
select user_id, least(c.ts, v.ts) as ts, c.value as clicked, v.props as viewed
from (select user_id, max(ts) as ts, arg_max(value, ts) as value from events where event_type = 'click' group by 1) c
join (select user_id, max(ts) as ts, arg_max(props, ts) as props from events where event_type = 'view' group by 1) v using (user_id)
""")
def latest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    left = events.where("event_type = 'click'").withColumnRenamed("value", "clicked")
    right = events.where("event_type = 'view'").withColumnRenamed("props", "viewed")
    return enrich.latest_join(left, right, "user_id", "ts", ["clicked"], ["viewed"])


@query("""
with v as (
  select user_id, max(ts) as ts, arg_max(props, ts) as props, max(cast(ts as date)) as day from events where event_type = 'view' group by 1
),
ends as (select min(day) as oldest from (select distinct cast(ts as date) as day from events where event_type = 'view' order by day desc limit 2))
select user_id, case when day < oldest then c.ts else least(c.ts, v.ts) end as ts, c.value as clicked,
       case when not day < oldest then v.props end as viewed, day < oldest as wiped
from (select user_id, max(ts) as ts, arg_max(value, ts) as value from events where event_type = 'click' group by 1) c join v using (user_id), ends
""")
def latest_join_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    left = events.where("event_type = 'click'").withColumnRenamed("value", "clicked")
    right = events.where("event_type = 'view'").select("user_id", "ts", F.col("props").alias("viewed"), F.to_date("ts").alias("day"))
    return enrich.latest_join_expiry(left, right, "user_id", "ts", "day", ["clicked"], ["viewed"])


# history ------------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    requests = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 3 != 0).alias("flag"))
    history = table(spark, sf_dir, "orders").where("o_custkey % 4 <> 1").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_orderstatus")
    return enrich.history_lookup(requests, history, "c_custkey", "o_orderdate", 3, ["o_orderkey"], ["o_orderstatus"])


@query("""
with top as (
  select o_custkey as c_custkey, o_orderdate, o_orderkey from orders where o_custkey % 3 <> 0 and o_custkey % 4 <> 1 and o_custkey in (select c_custkey from customer)
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) <= 3
)
select *, cast(row_number() over (partition by c_custkey order by o_orderdate, o_orderkey) as integer) as seq from top
""")
def history_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[0]


@query("""
select c_custkey, o_orderstatus, c_custkey % 3 <> 0 as flag from customer
join (select o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as o_orderstatus from orders where o_custkey % 4 <> 1 group by 1) on o_custkey = c_custkey
""")
def history_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[1]


@query("""
select c_custkey, c_custkey % 3 <> 0 as flag from customer
where c_custkey not in (select o_custkey from orders where o_custkey % 4 <> 1)
""")
def history_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[2]


# windows ------------------------------------------------------------------------


@query("select time_bucket(interval '15 minutes', ts) as window_start, count(*) as n from events group by 1")
def window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_per_window(table(spark, sf_dir, "events"), "ts", "15 minutes")


@query("""
with s as (
  select user_id, ts, lead(ts) over (partition by user_id order by ts) as later from events
)
select user_id, ts as last_ts from s where later is null or later > ts + interval '12 hours'
""")
def missing_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.missing_sessions(table(spark, sf_dir, "events"), "user_id", "ts", "12 hours")


@query("""
with w as (
  select user_id, value, time_bucket(interval '15 minutes', ts) - k * interval '15 minutes' + interval '120 minutes' as window_end
  from events, range(8) r(k)
)
select user_id, window_end, cast(trunc(avg(cast(trunc(value) as integer))) as integer) as average_ds,
       cast(trunc(avg(cast(trunc(value * 2) as integer))) as integer) as average_us, count(*) as measurements
from w group by 1, 2
""")
def rolling_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "ts", whole("value").alias("ds"), (F.col("value") * 2).cast("int").alias("us"))
    return windows.rolling_average(rows, ["user_id"], "ts", "120 minutes", "15 minutes", "ds", "us")


@query("""
select time_bucket(interval '7 days', o_orderdate, timestamp '1970-01-01') as window_start, count(*) as n, round(avg(delay), 3) as average_delay, quantile_disc(delay, 0.5) as percentile_delay, max(delay) as longest_delay
from (select o_orderdate, cast(epoch(l_shipdate) - epoch(o_orderdate) as double) as delay from lineitem join orders on l_orderkey = o_orderkey)
group by 1
""")
def arrival_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select(F.col("l_shipdate").cast("timestamp").alias("arrived"), F.col("o_orderdate").cast("timestamp").alias("measured"))
    found = windows.arrival_delay(rows, "arrived", "measured", "7 days")
    return found.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "average_delay": F.round(F.col("average_delay") * 1000) / 1000})
