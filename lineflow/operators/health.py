"""Detection of healthy lines, and the watch list that switches it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineflow.operators.enrich import enrich_asof
from lineflow.operators.segments import SEGMENT_ROWS, hot_keys, overlapping_blocks, same_keys


def health_over_sql(spark: SparkSession, view: str, n: int = 3, max_reinit: int = 60, max_uas: int = 18000) -> DataFrame:
    """Rows whose last n rows of the line have few re-inits and little unavailable time; view: ts, dslam, port, avc, reInit, uas."""
    return spark.sql(f"""
        SELECT ts, dslam, port, avc, cnt, sum_reinit, sum_uas FROM (
          SELECT ts, dslam, port, avc, COUNT(ts) OVER w AS cnt, SUM(reInit) OVER w AS sum_reinit, SUM(uas) OVER w AS sum_uas
          FROM {view} WHERE avc IS NOT NULL
          WINDOW w AS (PARTITION BY dslam, port ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
        ) WHERE cnt = {n} AND sum_reinit <= {max_reinit} AND sum_uas <= {max_uas}
    """)


def matched(keys: list[str], order: list[str], n: int, m: int, max_reinit: int, max_uas: int) -> F.Column:
    """Whether the row ends n rows with fewer re-inits than max_reinit, the last m of them up and with less unavailable time than max_uas.

    With counters of 0 and more the running sums of the pattern are its totals. Null counters are 0.
    """
    if not n > m >= 1:
        raise ValueError("n > m >= 1 is needed")
    window = Window.partitionBy(*keys).orderBy(*order)
    whole, last = window.rowsBetween(-(n - 1), 0), window.rowsBetween(-(m - 1), 0)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    few = (F.count("*").over(whole) == n) & (F.sum(zero("reInit")).over(whole) < max_reinit)
    return few & (F.sum(zero("uas")).over(last) < max_uas) & F.min(F.coalesce("ifOperStatus", F.lit(False))).over(last)


def marked(df: DataFrame, keys: list[str], order: list[str], n: int, m: int, max_reinit: int, max_uas: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """df with __up, matched() of each row; keys with more than segment_rows rows are cut in blocks that overlap by n - 1 rows.

    order begins with a time or a number.
    """
    found = lambda rows, keys, order: rows.withColumn("__up", matched(keys, order, n, m, max_reinit, max_uas))
    plain = found(df, keys, order)
    cuts = hot_keys(df, keys, order[0], segment_rows)
    if cuts is None:
        return plain
    blocks = overlapping_blocks(df, cuts, keys, order, max(segment_rows, n), n - 1)
    hot = found(blocks, [*keys, "__block"], ["__at"]).where("__own").drop("__at", "__block", "__own")
    return found(same_keys(df, cuts, keys, "left_anti"), keys, order).unionByName(hot)


def health_pattern(df: DataFrame, keys: list[str], order: list[str], n: int = 288, m: int = 8, max_reinit: int = 5, max_uas: int = 10, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The last rows of matches of the line-is-up pattern; matches may overlap."""
    return marked(df, keys, order, n, m, max_reinit, max_uas, segment_rows).where("__up").drop("__up")


def _toggled(events: DataFrame, toggles: DataFrame, keys: list[str], ts: str, segment_rows: int) -> DataFrame:
    """events with the last toggle's flag (default false) and its time; at equal times the toggle comes first."""
    given = F.col("flag").isNotNull().alias("present___flag")
    changes = toggles.select(*keys, ts, F.col("flag").alias("__flag"), given, F.col(ts).alias("__watch"), F.lit(True).alias("present___watch"))
    rows = enrich_asof(events, changes, keys, ts, ["__flag", "__watch"], segment_rows, "__seen").drop("__seen")
    return rows.withColumn("__flag", F.coalesce("__flag", F.lit(False)))


def watch_gate(events: DataFrame, toggles: DataFrame, keys: list[str], ts: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Events of lines that are switched on at their time."""
    return _toggled(events, toggles, keys, ts, segment_rows).where("__flag").select(events.columns)


def export_watch_state(toggles: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """(keys, flag): the current flag of every line that was ever switched; at equal times on wins."""
    return toggles.groupBy(*keys).agg(F.max_by("flag", F.struct(ts, "flag")).alias("flag"))


def seed_toggles(toggles: DataFrame, history: DataFrame, keys: list[str], ts: str, n: int) -> DataFrame:
    """toggles with held: the newest n rows (reInit, uas, up) of the line's history before each, oldest first.

    History is numbered once by line, toggles among it; a toggle then asks for n numbers.
    """
    values = F.struct(F.coalesce("reInit", F.lit(0)).cast("int").alias("reInit"), F.coalesce("uas", F.lit(0)).cast("int").alias("uas"), F.coalesce("ifOperStatus", F.lit(False)).alias("up"))
    switches = toggles.where("flag").select(*keys, ts).distinct()
    lines = history.join(switches.select(*keys).distinct(), keys, "left_semi")
    both = lines.select(*keys, ts, F.lit(1).alias("__kind"), values.alias("__v")).unionByName(switches.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    before = Window.partitionBy(*keys).orderBy(ts, "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("__n", F.sum("__kind").over(before))
    asked = both.where((F.col("__kind") == 0) & (F.col("__n") > 0)).select(*keys, ts, F.explode(F.sequence(F.greatest(F.col("__n") - n + 1, F.lit(1)), F.col("__n"))).alias("__n"))
    found = asked.join(both.where("__kind = 1").select(*keys, "__n", "__v"), [*keys, "__n"])
    held = found.groupBy(*keys, ts).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__v"))), lambda r: r["__v"]).alias("held"))
    return toggles.join(held, [*keys, ts], "left")


def monitor_loop(events: DataFrame, toggles: DataFrame, keys: list[str], ts: str, n: int, m: int, max_reinit: int, max_uas: int, seeded: bool = False, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Gate, pattern and feedback: a line switched on is watched until its first match, which switches it off.

    Each on-stretch gives at most its first match. A toggle starts with no rows held, or,
    seeded, with the line's newest rows before it: matches end in the stretch, but may
    begin before it.
    """
    stretch = [*keys, "__watch"]
    if seeded:
        known = marked(events, keys, [ts], n, m, max_reinit, max_uas, segment_rows)
        found = _toggled(known, toggles, keys, ts, segment_rows).where("__flag and __up")
    else:
        watched = _toggled(events, toggles, keys, ts, segment_rows).where("__flag")
        found = health_pattern(watched, stretch, [ts], n, m, max_reinit, max_uas, segment_rows)
    first = Window.partitionBy(*stretch).orderBy(ts)
    return found.withColumn("__r", F.row_number().over(first)).where("__r = 1").select(events.columns)
