"""Queries over time, totals, sketches, footers and table functions, with the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import views as V
from .functions import table_functions
from .functions.keys import key_category
from .operators import sketches, temporal, totals
from .queries import ANSWER, THINKING
from .session import table
from .sources import footers
from .streaming.windows import window_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
HOUR, GAP, TRAIL = 3600, 1800, 7
DAY_US = temporal.DAY


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


# --- windows, sessions and frames ---


@query(f"""SELECT event_type, epoch_us(ts) // {DAY_US} * {DAY_US} AS window_start, epoch_us(ts) // {DAY_US} * {DAY_US} + {DAY_US} AS window_end, count(*) AS n_events
  FROM events GROUP BY ALL""")
def event_tumbling_counts(spark, d):
    """Partial counts by window and type, one exchange of those."""
    return window_counts(table(spark, d, "events"), "ts", "1 day", by=["event_type"])


@query(f"""SELECT event_type, w * {6 * HOUR * 1_000_000} AS window_start, w * {6 * HOUR * 1_000_000} + {DAY_US} AS window_end, count(*) AS n_events FROM (
  SELECT event_type, unnest([k - 3, k - 2, k - 1, k]) AS w FROM (SELECT event_type, epoch_us(ts) // {6 * HOUR * 1_000_000} AS k FROM events)) GROUP BY ALL""")
def event_sliding_counts(spark, d):
    """Each row goes to its four windows before the partial counts; the exchange moves counts."""
    return window_counts(table(spark, d, "events"), "ts", "1 day", "6 hours", by=["event_type"])


@query(f"""SELECT user_id, min(t) AS session_start, max(t) AS session_end, count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS total FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT user_id, epoch_us(ts) AS t, CAST(round(value * 100) AS BIGINT) AS cents,
      CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < {24 * HOUR * 1_000_000} THEN 0 ELSE 1 END AS fresh FROM events))
  GROUP BY user_id, island""")
def event_sessions(spark, d):
    """One exchange by user; frequent users are split by time first and their sessions united."""
    events = table(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return temporal.sessions(events, ["user_id"], "ts", 24 * HOUR, "cents")


@query("""SELECT p.event_id, p.user_id, arg_max(v.event_id, (v.ts, v.event_id)) AS found_event, arg_max(v.event_type, (v.ts, v.event_id)) AS found_type
  FROM events p LEFT JOIN events v ON v.user_id = p.user_id AND v.ts < p.ts AND v.event_type <> 'purchase' WHERE p.event_type = 'purchase' GROUP BY ALL""")
def event_as_of(spark, d):
    """Every purchase with the user's latest earlier event: both sides united, one exchange and a window, no join."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    bought, others = events.where("event_type = 'purchase'"), events.where("event_type <> 'purchase'")
    found = temporal.as_of(bought, others, ["user_id"], "ts", "ts", ties=["event_id"])
    return found.select("event_id", "user_id", F.col("found.event_id").alias("found_event"), F.col("found.event_type").alias("found_type"))


_OFFERS = """offers AS (SELECT s_suppkey, s_nationkey AS nation, TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey * 37 % 2300 AS INTEGER)) AS start,
  TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey * 37 % 2300 + [1, 9, 400][s_suppkey % 3 + 1] AS INTEGER)) AS stop FROM supplier)"""


@query(f"""WITH {_OFFERS}, o AS (SELECT o_orderkey, o_orderdate, c_nationkey AS nation FROM orders JOIN customer ON c_custkey = o_custkey)
  SELECT s_suppkey, count(*) AS n_orders, CAST(sum(o_orderkey) AS BIGINT) AS order_keys FROM o JOIN offers USING (nation)
  WHERE start <= o_orderdate AND o_orderdate < stop GROUP BY s_suppkey""")
def order_intervals(spark, d):
    """Orders within offers of 1, 9 or 400 days to the customer's nation: an equi-join on nation, level and bin, no nested loop."""
    key = F.col("s_suppkey")
    begin = (key * 37 % 2300).cast("int")
    days = F.when(key % 3 == 0, 1).when(key % 3 == 1, 9).otherwise(400)
    day = lambda n: F.date_add(F.lit("1992-01-01").cast("date"), n)
    offers = table(spark, d, "supplier").select(key, F.col("s_nationkey").alias("nation"), day(begin).alias("start"), day(begin + days).alias("stop"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = table(spark, d, "orders").join(customers, "o_custkey").select("o_orderkey", "o_orderdate", "nation")
    pairs = temporal.interval_join(orders, offers, "o_orderdate", "start", "stop", ["nation"])
    return pairs.groupBy(F.col("interval.s_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n_orders"), F.sum("point.o_orderkey").alias("order_keys"))


@query("""SELECT event_id, count(*) OVER w AS n_day, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents_day FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)""")
def event_trailing_day(spark, d):
    """A range frame inside buckets of a day, each with the rows of the day before; one exchange."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    found = temporal.trailing(events, ["user_id"], "ts", 24 * HOUR, n_day=lambda r: F.count(r["event_id"]), cents_day=lambda r: F.sum(r["cents"]))
    return found.select("event_id", "n_day", "cents_day")


# --- totals ---

_BY = ("category", "site", "kind")
_TOTALS = "CAST(count(*) AS BIGINT) AS n, CAST(coalesce(sum(greatest(size, 0)), 0) AS BIGINT) AS total_bytes"
_KEYED = f"WITH {V.MANIFEST}, k AS (SELECT *, {V.KEY_CATEGORY} AS category FROM manifest)"


def _keyed(spark, d):
    return V.manifest(spark, d).withColumn("category", key_category(F.col("key")))


@query(f"{_KEYED} SELECT category, site, kind, CAST(grouping(category, site, kind) AS BIGINT) AS grouping_id, {_TOTALS} FROM k GROUP BY ROLLUP (category, site, kind)")
def manifest_rollup(spark, d):
    """Added up by all keys first; Expand multiplies groups only."""
    return totals.category_totals(_keyed(spark, d), totals.rollup_sets(_BY))


@query(f"{_KEYED} SELECT category, site, kind, CAST(grouping(category, site, kind) AS BIGINT) AS grouping_id, {_TOTALS} FROM k GROUP BY CUBE (category, site, kind)")
def manifest_cube(spark, d):
    return totals.category_totals(_keyed(spark, d), totals.cube_sets(_BY))


@query(f"""{_KEYED} SELECT category, site, kind, CAST(grouping(category, site, kind) AS BIGINT) AS grouping_id, {_TOTALS} FROM k
  GROUP BY GROUPING SETS ((category, kind), (site), ())""")
def manifest_grouping_sets(spark, d):
    return totals.category_totals(_keyed(spark, d), [["category", "kind"], ["site"], []])


# --- sketches ---


@query(f"""WITH e AS (SELECT epoch_us(ts) // {DAY_US} AS day, user_id FROM events), days AS (SELECT DISTINCT day FROM e)
  SELECT days.day, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_close, true AS median_close
  FROM days JOIN e ON e.day BETWEEN days.day - {TRAIL - 1} AND days.day GROUP BY days.day""")
def trailing_users(spark, d):
    """Seven trailing days from daily sketches; exact figures beside them show that the sketches are within 3 %."""
    events = table(spark, d, "events").select("ts", "user_id", "value")
    told = sketches.estimates(sketches.trailing_days(sketches.daily_sketches(events, "ts", "user_id", "value"), TRAIL), 0.5)
    told = told.select("day", F.col("distinct_items").alias("estimate"), "q50")
    # exact: one row for each day, user and value, spread over the days that it counts for
    own = events.select(F.to_date("ts").alias("day"), "user_id", "value")
    spread = own.withColumn("day", F.explode(F.sequence("day", F.date_add("day", TRAIL - 1)))).join(F.broadcast(told), "day")
    exact = spread.groupBy("day").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.count_if(F.col("value") <= F.col("q50")).alias("below"), F.first("estimate").alias("estimate")
    )
    close = lambda found, want, of: F.abs(found - want) <= 0.03 * of + 1
    day = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("long").alias("day")
    return exact.select(day, "n", "users", close(F.col("estimate"), F.col("users"), F.col("users")).alias("users_close"), close(F.col("below"), F.col("n") / 2, F.col("n")).alias("median_close"))


# --- footers and table functions ---


@query("SELECT count(*) AS n_rows, min(o_orderkey) AS low, max(o_orderkey) AS high, true AS all_in_place FROM orders")
def row_group_index(spark, d):
    """Counts and bounds of a table from its footers alone; no data is scanned."""
    shards = spark.createDataFrame([(p,) for p in table(spark, d, "orders").inputFiles()], "path string")
    groups = footers.with_places(footers.row_groups(spark, shards, ["o_orderkey"]))
    bound = lambda end: F.col("bounds")["o_orderkey"][end].cast("long")
    told = groups.agg(F.sum("n_rows").alias("n_rows"), F.min(bound("low")).alias("low"), F.max(bound("high")).alias("high"), F.max(F.col("before") + F.col("n_rows")).alias("end"))
    return told.select("n_rows", "low", "high", (F.col("end") == F.col("n_rows")).alias("all_in_place"))


@query(f"WITH {V.TRACES_FLAT} SELECT conv_id, turn, {THINKING} AS thinking, {ANSWER} AS answer FROM traces_flat")
def split_traces_in_sql(spark, d):
    """The table function on a table argument, from SQL."""
    table_functions.register(spark)
    return spark.sql("SELECT conv_id, turn, thinking, answer FROM split_traces(TABLE({t}), 'response')", t=V.traces_flat(spark, d))


@query("""SELECT conv_id, turn, row_number() OVER w AS number, last_value(CASE WHEN role = 'user' THEN nullif(text, '') END IGNORE NULLS) OVER w AS last_user,
  last_value(CASE WHEN role = 'assistant' THEN nullif(text, '') END IGNORE NULLS) OVER w AS last_assistant FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""")
def conversation_state_in_sql(spark, d):
    """A table function that asks for its partitioning and order itself; one exchange by conversation."""
    table_functions.register(spark)
    return spark.sql("SELECT * FROM conversation_state(TABLE({t}))", t=table(spark, d, "conversations"))
