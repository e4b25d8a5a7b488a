"""Streaming queries: each runs to the end of the data and returns what its sink holds."""

from functools import partial

from pyspark.sql import functions as F

from ..functions import payload as P
from ..operators.nested import explode_rows, nest
from ..operators.quality import Rule
from ..session import work_dir
from ..streaming import batches as B
from ..streaming import checkpoints as C
from ..streaming import expectations as E
from ..streaming import joins as J
from ..streaming import ledger as L
from ..streaming import runner as R
from ..streaming import windows as W
from .joins import CUSTOMERS_SQL, customers
from .registry import query as registered

query = partial(registered, streaming=True)


def events(t):
    return R.stream_table(t.spark, t.sf_dir, event_time="ts", glob="events.parquet")


def orders(t):
    return R.stream_table(t.spark, t.sf_dir, event_time="o_orderdate", glob="orders.parquet")


def lines(t):
    return R.stream_table(t.spark, t.sf_dir, event_time="l_shipdate", glob="lineitem.parquet")


def naive(df, *columns):
    """Zoned timestamps as plain ones, to compare with other engines."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def appended(t, stream, name):
    """Run in append mode and read the sink."""
    root = work_dir(t.spark, name)
    R.run_append(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{root}/table")


def replayed(t, name, tables, build, bytes_per_slice=R.BYTES_PER_SLICE):
    """``build`` run over tables, (name, time, columns) each, in the order of time: one slice for small ones."""
    stored = R.stored_bytes(t.spark, *[f"{t.sf_dir}/{table}.parquet" for table, *_ in tables])
    slices = R.time_slices(stored, bytes_per_slice)
    rows = [(getattr(t, table).withColumn(time, F.col(time).cast("timestamp")).select(*columns), time) for table, time, columns in tables]
    return R.replay_append(rows, build, work_dir(t.spark, name), slices)[0]


def completed(t, stream, name):
    root = work_dir(t.spark, name)
    R.run_complete(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table")


WINDOW = ("window_start", "window_end")


def bucket_sql(length, keys="", aggregates="COUNT(*) AS events", where="TRUE", source="events"):
    keys = f"{keys}," if keys else ""
    return f"""(SELECT time_bucket(INTERVAL {length}, ts, TIMESTAMP '1970-01-01') AS window_start,
      time_bucket(INTERVAL {length}, ts, TIMESTAMP '1970-01-01') + INTERVAL {length} AS window_end, {keys} {aggregates}
      FROM {source} WHERE {where} GROUP BY ALL)"""


CLOSED = "window_end <= (SELECT MAX(ts) FROM events) - INTERVAL {0}".format
MONEY = "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total"


def n():
    return {"events": F.count(F.lit(1))}


def n_total():
    return n() | {"total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}


@query("stream_copy", "T1 T3 S13 K10", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_copy(t):
    return naive(appended(t, events(t), "copy"), "ts")


@query("stream_filter", "T1", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 10")
def stream_filter(t):
    kept = events(t).where("event_type = 'purchase' and value > 10").select("event_id", "user_id", "value")
    return appended(t, kept, "filter")


@query("stream_project", "T1", "SELECT event_id, upper(event_type) AS kind, CAST(ts AS DATE) AS day FROM events")
def stream_project(t):
    return appended(t, events(t).select("event_id", F.upper("event_type").alias("kind"), F.to_date("ts").alias("day")), "project")


@query("stream_count_complete", "T4 T2", f"SELECT event_type, COUNT(*) AS events, {MONEY} FROM events GROUP BY 1")
def stream_count_complete(t):
    R.check_mode("complete", aggregated=True, watermarked=False)
    counts = events(t).groupBy("event_type").agg(*[c.alias(n) for n, c in n_total().items()])
    return completed(t, counts, "count")


@query("stream_count_update", "T2", "SELECT event_type, COUNT(*) AS events FROM events GROUP BY 1")
def stream_count_update(t):
    root = work_dir(t.spark, "update")
    counts = events(t).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    R.run_update(counts, f"{root}/table", f"{root}/checkpoint")
    return R.read_updates(t.spark, f"{root}/table", ["event_type"])


@query("stream_progress", "T5", "SELECT 'copied events' AS name, COUNT(*) AS input_rows FROM events")
def stream_progress(t):
    root = work_dir(t.spark, "progress")
    q = R.run_append(events(t), f"{root}/table", f"{root}/checkpoint", name="copied events")
    return C.progress_row(t.spark, q).select("name", "input_rows")


@query("stream_distinct_users", "T6 A15", "SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct_users(t):
    return appended(t, W.stream_dedup(events(t).select("user_id", "event_type"), ["user_id", "event_type"]), "distinct")


@query("stream_dedup_watermark", "T7", "SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def stream_dedup_watermark(t):
    rows = lines(t).select("l_orderkey", "l_linenumber", "l_shipdate")
    return naive(appended(t, W.stream_dedup(rows, ["l_orderkey", "l_linenumber", "l_shipdate"], "l_shipdate", "3 minutes"), "dedup"), "l_shipdate")


@query("stream_dedup_within", "T8", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def stream_dedup_within(t):
    rows = lines(t).select("l_orderkey", "l_linenumber", "l_shipdate")
    return appended(t, W.stream_dedup_within(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", "10 minutes"), "within").drop("l_shipdate")


@query("window_tumbling", "T9", f"SELECT * FROM {bucket_sql('1 HOUR', aggregates=f'COUNT(*) AS events, {MONEY}')}")
def window_tumbling(t):
    return naive(completed(t, W.window_agg(events(t), "ts", "1 hour", n_total()), "tumbling"), *WINDOW)


SLIDE_SQL = """(SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, event_type, COUNT(*) AS events FROM
  (SELECT event_type, UNNEST([time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01'),
    time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') - INTERVAL 30 MINUTE]) AS ws FROM events) GROUP BY ALL)"""


@query("window_sliding", "T9b", f"SELECT * FROM {SLIDE_SQL}")
def window_sliding(t):
    return naive(completed(t, W.window_agg(events(t), "ts", "1 hour", n(), ["event_type"], slide="30 minutes"), "sliding"), *WINDOW)


@query(
    "window_session",
    "T9c",
    """WITH p AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
    s AS (SELECT *, SUM(CASE WHEN b IS NULL OR ts - b > INTERVAL 10 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM p)
    SELECT user_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL 10 HOUR AS window_end, COUNT(*) AS events FROM s GROUP BY user_id, n""",
)
def window_session(t):
    return naive(completed(t, W.session_agg(events(t), "ts", "10 hours", ["user_id"], n()), "session"), *WINDOW)


@query("window_closed_only", "T9d", f"SELECT * FROM {bucket_sql('1 HOUR')} WHERE {CLOSED('10 MINUTE')}")
def window_closed_only(t):
    R.check_mode("append", aggregated=True, watermarked=True)
    return naive(appended(t, W.window_agg(events(t), "ts", "1 hour", n(), delay="10 minutes"), "closed"), *WINDOW)


@query("window_still_open", "T9e", f"SELECT * FROM {bucket_sql('1 HOUR')} WHERE NOT ({CLOSED('3 HOUR')})")
def window_still_open(t):
    everything = completed(t, W.window_agg(events(t), "ts", "1 hour", n()), "all")
    closed = appended(t, W.window_agg(events(t), "ts", "1 hour", n(), delay="3 hours"), "some")
    return naive(W.open_windows(everything, closed), *WINDOW)


@query(
    "window_two_keys",
    "T9f",
    f"SELECT * FROM {bucket_sql('1 DAY', 'user_id, event_type', f'COUNT(*) AS events, {MONEY}, MAX(value) AS top')} WHERE {CLOSED('1 HOUR')}",
)
def window_two_keys(t):
    keys = ["user_id", "event_type"]
    measures = n_total() | {"top": F.max("value")}
    return naive(appended(t, W.window_agg(events(t), "ts", "1 day", measures, keys, delay="1 hour"), "keys"), *WINDOW)


# -- joins with tables ----------------------------------------------------

ENRICH = f"SELECT event_id, user_id, value, {{columns}} FROM events {{how}} JOIN {CUSTOMERS_SQL} c ON user_id = customer_id {{where}}"


def people(t):
    return customers(t).withColumnRenamed("customer_id", "user_id")


@query("stream_static_inner", "T10 J13", ENRICH.format(columns="name, region, tier, balance", how="", where=""))
def stream_static_inner(t):
    return appended(t, J.stream_enrich(events(t).select("event_id", "user_id", "value"), people(t), "user_id"), "inner")


@query("stream_static_projected", "T11", ENRICH.format(columns="region", how="", where=""))
def stream_static_projected(t):
    stream = events(t).select("event_id", "user_id", "value")
    return appended(t, J.stream_enrich(stream, people(t), "user_id", columns=["region"]), "projected")


@query(
    "stream_static_left",
    "T12 J13",
    "SELECT event_id, user_id, value, COALESCE(name, 'Unknown') AS name FROM events LEFT JOIN (SELECT c_custkey, c_name AS name FROM customer WHERE c_acctbal > 2000) ON user_id = c_custkey",
)
def stream_static_left(t):
    stream = events(t).select("event_id", "user_id", "value")
    out = J.stream_enrich(stream, people(t), "user_id", "left", ["name"], "balance > 2000", {"name": "Unknown"})
    return appended(t, out, "left")


@query("stream_static_filtered", "T13 J8", ENRICH.format(columns="tier", how="", where="WHERE balance > 5000"))
def stream_static_filtered(t):
    stream = events(t).select("event_id", "user_id", "value")
    return appended(t, J.stream_enrich(stream, people(t), "user_id", columns=["tier"], where="balance > 5000"), "filtered")


@query(
    "stream_static_refreshed",
    "T14",
    "SELECT event_id, user_id, value, CASE WHEN event_type = 'click' THEN 'old' ELSE 'new' END AS label FROM events WHERE user_id IN (SELECT c_custkey FROM customer)",
)
def stream_static_refreshed(t):
    """The table changes between two runs of one query; the second run sees the new rows."""
    root = work_dir(t.spark, "refresh")
    staged = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    for label, part in (("old", "event_type = 'click'"), ("new", "event_type <> 'click'")):
        staged.where(part).write.mode("append").parquet(f"{root}/in")
        t.customer.select(F.col("c_custkey").alias("user_id"), F.lit(label).alias("label")).write.mode("overwrite").parquet(f"{root}/dim")
        stream = R.stream_table(t.spark, f"{root}/in").select("event_id", "user_id", "value")
        out = J.stream_enrich(stream, t.spark.read.parquet(f"{root}/dim"), "user_id")
        R.run_append(out, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table")


# -- joins of streams -----------------------------------------------------

UPPER = "90 days"
DELAYS = ("10 days 12 hours", "10 days 12 hours")
PAIR = "o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 90 DAY"
PAIR_COLUMNS = "o_orderkey, o_orderdate, l_orderkey, l_linenumber, l_partkey, l_shipdate"
MARK = "(SELECT LEAST((SELECT MAX(o_orderdate) FROM orders), (SELECT MAX(l_shipdate) FROM lineitem)) - INTERVAL '10 days 12 hours')"


ORDER_COLUMNS = ("o_orderkey", "o_orderdate")
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


def two_streams(t):
    return orders(t).select(*ORDER_COLUMNS), lines(t).select(*LINE_COLUMNS)


def joined(left, right, how, upper=UPPER):
    return J.interval_join(left, right, ("o_orderkey", "l_orderkey"), ("o_orderdate", "l_shipdate"), upper, DELAYS, how)


def pairs(t, how, name="pairs"):
    """Both tables in the order of time: the state of the join holds the bound, not the tables."""
    tables = [("orders", "o_orderdate", ORDER_COLUMNS), ("lineitem", "l_shipdate", LINE_COLUMNS)]
    return naive(replayed(t, name, tables, partial(joined, how=how)), "o_orderdate", "l_shipdate")


@query("stream_stream_watermarks", "T16 T15", f"SELECT {PAIR_COLUMNS} FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def stream_stream_watermarks(t):
    return naive(appended(t, joined(*two_streams(t), "inner", None), "pairs"), "o_orderdate", "l_shipdate")


@query("stream_stream_interval", "T17 J14", f"SELECT {PAIR_COLUMNS} FROM orders JOIN lineitem ON {PAIR}")
def stream_stream_interval(t):
    return pairs(t, "inner")


@query(
    "stream_stream_left",
    "T18",
    f"SELECT {PAIR_COLUMNS} FROM orders LEFT JOIN lineitem ON {PAIR} WHERE l_orderkey IS NOT NULL OR o_orderdate + INTERVAL 90 DAY < {MARK}",
)
def stream_stream_left(t):
    return pairs(t, "left_outer")


@query(
    "stream_stream_right",
    "T19",
    f"SELECT {PAIR_COLUMNS} FROM orders RIGHT JOIN lineitem ON {PAIR} WHERE o_orderkey IS NOT NULL OR l_shipdate < {MARK}",
)
def stream_stream_right(t):
    return pairs(t, "right_outer")


@query(
    "stream_stream_bounds",
    "T20",
    f"SELECT CAST(0 AS BIGINT) AS outside, COUNT(*) AS inside FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL {UPPER}",
)
def stream_stream_bounds(t):
    bound = J.time_bound("o_orderdate", "l_shipdate", UPPER)
    return pairs(t, "inner").agg(F.count(F.when(~bound, 1)).alias("outside"), F.count(F.when(bound, 1)).alias("inside"))


# -- micro-batch sinks ----------------------------------------------------


@query("batch_append", "T21 K11", "SELECT event_id, user_id, event_type, value FROM events")
def batch_append(t):
    root = work_dir(t.spark, "batches")
    stream = events(t).select("event_id", "user_id", "event_type", "value")
    B.stream_once(stream, f"{root}/table", f"{root}/checkpoint")
    return B.read_batches(t.spark, f"{root}/table").drop("batch_id")


def many_batches(t, root):
    """The events as a stream of four files, read one per batch."""
    t.events.withColumn("ts", F.col("ts").cast("timestamp")).repartition(4).write.parquet(f"{root}/in")
    return R.stream_table(t.spark, f"{root}/in", maxFilesPerTrigger=1)


LATEST = ["-ts", "-event_id"]


@query(
    "batch_upsert",
    "T22",
    "SELECT user_id, event_id, event_type, value, ts FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def batch_upsert(t):
    root = work_dir(t.spark, "upsert")
    stream = many_batches(t, root).select("user_id", "event_id", "event_type", "value", "ts")
    B.stream_upsert(stream, f"{root}/table", ["user_id"], LATEST, f"{root}/checkpoint")
    return naive(R.read_updates(t.spark, f"{root}/table", ["user_id"], LATEST), "ts")


@query(
    "batch_fanout",
    "T23",
    "SELECT 'all' AS sink, COUNT(*) AS rows FROM events UNION ALL SELECT 'purchases', COUNT(*) FROM events WHERE event_type = 'purchase'",
)
def batch_fanout(t):
    root = work_dir(t.spark, "fanout")
    sinks = {f"{root}/all": lambda b: b, f"{root}/purchases": lambda b: b.where("event_type = 'purchase'")}
    B.stream_fanout(events(t), sinks, f"{root}/checkpoint")
    counts = [
        t.spark.read.parquet(f"{root}/{s}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("sink"), "rows")
        for s in ("all", "purchases")
    ]
    return counts[0].unionByName(counts[1])


@query("batch_replayed_once", "T24", "SELECT event_id, value FROM events")
def batch_replayed_once(t):
    """A replay that cuts its batches as before replaces them: the rows stay single. For other cuts see the ledger."""
    root = work_dir(t.spark, "once")
    stream = events(t).select("event_id", "value")
    B.stream_once(stream, f"{root}/table", f"{root}/checkpoint")
    B.stream_once(stream, f"{root}/table", f"{root}/new-checkpoint")
    return B.read_batches(t.spark, f"{root}/table").drop("batch_id")


@query("ledger_lost_checkpoint", "T24 T29", "SELECT event_id, user_id, value FROM events")
def ledger_lost_checkpoint(t):
    """Two runs over a folder that grows, then the checkpoint is lost and one run reads all of it at once."""
    root = work_dir(t.spark, "ledger")
    columns = ("event_id", "user_id", "value", L.FILE, L.MODIFIED)

    def run(checkpoint, **options):
        stream = L.with_origin(R.stream_table(t.spark, f"{root}/in", **options)).select(*columns)
        L.stream_to_ledger(stream, f"{root}/sink", f"{root}/{checkpoint}")

    t.events.where("event_id % 3 = 0").repartition(3).write.parquet(f"{root}/in")
    run("first", maxFilesPerTrigger=1)
    t.events.where("event_id % 3 = 1").repartition(2).write.mode("append").parquet(f"{root}/in")
    run("first")
    t.events.where("event_id % 3 = 2").repartition(2).write.mode("append").parquet(f"{root}/in")
    run("second", maxFilesPerTrigger=4)
    return L.read_ledger(t.spark, f"{root}/sink").drop("load")


@query(
    "ledger_upsert_compacted",
    "T22 T27 T29",
    "SELECT user_id, event_id, event_type, value, ts FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def ledger_upsert_compacted(t):
    """Upserts in four batches, folded, removed loads, then the other half of the events on top of the base."""
    root = work_dir(t.spark, "folded")
    staged = t.events.withColumn("ts", F.col("ts").cast("timestamp"))

    def run():
        stream = L.with_origin(R.stream_table(t.spark, f"{root}/in", maxFilesPerTrigger=1))
        stream = stream.select("user_id", "event_id", "event_type", "value", "ts", L.FILE, L.MODIFIED)
        L.upsert_to_ledger(stream, f"{root}/sink", ["user_id"], LATEST, f"{root}/checkpoint")

    staged.where("event_id % 2 = 0").repartition(4).write.parquet(f"{root}/in")
    run()
    L.compact(t.spark, f"{root}/sink", ["user_id"], LATEST)
    L.vacuum(t.spark, f"{root}/sink")
    staged.where("event_id % 2 = 1").repartition(2).write.mode("append").parquet(f"{root}/in")
    run()
    return naive(L.read_upserts(t.spark, f"{root}/sink", ["user_id"], LATEST), "ts")


STREAM_RULES = [
    Rule("some_value", "value > 1", "drop"),
    Rule("no_error", "event_type <> 'error'", "drop"),
    Rule("dear", "value > 100"),
    Rule("has_user", "user_id is not null", "fail"),
]


@query("stream_expected_rows", "Q5 T25", "SELECT event_id, event_type, value FROM events WHERE value > 1 AND event_type <> 'error'")
def stream_expected_rows(t):
    root = work_dir(t.spark, "expected")
    E.run_expected(many_batches(t, root), STREAM_RULES, f"{root}/out", f"{root}/metrics", f"{root}/checkpoint")
    return B.read_batches(t.spark, f"{root}/out").select("event_id", "event_type", "value")


@query(
    "stream_expectation_counts",
    "Q5 T26",
    """SELECT rule, on_fail, CAST(4 AS BIGINT) AS batches, passed, total - passed AS failed FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (value > 1) AS a,
      COUNT(*) FILTER (event_type <> 'error') AS b, COUNT(*) FILTER (value > 100) AS c, COUNT(*) FILTER (user_id IS NOT NULL) AS d FROM events),
    LATERAL (VALUES ('some_value', 'drop', a), ('no_error', 'drop', b), ('dear', 'warn', c), ('has_user', 'fail', d)) x(rule, on_fail, passed)""",
)
def stream_expectation_counts(t):
    """Counts of every rule in every batch, added up over the batches."""
    root = work_dir(t.spark, "expected")
    E.run_expected(many_batches(t, root), STREAM_RULES, f"{root}/out", f"{root}/metrics", f"{root}/checkpoint")
    rows = B.read_batches(t.spark, f"{root}/metrics")
    sums = [F.sum(c).alias(c) for c in ("passed", "failed")]
    return rows.groupBy("rule", "on_fail").agg(F.count_distinct("batch_id").alias("batches"), *sums)


BAD = {"small_value": "value < 1", "error_event": "event_type = 'error'", "no_user": "user_id is null"}
BAD_SQL = "(value < 1 OR event_type = 'error')"


def routed(t, upsert=None):
    root = work_dir(t.spark, "route")
    B.stream_route(many_batches(t, root), BAD, f"{root}/good", f"{root}/bad", f"{root}/checkpoint", f"{root}/metrics", upsert)
    return root


@query(
    "batch_quarantine",
    "T25",
    f"""SELECT event_id, 'good' AS place, '' AS reasons FROM events WHERE NOT {BAD_SQL} UNION ALL
    SELECT event_id, 'bad', concat_ws(',', CASE WHEN value < 1 THEN 'small_value' END, CASE WHEN event_type = 'error' THEN 'error_event' END) FROM events WHERE {BAD_SQL}""",
)
def batch_quarantine(t):
    root = routed(t)
    good = t.spark.read.parquet(f"{root}/good").select("event_id", F.lit("good").alias("place"), F.lit("").alias("reasons"))
    bad = t.spark.read.parquet(f"{root}/bad").select("event_id", F.lit("bad").alias("place"), F.concat_ws(",", "reasons").alias("reasons"))
    return good.unionByName(bad)


@query(
    "batch_metrics",
    "T26",
    f"SELECT CAST(4 AS BIGINT) AS batches, COUNT(*) AS rows_in, COUNT(*) FILTER (NOT {BAD_SQL}) AS rows_good, COUNT(*) FILTER ({BAD_SQL}) AS rows_quarantined FROM events",
)
def batch_metrics(t):
    rows = B.read_batches(t.spark, f"{routed(t)}/metrics")
    return rows.agg(
        F.count_distinct("batch_id").alias("batches"),
        *[F.sum(c).alias(c) for c in ("rows_in", "rows_good", "rows_quarantined")],
    )


@query(
    "batch_upsert_and_quarantine",
    "T27",
    f"SELECT user_id, event_id, value FROM events WHERE NOT {BAD_SQL} QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def batch_upsert_and_quarantine(t):
    root = routed(t, (["user_id"], LATEST))
    return R.read_updates(t.spark, f"{root}/good", ["user_id"], LATEST).select("user_id", "event_id", "value")


@query("resume_from_checkpoint", "T28", "SELECT event_id, event_type FROM events")
def resume_from_checkpoint(t):
    root = work_dir(t.spark, "resume")
    for part in ("event_type = 'click'", "event_type <> 'click'", "false"):
        t.events.where(part).select("event_id", "event_type").write.mode("append").parquet(f"{root}/in")
        R.run_append(R.stream_table(t.spark, f"{root}/in"), f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table")


@query("window_state_resumes", "T30", f"SELECT * FROM {bucket_sql('1 DAY')} WHERE {CLOSED('1 HOUR')}")
def window_state_resumes(t):
    """Two runs of one windowed query: counts of a window add up across the restart."""
    root = work_dir(t.spark, "state")
    half = "ts < timestamp'2024-01-15 12:00:00'"
    staged = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    for part in (half, f"not ({half})"):
        staged.where(part).write.mode("append").parquet(f"{root}/in")
        counts = W.window_agg(R.stream_table(t.spark, f"{root}/in"), "ts", "1 day", n(), delay="1 hour")
        R.run_append(counts, f"{root}/table", f"{root}/checkpoint")
    return naive(t.spark.read.parquet(f"{root}/table"), *WINDOW)


@query("checkpoint_summary", "T31", "SELECT CAST(4 AS BIGINT) AS planned_batches, CAST(4 AS BIGINT) AS committed_batches, TRUE AS clean, COUNT(*) AS rows FROM events")
def checkpoint_summary(t):
    root = work_dir(t.spark, "inspect")
    R.run_append(many_batches(t, root), f"{root}/table", f"{root}/checkpoint")
    found = C.checkpoint_summary(t.spark, f"{root}/checkpoint").select("planned_batches", "committed_batches", "clean")
    rows = t.spark.read.parquet(f"{root}/table").count()
    return found.withColumn("rows", F.lit(rows).cast("bigint"))


@query(
    "velocity_spikes",
    "T32",
    f"SELECT *, txn_count > 5 AS is_velocity_spike FROM {bucket_sql('1 DAY', 'user_id', 'COUNT(*) AS txn_count')} WHERE {CLOSED('10 MINUTE')}",
)
def velocity_spikes(t):
    return naive(appended(t, W.velocity(events(t), "user_id", "ts", length="1 day"), "velocity"), *WINDOW)


@query(
    "rolling_amounts",
    "T33",
    """SELECT *, total_amount > 200 AS is_amount_threshold_exceeded FROM (SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, user_id,
      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount FROM (SELECT user_id, value,
        UNNEST(list_transform(range(12), lambda i: time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 5 MINUTE)) AS ws FROM events) GROUP BY ALL)
      WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""",
)
def rolling_amounts(t):
    def rule(stream):
        return W.amount_rule(stream, "user_id", "ts", "value", limit=200)

    # each event lies in twelve windows
    out = replayed(t, "amount", [("events", "ts", ("ts", "user_id", "value"))], rule, R.BYTES_PER_SLICE // 12)
    return naive(out, *WINDOW)


SIDES = {"East": ["ASIA", "MIDDLE EAST"], "West": ["AMERICA"]}


@query(
    "stream_enrich_activity",
    "T34 B12",
    f"""SELECT event_id, CAST(ts AS DATE) AS event_date, event_type AS action, user_id,
    CASE WHEN region IN ('ASIA', 'MIDDLE EAST') THEN 'East' WHEN region = 'AMERICA' THEN 'West' ELSE 'Central' END AS region, p_name, p_type, p_retailprice
    FROM events JOIN part ON p_partkey = CAST(json_extract(props, '$.k') AS INTEGER) LEFT JOIN {CUSTOMERS_SQL} c ON user_id = customer_id""",
)
def stream_enrich_activity(t):
    from ..plans.activity import enrich_activity

    stream = events(t).withColumn("product_id", F.from_json("props", "k BIGINT")["k"])
    products = t.part.select(F.col("p_partkey").alias("product_id"), "p_name", "p_type", "p_retailprice")
    located = people(t).select("user_id", F.col("region").alias("location"))
    out = enrich_activity(stream, products, located, P.categorize_udf(SIDES))
    return appended(t, out, "activity").drop("ts", "product_id")


@query(
    "stream_explode_lines",
    "N8",
    "SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def stream_explode_lines(t):
    from ..plans.sales import order_lines

    root = work_dir(t.spark, "orders")
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey as order_id", "o_custkey as customer_id", "l_partkey as product_id",
        "cast(cast(l_quantity as int) as string) as quantity", "cast(cast(l_extendedprice as decimal(10,2)) as string) as price", "l_linenumber",
    )
    nest(joined, ["order_id"], {"head": ["customer_id"]}, ["product_id", "quantity", "price"],
         ["l_linenumber", "product_id", "quantity", "price"], "line_items").select("order_id", "head.customer_id", "line_items").write.parquet(f"{root}/in")
    return appended(t, order_lines(R.stream_table(t.spark, f"{root}/in")), "lines")
