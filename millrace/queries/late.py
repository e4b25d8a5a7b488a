"""Late rows: sources that drip in by parts, with rows behind the watermark.

Each part is appended to a folder and the query goes on from its checkpoint, so
the watermark of one part judges the rows of the next.
"""

from functools import partial

from pyspark.sql import functions as F

from ..operators.windows import top_n
from ..session import work_dir
from ..streaming import checkpoints as C
from ..streaming import joins as J
from ..streaming import runner as R
from ..streaming import windows as W
from .registry import query as registered
from .streams import CLOSED, WINDOW, bucket_sql, n, naive

query = partial(registered, streaming=True)


def dripped(t, name, parts, build):
    """Run ``build(stream)`` once per part; its sink, and the query of each run."""
    root, runs = work_dir(t.spark, name), []
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        runs.append(R.run_append(build(R.stream_table(t.spark, f"{root}/in")), f"{root}/table", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/table"), runs


def staged(t):
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


LATE = "(event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-15')"


def parts_with_late_rows(t):
    """The first half but for one row in ten, the second half, then the rows held back."""
    rows = staged(t)
    return rows.where(f"ts < timestamp'2024-01-15' and not {LATE}"), rows.where("ts >= timestamp'2024-01-15'"), rows.where(LATE)


@query("late_rows_dropped", "T9 T9d T30", f"SELECT * FROM {bucket_sql('1 DAY', 'event_type', where=f'NOT {LATE}')} WHERE {CLOSED('1 HOUR')}")
def late_rows_dropped(t):
    """Rows of closed days arrive last: they change no count."""
    out, _ = dripped(t, "late", parts_with_late_rows(t), lambda s: W.window_agg(s, "ts", "1 day", n(), ["event_type"], delay="1 hour"))
    return naive(out, *WINDOW)


@query("late_rows_counted", "T9 T4", f"SELECT * FROM {bucket_sql('1 DAY', 'event_type')} WHERE window_end <= TIMESTAMP '2024-01-14'")
def late_rows_counted(t):
    """With a delay longer than they are late, the same rows count."""
    first, second, late = parts_with_late_rows(t)
    closer = t.spark.createDataFrame([(-1, "closer")], "event_id long, event_type string").withColumn("ts", F.lit("2025-06-01").cast("timestamp"))
    parts = (first, second, late, second.limit(0).unionByName(closer, allowMissingColumns=True))
    out, _ = dripped(t, "late", parts, lambda s: W.window_agg(s, "ts", "1 day", n(), ["event_type"], delay="60 days"))
    return naive(out, *WINDOW).where("window_end <= timestamp_ntz'2024-01-14 00:00:00'")


FIRST = "SELECT user_id, event_id, ts FROM events WHERE {0} QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"
EARLY, AFTER = "ts < TIMESTAMP '2024-01-08'", "ts >= TIMESTAMP '2024-01-21'"


@query("late_repeat_kept", "T8 T7", f"SELECT * FROM ({FIRST.format(EARLY)}) UNION ALL SELECT * FROM ({FIRST.format(AFTER)})")
def late_repeat_kept(t):
    """A user's next event within five days is a repeat and goes; weeks later, when its state is evicted, it is kept."""
    rows = staged(t).select("user_id", "event_id", "ts")
    early, after = (rows.where(w.replace("TIMESTAMP ", "timestamp")) for w in (EARLY, AFTER))
    first = lambda df: top_n(df, ["user_id"], ["ts", "event_id"], 1)
    again = early.join(first(early), ["user_id", "event_id", "ts"], "left_anti")
    clock = t.spark.createDataFrame([(-1, -1)], "user_id long, event_id long").withColumn("ts", F.lit("2024-01-20").cast("timestamp"))
    clock = clock.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema])
    out, _ = dripped(t, "late", (first(early), again, clock, first(after)), lambda s: W.stream_dedup_within(s, ["user_id"], "ts", "5 days"))
    return naive(out.where("user_id >= 0"), "ts")


@query(
    "late_state_metrics",
    "T7 T5 T30",
    f"""SELECT COUNT(*) AS rows_in, COUNT(*) FILTER ({LATE}) AS rows_late, COUNT(*) FILTER (NOT {LATE} AND ts <= m - INTERVAL 1 DAY) AS rows_evicted,
    COUNT(*) FILTER (NOT {LATE} AND ts > m - INTERVAL 1 DAY) AS rows_in_state FROM events, (SELECT MAX(ts) AS m FROM events)""",
)
def late_state_metrics(t):
    """What the state of a deduplication went through: rows too late for it, rows evicted, rows it still holds."""
    _, runs = dripped(t, "late", parts_with_late_rows(t), lambda s: W.stream_dedup(s.select("event_id", "ts"), ["event_id", "ts"], "ts", "1 day"))
    rows = C.state_rows(t.spark, runs)
    last = F.struct("run", "batch_id")
    return rows.agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_late").alias("rows_late"), F.sum("rows_evicted").alias("rows_evicted"),
        F.max_by("rows_in_state", last).alias("rows_in_state"),
    )


@query(
    "late_pairs",
    "T18 T19 T17",
    """WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), b AS (SELECT * FROM events WHERE event_type = 'purchase'),
    m AS (SELECT LEAST((SELECT MAX(ts) FROM l), (SELECT MAX(ts) FROM b WHERE event_id % 5 <> 0)) - INTERVAL 10 MINUTE AS mark),
    r AS (SELECT event_id AS other, user_id AS who, ts AS bought FROM b, m WHERE event_id % 5 <> 0 OR ts > mark),
    p AS (SELECT event_id, other FROM l JOIN r ON user_id = who AND bought BETWEEN ts AND ts + INTERVAL 2 HOUR)
    SELECT event_id, other FROM p UNION ALL SELECT event_id, NULL FROM l WHERE event_id NOT IN (SELECT event_id FROM p) AND ts < TIMESTAMP '2024-01-15'""",
)
def late_pairs(t):
    """Clicks with their purchases, left outer; one purchase in five comes when its clicks are long given up."""
    root = work_dir(t.spark, "late")
    rows = staged(t)
    clicks = rows.where("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = rows.where("event_type = 'purchase'").select(F.col("event_id").alias("other"), F.col("user_id").alias("who"), F.col("ts").alias("at"))
    half = "timestamp'2024-01-15'"
    parts = [
        (clicks.where(f"ts < {half}"), bought.where(f"at < {half} and other % 5 <> 0")),
        (clicks.where(f"ts >= {half}"), bought.where(f"at >= {half} and other % 5 <> 0")),
        (clicks.limit(0), bought.where("other % 5 = 0")),
    ]
    for left, right in parts:
        left.write.mode("append").parquet(f"{root}/left")
        right.write.mode("append").parquet(f"{root}/right")
        joined = J.interval_join(
            R.stream_table(t.spark, f"{root}/left"), R.stream_table(t.spark, f"{root}/right"), ("user_id", "who"), ("ts", "at"), "2 hours", how="left_outer"
        )
        R.run_append(joined, f"{root}/table", f"{root}/checkpoint")
    out = t.spark.read.schema(joined.schema).parquet(f"{root}/table")
    return out.where(f"other is not null or ts < {half}").select("event_id", "other")
