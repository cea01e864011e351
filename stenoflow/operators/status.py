"""Status of work items from an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATES = ("pending", "downloading", "completed", "failed")

#: States of an alignment.
ALIGNMENT_STATES = (
    "initializing", "segmenting", "segmenting_complete", "transcribing", "transcribing_complete", "completed", "failed",
)
#: What may follow each state; None is before the first.  A failed item may begin again, an aligned one by force.
DOWNLOAD = {
    None: ("pending", "downloading"), "pending": ("downloading", "failed"), "downloading": ("completed", "failed"),
    "failed": ("pending", "downloading"), "completed": (),
}
ALIGNMENT = {
    None: ("initializing",), "initializing": ("segmenting", "failed"), "segmenting": ("segmenting_complete", "failed"),
    "segmenting_complete": ("transcribing", "failed"), "transcribing": ("transcribing_complete", "failed"),
    "transcribing_complete": ("completed", "failed"), "failed": ("initializing",), "completed": ("initializing",),
}


def may_follow(before: Column, after: Column, table: dict) -> Column:
    """Whether a transition is in the table; null before the first state."""
    tests = [(before.isNull() if a is None else before == a) & after.isin(*b) for a, b in table.items() if b]
    found = tests[0]
    for t in tests[1:]:
        found = found | t
    return F.coalesce(found, F.lit(False))


def transitions(events: DataFrame, table: dict, *, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """events with the state before, whether the step is legal, and the seconds until the next event of the item."""
    w = Window.partitionBy("item").orderBy(*order)
    before = F.lag("status").over(w)
    seconds = F.unix_timestamp(F.lead("ts").over(w)) - F.unix_timestamp("ts")
    return events.withColumn("before", before).withColumn("legal", may_follow(F.col("before"), F.col("status"), table)).withColumn("seconds", seconds)


def stage_durations(events: DataFrame, table: dict) -> DataFrame:
    """(item, status, times, illegal, seconds): visits of every state, illegal ones among them, and the time spent in it."""
    return transitions(events, table).groupBy("item", "status").agg(
        F.count("*").alias("times"), F.count_if(~F.col("legal")).alias("illegal"), F.coalesce(F.sum("seconds"), F.lit(0)).alias("seconds")
    )


def todo(items: DataFrame, seen: DataFrame, key: str, *, force: bool = False) -> DataFrame:
    """Items that are not among the seen ones; all of them by force."""
    return items if force else items.join(seen.select(key).distinct(), key, "left_anti")


def legal(events: DataFrame) -> DataFrame:
    """Events with a known status."""
    return events.where(F.col("status").isin(*STATES))


def latest(events: DataFrame) -> DataFrame:
    """Per item: latest status, attempts, and the last error; older events that come late change nothing."""
    at = F.struct("ts", "event_id")
    failed = F.col("status") == "failed"
    return legal(events).groupBy("item").agg(
        F.max_by("status", at).alias("status"), F.max("ts").alias("ts"),
        F.count_if(F.col("status") == "downloading").alias("attempts"),
        F.max_by(F.when(failed, F.col("error")), F.when(failed, at)).alias("last_error"),
    )


def error_history(events: DataFrame) -> DataFrame:
    """Per item with errors: their list in order."""
    row = F.struct("ts", "event_id", "error")
    return legal(events).where("status = 'failed'").groupBy("item").agg(F.sort_array(F.collect_list(row)).alias("history"))


#: What a group's rows add up to: counters, and the first and last time.
TOTALS = ("total", "completed", "failed", "a", "b")


def progress(groups: DataFrame, group: str = "parliament") -> DataFrame:
    """Counters, success rate and remaining seconds of every group and of all, from (group, total, completed, failed, a, b)."""
    p = groups.rollup(group).agg(
        F.sum("total").alias("total"), F.sum("completed").alias("completed"), F.sum("failed").alias("failed"), F.min("a").alias("a"), F.max("b").alias("b"))
    spent = F.unix_timestamp("b") - F.unix_timestamp("a")
    return p.select(group, "total", "completed", "failed", F.round(F.try_divide(100.0 * F.col("completed"), F.col("completed") + F.col("failed")), 4).alias("success_rate"),
                    F.round(F.try_divide(spent, F.col("completed").cast("double")) * (F.col("total") - F.col("completed")), 2).alias("eta_seconds"))
