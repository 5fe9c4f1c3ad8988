"""The best of several attempts, and a state table as a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_attempt(attempts: DataFrame, key: str, passed: str, ratio: str, attempt_no: str, carry: list[str]) -> DataFrame:
    """Per key the attempt with the greatest (passed, ratio); the earliest wins ties. One aggregate, no window."""
    rank = F.struct(F.col(passed).cast("int").alias("p"), F.col(ratio).alias("r"), (-F.col(attempt_no)).alias("n"), *[F.col(c) for c in carry])
    best = attempts.groupBy(key).agg(F.max(rank).alias("b"))
    return best.select(key, (F.col("b.p") == 1).alias(passed), F.col("b.r").alias(ratio), (-F.col("b.n")).alias(attempt_no), *[F.col(f"b.{c}").alias(c) for c in carry])


def latest_status(log: DataFrame, key: str = "persona_id", seq: str = "seq") -> DataFrame:
    """The last row of each key of an append-only log."""
    rest = [c for c in log.columns if c not in (key, seq)]
    last = log.groupBy(key).agg(F.max(F.struct(seq, *rest)).alias("x"))
    return last.select(key, "x.*")


def pending(personas: DataFrame, log: DataFrame, live_runs: tuple[str, ...] = ()) -> DataFrame:
    """Personas to work on: without a status, pending, or left processing by a run that is gone."""
    now = latest_status(log)
    joined = personas.join(now.select("persona_id", F.col("status").alias("__s"), F.col("run_id").alias("__r"), F.col("attempts").alias("__n")), "persona_id", "left")
    gone = (F.col("__s") == "processing") & (~F.coalesce(F.col("__r").isin(list(live_runs)), F.lit(False)) if live_runs else F.lit(True))
    return joined.where(F.col("__s").isNull() | (F.col("__s") == "pending") | gone).withColumn("attempts", F.coalesce("__n", F.lit(0))).drop("__s", "__r", "__n")


def claim(pending_rows: DataFrame, size: int, key: str = "persona_id") -> DataFrame:
    """The next batch, in order of key."""
    return pending_rows.orderBy(key).limit(size)


def after_failure(failed: DataFrame, max_attempts: int = 3) -> DataFrame:
    """(persona_id, attempts, status): one attempt more, then pending again or failed for good."""
    n = F.coalesce("attempts", F.lit(0)) + 1
    return failed.withColumn("attempts", n).withColumn("status", F.when(F.col("attempts") >= max_attempts, "failed").otherwise("pending"))


def save_once(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of new whose key is neither in existing nor repeated (the row with the least values stays)."""
    rest = [c for c in new.columns if c != key]
    first = new.groupBy(key).agg(F.min(F.struct(*rest)).alias("x")).select(key, "x.*")
    return first.join(existing.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key the parent table lacks: the check that stands in for a foreign key."""
    return child.join(parent.select(key), key, "left_anti")
