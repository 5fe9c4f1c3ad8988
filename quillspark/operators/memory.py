"""Procedural memory: overused openings and exemplars, over an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import Settings
from quillspark.functions.text import opener, or_default


def prime(questions: DataFrame, personas: DataFrame) -> DataFrame:
    """Memory records of the stored questions that have an embedding, in order of question id."""
    meta = lambda n: or_default(F.col(f"json_metadata.{n}"), "unknown")
    joined = questions.where(F.col("embedding").isNotNull()).join(personas.select("persona_id", "json_metadata"), "persona_id")
    return joined.select(
        F.col("question_id").alias("seq"),
        F.col("embedding").alias("vec"),
        meta("profession").alias("profession"),
        meta("location").alias("region"),
        meta("pain_point").alias("topic"),
        F.col("question_text").alias("text"),
        F.coalesce("quality_score", F.lit(0.0)).cast("double").alias("score"),
        F.coalesce(F.nullif("opener", F.lit("")), opener(F.col("question_text"))).alias("opener"),
    )


def recent(memory: DataFrame, batch: DataFrame, cluster: list[str], most: int = 500, seq: str = "seq") -> DataFrame:
    """The last `most` records of each cluster that the batch touches: all that its rows may be compared with."""
    touched = memory.join(batch.select(*cluster).distinct(), cluster, "left_semi")
    rank = F.row_number().over(Window.partitionBy(*cluster).orderBy(F.desc(seq)))
    return touched.withColumn("__r", rank).where(F.col("__r") <= most).drop("__r")


def overused_openers(memory: DataFrame, cluster: list[str], top: int = 5, repeats: int = 2, seq: str = "seq") -> DataFrame:
    """The `top` most frequent openers of each cluster seen at least `repeats` times; ties to the first seen."""
    counted = memory.where(F.col("opener").isNotNull() & (F.col("opener") != "")).groupBy(*cluster, "opener").agg(F.count("*").alias("n"), F.min(seq).alias("first_seq")).where(F.col("n") >= repeats)
    rank = F.row_number().over(Window.partitionBy(*cluster).orderBy(F.desc("n"), "first_seq"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= top)


def tiered_exemplars(askers: DataFrame, bank: DataFrame, k: int = 3, key: str = "persona_id") -> DataFrame:
    """The k best exemplars for each asker: same profession first, then same region, then any; other topics only.

    Distinct profiles are answered, not askers, and a tier sees only profiles
    that the tiers before leave short of k. The bank is reduced first to what
    may be needed whatever a profile leaves out. A cell is a profession, a
    region and a topic; a profile leaves out one value of each that the tier
    does not fix. Of cells that agree in all but one value it leaves out one at
    most, so the k + 1 best are enough; of those that agree in one value and
    are left by that rule it leaves out k + 1 for each of the two others, so
    3k + 2 are enough; and 10k + 6 of all. So the last tier's side is of fixed size.
    """
    cols = ["profession", "region", "topic"]
    best = [F.desc("score"), F.col("seq")]
    profiles = askers.select(*cols).distinct()
    rows = bank.select(*[F.col(c).alias("b_" + c) for c in cols], "score", "seq", "text")

    def top(df: DataFrame, n: int, *group: str) -> DataFrame:
        return df.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(*best))).where(F.col("__r") <= n).drop("__r")

    rest = top(rows, k, "b_profession", "b_region", "b_topic")

    def reduced(cells: DataFrame, fixed: list[str], free: list[str]) -> DataFrame:
        """The cells that may be needed among those that agree in `fixed`, which holds no value that is left out."""
        for f in free:  # all but one free value agree
            cells = top(cells, k + 1, *fixed, *(x for x in free if x != f))
        if len(free) == 3:
            for f in free:
                cells = top(cells, 3 * k + 2, *fixed, f)
            return cells.orderBy(*best).limit(10 * k + 6)
        return top(cells, 3 * k + 2, *fixed) if len(free) == 2 else cells

    cells = top(rows.drop("text"), 1, "b_profession", "b_region", "b_topic")
    heads = top(top(rows.drop("text"), 1, "b_profession", "b_topic"), k + 1, "b_profession").select("b_profession", "b_topic")
    own = top(rows, k, "b_profession", "b_topic").join(heads, ["b_profession", "b_topic"], "left_semi")
    names = ["b_profession", "b_region", "b_topic"]
    within = lambda found: rest.join(found.select(*names), names, "left_semi")
    near = within(reduced(cells, ["b_region"], ["b_profession", "b_topic"]))
    far = F.broadcast(within(reduced(cells, [], names)))

    def tier(n: int, short: DataFrame, side: DataFrame, *tests) -> DataFrame:
        test = F.col("topic") != F.col("b_topic")
        for t in tests:
            test = test & t
        return short.join(side, test).select(*cols, F.lit(n).alias("tier"), "score", "seq", "text")

    def left_short(found: DataFrame) -> DataFrame:
        enough = found.groupBy(*cols).agg(F.count("*").alias("__n")).where(F.col("__n") >= k)
        return profiles.join(enough, cols, "left_anti")

    job, place = F.col("profession") == F.col("b_profession"), F.col("region") == F.col("b_region")
    found = tier(0, profiles, own, job)
    found = found.union(tier(1, left_short(found), near, place, ~job))
    found = found.union(tier(2, left_short(found), far, ~job, ~place))
    order = Window.partitionBy(*cols).orderBy("tier", *best)
    ranks = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return askers.select(key, *cols).join(ranks, cols).select(key, "tier", "score", "seq", "text", "rank")


def context(askers: DataFrame, memory: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """askers with `avoid_openers` and `exemplars`, both ordered arrays of text (empty if none)."""
    cluster = ["profession", "region"]
    openers = overused_openers(memory, cluster, settings.avoid_openers, settings.opener_min_repeats)
    listed = openers.groupBy(*cluster).agg(F.array_sort(F.collect_list(F.struct("rank", "opener"))).alias("__o")).withColumn("avoid_openers", F.transform("__o", lambda x: x["opener"])).drop("__o")
    bank = memory.where(F.col("score").cast("double") >= settings.exemplar_min_score)
    best = tiered_exemplars(askers, bank, settings.exemplars)
    texts = best.groupBy("persona_id").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("__e")).withColumn("exemplars", F.transform("__e", lambda x: x["text"])).drop("__e")
    none = F.array().cast("array<string>")
    return askers.join(listed, cluster, "left").join(texts, "persona_id", "left").withColumns({"avoid_openers": F.coalesce("avoid_openers", none), "exemplars": F.coalesce("exemplars", none)})
