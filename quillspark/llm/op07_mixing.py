"""Mixing to target weights (operator 7): a time-varying curriculum.

Sources get the weights 5, 2, 1 in turn; targets share all words by weight and
stop at three times a source's own words, the excess going to the rest. The
water level is found by repeated aggregates over the table of sources, until
no further source is over its cap. Within a source the documents lie end to
end in a fixed pseudo-random order, pass after pass; a copy is taken if its
middle lies before the target, so a source misses its target by half a
document at most.

Each weight class has a schedule over training time. Its integral is the
cumulative demand; inverting the demand at a copy's middle gives the copy's
training position, by which documents are range-sorted.

The order needs prefix sums within a source, and one source may hold a third
of all rows. They are taken level by level over prefixes of a hash of id and
text: no window partition holds more than 4,096 sums or a few thousand rows,
whatever the source. Rows that are alike are counted first and dealt out again
after the sums, so that repeated rows or null ids fill no leaf. Sources are
ranked by range partitions, as they may be millions. Texts are read once for
their word counts and never shuffled by `mix_documents`; `mix_rows` shuffles
them twice, to find their positions and to sort by these.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own and comes last; repeated rows are alike, so either may come
first, and each may be taken; rows that differ in any column are told apart;
an empty table gives an empty result; other columns, whatever their names, are
ignored by `mix_documents` and passed through by `mix_rows`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import free_prefix, materialize, row_digest, text_or_empty, words_array

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Weight -> knots (time, rate) of its schedule, linear in between; rates are relative.
SCHEDULES = {5: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 1: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}
#: Rows in a leaf of the prefix sums, about.
LEAF_ROWS = 2000


def position_of(share: Column, weight: Column, schedules=SCHEDULES) -> Column:
    """Time at which a source of this weight has used up `share` of its demand."""
    out = F.lit(None).cast("double")
    for w, knots in sorted(schedules.items()):
        parts = [(t0, t1, r0, r1, (t1 - t0) * (r0 + r1) / 2) for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        whole, done, at = sum(p[4] for p in parts), 0.0, None
        for t0, t1, r0, r1, area in parts:
            rest, bend = share * F.lit(whole) - F.lit(done), (r1 - r0) / (t1 - t0)
            here = F.lit(t0) + (rest / F.lit(r0) if bend == 0 else (F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * bend) * rest, F.lit(0.0))) - F.lit(r0)) / F.lit(bend))
            done += area
            at = F.when(share * F.lit(whole) < F.lit(done), here) if at is None else at.when(share * F.lit(whole) < F.lit(done), here)
        out = F.when(weight == w, at.otherwise(F.lit(1.0))).otherwise(out)
    return out


def _ranked(sums: DataFrame) -> DataFrame:
    """sums with `place`: the rank of each source (from 0, null last), by range partitions."""
    spread = sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    spread = materialize(spread, "sources")
    counts = {r["part"]: r["n"] for r in spread.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row per partition
    starts, at = [(-1, 0)], 0
    for part in sorted(counts):
        starts.append((part, at))
        at += counts[part]
    first = F.broadcast(sums.sparkSession.createDataFrame(starts, "part int, first long"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return spread.withColumn("within", within).join(first, "part").withColumn("place", F.col("first") + F.col("within") - 1).drop("part", "within", "first")


def source_targets(digest: DataFrame) -> DataFrame:
    """skey, source_size, weight, target; one row per source."""
    sums = _ranked(digest.groupBy("skey").agg(F.min("source").alias("source"), F.sum("words").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.col("place"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    cap = F.lit(MOST_COPIES) * F.col("source_size")
    sums = materialize(sums.select("skey", "source_size", weight.alias("weight"), cap.alias("cap"), (cap / weight).alias("fill")), "weights")
    level, before = 0.0, -1.0
    while level != before:  # sources whose cap lies below the level are settled, which lifts it for the others
        over = F.col("fill") < F.lit(level)
        left = sums.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("cap"))).alias("settled"), F.sum(F.when(~over, F.col("weight"))).alias("parts")).first()
        level, before = ((left["all"] or 0) - (left["settled"] or 0)) / (left["parts"] or 1), level
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return sums.select("skey", "source_size", "weight", target.alias("target"))


def _digest(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """One row per kind of row, with its number: doc_id, source, size, hash, skey (and key); words are those of all."""
    text = text_or_empty()
    cols = [F.col("doc_id"), F.col("source"), F.size(words_array(text)).cast("long").alias("size")]
    cols.append(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))).alias("hash"))
    cols.append(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))).alias("skey"))
    if key is not None:
        cols.append(key.alias("key"))
    out = docs.select(*cols)
    return out.groupBy(*out.columns).agg(F.count("*").alias("alike")).withColumn("words", F.col("size") * F.col("alike"))


def _before(digest: DataFrame, rows: int, targets: DataFrame) -> DataFrame:
    """digest with `before`, the words of its source that come earlier in the order of hash, id and size, and its source's target."""
    depth = max(1, math.ceil(math.log(max(rows / LEAF_ROWS, 1.0), 16)))
    levels = [*range(3, depth, 3), depth]
    prefix = lambda d: F.substring("hash", 1, d)
    offsets, upper = None, 0
    for d in levels:
        sums = digest.groupBy("skey", prefix(d).alias("leaf")).agg(F.sum("words").alias("words"))
        sums = sums.withColumn("up", F.substring("leaf", 1, upper))
        running = Window.partitionBy("skey", "up").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("start", F.coalesce(F.sum("words").over(running), F.lit(0)))
        if offsets is not None:
            sums = sums.join(offsets, ["skey", "up"]).withColumn("start", F.col("start") + F.col("base"))
        offsets, upper = sums.select("skey", F.col("leaf").alias("up"), F.col("start").alias("base")), d
    # Targets go to the leaves, not to the rows, so no row is joined by its source.
    leaves = materialize(offsets, "leaves").join(targets, "skey")
    within = Window.partitionBy("skey", "up").orderBy("hash", "doc_id", "size", *(["key"] if "key" in digest.columns else [])).rowsBetween(Window.unboundedPreceding, -1)
    rows_ = digest.withColumn("up", prefix(depth)).withColumn("inner", F.coalesce(F.sum("words").over(within), F.lit(0)))
    return rows_.join(leaves, ["skey", "up"]).withColumn("before", F.col("base") + F.col("inner"))


def _mixed(docs: DataFrame, key: Column | None = None) -> DataFrame:
    digest = materialize(_digest(docs, key), "sizes")
    targets = materialize(source_targets(digest), "targets")
    out = _before(digest, digest.count(), targets)
    out = out.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("alike") - 1))).withColumn("before", F.col("before") + F.col("nth") * F.col("size"))
    middle = lambda e: F.lit(e) * F.col("source_size") + F.col("before") + F.col("size") / F.lit(2.0)
    taken = [F.when((F.col("size") > 0) & (middle(e) < F.col("target")), position_of(middle(e) / F.col("target"), F.col("weight"))) for e in range(MOST_COPIES)]
    return out.withColumn("positions", F.filter(F.array(*taken), lambda x: x.isNotNull()))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, first_position (millionths), by position."""
    first = F.get("positions", F.lit(0))
    out = _mixed(docs).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("positions")).alias("taken"),
        F.size("positions").cast("long").alias("copies"),
        F.floor(F.lit(1e6) * first).alias("first_position"),
        first.alias("at"),
    )
    return out.orderBy(F.col("at").asc_nulls_last(), "doc_id").drop("at")


def mix_rows(docs: DataFrame) -> DataFrame:
    """The copies that the mix takes, with docs' own columns, range-sorted by training position."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    tmp = free_prefix(docs.columns, "mx_")
    digest = row_digest(docs.columns)
    mixed = materialize(_mixed(docs, digest).select("key", "alike", "positions"), "mixed")
    places = mixed.where(F.size("positions") > 0).select(F.col("key").alias(tmp + "key"), "alike", F.explode("positions").alias(tmp + "at"))
    keyed = docs.withColumn(tmp + "key", digest)
    at = lambda rows, wanted: rows.join(wanted.select(tmp + "key", tmp + "at"), tmp + "key")
    out = at(keyed, places.where("alike = 1"))
    many = mixed.where("alike > 1").select(F.col("key").alias(tmp + "key")).distinct()
    if not many.isEmpty():  # repeated rows: one of each stands for all
        once = keyed.join(many, tmp + "key", "left_semi").dropDuplicates([tmp + "key"])
        out = out.union(at(once, places.where("alike > 1")))
    return out.orderBy(tmp + "at", tmp + "key").select(*own)
