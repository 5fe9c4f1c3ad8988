"""Exact and near duplicates among generated texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import dot
from quillspark.sources.store import saved, scratch


def exact_duplicates(df: DataFrame, hash_col: str, order: list[str], scope: list[str] | None = None) -> DataFrame:
    """df with `duplicate`: an earlier row of the same scope has the same hash.

    Computed from the least order key per hash, so a hash that a third of the
    rows share costs one partial aggregate and a join, not one sorted task. df is
    read twice: save it first if its hashes are yet to be computed.
    """
    keys = [*(scope or []), hash_col]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__first"))
    return df.join(first, keys, "left").withColumn("duplicate", F.coalesce(F.struct(*order) != F.col("__first"), F.lit(False))).drop("__first")


def places(rows: DataFrame, cluster: list[str], seq: str, path: str) -> DataFrame:
    """(cluster, seq, __place): the place from 0 of each record in its cluster, by order of seq.

    Keys alone are sorted, by range partitions, so a cluster of any size is
    spread; they are kept under `path`, as a second sort might cut elsewhere.
    """
    keys = rows.select(*cluster, seq).repartitionByRange(*cluster, seq).withColumn("__part", F.spark_partition_id())
    keys.write.parquet(path)
    keys = rows.sparkSession.read.parquet(path)
    counts = keys.groupBy(*cluster, "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*cluster).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(cluster)], F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"))
    same = F.col("__part") == F.col("__p")
    for i, c in enumerate(cluster):
        same = same & F.col(c).eqNullSafe(F.col(f"__c{i}"))
    within = F.row_number().over(Window.partitionBy(*cluster, "__part").orderBy(seq)) - 1
    return keys.withColumn("__within", within).join(counts, same).select(*cluster, seq, (F.col("__before") + F.col("__within")).alias("__place"))


def near_duplicates(rows: DataFrame, cluster: list[str], seq: str, vec: str, threshold: float = 0.92, recent: int = 500) -> DataFrame:
    """rows with `near_dup`: one of the `recent` records before it in its cluster is within the threshold.

    Recency is a bound on places: record n meets records n-recent .. n-1 of its
    cluster (null vectors take a place, then match nothing). `seq` tells records
    apart. Places are found over the keys alone, then cut into blocks of
    `recent`; a record meets only its own block and the one before, so a cluster
    of any size is spread over many tasks.
    """
    place = places(rows, cluster, seq, scratch(rows.sparkSession, "places")).select(F.col(seq).alias("__seq"), "__place")
    placed = rows.where(F.col(vec).isNotNull()).join(place, F.col(seq) == F.col("__seq")).withColumn("__block", F.floor(F.col("__place") / recent))
    left = placed.select(*cluster, seq, F.col(vec).alias("__a"), F.col("__place").alias("__pa"), F.explode(F.array(F.col("__block"), F.col("__block") - 1)).alias("__block"))
    right = placed.select(*cluster, F.col(vec).alias("__b"), F.col("__place").alias("__pb"), "__block")
    near = left.join(right, [*cluster, "__block"]).where((F.col("__pb") < F.col("__pa")) & (F.col("__pb") >= F.col("__pa") - recent)).where(dot(F.col("__a"), F.col("__b")) >= threshold)
    hits = near.select(seq).distinct().withColumn("near_dup", F.lit(True))
    return rows.join(hits, seq, "left").withColumn("near_dup", F.coalesce("near_dup", F.lit(False)))


def similar_pairs(rows: DataFrame, cluster: list[str], seq: str, vec: str, threshold: float, block: int = 8192) -> DataFrame:
    """(first, second, similarity) of the pairs of a cluster at or above the threshold.

    All pairs are met. A cluster is dealt into blocks of about `block` rows, at
    random and written down, so rows that repeat are spread too; two blocks make
    a group, whose candidates come from a matrix product and are then summed up
    as `dot` does. A group holds 2 * `block` vectors and slices of the rest.
    """
    live = rows.where(F.col(seq).isNotNull() & F.col(vec).isNotNull())
    cells = [F.col(c).alias(f"__c{i}") for i, c in enumerate(cluster)]
    keys = [f"__c{i}" for i in range(len(cluster))]
    slim = live.select(*cells, F.col(seq).alias("first"), F.col(vec).cast("array<double>").alias("__v"))
    blocks = slim.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("__blocks"))
    placed = saved(slim.join(blocks, keys).withColumn("__block", F.floor(F.rand(7) * F.col("__blocks")).cast("int")), "blocks")
    met = placed.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    met = met.select(*keys, F.least("__block", "__other").alias("__i"), F.greatest("__block", "__other").alias("__j"), "__block", "first", "__v")
    types = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), f"first {types['first']}", f"second {types['first']}", "similarity double"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        lists = table.column("__v").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        whole = np.ones(len(lists), bool)
        if lists.values.null_count:  # a product with null is null
            whole = ~np.array(pc.is_in(pa.array(np.arange(len(lists))), pc.list_parent_indices(lists).filter(pc.is_null(lists.flatten()))))
        rank = pc.rank(table.column("first"), tiebreaker="dense").to_numpy()
        own, low = table.column("__block").to_numpy(), table.column("__i")[0].as_py()
        same = low == table.column("__j")[0].as_py()
        for dim in np.unique(sizes[whole]).tolist():  # vectors of different lengths have no product
            at = np.flatnonzero(whole & (sizes == dim))
            x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
            left = at == at if same else own[at] == low
            right = left if same else ~left
            for a, b, s in _close(x[left], rank[at[left]], x[right], rank[at[right]], threshold, same):
                a, b = at[left][a], at[right][b]
                swap = rank[a] > rank[b]
                first, second = pa.array(np.where(swap, b, a)), pa.array(np.where(swap, a, b))
                columns = [table.column(k).take(first).combine_chunks() for k in keys] + [table.column("first").take(i).combine_chunks() for i in (first, second)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(s)], names=[*keys, "first", "second", "similarity"])

    found = met.groupBy(*keys, "__i", "__j").applyInArrow(solve, schema)
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, cluster)], "first", "second", "similarity")


def _close(x: np.ndarray, xr: np.ndarray, y: np.ndarray, yr: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in x, places in y, product) at or above the threshold (NaN is above all), but of equal ranks; of x with itself each pair once.

    The matrix product only rules pairs out, by more than both sums can err:
    which pairs stay is settled by sums from left to right.
    """
    if not len(x) or not len(y):
        return
    dim, step = x.shape[1], max(1, 2**22 // len(y))
    with np.errstate(all="ignore"):
        xn, yn = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
        sure = np.isfinite(yn)
        err = 4 * (dim + 2) * np.finfo(float).eps * (xn * yn[sure].max(initial=0.0)) + np.finfo(float).tiny
        xt, yt = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
        for at in range(0, len(x), step):
            keep = ~(x[at : at + step] @ yt < (threshold - err[at : at + step])[:, None])
            keep |= ~sure[None, :]
            ranks = xr[at : at + step][:, None]
            keep &= ranks < yr[None, :] if same else ranks != yr[None, :]
            a, b = np.nonzero(keep)
            for i in range(0, len(a), 2**18):
                p, q = a[i : i + 2**18] + at, b[i : i + 2**18]
                s = np.zeros(len(p))
                for d in range(dim):
                    s += xt[d][p] * yt[d][q]
                hit = (s >= threshold) | np.isnan(s)
                if hit.any():
                    yield p[hit], q[hit], s[hit]


def mean_pairwise_cosine(rows: DataFrame, cluster: list[str], vec: str, dim: int) -> DataFrame:
    """Mean cosine over all pairs of a cluster of unit vectors, without making a pair.

    The sum over pairs is (|sum of vectors|^2 - sum of |vector|^2) / 2.
    """
    parts = [F.sum(F.get(vec, F.lit(i)).cast("double")).alias(f"__s{i}") for i in range(dim)]
    sums = rows.where(F.col(vec).isNotNull()).groupBy(*cluster).agg(F.count("*").alias("n"), F.sum(dot(F.col(vec), F.col(vec))).alias("__own"), *parts)
    square: Column = sum((F.col(f"__s{i}") * F.col(f"__s{i}") for i in range(dim)), F.lit(0.0))
    mean = F.when(F.col("n") > 1, (square - F.col("__own")) / (F.col("n") * (F.col("n") - 1)))
    return sums.select(*cluster, "n", mean.alias("mean_cosine"))
