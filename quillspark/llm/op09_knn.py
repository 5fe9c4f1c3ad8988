"""Exact top-k search (operator 9): a Voronoi kNN join on inner products.

Queries and data are assigned to the nearest of `PIVOTS` pivots. Each cell is
summed up by count, radius and largest norm. For a query cell j and a data
cell i with pivots p and radii r, every inner product lies within
p_j.p_i -+ (r_j |p_i| + |q|max r_i); the k-th best lower bound of a query cell
is a floor under its answers, and a data cell whose upper bound is below the
floor is not needed. Query cells that need much the same data form blocks of
`BLOCK` queries (a larger cell makes several); a data cell is sent to the blocks
that need it only, and a query meets only the cells that its own cell needs.
They are solved there by exact matrix products.

Cells are cut into chunks of `CHUNK` vectors by a hash, so a task's memory is
bounded even if one vector makes up a third of the table. Each chunk sends k
rows per query to the final ranking. Pivots grow with the square root of the
rows, from `PIVOTS[0]` to `PIVOTS[1]`. What goes to the driver is the pivots and
one summary row per cell; the plan holds a row per block and cell that it needs.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows with a null id; of vectors of different lengths the
shorter counts as padded with zeros; rows that repeat an id are all
candidates, and as queries are asked once (the smallest vector); a query never
meets its own id; ties go to the smaller id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import materialize

PIVOTS, CHUNK, BLOCK = (48, 1024), 8192, 4096
#: Rows of the plan up to which it is broadcast.
BROADCAST_ROWS = 1_000_000
SCALE = 256


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, v): floor(SCALE * x) of each component, as little-endian doubles."""
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        lists = lists.cast(pa.large_list(pa.float64()))
        live = pc.and_(ids.is_valid(), lists.is_valid())
        ids, lists = ids.filter(live), lists.filter(live)
        flat = lists.flatten()
        x = np.floor(SCALE * flat.to_numpy(zero_copy_only=False).astype(np.float64))
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)) if len(lists) else np.empty(0, np.int64)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        keep = bad[ends] == bad[starts] if len(ends) else np.empty(0, bool)
        rows = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array([x[starts[i] : ends[i]].astype("<f8").tobytes() for i in rows], pa.binary())], names=["vec_id", "v"])


def _matrix(blobs, dim: int | None = None) -> np.ndarray:
    sizes = {len(b) for b in blobs}
    dim = max([*(s // 8 for s in sizes), dim or 0, 1])
    if sizes == {dim * 8}:
        return np.frombuffer(b"".join(blobs), "<f8").reshape(-1, dim)
    out = np.zeros((len(blobs), dim))
    for i, b in enumerate(blobs):
        out[i, : len(b) // 8] = np.frombuffer(b, "<f8")
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where that is exact."""
    if q.size and x.size and np.abs(q).max() * np.abs(x).max() * q.shape[1] >= 2.0**53:
        return q.astype(np.int64) @ x.astype(np.int64).T
    return (q @ x.T).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of each row: higher score first, then smaller id. ids are ascending."""
    n = scores.shape[1]
    if n > 4 * k:  # all columns that reach the k-th score, then the exact order among them
        floor = np.partition(scores, n - k, axis=1)[:, n - k]
        out = np.full((len(scores), k), -1, np.int64)
        for i, row in enumerate(scores):
            at = np.flatnonzero(row >= floor[i])
            out[i] = at[np.argsort(-row[at], kind="stable")[:k]]
        return out
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id divides by `every`."""
    spark = vectors.sparkSession
    numbers = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).mapInArrow(_numbers, "vec_id long, v binary")
    wanted = min(PIVOTS[1], max(PIVOTS[0], int(vectors.count() ** 0.5 / 8)))
    pivots = [bytes(r["v"]) for r in numbers.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(wanted).collect()]
    pivots = list(dict.fromkeys(pivots))
    schema = "query_id long, rank int, vec_id long, score long"
    if not pivots:
        return spark.createDataFrame([], schema)
    centre = _matrix(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix([b.as_py() for b in batch.column(1)], centre.shape[1]) if batch.num_rows else np.zeros((0, centre.shape[1]))
            c = np.pad(centre, ((0, 0), (0, x.shape[1] - centre.shape[1])))
            square = (x * x).sum(1)
            away = np.maximum(square[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :], 0)
            cell = away.argmin(1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(np.sqrt(away[np.arange(len(x)), cell])), pa.array(np.sqrt(square))], names=["vec_id", "v", "cell", "away", "norm"])

    cells = materialize(numbers.mapInArrow(assign, "vec_id long, v binary, cell int, away double, norm double"), "cells")
    asked = F.col("vec_id") % every == 0
    summary = cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("away").alias("radius"), F.count(F.when(asked, 1)).alias("nq"), F.max(F.when(asked, F.col("away"))).alias("rq"), F.max(F.when(asked, F.col("norm"))).alias("nrm")
    ).collect()  # one row per pivot
    if not any(s["nq"] for s in summary):
        return spark.createDataFrame([], schema)
    copies = cells.where(asked).groupBy("vec_id", "cell").agg(F.count("*").alias("n"))
    most = {r["cell"]: r["n"] for r in copies.groupBy("cell").agg(F.max("n").alias("n")).collect()}  # one row per pivot
    top = copies.groupBy("vec_id").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    need = _needed(summary, centre, k, most, top)
    cuts = {s["cell"]: -(-s["n"] // CHUNK) for s in summary}
    small = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df
    sizes = F.broadcast(spark.createDataFrame(list(cuts.items()), "cell int, chunks int"))
    planned = lambda name, lists: small(spark.createDataFrame(list(lists.items()), f"{name} int, cells array<int>").select(name, F.explode("cells").alias("cell")).join(sizes, "cell"), sum(map(len, lists.values())))
    places = planned("qcell", need)
    first, parts, sends = _blocks({s["cell"]: s["nq"] for s in summary}, need)
    own = spark.createDataFrame([(j, first[j], parts[j]) for j in need], "qcell int, first int, parts int")
    sent = planned("block", sends)
    queries = cells.where(asked).groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("x")).select(F.col("vec_id").alias("query_id"), F.col("x.v").alias("qv"), F.col("x.cell").alias("qcell"))
    block = (F.col("first") + F.pmod(F.xxhash64("query_id", F.lit(7)), F.col("parts"))).cast("int")
    queries = queries.join(F.broadcast(own), "qcell").withColumn("block", block).join(places, "qcell")
    queries = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("cell", "chunk", "block", "query_id", "qv")
    # A cell comes once for each block that needs it; its chunk is the same in all.
    data = cells.join(sent, "cell").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")).select("cell", "chunk", "block", "vec_id", "v")

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            dim = max(max(map(len, left["qv"])), max(map(len, right["v"]))) // 8
            x, ids = _matrix(list(right["v"]), dim), right["vec_id"].to_numpy()
            for i in range(0, len(left), 256):
                part = left.iloc[i : i + 256]
                scores = _products(_matrix(list(part["qv"]), dim), x)
                own = part["query_id"].to_numpy()[:, None] == ids[None, :]
                low = np.iinfo(np.int64).min
                scores = np.where(own, low, scores)
                best = _best(scores, ids, k)
                got = np.take_along_axis(scores, best, 1)
                real = (got != low).ravel()
                out.append(pd.DataFrame({"query_id": np.repeat(part["query_id"].to_numpy(), best.shape[1])[real], "vec_id": ids[best].ravel()[real], "score": got.ravel()[real]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0, np.int64)})

    keys = ["cell", "chunk", "block"]
    found = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _needed(summary, centre: np.ndarray, k: int, most: dict[int, int] | None = None, top: int = 1) -> dict[int, list[int]]:
    """For each cell with queries, the data cells that the bounds cannot rule out.

    A query never meets its own id, so a floor rests on the rows that are left
    without any one query's: `top` rows have the same query id at most, and
    `most` of them in each cell.
    """
    norm, dots = np.sqrt((centre * centre).sum(1)), centre @ centre.T
    cell = np.array([s["cell"] for s in summary])
    n, radius = np.array([s["n"] for s in summary]), np.array([s["radius"] for s in summary])
    same = np.array([top if most is None else most.get(c, 0) for c in cell.tolist()])
    out = {}
    for j in (s for s in summary if s["nq"]):
        at = dots[j["cell"], cell]
        wide = j["rq"] * norm[cell] + j["nrm"] * radius
        slack = 1e-6 * (1 + wide.max() + np.abs(dots).max())
        low = np.argsort(-(at - wide), kind="stable")
        enough = np.flatnonzero(np.cumsum(n[low]) - np.minimum(np.cumsum(same[low]), top) >= k)
        floor = (at - wide)[low[enough[0]]] - slack if len(enough) else -np.inf
        out[j["cell"]] = cell[at + wide + slack >= floor].tolist()
    return out


def _blocks(asked: dict[int, int], need: dict[int, list[int]]) -> tuple[dict[int, int], dict[int, int], dict[int, list[int]]]:
    """First block and number of blocks of each query cell, and the data cells that each block needs.

    Cells are taken in the order of what they need, so those that need the same lie together.
    """
    first, parts, sends = {}, {}, {}
    block, held, cells = 0, 0, set()
    for j in sorted(need, key=lambda c: (need[c], c)):
        if held and held + asked[j] > BLOCK:
            sends[block] = sorted(cells)
            block, held, cells = block + 1, 0, set()
        first[j], parts[j] = block, max(1, -(-asked[j] // BLOCK))
        held, cells = held + asked[j], cells | set(need[j])
        if parts[j] > 1:
            for _ in range(parts[j]):
                sends[block] = sorted(cells)
                block += 1
            held, cells = 0, set()
    if held:
        sends[block] = sorted(cells)
    return first, parts, sends
