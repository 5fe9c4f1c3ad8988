"""Helpers shared by the training-data operators.

Two families live here: small column builders for the operators that stay on
built-in functions, and a vectorised tokenizer over Arrow string buffers for
the operators that run in Arrow batches.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word separator of every contract in this package.
SEPARATORS = r"[\x20\x09-\x0D]+"

_SCRATCH: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, as spark.checkpoint.dir names it.

    Where the setting is absent a temporary folder is made once for the
    application, but only in local mode: on a cluster, executors would each
    write to a disk of their own, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = "file://" + tempfile.mkdtemp(prefix="quillspark-")
    return _SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quillspark/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    Lineage ends at the files, so a lost executor costs a re-read only, and
    the planner knows the size of what it joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables that `materialize` wrote, once nothing is to be computed from them again."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let the driver drop plans that nothing refers to, and with them the shuffle files of finished steps.

    Otherwise these stay until the driver's memory runs short, which a job of many steps on much disk may never see.
    """
    gc.collect()
    spark._jvm.System.gc()


def free_prefix(columns: list[str], wanted: str) -> str:
    """A prefix with which none of the columns begins, so that temporary names clash with none."""
    while any(c.lower().startswith(wanted) for c in columns):
        wanted = "_" + wanted
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def words_array(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` in order."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def row_digest(columns: list[str], text_col: str = "text") -> Column:
    """128-bit digest over all columns: only rows that agree in every one of them share it."""
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns if c != text_col]), {"ignoreNullFields": "false"}) if len(columns) > 1 else F.lit("")
    return F.md5(F.concat_ws("|", F.coalesce(F.md5(F.col(text_col)), F.lit("null")), rest))


# --- Arrow batches ---------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64; works in place on a uint64 array."""
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def hash_of(word: bytes) -> int:
    """The hash that `tokenize` gives to one word."""
    return int(tokenize(pa.array([word.decode()]))[0][0])


def tokenize(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and where each text's begin.

    Returns (hashes, offsets): text i has hashes[offsets[i]:offsets[i + 1]].
    Null texts have no words. Everything runs over the batch's own buffer, so
    the cost does not depend on the number of rows.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n or texts.buffers()[2] is None:
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    size = int(at[-1] - at[0])
    data = np.zeros(size + 8, np.uint8)
    data[:size] = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    inside[size:] = False
    first = inside.copy()
    cut = np.zeros(size + 8, bool)
    cut[at] = True
    first[1:] &= ~inside[:-1] | cut[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    length = end - begin
    eights = np.ndarray(shape=(size + 1,), dtype="<u8", buffer=data, strides=(1,))
    h = length.astype(np.uint64) * _GOLD + np.uint64(1)
    mix(h)
    h ^= eights[begin] & _MASKS[np.minimum(length, 8)]
    mix(h)
    live, done = np.flatnonzero(length > 8), 8
    while len(live):
        part = eights[begin[live] + done] & _MASKS[np.minimum(length[live] - done, 8)]
        h[live] = mix((h[live] * _GOLD) ^ part)
        done += 8
        live = live[length[live] > done]
    return h, np.searchsorted(begin, at).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has about `most` bytes of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < n:
            before = int(total[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
