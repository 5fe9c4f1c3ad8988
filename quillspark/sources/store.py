"""Tables in a folder: parquet batches keyed by run and batch, CSV mirrors, vectors as bytes.

Parquet has no UPDATE, so states are an append-only log and a batch is a
folder: writing a batch again replaces that folder, which makes commits
idempotent. A lock file keeps two drivers from claiming the same rows; it is as
exclusive as the file system's creation of files (HDFS: fully). All paths go through Spark's file systems.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import time
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas

TABLES = {"personas": schemas.PERSONAS, "questions": schemas.QUESTIONS, "evaluations": schemas.EVALUATIONS, "memory": schemas.MEMORY, "status_log": schemas.STATUS_LOG}


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.exists(p) and len(fs.listStatus(p)) > 0

    def read(self, table: str, but: tuple[str, int] | None = None) -> DataFrame:
        """All committed batches of a table, in its schema; empty if there are none. `but`: a run's batch to leave out."""
        if not self._exists(self.path(table)):
            return self.spark.createDataFrame([], TABLES[table])
        df = self.spark.read.option("mergeSchema", "true").parquet(self.path(table))
        if but is not None and {"_run", "_batch"} <= set(df.columns):
            df = df.where((F.col("_run").cast("string") != but[0]) | (F.col("_batch") != but[1]))
        return schemas.migrate(df, TABLES[table])

    def batch_path(self, table: str, run_id: str, batch_id: int) -> str:
        return f"{self.path(table)}/_run={run_id}/_batch={batch_id}"

    def write_batch(self, table: str, df: DataFrame, run_id: str, batch_id: int) -> None:
        """Write a batch, in place of an earlier try at it."""
        df.drop("_run", "_batch").write.mode("overwrite").parquet(self.batch_path(table, run_id, batch_id))

    def read_batch(self, table: str, run_id: str, batch_id: int) -> DataFrame:
        return schemas.migrate(self.spark.read.parquet(self.batch_path(table, run_id, batch_id)), TABLES[table])

    def append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.path(table)}/_run=seed/_batch=0")

    def replace(self, table: str, df: DataFrame) -> None:
        """Put df, which may be read from the table itself, in the place of all of its batches."""
        fs, new, old = self._fs(), f"{self.root}/_new/{table}-{uuid.uuid4().hex}", f"{self.root}/_old/{table}-{uuid.uuid4().hex}"
        df.drop("_run", "_batch").write.parquet(f"{new}/_run=replaced/_batch=0")
        fs.mkdirs(self._hadoop(f"{self.root}/_old"))
        if fs.exists(self._hadoop(self.path(table))):
            fs.rename(self._hadoop(self.path(table)), self._hadoop(old))
        fs.rename(self._hadoop(new), self._hadoop(self.path(table)))
        fs.delete(self._hadoop(old), True)

    def has_batch(self, table: str, run_id: str, batch_id: int) -> bool:
        return self._exists(f"{self.batch_path(table, run_id, batch_id)}/_SUCCESS")

    def next_batch(self, table: str, run_id: str) -> int:
        """The number after the last batch of a run, finished or not."""
        folder = self._hadoop(f"{self.path(table)}/_run={run_id}")
        if not self._fs().exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return max((int(n.removeprefix("_batch=")) for n in names if n.startswith("_batch=")), default=-1) + 1

    # --- several drivers ---

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    @contextlib.contextmanager
    def lock(self, name: str, patience: float = 600.0):
        """Hold a lock file, which one driver at a time can create; one older than `patience` seconds is taken over."""
        fs, path = self._fs(), self._hadoop(f"{self.root}/_locks/{name}")
        while not fs.createNewFile(path):
            if fs.exists(path) and time.time() - fs.getFileStatus(path).getModificationTime() / 1000 > patience:
                fs.delete(path, False)
            else:
                time.sleep(0.2)
        try:
            yield
        finally:
            fs.delete(path, False)

    def beat(self, run_id: str) -> None:
        """Say that a run is alive."""
        self._fs().create(self._hadoop(f"{self.root}/_live/{run_id}"), True).close()

    def rest(self, run_id: str) -> None:
        """Say that a run has ended."""
        self._fs().delete(self._hadoop(f"{self.root}/_live/{run_id}"), False)

    def live_runs(self, patience: float = 3600.0) -> tuple[str, ...]:
        """Runs that said so within `patience` seconds; what others left processing is free again."""
        folder = self._hadoop(f"{self.root}/_live")
        if not self._fs().exists(folder):
            return ()
        return tuple(s.getPath().getName() for s in self._fs().listStatus(folder) if not s.getPath().getName().startswith(".") and time.time() - s.getModificationTime() / 1000 <= patience)


_TEMPORARY: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that spark.checkpoint.dir names; in local mode a temporary one where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        app = spark.sparkContext.applicationId
        base = _TEMPORARY.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="quillspark-")
        _TEMPORARY[app] = base
    return f"{base.rstrip('/')}/quillspark/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written to a fresh path and read again: for what is costly and used more than once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: What the reader takes a field for that is empty and not quoted. It must differ from any text, so it is made of noncharacters.
_NO_TEXT = "\ufffe\uffff\ufffe"
_CSV = {"header": True, "escape": '"', "charToEscapeQuoteEscaping": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, headers: list[str], mode: str = "append") -> None:
    """Mirror of some columns; further columns of df are ignored.

    Texts are kept to the letter: a null is an empty field, an empty text a pair of
    quotes. In a mirror of one column that would be an empty line, which readers
    skip, so there a null is `_NO_TEXT`.
    """
    flat = [F.col(h).cast("string").alias(h) if isinstance(df.schema[h].dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(h) for h in headers]
    df.select(*flat).write.mode(mode).options(**_CSV, nullValue="" if len(headers) > 1 else _NO_TEXT, emptyValue='""').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV, multiLine=True, nullValue=_NO_TEXT, emptyValue="").csv(path)


def question_mirror(questions: DataFrame, personas: DataFrame) -> DataFrame:
    joined = questions.join(personas.select("persona_id", "age", "gender", "location", "profession"), "persona_id")
    return joined.withColumn("cot_log", F.substring("cot_log", 1, 500)).select(*schemas.QUESTION_CSV)


def evaluation_mirror(evals: DataFrame, questions: DataFrame, personas: DataFrame) -> DataFrame:
    joined = evals.join(questions.select("question_id", "question_text"), "question_id").join(personas.select("persona_id", "profession", "location"), "persona_id")
    return joined.select(*schemas.EVALUATION_CSV)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def decode_vector(blobs: pd.Series) -> pd.Series:
    """float32 bytes to array<float>."""
    return blobs.map(lambda b: None if b is None else np.frombuffer(b, "<f4"))


@F.pandas_udf(T.BinaryType())
def encode_vector(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())
