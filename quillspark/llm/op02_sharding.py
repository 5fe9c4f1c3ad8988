"""Sharding (operator 2): size-tiered compaction under a versioned manifest.

A store is a folder: `data/` holds immutable runs, each a folder of shard
files; `manifest/` holds one JSON-lines file per version, a row per shard.
`append` writes an arrival as small shards, one run. `compact` groups runs by
size tier (powers of `FANOUT` above `SMALL_BYTES`); a tier with at least `MIN_RUNS` runs is
merged into target-sized files, which lift into a higher tier, until no tier
is due. The merge reads whole small files and writes them on, coalesced: rows
are never shuffled. A version is committed by giving a finished file a name
that must not exist yet, so readers see the old version or the new one. Of two
writers one finds the name taken; it then adds its shards to the newer version
(`append`), or plans its merge anew (`compact`). On local folders the name is
a hard link, elsewhere a rename that never replaces; both are atomic on POSIX
folders and on HDFS. A store without such a rename (plain object stores) needs
a single writer. Files that no version lists are invisible; `vacuum` removes
them.

Built-in functions only. What the driver holds is one row per run.

Defined results: rows are kept as they are, so null columns, empty texts,
repeated rows and further columns come back unchanged; an empty arrival commits
a version without shards, and an empty store reads as no rows of the columns
of its first arrival. A column whose name starts with `_sh_` is refused.
"""

from __future__ import annotations

import json
import math
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import scratch_path

TARGET_BYTES, SMALL_BYTES, FANOUT, MIN_RUNS = 128 << 20, 1 << 20, 4, 4
_MANIFEST = "run string, file string, bytes long, rows long, level int"


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, min_runs: int = MIN_RUNS, fanout: int = FANOUT, small_bytes: int = SMALL_BYTES):
        self.spark, self.root = spark, root.rstrip("/")
        self.target_bytes, self.min_runs, self.fanout, self.small_bytes = target_bytes, min_runs, fanout, small_bytes

    # --- files and versions ---

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, folder = self._fs(), self._path("manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:9]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> DataFrame:
        """One row per shard of a version, the latest by default."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifest/v{known[-1] if version is None else version:08d}.json")

    def commit(self, shards: DataFrame, version: int) -> int:
        """Publish `shards` as `version`, or raise CommitConflict if it exists."""
        fs, part = self._fs(), f"manifest/_part-{uuid.uuid4().hex}"
        shards.coalesce(1).write.json(f"{self.root}/{part}")
        found = [s.getPath() for s in fs.listStatus(self._path(part)) if s.getPath().getName().startswith("part-")]
        if not found:
            fs.create(self._path(f"{part}/part-empty")).close()
            found = [self._path(f"{part}/part-empty")]
        done = self._publish(found[0], self._path(f"manifest/v{version:08d}.json"))
        fs.delete(self._path(part), True)
        if not done:
            raise CommitConflict(f"version {version} exists")
        return version

    def _publish(self, part, to) -> bool:
        """Give a finished file its name, unless there is such a file."""
        jvm, fs = self.spark._jvm, self._fs()
        try:
            if fs.getUri().getScheme() == "file":
                at = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(at(to), at(part))
            else:
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(part, to, options)
        except Py4JJavaError:
            if fs.exists(to):
                return False
            raise
        return True

    def _stats(self, folder: str, level: int, runs: int) -> DataFrame:
        """A row per shard file of the runs below `folder`."""
        fs, files = self._fs(), []
        found = fs.listFiles(self._path(folder), True)
        while not files and found.hasNext():
            name = found.next().getPath().getName()
            files += [name] if name.startswith("part-") else []
        if not files:  # an arrival without rows, dealt out by a column, writes no file
            return self.spark.createDataFrame([], _MANIFEST)
        files = self.spark.read.parquet(f"{self.root}/{folder}").groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
        parts = F.split("file", "/")
        run = F.concat_ws("/", F.slice(parts, -(runs + 1), runs))
        return files.select(run.alias("run"), "file", "bytes", "rows", F.lit(level).alias("level"))

    def _columns(self, schema: T.StructType | None = None) -> T.StructType | None:
        """Columns of the store; those of its first arrival are written down."""
        fs, path = self._fs(), self._path("schema.json")
        if schema is not None and not fs.exists(path):
            out = fs.create(path, False)
            out.write(bytearray(schema.json().encode()))
            out.close()
        if not fs.exists(path):
            return None
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.root}/schema.json", wholetext=True).first()[0]))

    # --- operations ---

    def append(self, rows: DataFrame) -> int:
        """Write one arrival as a run of small shards and commit it."""
        return self._append(rows, None)

    def append_all(self, rows: DataFrame, arrival: str) -> int:
        """Write several arrivals, told by the int column `arrival` (dropped), a run each, in one job."""
        return self._append(rows, arrival)

    def _append(self, rows: DataFrame, arrival: str | None) -> int:
        own = rows if arrival is None else rows.drop(arrival)
        if any(c.lower().startswith("_sh_") for c in own.columns):
            raise ValueError("names that start with _sh_ are reserved")
        self._columns(own.schema)
        name = f"data/{uuid.uuid4().hex}"
        writer = rows.write if arrival is None else rows.withColumnRenamed(arrival, "_sh_run").write.partitionBy("_sh_run")
        writer.parquet(f"{self.root}/{name}")
        stats = self._stats(name, 0, 1 if arrival is None else 2)
        while True:  # the rows are written once; a lost race only adds them to a newer version
            version = (self.versions() or [0])[-1]
            try:
                return self.commit(self.manifest(version or None).unionByName(stats), version + 1)
            except CommitConflict:
                continue

    def _tier(self, size: int) -> int:
        return max(0, int(math.log(max(size, 1) / self.small_bytes, self.fanout))) if size > self.small_bytes else 0

    def compact(self) -> int:
        """Merge tiers that are due until none is; returns the version then current."""
        while True:
            version = (self.versions() or [0])[-1]
            current = self.manifest(version or None)
            runs = current.groupBy("run").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"), F.max("level").alias("level")).collect()
            tiers: dict[int, list] = {}
            for r in runs:
                if r["largest"] < self.target_bytes // 2 or r["level"] == 0:
                    tiers.setdefault(self._tier(r["bytes"]), []).append(r)
            due = sorted((t, rs) for t, rs in tiers.items() if len(rs) >= self.min_runs)
            if not due:
                return version
            merged = due[0][1]
            size, names = sum(r["bytes"] for r in merged), sorted(r["run"] for r in merged)
            name = f"data/{uuid.uuid4().hex}"
            self._read(names).coalesce(max(1, round(size / self.target_bytes))).write.parquet(f"{self.root}/{name}")
            fresh = self._stats(name, max(r["level"] for r in merged) + 1, 1)
            while True:
                rest = current.where(~F.col("run").isin(names))
                try:
                    self.commit(rest.unionByName(fresh), version + 1)
                    break
                except CommitConflict:  # if what was merged is still there, the merge holds for the newer version too
                    version = self.versions()[-1]
                    current = self.manifest(version)
                    if current.where(F.col("run").isin(names)).select("run").distinct().count() < len(names):
                        self._fs().delete(self._path(name), True)
                        break

    def _read(self, runs: list[str]) -> DataFrame:
        """Rows of whole runs; a run that was dealt out keeps its arrival in the folder's name only."""
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.root}/data/{r}" for r in runs])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, with the shard they lie in as `_sh_file`."""
        shards = self.manifest(version)
        runs = [r["run"] for r in shards.select("run").distinct().collect()]
        if not runs:
            return self.spark.createDataFrame([], self._columns() or T.StructType()).withColumn("_sh_file", F.lit(None).cast("string"))
        return self._read(sorted(runs)).withColumn("_sh_file", F.col("_metadata.file_path"))

    def vacuum(self) -> None:
        """Remove runs that the latest version does not list."""
        fs = self._fs()
        live = {r["run"].split("/")[0] for r in self.manifest().select("run").distinct().collect()}
        for s in fs.listStatus(self._path("data")):
            if s.getPath().getName() not in live:
                fs.delete(s.getPath(), True)


def shard_documents(docs: DataFrame, arrivals: int = 8, root: str | None = None) -> ShardStore:
    """A store of all rows of docs, dealt by id into `arrivals` arrivals, appended and compacted."""
    store = ShardStore(docs.sparkSession, root or scratch_path(docs.sparkSession, "shards"))
    store.append_all(docs.withColumn("_sh_arrival", F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)).cast("int")), "_sh_arrival")
    store.compact()
    return store
