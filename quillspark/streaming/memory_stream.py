"""Structured Streaming over a table of generated texts: memory and duplicates by micro-batch.

A micro-batch is compared to what earlier ones stored, then stored itself,
keyed by its batch id: with the same checkpoint nothing is done twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.functions.text import dedup_hash, opener
from quillspark.operators.dedup import exact_duplicates
from quillspark.sources.store import saved


def stream_memory(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text", glob: str | None = None) -> StreamingQuery:
    """Write (id, dedup_hash, opener, duplicate) of each new text under `target`, a folder per batch.

    `source` is a folder of Parquet files or a single file. `target` is there
    from the start, so it can be read even if no text ever comes.
    """
    hadoop = lambda path: spark._jvm.org.apache.hadoop.fs.Path(path)
    fs_of = lambda path: path.getFileSystem(spark._jsc.hadoopConfiguration())
    at = hadoop(source)
    if fs_of(at).exists(at) and fs_of(at).getFileStatus(at).isFile():  # a stream reads folders only
        source, glob = at.getParent().toString(), at.getName()
    fs_of(hadoop(target)).mkdirs(hadoop(target))
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.parquet(source)

    def commit(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        fresh = batch.select(id_col, dedup_hash(F.col(text_col)).alias("dedup_hash"), opener(F.col(text_col)).alias("opener"))
        fresh = exact_duplicates(saved(fresh, "fresh"), "dedup_hash", [id_col])
        if batch_id > 0:
            seen = s.read.schema("dedup_hash string, _batch long").parquet(target).where(F.col("_batch") < batch_id).select("dedup_hash").distinct().withColumn("__seen", F.lit(True))
            fresh = fresh.join(seen, "dedup_hash", "left").withColumn("duplicate", F.col("duplicate") | F.coalesce("__seen", F.lit(False))).drop("__seen")
        fresh.write.mode("overwrite").parquet(f"{target}/_batch={batch_id}")

    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
