"""The two-axis judging job: unjudged questions, one call each, idempotent saves.

A reply that cannot be read is not stored; it is reported and asked again by
the next run, never within one run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.config import Settings
from quillspark.functions.parsers import parse_verdict
from quillspark.operators.attempts import save_once
from quillspark.plans import prompts
from quillspark.plans.generate import Progress
from quillspark.plans.reports import unjudged
from quillspark.sources.llm import Chat
from quillspark.sources.store import Store


def judging_input(questions: DataFrame, personas: DataFrame, evals: DataFrame, limit: int | None = None) -> DataFrame:
    rows = unjudged(questions.select("question_id", "persona_id", "question_text"), evals, "question_id", limit)
    return rows.join(personas.select("persona_id", "backstory", "json_metadata.*"), "persona_id")


def reply_stage(rows: DataFrame, chat: Chat, concurrency: int) -> DataFrame:
    def one(messages) -> tuple[str | None, str | None]:
        try:
            return chat([dict(m) for m in messages], None), None
        except Exception as error:  # noqa: BLE001  counted as an error of this row
            return None, str(error)[:2000]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in frames:
                got = list(pool.map(one, pdf["prompt"]))
                yield pd.DataFrame({"question_id": pdf["question_id"], "persona_id": pdf["persona_id"], "raw_response": [g[0] for g in got], "error": [g[1] for g in got]})

    return rows.select("question_id", "persona_id", "prompt").mapInPandas(run, "question_id long, persona_id long, raw_response string, error string")


def run(store: Store, chat: Chat, run_id: str, settings: Settings = Settings(), limit: int | None = None, model: str = "judge", batch_size: int | None = None, progress: Callable[[str], None] | None = None) -> dict[str, int]:
    """Judge what is unjudged, `limit` at most; returns counts of done, passed, failed, unparsed and errors.

    Each call writes batches of its own, so a run may be repeated under its
    name. Without a batch size all is one batch. What one run could not read
    it does not ask again.
    """
    total = {"done": 0, "passed": 0, "failed": 0, "errors": 0, "unparsed": 0}
    tried, left = store.spark.createDataFrame([], "question_id long"), limit
    pace = Progress(lambda: min(unjudged(store.read("questions"), store.read("evaluations")).count(), limit or 2**62)) if progress else None
    while left is None or left > 0:
        size = min((x for x in (batch_size, left) if x is not None), default=None)
        asked, got = _batch(store, chat, run_id, settings, tried, size, model)
        total = {k: total[k] + got[k] for k in total}
        count = sum(got[k] for k in ("done", "errors", "unparsed"))
        if progress and pace and count:
            progress(pace.line(sum(total[k] for k in ("done", "errors", "unparsed"))))
        if batch_size is None or not count:
            break
        tried = tried.union(asked)
        left = None if left is None else left - count
    return total


def _batch(store: Store, chat: Chat, run_id: str, settings: Settings, tried: DataFrame, size: int | None, model: str) -> tuple[DataFrame, dict[str, int]]:
    """(question ids asked, counts) of one batch."""
    evals, batch_id = store.read("evaluations"), store.next_batch("evaluations", run_id)
    names = ("age", "gender", "profession", "location", "social_status", "education", "pain_point", "backstory")
    rows = judging_input(store.read("questions").join(tried, "question_id", "left_anti"), store.read("personas"), evals, size)
    rows = rows.withColumn("prompt", prompts.axes_prompt(F.col("question_text"), **{n: F.col(n) for n in names}))
    work = f"{store.root}/_judged/_run={run_id}/_batch={batch_id}"
    reply_stage(rows, chat, settings.concurrency).write.mode("overwrite").parquet(work)
    replies = store.spark.read.parquet(work).withColumn("v", parse_verdict(F.col("raw_response")))
    good = replies.where(F.col("v").isNotNull()).select(F.col("question_id").alias("eval_id"), "question_id", "persona_id", "v.*", "raw_response", F.lit(model).alias("model"), F.current_timestamp().cast("timestamp_ntz").alias("created_at"))
    store.write_batch("evaluations", save_once(good, evals, "question_id"), run_id, batch_id)
    n = replies.agg(F.count("*").alias("all"), F.count_if(F.col("v")["overall_pass"]).alias("passed"), F.count_if(~F.col("v")["overall_pass"]).alias("failed"), F.count_if(F.col("error").isNotNull()).alias("errors")).first()
    done = n["passed"] + n["failed"]
    return replies.select("question_id"), {"done": done, "passed": n["passed"], "failed": n["failed"], "errors": n["errors"], "unparsed": n["all"] - done - n["errors"]}
