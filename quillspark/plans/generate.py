"""The generation run: claim, draft, gate, judge, rewrite, deduplicate, commit.

One batch is one plan. Model calls happen in a single `mapInPandas` stage whose
output is written before anything else reads it, so no call is ever repeated
by the planner; gates, duplicates and scores are columns after that. Order
within a batch is by persona id.
"""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.config import Settings
from quillspark.functions import parsers
from quillspark.functions import text as tx
from quillspark.operators import attempts, dedup, memory
from quillspark.plans import prompts
from quillspark.plans.reports import format_eta
from quillspark.sources.llm import Chat
from quillspark.sources.store import Store

log = logging.getLogger("quillspark")
ATTEMPT = "struct<no:int,text:string,judge_raw:string,seed:bigint>"


def _gate(text: str, settings: Settings) -> tuple[bool, float]:
    """The gate of `tx.quality_gate`, for the decision inside the loop whether to call the judge."""
    own = sum("ঀ" <= c <= "৿" for c in text)
    whole = own + sum(c.isascii() and c.isalnum() for c in text)
    ratio = own / whole if whole else 0.0
    low = text.lower()
    return bool(text.strip()) and ratio >= settings.min_script_ratio and not any(p in low for p in tx.BANNED_ANY_CASE) and not any(p in text for p in tx.BANNED_EXACT), ratio


def _draft_of(reply: str) -> str:
    """The draft of `tx.last_draft`, for the loop."""
    clean = re.sub(r"(?is)<think>.*?</think>", "", reply or "").strip()
    blocks = re.findall(r"(?s)<draft_questions>(.*?)</draft_questions>", clean)
    if blocks:
        return blocks[-1].strip()
    if re.match(tx.MONOLOGUE, clean):
        return ""
    clean = re.sub(r"(?i)<[^>]*draft_questions[^>]*>", "", clean)
    return re.sub(tx.SHORT_TAG, "", clean).strip()


def _fill(template: str, values: dict) -> str:
    for k, v in values.items():
        template = template.replace("{" + k + "}", str(v))
    return template


def loop(persona: dict, messages: list[dict], chat: Chat, settings: Settings) -> tuple[list[dict], str, str | None]:
    """(attempts, log, error) of one persona: draft, then gate, judge and rewrite until one passes."""
    seed = int(persona["random_seed"] if persona["random_seed"] is not None else persona["persona_id"])
    shown = {k: persona[k] or "unknown" for k in ("profession", "location", "education")}
    tried: list[dict] = []
    log: list[str] = []
    try:
        reply = chat(messages, seed)
        text = _draft_of(reply)
        log.append(f"[draft]\n{reply}")
        for no in range(settings.max_rewrites + 1):
            ok, ratio = _gate(text, settings)
            raw = None
            if ok:
                raw = chat([{"role": "system", "content": prompts.JUDGE_SYSTEM}, {"role": "user", "content": _fill(prompts.JUDGE_USER, {**shown, "draft": text})}], seed + 1000 + no)
            read = parsers.read_quality(raw) if ok else {"verdict": "SKIPPED", "in_script": False, "reasons": ["gate failed"]}
            log.append(f"[gate {no}] {ok} {ratio:.3f}\n[judge {no}] {raw}")
            tried.append({"no": no, "text": text, "judge_raw": raw, "seed": seed})
            if (ok and read["verdict"] == "PASS" and read["in_script"]) or no == settings.max_rewrites:
                break
            user = _fill(prompts.REWRITE_USER, {**shown, "draft": text, "problems": "; ".join(read["reasons"]) or "weak"})
            if round(ratio, 3) < settings.min_script_ratio:
                user += _fill(prompts.LANGUAGE_NOTE, {"language": "Bengali"})
            reply = chat([{"role": "system", "content": _fill(prompts.SYSTEM, {"language": "Bengali"})}, {"role": "user", "content": user}], seed + 2000 + no)
            text = _draft_of(reply)
            log.append(f"[rewrite {no}]\n{reply}")
        return tried, "\n\n".join(log), None
    except Exception as error:  # noqa: BLE001  any failure of a call sends the persona to retry
        return [], "\n\n".join(log), str(error)[:2000]


def attempt_stage(batch: DataFrame, chat: Chat, settings: Settings) -> DataFrame:
    """(persona_id, tries, cot_log, error) of each row of batch, by a pool of threads in each task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(settings.concurrency) as pool:
            for pdf in frames:
                rows = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
                done = list(pool.map(lambda r: loop(r, [dict(m) for m in r["prompt"]], chat, settings), rows))
                yield pd.DataFrame({"persona_id": pdf["persona_id"], "tries": [d[0] for d in done], "cot_log": [d[1] for d in done], "error": [d[2] for d in done]})

    return batch.select("persona_id", "random_seed", "profession", "location", "education", "prompt").mapInPandas(run, f"persona_id long, tries array<{ATTEMPT}>, cot_log string, error string")


def judged_attempts(outcome: DataFrame, settings: Settings) -> DataFrame:
    """A row per attempt with its flags, computed by columns."""
    rows = outcome.where(F.size("tries") > 0).select("persona_id", F.explode("tries").alias("t")).select("persona_id", "t.*")
    rows = rows.withColumn("gate", tx.quality_gate(F.col("text"), settings.min_script_ratio, tx.BANNED_ANY_CASE, tx.BANNED_EXACT)).withColumn("read", parsers.parse_quality(F.col("judge_raw")))
    skipped = F.struct(F.lit("SKIPPED").alias("verdict"), F.lit(False).alias("in_script"), F.array(F.lit("gate failed")).alias("reasons"))
    rows = rows.withColumn("judge", F.when(F.col("judge_raw").isNull(), skipped).otherwise(F.col("read")))
    return rows.withColumn("passed", F.col("gate.programmatic_pass") & (F.col("judge.verdict") == "PASS") & F.col("judge.in_script")).withColumn("ratio", F.col("gate.script_ratio"))


class Generator:
    """Runs batches against a store until nothing is pending."""

    def __init__(self, store: Store, chat: Chat, embed: Callable[[list[str]], list[list[float]]] | None = None, settings: Settings = Settings(), run_id: str = "run"):
        self.store, self.chat, self.embed, self.settings, self.run_id = store, chat, embed, settings, run_id

    def _embedded(self, df: DataFrame) -> DataFrame:
        if self.embed is None:
            return df.withColumn("embedding", F.lit(None).cast("array<float>"))
        embed = self.embed

        @F.pandas_udf("array<float>")
        def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in parts:
                yield pd.Series(embed(s.tolist()))

        return df.withColumn("embedding", vectors.asNondeterministic()("question_text"))

    def _claim(self, batch_id: int, people: DataFrame) -> DataFrame:
        """(persona_id, attempts) of the batch: claimed earlier by this run and not finished, or claimed now.

        A persona with a saved question is done, whatever the log says: the
        question is what commits it. Numbers of the log go on over all runs.
        """
        store = self.store
        if not store.has_batch("status_log", self.run_id, batch_id * 2):
            with store.lock("claim"):
                log = store.read("status_log")
                live = (*store.live_runs(), self.run_id)
                todo = attempts.pending(people, log, live).join(store.read("questions").select("persona_id"), "persona_id", "left_anti")
                last = log.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("m")).first()["m"]
                store.write_batch("status_log", self._mark(attempts.claim(todo, self.settings.batch_size), F.lit("processing"), last + 1, batch_id), self.run_id, batch_id * 2)
        return store.read_batch("status_log", self.run_id, batch_id * 2)

    def _mark(self, df: DataFrame, status: Column, seq: int, batch_id: int, error: Column | None = None) -> DataFrame:
        error = F.lit(None).cast("string") if error is None else error
        return df.select("persona_id", F.lit(seq).cast("long").alias("seq"), F.lit(self.run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id"), status.alias("status"), F.col("attempts").cast("int").alias("attempts"), error.alias("error"))

    def run_batch(self, batch_id: int) -> dict[str, int]:
        """Claim and process one batch; returns counts by outcome, empty if nothing was pending."""
        s, store = self.settings, self.store
        store.beat(self.run_id)
        people = store.read("personas")
        claimed = self._claim(batch_id, people)
        if claimed.isEmpty():
            return {}
        seq = claimed.agg(F.max("seq").alias("m")).first()["m"] + 1
        todo = people.drop("attempts").join(claimed.select("persona_id", "attempts"), "persona_id")
        meta = lambda n: F.col(f"json_metadata.{n}")
        asked = todo.select("persona_id", "attempts", meta("random_seed").alias("random_seed"), meta("profession").alias("profession"), meta("location").alias("location"), meta("education").alias("education"), meta("pain_point").alias("topic"), meta("location").alias("region"), "backstory")
        known = store.read("memory", but=(self.run_id, batch_id))
        if s.memory_enabled:
            asked = memory.context(asked, known, s)
        else:
            none = F.array().cast("array<string>")
            asked = asked.withColumns({"avoid_openers": none, "exemplars": none})
        shown = prompts.persona_json(["profession", "location", "education", "topic", "backstory"])
        asked = asked.withColumn("prompt", prompts.draft_prompt(shown, F.col("avoid_openers"), F.col("exemplars")))
        work = f"{store.root}/_work/_run={self.run_id}/_batch={batch_id}"
        if not store._exists(work + "/_SUCCESS"):  # a batch that is run again never repeats its calls
            attempt_stage(asked, self.chat, s).write.mode("overwrite").parquet(work)
        outcome = store.spark.read.parquet(work).join(people.select("persona_id", "json_metadata"), "persona_id").join(claimed.select("persona_id", "attempts"), "persona_id")
        best = attempts.best_attempt(judged_attempts(outcome, s), "persona_id", "passed", "ratio", "no", ["text", "gate", "judge"])
        earlier = store.read("questions", but=(self.run_id, batch_id))
        start = earlier.agg(F.coalesce(F.max("question_id"), F.lit(0)).alias("m")).first()["m"]
        fresh = best.join(outcome.where(F.col("error").isNull()), "persona_id").withColumnRenamed("text", "question_text")
        fresh = fresh.withColumn("question_id", F.row_number().over(Window.orderBy("persona_id")) + F.lit(start)).withColumn("dedup_hash", tx.dedup_hash(F.col("question_text")))
        fresh = self._embedded(fresh)
        staged = f"{store.root}/_staged/_run={self.run_id}/_batch={batch_id}"
        fresh.write.mode("overwrite").parquet(staged)
        fresh = dedup.exact_duplicates(store.spark.read.parquet(staged), "dedup_hash", ["persona_id"])
        before = store.spark.read.parquet(f"{store.root}/_staged/_run={self.run_id}").where(F.col("_batch") < batch_id).select("dedup_hash").distinct().withColumn("seen", F.lit(True))
        fresh = fresh.join(before, "dedup_hash", "left").withColumn("duplicate", F.col("duplicate") | F.coalesce("seen", F.lit(False)))
        place = fresh.select(F.col("question_id").alias("seq"), F.col("embedding").alias("vec"), F.col("json_metadata.profession").alias("profession"), F.col("json_metadata.location").alias("region"))
        if s.memory_enabled:
            recent = memory.recent(known, place, ["profession", "region"], s.near_dup_recent)
            near = dedup.near_duplicates(recent.select("seq", "vec", "profession", "region").union(place), ["profession", "region"], "seq", "vec", s.near_dup_threshold, s.near_dup_recent)
            fresh = fresh.join(near.select(F.col("seq").alias("question_id"), "near_dup"), "question_id")
        else:
            fresh = fresh.withColumn("near_dup", F.lit(False))
        flags = F.struct(F.col("gate.script_ratio"), F.col("gate.banned_phrases"), F.col("gate.empty"), F.col("gate.programmatic_pass"), "judge", "near_dup", "duplicate")
        off = F.lit(None)
        rows = fresh.select(
            F.col("question_id").cast("long").alias("question_id"), "persona_id", "question_text", "cot_log", F.col("json_metadata.random_seed").alias("random_seed"), "dedup_hash", flags.cast(schemas.FLAGS).alias("quality_flags"), "embedding",
            (tx.opener(F.col("question_text"), s.opener_tokens) if s.memory_enabled else off.cast("string")).alias("opener"),
            (tx.quality_score(F.col("judge.verdict"), F.col("gate.script_ratio"), F.col("duplicate")) if s.memory_enabled else off.cast("double")).alias("quality_score"),
            F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
        )
        store.write_batch("questions", rows, self.run_id, batch_id)
        saved = store.spark.read.parquet(f"{store.path('questions')}/_run={self.run_id}/_batch={batch_id}")
        ended = attempts.after_failure(outcome.where(F.col("error").isNotNull()), s.max_attempts)
        if s.memory_enabled:
            store.write_batch("memory", memory.prime(saved, people).select(*schemas.MEMORY.fieldNames()), self.run_id, batch_id)
        done = outcome.join(saved.select("persona_id"), "persona_id", "left_semi")
        ends = self._mark(done, F.lit("done"), seq, batch_id).union(self._mark(ended, F.col("status"), seq, batch_id, F.col("error")))
        store.write_batch("status_log", ends, self.run_id, batch_id * 2 + 1)
        written = store.spark.read.parquet(f"{store.path('status_log')}/_run={self.run_id}/_batch={batch_id * 2 + 1}")
        counts = {r["status"]: r["count"] for r in written.groupBy("status").count().collect()}
        flagged = saved.agg(F.count_if("quality_flags.duplicate").alias("dup"), F.count_if("quality_flags.near_dup").alias("near_dup")).first()
        return {"ok": counts.get("done", 0), "retry": counts.get("pending", 0), "failed": counts.get("failed", 0), "dup": flagged["dup"], "near_dup": flagged["near_dup"]}

    def run(self, max_batches: int = 1_000_000, progress: Callable[[str], None] | None = None) -> dict[str, int]:
        """Batches until nothing is pending. A batch that cannot be written is counted; its personas stay claimed until the next run."""
        total = {"ok": 0, "retry": 0, "failed": 0, "dup": 0, "near_dup": 0, "write_errors": 0}
        store, begin = self.store, self.store.next_batch("status_log", self.run_id) // 2
        if begin and not store.has_batch("status_log", self.run_id, begin * 2 - 1):
            begin -= 1  # claimed, but not finished
        pace = Progress(lambda: attempts.pending(store.read("personas"), store.read("status_log"), (self.run_id,)).count()) if progress else None
        try:
            for batch_id in range(begin, begin + max_batches):
                try:
                    got = self.run_batch(batch_id)
                except (Py4JJavaError, PySparkException, OSError) as error:
                    log.error("batch %d was not written: %s", batch_id, str(error)[:500])
                    if not store.has_batch("status_log", self.run_id, batch_id * 2):
                        raise  # nothing is claimed, so the next try would fail alike
                    total["write_errors"] += 1
                    continue
                if not got:
                    break
                total = {k: total[k] + got.get(k, 0) for k in total}
                if progress and pace:
                    progress(pace.line(total["ok"] + total["failed"]))
        finally:
            store.rest(self.run_id)
        return total


class Progress:
    """Done so far, share, rate and time left. `waiting` counts what there is to do, once, at the start."""

    def __init__(self, waiting: Callable[[], int], clock: Callable[[], float] = time.monotonic):
        self.clock, self.all, self.began = clock, waiting(), clock()

    def line(self, done: int) -> str:
        took = self.clock() - self.began
        rate = done / took if took > 0 else 0.0
        left = (self.all - done) / rate if rate else None
        return f"{done:,} of {self.all:,} ({100 * done / self.all if self.all else 100:.1f} %), {rate:.2f} a second, {format_eta(left)} left"
