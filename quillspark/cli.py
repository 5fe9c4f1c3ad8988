"""Command line: python -m quillspark.cli --root DIR [--init] [--gen-personas N] [--generate] …

Steps run in a fixed order: init, migrate, personas, generation, judging, reports.
"""

from __future__ import annotations

import argparse
import logging
import sys
import uuid

from quillspark import schemas
from quillspark.config import Settings
from quillspark.functions.sampling import personas
from quillspark.plans import judge, reports
from quillspark.plans.domains import Domains
from quillspark.plans.generate import Generator
from quillspark.session import session
from quillspark.sources.llm import HttpChat, HttpEmbedder, LocalEmbedder, StubChat, hash_embedder
from quillspark.sources.store import TABLES, Store, evaluation_mirror, question_mirror, write_csv

log = logging.getLogger("quillspark")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillspark")
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--init", action="store_true")
    p.add_argument("--migrate", action="store_true")
    p.add_argument("--gen-personas", type=int, metavar="N")
    p.add_argument("--generate", action="store_true")
    p.add_argument("--batch-size", type=int)
    p.add_argument("--test", action="store_true", help="a run in batches of 100; wins over --generate")
    p.add_argument("--judge", action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--report", action="store_true")
    p.add_argument("--judge-report", action="store_true")
    p.add_argument("--topic-report", metavar="HTML")
    p.add_argument("--export-csv", metavar="DIR")
    p.add_argument("--stub", action="store_true", help="deterministic replies instead of a model")
    return p


def embedder(env: Settings, stub: bool):
    """The embedder that the settings name: an endpoint, a local model, the stand-in for dry runs, or none (memory off)."""
    if env.embed_url:
        return HttpEmbedder(env.embed_url, env.embed_model, env.llm_key)
    if stub:
        return hash_embedder()
    return LocalEmbedder(env.embed_model) if env.embed_model else None


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    env = Settings.from_env()
    handlers = [logging.StreamHandler(sys.stdout), *([logging.FileHandler(env.log_file, encoding="utf-8")] if env.log_file else [])]
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=handlers, force=True)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = session()
    store, run_id = Store(spark, a.root), uuid.uuid4().hex
    chat = StubChat() if a.stub else HttpChat(env.llm_url, env.llm_model, env.llm_key, env.llm_temperature, env.llm_max_tokens, env.llm_timeout, env.llm_tries)
    if a.init:
        for name, schema in TABLES.items():
            store.append(name, spark.createDataFrame([], schema))
    if a.migrate:
        store.replace("personas", schemas.migrate_personas(store.read("personas")))
    if a.gen_personas:
        store.write_batch("personas", personas(spark, a.gen_personas, Domains()), "population", 0)
        log.info("personas: %d", reports.count_rows(store.read("personas")))
    if a.generate or a.test:
        size = 100 if a.test else a.batch_size or env.batch_size
        settings = Settings(**{**env.__dict__, "batch_size": size})
        log.info("generation: %s", Generator(store, chat, embedder(env, a.stub), settings, run_id).run(progress=log.info))
    if a.judge:
        quiet = StubChat() if a.stub else HttpChat(env.llm_url, env.llm_model, env.llm_key, env.judge_temperature, env.judge_max_tokens, env.llm_timeout, env.llm_tries)
        log.info("judging: %s", judge.run(store, quiet, run_id, env, a.limit, batch_size=a.batch_size or env.judge_batch_size, progress=log.info))
    people, questions = store.read("personas"), store.read("questions")
    if a.report:
        print(reports.text_report(people, questions))
    if a.judge_report:
        print(reports.judge_report(store.read("evaluations"), people, env.cohort_min_rows, env.cohort_top))
    if a.topic_report:
        log.info("topic report: %s", reports.topic_html(questions, people, a.topic_report))
    if a.export_csv:
        write_csv(question_mirror(questions, people), f"{a.export_csv}/questions", schemas.QUESTION_CSV, "overwrite")
        write_csv(evaluation_mirror(store.read("evaluations"), questions, people), f"{a.export_csv}/evaluations", schemas.EVALUATION_CSV, "overwrite")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
