"""The store, the generation run, judging, streaming and reports, with the stub model."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pyspark.sql.functions as F
import pytest

from quillspark import cli, schemas
from quillspark.config import Settings
from quillspark.functions import sampling
from quillspark.functions import text as tx
from quillspark.operators import attempts
from quillspark.plans import judge, reports
from quillspark.plans.domains import Domains
from quillspark.plans.generate import Generator, Progress, _draft_of, _gate
from quillspark.queries import QUERIES
from quillspark.sources.llm import ChatError, HttpChat, HttpEmbedder, StubChat, hash_embedder
from quillspark.sources.store import Store, decode_vector, encode_vector, question_mirror, read_csv, write_csv
from quillspark.streaming.memory_stream import stream_memory


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    store.write_batch("personas", sampling.personas(spark, 24, Domains()), "population", 0)
    settings = Settings(batch_size=12, concurrency=4)
    got = Generator(store, StubChat(), hash_embedder(16), settings, "r1").run(4)
    return store, got


def test_every_persona_ends(run):
    store, got = run
    assert got["ok"] == 24 and got["failed"] == got["retry"] == 0
    rows = store.read("questions").collect()
    assert len(rows) == len({r["question_id"] for r in rows}) == len({r["persona_id"] for r in rows}) == 24
    assert got["dup"] == sum(r["quality_flags"]["duplicate"] for r in rows)
    assert store.read("memory").count() == 24


def test_failures_are_retried_then_given_up(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write_batch("personas", sampling.personas(spark, 3, Domains()), "population", 0)
    got = Generator(store, StubChat(fail_every=1), None, Settings(batch_size=3, max_attempts=3, concurrency=2), "r").run(6)
    assert got == {"ok": 0, "retry": 6, "failed": 3, "dup": 0, "near_dup": 0, "write_errors": 0}


def test_judging_is_idempotent(run):
    store, _ = run
    first = judge.run(store, StubChat(), "j1", Settings(concurrency=4))
    assert first["done"] == 24 and first["unparsed"] == 0
    assert judge.run(store, StubChat(), "j2", Settings(concurrency=4))["done"] == 0
    assert store.read("evaluations").count() == 24


def test_reports(run, tmp_path):
    store, _ = run
    people, questions = store.read("personas"), store.read("questions")
    assert "Diversity" in reports.text_report(people, questions)
    path = reports.topic_html(questions, people, str(tmp_path / "t.html"))
    assert "<h1>Topics" in open(path, encoding="utf-8").read()
    assert reports.topic_html(questions.limit(0), people, str(tmp_path / "none.html")) is None
    assert "overall" in reports.judge_report(store.read("evaluations"), people, 1)


def test_csv_and_vectors(run, spark, tmp_path):
    store, _ = run
    mirror = question_mirror(store.read("questions"), store.read("personas"))
    write_csv(mirror, str(tmp_path / "csv"), schemas.QUESTION_CSV)
    back = read_csv(spark, str(tmp_path / "csv"), mirror.schema)
    assert sorted(r["question_text"] for r in back.collect()) == sorted(r["question_text"] for r in mirror.collect())
    v = spark.createDataFrame([([0.5, -1.0],), (None,)], "v array<float>")
    assert v.select(decode_vector(encode_vector("v")).alias("v")).collect() == v.collect()


def test_csv_keeps_texts_to_the_letter(spark, tmp_path):
    odd = [None, "", " ", "  a", "a  ", "\ta", "a\n", "\n", "\r", "a\r\nb", "\x00", '\x00"', '"\x00', '"', '""', "a,b", "\\", '\\"\n', "\\N", "null", "#x"]
    df = spark.createDataFrame([(i, x, x, None if i % 2 else i) for i, x in enumerate(odd)], "i long, a string, b string, n long")
    write_csv(df, str(tmp_path / "csv"), df.columns)
    assert read_csv(spark, str(tmp_path / "csv"), df.schema).orderBy("i").collect() == df.orderBy("i").collect()
    alone = df.select("a")
    write_csv(alone, str(tmp_path / "alone"), ["a"])
    assert sorted(map(repr, read_csv(spark, str(tmp_path / "alone"), alone.schema).collect())) == sorted(map(repr, alone.collect()))


def test_streaming_runs_once(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, "Ab c"), (2, "ab  C"), (3, "x")], "doc_id long, text string").coalesce(1).write.parquet(src)
    args = (spark, src, "doc_id long, text string", str(tmp_path / "out"), str(tmp_path / "ck"))
    stream_memory(*args).awaitTermination()
    spark.createDataFrame([(4, "AB C"), (5, "y")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
    stream_memory(*args).awaitTermination()
    stream_memory(*args).awaitTermination()
    got = {r["doc_id"]: r["duplicate"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_streaming_of_a_table_of_any_form(spark, tmp_path):
    """A table is a folder of files or one file, and may be empty."""
    rows = spark.createDataFrame([(1, "Ab c"), (2, "ab  C"), (3, "x")], "doc_id long, text string")
    rows.repartition(2).write.parquet(str(tmp_path / "folder/documents.parquet"))
    rows.where("doc_id < 0").write.parquet(str(tmp_path / "none/documents.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "parts"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "parts").glob("part-*")).rename(tmp_path / "file/documents.parquet")
    for form, want in (("folder", {1: False, 2: True, 3: False}), ("file", {1: False, 2: True, 3: False}), ("none", {})):
        assert {r["doc_id"]: r["duplicate"] for r in QUERIES["streaming_memory"](spark, str(tmp_path / form)).collect()} == want


def test_settings_from_environment():
    s = Settings.from_env({"QUILL_BATCH_SIZE": "7", "QUILL_MEMORY_ENABLED": "false"})
    assert s.batch_size == 7 and s.memory_enabled is False


def test_memory_off_leaves_columns_null(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write_batch("personas", sampling.personas(spark, 2, Domains()), "population", 0)
    Generator(store, StubChat(good=1.0, passes=1.0), None, Settings(batch_size=5, memory_enabled=False), "r").run(2)
    rows = store.read("questions").collect()
    assert len(rows) == 2 and all(r["opener"] is None and r["quality_score"] is None and r["embedding"] is None for r in rows)
    assert store.read("questions").where(F.col("quality_flags.judge.verdict") == "PASS").count() == 2


GOOD, DOWN = StubChat(good=1.0, passes=1.0), StubChat(good=1.0, passes=1.0, fail_every=2)


def test_runs_after_failures_write_one_question_a_persona(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write_batch("personas", sampling.personas(spark, 6, Domains()), "population", 0)
    settings = Settings(batch_size=6, concurrency=2, memory_enabled=False)
    Generator(store, DOWN, None, settings, "r1").run(1)
    done = store.read("questions").count()
    assert 0 < done < 6
    Generator(store, GOOD, None, settings, "r2").run(3)
    Generator(store, GOOD, None, settings, "r2").run(3)
    rows = store.read("questions").collect()
    assert sorted(r["persona_id"] for r in rows) == [1, 2, 3, 4, 5, 6] and len({r["question_id"] for r in rows}) == 6
    now = {r["persona_id"]: r["status"] for r in attempts.latest_status(store.read("status_log")).collect()}
    assert set(now.values()) == {"done"} and len(now) == 6


def test_an_interrupted_batch_goes_on_with_its_own_personas(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write_batch("personas", sampling.personas(spark, 4, Domains()), "population", 0)
    settings = Settings(batch_size=2, concurrency=2, memory_enabled=False)
    g = Generator(store, GOOD, None, settings, "r1")
    g._claim(0, store.read("personas"))  # and the driver is gone
    other = Generator(store, GOOD, None, settings, "r2")
    store.beat("r1")
    store.beat("r2")
    assert [r["persona_id"] for r in other._claim(0, store.read("personas")).orderBy("persona_id").collect()] == [3, 4]
    assert g.run()["ok"] == 2 and other.run()["ok"] == 2
    assert sorted(r["persona_id"] for r in store.read("questions").collect()) == [1, 2, 3, 4]


def test_migration_replaces_and_repeats(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write_batch("personas", sampling.personas(spark, 3, Domains()), "population", 0)
    before = sorted(map(repr, store.read("personas").collect()))
    for _ in range(2):
        store.replace("personas", schemas.migrate_personas(store.read("personas")))
        assert sorted(map(repr, store.read("personas").collect())) == before


def test_judging_again_under_one_name_keeps_all(run):
    store, _ = run
    again = Store(store.spark, store.root + "-judged")
    for name in ("personas", "questions"):
        again.write_batch(name, store.read(name), "copy", 0)
    lines = []
    for limit in (1, 2, None):
        judge.run(again, StubChat(), "j", Settings(concurrency=4), limit, batch_size=10, progress=lines.append)
    rows = again.read("evaluations").collect()
    assert len(rows) == len({r["question_id"] for r in rows}) == 24 and "left" in lines[-1]


def test_progress_line():
    now = iter([0.0, 10.0])
    assert Progress(lambda: 100, lambda: next(now)).line(20) == "20 of 100 (20.0 %), 2.00 a second, 0:00:40 left"


REPLIES = ["<draft_questions>a</draft_questions> <draft_questions> আমার b </draft_questions>", "<think>x</think> আমার কাজ <b>কি</b>", "Let me think", "Okay so <draft_questions>x", "", "kindly আমার", "<p>মহোদয়</p>", "plain text ৩ <m_draft_questions>"]


def test_the_loop_and_the_columns_agree(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(REPLIES)], "i int, r string")
    gate = tx.quality_gate(tx.last_draft(F.col("r")), 0.65, tx.BANNED_ANY_CASE, tx.BANNED_EXACT)
    for row in df.select("i", tx.last_draft(F.col("r")).alias("d"), gate.alias("g")).collect():
        draft = _draft_of(REPLIES[row["i"]])
        ok, ratio = _gate(draft, Settings())
        assert (draft, ok) == (row["d"], row["g"]["programmatic_pass"]) and round(ratio, 3) == pytest.approx(row["g"]["script_ratio"], abs=1e-3)


class Endpoint(BaseHTTPRequestHandler):
    """Fails once, then answers."""

    asked: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.asked.append(body)
        good = len(self.asked) != 1
        if "input" in body:
            reply = {"data": [{"index": i, "embedding": [3.0, 4.0]} for i in range(len(body["input"]))]}
        else:
            reply = {"choices": [{"message": {"content": f"seed {body.get('seed')}"}}]}
        out = json.dumps(reply).encode()
        self.send_response(200 if good else 500)
        self.send_header("Content-Length", str(len(out)))
        self.end_headers()
        self.wfile.write(out)

    def log_message(self, *args):
        pass


def test_http_clients(monkeypatch):
    monkeypatch.setattr("time.sleep", lambda s: None)
    server = HTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/v1"
    try:
        assert HttpChat(url, "m")([{"role": "user", "content": "x"}], 7) == "seed 7"
        assert [a["max_tokens"] for a in Endpoint.asked] == [800, 800] and Endpoint.asked[1]["chat_template_kwargs"] == {"enable_thinking": False}
        assert HttpEmbedder(url, "e")(["a", "b"]) == [[0.6, 0.8], [0.6, 0.8]]
    finally:
        server.shutdown()
    with pytest.raises(ChatError):
        HttpChat("http://127.0.0.1:9/none", "m", tries=2, timeout=1)([], None)
    assert HttpEmbedder("http://127.0.0.1:9/none", "e", tries=1, timeout=1)(["a"]) == [None]


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "session", lambda: spark)
    monkeypatch.setenv("QUILL_LOG_FILE", str(tmp_path / "run.log"))
    root = ["--root", str(tmp_path / "s")]
    assert cli.main([*root, "--init", "--gen-personas", "3", "--test", "--stub", "--judge"]) == 0
    for _ in range(2):
        assert cli.main([*root, "--migrate", "--report", "--judge-report", "--topic-report", str(tmp_path / "t.html"), "--export-csv", str(tmp_path / "csv")]) == 0
    store = Store(spark, str(tmp_path / "s"))
    assert [store.read(t).count() for t in ("personas", "questions", "evaluations")] == [3, 3, 3]
    assert read_csv(spark, str(tmp_path / "csv/questions"), spark.createDataFrame([], ", ".join(f"{c} string" for c in schemas.QUESTION_CSV)).schema).count() == 3
    assert "Diversity" in capsys.readouterr().out and "personas: 3" in (tmp_path / "run.log").read_text()
