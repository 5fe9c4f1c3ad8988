"""The engine's queries over the shared tables, and their SQL.

documents stand in for questions (source = region, lang = profession, n_chars
mod 7 = topic), labels for verdicts, events for a status log, embeddings for
vectors with clusters, conversations for attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import parsers, sampling
from quillspark.functions import text as tx
from quillspark.operators import attempts, dedup, memory
from quillspark.plans import prompts, reports
from quillspark.plans.domains import TOPIC_CATEGORY, Domains
from quillspark.sources.store import read_csv, saved, scratch, write_csv
from quillspark.streaming.memory_stream import stream_memory

_LATIN = "a-z"
_PHRASES = ["the reading", "of the", "kindly"]
_EXACT = ["Token", "This work"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _evals(spark, sf_dir) -> DataFrame:
    a1, a2 = F.col("quality") == 1, F.col("toxic") == 0
    labels = _t(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").alias("question_id"), a1.alias("axis1_pass"), a2.alias("axis2_pass"), (a1 & a2).alias("overall_pass"), F.when(~a1, F.concat(F.lit("low quality "), "doc_id")).otherwise("").alias("axis1_reason"))


def _judged(spark, sf_dir) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("question_id"), "lang", "source")
    return _evals(spark, sf_dir).join(docs, "question_id")


def _memory(spark, sf_dir) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    score = F.round(tx.script_ratio(F.col("text"), _LATIN), 6) + F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.0)
    return docs.select(F.col("doc_id").alias("seq"), F.col("lang").alias("profession"), F.col("source").alias("region"), (F.col("n_chars") % 7).cast("string").alias("topic"), "text", score.alias("score"), tx.opener(F.col("text"), 2, normalize=False).alias("opener"))


def _saved_memory(spark, sf_dir) -> DataFrame:
    """The memory table, written once: its readers join it to itself several times."""
    return saved(_memory(spark, sf_dir), "memory")


def worst_cohorts(spark, sf_dir, least=20):
    """The worst sources of at least `least` judged documents, as in the SQL."""
    return reports.worst_cohorts(_judged(spark, sf_dir), "source", least)


def judge_pass_rates(spark, sf_dir):
    return reports.pass_rates(_evals(spark, sf_dir))


def unjudged_fetch(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("question_id"), "lang", "source")
    return reports.unjudged(docs, _evals(spark, sf_dir), limit=25)


def unjudged_count(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("question_id"))
    return reports.unjudged(docs, _evals(spark, sf_dir)).agg(F.count("*").alias("n"))


def sample_reasons(spark, sf_dir):
    return reports.sample_reasons(_evals(spark, sf_dir), "axis1")


def status_counts(spark, sf_dir):
    return reports.status_counts(_t(spark, sf_dir, "events"), "event_type")


def latest_status(spark, sf_dir):
    log = _t(spark, sf_dir, "events").select(F.col("user_id").alias("persona_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"))
    return attempts.latest_status(log).select("persona_id", "seq", "status")


def coverage_histogram(spark, sf_dir):
    return reports.histogram(_t(spark, sf_dir, "events"), F.get_json_object("props", "$.k"))


def coverage_histograms(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return reports.histograms(docs, {"lang": F.col("lang"), "source": F.col("source"), "topic": F.col("n_chars") % 7}).select("field", "value", "n")


def quality_summary(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    ratio = F.round(tx.script_ratio(F.col("text"), _LATIN), 6)
    return reports.quality_summary(docs, F.col("quality") == 1, F.col("toxic") == 1, F.col("quality") == 0, F.col("text"), ratio)


def hash_duplicate_rate(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(tx.dedup_hash(F.col("text")).alias("h"))
    return reports.duplicate_rate(docs, "h")


def exact_dup_flags(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", tx.dedup_hash(F.col("text")).alias("dedup_hash"))
    return dedup.exact_duplicates(saved(docs, "hashes"), "dedup_hash", ["doc_id"])


def opener_diversity(spark, sf_dir):
    return reports.opener_diversity(_t(spark, sf_dir, "documents").select(tx.opener(F.col("text")).alias("o")), "o")


def overused_openers(spark, sf_dir):
    found = memory.overused_openers(_memory(spark, sf_dir), ["profession", "region"])
    return found.select("profession", "region", "opener", "n", "first_seq", "rank")


def tiered_exemplars(spark, sf_dir):
    known = _saved_memory(spark, sf_dir)
    askers = known.select(F.col("seq").alias("persona_id"), "profession", "region", "topic")
    return memory.tiered_exemplars(askers, known.where(F.col("score") >= 1.4)).select("persona_id", "rank", "tier", "seq")


def near_duplicates(spark, sf_dir):
    v = _t(spark, sf_dir, "embeddings")
    return dedup.near_duplicates(v, ["label"], "vec_id", "embedding", 0.3, 500).select("vec_id", "near_dup")


def near_duplicates_recent(spark, sf_dir):
    v = _t(spark, sf_dir, "embeddings")
    return dedup.near_duplicates(v, ["label"], "vec_id", "embedding", 0.3, 20).select("vec_id", "near_dup")


def mean_pairwise_cosine(spark, sf_dir):
    v = dedup.mean_pairwise_cosine(_t(spark, sf_dir, "embeddings"), ["label"], "embedding", 64)
    return v.select("label", "n", F.round("mean_cosine", 6).alias("mean_cosine"))


def script_ratio_gate(spark, sf_dir):
    gate = tx.quality_gate(F.col("text"), 0.9, _PHRASES, _EXACT, _LATIN)
    out = _t(spark, sf_dir, "documents").select("doc_id", gate.alias("g"))
    return out.select("doc_id", "g.script_ratio", F.array_join("g.banned_phrases", "|").alias("banned"), F.col("g.empty").alias("is_empty"), F.col("g.programmatic_pass").alias("passed"))


def _wrapped(spark, sf_dir) -> DataFrame:
    """Replies built from documents: drafts, thoughts, monologues and litter by id."""
    text = F.col("text")
    kind = F.pmod(F.col("doc_id"), F.lit(5))
    reply = (
        F.when(kind == 0, F.concat(F.lit("<think>a\nb</think><draft_questions> one </draft_questions> x <draft_questions>\n"), text, F.lit("</draft_questions>")))
        .when(kind == 1, F.concat(F.lit("Let me think about it. "), text))
        .when(kind == 2, F.concat(F.lit("<m_draft_questions>"), text, F.lit("</p>")))
        .when(kind == 3, F.concat(F.lit("<think>open <draft_questions>"), text, F.lit("</draft_questions>")))
        .otherwise(text)
    )
    return _t(spark, sf_dir, "documents").select("doc_id", reply.alias("reply"))


def last_draft(spark, sf_dir):
    return _wrapped(spark, sf_dir).select("doc_id", F.md5(tx.last_draft(F.col("reply"))).alias("draft_md5"))


def strip_think(spark, sf_dir):
    return _wrapped(spark, sf_dir).select("doc_id", F.md5(tx.strip_think(F.col("reply"))).alias("text_md5"))


def tag_litter(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.md5(tx.strip_litter(F.col("html"), "draft_questions")).alias("text_md5"))


def _replies(spark, sf_dir) -> DataFrame:
    verdict = F.when(F.col("quality") == 1, "PASS").otherwise("FAIL")
    axis = lambda n, v, r: F.format_string(f'"{n}": {{"verdict": "%s", "reason": "%s"}}', v, r)
    second = F.when(F.col("toxic") == 0, "PASS").otherwise("FAIL")
    body = F.concat(F.lit("note ```json\n{"), axis("axis1", verdict, F.when(F.col("doc_id") % 3 == 0, "").otherwise("why")), F.lit(", "), axis("axis2", second, F.lit("so")), F.lit("}\n```"))
    return _t(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", body.alias("reply"))


def parse_verdicts(spark, sf_dir):
    v = _replies(spark, sf_dir).select("doc_id", parsers.parse_verdict(F.col("reply")).alias("v"))
    return v.select("doc_id", F.col("v")["axis1_pass"].alias("axis1_pass"), F.col("v")["axis2_pass"].alias("axis2_pass"), F.col("v")["overall_pass"].alias("overall_pass"))


def parse_quality_replies(spark, sf_dir):
    body = F.when(F.col("doc_id") % 4 == 0, F.lit("no verdict at all")).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("verdict: "), F.when(F.col("quality") == 1, "PASS").otherwise("FAIL"), F.lit(" {broken")))
    body = body.otherwise(F.concat(F.lit('{"verdict": "'), F.when(F.col("quality") == 1, "pass").otherwise("fail"), F.lit('", "is_bengali": "false"}')))
    v = _t(spark, sf_dir, "labels").select("doc_id", parsers.parse_quality(body).alias("v"))
    return v.select("doc_id", "v.verdict", "v.in_script", F.size("v.reasons").cast("long").alias("n_reasons"))


def quality_score(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", tx.dedup_hash(F.col("text")).alias("dedup_hash"), F.round(tx.script_ratio(F.col("text"), _LATIN), 6).alias("ratio"))
    rows = dedup.exact_duplicates(saved(docs, "scored"), "dedup_hash", ["doc_id"]).join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    verdict = F.when(F.col("quality") == 1, "PASS").when(F.col("quality") == 0, "FAIL")
    return rows.select("doc_id", F.round(tx.quality_score(verdict, F.col("ratio"), F.col("duplicate")), 6).alias("score"))


def best_attempt(spark, sf_dir):
    tries = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", (F.col("role") == "assistant").alias("passed"), F.round(tx.script_ratio(F.col("text"), _LATIN), 6).alias("ratio"))
    return attempts.best_attempt(tries, "conv_id", "passed", "ratio", "turn", ["role"])


_CELLS = 25_000


def stratified_cells(spark, sf_dir):
    return sampling.stratified_cells(spark, _CELLS, Domains())


def weighted_choice(spark, sf_dir):
    u = sampling.uniform(F.lit("region"), F.col("doc_id"))
    pick = sampling.weighted_choice(u, ["hub", "town", "village"], [25.0, 36.0, 79.0])
    return _t(spark, sf_dir, "documents").select("doc_id", F.round(u, 9).alias("u"), pick.alias("pick"))


def personas_exact(spark, sf_dir):
    return sampling.personas(spark, 2000, Domains()).select("persona_id", "age", "gender", "location", "profession", "social_status", "backstory", "json_metadata.education", "json_metadata.pain_point", "json_metadata.random_seed")


def _topic(col: str = "n_chars") -> Column:
    topics = list(TOPIC_CATEGORY)
    return F.get(F.array(*[F.lit(t) for t in topics[:50]], *[F.lit(f"unlisted {i}") for i in range(5)]), F.pmod(F.col(col), F.lit(55)).cast("int"))


def _topic_counts(spark, sf_dir) -> DataFrame:
    people = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("persona_id"), F.struct(_topic().alias("pain_point")).alias("json_metadata"))
    questions = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("persona_id"))
    return reports.topic_counts(questions, people)


def topic_counts(spark, sf_dir):
    return _topic_counts(spark, sf_dir)


def topic_rollup(spark, sf_dir):
    out = reports.category_rollup(reports.with_category(_topic_counts(spark, sf_dir)))
    return out.select("category", "n", F.col("n_topics"), F.array_join("topics", "|").alias("topics"), "share_pct")


def topic_evenness(spark, sf_dir):
    return reports.evenness(reports.with_category(_topic_counts(spark, sf_dir)))


def _log(spark, sf_dir) -> DataFrame:
    status = F.element_at(F.array(*[F.lit(x) for x in ("pending", "processing", "done", "failed", "pending")]), (F.col("event_id") % 5 + 1).cast("int"))
    return _t(spark, sf_dir, "events").select(F.col("user_id").alias("persona_id"), F.col("event_id").alias("seq"), F.concat(F.lit("run"), F.col("event_id") % 3).alias("run_id"), status.alias("status"), (F.col("event_id") % 4).cast("int").alias("attempts"))


def claim_batch(spark, sf_dir):
    people = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("persona_id"))
    return attempts.claim(attempts.pending(people, _log(spark, sf_dir), ("run1",)), 100)


def resume_status(spark, sf_dir):
    """All that a new run has to work on, after what others left behind."""
    people = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("persona_id"))
    return attempts.pending(people, _log(spark, sf_dir), ("run1",)).select("persona_id", F.col("attempts").cast("int").alias("attempts"))


def worst_cohorts_by_dimension(spark, sf_dir):
    """The worst cohorts of each dimension, in one pass over the judged rows."""
    judged = _judged(spark, sf_dir).join(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("question_id"), (F.col("n_chars") % 7).cast("string").alias("topic")), "question_id")
    return reports.worst_cohorts_of(judged, {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col("topic")})


def dead_letter(spark, sf_dir):
    gone = attempts.latest_status(_log(spark, sf_dir)).where(F.col("status") == "processing")
    return attempts.after_failure(gone).select("persona_id", "attempts", "status")


def prompt_messages(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    m = prompts.judge_prompt(F.col("text"), F.col("lang"), F.col("source"), F.lit("primary"))
    return docs.select("doc_id", F.explode(m).alias("m")).select("doc_id", "m.role", F.md5("m.content").alias("content_md5"))


def idempotent_save(spark, sf_dir):
    labels = _t(spark, sf_dir, "labels")
    new = labels.select(F.col("doc_id").alias("question_id"), "quality", "toxic")
    return attempts.save_once(new.union(new), new.where(F.col("question_id") % 3 == 0), "question_id")


def orphan_questions(spark, sf_dir):
    orders, people = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k")), _t(spark, sf_dir, "customer").where(F.col("c_custkey") % 7 != 0).select(F.col("c_custkey").alias("k"))
    return attempts.orphans(orders, people, "k").select("o_orderkey", F.col("k").alias("o_custkey"))


def topic_similarity_pairs(spark, sf_dir):
    p = dedup.similar_pairs(_t(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding", 0.3)
    return p.select("label", "first", "second", F.round("similarity", 6).alias("similarity"))


def share_of_total(spark, sf_dir):
    counts = _t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return counts.withColumn("share_pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4)).withColumn("bar_pct", F.round(100.0 * F.col("n") / F.max("n").over(Window.partitionBy()), 4))


def generation_loop_stub(spark, sf_dir):
    """Outcomes of one batch of 200 personas with the stub model, without writing a store."""
    from quillspark.config import Settings
    from quillspark.plans.generate import attempt_stage, judged_attempts
    from quillspark.sources.llm import StubChat

    people = sampling.personas(spark, 200, Domains())
    none = F.array().cast("array<string>")
    asked = people.select("persona_id", "json_metadata.random_seed", "profession", "location", "json_metadata.education", "backstory")
    asked = asked.withColumn("prompt", prompts.draft_prompt(prompts.persona_json(["profession", "location", "education", "backstory"]), none, none))
    outcome = attempt_stage(asked, StubChat(), Settings(concurrency=4))
    best = attempts.best_attempt(judged_attempts(outcome, Settings()), "persona_id", "passed", "ratio", "no", ["text"])
    return best.select("persona_id", "passed", "ratio", "no", "text")


def csv_roundtrip(spark, sf_dir):
    """All documents through a CSV mirror and back."""
    docs = _t(spark, sf_dir, "documents")
    path = scratch(spark, "csv")
    write_csv(docs, path, docs.columns)
    back = read_csv(spark, path, docs.schema)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


def streaming_memory(spark, sf_dir):
    """Documents as a stream, each micro-batch compared to what earlier ones stored."""
    out, schema = scratch(spark, "stream"), _t(spark, sf_dir, "documents").schema
    stream_memory(spark, f"{sf_dir}/documents.parquet", schema, out, scratch(spark, "offsets")).awaitTermination()
    return spark.read.schema(f"doc_id {schema['doc_id'].dataType.simpleString()}, dedup_hash string, duplicate boolean").parquet(out).select("doc_id", "dedup_hash", "duplicate")


def memory_context(spark, sf_dir):
    """Openings to avoid for each document's cluster, as the prompt gets them."""
    known = _saved_memory(spark, sf_dir)
    asked = known.select(F.col("seq").alias("persona_id"), "profession", "region", "topic")
    got = memory.context(asked, known)
    return got.select("persona_id", F.array_join("avoid_openers", "|").alias("avoid"), F.size("exemplars").cast("long").alias("n_exemplars"))


QUERIES = {
    f.__name__: f
    for f in (
        worst_cohorts, judge_pass_rates, unjudged_fetch, unjudged_count, sample_reasons, status_counts, latest_status, coverage_histogram, coverage_histograms,
        quality_summary, hash_duplicate_rate, exact_dup_flags, opener_diversity, overused_openers, tiered_exemplars, near_duplicates, near_duplicates_recent,
        mean_pairwise_cosine, script_ratio_gate, last_draft, strip_think, tag_litter, parse_verdicts, parse_quality_replies, quality_score, best_attempt,
        stratified_cells, weighted_choice, personas_exact, topic_counts, topic_rollup, topic_evenness, claim_batch, resume_status, worst_cohorts_by_dimension, dead_letter, prompt_messages, idempotent_save,
        orphan_questions, topic_similarity_pairs, share_of_total, generation_loop_stub, csv_roundtrip, streaming_memory, memory_context,
    )
}


# --- the same in DuckDB's SQL ------------------------------------------------

_EVALS = "SELECT doc_id AS question_id, quality = 1 AS axis1_pass, toxic = 0 AS axis2_pass, quality = 1 AND toxic = 0 AS overall_pass FROM labels"
_RATIO = "CASE WHEN len(regexp_extract_all(text, '[a-zA-Z0-9]')) > 0 THEN len(regexp_extract_all(text, '[a-z]'))::DOUBLE / len(regexp_extract_all(text, '[a-zA-Z0-9]')) ELSE 0 END"
_HASH = r"sha1(trim(regexp_replace(lower(text), '[^\x{0980}-\x{09FF}a-z0-9]+', ' ', 'g')))"
_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+'), lambda x: x <> '')"
_MEMORY = f"SELECT doc_id AS seq, lang AS profession, source AS region, (n_chars % 7)::VARCHAR AS topic, round({_RATIO}, 6) + CASE WHEN doc_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score, array_to_string(({_TOKENS})[1:2], ' ') AS opener FROM documents"
_LIT = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
_TOPICS = _LIT([*list(TOPIC_CATEGORY)[:50], *[f"unlisted {i}" for i in range(5)]])
_TOPIC_COUNTS = f"SELECT ({_TOPICS})[(n_chars % 55 + 1)::INT] AS topic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1"
_CATEGORY = "CASE topic " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in TOPIC_CATEGORY.items()) + " ELSE 'Other' END"
_REPLY = """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '<think>a' || chr(10) || 'b</think><draft_questions> one </draft_questions> x <draft_questions>' || chr(10) || text || '</draft_questions>'
 WHEN 1 THEN 'Let me think about it. ' || text WHEN 2 THEN '<m_draft_questions>' || text || '</p>'
 WHEN 3 THEN '<think>open <draft_questions>' || text || '</draft_questions>' ELSE text END AS reply FROM documents"""
_STRIP = lambda x: rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
_THINKLESS = "regexp_replace(reply, '(?is)<think>.*?</think>', '', 'g')"
_STATUS_LOG = "SELECT user_id AS persona_id, event_id AS seq, 'run' || (event_id % 3) AS run_id, (['pending', 'processing', 'done', 'failed', 'pending'])[(event_id % 5 + 1)::INT] AS status, (event_id % 4)::INT AS attempts FROM events"
_LATEST = f"SELECT * FROM ({_STATUS_LOG}) QUALIFY row_number() OVER (PARTITION BY persona_id ORDER BY seq DESC) = 1"


def _near_sql(recent: int) -> str:
    return f"""WITH p AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS place FROM embeddings)
SELECT a.vec_id, EXISTS (SELECT 1 FROM p b WHERE b.label = a.label AND b.place < a.place AND b.place >= a.place - {recent} AND list_inner_product(a.e, b.e) >= 0.3) AS near_dup FROM p a"""


def _cells_sql() -> str:
    p, t, e = sampling.shuffled_axes(Domains())
    return f"SELECT i, ({_LIT(p)})[(i * 7 % {len(p)} + 1)::INT] AS profession, ({_LIT(t)})[(i * 13 % {len(t)} + 1)::INT] AS pain_point, ({_LIT(e)})[(i * 11 % {len(e)} + 1)::INT] AS education FROM range({_CELLS}) r(i)"


def _exemplar_sql() -> str:
    return f"""WITH m AS ({_MEMORY}), b AS (SELECT * FROM m WHERE score >= 1.4),
j AS (SELECT a.seq AS persona_id, CASE WHEN a.profession = b.profession THEN 0 WHEN a.region = b.region THEN 1 ELSE 2 END AS tier, b.score, b.seq
      FROM m a JOIN b ON a.topic <> b.topic),
r AS (SELECT *, row_number() OVER (PARTITION BY persona_id ORDER BY tier, score DESC, seq)::INT AS rank FROM j)
SELECT persona_id, rank, tier, seq FROM r WHERE rank <= 3"""


def _gate_sql() -> str:
    low = f"list_filter({_LIT(_PHRASES)}, lambda p: contains(lower(text), p))"
    raw = f"list_filter({_LIT(_EXACT)}, lambda p: contains(text, p))"
    return f"""WITH g AS (SELECT doc_id, {_RATIO} AS r, list_concat({low}, {raw}) AS b, NOT regexp_matches(text, '\\S') AS e FROM documents)
SELECT doc_id, round(r, 3) AS script_ratio, array_to_string(b, '|') AS banned, e AS is_empty, NOT e AND r >= 0.9 AND len(b) = 0 AS passed FROM g"""


_DRAFTS = rf"""WITH w AS ({_REPLY}), c AS (SELECT doc_id, {_STRIP(_THINKLESS)} AS c FROM w),
d AS (SELECT doc_id, c, regexp_extract_all(c, '(?s)<draft_questions>(.*?)</draft_questions>', 1) AS b FROM c)
SELECT doc_id, md5(CASE WHEN len(b) > 0 THEN {_STRIP("b[-1]")} WHEN regexp_matches(c, '(?is)^(here''?s?\s+(a|my)\s+thinking\s+process|let me think|okay,?\s+so)') THEN ''
  ELSE {_STRIP(r"regexp_replace(regexp_replace(c, '(?i)<[^>]*draft_questions[^>]*>', '', 'g'), '</?[a-zA-Z][\w\-]{0,30}>', '', 'g')")} END) AS draft_md5 FROM d"""

_JUDGE_TEXT = "'" + prompts.JUDGE_USER.replace("'", "''") + "'"
for _name, _value in (("profession", "lang"), ("location", "source"), ("education", "'primary'"), ("draft", "text")):
    _JUDGE_TEXT = f"replace({_JUDGE_TEXT}, '{{{_name}}}', {_value})"

ORACLE = {
    "worst_cohorts": f"SELECT source AS cohort, count(*) AS n, count(*) FILTER (WHERE NOT overall_pass) AS fails, round(100.0 * count(*) FILTER (WHERE NOT overall_pass) / count(*), 1)::DOUBLE AS fail_pct FROM ({_EVALS}) e JOIN documents d ON d.doc_id = e.question_id GROUP BY 1 HAVING count(*) >= 20 ORDER BY fail_pct DESC, cohort LIMIT 6",
    "judge_pass_rates": f"SELECT count(*) AS total, count(*) FILTER (WHERE overall_pass) AS overall, count(*) FILTER (WHERE axis1_pass) AS axis1, count(*) FILTER (WHERE axis2_pass) AS axis2 FROM ({_EVALS})",
    "unjudged_fetch": "SELECT doc_id AS question_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id LIMIT 25",
    "unjudged_count": "SELECT count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "sample_reasons": "SELECT doc_id AS question_id, substr('low quality ' || doc_id, 1, 110) AS reason FROM labels WHERE quality <> 1 ORDER BY doc_id LIMIT 5",
    "status_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "latest_status": "SELECT user_id AS persona_id, event_id AS seq, event_type AS status FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "coverage_histogram": "SELECT json_extract_string(props, '$.k') AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 12",
    "coverage_histograms": "WITH u AS (SELECT 'lang' AS field, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'topic', (n_chars % 7)::VARCHAR FROM documents), c AS (SELECT field, value, count(*) AS n FROM u GROUP BY 1, 2) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY field ORDER BY n DESC, value) <= 12",
    "quality_summary": f"SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS passed, count(*) FILTER (WHERE toxic = 1) AS near_dups, count(*) FILTER (WHERE quality = 0) AS duplicates, round(avg(length(text)), 6) AS avg_length, round(avg(round({_RATIO}, 6)), 6) AS avg_ratio FROM documents LEFT JOIN labels USING (doc_id)",
    "hash_duplicate_rate": f"SELECT count(*) AS total, count(DISTINCT {_HASH}) AS distinct_hashes, round(100.0::DOUBLE * (1.0::DOUBLE - count(DISTINCT {_HASH})::DOUBLE / count(*)), 4) AS duplicate_pct FROM documents",
    "exact_dup_flags": f"WITH h AS (SELECT doc_id, {_HASH} AS dedup_hash FROM documents) SELECT dedup_hash, doc_id, row_number() OVER (PARTITION BY dedup_hash ORDER BY doc_id) > 1 AS duplicate FROM h",
    "opener_diversity": f"WITH o AS (SELECT array_to_string(({_TOKENS})[1:6], ' ') AS o FROM documents) SELECT count(*) AS total, count(DISTINCT o) AS distinct_openers, round(100.0::DOUBLE * count(DISTINCT o)::DOUBLE / count(*), 4) AS distinct_pct FROM o",
    "overused_openers": f"WITH c AS (SELECT profession, region, opener, count(*) AS n, min(seq) AS first_seq FROM ({_MEMORY}) WHERE opener <> '' GROUP BY 1, 2, 3 HAVING count(*) >= 2) SELECT *, row_number() OVER (PARTITION BY profession, region ORDER BY n DESC, first_seq)::INT AS rank FROM c QUALIFY rank <= 5",
    "tiered_exemplars": _exemplar_sql(),
    "near_duplicates": _near_sql(500),
    "near_duplicates_recent": _near_sql(20),
    "mean_pairwise_cosine": "WITH p AS (SELECT a.label, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id), n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) SELECT n.label, n.n, round(avg(s), 6) AS mean_cosine FROM n LEFT JOIN p ON p.label = n.label GROUP BY n.label, n.n",
    "script_ratio_gate": _gate_sql(),
    "last_draft": _DRAFTS,
    "strip_think": f"SELECT doc_id, md5({_THINKLESS}) AS text_md5 FROM ({_REPLY})",
    "tag_litter": r"SELECT page_id, md5(regexp_replace(html, '</?[a-zA-Z][\w\-]{0,30}>', '', 'g')) AS text_md5 FROM pages",
    "parse_verdicts": "WITH v AS (SELECT doc_id, quality = 1 AS a1, toxic = 0 AS a2, quality <> 1 AND doc_id % 3 = 0 AS bare FROM labels) SELECT doc_id, CASE WHEN NOT bare THEN a1 END AS axis1_pass, CASE WHEN NOT bare THEN a2 END AS axis2_pass, CASE WHEN NOT bare THEN a1 AND a2 END AS overall_pass FROM v",
    "parse_quality_replies": "SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR quality = 1 THEN 'PASS' ELSE 'FAIL' END AS verdict, true AS in_script, CASE WHEN doc_id % 4 < 2 THEN 1 ELSE 0 END::BIGINT AS n_reasons FROM labels",
    "quality_score": f"WITH h AS (SELECT doc_id, round({_RATIO}, 6) AS r, row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) > 1 AS dup FROM documents) SELECT doc_id, round(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + r - CASE WHEN dup THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END, 6) AS score FROM h LEFT JOIN labels USING (doc_id)",
    "best_attempt": f"SELECT conv_id, role = 'assistant' AS passed, round({_RATIO}, 6) AS ratio, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY (role = 'assistant')::INT DESC, round({_RATIO}, 6) DESC, turn, role DESC) = 1",
    "stratified_cells": _cells_sql(),
    "weighted_choice": "WITH u AS (SELECT doc_id, ('0x' || substr(md5('region|' || doc_id), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u FROM documents) SELECT doc_id, round(u, 9) AS u, CASE WHEN u < 25.0::DOUBLE / 140 THEN 'hub' WHEN u < 61.0::DOUBLE / 140 THEN 'town' ELSE 'village' END AS pick FROM u",
    "topic_counts": _TOPIC_COUNTS,
    "topic_rollup": f"WITH c AS (SELECT topic, n, {_CATEGORY} AS category FROM ({_TOPIC_COUNTS})) SELECT category, sum(n)::BIGINT AS n, count(*) AS n_topics, string_agg(topic, '|' ORDER BY n DESC, topic) AS topics, round(100.0::DOUBLE * sum(n)::BIGINT / (sum(sum(n)) OVER ())::BIGINT, 4) AS share_pct FROM c GROUP BY category",
    "topic_evenness": f"WITH c AS (SELECT topic, n, {_CATEGORY} AS category FROM ({_TOPIC_COUNTS})) SELECT sum(n)::BIGINT AS total, min(n) AS least, max(n) AS most, count(*) AS topics, count(DISTINCT category) AS categories, round(max(n)::DOUBLE / min(n), 6) AS evenness FROM c",
    "claim_batch": f"WITH l AS ({_LATEST}) SELECT c_custkey AS persona_id, coalesce(attempts, 0) AS attempts FROM customer LEFT JOIN l ON l.persona_id = c_custkey WHERE status IS NULL OR status = 'pending' OR (status = 'processing' AND run_id <> 'run1') ORDER BY c_custkey LIMIT 100",
    "resume_status": f"WITH l AS ({_LATEST}) SELECT c_custkey AS persona_id, coalesce(attempts, 0)::INT AS attempts FROM customer LEFT JOIN l ON l.persona_id = c_custkey WHERE status IS NULL OR status = 'pending' OR (status = 'processing' AND run_id <> 'run1')",
    "worst_cohorts_by_dimension": f"WITH j AS (SELECT source, lang, (n_chars % 7)::VARCHAR AS topic, overall_pass FROM ({_EVALS}) e JOIN documents d ON d.doc_id = e.question_id), u AS (SELECT 'source' AS dimension, source AS cohort, overall_pass FROM j UNION ALL SELECT 'lang', lang, overall_pass FROM j UNION ALL SELECT 'topic', topic, overall_pass FROM j), g AS (SELECT dimension, cohort, count(*) AS n, count(*) FILTER (WHERE NOT overall_pass) AS fails, round(100.0 * count(*) FILTER (WHERE NOT overall_pass) / count(*), 1)::DOUBLE AS fail_pct FROM u GROUP BY 1, 2 HAVING count(*) >= 20) SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY fail_pct DESC, cohort) <= 6",
    "dead_letter": f"SELECT persona_id, attempts + 1 AS attempts, CASE WHEN attempts + 1 >= 3 THEN 'failed' ELSE 'pending' END AS status FROM ({_LATEST}) WHERE status = 'processing'",
    "prompt_messages": f"SELECT doc_id, 'system' AS role, md5('{prompts.JUDGE_SYSTEM}') AS content_md5 FROM documents UNION ALL SELECT doc_id, 'user', md5({_JUDGE_TEXT}) FROM documents",
    "idempotent_save": "SELECT doc_id AS question_id, quality, toxic FROM labels WHERE doc_id % 3 <> 0",
    "orphan_questions": "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_custkey % 7 <> 0)",
    "topic_similarity_pairs": "SELECT a.label, a.vec_id AS first, b.vec_id AS second, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3",
    "csv_roundtrip": "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents",
    "streaming_memory": f"WITH h AS (SELECT doc_id, {_HASH} AS dedup_hash FROM documents) SELECT doc_id, dedup_hash, row_number() OVER (PARTITION BY dedup_hash ORDER BY doc_id) > 1 AS duplicate FROM h",
    "memory_context": f"WITH m AS ({_MEMORY}), c AS (SELECT profession, region, opener, count(*) AS n, min(seq) AS f FROM m WHERE opener <> '' GROUP BY 1, 2, 3 HAVING count(*) >= 2), o AS (SELECT profession, region, string_agg(opener, '|' ORDER BY n DESC, f) AS avoid FROM (SELECT *, row_number() OVER (PARTITION BY profession, region ORDER BY n DESC, f) AS r FROM c) WHERE r <= 5 GROUP BY 1, 2) SELECT m.seq AS persona_id, coalesce(avoid, '') AS avoid, 3::BIGINT AS n_exemplars FROM m LEFT JOIN o USING (profession, region)",
    "share_of_total": "SELECT source, count(*) AS n, round(100.0::DOUBLE * count(*) / (sum(count(*)) OVER ())::BIGINT, 4) AS share_pct, round(100.0::DOUBLE * count(*) / max(count(*)) OVER (), 4) AS bar_pct FROM documents GROUP BY 1",
}
