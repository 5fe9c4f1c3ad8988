"""The queries of the training-data operators and their SQL, where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.llm.common import table
from quillspark.llm.op01_packing import pack
from quillspark.llm.op02_sharding import shard_documents
from quillspark.llm.op03_pii import find_pii
from quillspark.llm.op04_quality import RULES, STOP_WORDS, score_quality
from quillspark.llm.op05_secrets import scan_secrets
from quillspark.llm.op06_neardup import near_duplicates
from quillspark.llm.op07_mixing import SCHEDULES, mix_documents
from quillspark.llm.op08_licenses import scan_licenses
from quillspark.llm.op09_knn import top_k
from quillspark.llm.op10_pst import score_documents


def op1_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    """All documents as the compacted store gives them back: an exact round trip."""
    rows = shard_documents(table(spark, sf_dir, "documents")).read()
    return rows.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


def op3_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents"))


def op10_pst(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"))


def op5_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


def op6_neardup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mix_documents(table(spark, sf_dir, "documents"))


def op8_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op9_knn(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


def _quality_sql() -> str:
    stops = " ".join(f"WHEN '{k}' THEN len(list_filter(w, lambda x: lower(x) IN ({', '.join(repr(x) for x in v)})))" for k, v in sorted(STOP_WORDS.items()))
    share = {
        "mean_word_length": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "stop_word_share": "stops / nullif(n_words, 0)",
        "letter_word_share": "letters / nullif(n_words, 0)",
        "duplicate_line_share": "n_dup_lines / nullif(lines, 0)",
        "bullet_line_share": "bullets / nullif(lines, 0)",
        "ellipsis_line_share": "dots / nullif(lines, 0)",
    }
    rules = " AND ".join(f"coalesce({share[n]} {how} {b}, {'stops IS NULL OR ' if n == 'stop_word_share' else ''}0 {how} {b})" for n, how, b in RULES)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
a AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
p AS (SELECT rid, unnest(generate_series(1, len(w) - 2)) AS i, w FROM a WHERE len(w) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM p),
r AS (SELECT rid, count(DISTINCT j) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c > 1) GROUP BY rid),
m AS (SELECT a.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(r.n_repeat_words, 0) AS n_repeat_words, len(l) AS lines,
        CASE lang {stops} END AS stops,
        len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS letters,
        len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS bullets,
        len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS dots
      FROM a LEFT JOIN r USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND ({rules}) AS kept
FROM f"""


def _position_sql() -> str:
    """The inverse of each schedule's integral, as CASE branches over the share u."""
    out = []
    for w, knots in sorted(SCHEDULES.items()):
        parts = [(t0, t1, r0, r1, (t1 - t0) * (r0 + r1) / 2) for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        whole, done = sum(p[4] for p in parts), 0.0
        for t0, t1, r0, r1, area in parts:
            rest, bend = f"(u * {whole!r}::DOUBLE - {done!r}::DOUBLE)", (r1 - r0) / (t1 - t0)
            here = f"{rest} / {r0!r}::DOUBLE" if bend == 0 else f"(sqrt(greatest({r0 * r0!r}::DOUBLE + {2 * bend!r}::DOUBLE * {rest}, 0.0::DOUBLE)) - {r0!r}::DOUBLE) / ({bend!r}::DOUBLE)"
            done += area
            out.append(f"WHEN weight = {w} AND u * {whole!r}::DOUBLE < {done!r}::DOUBLE THEN {t0!r}::DOUBLE + {here}")
    return "CASE WHEN u IS NULL THEN NULL " + " ".join(out) + " ELSE 1.0::DOUBLE END"


_MIXING_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight, 3 * source_size AS cap FROM s),
f AS (SELECT *, cap::DOUBLE / weight AS fill FROM r),
c AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
      FROM f WINDOW w AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT *, (SELECT level FROM c WHERE level <= fill ORDER BY fill, source NULLS LAST LIMIT 1) AS final FROM c),
t AS (SELECT source, source_size, weight, CASE WHEN level > fill THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * final) END AS target FROM e),
b AS (SELECT d.*, t.source_size, t.weight, t.target,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CASE WHEN size > 0 THEN (before + size / 2.0::DOUBLE < target)::INT + (source_size + before + size / 2.0::DOUBLE < target)::INT
        + (2 * source_size + before + size / 2.0::DOUBLE < target)::INT ELSE 0 END::BIGINT AS copies FROM b),
u AS (SELECT *, CASE WHEN copies > 0 THEN (before + size / 2.0::DOUBLE) / target END AS u FROM n)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies, floor(1e6::DOUBLE * ({_position_sql()}))::BIGINT AS first_position FROM u"""

_KNN_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


QUERIES = {
    "op1_packing": op1_packing,
    "op2_sharding": op2_sharding,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_neardup": op6_neardup,
    "op7_mixing": op7_mixing,
    "op8_licenses": op8_licenses,
    "op9_knn": op9_knn,
    "op10_pst": op10_pst,
}
ORACLE = {
    "op2_sharding": "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents",
    "op4_quality": _quality_sql(),
    "op7_mixing": _MIXING_SQL,
    "op9_knn": _KNN_SQL,
}
