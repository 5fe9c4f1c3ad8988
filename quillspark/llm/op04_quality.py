"""Quality rules (operator 4): a threshold table compiled into one projection.

`RULES` holds one row per limit: the statistic, the comparison and the bound.
`compile_rules` turns the table into a single boolean column over built-in
functions, so the whole operator is a scan and projections: no shuffle, no
user function, and each text is read once.

Defined results: a null text counts as empty (no words, base_failed, not
kept); a null language, or one that `STOP_WORDS` lacks, skips the stop-word
rule; repeated rows each get their own row; an empty table gives an empty
result; other columns, whatever their names, are ignored by `score_quality`
and passed through by `keep_quality`. Windows are compared by a 64-bit hash
of their three words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import free_prefix, text_or_empty, words_array

#: Frequent words by language; punctuation that touches a word hides it, so limits on them are low.
STOP_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "was", "are", "as", "by", "this", "from"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "una", "su", "para", "es", "al", "lo", "como"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "plus", "pas", "au"],
}

#: (statistic, comparison, bound). A document is kept if every row holds.
RULES: tuple[tuple[str, str, float], ...] = (
    ("mean_word_length", ">=", 2.0),
    ("mean_word_length", "<=", 15.0),
    ("symbols_per_word", "<=", 0.1),
    ("stop_word_share", ">=", 0.01),
    ("letter_word_share", ">=", 0.6),
    ("duplicate_line_share", "<=", 0.5),
    ("bullet_line_share", "<=", 0.9),
    ("ellipsis_line_share", "<=", 0.3),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Prefix of temporary columns; lengthened where a column of the table begins so.
_T = "qr_"
_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _count_in(words: Column, listed: list[str]) -> Column:
    return F.size(F.filter(words, lambda x: F.lower(x).isin(listed)))


def _measured(docs: DataFrame, _T: str) -> DataFrame:
    """docs with temporary columns `_T*`: words, lines and the counts over them."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    out = docs.withColumns({_T + "text": text_or_empty(), _T + "lang": lang})
    out = out.withColumns(
        {
            _T + "w": words_array(F.col(_T + "text")),
            _T + "l": F.filter(F.split(F.col(_T + "text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    w = F.col(_T + "w")
    n = F.size(w)
    windows = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    # The row number, always true, keeps filters on what follows above this projection;
    # pushed below it, each use of the word array would split the text again.
    windows = F.when(F.monotonically_increasing_id() >= 0, windows)
    stops = F.lit(None).cast("int")
    for code, words in sorted(STOP_WORDS.items()):
        stops = F.when(F.col(_T + "lang") == code, _count_in(w, words)).otherwise(stops)
    lines = F.col(_T + "l")
    out = out.withColumns(
        {
            _T + "n_words": n.cast("long"),
            _T + "word_chars": F.length(F.array_join(w, "")).cast("long"),
            _T + "n_symbols": F.regexp_count(F.col(_T + "text"), F.lit(r"[#*$%&|<>]")).cast("long"),
            _T + "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            _T + "stops": stops,
            _T + "letters": F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))),
            _T + "lines": F.size(lines),
            _T + "bullets": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))),
            _T + "dots": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))),
            _T + "g": F.sort_array(windows),
        }
    )
    g = F.col(_T + "g")
    again = F.filter(g, lambda x, i: F.coalesce(x["h"] == F.get(g, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(g, i + 1)["h"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    return out.withColumn(_T + "n_repeat_words", F.size(covered).cast("long"))


def _statistic(name: str, _T: str) -> Column:
    c = lambda x: F.col(_T + x)
    return {
        "mean_word_length": _share(c("word_chars"), c("n_words")),
        "symbols_per_word": _share(c("n_symbols"), c("n_words")),
        "stop_word_share": _share(c("stops"), c("n_words")),
        "letter_word_share": _share(c("letters"), c("n_words")),
        "duplicate_line_share": _share(c("n_dup_lines"), c("lines")),
        "bullet_line_share": _share(c("bullets"), c("lines")),
        "ellipsis_line_share": _share(c("dots"), c("lines")),
    }[name]


def compile_rules(rules: tuple[tuple[str, str, float], ...] = RULES, prefix: str = _T) -> Column:
    """One boolean column over the counts under `prefix`: true where every rule holds. A null statistic passes."""
    verdict = F.lit(True)
    for name, how, bound in rules:
        x = _statistic(name, prefix)
        holds = x >= F.lit(bound) if how == ">=" else x <= F.lit(bound)
        verdict = verdict & F.coalesce(holds, F.lit(True))
    return verdict


def _judged(docs: DataFrame, rules, _T: str) -> DataFrame:
    out = _measured(docs, _T)
    n, repeated = F.col(_T + "n_words"), F.col(_T + "n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
    out = out.withColumn(_T + "base_failed", failed)
    return out.withColumn(_T + "kept", ~F.col(_T + "base_failed") & compile_rules(rules, _T))


def score_quality(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the five counts, base_failed and kept of every row."""
    out = _judged(docs.select(*[c for c in ("doc_id", "text", "lang") if c in docs.columns]), rules, _T)
    return out.select("doc_id", *[F.col(_T + c).alias(c) for c in (*_METRICS, "base_failed", "kept")])


def keep_quality(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns."""
    tmp = free_prefix(docs.columns, _T)
    return _judged(docs, rules, tmp).where(F.col(tmp + "kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
