"""Text functions as column expressions; only Python's way of rounding needs Python."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The script that texts are expected in, and what counts as a letter or digit. Fixed values.
BENGALI = r"\x{0980}-\x{09FF}"
ALNUM = "A-Za-z0-9"

#: Phrases that give a text away, matched in lower case and as they stand. Fixed values;
#: the Bengali ones are in decomposed form (U+09AF U+09BC).
BANNED_ANY_CASE = ["i would like to inquire", "i hope this message finds you well", "kindly", "furthermore", "please be advised"]
BANNED_EXACT = ["অনুগ্রহপূর্বক", "এতদ্বারা", "উক্ত বিষয়ে", "মহোদয়", "সম্মানিত", "বিনীত অনুরোধ", "সদয় অবগতি", "প্রসঙ্গে জানানো যাচ্ছে", "স্মারকে"]


def nfkc(text: Column) -> Column:
    """Unicode NFKC. ASCII texts are their own normal form, so only others are normalized.

    That is done by the ICU library that Spark ships for its collations, so no
    text leaves the JVM. Its tables are of Unicode 16: against Python 3.13 (15.1)
    they differ in 41 code points that 15.1 does not have.
    """
    normal = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return F.coalesce(F.when(F.octet_length(text) > F.length(text), normal), text)


@F.pandas_udf(T.DoubleType())
def round_half_even(x: pd.Series, digits: pd.Series) -> pd.Series:
    """round() of the binary value as Python has it; Spark's goes half up."""
    return pd.Series([None if v is None or v != v else round(float(v), int(d)) for v, d in zip(x, digits)])


def strip(text: Column) -> Column:
    """Trim all Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def script_ratio(text: Column, script: str = BENGALI, alnum: str = ALNUM) -> Column:
    """Share of letters and digits that belong to `script` (a regex class); 0 if there are none.

    If the script is part of `alnum`, the denominator is just the latter.
    """
    # What is left when the runs of all else are gone; counting matches would build a string for each.
    whole = F.length(F.regexp_replace(text, f"[^{script}{alnum}]+", ""))
    own = F.length(F.regexp_replace(text, f"[^{script}]+", ""))
    return F.coalesce(own.cast("double") / F.nullif(whole, F.lit(0)), F.lit(0.0))


def find_phrases(text: Column, any_case: list[str], exact: list[str]) -> Column:
    """The phrases that occur: first those matched on lower-cased text, then the exact ones, in list order."""
    lower = F.filter(F.array(*[F.lit(p) for p in any_case]) if any_case else F.array().cast("array<string>"), lambda p: F.contains(F.lower(text), p))
    raw = F.filter(F.array(*[F.lit(p) for p in exact]) if exact else F.array().cast("array<string>"), lambda p: F.contains(text, p))
    return F.concat(lower, raw)


def quality_gate(text: Column, least: float, any_case: list[str], exact: list[str], script: str = BENGALI, alnum: str = ALNUM, python_round: bool = False) -> Column:
    """struct(script_ratio, banned_phrases, empty, programmatic_pass); the test uses the unrounded ratio."""
    ratio, banned = script_ratio(text, script, alnum), find_phrases(text, any_case, exact)
    empty = F.length(strip(text)) == 0
    shown = round_half_even(ratio, F.lit(3)) if python_round else F.round(ratio, 3)
    return F.struct(shown.alias("script_ratio"), banned.alias("banned_phrases"), empty.alias("empty"), ((ratio >= least) & ~empty & (F.size(banned) == 0)).alias("programmatic_pass"))


def extract_tag(text: Column, tag: str) -> Column:
    """Inside of the first <tag>…</tag>, stripped; null if there is none."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return strip(F.try_element_at(found, F.lit(1)))


def strip_think(text: Column) -> Column:
    """Drop closed <think> blocks; one that is never closed stays."""
    return F.regexp_replace(text, r"(?is)<think>.*?</think>", "")


#: Short tags that models leave in a text. Fixed value.
SHORT_TAG = r"</?[a-zA-Z][\w\-]{0,30}>"


def strip_litter(text: Column, tag: str) -> Column:
    """Drop whatever is in angle brackets and names `tag`, then short tags."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?i)<[^>]*{tag}[^>]*>", ""), "(?U)" + SHORT_TAG, "")


#: How a leaked monologue begins. Fixed value.
MONOLOGUE = r"(?is)^(here'?s?\s+(a|my)\s+thinking\s+process|let me think|okay,?\s+so)"


def last_draft(text: Column, tag: str = "draft_questions") -> Column:
    """The last <tag> block; else nothing for a monologue; else the text without tag litter."""
    clean = strip(strip_think(text))
    blocks = F.regexp_extract_all(clean, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return F.when(F.size(blocks) > 0, strip(F.try_element_at(blocks, F.lit(-1)))).when(clean.rlike(MONOLOGUE), F.lit("")).otherwise(strip(strip_litter(clean, tag)))


def code_fence(text: Column) -> Column:
    """Inside of the first code fence, or the text if it has none."""
    found = F.regexp_extract_all(text, F.lit(r"(?is)```(?:json)?\s*(.*?)```"), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(1)), text)


def normal_form(text: Column, script: str = BENGALI, normalize: bool = True) -> Column:
    """Lower case, each run outside the script, a-z and 0-9 made one space, trimmed."""
    text = nfkc(text) if normalize else text
    # Two small classes intersected: Java is twice as slow on one class of several ranges.
    return F.trim(F.regexp_replace(F.lower(text), rf"[[^a-z0-9]&&[^{script}]]+", " "))


def dedup_hash(text: Column, script: str = BENGALI, normalize: bool = True) -> Column:
    return F.sha1(normal_form(text, script, normalize))


def opener(text: Column, tokens: int = 6, normalize: bool = True) -> Column:
    """The first tokens of a text, lower-cased, one space apart."""
    text = nfkc(text) if normalize else text
    parts = F.array_remove(F.split(F.lower(text), r"(?U)\s+"), "")
    return F.array_join(F.slice(parts, 1, tokens), " ")


def quality_score(verdict: Column, ratio: Column, duplicate: Column) -> Column:
    """1 for PASS, plus the script ratio, less a half for an exact duplicate."""
    passed = F.when(verdict == "PASS", 1.0).otherwise(0.0)
    return passed + F.coalesce(ratio, F.lit(0.0)) - F.when(F.coalesce(duplicate, F.lit(False)), 0.5).otherwise(0.0)


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def fill_template(template: str, **values: Column) -> Column:
    """`template` with each {name} replaced by a column."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def or_default(value: Column, default: str) -> Column:
    """`default` where the value is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def meta_field(df_columns: list[str], name: str, meta: str = "json_metadata") -> Column:
    """A metadata field, else the row's own column of that name, else 'unknown'."""
    chain = [F.get_json_object(F.to_json(meta), f"$.{name}")] if meta in df_columns else []
    chain += [F.col(name).cast("string")] if name in df_columns else []
    return F.coalesce(*[c.cast("string") for c in chain], F.lit("unknown"))
