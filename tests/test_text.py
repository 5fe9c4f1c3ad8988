"""Scalar functions against worked values."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import parsers
from quillspark.functions import text as tx

CASES = [  # text, Bengali, letters and digits, hash prefix
    ("আমার NID তে নাম ভুল, ঠিক করব কিভাবে?", 24, 27, "e9e5195c"),
    ("", 0, 0, "da39a3ee"),
    ("!!! ...", 0, 0, "da39a3ee"),
    ("NID SMS app ভুল", 3, 12, "099fa4b3"),
    ("ＮＩＤ ভুল ৩ বার", 7, 7, "c049dd77"),
    ("১২৩ 456", 3, 6, "b374f3db"),
]


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,own,whole,prefix", CASES)
def test_ratio_and_hash(spark, text, own, whole, prefix):
    assert one(spark, text, tx.script_ratio(F.col("t"))) == (own / whole if whole else 0.0)
    assert one(spark, text, tx.dedup_hash(F.col("t")))[:8] == prefix


def test_gate(spark):
    gate = lambda t: one(spark, t, tx.quality_gate(F.col("t"), 0.65, ["kindly"], ["বিনীত"]))
    assert gate(CASES[0][0])["programmatic_pass"]
    assert not gate("kindly আমার কার্ড দেন")["programmatic_pass"] and gate("kindly আমার কার্ড দেন")["banned_phrases"] == ["kindly"]
    assert gate("  \n")["empty"]
    assert one(spark, "x", tx.round_half_even(F.lit(1 / 16), F.lit(3))) == 0.062


def test_opener_strips_unicode_space(spark):
    assert one(spark, "  আমার NID তে  নাম ভুল, ঠিক করব", tx.opener(F.col("t"))) == "আমার nid তে নাম ভুল, ঠিক"


@pytest.mark.parametrize(
    "reply,want",
    [
        ("<draft_questions>a</draft_questions><draft_questions> b </draft_questions>", "b"),
        ("<think>x\ny</think><draft_questions>c</draft_questions>", "c"),
        ("<think>open <draft_questions>d</draft_questions>", "d"),
        ("Let me think. It is", ""),
        ("<draft_questions>never closed</p>", "never closed"),
        ("plain", "plain"),
    ],
)
def test_last_draft(spark, reply, want):
    assert one(spark, reply, tx.last_draft(F.col("t"))) == want


def test_quality_replies():
    read = parsers.read_quality
    assert read('{"verdict": "fail", "reasons": ["x"]}') == {"verdict": "FAIL", "in_script": True, "reasons": ["x"]}
    assert read('say ```json\n{"verdict": "FAIL"}\n```')["verdict"] == "FAIL"
    assert read('{"verdict": "FAIL", broken')["verdict"] == "FAIL"
    assert read('{"verdict": "PASS", "is_bengali": "false"}')["in_script"] is True
    assert read(None)["verdict"] == "PASS" and read("nothing")["verdict"] == "PASS"
    assert read('{"reasons": "one"}')["reasons"] == ["one"]


@pytest.mark.parametrize(
    "reply,want",
    [
        ('{"axis1": {"verdict": "PASS"}, "axis2": {"verdict": "PASS"}, "overall": "FAIL"}', True),
        ('{"axis1": {"verdict": "FAIL", "reason": ""}, "axis2": {"verdict": "PASS"}}', None),
        ('{"axis1": {"verdict": "FAIL", "reason": "r"}, "axis2": {"verdict": "PASS"}}', False),
        ('{"axis1": {"verdict": "PASS"}}', None),
        ('{"axis1": "PASS", "axis2": "PASS"}', True),
        ('{"other": 1} {"axis1": "PASS", "axis2": "PASS"}', True),
        ('{"axis1": {"verdict": "FAIL", "reason": "}"}, "axis2": "PASS"}', None),
        ("", None),
    ],
)
def test_verdicts(spark, reply, want):
    got = one(spark, reply, parsers.parse_verdict(F.col("t")))
    assert (got and got["overall_pass"]) == want if want is not None else got is None


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='{}[]":,axis12PASFIL \n`json', max_size=80))
def test_parsers_never_raise(text):
    assert parsers.read_quality(text)["verdict"] in ("PASS", "FAIL")
    parsers.read_axes(text)
    for part in parsers.brace_spans(text):
        assert part[0] == "{" and part[-1] == "}"


def test_score_and_dot(spark):
    score = tx.quality_score(F.lit("PASS"), F.lit(0.9), F.lit(True))
    assert one(spark, "x", score) == pytest.approx(1.4)
    assert one(spark, "x", tx.dot(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(0.5)))) == 4.0


def test_normal_form_is_sha1(spark):
    assert one(spark, "Ab, c!", tx.dedup_hash(F.col("t"))) == hashlib.sha1(b"ab c").hexdigest()


def plain_spans(text):
    """Balanced top-level parts, character by character."""
    out, open_ = [], []
    for i, c in enumerate(text):
        if c == "{":
            open_.append(i)
        elif c == "}" and open_:
            begin = open_.pop()
            if not open_:
                out.append(text[begin : i + 1])
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="{}a\"", max_size=40))
def test_brace_spans_match_a_scanner(text):
    assert list(parsers.brace_spans(text)) == plain_spans(text)


def test_unused_by_queries_but_offered(spark):
    from quillspark.plans import prompts

    assert one(spark, "x <t> in\nside </t> <t>b</t>", tx.extract_tag(F.col("t"), "t")) == "in\nside" and one(spark, "x", tx.extract_tag(F.col("t"), "t")) is None
    assert one(spark, "a ```json\n{1}``` ```two```", tx.code_fence(F.col("t"))) == "{1}" and one(spark, "plain", tx.code_fence(F.col("t"))) == "plain"
    assert one(spark, 'x } {"a": {}} {', parsers.brace_objects(F.col("t"))) == ['{"a": {}}']
    row = spark.createDataFrame([("p", None)], "profession string, json_metadata struct<profession:string,education:string>")
    assert row.select(tx.meta_field(row.columns, "profession"), tx.meta_field(row.columns, "education"), tx.meta_field(row.columns, "other")).first()[:] == ("p", "unknown", "unknown")
    lit = F.lit
    for fail in (True, False):
        got = one(spark, "d", prompts.rewrite_prompt(F.col("t"), lit("stiff"), lit(fail), lit("p"), lit("l"), lit("e")))
        assert [m["role"] for m in got] == ["system", "user"] and "stiff" in got[1]["content"] and ("transliteration" in got[1]["content"]) == fail


def test_nfkc_leaves_ascii_alone(spark):
    got = spark.createDataFrame([("ＮＩＤ",), ("plain",), (None,), ("",)], "t string").select(tx.nfkc(F.col("t")).alias("x")).collect()
    assert [r["x"] for r in got] == ["NID", "plain", None, ""]


def test_hashes_need_no_python(spark):
    """Whole texts in Arrow batches filled the Python workers; results are those of unicodedata."""
    texts = ["ﬁ x", "e\u0301", "Å", "①²", "ড\u09bc", "한", "ㅎㅏㄴ", "ｶﾞ", "\u1e9b\u0323", "😀 ﷺ", "q\u0323\u0307\u0301", "\x00é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.nfkc(F.col("t")).alias("x"), tx.dedup_hash(F.col("t")).alias("h"), tx.opener(F.col("t")).alias("o"))
    assert "Python" not in df._jdf.queryExecution().toString()
    for r in df.collect():
        assert r["x"] == unicodedata.normalize("NFKC", r["t"])
        assert r["h"] == hashlib.sha1(re.sub(r"[^\u0980-\u09ffa-z0-9]+", " ", r["x"].lower()).strip().encode()).hexdigest()


def test_texts_are_hashed_once(spark, sf_dir):
    from quillspark.queries import QUERIES

    for name in ("exact_dup_flags", "quality_score"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "documents.parquet" not in plan and "sha1" not in plan.lower()


def test_domains_from_json():
    from quillspark.plans.domains import Domains

    d = Domains.from_json('{"regions": ["a", "b"], "region_weights": [1, 2], "age_ranges": [[1, 2]], "age_weights": [1]}')
    assert d.regions == ("a", "b") and d.age_ranges == ((1, 2),) and d.genders == ("male", "female", "other")
    for bad in ('{"regions": ["a"]}', '{"none": []}'):
        with pytest.raises(ValueError):
            Domains.from_json(bad)
