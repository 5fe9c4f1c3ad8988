"""Reports: coverage, quality, diversity, topics and worst cohorts. Each is one or two aggregates."""

from __future__ import annotations

import html
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.plans.domains import TOPIC_CATEGORY


def count_rows(df: DataFrame, status: str | None = None) -> int:
    return (df if status is None else df.where(F.col("status") == status)).count()


def status_counts(df: DataFrame, col: str = "status") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def histogram(df: DataFrame, value: Column, top: int = 12) -> DataFrame:
    """(value, n): the most frequent values, ties by value."""
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(top)


def histograms(df: DataFrame, fields: dict[str, Column], top: int = 12) -> DataFrame:
    """(field, value, n) of several fields in one scan: the fields are unpivoted, then counted."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value")) for n, c in fields.items()]))
    counted = df.select(pairs.alias("x")).select("x.*").groupBy("field", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= top)


def quality_summary(df: DataFrame, passed: Column, near_dup: Column, duplicate: Column, text: Column, ratio: Column) -> DataFrame:
    """Counts by flag, mean length and mean ratio, in one pass; nulls count for no flag."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce(passed, F.lit(False))).alias("passed"),
        F.count_if(F.coalesce(near_dup, F.lit(False))).alias("near_dups"),
        F.count_if(F.coalesce(duplicate, F.lit(False))).alias("duplicates"),
        F.round(F.avg(F.length(text)), 6).alias("avg_length"),
        F.round(F.avg(ratio), 6).alias("avg_ratio"),
    )


def duplicate_rate(df: DataFrame, hash_col: str) -> DataFrame:
    """Two aggregates, so that a hot hash is folded before the shuffle."""
    whole = df.where(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("total"), F.count("*").alias("distinct_hashes"))
    rate = F.when(F.col("total") > 0, F.round(100.0 * (1.0 - F.col("distinct_hashes").cast("double") / F.col("total")), 4)).otherwise(F.lit(0.0))
    return whole.withColumn("duplicate_pct", rate)


def opener_diversity(df: DataFrame, opener_col: str) -> DataFrame:
    whole = df.where(F.col(opener_col).isNotNull()).groupBy(opener_col).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("total"), F.count("*").alias("distinct_openers"))
    return whole.withColumn("distinct_pct", F.when(F.col("total") > 0, F.round(100.0 * F.col("distinct_openers").cast("double") / F.col("total"), 4)).otherwise(F.lit(0.0)))


def pass_rates(evals: DataFrame) -> DataFrame:
    return evals.agg(F.count("*").alias("total"), F.count_if("overall_pass").alias("overall"), F.count_if("axis1_pass").alias("axis1"), F.count_if("axis2_pass").alias("axis2"))


def worst_cohorts(evals: DataFrame, cohort: str, least: int = 20, top: int = 6) -> DataFrame:
    """Cohorts of at least `least` evaluations by share of failures, ties by name."""
    grouped = evals.groupBy(F.col(cohort).alias("cohort")).agg(F.count("*").alias("n"), F.count_if(~F.col("overall_pass")).alias("fails"))
    pct = F.round((F.lit(100).cast("decimal(20,0)") * F.col("fails") / F.col("n")), 1).cast("double")
    return grouped.where(F.col("n") >= least).withColumn("fail_pct", pct).orderBy(F.desc("fail_pct"), "cohort").limit(top)


def worst_cohorts_of(evals: DataFrame, dimensions: dict[str, Column], least: int = 20, top: int = 6) -> DataFrame:
    """(dimension, cohort, n, fails, fail_pct): `worst_cohorts` of several dimensions in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("cohort")) for n, c in dimensions.items()]))
    grouped = evals.select(pairs.alias("x"), "overall_pass").groupBy("x.dimension", "x.cohort").agg(F.count("*").alias("n"), F.count_if(~F.col("overall_pass")).alias("fails"))
    pct = F.round((F.lit(100).cast("decimal(20,0)") * F.col("fails") / F.col("n")), 1).cast("double")
    rank = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("fail_pct"), "cohort"))
    return grouped.where(F.col("n") >= least).withColumn("fail_pct", pct).withColumn("rank", rank).where(F.col("rank") <= top).drop("rank")


def sample_reasons(evals: DataFrame, axis: str, n: int = 5, chars: int = 110) -> DataFrame:
    bad = evals.where(~F.col(f"{axis}_pass") & (F.col(f"{axis}_reason") != ""))
    return bad.orderBy("question_id").limit(n).select("question_id", F.substring(f"{axis}_reason", 1, chars).alias("reason"))


def unjudged(questions: DataFrame, evals: DataFrame, key: str = "question_id", limit: int | None = None) -> DataFrame:
    rows = questions.join(evals.select(key), key, "left_anti")
    return rows if limit is None else rows.orderBy(key).limit(limit)


def topic_counts(questions: DataFrame, personas: DataFrame) -> DataFrame:
    joined = questions.select("persona_id").join(personas.select("persona_id", F.col("json_metadata.pain_point").alias("topic")), "persona_id")
    return joined.groupBy("topic").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic")


def with_category(counts: DataFrame, categories: dict[str, str] = TOPIC_CATEGORY, topic: str = "topic") -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    return counts.withColumn("category", F.coalesce(F.try_element_at(table, F.col(topic)), F.lit("Other")))


def category_rollup(counts: DataFrame, topic: str = "topic") -> DataFrame:
    """(category, n, topics, share_pct): topics by falling count."""
    grouped = counts.groupBy("category").agg(F.sum("n").cast("long").alias("n"), F.count("*").alias("n_topics"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(topic).alias("t")))).alias("x"))
    total = F.sum("n").over(Window.partitionBy())
    return grouped.select("category", "n", "n_topics", F.transform("x", lambda x: x["t"]).alias("topics"), F.round(100.0 * F.col("n") / total, 4).alias("share_pct")).orderBy(F.desc("n"), "category")


def evenness(counts: DataFrame) -> DataFrame:
    whole = counts.agg(F.sum("n").cast("long").alias("total"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("topics"), F.count_distinct("category").alias("categories"))
    return whole.withColumn("evenness", F.when(F.col("least") != 0, F.round(F.col("most").cast("double") / F.col("least"), 6)).otherwise(F.lit(0.0)))


def format_eta(seconds: float | None) -> str:
    if seconds is None or seconds != seconds or seconds in (float("inf"), float("-inf")):
        return "-"
    whole = int(seconds)
    return f"{whole // 3600}:{whole // 60 % 60:02d}:{whole % 60:02d}"


def text_report(personas: DataFrame, questions: DataFrame) -> str:
    """The coverage, quality and diversity report as text; only aggregates reach the driver."""
    flags = F.col("quality_flags")
    out = ["Status"] + [f"  {r['status']}: {r['n']:,}" for r in status_counts(personas).collect()]
    q = quality_summary(questions, flags["judge"]["verdict"] == "PASS", flags["near_dup"], flags["duplicate"], F.col("question_text"), flags["script_ratio"]).first()
    out += ["Quality", *(f"  {k}: {q[k]}" for k in ("total", "passed", "near_dups", "duplicates", "avg_length", "avg_ratio"))]
    d, o = duplicate_rate(questions, "dedup_hash").first(), opener_diversity(questions, "opener").first()
    out += ["Diversity", f"  duplicates: {d['duplicate_pct']:.1f} %", f"  distinct openers: {o['distinct_pct']:.1f} %"]
    meta = personas.join(questions.select("persona_id"), "persona_id")
    rows = histograms(meta, {n: F.col(f"json_metadata.{n}") for n in ("location", "profession", "pain_point", "education")}).orderBy("field", "rank").collect()
    for field in ("location", "profession", "pain_point", "education"):
        out += [f"Coverage: {field}"] + [f"  {(r['value'] or 'null')[:34]:<34} {r['n']:,}" for r in rows if r["field"] == field]
    return "\n".join(out)


def judge_report(evals: DataFrame, personas: DataFrame, least: int = 20, top: int = 6) -> str:
    p = pass_rates(evals).first()
    if not p["total"]:
        return "no evaluations"
    out = [f"{n}: {p[n]:,} of {p['total']:,} ({100 * p[n] / p['total']:.1f} %)" for n in ("overall", "axis1", "axis2")]
    joined = evals.join(personas.select("persona_id", "json_metadata.*"), "persona_id")
    dims = ("profession", "education", "pain_point")
    worst = worst_cohorts_of(joined, {d: F.col(d) for d in dims}, least, top).orderBy("dimension", F.desc("fail_pct"), "cohort").collect()
    for dim in dims:
        out += [f"Worst by {dim}"] + [f"  {r['cohort']}: {r['fail_pct']} % of {r['n']}" for r in worst if r["dimension"] == dim]
    for axis in ("axis1", "axis2"):
        out += [f"Reasons, {axis}"] + [f"  {r['question_id']}: {r['reason']}" for r in sample_reasons(evals, axis).collect()]
    return "\n".join(out)


def topic_html(questions: DataFrame, personas: DataFrame, path: str, categories: dict[str, str] = TOPIC_CATEGORY) -> str | None:
    """Write the topic report; nothing is written if there are no questions. A row per topic reaches the driver."""
    counts = with_category(topic_counts(questions, personas), categories)
    rows = counts.collect()
    if not rows:
        return None
    whole, groups = evenness(counts).first(), category_rollup(counts).collect()
    most = max(r["n"] for r in rows)
    cell = lambda x: html.escape(str(x))
    bar = lambda n, scale: f'<div style="background:#468;height:10px;width:{100 * n / scale if scale else 0:.1f}%"></div>'
    tiles = {"Questions": f"{whole['total']:,}", "Done": f"{count_rows(personas, 'done'):,}", "Topics": whole["topics"], "Categories": whole["categories"], "Range": f"{whole['least']:,} to {whole['most']:,}", "Evenness": f"{whole['evenness']:.2f}"}
    body = "".join(f"<li><b>{cell(k)}</b> {cell(v)}</li>" for k, v in tiles.items())
    cats = "".join(f"<tr><td>{cell(g['category'])}<td>{g['n']:,}<td>{g['share_pct']:.1f} %<td>{bar(g['n'], groups[0]['n'])}</tr>" for g in groups)
    parts = "".join(f"<h3>{cell(g['category'])}</h3><table>" + "".join(f"<tr><td>{cell(r['topic'])}<td>{r['n']:,}<td>{bar(r['n'], most)}</tr>" for r in rows if r["category"] == g["category"]) + "</table>" for g in groups)
    Path(path).write_text(f"<!doctype html><meta charset=utf-8><title>Topics</title><h1>Topics</h1><ul>{body}</ul><h2>Categories</h2><table>{cats}</table>{parts}", encoding="utf-8")
    return path
