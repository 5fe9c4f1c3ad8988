"""Operators on small tables, against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import sampling
from quillspark.functions import text as tx
from quillspark.operators import attempts, dedup, memory
from quillspark.plans import reports
from quillspark.plans.domains import TOPIC_CATEGORY, Domains


def test_cells_cover_evenly(spark):
    rows = sampling.stratified_cells(spark, 25_000, Domains()).collect()
    assert len({(r["profession"], r["pain_point"], r["education"]) for r in rows}) == 25_000
    for axis, n in (("profession", 62), ("pain_point", 55), ("education", 9)):
        counts = {}
        for r in rows:
            counts[r[axis]] = counts.get(r[axis], 0) + 1
        assert len(counts) == n and max(counts.values()) - min(counts.values()) <= 1


def test_domains_have_their_sizes():
    d = Domains()
    assert (len(d.regions), len(d.professions), len(d.topics), len(d.educations)) == (74, 62, 55, 9)
    assert len(d.regions) == len(d.region_weights) and abs(sum(d.region_weights) - 140) < 1e-9
    assert len(set(TOPIC_CATEGORY.values())) == 10


def test_personas_repeat(spark):
    a, b = (sampling.personas(spark, 50, Domains()).orderBy("persona_id").collect() for _ in range(2))
    assert a == b
    assert all(18 <= r["age"] <= 80 and r["json_metadata"]["random_seed"] <= 2**31 for r in a)


def test_personas_are_those_of_one_generator(spark):
    import random as rnd

    d = Domains()
    cell, seeds = rnd.Random(43), rnd.Random(42)
    axes = [list(d.professions), list(d.topics), list(d.educations)]
    for axis in axes:
        cell.shuffle(axis)
    got = sampling.personas(spark, 4100, d).orderBy("persona_id").collect()  # more than two blocks of seeds
    assert [r["persona_id"] for r in got] == list(range(1, 4101))
    for i, r in enumerate(got):
        seed = seeds.randint(0, 2**31)
        assert r["json_metadata"]["random_seed"] == seed
        assert (r["profession"], r["json_metadata"]["pain_point"], r["json_metadata"]["education"]) == tuple(a[i * k % len(a)] for a, k in zip(axes, (7, 13, 11)))
        if i % 500 == 0:  # drawn anew, step by step
            g = rnd.Random(seed)
            low, high = g.choices(d.age_ranges, weights=d.age_weights)[0]
            assert r["age"] == g.randint(low, high)
            assert r["gender"] == g.choices(d.genders, weights=d.gender_weights)[0]
            assert r["social_status"] == g.choices(d.statuses, weights=d.status_weights)[0]
            assert r["location"] == g.choices(d.regions, weights=d.region_weights)[0]
            detail, size, years = g.choice(d.life_details), g.randint(2, 8), g.randint(1, 30)
            detail = detail.replace("{location}", r["location"]).replace("{family_size}", str(size)).replace("{years_exp}", str(years))
            assert detail in r["backstory"] and f"Education: {r['json_metadata']['education']}." in r["backstory"]
            assert g.choice(d.backstories)[:6].split("{")[0] in r["backstory"]


def test_best_attempt_keeps_the_first_of_ties(spark):
    rows = [(1, False, 0.9, 0, "a"), (1, False, 0.9, 1, "b"), (1, False, 0.7, 2, "c"), (2, False, 0.99, 0, "d"), (2, True, 0.7, 1, "e")]
    got = attempts.best_attempt(spark.createDataFrame(rows, "k int, passed boolean, ratio double, no int, text string"), "k", "passed", "ratio", "no", ["text"])
    assert {r["k"]: r["text"] for r in got.collect()} == {1: "a", 2: "e"}


def test_states(spark):
    log = spark.createDataFrame([(1, 1, "r", 0, "processing", 0, None), (2, 1, "r", 0, "done", 0, None), (3, 1, "gone", 0, "processing", 1, None)], schemas.STATUS_LOG)
    people = spark.createDataFrame([(i,) for i in range(1, 5)], "persona_id long")
    assert {r["persona_id"] for r in attempts.pending(people, log, ("r",)).collect()} == {3, 4}
    assert {r["persona_id"] for r in attempts.pending(people, log).collect()} == {1, 3, 4}
    failed = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "persona_id long, attempts int")
    assert {r["persona_id"]: r["status"] for r in attempts.after_failure(failed).collect()} == {1: "pending", 2: "pending", 3: "failed"}


def test_save_once(spark):
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "question_id long, v string")
    assert {(r[0], r[1]) for r in attempts.save_once(new, new.where("question_id = 2"), "question_id").collect()} == {(1, "a")}


def test_openers_and_exemplars(spark):
    mem = [("p", "r", o) for o in ["a", "a", "a", "b", "c", "b", "c", "d"]]
    df = spark.createDataFrame([(i, *m) for i, m in enumerate(mem)], "seq long, profession string, region string, opener string")
    assert [r["opener"] for r in memory.overused_openers(df, ["profession", "region"]).orderBy("rank").collect()] == ["a", "b", "c"]


def test_exemplars_match_brute_force(spark):
    rng = random.Random(5)
    bank = [(i, rng.choice("pq"), rng.choice("rst"), rng.choice("xyz"), f"t{i}", rng.randint(0, 4) / 4) for i in range(60)]
    askers = [(i, p, r, t) for i, (p, r, t) in enumerate((p, r, t) for p in "pqz" for r in "rsw" for t in "xyv")]
    b = spark.createDataFrame(bank, "seq long, profession string, region string, topic string, text string, score double")
    a = spark.createDataFrame(askers, "persona_id long, profession string, region string, topic string")
    got = {}
    for r in memory.tiered_exemplars(a, b, 3).orderBy("persona_id", "rank").collect():
        got.setdefault(r["persona_id"], []).append(r["seq"])
    for i, p, r, t in askers:
        ranked = sorted((0 if x[1] == p else 1 if x[2] == r else 2, -x[5], x[0]) for x in bank if x[3] != t)
        assert got[i] == [x[2] for x in ranked[:3]]
    assert memory.tiered_exemplars(a, b, 0).count() == 0


def test_exemplars_whatever_is_left_out(spark):
    """Banks in which few values hold most of the best rows, so that a profile may leave out much."""
    for seed in range(3):
        rng = random.Random(seed)
        skew = lambda n: "abcdefgh"[min(int(rng.expovariate(1.2)), n - 1)]
        bank = [(i, skew(8), skew(5), skew(6), f"t{i}", float(rng.randint(0, 6))) for i in range(250)]
        askers = [(i, p, r, t) for i, (p, r, t) in enumerate((p, r, t) for p in "abz" for r in "abz" for t in "abz")]
        b = spark.createDataFrame(bank, "seq long, profession string, region string, topic string, text string, score double")
        a = spark.createDataFrame(askers, "persona_id long, profession string, region string, topic string")
        for k in (1, 4):
            got = {}
            for x in memory.tiered_exemplars(a, b, k).orderBy("persona_id", "rank").collect():
                got.setdefault(x["persona_id"], []).append(x["seq"])
            for i, p, r, t in askers:
                ranked = sorted((0 if x[1] == p else 1 if x[2] == r else 2, -x[5], x[0]) for x in bank if x[3] != t)
                assert got[i] == [x[2] for x in ranked[:k]]


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), None if rng.random() < 0.1 else [rng.choice([0.0, 0.6, 0.8]) for _ in range(2)]) for i in range(80)]
    df = spark.createDataFrame(rows, "seq long, c string, vec array<double>")
    got = {r["seq"]: r["near_dup"] for r in dedup.near_duplicates(df, ["c"], "seq", "vec", 0.96, 3).collect()}
    for i, c, v in rows:
        before = [r[2] for r in rows if r[1] == c and r[0] < i][-3:]
        assert got[i] == (v is not None and any(w is not None and v[0] * w[0] + v[1] * w[1] >= 0.96 for w in before))


def test_similar_pairs_match_brute_force(spark):
    """Blocks of all sizes, repeated ids, ties with the threshold, nulls, NaN and vectors of other lengths."""
    rng = random.Random(3)
    draw = lambda: [rng.choice([0.1, 0.3, 0.7, -0.2]) for _ in range(3)]
    odd = [None, [0.5, None, 0.5], [0.5, 0.5], [], [float("nan"), 0.1, 0.1], [1e300, 1e300, 1e300], [float("inf"), 0.0, 0.1]]
    rows = [(rng.choice(["a", "a", "b", None]), rng.randint(0, 50), odd[i] if i < len(odd) else draw()) for i in range(70)]
    df = spark.createDataFrame(rows, "c string, seq long, vec array<double>")
    cut = 0.1 * 0.3 + 0.3 * 0.7 + 0.7 * 0.7
    a, b = df.selectExpr("c", "seq first", "vec a"), df.selectExpr("c", "seq second", "vec b")
    want = a.join(b, "c").where("first < second").withColumn("similarity", tx.dot(F.col("a"), F.col("b"))).where(F.col("similarity") >= cut).select("c", "first", "second", "similarity")
    want = sorted(map(repr, want.collect()))
    assert len(want) > 50
    for block in (4, 30, 1000):
        got = dedup.similar_pairs(df, ["c"], "seq", "vec", cut, block)
        assert sorted(map(repr, got.collect())) == want


def test_similar_pairs_are_not_joined(spark):
    """The pairs of a cluster were the rows of a join; now a task meets two blocks."""
    df = spark.createDataFrame([("a", i, [1.0]) for i in range(9)], "c string, seq long, vec array<double>")
    got = dedup.similar_pairs(df, ["c"], "seq", "vec", 0.5, 2)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 36


def test_exact_duplicates_by_run(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "a"), (3, "y", "a"), (4, "x", None)], "i long, run string, h string")
    got = {r["i"]: r["duplicate"] for r in dedup.exact_duplicates(df, "h", ["i"], ["run"]).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_cohorts_and_evenness(spark):
    rows = [("a", i % 4 != 0) for i in range(40)] + [("b", True)] * 30 + [("c", False)] * 3
    got = reports.worst_cohorts(spark.createDataFrame(rows, "c string, overall_pass boolean"), "c", 20).collect()
    assert [(r["cohort"], r["fail_pct"]) for r in got] == [("a", 25.0), ("b", 0.0)]
    counts = spark.createDataFrame([("x", 4, "A"), ("y", 2, "B")], "topic string, n long, category string")
    assert reports.evenness(counts).first()["evenness"] == 2.0
    assert reports.format_eta(3725) == "1:02:05" and reports.format_eta(float("nan")) == "-"


def test_migration_is_idempotent(spark):
    old = spark.createDataFrame([(1, True), (2, None)], "persona_id long, processed boolean")
    once = schemas.migrate_personas(old)
    assert [r["status"] for r in once.orderBy("persona_id").collect()] == ["done", "pending"]
    assert schemas.migrate_personas(once).collect() == once.collect()
    assert schemas.too_long(old.withColumn("t", F.lit("abc")), {"t": 2}).count() == 2
