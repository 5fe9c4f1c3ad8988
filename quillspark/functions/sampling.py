"""Populations: strided cells, weighted choices, and personas by seed."""

from __future__ import annotations

import pickle
import random
from collections.abc import Iterator
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.plans.domains import Domains

MASTER_SEED, CELL_SEED = 42, 43


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) from an md5 of the keys: the same in every engine and partitioning."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def weighted_choice(u: Column, items: list[str], weights: list[float]) -> Column:
    """The item in whose band of the cumulative weights u falls."""
    total, at, out = float(sum(weights)), 0.0, None
    for item, w in zip(items, weights):
        at += w
        test = u < F.lit(at / total)
        out = F.when(test, F.lit(item)) if out is None else out.when(test, F.lit(item))
    return out.otherwise(F.lit(items[-1]))


def strided(index: Column, values: list[str], stride: int) -> Column:
    """values[index * stride mod len], with a stride that visits every value."""
    if gcd(stride, len(values)) != 1:
        raise ValueError(f"stride {stride} does not visit all {len(values)} values")
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(index * stride, F.lit(len(values))).cast("int"))


def shuffled_axes(domains: Domains, seed: int = CELL_SEED) -> tuple[list[str], list[str], list[str]]:
    rng = random.Random(seed)
    axes = [list(domains.professions), list(domains.topics), list(domains.educations)]
    for axis in axes:
        rng.shuffle(axis)
    return tuple(axes)


def stratified_cells(spark: SparkSession, count: int, domains: Domains, seed: int = CELL_SEED) -> DataFrame:
    """(i, profession, pain_point, education): cells that cover each axis evenly, by strides 7, 13 and 11."""
    professions, topics, educations = shuffled_axes(domains, seed)
    i = F.col("id")
    return spark.range(count).select(i.alias("i"), strided(i, professions, 7).alias("profession"), strided(i, topics, 13).alias("pain_point"), strided(i, educations, 11).alias("education"))


def make_persona(seed: int, cell: tuple[str, str, str] | None, d: Domains) -> dict:
    """One persona; the order of draws is part of the result (all details are drawn on every row)."""
    rng = random.Random(seed)
    pick = lambda items, weights: rng.choices(items, weights=weights, k=1)[0]
    low, high = pick(d.age_ranges, d.age_weights)
    out = {"age": rng.randint(low, high)}
    out["gender"] = pick(d.genders, d.gender_weights)
    out["social_status"] = pick(d.statuses, d.status_weights)
    out["location"] = pick(d.regions, d.region_weights)
    if cell is None:
        cell = rng.choice(d.professions), rng.choice(d.topics), pick(d.educations, d.education_weights)
    out["profession"], out["pain_point"], out["education"] = cell
    detail = rng.choice(d.life_details)
    detail = detail.format(location=out["location"], family_size=rng.randint(*d.family_sizes), years_exp=rng.randint(*d.experience_years))
    template = rng.choice(d.backstories)
    out["backstory"] = template.format(life_detail=detail, education_detail=f"Education: {out['education']}.", **{k: out[k] for k in ("age", "gender", "profession", "location", "social_status", "pain_point")})
    return out


#: Personas whose seeds one task draws from one state of the generator.
SEED_BLOCK = 2000


def seed_states(count: int, seed: int, block: int = SEED_BLOCK) -> Iterator[tuple[int, int, bytes]]:
    """(first, rows, state of the generator) of each block of seeds. Seeds are drawn in order; only the states are kept."""
    rng = random.Random(seed)
    for first in range(0, count, block):
        rows = min(block, count - first)
        yield first, rows, pickle.dumps(rng.getstate())
        for _ in range(rows if first + rows < count else 0):
            rng.randint(0, 2**31)


def personas(spark: SparkSession, count: int, domains: Domains, seed: int = MASTER_SEED, cell_seed: int = CELL_SEED) -> DataFrame:
    """`count` personas, reproducible by row: cell and seed depend on the row's number alone."""
    professions, topics, educations = shuffled_axes(domains, cell_seed)
    states = spark.createDataFrame(list(seed_states(count, seed)), "first long, rows int, state binary")
    names = ["persona_id", "age", "gender", "location", "profession", "social_status", "backstory", "education", "pain_point", "random_seed"]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first, rows, state in zip(pdf["first"], pdf["rows"], pdf["state"]):
                rng = random.Random()
                rng.setstate(pickle.loads(state))
                made = []
                for i in range(first, first + rows):
                    drawn = rng.randint(0, 2**31)
                    cell = professions[i * 7 % len(professions)], topics[i * 13 % len(topics)], educations[i * 11 % len(educations)]
                    made.append({**make_persona(drawn, cell, domains), "random_seed": drawn, "persona_id": i + 1})
                yield pd.DataFrame(made)[names]

    parts = max(1, -(-count // SEED_BLOCK))
    rows = states.repartition(parts).mapInPandas(build, "persona_id long, age int, gender string, location string, profession string, social_status string, backstory string, education string, pain_point string, random_seed long")
    meta = F.struct(*[F.col(c) for c in ("age", "gender", "location", "profession", "social_status", "education", "pain_point", "random_seed")])
    return rows.select("persona_id", "age", "gender", "location", "profession", "social_status", "backstory", meta.alias("json_metadata"), F.lit(False).alias("processed"), F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("error"))
