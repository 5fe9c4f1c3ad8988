"""Table schemas, and additive migration to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType(), "array<float>": T.ArrayType(T.FloatType()), "array<string>": T.ArrayType(T.StringType())}


def _struct(**fields: str | T.DataType) -> T.StructType:
    """A struct of named types; works without a session, unlike parsing DDL."""
    return T.StructType([T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields.items()])


METADATA = _struct(age="int", gender="string", location="string", profession="string", social_status="string", education="string", pain_point="string", random_seed="bigint")
JUDGE = _struct(verdict="string", in_script="boolean", reasons="array<string>")
FLAGS = _struct(script_ratio="double", banned_phrases="array<string>", empty="boolean", programmatic_pass="boolean", judge=JUDGE, near_dup="boolean", duplicate="boolean")
PERSONAS = _struct(
    persona_id="bigint", age="int", gender="string", location="string", profession="string", social_status="string", backstory="string",
    json_metadata=METADATA, processed="boolean", status="string", attempts="int", error="string",
)
QUESTIONS = _struct(
    question_id="bigint", persona_id="bigint", question_text="string", cot_log="string", random_seed="bigint", dedup_hash="string",
    quality_flags=FLAGS, embedding="array<float>", opener="string", quality_score="double", created_at="timestamp_ntz",
)
EVALUATIONS = _struct(
    eval_id="bigint", question_id="bigint", persona_id="bigint", axis1_pass="boolean", axis1_reason="string", axis2_pass="boolean",
    axis2_reason="string", overall_pass="boolean", raw_response="string", model="string", created_at="timestamp_ntz",
)
MEMORY = _struct(seq="bigint", vec="array<float>", profession="string", region="string", topic="string", text="string", score="double", opener="string")
STATUS_LOG = _struct(persona_id="bigint", seq="bigint", run_id="string", batch_id="bigint", status="string", attempts="int", error="string")

#: Columns of the CSV mirrors.
QUESTION_CSV = ["question_id", "persona_id", "age", "gender", "location", "profession", "question_text", "cot_log", "random_seed", "dedup_hash", "created_at"]
EVALUATION_CSV = ["question_id", "persona_id", "profession", "location", "question_text", "axis1_pass", "axis1_reason", "axis2_pass", "axis2_reason", "overall_pass", "model", "created_at"]


def migrate(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Bring df to `schema`: missing columns are added, values cast, nulls of `defaults` filled.

    Applying it twice changes nothing. Columns that the schema lacks are dropped.
    """
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def migrate_personas(df: DataFrame) -> DataFrame:
    """Status columns with their backfill: rows marked processed are done, the rest pending."""
    processed = F.coalesce(F.col("processed"), F.lit(False)) if "processed" in df.columns else F.lit(False)
    derived = F.when(processed, "done").otherwise("pending")
    status = F.coalesce(F.col("status"), derived) if "status" in df.columns else derived
    return migrate(df.withColumn("status", status), PERSONAS, {"processed": False, "attempts": 0})


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text over its limit, in code points; Spark strings have none of their own."""
    test = F.lit(False)
    for name, most in limits.items():
        test = test | (F.length(name) > most)
    return df.where(test)
