"""Chat messages as columns: array<struct<role, content>>. Wording is our own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import fill_template

SYSTEM = "You write one short question that the citizen described would type on a phone, in {language}. Keep their level of schooling and their hurry. Put it between <draft_questions> and </draft_questions>."
JUDGE_SYSTEM = "You check whether a question reads as if a real citizen typed it. Answer with one JSON object only."
JUDGE_USER = 'Writer: {profession}, {location}, schooling {education}.\n\nText:\n{draft}\n\nReply as {"verdict": "PASS" or "FAIL", "is_bengali": true or false, "reasons": []}. Fail stiff, polished or wrongly scripted text.'
REWRITE_USER = "Writer: {profession}, {location}, schooling {education}.\n\nText:\n{draft}\n\nWhat is wrong: {problems}\n\nWrite it anew between <draft_questions> and </draft_questions>."
LANGUAGE_NOTE = "\n\nThe text was not in the script asked for. Use {language} script only; no transliteration."
AXES_SYSTEM = "You grade a question on two axes. Answer with one JSON object only."
AXES_USER = 'Citizen: {age}, {gender}, {profession}, {location}, {social_status}, schooling {education}, matter: {pain_point}.\nBackground: {backstory}\n\nQuestion: {question}\n\naxis1: does it fit this citizen? axis2: is it clear and answerable? Reply as {"axis1": {"verdict": "PASS", "reason": ""}, "axis2": {"verdict": "PASS", "reason": ""}}; a FAIL needs a reason.'


def messages(system: Column, user: Column) -> Column:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("system", system), turn("user", user))


def memory_block(avoid: Column, exemplars: Column) -> Column:
    """Optional sections on openings to avoid and examples to follow; '' if both are empty."""
    bullets = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), x)), "\n")
    section = lambda title, c: F.when(F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0, F.concat(F.lit(f"\n\n{title}\n"), bullets(c))).otherwise(F.lit(""))
    return F.concat(section("Do not open like this:", avoid), section("Good examples on other matters:", exemplars))


def persona_json(names: list[str]) -> Column:
    """The persona shown to the model: indented JSON with nulls kept and no seed."""
    return F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false", "pretty": "true"})


def draft_prompt(persona: Column, avoid: Column, exemplars: Column, language: str = "Bengali") -> Column:
    user = F.concat(F.lit("Citizen:\n"), persona, memory_block(avoid, exemplars))
    return messages(fill_template(SYSTEM, language=F.lit(language)), user)


def judge_prompt(draft: Column, profession: Column, location: Column, education: Column) -> Column:
    return messages(F.lit(JUDGE_SYSTEM), fill_template(JUDGE_USER, profession=profession, location=location, education=education, draft=draft))


def rewrite_prompt(draft: Column, problems: Column, lang_fail: Column, profession: Column, location: Column, education: Column, language: str = "Bengali") -> Column:
    user = fill_template(REWRITE_USER, profession=profession, location=location, education=education, draft=draft, problems=problems)
    note = F.when(lang_fail, fill_template(LANGUAGE_NOTE, language=F.lit(language))).otherwise(F.lit(""))
    return messages(fill_template(SYSTEM, language=F.lit(language)), F.concat(user, note))


def axes_prompt(question: Column, **persona: Column) -> Column:
    return messages(F.lit(AXES_SYSTEM), fill_template(AXES_USER, question=question, **persona))
