"""Secret scans (operator 5): multipart credential linking by interval join.

Strong forms (assignments, access identifiers, long hex) are reported as they
stand. Weak forms (user names, short passwords, mixed-case tokens, endpoints)
are noise alone: one is reported only when a complementary part overlaps it or
lies within `SCOPE` code points of it. That test is an interval join, done as an
equi-join on bins of SCOPE code points: each bin holds one row per role with
the first start and the last end in it, and one for the parts that cover any of
it. Parts that share a bin are near; a candidate also probes the bins on either
side. A bin spans SCOPE code points, so no join key can be hot, no pair of parts
is ever made, and only rows of parts (never texts) are shuffled.

Built-in functions only. Positions come from splitting a text by the pattern:
the pieces' and matches' lengths add up to offsets, chunk by chunk of `CHUNK`
matches, so the cost is linear in the matches. Weak parts that meet a strong one
are left out by running bounds over the parts of a text in order.

Defined results: a null text counts as empty; a null doc_id is a document like
any other; repeated rows each get their own row; an empty table gives an empty
result; other columns are ignored by `scan_secrets` and passed through by
`redact_secrets`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import free_prefix, materialize, text_or_empty

#: Code points within which complementary parts link.
SCOPE = 200
#: Matches whose offsets are added up in one go.
CHUNK = 128
#: Code points in the blocks that a text with secrets is cut to, as finding a place in a text takes time in proportion to it.
BLOCK = 4096

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
#: Weak candidates: kind, words of which a text must hold one (in lower case), the pattern of the span.
WEAK = (
    ("ident", ("user", "login", "client", "account", "access"), r"""(?<![A-Za-z])(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""),
    ("key", ("pass", "pwd", "key", "auth", "cred", "secret", "token"), r"""(?i:pass(?:word|wd|phrase)?|pwd|auth|credential|secret|token|(?:api|private|signing)_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=@!$%^&*-]{4,}"""),
    ("key", (), r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}"),
    ("endpoint", ("://", "host", "endpoint"), r"""(?:(?<![A-Za-z])(?:https?|ftps?|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)(?::[a-z]+)?://[^\x20\x09-\x0D"'<>]+|(?<![A-Za-z])(?i:host(?:name)?|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,})"""),
)
#: What a text must hold for a strong form: words of which it must hold one, or a pattern.
STRONG = (("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"), ASSIGN), ("access", ("akia",), ACCESS), ("hex", (), HEX))
#: The roles that parts of a kind play, and what completes each role.
ROLE = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "key": "secret", "endpoint": "endpoint"}
COMPLETES = {"ident": ("secret",), "secret": ("ident", "endpoint"), "endpoint": ("secret",)}

_SPANS = "array<struct<s:int,r:int,e:int>>"
_STEPS = "array<struct<p:int,m:int,g:int>>"


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _found(text: Column, lower: Column, words: tuple[str, ...], pattern: str) -> Column:
    """All matches; texts without any of the words are not searched."""
    cheap = F.lit(not words)
    for w in words:
        cheap = cheap | F.contains(lower, F.lit(w))
    return F.when(cheap, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _steps(text: Column, found: Column, pattern: str, group: bool) -> Column:
    """The lengths of the piece before each match, of the match, and of its value."""
    lengths = lambda c: F.transform(c, F.length)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if group else found
    zipped = F.arrays_zip(lengths(F.slice(F.split(text, pattern, -1), 1, F.size(found))).alias("p"), lengths(found).alias("m"), lengths(value).alias("g"))
    return F.when(F.size(found) > 0, zipped).otherwise(_none(_STEPS))


def _chunked(items: Column, first: Column, total, step, kind: str) -> Column:
    """Concatenated results of `step` over all items, which carries `at` along.

    `total` gives `at` after an item, from `at` before it; it runs over all
    items first, so that each chunk starts from its own `at`. Items are taken by
    place: a slice would copy the whole array for each chunk. `items` has to be a
    column of the input, not an expression.
    """
    n = F.size(items)
    chunks = F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))
    places = lambda i: F.sequence(i * CHUNK, F.least(i * CHUNK + CHUNK, n) - 1)
    over = lambda i, at: F.aggregate(places(i), at, lambda acc, j: total(acc, F.get(items, j)))
    starts = F.aggregate(chunks, F.array(first), lambda acc, i: F.concat(acc, F.array(over(i, F.element_at(acc, -1)))))
    one = lambda x: F.aggregate(places(x["i"]), F.struct(x["at"].alias("at"), _none(kind).alias("out")), lambda acc, j: step(acc, F.get(items, j)), lambda acc: acc["out"])
    each = F.transform(F.arrays_zip(chunks.alias("i"), F.slice(starts, 1, F.size(chunks)).alias("at")), one)
    return F.when(n > 0, F.flatten(each)).otherwise(_none(kind))


def _spans(steps: Column, rank: int, least: int) -> Column:
    """Spans (start, rank of kind, end) of the matches whose value is long enough."""

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["p"]
        here = F.when(x["g"] >= least, F.array(F.struct(begin.alias("s"), F.lit(rank).alias("r"), (begin + x["m"]).alias("e")))).otherwise(_none(_SPANS))
        return F.struct((begin + x["m"]).alias("at"), F.concat(acc["out"], here).alias("out"))

    return _chunked(steps, F.lit(0), lambda at, x: at + x["p"] + x["m"], step, _SPANS)


def _digest(rows: DataFrame, text: Column, tmp: str) -> DataFrame:
    """rows with a row id, base spans and weak spans under `tmp`."""
    kinds = [(kind, words, pattern) for kind, words, pattern in (*STRONG, *WEAK)]
    out = rows.withColumns({tmp + "rid": F.monotonically_increasing_id(), tmp + "lower": F.lower(text)})
    found = {f"{tmp}f{i}": _found(text, F.col(tmp + "lower"), words, pattern) for i, (_, words, pattern) in enumerate(kinds)}
    out = out.withColumns(found)
    steps = {f"{tmp}z{i}": _steps(text, F.col(f"{tmp}f{i}"), pattern, kind == "assign") for i, (kind, _, pattern) in enumerate(kinds)}
    out = out.withColumns(steps)
    spans = [_spans(F.col(f"{tmp}z{i}"), KINDS.index(kind), 8 if kind == "assign" else 0) for i, (kind, *_) in enumerate(kinds)]
    out = out.withColumns({tmp + "base": F.concat(*spans[: len(STRONG)]), tmp + "weak": F.concat(*spans[len(STRONG) :])})
    return out.drop(tmp + "lower", *found, *steps)


def _clear(parts: DataFrame) -> DataFrame:
    """parts (rid, s, r, e, weak) without weak ones that a strong one overlaps."""
    strong = lambda c: F.when(~F.col("weak"), F.col(c))
    before = F.max(strong("e")).over(Window.partitionBy("rid").orderBy("s").rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(strong("s")).over(Window.partitionBy("rid").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, 0))
    met = F.coalesce(before > F.col("s"), F.lit(False)) | F.coalesce(after < F.col("e"), F.lit(False))
    return parts.withColumn("met", met).where(~(F.col("weak") & F.col("met"))).drop("met")


def _linked(digest: DataFrame, scope: int) -> DataFrame:
    """(rid, linked): the weak spans of each row that a complementary part is near; digest has rid, base and weak."""
    held = digest.where(F.size("weak") > 0)
    role = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLE[k])]), F.col("r"))
    marked = lambda c, weak: F.transform(F.col(c), lambda x: F.struct(x["s"].alias("s"), x["r"].alias("r"), x["e"].alias("e"), F.lit(weak).alias("weak")))
    parts = held.select("rid", F.explode(F.concat(marked("weak", True), marked("base", False))).alias("p")).select("rid", "p.*")
    parts = materialize(_clear(parts).withColumn("role", role), "parts")
    at = lambda c: F.floor(F.col(c) / scope)
    place = lambda side, b, c: F.struct(F.lit(side).alias("side"), b.alias("bin"), F.col(c).alias("at"))
    over = F.transform(F.sequence(at("s"), at("e")), lambda b: place("over", b, "s"))
    edges = parts.select("rid", "role", F.explode(F.concat(F.array(place("end", at("e"), "e"), place("start", at("s"), "s")), over)).alias("x")).select("rid", "role", "x.*")
    bins = edges.groupBy("rid", "bin", "side", "role").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    needs = F.create_map(*[y for r, c in COMPLETES.items() for y in (F.lit(r), F.array(*[F.lit(z) for z in c]))])
    probe = lambda side, b: F.struct(F.lit(side).alias("side"), b.alias("bin"))
    probes = (
        parts.where("weak")
        .withColumn("q", F.explode(F.concat(F.array(probe("end", at("s") - 1), probe("start", at("e") + 1)), F.transform(F.sequence(at("s"), at("e")), lambda b: probe("over", b)))))
        .withColumn("needed", F.explode(F.element_at(needs, F.col("role"))))
        .select("rid", "s", "r", "e", "q.side", "q.bin", F.col("needed").alias("role"))
    )
    near = F.when(F.col("side") == "end", F.col("last") >= F.col("s") - scope).when(F.col("side") == "start", F.col("first") <= F.col("e") + scope).otherwise(True)
    hits = probes.join(bins, ["rid", "bin", "side", "role"]).where(near)
    return hits.groupBy("rid").agg(F.collect_set(F.struct("s", "r", "e")).alias("linked"))


def _text_of(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(spans)
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.get(name, x["r"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _complete(digest: DataFrame, scope: int, tmp: str) -> DataFrame:
    """digest with the linked spans of each row; rows without weak parts are not shuffled."""
    empty = _none(_SPANS)
    linked = _linked(digest.select(*[F.col(tmp + c).alias(c) for c in ("rid", "base", "weak")]), scope)
    linked = linked.select(F.col("rid").alias(tmp + "rid"), F.col("linked").alias(tmp + "linked"))
    bare = digest.where(F.size(tmp + "weak") == 0).withColumn(tmp + "linked", empty)
    held = digest.where(F.size(tmp + "weak") > 0).join(linked, tmp + "rid", "left").withColumn(tmp + "linked", F.coalesce(F.col(tmp + "linked"), empty))
    return bare.unionByName(held)


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of every row."""
    digest = materialize(_digest(docs.select("doc_id", "text"), text_or_empty(), "sx_").drop("text"), "secrets")
    out = _complete(digest, scope, "sx_")
    base = F.col("sx_base")
    count = lambda i: F.size(F.filter(base, lambda x: x["r"] == i)).cast("long")
    return out.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(F.concat(base, F.col("sx_linked"))).alias("spans"),
        F.size("sx_linked").cast("long").alias("n_linked"),
    )


def redact_secrets(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """docs with each reported span of text replaced by `mark`; overlapping spans give one mark.

    Texts without a span, null texts among them, come back as they are. Rows
    are written once with their spans, so texts are scanned once.
    """
    tmp = free_prefix(docs.columns, "sx_")
    digest = materialize(_digest(docs, text_or_empty(), tmp), "secrets")
    out = _complete(digest, scope, tmp)
    text = text_or_empty()
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")), lambda k: F.substring(text, k * BLOCK + 1, F.lit(BLOCK)))
    out = out.withColumn(tmp + "spans", F.sort_array(F.concat(F.col(tmp + "base"), F.col(tmp + "linked"))))
    out = out.withColumn(tmp + "blocks", F.when(F.size(tmp + "spans") > 0, blocks))
    cut, spans = F.col(tmp + "blocks"), F.col(tmp + "spans")

    def piece(begin: Column, end: Column) -> Column:
        """text from begin to end, out of the blocks that it touches."""
        at = lambda x: F.floor(x / BLOCK).cast("int")
        part = lambda k: F.substring(F.get(cut, k), F.greatest(begin - k * BLOCK, F.lit(0)) + 1, F.least(end, (k + 1) * BLOCK) - F.greatest(begin, k * BLOCK))
        return F.when(end > begin, F.array_join(F.transform(F.sequence(at(begin), at(end - 1)), part), "")).otherwise(F.lit(""))

    def step(acc: Column, x: Column) -> Column:
        gap = F.when(x["s"] >= acc["at"], F.array(piece(acc["at"], x["s"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    gaps = _chunked(spans, F.lit(0), lambda at, x: F.greatest(at, x["e"]), step, "array<string>")
    last = F.aggregate(spans, F.lit(0), lambda at, x: F.greatest(at, x["e"]))
    redacted = F.concat(F.array_join(gaps, mark), F.lit(mark), piece(last, F.length(text)))
    final = F.when(F.size(spans) > 0, redacted).otherwise(F.col("text"))
    return out.select(*[final.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
