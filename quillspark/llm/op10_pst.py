"""LM scoring (operator 10): a probabilistic suffix tree.

Training counts every token, one end per document included, then level by
level the contexts of one, two, ... tokens and what follows them, as long as a
longer context could be retained (`MOST_DEPTH` at most). Contexts that occur
`LEAST_CONTEXT` times and followers that occur `LEAST_COUNT` times after them
are candidates, whatever the size of the corpus, so the tree grows with it. A
context is retained if its next-symbol distribution diverges from that of its
longest retained suffix: count times Kullback-Leibler divergence of at least
`DIVERGENCE` nats. Next-symbol counts are smoothed by the suffix's
distribution, the root's by add-one:

    p(w | s) = (c(s, w) + (c(s) - k(s) + BACKOFF) * p(w | suffix of s)) / (c(s) + BACKOFF)

k(s) being the sum of the counts kept for s, so each distribution sums to one.
A token is scored by the longest retained suffix of what precedes it.

Counts and probabilities stay in tables, keyed by 64-bit hashes. log p of a
token is a sum over the grams that end at it and their contexts: the root's
log p, log of the back-off weight of each retained context, and for each kept
(s, w) log of p(w | s) / (weight of s * p(w | suffix of s)). So a text's score
is the sum of one value per gram in it, found by a join per (row, gram).
Frequent keys are broadcast (`HOT_ROWS` of them at most), which keeps hot keys out of
the join. Bitmaps of fixed size spare lookups that would fail; that of the last
join holds only longer grams that are not broadcast, not the many rare tokens, so
grams that the tree does not have stay out of it.

Texts are read once per level and twice more, in Arrow batches, and never
shuffled. Tables of a level are removed once the next has been written.

Defined results: a null text is one end token; a null doc_id hashes as the
empty text, so it is a training row; repeated rows all count and each get
their own row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import forget, hash_of, materialize, mix, release, slices, text_or_empty, tokenize

LEAST_CONTEXT, LEAST_COUNT, DIVERGENCE, BACKOFF = 64, 16, 8.0, 4.0
#: Entries that occur so often are broadcast instead of joined, the most frequent HOT_ROWS at most; results do not depend on either.
HOT_COUNT, HOT_ROWS = 16, 3 << 19
#: Tokens in the longest contexts.
MOST_DEPTH = 3
#: Least and greatest size (as a power of two) of the bitmaps that spare tasks rows that would match nothing; results do not depend on it.
FILTER_BITS = (16, 27)
FOLDS, HELD = 7, 2
_END = np.uint64(hash_of(b"\x00end of document"))
_NONE = np.int64(-1)
_MARK, _GOLD = np.uint64(1 << 63), np.uint64(0x9E3779B97F4A7C15)
#: Distinct keys that a task gathers before it passes them on.
_FLUSH = 400_000


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text closed by the end token, and offsets."""
    words, at = tokenize(texts, lower=True)
    at = at + np.arange(len(at))
    out = np.empty(len(words) + len(at) - 1, np.uint64)
    ends = at[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = words
    out[ends] = _END
    return out, at


class _Counter:
    """Sums counts of int64 keys and hands them out in bounded batches."""

    def __init__(self, name: str):
        self.name, self.keys, self.counts, self.size = name, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, c = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(c)
        self.size += len(k)
        if self.size > 2 * _FLUSH:
            self._fold()
            if self.size > _FLUSH:
                yield from self.rest()

    def _fold(self):
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts = [keys[first]], [np.add.reduceat(counts, first)]
        self.size = len(first)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._fold()
            keys, counts = self.keys[0], self.counts[0]
            self.keys, self.counts, self.size = [], [], 0
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000]), pa.array(counts[i : i + 100_000].astype(np.int64))], names=[self.name, "n"])


def _find(values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in sorted values, or -1."""
    if not len(values):
        return np.full(len(x), _NONE)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return np.where(values[at] == x, at, _NONE)


def _cut(counted: DataFrame) -> int:
    """The least count of the entries that are broadcast: HOT_COUNT, or the least that leaves HOT_ROWS at most."""
    # Counts up to 4,095 by themselves, larger ones by powers of two: a few thousand rows go to the driver.
    step = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long")).alias("step")
    cut, held = 2**62, 0
    for r in counted.where(F.col("n") >= HOT_COUNT).groupBy(step).agg(F.count("*").alias("c")).orderBy(F.desc("step")).collect():
        held += r["c"]
        if held > HOT_ROWS:
            break
        cut = r["step"]
    return cut


class _Places:
    """Finds places in sorted values by one look into a table; only what shares a slot is searched for."""

    def __init__(self, values: np.ndarray):
        self.values, self.bits = values, max(10, len(values).bit_length() + 1)
        self.table = np.zeros(1 << self.bits, np.int32)
        self.table[_slots(values, self.bits)] = np.arange(len(values), dtype=np.int32)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each x, or -1."""
        if not len(self.values):
            return np.full(len(x), _NONE)
        at = self.table[_slots(x, self.bits)].astype(np.int64)
        other = np.flatnonzero(self.values[at] != x)
        at[other] = _find(self.values, x[other])
        return at


def _codes(hashes: np.ndarray, frequent: _Places) -> np.ndarray:
    """Keys of tokens: places (from 1) of frequent ones, which compress well, marked hashes of the others."""
    at = frequent.find(hashes)
    return np.where(at >= 0, (at + 1).astype(np.uint64), hashes | _MARK)


def _joined(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Keys of grams, from those of a gram without its last and without its first token."""
    return mix(mix(before + _GOLD) * _GOLD ^ last)


def _grams(codes: np.ndarray, at: np.ndarray, depth: int) -> list[np.ndarray]:
    """For 0 to depth: the keys of the grams of so many tokens more than one that end at each position, or 0."""
    place = np.arange(len(codes)) - np.repeat(at[:-1], np.diff(at))
    out = [codes]
    for d in range(1, depth + 1):
        gram = np.zeros(len(codes), np.uint64)
        live = np.flatnonzero(place >= d)
        gram[live] = _joined(out[-1][live - 1], out[-1][live])
        out.append(gram)
    return out


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return mix(keys * _GOLD + np.uint64(1)) >> np.uint64(64 - bits)


def _filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of bounded size that holds all keys, and by chance some others."""
    least, most = FILTER_BITS
    bits = min(most, max(least, keys.count().bit_length() + 3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(_slots(batch.column(0).to_numpy().view(np.uint64), bits))
            word, first = np.unique(slot >> np.uint64(6), return_index=True)
            if len(word):
                held = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(held.view(np.int64))], names=["word", "bits"])

    got = keys.mapInArrow(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _holds(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = _slots(keys, len(bitmap).bit_length() + 5)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


class _PairCounter:
    """Sums counts of pairs of keys and hands them out in bounded batches."""

    def __init__(self):
        self.context, self.low, self.size = [], [], 0

    def add(self, context: np.ndarray, low: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.context.append(context)
        self.low.append(low)
        self.size += len(context)
        if self.size > 4 * _FLUSH:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            context, low = np.concatenate(self.context), np.concatenate(self.low)
            self.context, self.low, self.size = [], [], 0
            key = _joined(context, low)
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            place, n = order[first], np.diff(np.append(first, len(key)))
            for i in range(0, len(n), 100_000):
                part = slice(i, i + 100_000)
                yield _counts(context[place[part]], low[place[part]], n[part])


def _counts(context: np.ndarray, low: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(context.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n.astype(np.int64))], names=["context", "low", "n"])


def _counted(texts: DataFrame) -> DataFrame:
    """(token, n) of every token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter("token")
        for batch in slices(batches):
            hashes, _ = _tokens(batch.column(0))
            if len(hashes):
                yield from counter.add(hashes.view(np.int64))
        yield from counter.rest()

    return texts.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _followed(texts: DataFrame, depth: int, frequent, opened, known, common) -> DataFrame:
    """(context, low, n): counts of contexts of `depth` tokens (low 0) and of what follows them.

    low is the key of the follower's gram without the context's first token.
    `opened` holds the suffixes that longer contexts may still extend, `known`
    the lower grams with a probability, `common` grams that are frequent enough
    to stand in a context.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, contexts, places = _PairCounter(), _Counter("context"), _Places(frequent.value)

        def whole(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in found:
                keys = b.column(0).to_numpy().view(np.uint64)
                yield _counts(keys, np.zeros(len(keys), np.uint64), b.column(1).to_numpy())

        for batch in slices(batches):
            hashes, at = _tokens(batch.column(0))
            grams = _grams(_codes(hashes, places), at, depth - 1)
            live = np.flatnonzero(np.arange(len(hashes)) - np.repeat(at[:-1], np.diff(at)) >= depth)
            part = grams[min(depth, 2) - 1]  # the context's tokens, or its pairs
            for back in range(1, max(depth, 2)):
                live = live[_holds(common.value, part[live - back])]
            if depth > 1:
                live = live[_holds(opened.value, grams[-2][live - 1])]
            context, low = grams[-1][live - 1], grams[-1][live]
            seen = _holds(known.value, low)
            if len(live):
                yield from whole(contexts.add(context.view(np.int64)))
                yield from pairs.add(context[seen], low[seen])
        yield from whole(contexts.rest())
        yield from pairs.rest()

    counts = texts.mapInArrow(run, "context long, low long, n long").groupBy("context", "low").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= F.when(F.col("low") == 0, LEAST_CONTEXT).otherwise(LEAST_COUNT))


def _named(grams: DataFrame) -> DataFrame:
    """grams (context, low, ...) with the key of the whole gram in their place."""
    rest = grams.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_joined(a, b).view(np.int64)), *batch.columns[2:]], names=["gram", *rest])

    return grams.mapInArrow(run, ", ".join(["gram long", *(f"{n} {t}" for n, t in grams.dtypes[2:])]))


def _level(counts: DataFrame, lower: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contexts (context, n, back, kept, open) of the counts and their grams (gram, n, p, gain, kept, open).

    `lower` holds (gram, p) of the grams that are one token shorter. A context
    stays open while a longer one could be retained: its followers' counts
    bound those of every longer context, so the bound on gain is exact.
    """
    whole = counts.where("low = 0").select("context", F.col("n").alias("whole"))
    after = counts.where("low <> 0").join(lower.select(F.col("gram").alias("low"), F.col("p").alias("lp")), "low")
    after = materialize(after.join(whole.select("context"), "context", "left_semi").select("context", "low", "n", "lp"), "after")
    sums = after.groupBy("context").agg(F.sum("n").alias("k")).join(whole, "context")
    back = (F.col("whole") - F.col("k") + BACKOFF) / (F.col("whole") + BACKOFF)
    own = F.col("n") / (F.col("whole") + BACKOFF) + F.col("back") * F.col("lp")
    rows = after.join(sums.withColumn("back", back), "context").withColumn("own", own)
    most = lambda p: F.sum(F.col("n") * F.log((F.col("n") + BACKOFF * p) / (F.col("n") + BACKOFF) / p))
    each = rows.groupBy("context").agg(F.sum(F.col("n") * F.log(F.col("own") / F.col("lp"))).alias("gain"), F.first("whole").alias("whole"), F.first("k").alias("k"), F.first("back").alias("back"), most(F.col("own")).alias("m1"), most(F.col("lp")).alias("m0"))
    kept = F.col("gain") + (F.col("whole") - F.col("k")) * F.log("back") >= DIVERGENCE
    each = each.withColumn("kept", kept).withColumn("open", F.when(F.col("kept"), F.col("m1")).otherwise(F.col("m0")) >= DIVERGENCE)
    contexts = materialize(each.where("kept or open").select("context", F.col("whole").alias("n"), "back", "kept", "open"), "contexts")
    grams = after.join(contexts.select("context", F.col("n").alias("whole"), "back", "kept", "open"), "context").withColumn("own", own)
    grams = grams.select("context", "low", "n", F.when(F.col("kept"), F.col("own")).otherwise(F.col("lp")).alias("p"), F.log10(F.col("own") / F.col("lp") / F.col("back")).alias("gain"), "kept", "open")
    grams = materialize(_named(grams), "grams")
    forget(after)
    return contexts, grams


def train(texts: DataFrame) -> tuple[int, int, int, np.ndarray, DataFrame]:
    """Token and vocabulary counts, depth, frequent tokens, and the model's table.

    The table has (key, n, base, value, seen): adding the values of all grams
    of a text gives its score (see the head of the file).
    """
    spark = texts.sparkSession
    counts = materialize(_counted(texts), "tokens")
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, vocabulary = int(whole["n"] or 0), int(whole["v"])
    candidates = counts.where(F.col("n") >= LEAST_COUNT)
    frequent = np.sort(candidates.where(F.col("n") >= _cut(candidates)).select("token").toArrow().column("token").to_numpy().view(np.uint64))
    shared = spark.sparkContext.broadcast(frequent)
    release(spark)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(shared.value)
        for batch in batches:
            code = _codes(batch.column(0).to_numpy().view(np.uint64), places)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), batch.column(1)], names=["gram", "n"])

    root = counts.mapInArrow(coded, "gram long, n long").withColumn("p", (F.col("n") + 1.0) / F.lit(float(total + vocabulary + 1)))
    none = F.lit(0.0)
    table = root.select(F.col("gram").alias("key"), "n", F.log10("p").alias("base"), F.log10("p").alias("value"), F.lit(1).alias("seen"))
    bitmap = lambda keys: spark.sparkContext.broadcast(_filter(keys))
    lower, opened, depth, levels = root.where(F.col("n") >= LEAST_COUNT), None, 0, []
    known, common = bitmap(lower.select("gram")), bitmap(root.where(F.col("n") >= LEAST_CONTEXT).select("gram"))
    while depth < MOST_DEPTH and total:
        depth += 1
        followed = materialize(_followed(texts, depth, shared, opened, known, common), "followed")
        contexts, grams = _level(followed, lower)
        used = [known, *([opened] if opened else [])]
        if depth == 1:
            used.append(common)
            common = bitmap(_named(followed.where((F.col("low") != 0) & (F.col("n") >= LEAST_CONTEXT))).select("gram"))
        for b in used:
            b.destroy()
        forget(followed)
        levels.append((contexts, grams))
        table = table.union(grams.where("kept").select("gram", "n", none, "gain", F.lit(0))).union(contexts.where("kept").select("context", "n", none, F.log10("back"), F.lit(0)))
        lower = grams.where("open").select("gram", "p")
        opened, known = bitmap(contexts.where("open").select("context")), bitmap(lower.select("gram"))
        release(spark)
        if not opened.value.any():
            break
    # A gram's own row and its row as a context become one.
    table = table.groupBy("key").agg(F.max("n").alias("n"), F.sum("base").alias("base"), F.sum("value").alias("value"), F.max("seen").alias("seen"))
    model = materialize(table, "model")
    forget(counts, *(t for level in levels for t in level))
    release(spark)
    return total, vocabulary, depth, frequent, model


_SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>"


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), (fold == HELD).alias("held_out"), text_or_empty().alias("text"))
    total, vocabulary, depth, frequent, model = train(rows.where(~F.col("held_out")).select("text"))
    cut = _cut(model)
    hot = model.where(F.col("n") >= cut).toArrow()  # HOT_ROWS rows at most
    keys = hot.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    longer = model.where("seen = 0")
    bitmaps = _filter(longer.select("key")), _filter(longer.where(F.col("n") < cut).select("key"))
    shared = spark.sparkContext.broadcast((frequent, keys[order], *(hot.column(c).to_numpy()[order] for c in ("base", "value", "seen")), *bitmaps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, keys, base_of, value_of, seen_of, longer, cold = shared.value
        frequent, keys = _Places(frequent), _Places(keys)
        for batch in slices(batches):
            hashes, at = _tokens(batch.column(3))
            sums, rare, docs = np.zeros((3, len(hashes))), [], []
            of = np.repeat(np.arange(batch.num_rows), np.diff(at))
            # Tokens that are not broadcast are looked up, all of them; longer grams only where some of them are not broadcast.
            for d, gram in enumerate(_grams(_codes(hashes, frequent), at, depth)):
                left = np.flatnonzero((gram != 0) & _holds(longer, gram)) if d else np.arange(len(gram))
                place = keys.find(gram[left])
                found = place >= 0
                for i, column in enumerate((base_of, value_of, seen_of)):
                    sums[i, left[found]] += column[place[found]]
                left = left[~found]
                if d:
                    left = left[_holds(cold, gram[left])]
                rare.append(gram[left])
                docs.append(of[left])
            token, doc = np.concatenate(rare), np.concatenate(docs)
            order = np.lexsort((token, doc))
            doc, token = doc[order], token[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])])) if len(doc) else np.empty(0, np.int64)
            times = np.diff(np.append(new, len(doc))).astype(np.int32)
            ends = np.searchsorted(doc[new], np.arange(batch.num_rows + 1)).astype(np.int32)
            base, score, seen = np.add.reduceat(sums, at[:-1], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(np.diff(at)),
                    pa.array(seen.astype(np.int64)),
                    pa.array(base),
                    pa.array(score),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(token[new].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times)),
                ],
                names=["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"],
            )

    scored = materialize(rows.mapInArrow(run, _SCORED), "scored")
    tail = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("rid", F.col("x.rare").alias("key"), F.col("x.times").alias("t"))
    tail = tail.join(model.select("key", "base", "value", "seen"), "key")
    total_of = lambda c: F.sum(F.col("t") * F.col(c))
    sums = tail.groupBy("rid").agg(total_of("base").alias("b"), total_of("value").alias("s"), total_of("seen").alias("also"))
    out = scored.drop("rare", "times").join(sums, "rid", "left").fillna(0, ["b", "s", "also"])
    out = out.withColumn("n_known", F.col("n_known") + F.col("also"))
    unseen = (F.col("n_tokens") - F.col("n_known")) * F.lit(-float(np.log10(total + vocabulary + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.col("b") + unseen).alias("base_score"), (F.col("score") + F.col("s") + unseen).alias("score")
    )
