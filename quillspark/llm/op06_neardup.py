"""Near-duplicates (operator 6): Order MinHash, verified by banded alignment.

Two texts are near-duplicates if their words align to s = L / (n + m - L) >= 0.8,
L being the longest common subsequence (the Jaccard similarity, with order).
Texts whose five-word shingles are that similar always are. Exact copies are
folded first, by digest.

Sketch: each of `SKETCHES` hash functions takes the `PICKS` least five-word
shingles, labelled by their occurrence in the text, and lists them in text
order; the hash of that list is a bucket. If every twentieth word differs the
shingles' similarity is about 0.63 and a sketch agrees with probability 0.4; at
s = 0.8 with the changes spread evenly these are 0.38 and 0.15, so 24 sketches
miss 1 pair in 200,000 and 1 in 50. Copies of one text mostly link through others.

Candidates: within a bucket the member that shares most buckets leads, and
everyone is verified against the leader only; verified links give components.
What remains are pairs of one bucket in different components. They are never
written out: such buckets are cut by length, as partners differ by a fifth at
most. The component with most members there is set apart: what else is in the
bucket meets its members in one group a component, not one a bucket, and only
these others meet each other per bucket. Groups are cut into blocks of
`BLOCK_ROWS` members or `BLOCK_WORDS` words, and a task that gets two blocks finds
their links itself. Before a group is cut into several blocks, members are left
out that can have no partner there: 3 of a text's u words without a counterpart
and 2 of the partner's v break each a three-word gram, 3u + 2v is 0.6 of the
text's n words at most, so 0.4 n - 2 of its grams must occur in others of the
group. So a group of unlike texts that share a passage, and a group of near
copies with some unlike ones, cost rows in proportion to their members; rows are
repeated for blocks only where many texts of different components are that alike.
A text shares four fifths of its words with a partner, so among its rarest words
all but a fifth of the text's number must be found there; what reaches that is
aligned, unless links found so far already join the two. So no link is lost and
no bucket is capped, and a group of thousands of near copies costs about one
verification each.

Alignment compares the words themselves, bit-parallel within a band. Components
are found by star contraction over tables. Texts are nodes by a number of their
own, so documents that share an id are kept apart.

Defined results: a null text counts as empty, and empty texts are copies of
each other; texts of under five words have one shingle, all their words; the
class is named by its least id, or by a negative hash where no member has one,
and `class_key` (the digest of the text that is kept) tells classes that share
an id apart; of each class one row is kept, that with the least id (nulls last),
of repeated rows any; an empty table gives an empty result; other columns are
ignored by `near_duplicates` and passed through by `drop_near_duplicates`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import free_prefix, materialize, mix, row_digest, slices, text_or_empty, tokenize
from quillspark.llm.graph import components

WORDS, SIMILARITY, SKETCHES, PICKS = 5, 0.8, 24, 2
#: Members, and words, of a block of a bucket.
BLOCK_ROWS, BLOCK_WORDS = 512, 1 << 18
#: Words of the grams that tell which members of a large group can have a partner.
GRAM = 3
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _MUL)
_TOP = np.uint64(2**64 - 1)


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of all texts of a batch, and their offsets."""
    n = np.diff(offsets)
    counts = np.where(n >= WORDS, n - WORDS + 1, (n > 0).astype(n.dtype))
    ends = np.concatenate([[0], np.cumsum(counts)])
    if not ends[-1]:
        return np.empty(0, np.uint64), ends
    doc = np.repeat(np.arange(len(n)), counts)
    at = np.arange(ends[-1]) - ends[doc] + offsets[doc]
    padded = np.concatenate([words.astype(np.uint64), np.zeros(WORDS, np.uint64)])
    out = padded[at].copy()
    short = n[doc] < WORDS
    for j in range(1, WORDS):
        nxt = padded[at + j]
        if short.any():
            nxt = np.where(at + j < offsets[doc + 1], nxt, np.uint64(0))
        out = mix(out * _MUL + nxt)
    return out, ends


def _labelled(sh: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Shingle hashes that also tell the how-manieth occurrence in its text each is."""
    key = sh ^ mix(doc.astype(np.uint64) * _MUL + np.uint64(1))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    out = sh.copy()
    if len(twice):
        values = np.unique(twice)
        slot = np.minimum(np.searchsorted(values, key), len(values) - 1)
        rows = np.flatnonzero(values[slot] == key)
        order = rows[np.argsort(slot[rows], kind="stable")]
        run = slot[order]
        first = np.concatenate([[True], run[1:] != run[:-1]])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
        out[order] += (np.arange(len(run)) - begin).astype(np.uint64) * _MUL
    return mix(out)


def sketches(sh: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The SKETCHES bucket hashes of each text that has shingles; rows as those texts."""
    counts = np.diff(ends)
    live = np.flatnonzero(counts)
    if not len(live):
        return np.empty((0, SKETCHES), np.uint64)
    counts, starts = counts[live], ends[:-1][live]
    doc = np.repeat(np.arange(len(live)), counts)
    base = _labelled(sh, doc)
    out = np.empty((len(live), SKETCHES), np.uint64)
    for j, seed in enumerate(_SEEDS):
        v = mix(base ^ seed)
        place = np.full((len(live), PICKS), -1, np.int64)
        for r in range(PICKS):
            least = np.minimum.reduceat(v, starts)
            least[counts <= r] = 0
            hit = np.flatnonzero(v == np.repeat(least, counts))
            place[doc[hit], r] = hit
            v[hit] = _TOP
        place.sort(axis=1)
        h = np.full(len(live), seed, np.uint64)
        for r in range(PICKS):
            h = mix(h * _MUL + np.where(place[:, r] >= 0, base[place[:, r]], np.uint64(r)))
        out[:, j] = h
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words, at = tokenize(batch.column(batch.num_columns - 1))
        sh, ends = shingles(words, at)
        found = sketches(sh, ends)
        offsets = np.concatenate([[0], np.cumsum(np.where(np.diff(ends) > 0, SKETCHES, 0))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.diff(at).astype(np.int64)), lists], names=[*batch.schema.names[:-1], "n", "sketch"])


def longest_common(a: list, b: list, band: int) -> int:
    """Length of the longest common subsequence whose matches lie within `band` of the diagonal.

    A row of the table of lengths is kept as the bits of a number (1: no step up
    there), so a word of a costs a few operations on len(b) bits (Hyyro, 2004).
    """
    m = len(b)
    if len(a) > m:
        return longest_common(b, a, band)
    where: dict = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    places = {}
    for x in set(a) & where.keys():
        bits = bytearray(m // 8 + 1)
        for j in where[x]:
            bits[j >> 3] |= 1 << (j & 7)
        places[x] = int.from_bytes(bits, "little")
    whole = (1 << m) - 1
    row, window, wide = whole, (1 << (2 * band + 1)) - 1, band < m
    for i, x in enumerate(a):
        hit = places.get(x)
        if hit is not None:
            if wide:
                hit &= window << (i - band) if i >= band else window >> (band - i)
            hit &= row
            if hit:
                row = ((row + hit) | (row - hit)) & whole
    return m - row.bit_count()


def alignment(a: list, b: list, least: float = SIMILARITY) -> float:
    """Ordered similarity of two sequences, or 0 if it is below `least`.

    A similarity of `least` leaves at most `band` items unmatched, so the
    alignment may leave the diagonal by no more than that.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    band = int((n + m) * (1 - least) / (1 + least) + 1e-9)
    if 2 * (Counter(a) & Counter(b)).total() < n + m - band:
        return 0.0
    head, short = 0, min(n, m)
    while head < short and a[head] == b[head]:
        head += 1
    tail, rest = 0, short - head
    while tail < rest and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    common = head + tail
    x, y = a[head : n - tail], b[head : m - tail]
    if x and y:
        common += longest_common(x, y, band)
    s = common / (n + m - common)
    return s if s >= least else 0.0


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        good, seen = [], (None, [])
        for i in range(batch.num_rows):
            text = left[i].as_py()
            if seen[0] != text:
                seen = (text, _WORD.findall(text))
            if alignment(seen[1], _WORD.findall(right[i].as_py())) >= SIMILARITY:
                good.append(i)
        rows = pa.array(good, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])


def links_within(roots: list[int], texts: list[list], side: list[int], home: list[bool]) -> list[tuple[int, int]]:
    """Links between texts of different roots that are enough to join all that belong together.

    Every pair at or above SIMILARITY is linked, or was joined by earlier links.
    If there are two sides, only pairs across them count; one of a pair has to be at home here.
    """
    g = len(roots)
    parent = {r: r for r in roots}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    number: dict = {}  # (word, its how-manieth occurrence) -> number
    ids = []
    for words in texts:
        times: dict = {}
        own = np.empty(len(words), np.int64)
        for k, w in enumerate(words):
            c = times.get(w, 0)
            times[w] = c + 1
            own[k] = number.setdefault((w, c), len(number))
        ids.append(own)
    sizes = np.array([len(x) for x in ids])
    owner, flat = np.repeat(np.arange(g), sizes), np.concatenate(ids) if ids else np.empty(0, np.int64)
    df = np.bincount(flat, minlength=len(number))
    postings, ptr = owner[np.argsort(flat, kind="stable")], np.concatenate([[0], np.cumsum(df)])
    slack = np.floor((1 - SIMILARITY) * sizes + 1e-9).astype(np.int64)  # words that no partner need have
    shared = np.bincount(owner, df[flat] > 1, g)
    alive = (sizes > 0) & (shared >= sizes - slack)
    side_, home_, now, across, out = np.array(side), np.array(home), np.array(roots), len(set(side)) > 1, []
    later = np.arange(g)
    for i in np.flatnonzero(alive).tolist():
        ok = alive & (later > i) & (now != now[i]) & (home_ | home_[i]) & (np.minimum(sizes, sizes[i]) >= SIMILARITY * np.maximum(sizes, sizes[i]) - 1e-9)
        if across:
            ok &= side_ != side_[i]
        if not ok.any():
            continue
        rare = ids[i][np.argsort(df[ids[i]], kind="stable")][: 2 * int(slack[i]) + 2]
        hits = np.bincount(np.concatenate([postings[ptr[u] : ptr[u + 1]] for u in rare.tolist()]), minlength=g)
        cols = np.flatnonzero(ok & (hits >= len(rare) - slack[i]))
        for j in cols[np.argsort(-hits[cols], kind="stable")].tolist():
            a, b = find(roots[i]), find(roots[j])
            if a != b and alignment(texts[i], texts[j]) >= SIMILARITY:
                parent[max(a, b)] = min(a, b)
                now[np.isin(now, [a, b])] = min(a, b)
                out.append((i, j))
    return out


def _rest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group (key, size, bi, bj); rows come sorted by group, and a group may span batches."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        nodes, roots = rows.column("node").to_pylist(), rows.column("root").to_pylist()
        own, found = rows.column("own").to_pylist(), []
        halves = 2 if last[1] < 0 or last[2] != last[3] else 1
        if len(set(roots)) > 1 and len(set(own)) == halves:
            found = links_within(roots, [_WORD.findall(t) for t in rows.column("text").to_pylist()], own, rows.column("home").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in found], pa.int64()), pa.array([nodes[j] for _, j in found], pa.int64())], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        cols = [batch.column(k).to_numpy() for k in range(4)]
        change = np.zeros(max(batch.num_rows - 1, 0), bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        begins = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for begin, end in zip(begins, begins[1:]):
            if begin == end:
                continue
            group = tuple(int(c[begin]) for c in cols)
            if held and group != last:
                yield solve(pa.Table.from_batches(held))
                held = []
            last = group
            held.append(batch.slice(begin, end - begin))
    if held:
        yield solve(pa.Table.from_batches(held))


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose texts align. b may be hot, so its side is a plain join that can be split."""
    left = words.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    right = words.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    joined = pairs.join(right, "a").join(left, "b").select("a", "b", "tb", "ta")
    return joined.mapInArrow(_verify_batches, "a long, b long")


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of GRAM words of each text with the times they occur in it, beside the row's other columns."""
    for batch in slices(batches):
        words, at = tokenize(batch.column(batch.num_columns - 1))
        counts = np.maximum(np.diff(at) - GRAM + 1, 0)
        doc = np.repeat(np.arange(batch.num_rows), counts)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + at[doc]
        gram = words[place]
        for j in range(1, GRAM):
            gram = mix(gram * _MUL + words[place + j])
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        first = np.flatnonzero(new)
        rows, times = pa.array(doc[first]), np.diff(np.append(first, len(doc)))
        yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns[:-1]), pa.array(gram[first].view(np.int64)), pa.array(times.astype(np.int64))], names=[*batch.schema.names[:-1], "gram", "times"])


def _blocks(sides: DataFrame) -> DataFrame:
    """(key, size, b0, b1): into how many blocks each side of a group is cut."""
    cut = lambda at: F.greatest(F.ceil(F.count(F.when(at, 1)) / BLOCK_ROWS), F.ceil(F.sum(F.when(at, F.col("n")).otherwise(0)) / BLOCK_WORDS)).cast("int")
    return sides.groupBy("key", "size").agg(cut(F.col("side") == 0).alias("b0"), cut(F.col("side") == 1).alias("b1"))


def _partnered(crowded: DataFrame, words: DataFrame) -> DataFrame:
    """The members of these groups that can have a partner there, by the grams that they share with others."""
    other = F.when(F.col("size") < 0, F.col("side")).otherwise(F.col("root")).alias("other")
    grams = crowded.join(words, "node").select("key", "size", "node", other, "text")
    grams = materialize(grams.mapInArrow(_gram_batches, "key long, size int, node long, other long, gram long, times long"), "grams")
    shared = grams.groupBy("key", "size", "gram").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo < hi")
    met = grams.join(shared.select("key", "size", "gram"), ["key", "size", "gram"]).groupBy("key", "size", "node").agg(F.sum("times").alias("met"))
    enough = F.coalesce("met", F.lit(0)) >= F.col("n") * (1 - GRAM * (1 - SIMILARITY)) - (GRAM - 1) - 1e-6
    return crowded.join(met, ["key", "size", "node"], "left").where(enough).drop("met")


def _rest(members: DataFrame, roots: DataFrame, words: DataFrame) -> DataFrame:
    """Links (a, b) that join what shares a bucket, is alike, and is not joined yet."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Partners' lengths differ by a factor of 1.25 at most, so they lie in one class of lengths or in two that touch.
    size = F.floor(F.log(F.greatest("n", F.lit(1))) / F.lit(math.log(1.26))).cast("int")
    places = F.explode(F.array(F.struct(size.alias("size"), F.lit(True).alias("home")), F.struct((size + 1).alias("size"), F.lit(False).alias("home"))))
    placed = materialize(placed.select("key", "node", "root", "n", places.alias("p")).select("key", "node", "root", "n", "p.size", "p.home"), "placed")
    parts = placed.groupBy("key", "size", "root").agg(F.count("*").alias("c"), F.max("home").alias("any"))
    groups = parts.groupBy("key", "size").agg(F.max(F.struct("c", "root")).alias("x"), F.count("*").alias("parts"), F.max("any").alias("any"))
    mixed = materialize(groups.where("parts > 1 and any").select("key", "size", F.col("x.root").alias("top"), "parts"), "mixed")
    others = materialize(placed.join(mixed, ["key", "size"]).where("root <> top"), "others")

    # The largest component of a bucket (side 0) and what shares the bucket with it (side 1), under the component
    # and a size below 0; and these others of each bucket among themselves.
    flip = (-1 - F.col("size")).alias("size")
    nodes = placed.select("size", "node", "root", "n", "home").distinct().join(mixed.select("size", F.col("top").alias("root")).distinct(), ["root", "size"], "left_semi")
    sides = nodes.select(F.col("root").alias("key"), flip, "node", "root", "n", "home", F.lit(0).alias("side"))
    sides = sides.union(others.select(F.col("top").alias("key"), flip, "node", "root", "n", "home", F.lit(1)).distinct())
    sides = materialize(sides.union(others.where("parts > 2").select("key", "size", "node", "root", "n", "home", F.lit(0))), "sides")
    large = materialize(_blocks(sides).where("b0 > 1 or b1 > 1"), "large")
    two, none = F.col("size") < 0, F.lit(0)
    whole = sides.join(large, ["key", "size"], "left_anti")
    dealt = whole.select("key", "size", none.alias("bi"), none.alias("bj"), F.when(two, F.col("side")).otherwise(0).alias("own"), "home", "node", "root")
    if not large.isEmpty():
        crowded = materialize(sides.join(large.select("key", "size"), ["key", "size"]), "crowded")
        cut = materialize(_partnered(crowded, words), "cut")
        mine, theirs = F.when(F.col("side") == 0, F.col("b0")).otherwise(F.col("b1")), F.when(two & (F.col("side") == 0), F.col("b1")).otherwise(F.col("b0"))
        cut = cut.join(_blocks(cut).where("size >= 0 or b0 > 0 and b1 > 0"), ["key", "size"]).withColumn("own", F.pmod(F.xxhash64("node"), mine).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(none, theirs - 1)))
        first = F.when(two, F.col("side") == 0).otherwise(F.col("own") <= F.col("other"))
        bi, bj = F.when(first, F.col("own")).otherwise(F.col("other")), F.when(first, F.col("other")).otherwise(F.col("own"))
        dealt = dealt.union(cut.select("key", "size", bi, bj, F.when(two, F.col("side")).otherwise(F.col("own")), "home", "node", "root"))
    dealt = dealt.join(words, "node").select("key", "size", "bi", "bj", "own", "home", "node", "root", "text")
    dealt = dealt.repartition("key", "size", "bi", "bj").sortWithinPartitions("key", "size", "bi", "bj")
    return materialize(dealt.mapInArrow(_rest_batches, "a long, b long").distinct(), "more")


def _classes(docs: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(rid, key, doc_id, tkey of every row; tkey, class_id, class_key, class_size, id, kept of every text)."""
    doc_id, tkey = F.col("doc_id").cast("long").alias("doc_id"), F.md5(text_or_empty()).alias("tkey")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), key.alias("key"), doc_id, tkey, text_or_empty().alias("text"))
    rows = materialize(rows.mapInArrow(_sketch_batches, "rid long, key string, doc_id long, tkey string, n long, sketch array<long>"), "sketches")
    texts = rows.groupBy("tkey", "n", "sketch").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    texts = materialize(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    buckets = texts.select("node", "n", F.explode("sketch").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = materialize(buckets.join(shared, "key"), "members")
    spread = members.groupBy("node").agg(F.sum("c").alias("spread"))
    ranked = members.join(spread, "node")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("spread", -F.col("node"), "n")).alias("x")).select("key", (-F.col("x.col2")).alias("leader"), F.col("x.n").alias("ln"))
    leaders = materialize(leaders, "leaders")
    fits = lambda x, y: F.least(x, y) >= SIMILARITY * F.greatest(x, y)
    stars = members.join(leaders, "key").where((F.col("node") != F.col("leader")) & fits(F.col("n"), F.col("ln")))
    stars = materialize(stars.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "stars")

    # One row of each text, found by id and digest, which spreads copies.
    wanted = texts.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("tkey").alias("k"), "id")
    whole = docs.select(doc_id, tkey, text_or_empty().alias("text"))
    same = (F.col("tkey") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id"))
    words = materialize(whole.join(wanted, same).select("tkey", "doc_id", "node", "text").dropDuplicates(["tkey", "doc_id"]).select("node", "text"), "words")

    links = materialize(_verified(stars, words), "links")
    roots = components(links)
    more = _rest(members, roots, words)
    if not more.isEmpty():
        roots = components(links.union(more))
    rooted = materialize(texts.drop("sketch", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    # Written before it is joined, so that the join may split a hot class.
    head = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "tkey")).alias("h")
    sums = rooted.groupBy("root").agg(head, F.sum("copies").alias("class_size"))
    name = F.coalesce("h.id", -F.pmod(F.xxhash64("h.tkey"), F.lit(2**62)) - 1).alias("class_id")
    sums = materialize(sums.select("root", "class_size", name, F.col("h.tkey").alias("class_key"), F.col("h.node").alias("head")), "classes")
    return rows, materialize(rooted.join(sums, "root").select("tkey", "class_id", "class_key", "class_size", "id", (F.col("node") == F.col("head")).alias("kept")), "placed")


def _heads(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows (rid, key) that may be kept: those with the text and the id that are kept of their class."""
    heads = texts.where("kept").select(F.col("tkey").alias("k"), "id")
    return rows.join(heads, (F.col("tkey") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("tkey", "rid", "key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least id of its class), class_size, kept (the one row of its class that is), class_key."""
    rows, texts = _classes(docs, F.lit(None).cast("string"))
    chosen = materialize(_heads(rows, texts).groupBy("tkey").agg(F.min("rid").alias("rid")).select("rid", F.lit(True).alias("kept")), "chosen")
    out = rows.select("rid", "doc_id", "tkey").join(texts.drop("id", "kept"), "tkey").join(chosen, "rid", "left")
    return out.select("doc_id", "class_id", "class_size", F.coalesce("kept", F.lit(False)).alias("kept"), "class_key")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, the one that `near_duplicates` keeps, with docs' own columns."""
    tmp = free_prefix(docs.columns, "nd_") + "key"
    digest = row_digest(docs.columns)
    rows, texts = _classes(docs, digest)
    heads = _heads(rows, texts).groupBy("tkey", "key").agg(F.count("*").alias("alike"))
    chosen = materialize(heads.groupBy("tkey").agg(F.min(F.struct("key", "alike")).alias("x")).select(F.col("x.key").alias(tmp), F.col("x.alike").alias("alike")), "chosen")
    keyed = docs.withColumn(tmp, digest)
    out = keyed.join(chosen.where("alike = 1").select(tmp), tmp, "left_semi")
    many = chosen.where("alike > 1").select(tmp)
    if not many.isEmpty():  # repeated rows: one of them stands for all
        out = out.union(keyed.join(many, tmp, "left_semi").dropDuplicates([tmp]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
