"""Best-fit packing (operator 1): conflict-constrained best fit.

Documents become pieces of at most `CAPACITY` words and go to bins of that
capacity. Bins are ordered by what is left in them and carry two bitmaps: of
the duplicate clusters they hold, and of sources, `PER_SOURCE` bits a source.
A piece looks up the tightest bin that fits it and searches on through its
successors until one is compatible: its cluster's bit is clear, and one of its
source's bits. If none is, a bin is opened. Pieces come longest first.

Packing is sequential, so documents are dealt into groups of about
`GROUP_ROWS` by a hash of id, cluster and copy; a group is packed in one task with
bounded memory, and each bin belongs to one group, so the constraints hold
over the whole table. A source or cluster with a third of all rows is spread
over all groups. Only ids, sizes, sources and digests are shuffled; texts stay
where they are.

Defined results: a null text counts as empty; a document without words takes
no room and gets one row with a null bin; a null source is a source of its
own; repeated rows are packed one by one, and as copies they never share a
bin; an empty table gives an empty result; other columns are ignored. Pieces
of one document are not copies of each other, but never share a bin either,
as all but the last fill theirs.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import materialize, text_or_empty, words_array

CAPACITY, PER_SOURCE, GROUP_ROWS = 2048, 4, 4096
_SCHEMA = "doc_id long, piece int, first_word long, n_words long, bin string, place long, bin_words long"


class Bins:
    """Open bins in order of what is left, with their bitmaps."""

    def __init__(self, capacity: int, per_source: int, n_sources: int | None = None):
        self.capacity, self.per_source = capacity, per_source
        #: What the bitmap of a bin that takes no source any more looks like.
        self.full = None if n_sources is None else (1 << (n_sources * per_source)) - 1
        self.order: list[tuple[int, int]] = []  # (words left, bin)
        self.used: list[int] = []
        self.clusters: list[int] = []
        self.sources: list[int] = []

    def _slot(self, b: int, source: int) -> int | None:
        """The first clear bit of the source in the bin, if there is one."""
        own = (self.sources[b] >> (source * self.per_source)) & ((1 << self.per_source) - 1)
        return None if own == (1 << self.per_source) - 1 else source * self.per_source + own.bit_count()

    def put(self, size: int, cluster: int, source: int) -> tuple[int, int]:
        """(bin, place in it) of a piece; cluster is -1 if it has no copies here."""
        i = bisect_left(self.order, (size, -1))
        bit = 1 << cluster if cluster >= 0 else 0
        while i < len(self.order):
            b = self.order[i][1]
            if not self.clusters[b] & bit:
                slot = self._slot(b, source)
                if slot is not None:
                    break
            i += 1
        else:
            b, slot = len(self.used), source * self.per_source
            self.used.append(0)
            self.clusters.append(0)
            self.sources.append(0)
            self.order.append((self.capacity, b))
            i = len(self.order) - 1
            insort(self.order, self.order.pop())
            i = bisect_left(self.order, (self.capacity, b))
        del self.order[i]
        place = self.used[b]
        self.used[b] += size
        self.clusters[b] |= bit
        self.sources[b] |= 1 << slot
        if self.used[b] < self.capacity and self.sources[b] != self.full:
            insort(self.order, (self.capacity - self.used[b], b))
        return b, place


def pack_group(pdf: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Placements of one group's documents (doc_id, source, size, cluster, copy, grp).

    Ids come as text: a column of numbers with nulls would turn to floating point.
    """
    copies = pdf.groupby("cluster")["cluster"].transform("size")
    cluster_of = {c: i for i, c in enumerate(sorted(pdf.loc[copies > 1, "cluster"].unique()))}
    source_of = {s: i for i, s in enumerate(sorted(pdf["source"].unique()))}
    pieces, out = [], []
    for doc, source, size, cluster, copy in zip(pdf["doc_id"], pdf["source"], pdf["size"], pdf["cluster"], pdf["copy"]):
        doc = None if pd.isna(doc) else int(doc)
        if not size:
            out.append((doc, 0, 0, 0, None, None, None))
        for k, begin in enumerate(range(0, size, capacity)):
            pieces.append((-min(capacity, size - begin), doc is not None, doc or 0, k, cluster, source, copy, begin, doc))
    pieces.sort(key=lambda p: p[:7])
    bins, group, at = Bins(capacity, per_source, len(source_of)), int(pdf["grp"].iloc[0]), []
    for size, _, _, k, cluster, source, _, begin, doc in pieces:
        b, place = bins.put(-size, cluster_of.get(cluster, -1), source_of[source])
        at.append((doc, k, begin, -size, b, place))
    out += [(doc, k, begin, n, f"{group}-{b}", place, bins.used[b]) for doc, k, begin, n, b, place in at]
    kinds = {"doc_id": "Int64", "piece": "int32", "first_word": "int64", "n_words": "int64", "bin": "object", "place": "Int64", "bin_words": "Int64"}
    # Column by column: as one frame, ids beside a null would pass through floating point.
    return pd.DataFrame({name: pd.array([row[i] for row in out], dtype=kind) for i, (name, kind) in enumerate(kinds.items())})


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin, place (words before it), bin_words."""
    digest = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))).alias("source"),
        F.size(words_array(text_or_empty())).cast("long").alias("size"),
        F.md5(F.lower(F.regexp_replace(text_or_empty(), r"[\x20\x09-\x0D]+", " "))).alias("cluster"),
    )
    # Rows that agree in everything are told apart by a number, so that a row repeated often is still spread.
    digest = digest.groupBy(*digest.columns).agg(F.count("*").alias("rows"))
    digest = materialize(digest.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows"), "sizes")
    groups = max(1, -(-digest.count() // group_rows))
    dealt = digest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pack_group(pdf, capacity, per_source)

    return dealt.groupBy("grp").applyInPandas(run, _SCHEMA)
