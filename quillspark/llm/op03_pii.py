"""Personal data (operator 3): candidate generators and gradient boosting.

High-recall generators propose spans of six kinds, which may overlap. Format
and context features go to boosted trees; per-kind thresholds on calibrated
probabilities select what is redacted, the likeliest first where candidates
overlap. Candidates that meet a base form (see `base_spans`) always stay.

The trees are fitted on `TRAIN_ROWS` labelled lines written from a seed
(`labelled_lines`), two thirds for the trees and one third for calibration;
that bound is the only sample here. Scoring is one pass in Arrow batches over
whole texts, without a shuffle. Rows that hold no digit, at sign, spelled-out
address or hexadecimal groups are settled by one vectorised test. All patterns are anchored so that
long runs cost linear time.

Defined results: a null text counts as empty; a null doc_id is kept as null;
repeated rows each get their own row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import boosting
from quillspark.llm.common import slices

KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
#: Labelled lines that the trees and the calibration see.
TRAIN_ROWS = 6000
#: Precision that a kind's threshold must reach on the calibration part.
PRECISION = 0.98

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MAY_HOLD = r"[0-9@]|[\[(]at[\])]| at  ?[A-Za-z0-9-]+ ?(?:\[dot\]|\(dot\)| dot )|[A-Fa-f]:[A-Fa-f]{1,4}:"
#: Generators of further candidates: kind, pattern.
_MORE = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,24}){1,3}")),
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9A-Za-z])")),
    ("ssn", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])")),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
)
_CONTEXT = (
    re.compile(r"(?i)e-?mail|mail|contact|write|reach"),
    re.compile(r"(?i)phone|tel\b|call|mobile|fax|dial"),
    re.compile(r"(?i)card|visa|credit|debit|payment"),
    re.compile(r"(?i)\bip\b|host|server|address|client|network"),
    re.compile(r"(?i)ssn|social|taxpayer|insurance"),
    re.compile(r"(?i)iban|bank|transfer|account"),
    re.compile(r"(?i)version|release|build|isbn|issn|order|invoice|serial|page|part|ref|ticket|tracking"),
    re.compile(r"(?i)date|time|year|born|since|until|\bat\b"),
    re.compile(r"[$€£%#]\s*$"),
)


@dataclass
class PiiModel:
    booster: boosting.Booster
    cuts: dict[str, float]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base forms, leftmost and non-overlapping by kind."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = free + len(text[free:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append(("email", begin, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that the generators propose besides the base forms; they may overlap."""
    return [(kind, m.start(), m.end()) for kind, pattern in _MORE for m in pattern.finditer(text)]


def _mod97(s: str) -> bool:
    s = s.replace(" ", "")
    s = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def features(text: str, kind: str, begin: int, end: int) -> list[float]:
    """Format of the span and words around it."""
    span, before, after = text[begin:end], text[max(0, begin - 40) : begin], text[end : end + 20]
    digits = "".join(c for c in span if "0" <= c <= "9")
    groups = [len(g) for g in re.split(r"[^0-9A-Za-z]+", span) if g]
    seps = set(re.sub(r"[0-9A-Za-z]", "", span))
    return [
        *(float(kind == k) for k in KINDS),
        float(len(span)),
        float(len(digits)),
        float(len(groups)),
        float(min(groups, default=0)),
        float(max(groups, default=0)),
        float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0),
        float(len(seps)),
        len(set(digits)) / max(1, len(digits)),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(kind == "iban" and _mod97(span)),
        float(span[:1] == "("),
        float("[" in span or "(" in span),
        float(any("a" <= c <= "f" or "A" <= c <= "F" for c in span)),
        float(digits[:3] in ("000", "666") or digits[:1] == "9"),
        *(float(bool(p.search(before))) for p in _CONTEXT),
        float(bool(_CONTEXT[6].search(after))),
    ]


def labelled_lines(rows: int = TRAIN_ROWS, seed: int = 11) -> list[tuple[str, int, int, str, int]]:
    """(text, start, end, kind, label): personal data in many formats, and look-alikes that are none."""
    rng = random.Random(seed)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    up = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n))

    def number_with(test, n):
        while True:
            s = num(n)
            if test(s):
                return s

    def iban(good):
        body = up(4) + num(14)
        check = 98 - int("".join(str(int(c, 36)) for c in body + "DE00")) % 97
        check = check if good else (check + rng.randint(1, 90)) % 97
        s = f"DE{check:02d}{body}"
        return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if rng.random() < 0.5 else s

    def phone():
        sep = rng.choice(" .-")
        return rng.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{sep}{num(3)}{sep}{num(4)}", f"{num(2)}{sep}{num(2)}{sep}{num(2)}{sep}{num(2)}", f"{num(4)}{sep}{num(3)}{sep}{num(3)}"])

    def card(good):
        s = number_with(lambda x: luhn(x) == good, 16)
        sep = rng.choice([".", ".", " ", "-", ""])
        return sep.join(s[i : i + 4] for i in range(0, 16, 4))

    says = {"email": ["email", "contact", "write to"], "phone": ["call", "phone:", "tel", "mobile"], "card": ["card", "visa", "payment by"], "ip": ["host", "server ip", "client"], "ssn": ["ssn", "social security"], "iban": ["iban", "bank account"]}
    make = {
        "email": (lambda: f"{word()}{rng.choice([' [at] ', '(at)', ' at '])}{word()}{rng.choice([' [dot] ', '(dot)', ' dot '])}{rng.choice(['com', 'org', 'net', 'de'])}", lambda: f"{word()} at {word()} dot {word()}"),
        "ip": (lambda: ":".join("%x" % rng.randint(4096, 65535) for _ in range(8)), lambda: ":".join(num(2) for _ in range(rng.choice([3, 3, 4])))),
        "card": (lambda: card(True), lambda: card(False)),
        "phone": (phone, lambda: rng.choice([f"{rng.randint(1900, 2030)}-{num(2)}-{num(2)}", f"{num(2)}.{num(2)}.{rng.randint(1900, 2030)}", f"{num(3)} {num(3)} {num(3)}", f"{num(2)}-{num(4)}-{num(4)}-{num(4)}", f"{num(3)}-{num(2)}-{num(3)}"])),
        "ssn": (lambda: f"{number_with(lambda x: x not in ('000', '666') and x[0] != '9', 3)}-{num(2)}-{num(4)}", lambda: f"{rng.choice(['000', '666', '9' + num(2)])}-{num(2)}-{num(4)}"),
        "iban": (lambda: iban(True), lambda: iban(False)),
    }
    noise = ["version", "release", "order", "invoice", "serial", "part", "ref", "date", "$", "tracking", "page"]
    out = []
    while len(out) < rows:
        kind = rng.choice(KINDS)
        good = rng.random() < 0.5
        lead = rng.choice(says[kind]) if rng.random() < (0.75 if good else 0.1) else (rng.choice(noise) if rng.random() < (0.0 if good else 0.6) else word())
        bare = good and kind in ("phone", "ssn") and not any(lead == s for s in says[kind])
        before = f"{prose(rng.randint(0, 5))} {lead} "
        span = make[kind][0 if good else 1]()
        text = before + span + " " + prose(rng.randint(0, 5))
        for k, b, e in candidates(text):
            if e > len(before) and b < len(before) + len(span):
                right = good and k == kind and abs(b - len(before)) <= 1 and abs(e - len(before) - len(span)) <= 1 and not (bare and k == "phone")
                out.append((text, b, e, k, int(right)))
    return out[:rows]


def train(rows: int = TRAIN_ROWS, seed: int = 11, precision: float = PRECISION) -> PiiModel:
    lines = labelled_lines(rows, seed)
    x = np.array([features(t, k, b, e) for t, b, e, k, _ in lines])
    y = np.array([float(v) for *_, v in lines])
    held = np.arange(len(y)) % 3 == 2
    booster = boosting.calibrate(boosting.fit(x[~held], y[~held]), x[held], y[held])
    p, kinds = booster.probability(x[held]), np.array([k for *_, k, _ in lines])[held]
    return PiiModel(booster, {k: boosting.threshold(p[kinds == k], y[held][kinds == k], precision) for k in KINDS})


def select(text: str, model: PiiModel) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, spans that the trees add)."""
    base = base_spans(text)
    new = [c for c in candidates(text) if not any(c[1] < e and b < c[2] for _, b, e in base)] if len(base) < 64 else _clear(candidates(text), base)
    if not new:
        return base, []
    p = model.booster.probability(np.array([features(text, *c) for c in new]))
    added, taken = [], _Taken()
    for i in sorted((i for i in range(len(new)) if p[i] >= model.cuts[new[i][0]]), key=lambda i: (-p[i], new[i])):
        if taken.add(new[i][1], new[i][2]):
            added.append(new[i])
    return base, added


class _Taken:
    """Disjoint intervals, ordered by start."""

    def __init__(self):
        self.begins, self.ends = [], []

    def add(self, begin: int, end: int) -> bool:
        from bisect import bisect_left

        i = bisect_left(self.begins, begin)
        if (i and self.ends[i - 1] > begin) or (i < len(self.begins) and self.begins[i] < end):
            return False
        self.begins.insert(i, begin)
        self.ends.insert(i, end)
        return True


def _clear(found, base):
    """Candidates that meet no base span, by a sweep over merged base spans."""
    merged: list[list[int]] = []
    for _, b, e in sorted(base, key=lambda s: s[1]):
        if merged and b < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([b, e])
    begins, ends = np.array([m[0] for m in merged]), np.array([m[1] for m in merged])
    out = []
    for c in found:
        i = int(np.searchsorted(begins, c[2]))
        if not (i and ends[i - 1] > c[1]):
            out.append(c)
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_pii(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """One row per row of docs: base counts, digest of the base spans, all spans."""
    model = model or train()
    empty = hashlib.sha256(b"").hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            n = batch.num_rows
            counts = np.zeros((5, n), np.int64)
            shas, spans = [empty] * n, [""] * n
            hot = np.flatnonzero(pc.match_substring_regex(texts, _MAY_HOLD).to_numpy(zero_copy_only=False))
            for i in hot.tolist():
                base, added = select(texts[i].as_py(), model)
                for k in range(4):
                    counts[k, i] = sum(s[0] == KINDS[k] for s in base)
                counts[4, i] = len(added)
                shas[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans[i] = _joined(base + added)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(counts[k]) for k in range(4)), pa.array(shas), pa.array(spans), pa.array(counts[4])],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(scan, _SCHEMA)
