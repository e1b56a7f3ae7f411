"""Personal data by weak supervision.

Base spans (email, ip, card, phone) are found by fixed patterns and always stay.
Further candidates - secrets, long numbers, handles - get the votes of three labelers:

* regex: does the shape of the span look like personal data?
* gazetteer: does a cue word of the kind stand near it?
* context: do the characters around it set it apart as a value?

Votes are +1, 0 (no opinion) or -1. Expectation-maximisation over the counts of vote
patterns estimates each labeler's reliability per kind without any hand label, and its
posteriors are the soft labels of the final span classifier (naive Bayes over the votes
and the span's shape features). Candidates that the classifier accepts are added.

Plan: one pass counts (kind, votes, features) - all categorical, so the counts that
reach the driver are bounded by the feature domain, not by the rows - and a second
pass applies the fitted table. No shuffle of texts, no grouping by document.

Whole texts are scanned; offsets are code points, ends exclusive. Defined results: null
text = empty text, no spans; repeated rows give repeated rows; an empty table gives an
empty result; extra columns are ignored (``redact`` passes them through).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import table, tidied

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number", "handle")
KINDS = BASE + ADDED
LABELERS = 3
EM_ROUNDS = 30
ACCEPT = 0.5

# Cue words of the gazetteer labeler.
CUES = {
    "secret": ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "key"),
    "number": ("card", "visa", "account", "iban", "phone", "tel", "ssn", "passport", "konto"),
    "handle": ("user", "twitter", "follow", "contact", "login", "handle"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=")
_DIGITS = frozenset("0123456789")
_HEX = frozenset("0123456789abcdef")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails at its first digit fails at every later one, so a match
# can only start where a run starts
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_RUN = re.compile(r"[0-9]+")
_HANDLE = re.compile(r"@[A-Za-z0-9_]{2,}")
_WORTH = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # start, rank of the kind, end


def _digits(s: str) -> str:
    return "".join(c for c in s if c in _DIGITS)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    out: list[Span] = []
    if "@" in text:
        end = 0
        for m in _AT.finditer(text):
            start = at = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                out.append((start, 0, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Further spans that may be personal data; none overlaps a base span or another."""
    found: list[Span] = []
    end = 0
    for m in _RUN.finditer(text):
        if m.start() < end:
            continue
        lo, hi = m.start(), m.end()
        while lo > end and text[lo - 1] in _TOKEN:
            lo -= 1
        while hi < len(text) and text[hi] in _TOKEN:
            hi += 1
        end = hi
        token = text[lo:hi]
        if hi - lo >= 20 and not all(c in _DIGITS or c == "-" for c in token):
            found.append((lo, 4, hi))
    for m in _CARD.finditer(text):
        if 7 <= len(_digits(m[0])) <= 19:
            found.append((m.start(), 5, m.end()))
    if "@" in text:
        for m in _HANDLE.finditer(text):
            if m.start() == 0 or text[m.start() - 1] not in _LOCAL:
                found.append((m.start(), 6, m.end()))
    taken = sorted((s, e) for s, _, e in base)
    out: list[Span] = []
    last = i = 0
    for s, k, e in sorted(found, key=lambda x: (x[0], x[1])):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s >= last and not (i < len(taken) and taken[i][0] < e):
            out.append((s, k, e))
            last = e
    return out


def votes(text: str, span: Span) -> tuple[int, int, int]:
    """What the regex, gazetteer and context labelers say of a candidate."""
    s, k, e = span
    kind, body = KINDS[k], text[s:e]
    digits = sum(c in _DIGITS for c in body)
    if kind == "secret":
        share = digits / len(body)
        shape = 1 if 0.15 <= share <= 0.85 else -1
    elif kind == "number":
        plain = digits == len(body)
        shape = 1 if digits >= 12 or (not plain and digits >= 9) else -1 if digits < 9 else 0
    else:
        shape = 1 if digits else 0
    near = text[max(0, s - 32) : s].lower() + " " + text[e : e + 16].lower()
    cue = 1 if any(w in near for w in CUES[kind]) else 0 if kind == "number" else -1
    before = text[s - 1] if s else " "
    after = text[e] if e < len(text) else " "
    if before in "=:\"'" or after in "\"'":
        around = 1
    elif before.isspace() and not after.isalnum():
        around = 1 if kind == "number" else 0
    else:
        around = -1
    return shape, cue, around


def features(text: str, span: Span) -> tuple[int, int, int]:
    """Shape classes of a candidate: length, share of digits, character set."""
    s, _, e = span
    body = text[s:e]
    digits = sum(c in _DIGITS for c in body)
    if digits == len(body):
        chars = 0
    elif set(body) <= _HEX:
        chars = 1
    elif all(c in _TOKEN for c in body):
        chars = 2
    else:
        chars = 3
    return min(7, int(math.log2(len(body)))), 4 * digits // (len(body) + 1), chars


def posteriors(patterns: dict[tuple, float]) -> dict[tuple, float]:
    """P(personal data | votes) by EM over the counts of one kind's vote patterns."""
    rates = [{y: {-1: 0.3, 0: 0.3, 1: 0.4} for y in (0, 1)} for _ in range(LABELERS)]
    for r in rates:  # start: a labeler is right more often than wrong
        r[1] = {-1: 0.15, 0: 0.25, 1: 0.6}
        r[0] = {-1: 0.6, 0: 0.25, 1: 0.15}
    prior, post = 0.5, {}
    for _ in range(EM_ROUNDS):
        for p in patterns:
            yes = prior * math.prod(rates[j][1][v] for j, v in enumerate(p))
            no = (1 - prior) * math.prod(rates[j][0][v] for j, v in enumerate(p))
            post[p] = yes / (yes + no)
        total = sum(patterns.values())
        prior = (1 + sum(n * post[p] for p, n in patterns.items())) / (2 + total)
        for j in range(LABELERS):
            for y in (0, 1):
                w = {v: 1.0 for v in (-1, 0, 1)}
                for p, n in patterns.items():
                    w[p[j]] += n * (post[p] if y else 1 - post[p])
                rates[j][y] = {v: x / sum(w.values()) for v, x in w.items()}
    return post


def fit(counts: dict[tuple, int]) -> set[tuple]:
    """Accepted (kind, votes, features) classes: naive Bayes on EM's soft labels."""
    accepted: set[tuple] = set()
    for k in sorted({c[0] for c in counts}):
        rows = {c[1:]: n for c, n in counts.items() if c[0] == k}
        patterns: Counter = Counter()
        for c, n in rows.items():
            patterns[c[:LABELERS]] += n
        soft = posteriors(dict(patterns))
        weight = [Counter(), Counter()]  # (place, value) -> mass, per class
        mass = [1.0, 1.0]
        for c, n in rows.items():
            for y in (0, 1):
                m = n * (soft[c[:LABELERS]] if y else 1 - soft[c[:LABELERS]])
                mass[y] += m
                for place, value in enumerate(c):
                    weight[y][place, value] += m
        for c in rows:
            log_odds = math.log(mass[1] / mass[0])
            for place, value in enumerate(c):
                log_odds += math.log((weight[1][place, value] + 0.1) / (mass[1] + 1))
                log_odds -= math.log((weight[0][place, value] + 0.1) / (mass[0] + 1))
            if log_odds > math.log(ACCEPT / (1 - ACCEPT)):
                accepted.add((k, *c))
    return accepted


def train(docs: DataFrame, text: str = "text") -> set[tuple]:
    """Fit the span classifier on all rows: the accepted candidate classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column("t"):
                t = t.as_py() or ""
                if _WORTH.search(t):
                    for c in candidates(t, base_spans(t)):
                        seen[(c[1], *votes(t, c), *features(t, c))] += 1
        if seen:
            yield pa.RecordBatch.from_pydict(
                {"c": [list(c) for c in seen], "n": list(seen.values())}
            )

    rows = (
        docs.select(F.col(text).alias("t"))
        .mapInArrow(tidied(count), "c array<bigint>, n bigint")
        .groupBy("c")
        .agg(F.sum("n").alias("n"))
    )
    # bounded by the feature domain: kinds x votes x shape classes
    return fit({tuple(r["c"]): r["n"] for r in rows.collect()})


def all_spans(text: str, accepted: set[tuple]) -> tuple[list[Span], list[Span]]:
    """(base spans, base and accepted spans) of a text."""
    if not _WORTH.search(text):
        return [], []
    base = base_spans(text)
    more = [
        c
        for c in candidates(text, base)
        if (c[1], *votes(text, c), *features(text, c)) in accepted
    ]
    return base, sorted(base + more)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def detect(
    docs: DataFrame, accepted: set[tuple], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, counts of base kinds, digest of the base spans, all spans, n_added."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [f"n_{k}" for k in BASE]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(len(BASE) + 3)]
            for t in b.column("t"):
                base, every = all_spans(t.as_py() or "", accepted)
                per = Counter(k for _, k, _ in base)
                for i in range(len(BASE)):
                    cols[i].append(per[i])
                cols[-3].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                cols[-2].append(_joined(every))
                cols[-1].append(len(every) - len(base))
            types = [pa.int64()] * len(BASE) + [pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *arrays], ["doc_id", *names, "base_sha256", "spans", "n_added"]
            )

    schema = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names)
    return rows.mapInArrow(tidied(spans), schema + ", base_sha256 string, spans string, n_added bigint")


def redact(docs: DataFrame, accepted: set[tuple], text: str = "text") -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced by its kind."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            out = []
            for value in b.column(at):
                t = value.as_py()
                _, every = all_spans(t or "", accepted)
                last, parts = 0, []
                for s, k, e in every:
                    if e <= last:
                        continue  # inside a span that is replaced already
                    parts += [t[last:s] if s > last else "", f"<{KINDS[k].upper()}>"]
                    last = e
                out.append("".join([*parts, t[last:]]) if every else t)
            yield b.set_column(at, b.schema.field(at).name, pa.array(out, b.schema.field(at).type))

    return docs.mapInArrow(tidied(clean), docs.schema)


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    docs = table(spark, sf_dir, "documents")
    return detect(docs, train(docs))
