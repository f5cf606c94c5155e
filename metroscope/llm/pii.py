"""Personal data by fixed shapes and a semi-Markov conditional random field.

Fixed shapes: e-mail addresses, IPv4 addresses, card numbers and phone numbers with a leading plus. The field scores
whole segments: a candidate is a run of at most ``MAX_TOKENS`` tokens that looks like an address (no blanks, one @) or is made of digits
and their punctuation; its features describe the entire span (its shape, the lengths of its digit groups, check digit, octets) and what
stands beside it. Tokens outside candidates have the label "none". Dynamic programming over the
token positions of a stretch sums or maximises over all ways to cut it into labelled segments, so boundaries and types are chosen
together; segments of bounded length keep that linear in the text.

It is trained here, on the spans of the fixed shapes in a bounded sample of documents, and on the same phone
numbers written without their country code, which the fixed shapes do not know. It adds the segments of the best cutting whose probability is high
and which overlap no fixed span.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
LEAST_DIGITS = 6
SAMPLE_DOCS = 2_000
STRETCHES = 600
EPOCHS = 4
CERTAIN = 0.9
SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\s]")
_STRETCH = re.compile(r"[^\s@]*@[^\s@]*|[+(]?[0-9][0-9+().\x20/-]*[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed shapes, kind by kind; matches of a kind do not overlap, those that fail its condition are dropped."""
    out = []
    if "@" in text:
        done, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            found = _DOMAIN.match(text, at) if start < at else None
            if found:
                done = found.end()
                out.append(("email", start, done))
            at = text.find("@", max(at + 1, done))
    if any(d in text for d in "0123456789"):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


class Stretch:
    """The tokens of one stretch of text that may hold entities, and its candidate segments by their last token."""

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
        before = re.search(r"([^\W\d_]+)\W*$", text[max(0, start - 24) : start])
        self.word = before[1].lower() if before else ""
        self.ending: list[list[tuple[int, list[str]]]] = [[] for _ in self.tokens]
        for i, (a, _) in enumerate(self.tokens):
            if not (text[a].isalnum() or text[a] in "+("):
                continue
            for j in range(i, min(len(self.tokens), i + MAX_TOKENS)):
                b = self.tokens[j][1]
                if text[b - 1].isalnum() and self.possible(text[a:b]):
                    self.ending[j].append((i, self.features(a, b, i == 0)))

    @staticmethod
    def possible(span: str) -> bool:
        if "@" in span:
            return span.count("@") == 1 and " " not in span and "." in span[span.index("@") :] and span[0] not in "+("
        return len(_digits(span)) >= LEAST_DIGITS and not any(c.isalpha() for c in span)

    def features(self, a: int, b: int, first: bool) -> list[str]:
        span = self.text[a:b]
        groups = [len(g) for g in re.findall(r"[0-9]+", span)]
        total = sum(groups)
        shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", span))
        left, right = self.text[a - 1 : a], self.text[b : b + 1]
        out = [f"shape {shape}", f"lead {span[0] if not span[0].isalnum() else '9' if span[0].isdigit() else 'a'}", f"digits {min(total, 20)}",
               f"left {'edge' if not left or left.isspace() else left if not left.isalnum() else 'w'}", f"right {'edge' if not right or right.isspace() else right if not right.isalnum() else 'w'}",
               f"marks {''.join(sorted(set(c for c in span if not c.isalnum())))}"]
        if "@" not in span:
            out.append("groups " + "-".join(map(str, groups[-6:])))
            if 13 <= total <= 19:
                out.append(f"luhn {luhn(_digits(span))}")
            if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span):
                out.append(f"octets {all(g <= 3 for g in groups) and all(int(p) <= 255 for p in span.split('.'))}")
        if first and self.word:
            out.append(f"word {self.word}")
        return out


def stretches(text: str) -> Iterator[Stretch]:
    if "@" in text or any(d in text for d in "0123456789"):
        for m in _STRETCH.finditer(text):
            if Stretch.possible(m[0]) or "@" in m[0]:
                yield Stretch(text, m.start(), m.end())


class Field:
    """Weights of (feature, kind), of a token outside segments and of one label following another."""

    def __init__(self, weights: dict[str, list[float]] | None = None, outside: float = 0.0, follow: list[list[float]] | None = None):
        self.weights = weights or {}
        self.outside = outside
        self.follow = follow or [[0.0] * 5 for _ in range(5)]  # label 0 is none

    def score(self, features: list[str], kind: int) -> float:
        return sum(w[kind] for f in features if (w := self.weights.get(f)))

    def arcs(self, stretch: Stretch) -> list[list[tuple[int, int, float, list[str]]]]:
        """By last token: (first token, label, score, features) of every segment; label 0 covers one token."""
        return [[(j, 0, self.outside, [])] + [(i, k + 1, self.score(fs, k), fs) for i, fs in ending for k in range(4)] for j, ending in enumerate(stretch.ending)]

    def sums(self, arcs) -> tuple[list, list, float]:
        """Forward and backward log sums over cuttings, by position and label, and the log of the total."""
        n = len(arcs)
        forward = [[-math.inf] * 5 for _ in range(n + 1)]
        forward[0][0] = 0.0
        for j in range(n):
            for i, y, s, _ in arcs[j]:
                forward[j + 1][y] = _plus(forward[j + 1][y], s + _total(forward[i][p] + self.follow[p][y] for p in range(5)))
        backward = [[-math.inf] * 5 for _ in range(n + 1)]
        backward[n] = [0.0] * 5
        for j in range(n - 1, -1, -1):
            for i, y, s, _ in arcs[j]:
                for p in range(5):
                    backward[i][p] = _plus(backward[i][p], self.follow[p][y] + s + backward[j + 1][y])
        return forward, backward, _total(forward[n])

    def step(self, stretch: Stretch, gold: list[tuple[int, int, int]], rate: float) -> None:
        """One step up the likelihood of the gold segments (first token, last token, kind)."""
        arcs = self.arcs(stretch)
        forward, backward, total = self.sums(arcs)
        inside = {t for i, j, _ in gold for t in range(i, j + 1)}
        chosen = {(i, j, k + 1) for i, j, k in gold} | {(t, t, 0) for t in range(len(arcs)) if t not in inside}
        for j, ending in enumerate(arcs):
            for i, y, s, features in ending:
                into = [forward[i][p] + self.follow[p][y] for p in range(5)]
                share = [math.exp(min(0.0, x + s + backward[j + 1][y] - total)) for x in into]
                off = ((i, j, y) in chosen) - sum(share)
                if abs(off) > 1e-4:
                    if y:
                        for f in features:
                            self.weights.setdefault(f, [0.0] * 4)[y - 1] += rate * off
                    else:
                        self.outside += rate * off
                for p in range(5):
                    self.follow[p][y] -= rate * 0.1 * share[p]
        last = 0
        for _, _, y in sorted(chosen):
            self.follow[last][y] += rate * 0.1
            last = y

    def best(self, stretch: Stretch) -> list[tuple[str, int, int, float]]:
        """(kind, start, end, probability) of the entities of the best cutting."""
        if not any(stretch.ending):
            return []
        arcs = self.arcs(stretch)
        n = len(arcs)
        top = [[(-math.inf, None)] * 5 for _ in range(n + 1)]
        top[0][0] = (0.0, None)
        for j in range(n):
            for i, y, s, _ in arcs[j]:
                value, p = max((top[i][p][0] + self.follow[p][y], p) for p in range(5))
                if value + s > top[j + 1][y][0]:
                    top[j + 1][y] = (value + s, (i, p, s))
        forward, backward, total = self.sums(arcs)
        out, j = [], n
        y = max(range(5), key=lambda k: top[n][k][0])
        while j:
            i, p, s = top[j][y][1]
            if y:
                inside = _total(forward[i][q] + self.follow[q][y] for q in range(5)) + s + backward[j][y] - total
                out.append((KINDS[y - 1], stretch.tokens[i][0], stretch.tokens[j - 1][1], math.exp(min(0.0, inside))))
            j, y = i, p
        return out[::-1]

    def dump(self) -> str:
        return json.dumps([self.weights, self.outside, self.follow])


def _plus(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def _total(values) -> float:
    out = -math.inf
    for v in values:
        out = _plus(out, v)
    return out


def training_stretches(text: str) -> Iterator[tuple[str, list]]:
    """(short text, spans) around each stretch, with the fixed spans as truth; phone numbers again without their country code."""
    spans = base_spans(text)
    for m in _STRETCH.finditer(text):
        a, b = max(0, m.start() - 24), min(len(text), m.end() + 8)
        inside = [(k, s - a, e - a) for k, s, e in spans if m.start() <= s and e <= m.end()]
        yield text[a:b], inside
        for kind, s, e in inside:
            own = text[a + s : a + e]
            if kind == "phone" and (cut := re.match(r"\+[0-9]{1,3}[\x20.-]+", own)) and len(_digits(own[cut.end() :])) >= 7:
                yield text[a : a + s] + own[cut.end() :] + text[a + e : b], [("phone", s, e - cut.end())]


def train(examples: list[tuple[str, list]], epochs: int = EPOCHS) -> Field:
    """Stochastic steps over the examples in a fixed order, with a falling rate."""
    field = Field()
    prepared = []
    for text, spans in examples:
        for stretch in stretches(text):
            first, last = {a: i for i, (a, _) in enumerate(stretch.tokens)}, {b: i for i, (_, b) in enumerate(stretch.tokens)}
            known = {(i, j) for j, ending in enumerate(stretch.ending) for i, _ in ending}
            gold, taken = [], set()
            for kind, s, e in spans:
                key = (first.get(s), last.get(e))
                if key in known and not taken & set(range(key[0], key[1] + 1)):
                    gold.append((*key, KINDS.index(kind)))
                    taken |= set(range(key[0], key[1] + 1))
            if any(stretch.ending):
                prepared.append((stretch, gold))
    for epoch in range(epochs):
        for stretch, gold in prepared:
            field.step(stretch, gold, 0.3 / (1 + epoch))
    return field


def training_sample(docs: DataFrame, sample_docs: int, limit: int) -> list[tuple[str, list]]:
    """Examples from at most ``sample_docs`` different texts that hold a digit or an @, those of the smallest hash; at most ``limit`` of them."""
    hits = docs.where("text rlike '[0-9@]'").select(F.xxhash64("text").alias("hash"), "text")
    # Copies count once; one number reaches the driver, and the texts chosen stay spread by their hash.
    last = hits.select("hash").distinct().orderBy("hash").limit(sample_docs).agg(F.max("hash")).first()[0]
    if last is None:
        return []
    chosen = hits.where(F.col("hash") <= last).groupBy("hash").agg(F.min("text").alias("text")).select("text")

    def run(batches):
        for batch in batches:
            found = [(len(_digits(x)), x, json.dumps(s)) for t in batch.column(0).to_pylist() for x, s in training_stretches(t)]
            found = [f for f in found if "@" in f[1] or f[0] >= LEAST_DIGITS]
            yield pa.RecordBatch.from_arrays([pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.string())], names=["text", "spans"])

    rows = chosen.mapInArrow(run, "text string, spans string").distinct().orderBy(F.xxhash64("text"), "text", "spans").limit(limit).collect()
    return [(r["text"], [tuple(s) for s in json.loads(r["spans"])]) for r in rows]


def find_spans(text: str | None, field: Field, certain: float = CERTAIN) -> tuple[list, list]:
    """(fixed spans, added spans) of one text."""
    text = text or ""
    base = base_spans(text)
    added = [(k, a, b) for stretch in stretches(text) for k, a, b, p in field.best(stretch)
             if p >= certain and not any(a < e and s < b for _, s, e in base)] if text else []
    return base, added


def listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def personal_data(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, limit: int = STRETCHES, certain: float = CERTAIN) -> DataFrame:
    """(doc_id, counts of fixed spans, base_sha256, spans, n_added) per row of ``docs`` (doc_id, text).

    A null text is empty and has no spans; repeated rows give repeated results; a null doc_id is kept; other columns are ignored. If the sample holds no
    example, the field is empty and adds nothing.
    """
    examples = training_sample(docs, sample_docs, limit)
    model = train(examples).dump() if examples else None

    def run(batches):
        field = Field(*json.loads(model)) if model else Field(outside=1.0)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = find_spans(text, field, certain if model else 2.0)
                rows.append((*[sum(s[0] == k for s in base) for k in KINDS], hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added), len(added)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=[x.split()[0] for x in SPANS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SPANS)
