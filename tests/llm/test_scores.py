from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from metroscope.llm.bottom_k import containment, distinct_shingles, fingerprints, merge, merged_by, resemblance, sketch
from metroscope.llm.lm_scoring import cross_entropy_difference
from metroscope.llm.toxicity import _before_mix, distinct_grams, grams, toxicity
from metroscope.llm.words import mix

from . import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("limit", [10**6, 40])
def test_losses_against_a_plain_model(spark, monkeypatch, limit):
    """Bigrams counted with dictionaries; ``limit`` bounds the kept bigrams."""
    rows = [(r[0], r[1]) for r in awkward.documents()]
    targets = {15, 17, 200, 303}
    low = {c: c + 32 for c in range(65, 91)}
    texts = [WORD.findall((t or "").translate(low)) for _, t in rows]
    known = set(collections.Counter(w for t in texts for w in t))
    counts = [collections.Counter(), collections.Counter()]
    for (i, _), words in zip(rows, texts):
        for pair in zip(["\0start", *words], words):
            counts[1][pair] += 1
            counts[0][pair] += i in targets
    kept = {p for p, n in counts[1].items() if n > 1}
    if len(kept) > limit:
        levels = collections.Counter(math.floor(math.log2(counts[1][p]) * 64) for p in kept)
        total = least = 0
        for level in sorted(levels, reverse=True):
            total += levels[level]
            if total > limit:
                break
            least = level
        kept = {p for p in kept if math.floor(math.log2(counts[1][p]) * 64) >= least}

    def loss(k, words):
        single, histories = collections.Counter(), collections.Counter()
        for (h, w), n in counts[k].items():
            single[w] += n
            histories[h] += n if (h, w) in kept else 0
        size, total = len(known) + 1, sum(single.values())
        out = 0.0
        for h, w in zip(["\0start", *words], words):
            p = (single[w] + 0.5) / (total + size / 2)
            out -= math.log(((counts[k][h, w] if (h, w) in kept else 0) + 16 * p) / (histories[h] + 16))
        return out / len(words)

    ids = spark.createDataFrame([(i,) for i in [*targets, 15, 99999, None]], "doc_id long")
    found = {}
    for r in cross_entropy_difference(awkward.frame(spark), ids, bigrams=limit).collect():
        found.setdefault((r["doc_id"], r["n_words"]), r)
    assert sum(1 for t in texts if not t) == sum(r["target_loss"] is None for r in cross_entropy_difference(awkward.frame(spark), ids).collect())
    for (i, _), words in list(zip(rows, texts))[::5]:
        if words:
            r = found[i, len(words)]
            assert r["target_loss"] == pytest.approx(loss(0, words), rel=1e-5) and r["background_loss"] == pytest.approx(loss(1, words), rel=1e-5)
            assert r["difference"] == pytest.approx(r["target_loss"] - r["background_loss"], abs=1e-9)


@pytest.mark.parametrize("batch, keys", [(1 << 21, 1 << 20), (4000, 3000)])
def test_losses_by_every_word_and_bigram(spark, monkeypatch, batch, keys):
    """More words than 16 bits can number; bigrams seen once count as well."""
    monkeypatch.setattr("metroscope.llm.lm_scoring.BATCH_TOKENS", batch)
    monkeypatch.setattr("metroscope.llm.lm_scoring.BUCKET_KEYS", keys)
    rows = [(r[0], r[1]) for r in awkward.documents() if r[0] != 502] + [(2000 + k, " ".join(f"w{(k * 3001 + j * 7) % 70_001}" for j in range(2500))) for k in range(30)]
    targets = {15, 17, 200, 303, 2003, 2004}
    low = {c: c + 32 for c in range(65, 91)}
    texts = [WORD.findall((t or "").translate(low)) for _, t in rows]
    pairs, single, histories = ([collections.Counter(), collections.Counter()] for _ in range(3))
    for (i, _), words in zip(rows, texts):
        for h, w in zip(["\0start", *words], words):
            for k in (0, 1) if i in targets else (1,):
                pairs[k][h, w] += 1
                single[k][w] += 1
                histories[k][h] += 1

    def loss(k, words):
        size, total = len(single[1]) + 1, sum(single[k].values())
        p = lambda w: (single[k][w] + 0.5) / (total + size / 2)
        return sum(-math.log((pairs[k][h, w] + 16 * p(w)) / (histories[k][h] + 16)) for h, w in zip(["\0start", *words], words)) / len(words)

    assert len(single[1]) > 1 << 16
    ids = spark.createDataFrame([(i,) for i in [*targets, 15, 99999, None]], "doc_id long")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = cross_entropy_difference(docs, ids).collect()
    key = lambda i, n, a: (i is None, i or 0, n, a or 0)
    want = sorted([(i, len(w), loss(0, w) if w else None, loss(1, w) if w else None) for (i, _), w in zip(rows, texts)], key=lambda r: key(*r[:3]))
    found = sorted(found, key=lambda r: key(r["doc_id"], r["n_words"], r["target_loss"]))
    assert [(r["doc_id"], r["n_words"]) for r in found] == [r[:2] for r in want]
    for r, (_, n, a, b) in zip(found, want):
        assert (r["target_loss"], r["background_loss"]) == ((pytest.approx(a, rel=1e-9), pytest.approx(b, rel=1e-9)) if n else (None, None))
        assert r["difference"] == (pytest.approx(a - b, abs=1e-9) if n else None)
    assert cross_entropy_difference(awkward.empty(spark), ids.limit(0)).count() == 0


def test_scores_of_nothing(spark):
    ids = spark.createDataFrame([], "doc_id long")
    assert cross_entropy_difference(awkward.empty(spark), ids).count() == 0
    assert cross_entropy_difference(awkward.frame(spark), ids, words=3).count() == len(awkward.documents())


def test_grams_are_those_of_the_text():
    text = "  Ab\ncd é  "
    assert len(distinct_grams(text)) == len({" ab cd é "[k : k + n] for n in (4, 6, 8, 10) for k in range(len(" ab cd é ") - n + 1)})
    long = "ab cde " * 200_000
    assert len(distinct_grams(long)) == len(distinct_grams(long[:7000]))
    x = np.array([0, 1, 2**64 - 1, 12345678901234567], dtype=np.uint64)
    assert (_before_mix(mix(x)) == x).all() and list(grams(None)) == []


def test_toxicity_on_held_out_documents(spark):
    bad = ["moronka", "trastavo", "lomiste"]
    rows, marks = [], []
    for k in range(600):
        text = awkward.prose(k, 50)
        if k % 4 == 0:
            words = text.split(" ")
            for j in range(3):
                words[(k * 7 + 11 * j) % len(words)] = bad[(k // 4 + j) % 3]
            text = " ".join(words)
        rows.append((k, text, *[None] * 16))
        marks.append((k, 1, int(k % 4 == 0), None, None, None))
    marks += [(None, 1, 1, None, None, None), (1, 1, None, None, None, None), (2, 1, 0, None, None, None), (70_000, 1, 1, None, None, None)]
    docs = awkward.frame(spark, rows + [r for r in awkward.documents() if r[0] is None or r[0] >= 300 and r[0] < 307][:8])
    found = toxicity(docs, spark.createDataFrame(marks, awkward.LABELS)).collect()
    assert len(found) == len(rows) + 8 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 if r["doc_id"] is not None else False) for r in found)
    judged = [r for r in found if r["held_out"] and r["doc_id"] is not None and (r["doc_id"] < 300 or r["doc_id"] > 306)]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in judged)
    assert len(judged) > 100 and right >= 0.95 * len(judged)


def test_toxicity_without_both_classes(spark):
    none = spark.createDataFrame([], awkward.LABELS)
    assert all(r["score"] < 0.01 for r in toxicity(awkward.frame(spark), none).collect())
    assert toxicity(awkward.empty(spark), none).count() == 0
    one = spark.createDataFrame([(10, 1, 1, None, None, None), (11, 1, 1, None, None, None)], awkward.LABELS)
    assert all(r["predicted"] == 1 for r in toxicity(awkward.frame(spark), one).collect())


def shingle_set(text):
    words = WORD.findall(text or "")
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


@pytest.mark.parametrize("rows_per_bucket", [4, 2000])
def test_fingerprints(spark, monkeypatch, rows_per_bucket):
    import hashlib

    monkeypatch.setattr("metroscope.llm.bottom_k.BUCKET_ROWS", rows_per_bucket)
    kept = [r for r in awkward.documents() if r[0] not in (None, 401) and r[0] != 400]
    kept += [(10**9 + k, awkward.prose(k, 20), *[None] * 16) for k in range(5)]
    found = {r["doc_id"]: r for r in fingerprints(awkward.frame(spark, kept)).collect()}
    order = sorted(kept, key=lambda r: r[0])
    assert len(found) == len(order)
    by_text = {}
    for k, row in enumerate(order):
        text, after = row[1] or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        r = found[row[0]]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        a, b, c = shingle_set(text), shingle_set(new), shingle_set(after)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(r["near_edited"] - like(a, b)) < 0.2 and abs(r["near_next"] - like(a, c)) < 0.2
        assert abs(r["n_shingles"] - len(a)) <= 0.35 * len(a)
        if len(a) < 60 and len(b) < 60:
            assert r["near_edited"] == pytest.approx(like(a, b)) and r["contained"] == pytest.approx(len(a & b) / len(a) if a else 1.0)
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_fingerprints_of_repeats_nulls_and_nothing(spark):
    assert fingerprints(awkward.frame(spark)).count() == len(awkward.documents())
    assert fingerprints(awkward.empty(spark)).count() == 0
    only = fingerprints(awkward.frame(spark, [(1, "a b c d e f", *[None] * 16)])).collect()
    assert len(only) == 1 and only[0]["near_next"] == 1.0


def test_sketches_merge(spark):
    rows = spark.createDataFrame([("x", awkward.prose(1, 300)), ("x", awkward.prose(2, 200)), ("y", awkward.prose(1, 300)), ("z", "")], "part string, text string")
    sketched = rows.withColumn("sketch", sketch(F.col("text"), 32))
    merged = {r["part"]: r["sketch"] for r in merged_by(sketched, "part", "sketch", 32).collect()}
    one, two, y, z = [r["sketch"] for r in sketched.collect()]
    assert merged["x"] == sorted(set(one) | set(two))[:32] and merged["y"] == y and "z" not in merged and z == []
    pair = spark.createDataFrame([(one, two, z)], "a array<long>, b array<long>, c array<long>").select(
        merge(F.col("a"), F.col("b"), 32), resemblance(F.col("a"), F.col("a"), 32), resemblance(F.col("a"), F.col("c"), 32), containment(F.col("c"), F.col("a"), 32), distinct_shingles(F.col("c"), 32)).first()
    assert pair[0] == merged["x"] and tuple(pair[1:]) == (1.0, 0.0, 1.0, 0.0)
