from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metroscope.llm.pii import KINDS, LEAST_DIGITS, Field, Stretch, _digits, base_spans, find_spans, listed, luhn, personal_data, train, training_sample, training_stretches

from . import awkward

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.one_of(
    st.text("ab.@-+_%1 ", max_size=30), st.text("12590. ", max_size=30), st.text("+1 ().-2", max_size=30),
    st.lists(st.sampled_from(["4111 1111-1111 1111", "10.0.0.1", "256.1.1.1", "+1 (504) 555-3727", "a.b@c.de", "é", "@", " ", ",", "0" * 14, "1.2.3.4.5.6.7.8"]), max_size=6).map("".join)))
def test_fixed_shapes_equal_the_patterns(text):
    assert base_spans(text) == plain(text)


def number(rng):
    return f"+{rng.randint(1, 99)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"


def card(rng):
    digits = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
    return digits + next(str(d) for d in range(10) if luhn(digits + str(d)))


def texts(count, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(count):
        value = [number(rng), card(rng), ".".join(str(rng.randint(0, 255)) for _ in range(4)), f"{rng.choice('abc')}x.{rng.randint(1, 99)}@mail{k % 7}.example.com", str(rng.randint(10**6, 10**11)), "2021-03-04"][k % 6]
        words = awkward.prose(k, 14).split()
        words.insert(rng.randrange(len(words)), value)
        out.append(" ".join(words))
    return out


def field():
    return train([e for t in texts(240) for e in training_stretches(t)])


def test_field_finds_what_the_shapes_miss():
    model = field()
    hits = 0
    for t in texts(120, 2):
        base, added = find_spans(t, model)
        assert base == plain(t) and not any(a < e and s < b for _, a, b in added for _, s, e in base)
    for k in range(30):
        rng = random.Random(k)
        bare = number(rng).split(" ", 1)[1]
        text = f"please call {bare} today"
        hits += ("phone", 12, 12 + len(bare)) in find_spans(text, model)[1]
    assert hits >= 27
    joined = f"paid with {card(random.Random(1))} {card(random.Random(2))} today"
    assert [k for k, _, _ in find_spans(joined, model)[1]] == ["card", "card"]
    assert find_spans(None, model) == ([], []) and find_spans("plain words", Field()) == ([], [])


def test_sums_and_best_against_all_cuttings():
    rng = random.Random(4)
    for text in ("1.2.3.4", "+1 555-1234567", "a1@b.c.d", "55 66 77 88"):
        stretch = Stretch(text, 0, len(text))
        model = Field(outside=0.3, follow=[[rng.uniform(-1, 1) for _ in range(5)] for _ in range(5)])
        for ending in stretch.ending:
            for _, features in ending:
                for f in features:
                    model.weights[f] = [rng.uniform(-1, 1) for _ in range(4)]
        arcs = model.arcs(stretch)

        def cuttings(j):
            if j < 0:
                yield [], 0.0, 0
                return
            for i, y, s, _ in arcs[j]:
                for head, score, last in cuttings(i - 1):
                    yield [*head, (i, j, y)], score + s + model.follow[last][y], y

        scores = [(score, parts) for parts, score, _ in cuttings(len(arcs) - 1)]
        total = math.log(sum(math.exp(s) for s, _ in scores))
        assert math.isclose(model.sums(arcs)[2], total, rel_tol=1e-9)
        top = max(scores, key=lambda x: x[0])[1]
        found = model.best(stretch)
        want = [(KINDS[y - 1], stretch.tokens[i][0], stretch.tokens[j][1]) for i, j, y in top if y]
        assert [f[:3] for f in found] == want
        for (kind, a, b, p), (i, j, y) in zip(found, [x for x in top if x[2]]):
            share = sum(math.exp(s - total) for s, parts in scores if (i, j, y) in parts)
            assert math.isclose(p, share, rel_tol=1e-9)


def test_documents(spark):
    rows = awkward.documents() + [(1000 + k, t, *[None] * 16) for k, t in enumerate(texts(60))]
    found = personal_data(awkward.frame(spark, rows), certain=0.9).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r[1] or "")
    for r in found:
        wanted = [plain(t) for t in by_id[r["doc_id"]]]
        own = [w for w in wanted if hashlib.sha256(listed(w).encode()).hexdigest() == r["base_sha256"]]
        assert own
        assert tuple(r[f"n_{k}"] for k in KINDS) == tuple(sum(s[0] == k for s in own[0]) for k in KINDS)
        assert len(own[0]) + r["n_added"] == len([s for s in r["spans"].split(",") if s])
    assert personal_data(awkward.empty(spark)).count() == 0
    none = personal_data(awkward.frame(spark, [(1, "no digits here", *[None] * 16), (2, None, *[None] * 16)])).collect()
    assert [(r["spans"], r["n_added"]) for r in none] == [("", 0)] * 2
    assert len(list(itertools.chain.from_iterable(by_id.values()))) == len(rows)


def test_copies_do_not_change_the_sample(spark):
    own = [(t,) for t in texts(40)]
    once = training_sample(spark.createDataFrame(own, "text string"), 10, 600)
    hashed = spark.createDataFrame(own, "text string").where("text rlike '[0-9@]'").orderBy(F.xxhash64("text"))
    first = hashed.first()["text"]
    copied = spark.createDataFrame(own + [(first,)] * 50, "text string")
    assert len(once) > 1 and training_sample(copied, 10, 600) == once
    assert set(t for t, _ in once) == {x for r in hashed.limit(10).collect() for x, s in training_stretches(r["text"]) if "@" in x or sum(c.isdigit() for c in x) >= LEAST_DIGITS}
