from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from metroscope.llm.source_divergence import divergence_audit

from . import awkward

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, least_docs, top):
    """From (text, lang, source), term by term."""
    docs = [(TERM.findall((t or "").translate(LOWER)), lang or "", source or "") for t, lang, source in rows]
    seen, counts, whole, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for terms, lang, source in docs:
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
        whole[lang].update(terms)
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in seen[lang].items() if n >= least_docs]

        def share(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q, f = {s: share(counts[lang, s]) for s in own}, share(whole[lang]), lambda x, y: (x - y) ** 2 // (x + y)
        for s in own:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, source, 1, *[None] * 13) for k, (t, lang, source) in enumerate(rows)], awkward.SCHEMA)


@pytest.mark.parametrize("batch_words", [1 << 22, 60])
def test_against_brute_force(spark, batch_words):
    rng = random.Random(2)
    words = ["the", "The", "the,", "THE.", "l'eau", "eau", "a-b-a", "b", "Ünit", "ünit", "漢字", " x", "x1y", "...", "77", "é"] + [f"w{k}" for k in range(40)]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))).replace(" w3 ", "\x0bw3\n"), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None, "", "é"]))
            for _ in range(150)]
    rows += [(r[1], "en", r[3]) for r in awkward.documents()] + [(None, "xx", "s1"), ("", "xx", "s2"), ("same text here", "yy", "only")] * 3
    rows += [("rare term thrice", "zz", "s1")] * 9 + [("Rare, common", "zz", "s2")] * 2 + [("COMMON!", "zz", "s2")] * 9  # documents of a term come from two chunks
    found = divergence_audit(frame(spark, rows), least_docs=10, top=4, batch_words=batch_words)
    assert found.columns == COLUMNS and dict(found.dtypes)["value"] == "bigint"
    got, want = sorted(map(tuple, found.collect())), brute(rows, 10, 4)
    assert got == want
    assert ("zz", "s1", "term", "rare") in {r[:4] for r in got} and ("zz", "s2", "term", "common") in {r[:4] for r in got}


def test_no_term_is_kept(spark):
    rows = [("one two", "en", "a"), ("three", "en", "b"), ("one", "en", None)]
    assert sorted(map(tuple, divergence_audit(frame(spark, rows)).collect())) == brute(rows, 10, 10)
    assert divergence_audit(awkward.empty(spark)).count() == 0
