from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from metroscope.llm.filter_interaction import filter_audit, removal_games, scaled_potentials, text_failures

from . import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows, labels):
    """(part, failed filters, good, toxic) per row (doc_id, text, source)."""
    out = []
    for i, text, source in rows:
        words = WORD.findall(text or "")
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text or "")) > 2 * len(text or ""),
            "D": bool(re.search(r"[#$%&*|]", text or "")),
            "E": i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows)}
        own = [m for m in labels if m[0] == i and i is not None]
        out.append((source or "", {f for f, failed in fails.items() if failed}, any(m[1] == 1 for m in own), any(m[2] == 1 for m in own)))
    return out


def brute(failures, names):
    out, parts = [], sorted({f[0] for f in failures})
    for part in parts:
        docs, per_filter = [f for f in failures if f[0] == part], dict.fromkeys(names, 0)
        steps = []
        for order in itertools.permutations(names):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                per_filter[name] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(name in d[1] for d in docs) - len(gone), sum(d[1] == {name} for d in docs),
                              sum(d[2] for d in gone), sum(d[3] for d in gone), name))
        out += [(*s[:-1], per_filter[s[-1]]) for s in steps]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_awkward_documents(spark):
    rows = [(r[0], r[1], r[3]) for r in awkward.documents()] + [(900 + k, awkward.prose(k, 210 + k) + " #" * (k % 3), "src1") for k in range(20)] + [
        (950 + k, awkward.prose(k, 210 + k).upper(), "src2") for k in range(6)]
    marks = [(i, k % 2, (k + 1) % 3, None, None, None) for k, (i, _, _) in enumerate(rows)] + [(None, 1, 1, None, None, None), (300, None, None, None, None, None)]
    docs = spark.createDataFrame([(i, t, None, s, *[None] * 14) for i, t, s in rows], awkward.SCHEMA)
    flags = text_failures(docs, spark.createDataFrame(marks, awkward.LABELS))
    found = filter_audit(flags, "part", "ABCDE", {"good_lost": "good", "toxic_lost": "toxic"})
    assert found.columns == COLUMNS and dict(found.dtypes)["step"] == "int"
    want = brute(failing(rows, marks), "ABCDE")
    assert sorted(map(tuple, found.collect())) == want
    assert len(want) == 600 * len({s or "" for _, _, s in rows}) and all(any(w[k] for w in want) for k in range(3, 10))


def test_empty(spark):
    flags = text_failures(awkward.empty(spark), spark.createDataFrame([], awkward.LABELS))
    assert filter_audit(flags, "part", "ABCDE", {"good_lost": "good"}).count() == 0


def test_potentials_of_other_numbers_of_filters(spark):
    """Shapley values add up, and null filters pass."""
    rng = random.Random(4)
    rows = [(rng.choice(["x", None]), *[rng.choice([True, False, None]) for _ in range(3)], rng.random() < 0.5) for _ in range(200)]
    flags = spark.createDataFrame(rows, "part string, p boolean, q boolean, r boolean, lost boolean")
    found = filter_audit(flags, "part", "pqr", {"lost_here": "lost"}).collect()
    for part in ("x", None):
        own = [{n for n, v in zip("pqr", r[1:4]) if v} for r in rows if r[0] == part]
        for name in "pqr":
            want = sum(sum(name in d and not d & set(order[: order.index(name)]) for d in own) for order in map("".join, itertools.permutations("pqr")))
            assert {r["shapley"] for r in found if r["part"] == part and r["filter_order"][r["step"] - 1] == name} == {want}
    game = removal_games(flags, "part", "pqr").withColumn("q", scaled_potentials(F.col("removed"), 3)).first()
    assert game["q"][:3] == [0, game["removed"][1], game["removed"][2]] and game["q"][3] == game["removed"][3] + game["removed"][1] + game["removed"][2]
