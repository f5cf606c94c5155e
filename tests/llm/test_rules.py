from __future__ import annotations

import collections
import re

from pyspark.sql import functions as F

from metroscope.llm import decision_lists
from metroscope.llm.decision_lists import SHARES, Literal, any_rule, cuts_reached, learn_rules, learned_rules, quality_verdicts, text_statistics

from . import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics_against_python(spark):
    rows = text_statistics(awkward.frame(spark), F.struct("doc_id", "text")).collect()
    assert len(rows) == len(awkward.documents())
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts(r["row"]["text"]), r["row"]["doc_id"]


def test_rules_are_learned_and_applied(spark):
    good = [(k, awkward.prose(k, 60), *[None] * 16) for k in range(120)]
    shout = [(200 + k, awkward.prose(k, 60).upper().replace(" ", "!! "), *[None] * 16) for k in range(40)]
    signs = [(300 + k, awkward.prose(k, 60).replace(" ", "### "), *[None] * 16) for k in range(40)]
    docs = awkward.frame(spark, good + shout + signs)
    labels = [(i, 1, 0, None, None, None) for i in range(0, 120, 2)] + [(200 + k, 0, 0, None, None, None) for k in range(0, 40, 2)]
    labels += [(300 + k, 0, 0, None, None, None) for k in range(0, 40, 2)] + [(None, 0, 1, None, None, None), (4, None, 0, None, None, None), (6, 1, 0, None, None, None), (9999, 0, 0, None, None, None)]
    verdicts, rules = quality_verdicts(docs, spark.createDataFrame(labels, awkward.LABELS), F.struct("doc_id", "source"))
    assert rules and all(isinstance(x, Literal) for rule in rules for x in rule)
    kept = {r["row"]["doc_id"]: r["kept"] for r in verdicts.collect()}
    assert all(kept[i] for i in range(120)) and not any(kept[i] for i in range(200, 240)) and not any(kept[i] for i in range(300, 340))


def test_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], awkward.LABELS)
    verdicts, rules = quality_verdicts(awkward.frame(spark), labels, F.struct("doc_id"))
    assert rules == [] and verdicts.where("kept = base_failed").count() == 0
    verdicts, rules = quality_verdicts(awkward.empty(spark), labels, F.struct("doc_id"))
    assert rules == [] and verdicts.count() == 0


def test_rules_from_ranges_of_turns(spark):
    good = [(k, awkward.prose(k, 60 if k % 3 else 9), *[None] * 16) for k in range(240)]
    bad = [(300 + k, awkward.prose(k, 60 if k % 5 else 4).replace(" ", "### "), *[None] * 16) for k in range(120)]
    docs = awkward.frame(spark, good + bad + [(None, awkward.prose(1, 60), *[None] * 16), (7, None, *[None] * 16)])
    marks = [(i, int(i < 300), 0, None, None, None) for i in [*range(0, 240), *range(300, 420), *range(5000, 5200)]] + [(None, 0, 0, None, None, None), (3, None, 0, None, None, None)]
    labels = spark.createDataFrame(marks, awkward.LABELS)
    for most in (40, 150, 50_000):
        _, whole = quality_verdicts(docs, labels, F.struct("doc_id"), max_rows=most)
        assert learned_rules(docs, labels, most) == whole and whole
    assert learned_rules(docs, labels.limit(0)) == learned_rules(awkward.empty(spark), labels) == []


def test_first_rule_of_the_list_decides(spark):
    rules = [(Literal("digit_share", True, 0.5), Literal("mean_word", False, 3.0)), (Literal("upper_share", True, 0.9),)]
    rows = spark.createDataFrame([(0.6, 2.0, 0.0), (0.6, 4.0, 0.0), (0.0, 4.0, 0.95)], "digit_share double, mean_word double, upper_share double")
    assert [r[0] for r in rows.select(any_rule(rules)).collect()] == [True, False, True]
    assert [r[0] for r in rows.select(any_rule([])).collect()] == [False] * 3
    assert learn_rules(text_statistics(awkward.empty(spark), F.struct("doc_id")).select("*", F.lit(1).alias("key"), F.lit(True).alias("bad"))) == []


def test_cuts_are_counted_in_a_small_plan(spark, monkeypatch):
    cuts = [-1.5, 0.1, 0.1, 0.30000000000000004, 1e-300 + 0.5, 7.0]
    values = [None, float("nan"), -2.0, -1.5, 0.1, 0.3, 0.30000000000000004, 0.5, 6.9, 7.0, float("inf")]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", *[cuts_reached(cuts[:k], F.col("x")).alias(f"n{k}") for k in range(len(cuts) + 1)]).collect()
    for v, r in zip(values, rows):
        for k in range(len(cuts) + 1):
            assert r[f"n{k}"] == (0 if v is None else k if v != v else sum(v >= c for c in cuts[:k])), (v, k)
    plans = {}

    def kept(df, label, write=decision_lists.staged):
        plans[label] = df._jdf.queryExecution().analyzed().toString()
        return write(df, label)

    monkeypatch.setattr(decision_lists, "staged", kept)
    rows = spark.range(400).select(F.col("id").alias("key"), (F.col("id") % 3 == 0).alias("bad"), *[(F.pmod(F.xxhash64("id", F.lit(s)), F.lit(997)) / 997).alias(s) for s in SHARES])
    learn_rules(rows)
    # A condition for each of the hundreds of thresholds made this plan several hundred times as large.
    assert plans["binned"].count("WHEN") <= len(SHARES)
