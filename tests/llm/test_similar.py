from __future__ import annotations

import collections
import random
import re
import time

import numpy as np
import pytest

from metroscope.llm import jaccard_join
from metroscope.llm.components import _large_star, _small_star, connected_components
from metroscope.llm.jaccard_join import LEVEL_BITS, least_shared, linked_pairs, ordered_prefix, similar_components, similar_link_counts, similar_links
from metroscope.llm.storage import DROP, staged
from metroscope.llm.words import shingle_set, word_hashes

from . import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    """(doc_id, size, component) per row, by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def test_awkward_documents(spark):
    rows = [(r[0], r[1]) for r in awkward.documents()]
    assert result(similar_components(awkward.frame(spark))) == brute(rows)


@pytest.mark.parametrize("block", [8 << 20, 3000])
def test_every_link_is_given(spark, monkeypatch, block):
    """In a group of near copies each links with several others, not with the lead of the group alone."""
    monkeypatch.setattr("metroscope.llm.jaccard_join.BLOCK_BYTES", block)
    rows = [(r[0], r[1]) for r in awkward.documents()] + [(3000 + k, awkward.edited(awkward.prose(11, 150), k, 1 + k % 3)) for k in range(15)]
    sets = [grams(t) for _, t in rows]
    like = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counted = similar_link_counts(docs).collect()
    want = [(i, n, c, sum(like(sets[k], x) for j, x in enumerate(sets) if j != k)) for k, (i, n, c) in enumerate(
        (i, len(s), None) for (i, _), s in zip(rows, sets))]
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in counted), key=repr) == sorted(((i, n, m) for i, n, _, m in want), key=repr)
    assert result(similar_link_counts(docs).drop("n_links")) == brute(rows)
    ids, copies = {}, collections.Counter(s for s in sets if s)
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            ids[s] = min(ids.get(s, i), i)
    pairs = [(a, b) for a in copies for b in copies if a is not b and like(a, b)]
    found = [(r["a"], r["b"], r["copies_a"], r["copies_b"]) for r in similar_links(docs).collect()]
    assert len(found) == len(pairs) // 2 and len(found) > 50
    assert sorted([*found, *[(b, a, m, n) for a, b, n, m in found]], key=repr) == sorted(((ids.get(a), ids.get(b), copies[a], copies[b]) for a, b in pairs), key=repr)
    assert similar_links(awkward.empty(spark)).count() == 0 and similar_link_counts(awkward.empty(spark)).count() == 0


def test_empty_table(spark):
    assert similar_components(awkward.empty(spark)).collect() == []


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_dense_groups_in_blocks(spark, monkeypatch, block):
    """Many near copies of one text around the threshold, verified in many blocks or in one."""
    monkeypatch.setattr("metroscope.llm.jaccard_join.BLOCK_BYTES", block * 32)
    base = awkward.prose(1, 120)
    texts = [(k, awkward.edited(base, k, k % 7)) for k in range(60)] + [(100 + k, base[: 200 + 20 * k]) for k in range(10)]
    rows = [(i, t, *[None] * 16) for i, t in texts]
    assert result(similar_components(awkward.frame(spark, rows))) == brute(texts)


def test_prefixes_lose_no_linked_pair():
    rng = random.Random(3)
    levels = np.zeros(1 << LEVEL_BITS, dtype=np.uint8)
    for _ in range(300):
        pool = [rng.getrandbits(64) for _ in range(rng.randint(5, 200))]
        a = np.unique(np.array(pool, dtype=np.uint64))
        b = np.unique(np.array([x for x in pool if rng.random() > 0.11] + [rng.getrandbits(64) for _ in range(rng.randint(0, 9))], dtype=np.uint64))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            for order in range(3):
                shared = len(np.intersect1d(ordered_prefix(a, levels, order, 80), ordered_prefix(b, levels, order, 80)))
                assert shared >= min(least_shared(len(a), 80), least_shared(len(b), 80))
            assert [h.tolist() for _, h in linked_pairs([a], [b], levels, 80, 3)] == [[0]]


@pytest.mark.parametrize("bits", [8, 26])
def test_documents_that_share_little_stay_behind(spark, monkeypatch, bits):
    """However many tokens a corpus shares for the size of its bitmap, its other documents do not become candidates."""
    monkeypatch.setattr(jaccard_join, "MARK_BITS", bits)
    base = awkward.prose(1, 300)
    near = [(k, awkward.edited(base, k, 2)) for k in range(20)]
    alone = [(100 + k, awkward.prose(500 + k, 300)) for k in range(60)]
    docs = spark.createDataFrame(near + alone, "doc_id long, text string").repartition(3)
    rows, active, _ = jaccard_join._prepared(docs, 80, 5)
    of = {r["node"]: r["doc_id"] for r in rows.collect()}
    found = [of[r["node"]] for r in active.collect()]
    assert len(found) >= 20 and set(found) == set(range(20))
    assert result(similar_components(docs)) == brute(near + alone)


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_tokens_of_several_nodes(spark, batch):
    """Copies of a posting do not make its token shared; one that goes on over many batches is."""
    rng = random.Random(batch)
    rows = [(rng.randint(-40, 40), rng.randint(0, 3)) for _ in range(90)] + [(7, 5)] * 9 + [(60, 1)] * 8 + [(61, k // 4) for k in range(40)] + [(62, 2)] * 7 + [(62, 3)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = [tuple(r) for r in jaccard_join._met_again(spark.createDataFrame(rows, "token long, node long")).collect()]
        assert jaccard_join._met_again(spark.createDataFrame([], "token long, node long")).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    nodes = collections.defaultdict(set)
    for token, node in rows:
        nodes[token].add(node)
    assert set(found) == {(t, n) for t, n in rows if len(nodes[t]) > 1} and len(nodes[60]) == 1


def test_a_stage_leaves_no_shuffle_files(spark):
    """Disk does not depend on when the driver collects its garbage."""
    blocks = lambda: {str(x) for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if x.isShuffle()}
    frame = spark.range(1000).groupBy("id").count().repartition("count")
    before, was = blocks(), spark.conf.get(DROP, None)
    assert staged(frame, "kept").count() == 1000 and blocks() - before
    before = blocks()
    dropped = staged(frame, "dropped", drop=True)
    for _ in range(50):
        if not blocks() - before:
            break
        time.sleep(0.1)
    assert not blocks() - before and spark.conf.get(DROP, None) == was
    assert dropped.where("count = 1").count() == 1000


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 100), (200, 200), (300, 299), (300, 298)]
    found = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 298: 298, 299: 298, 300: 298}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_round_of_components_shuffles_once_per_step(spark):
    pairs = [(k, 7 * k % 40) for k in range(40)] * 3 + [(k, k + 1) for k in range(50, 90, 3)] * 2 + [(90 + k, 90) for k in range(30)]
    want = {}
    for a, b in pairs:
        if a != b:
            both = want.get(a, {a}) | want.get(b, {b})
            want.update(dict.fromkeys(both, both))
    edges = spark.createDataFrame(pairs, "a long, b long")
    found = {r["node"]: r["label"] for r in connected_components(edges).collect()}
    assert found == {node: min(nodes) for node, nodes in want.items()}
    # Per star a minimum and a join, and one that drops repeated edges at the end.
    text = _small_star(_large_star(edges))._jdf.queryExecution().optimizedPlan().toString()
    assert sum(text.count(x) for x in ("Aggregate", "Distinct")) == 4 and text.count("Union") == 2


def test_hashes_follow_the_text_only():
    long = "word " * 300_000 + "end"
    hashes = word_hashes(long)
    assert len(hashes) == 300_001 and len(set(hashes.tolist())) == 2
    assert (word_hashes("A b\tc") == word_hashes("a  B\nC")).all() and len(word_hashes(None)) == 0
    assert len({int(shingle_set(t)[0]) for t in ("a", "a b", "b a", "ab", "a b c d e")}) == 5
