from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metroscope.llm.mixing import in_mixed_order, mixed, schedule

from . import awkward


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(min_size=1, max_size=3)), st.integers(1, 30), min_size=1, max_size=8))
def test_every_block_keeps_its_window(parts):
    table, period = schedule(parts), sum(parts.values())
    assert [slot for _, _, slot, _, _ in table] == list(range(period))
    assert all(release <= slot < deadline for _, _, slot, release, deadline in table)
    served = dict.fromkeys(parts, 0)
    for name, block, slot, _, _ in table:
        assert block == served[name]
        served[name] += 1
        assert all(abs(served[s] * period - parts[s] * (slot + 1)) < period for s in parts)
    assert served == parts


def played(parts, rest):
    """Earliest deadline first, slot by slot; the supertask comes last among equal deadlines."""
    streams = [(s is not None, s or "", k) for s, k in parts.items()] + ([(2, "", rest)] if rest else [])
    period = sum(k for *_, k in streams)
    jobs = [(-(-(j + 1) * period // k), first, name, j, j * period // k) for first, name, k in streams for j in range(k)]
    out = []
    for slot in range(period):
        job = min(j for j in jobs if j[4] <= slot)
        jobs.remove(job)
        out.append((job[1], job[2], job[3]))
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text(min_size=1, max_size=2), st.integers(1, 12), max_size=5), st.integers(0, 60), st.integers(1, 4))
def test_equals_take_turns_in_the_slots_left_over(parts, equals, default):
    rest = equals * default
    period = sum(parts.values()) + rest
    whole = played(parts, rest)
    table = schedule(parts, rest)
    assert [(True, s, b, slot) for s, b, slot, _, _ in table] == [(*x, t) for t, x in enumerate(whole) if x[0] != 2]
    # Every source, named or not, is less than a block from its share after every slot, and every block is in its window.
    shares = {**parts, **{i: default for i in range(equals)}}
    served = dict.fromkeys(shares, 0)
    for slot, (kind, name, block) in enumerate(whole):
        who, k = (block % equals, default) if kind == 2 else (name, parts[name])
        assert served[who] * period // k <= slot < -(-(served[who] + 1) * period // k)
        served[who] += 1
        assert all(abs(served[s] * period - k * (slot + 1)) < period for s, k in shares.items())


def test_work_follows_the_named_sources_only():
    table = schedule({"a": 6, "b": 3}, 2 * 10**12)
    assert len(table) == 9 and all(release <= slot < deadline for *_, slot, release, deadline in table)


def test_bad_weights(spark):
    with pytest.raises(ValueError):
        schedule({"a": 0})
    with pytest.raises(ValueError):
        schedule({"a": 100_001})
    with pytest.raises(ValueError):
        mixed(awkward.empty(spark), F.struct("doc_id"), {}, 0)


def brute(rows, weights, default, size):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    streams = {}
    for i, text, source in rows:
        streams.setdefault(source, []).append((md5("" if i is None else str(i)), md5(text or ""), i, len(text or "")))
    named = {s: weights[s] for s in streams if s in weights}
    equals = sorted((s for s in streams if s not in weights), key=lambda s: (md5("" if s is None else "=" + s), s))
    rest = default * len(equals)
    period = sum(named.values()) + rest
    slots = {}
    for slot, (kind, name, block) in enumerate(played(named, rest)):
        slots[(2, block) if kind == 2 else (name, block)] = slot
    out = []
    for source, stream in streams.items():
        k, before = named.get(source, default), 0
        for _, _, i, n in sorted(stream, key=lambda x: x[:2]):
            block = before // size
            if source in named:
                slot = block // k * period + slots[source, block % k]
            else:
                nth = block * len(equals) + equals.index(source)
                slot = nth // rest * period + slots[2, nth % rest]
            out.append((i, source, block, slot, block * period // k, -(-(block + 1) * period // k)))
            before += n
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [4, 2000])
def test_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr("metroscope.llm.mixing.BUCKET_ROWS", bucket)
    rows = [(r[0], r[1], r[3]) for r in awkward.documents()]
    placed, last = mixed(awkward.frame(spark), F.struct("doc_id"), {"src0": 5, "": 2}, 3, 500)
    found = [(r["row"]["doc_id"], r["source"], r["block"], r["slot"], r["release"], r["deadline"]) for r in placed.collect()]
    assert sorted(found, key=repr) == brute(rows, {"src0": 5, "": 2}, 3, 500)
    assert last >= max(f[3] for f in found)


@pytest.mark.parametrize("weights", [{}, {"a0": 2, "a1": 1}, {f"a{i}": 1 + i % 3 for i in range(400)}])
def test_many_sources(spark, weights):
    """None, a few and all sources named; one source holds a third of the rows."""
    rows = [(i, "x" * (i % 97), f"a{i % 400}" if i % 3 else "a7") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed, last = mixed(docs, F.struct("doc_id"), weights, 2, 300)
    found = [(r["row"]["doc_id"], r["source"], r["block"], r["slot"], r["release"], r["deadline"]) for r in placed.collect()]
    assert sorted(found, key=repr) == brute(rows, weights, 2, 300)
    assert last >= max(f[3] for f in found)


def test_more_sources_than_the_bound_on_named_parts(spark):
    docs = spark.range(120_000).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"), F.concat(F.lit("host"), "id").alias("source"))
    placed, last = mixed(docs, F.struct("doc_id"), {"host5": 3}, 2, 300)
    out = placed.agg(F.count("*"), F.countDistinct("slot"), F.max("slot"), F.sum((~F.col("slot").between(F.col("release"), F.col("deadline") - 1)).cast("int"))).first()
    assert tuple(out) == (120_000, 120_000, last, 0)


def test_order_of_the_written_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("metroscope.llm.mixing.FILE_CHARS", 20_000)
    docs = awkward.frame(spark)
    out = in_mixed_order(docs, ("doc_id", "source", "n_chars"), {"src0": 5}, 1, 500)
    placed, _ = mixed(docs, F.struct("doc_id"), {"src0": 5}, 1, 500)
    slots = {}
    for r in placed.collect():
        slots.setdefault(r["row"]["doc_id"], set()).add(r["slot"])
    out.write.parquet(str(tmp_path / "mix"))
    files = sorted((tmp_path / "mix").glob("part-*.parquet"))
    ids = [r["doc_id"] for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 1 and len(ids) == len(awkward.documents())
    single = [min(slots[i]) for i in ids if len(slots[i]) == 1]
    assert single == sorted(single)


def test_files_are_even_when_one_source_runs_on(spark, tmp_path, monkeypatch):
    """A third of the rows have a share of a hundredth: nearly all slots of the mix are the tail of that source."""
    monkeypatch.setattr("metroscope.llm.mixing.FILE_CHARS", 20_000)
    docs = spark.range(6_000).select(F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 100)).alias("source"))
    in_mixed_order(docs, ("doc_id", "text", "source"), {}, 1, 500).write.parquet(str(tmp_path / "mix"))
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "mix")).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 6_000 and 12 <= len(sizes) <= 15 and max(sizes) <= 2 * 20_000 / 50


def test_empty(spark):
    placed, last = mixed(awkward.empty(spark), F.struct("doc_id"), {}, 1)
    assert placed.count() == 0 and last == -1
    assert in_mixed_order(awkward.empty(spark), ("doc_id", "text"), {}, 1).count() == 0
