"""N-gram Jaccard self-join with prefix filters under several global token orders.

Two sets x and y with Jaccard similarity t or more share at least min(l(x), l(y)) tokens of their
prefixes, where x's prefix is its first |x| - ceil(t |x|) + l(x) tokens under any global order: at most
|x| - |x & y| <= |x| - ceil(t |x|) of them lie in x alone. Here l is a quarter of the plain prefix, plus one.
Under an order that puts rare tokens first so many tokens are rarely shared by chance; under several
different orders at once even less.

1. One pass hashes every text to its shingle set and counts the shingles that repeat within a batch.
   The counts give each shingle a frequency level, kept in a table of fixed size. Equal sets are one
   node from here on, so copies cost nothing further.
2. A second pass deals the first order's prefixes by token. Tokens met in one node only cannot make
   a candidate; the others go back to their nodes. Active are the nodes left with as many tokens as a
   partner of the smallest possible size must share.
3. Each token's smallest node is its hub. All candidates that share a token share its hub, so the
   hub's group (each node once, however many tokens it shares) holds every candidate pair. Only the
   shared tokens travel at first: a member stays if some other member of a fitting size shares enough of them.
4. A third pass emits the whole sets of the members that stay; a bitmap of fixed size over hashes of texts
   tells which texts to read. Groups are dealt into blocks by name and size; sets join them last.
5. First every node is in the group of its smallest hub; then those groups follow that hold nodes of
   different smallest hubs, for only they have pairs not yet seen.
6. Groups are verified in bounded blocks: first everything against the smallest member, then what it did
   not link against the whole group. A pair is verified if its prefixes share enough under all orders.
   Nodes that it links belong together already, so no pair between them is looked at and no
   pair is ever a row; only links that join parts come out.
7. Components of the links.

Token and node identities are 64-bit hashes; with n different items about n*n / 2**65 pairs collide.
The tables of fixed size only steer the order and what travels: a collision there costs time, never
a link. No bitmap holds tokens: a corpus shares more of them than any fixed size can tell apart, and
beyond a share of false ones every node would be active. A collision of texts sends one set more.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import staged
from .words import mix, shingle_set

LEVEL_BITS = 25
LEVEL_TOKENS = 1 << 22
MARK_BITS = 26
BLOCK_BYTES = 8 << 20
SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)


def least_shared(n: int, percent: int) -> int:
    """l(n): prefix tokens that a set of ``n`` tokens shares with a linked set of this or a larger size."""
    return 1 + (n - (percent * n + 99) // 100) // 4


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + least_shared(n, percent)


def ordered_prefix(tokens: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set (sorted array) under one order: by level, then by a seeded hash, then by token."""
    level = levels[(tokens >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)].astype(np.uint64)
    key = (level << np.uint64(58)) | (mix(tokens ^ np.uint64(SEEDS[order])) >> np.uint64(6))
    return tokens[np.argsort(key, kind="stable")[: prefix_length(len(tokens), percent)]]


def _node(tokens: np.ndarray) -> int:
    return int(mix(np.array([np.bitwise_xor.reduce(tokens) ^ np.sum(mix(tokens + np.uint64(1))) ^ np.uint64(len(tokens))], dtype=np.uint64)).view(np.int64)[0])


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def similar_components(docs: DataFrame, percent: int = 80, size: int = 5, orders: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text); other columns are ignored.

    Texts link when 100 * shared >= percent * united over their sets of word shingles. A null or
    blank text has no shingles and is its own component. A repeated doc_id gives a row per input row; a null
    doc_id takes part like any other and is never a component_id of a row that has an id beside it.
    """
    rows, active, levels = _prepared(docs, percent, size)
    return _components(rows, _links(docs, rows, active, levels, percent, size, orders))


def similar_links(docs: DataFrame, percent: int = 80, size: int = 5, orders: int = 3) -> DataFrame:
    """(a, b, copies_a, copies_b): every link between different sets of shingles, once, between the least doc_ids of the sets.

    ``copies`` counts the rows of a set, which link among themselves as well; a is null if no row of its set has an id, and so is b. All
    candidate pairs are verified, none is taken as implied, so the rows are as many as the links.
    """
    rows, active, levels = _prepared(docs, percent, size)
    nodes = _copies(rows)
    side = lambda x: nodes.select(F.col("node").alias(f"node_{x}"), F.col("least").alias(x), F.col("copies").alias(f"copies_{x}"))
    pairs = _links(docs, rows, active, levels, percent, size, orders, every=True).select(F.col("a").alias("node_a"), F.col("b").alias("node_b"))
    return pairs.join(side("a"), "node_a").join(side("b"), "node_b").select("a", "b", "copies_a", "copies_b")


def similar_link_counts(docs: DataFrame, percent: int = 80, size: int = 5, orders: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) per row of ``docs``: as ``similar_components``, with the number of other rows that a row links with.

    A row without shingles has no links.
    """
    rows, active, levels = _prepared(docs, percent, size)
    pairs = staged(_links(docs, rows, active, levels, percent, size, orders, every=True), "pairs", drop=True)
    nodes = _copies(rows)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("beside"))
    links = nodes.join(beside, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("beside", F.lit(0))).alias("links"))
    named = _components(rows, pairs, "node")
    return named.join(links, "node", "left").select("doc_id", "n_shingles", "component_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"))


def _prepared(docs: DataFrame, percent: int, size: int) -> tuple[DataFrame, DataFrame, bytes]:
    """Rows (doc_id, node, n, copy: a hash of the text), the active nodes and the frequency levels."""
    hashed = staged(_hashed(docs, size), "sets")
    levels = _levels(hashed.where("token is not null"))
    rows = hashed.where("token is null").select("doc_id", "node", "n", "copy")
    return rows, staged(_active(rows, _postings(docs, levels, percent, size), percent), "active", drop=True), levels


def _copies(rows: DataFrame) -> DataFrame:
    return rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))


def _components(rows: DataFrame, edges: DataFrame, *kept: str) -> DataFrame:
    """(doc_id, n_shingles, component_id and ``kept`` columns) per row."""
    labels = connected_components(edges)
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(labels, "node", "left")
    of_label = nodes.where("label is not null").groupBy("label").agg(F.min("least").alias("lowest"))
    named = nodes.join(of_label, "label", "left").select("node", F.coalesce("lowest", "least").alias("component"))
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), *kept)


def _hashed(docs: DataFrame, size: int) -> DataFrame:
    """Per document its node, its set size and a hash of its text; besides, per batch the tokens met in several of its nodes."""

    def run(batches):
        for batch in batches:
            nodes, counts, sets = [], [], {}
            for text in batch.column(1).to_pylist():
                tokens = shingle_set(text, size)
                node = _node(tokens) if len(tokens) else None
                nodes.append(node)
                counts.append(len(tokens))
                if node is not None:
                    sets.setdefault(node, tokens)
            n = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), batch.column(2), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                names=["doc_id", "node", "n", "copy", "token", "df"])
            if sets:
                tokens, df = np.unique(np.concatenate(list(sets.values())), return_counts=True)
                tokens, df = tokens[df > 1], df[df > 1]
                n = len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), _signed(tokens), pa.array(df.astype(np.int64))],
                    names=["doc_id", "node", "n", "copy", "token", "df"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("copy")).mapInArrow(run, "doc_id long, node long, n long, copy long, token long, df long")


def _levels(repeats: DataFrame) -> bytes:
    """Frequency levels (log2 of the count) by leading token bits; at most LEVEL_TOKENS tokens, the most frequent, get one."""
    counted = staged(repeats.groupBy("token").agg(F.log2(F.sum("df")).cast("int").alias("level")), "levels", drop=True)
    least, total = 64, 0
    for row in sorted(counted.groupBy("level").count().collect(), key=lambda r: -r["level"]):  # one row per level, 64 at most
        total += row["count"]
        if total > LEVEL_TOKENS:
            break
        least = row["level"]
    cell = F.shiftrightunsigned("token", 64 - LEVEL_BITS).cast("int")
    cells = counted.where(F.col("level") >= least).groupBy(cell.alias("cell")).agg(F.max("level").alias("level")).toArrow()
    table = np.zeros(1 << LEVEL_BITS, dtype=np.uint8)
    table[cells.column("cell").to_numpy()] = np.minimum(cells.column("level").to_numpy(), 60)
    return zstandard.compress(table.tobytes(), 1)


@lru_cache(maxsize=1)
def _table(levels: bytes) -> np.ndarray:
    """Unpacked once per worker, not once per group."""
    return np.frombuffer(zstandard.decompress(levels), dtype=np.uint8)


def _postings(docs: DataFrame, levels: bytes, percent: int, size: int) -> DataFrame:
    """(token, node) of every prefix under the first order, once per batch and node."""

    def run(batches):
        table = _table(levels)
        for batch in batches:
            seen, tokens, nodes = set(), [], []
            for text in batch.column(0).to_pylist():
                own = shingle_set(text, size)
                if len(own) and (node := _node(own)) not in seen:
                    seen.add(node)
                    tokens.append(ordered_prefix(own, table, 0, percent))
                    nodes.append(np.full(len(tokens[-1]), node, dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(tokens)), pa.array(np.concatenate(nodes))], names=["token", "node"])

    return docs.select("text").mapInArrow(run, "token long, node long")


def _shared(postings: DataFrame) -> DataFrame:
    """Tokens of two nodes or more, with the smallest node as hub."""
    return postings.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").select("token", "hub")


def _met_again(postings: DataFrame) -> DataFrame:
    """The postings of tokens met in several nodes. Tokens stream by in order, so one in very many nodes fills no memory."""

    def run(batches):
        held, several = np.zeros((2, 0), dtype=np.int64), False  # the last row, as its token may go on, and whether that token's rows have gone out
        for batch in batches:
            rows = np.concatenate([held, [batch.column(k).to_numpy() for k in range(2)]], axis=1)
            if rows.shape[1]:
                starts = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
                shared = np.minimum.reduceat(rows[1], starts) < np.maximum.reduceat(rows[1], starts)
                shared[0] |= several
                keep = np.repeat(shared, np.diff(starts, append=rows.shape[1]))
                keep[0] &= not several
                held, several = rows[:, -1:], bool(shared[-1])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:, keep]], names=["token", "node"])

    return postings.repartition("token").sortWithinPartitions("token").mapInArrow(run, "token long, node long")


def _active(rows: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """(node, n, shared): nodes that share enough tokens of their first prefix, with those and the size of the set."""
    sizes = rows.where("node is not null").groupBy("node").agg(F.first("n").alias("n"))
    shared = _met_again(postings).groupBy("node").agg(F.collect_set("token").alias("shared"))
    up = lambda n: F.expr(f"({percent} * {n} + 99) div 100")
    return (shared.join(sizes, "node").withColumn("smallest", up("n"))
            .where(F.size("shared") >= 1 + F.floor((F.col("smallest") - up("smallest")) / 4)).select("node", "n", "shared"))


def _marks(copies: DataFrame) -> bytes:
    """A bitmap over the leading bits of (copy): 2**MARK_BITS bits whatever the input."""
    place = F.shiftrightunsigned("copy", 64 - MARK_BITS)
    words = (copies
             .select(F.shiftright(place, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(copy, {64 - MARK_BITS}) & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    table = np.zeros(1 << (MARK_BITS - 6), dtype=np.int64)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return table.tobytes()


def _whole(docs: DataFrame, rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, tokens): the whole sets of ``nodes``. Of a node's texts the one of the smallest hash is read again; other texts pass unread."""
    marks = _marks(rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("copy").alias("copy")))

    def run(batches):
        bits = np.frombuffer(marks, dtype=np.uint64)
        for batch in batches:
            place = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)
            marked = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
            found, held = {}, 0
            for k in np.flatnonzero(marked):
                own = shingle_set(batch.column(0)[k].as_py(), size)
                if len(own) and (node := _node(own)) not in found:
                    found[node] = own.tobytes()
                    held += len(found[node])
                    if held >= BLOCK_BYTES:
                        yield _sets_record(found)
                        found, held = {}, 0
            yield _sets_record(found)

    whole = docs.select("text", F.xxhash64("text").alias("copy")).mapInArrow(run, "node long, tokens binary")
    # One row per node: copies in several batches repeat it.
    return whole.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def _sets_record(sets: dict[int, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sets.keys(), pa.int64()), pa.array(sets.values(), pa.binary())], names=["node", "tokens"])


def _links(docs: DataFrame, rows: DataFrame, active: DataFrame, levels: bytes, percent: int, size: int, orders: int, every: bool = False) -> DataFrame:
    """(a, b) links that join all nodes which any chain of links joins; with ``every`` all links, each once and a < b."""
    postings = active.select(F.explode("shared").alias("token"), "node")
    members = staged(postings.join(_shared(postings), "token").select("hub", "node").distinct(), "groups", drop=True)
    members = staged(_with_partner(members, active, percent), "partners", drop=True)
    sets = staged(_whole(docs, rows, members.select("node").distinct(), size), "whole", drop=True)
    if every:
        return _all_pairs(members, sets, levels, percent, orders).distinct()
    # A node of a dense group has many hubs. Its smallest comes first; then only groups of nodes with different smallest hubs are left.
    smallest = staged(members.groupBy("node").agg(F.min("hub").alias("smallest"), F.first("n").alias("n")), "smallest", drop=True)
    first = _resolved(smallest.select(F.col("smallest").alias("hub"), "node", "n"), sets, levels, percent, orders)
    mixed = members.join(smallest.select("node", "smallest"), "node").groupBy("hub").agg(F.min("smallest").alias("low"), F.max("smallest").alias("high")).where("low < high").select("hub")
    return first.unionByName(_resolved(members.join(mixed, "hub"), sets, levels, percent, orders))


def _resolved(groups: DataFrame, sets: DataFrame, levels: bytes, percent: int, orders: int) -> DataFrame:
    """Links (a, b) that join what the pairs within groups (hub, node, n) join, found in blocks of bounded size."""
    groups = staged(groups.select("hub", "node", "n"), "members", drop=True)
    blocks = groups.groupBy("hub").agg(F.min("node").alias("lead"), _blocks().alias("blocks"))
    part = lambda by: F.pmod(F.xxhash64("node"), F.col(by)).cast("int")
    grouped = groups.join(blocks, "hub")
    leads = grouped.where("node = lead").select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("turn"), F.lit(True).alias("asks"), "node")
    rest = grouped.where("node <> lead").select("hub", part("blocks").alias("block"), F.lit(0).alias("turn"), F.lit(False).alias("asks"), "node")
    first = staged(_verified(leads.unionByName(rest).join(sets, "node"), levels, percent, orders), "lead-links", drop=True)
    # What the lead of its group does not link asks the whole group.
    linked = first.select(F.col("a").alias("lead"), F.col("b").alias("node")).distinct()
    asking = grouped.where("node <> lead").join(linked, ["lead", "node"], "left_anti")
    turns = asking.groupBy("hub").agg(_blocks().alias("turns"))
    asks = asking.join(turns, "hub").select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part("turns").alias("turn"), F.lit(True).alias("asks"), "node")
    asked = grouped.where("node <> lead").join(turns, "hub").select(
        "hub", part("blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(False).alias("asks"), "node")
    return first.unionByName(_verified(asks.unionByName(asked).join(sets, "node"), levels, percent, orders))


def _all_pairs(groups: DataFrame, sets: DataFrame, levels: bytes, percent: int, orders: int) -> DataFrame:
    """Every link a < b within groups (hub, node, n), each part of a group against each part; a pair of several groups comes from each of them."""
    blocks = groups.groupBy("hub").agg(_blocks().alias("blocks"))
    part, each = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = groups.join(blocks, "hub")
    asks = grouped.select("hub", each.alias("block"), part.alias("turn"), F.lit(True).alias("asks"), "node")
    answers = grouped.select("hub", part.alias("block"), each.alias("turn"), F.lit(False).alias("asks"), "node")
    return _verified(asks.unionByName(answers).join(sets, "node"), levels, percent, orders, every=True)


def _blocks():
    """How many blocks the sets of a group fill: eight bytes a token."""
    return F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES).cast("int")


def _with_partner(members: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """The members (hub, node, n) that may have a partner in their group, judged by the shared tokens of their prefixes.

    The hub stays if any member does. A group beyond one block is passed on whole: its pairs are checked in blocks later.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(s, dtype=np.int64) for s in frame["shared"]]
        sizes = frame["n"].to_numpy().astype(np.int64)
        least = np.array([least_shared(int(n), percent) for n in sizes])
        index, keep = _Index(sets), np.zeros(len(sets), dtype=bool)
        for k, tokens in enumerate(sets):
            if not keep[k]:
                fits = (index.shared(tokens) >= np.minimum(least, least[k])) & (100 * sizes >= percent * sizes[k]) & (percent * sizes <= 100 * sizes[k])
                fits[k] = False
                if fits.any():
                    keep |= fits
                    keep[k] = True
        if keep.any():
            keep |= frame["node"].to_numpy() == frame["hub"].to_numpy()
        return frame.loc[keep, ["hub", "node", "n"]]

    filled = members.join(active, "node")
    large = members.join(active.select("node", F.size("shared").alias("tokens")), "node").groupBy("hub").agg(
        (F.sum("tokens") * 8 > BLOCK_BYTES).alias("large"))
    sized = filled.join(large, "hub")
    return sized.where("not large").groupBy("hub").applyInPandas(run, "hub long, node long, n long").unionByName(sized.where("large").select("hub", "node", "n"))


def _verified(rows: DataFrame, levels: bytes, percent: int, orders: int, every: bool = False) -> DataFrame:
    """Links (a asks, b answers) inside each block, without those that an earlier link of the block implies; with ``every`` all with a < b."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        table = _table(levels)
        asks = frame["asks"].to_numpy()
        nodes, sets = frame["node"].to_numpy(), [np.frombuffer(t, dtype=np.uint64) for t in frame["tokens"]]
        found = linked_pairs([s for s, a in zip(sets, asks) if a], [s for s, a in zip(sets, asks) if not a], table, percent, orders)
        first, second = nodes[asks], nodes[~asks]
        if every:
            return pd.DataFrame([(int(first[q]), int(b)) for q, answers in found for b in second[answers] if first[q] < b], columns=["a", "b"], dtype="int64")
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for q, answers in found:
            for b in second[answers]:
                x, y = root(int(first[q])), root(int(b))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((int(first[q]), int(b)))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("hub", "block", "turn").applyInPandas(run, "a long, b long")


class _Index:
    """Which of several sets hold a token."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owners, self.sets = tokens[order], owners[order], len(sets)

    def shared(self, tokens: np.ndarray) -> np.ndarray:
        """For each set, how many of ``tokens`` it holds."""
        start, end = np.searchsorted(self.tokens, tokens, "left"), np.searchsorted(self.tokens, tokens, "right")
        size = end - start
        at = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        return np.bincount(self.owners[at], minlength=self.sets)


def linked_pairs(asking, answering, levels: np.ndarray, percent: int, orders: int):
    """(index of an asking set, indices of the answering sets linked with it), exact."""
    lengths = np.array([len(s) for s in answering], dtype=np.int64)
    least = np.array([least_shared(n, percent) for n in lengths], dtype=np.int64)
    prefixes = [_Index([ordered_prefix(s, levels, k, percent) for s in answering]) for k in range(orders)]
    whole = _Index(answering)
    for q, tokens in enumerate(asking):
        n = len(tokens)
        near = (100 * lengths >= percent * n) & (percent * lengths <= 100 * n)
        for k in range(orders):
            if near.any():
                near &= prefixes[k].shared(ordered_prefix(tokens, levels, k, percent)) >= np.minimum(least, least_shared(n, percent))
        if near.any():
            both = whole.shared(tokens)
            hits = np.flatnonzero(near & (100 * both >= percent * (n + lengths - both)))
            if len(hits):
                yield q, hits
