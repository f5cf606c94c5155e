"""One query per operator, over whole tables; SQL beside those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .storage import documents, labels  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from .jaccard_join import similar_components

    return similar_components(documents(spark, folder), percent=80, size=5, orders=3)


# Every pair that shares a shingle is counted, then components by repeated minima.
ORACLES["op10_ngram_jaccard_join"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams
  FROM split
), tokens AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM tokens a JOIN tokens b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (doc_id)
"""


@query
def op6_decision_lists(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .decision_lists import quality_verdicts

    verdicts, _ = quality_verdicts(documents(spark, folder), labels(spark, folder), F.struct("doc_id"))
    return verdicts.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .secret_scan import find_secrets

    return find_secrets(documents(spark, folder), F.struct("doc_id"), rate=0.01, level=0.001).select(
        "row.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


#: Target parts of the mix: the rest of the sources have MIX_DEFAULT parts each.
MIX_PARTS = {"src0": 6, "src1": 3, "src2": 3}
MIX_DEFAULT = 2
MIX_BLOCK = 65_536


@query
def op2_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .mixing import mixed

    placed, _ = mixed(documents(spark, folder), F.struct("doc_id"), MIX_PARTS, MIX_DEFAULT, MIX_BLOCK)
    return placed.select("row.doc_id", "source", "block", "slot", "release", "deadline")


# The schedule is played slot by slot: among the released blocks not yet served, the earliest deadline. Sources
# without a weight of their own are one stream, whose blocks they take in turns.
ORACLES["op2_pfair_mixing"] = r"""
WITH RECURSIVE sources AS (
  SELECT source, CASE source WHEN 'src0' THEN 6 WHEN 'src1' THEN 3 WHEN 'src2' THEN 3 END AS own FROM (SELECT DISTINCT source FROM documents)
), equals AS (
  SELECT source, row_number() OVER (ORDER BY md5(coalesce('=' || source, '')), source) - 1 AS place, count(*) OVER () AS m FROM sources WHERE own IS NULL
), streams AS (
  SELECT source AS name, own AS k, 0 AS last FROM sources WHERE own IS NOT NULL
  UNION ALL SELECT NULL, 2 * count(*), 1 FROM equals HAVING count(*) > 0
), total AS (SELECT CAST(sum(k) AS BIGINT) AS q FROM streams),
jobs AS (
  SELECT name, last, j, j * q // k AS release, ((j + 1) * q + k - 1) // k AS deadline
  FROM (SELECT name, k, last, unnest(range(k)) AS j FROM streams), total
), ranked AS (SELECT *, row_number() OVER (ORDER BY deadline, last, name, j) AS id FROM jobs),
play(slot, served) AS (
  SELECT CAST(-1 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT slot + 1, list_append(served, (SELECT min(id) FROM ranked WHERE release <= slot + 1 AND NOT list_contains(served, id)))
  FROM play WHERE slot + 1 < (SELECT q FROM total)
), served AS (SELECT p.slot, r.name, r.j FROM play p JOIN ranked r ON r.id = p.served[len(p.served)] WHERE p.slot >= 0),
begun AS (
  SELECT doc_id, source, coalesce(sum(length(coalesce(text, ''))) OVER (
    PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), md5(coalesce(text, '')) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM documents
), blocks AS (
  SELECT d.doc_id, d.source, CAST(d.before // 65536 AS BIGINT) AS block, s.own, coalesce(s.own, 2) AS k, e.place, e.m
  FROM begun d JOIN sources s ON s.source IS NOT DISTINCT FROM d.source
  LEFT JOIN equals e ON e.source IS NOT DISTINCT FROM d.source AND s.own IS NULL
), nth AS (
  SELECT *, CASE WHEN own IS NULL THEN block * m + place ELSE block END AS n, CASE WHEN own IS NULL THEN 2 * m ELSE own END AS cycle,
    CASE WHEN own IS NOT NULL THEN source END AS stream FROM blocks
)
SELECT n.doc_id, n.source, n.block, CAST(n.n // n.cycle * q + s.slot AS BIGINT) AS slot,
  CAST(n.block * q // n.k AS BIGINT) AS release, CAST(((n.block + 1) * q + n.k - 1) // n.k AS BIGINT) AS deadline
FROM nth n JOIN served s ON s.name IS NOT DISTINCT FROM n.stream AND s.j = n.n % n.cycle, total
"""


@query
def op4_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    from .bitplanes import read_digests, write_blocks
    from .tokens import vocabulary

    return read_digests(write_blocks(documents(spark, folder), vocabulary("word_bpe_49k.json"), end_id=2))


@query
def op8_hierarchical_packing(spark: SparkSession, folder: str) -> DataFrame:
    from .packing import packed
    from .tokens import vocabulary

    return packed(documents(spark, folder), vocabulary("byte_bpe_50k.json"), end_id=0)


@query
def op7_bottom_k_sketch(spark: SparkSession, folder: str) -> DataFrame:
    from .bottom_k import fingerprints

    return fingerprints(documents(spark, folder), k=128, size=5)


@query
def op1_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    from .lm_scoring import cross_entropy_difference

    return cross_entropy_difference(documents(spark, folder), labels(spark, folder).where("quality = 1").select("doc_id"))


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(documents(spark, folder), labels(spark, folder))


@query
def op5_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    from .pii import personal_data

    return personal_data(documents(spark, folder))


@query
def op12_filter_interaction(spark: SparkSession, folder: str) -> DataFrame:
    from .filter_interaction import filter_audit, text_failures

    return filter_audit(text_failures(documents(spark, folder), labels(spark, folder)), "part", "ABCDE", {"good_lost": "good", "toxic_lost": "toxic"})


# Every order is played over the sets of failed filters; the Shapley sums are sums over the orders.
ORACLES["op12_filter_interaction"] = r"""
WITH marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), failed AS (
  SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts LEFT JOIN marks USING (doc_id)
), sets AS (
  SELECT part, concat(if(a, 'A', ''), if(b, 'B', ''), if(c, 'C', ''), if(d, 'D', ''), if(e, 'E', '')) AS fails,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT concat(p.x, q.x, r.x, s.x, t.x) AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), played AS (
  SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS hit, fails = letter AS alone,
    len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AND earlier <> '' AND fails <> '' AS gone
  FROM sets, steps
), counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
  FROM played GROUP BY ALL
)
SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted
"""


@query
def op13_ball_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .ball_tree import top_inner_products

    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return top_inner_products(vectors, F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)), k=10)


# Every query against every other row.
ORACLES["op13_ball_tree_search"] = r"""
WITH whole AS (
  SELECT row_number() OVER () AS line, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.line, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.line <> c.line AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    from .source_divergence import divergence_audit

    return divergence_audit(documents(spark, folder), least_docs=10, top=10)


# Terms straight from the texts, shares of every group for every kept term.
ORACLES["op11_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS line, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), found AS (SELECT line, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY ALL HAVING count(DISTINCT line) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (s.n + 2 * s.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), results AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM results
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
