"""Secret scans in DataFrame functions: fixed shapes, and a randomness battery over long tokens.

Fixed shapes are assignments to a secret's name, access key ids and long hexadecimal runs. Besides,
every run of 20 or more characters of the base64 alphabets is a candidate. Its encoding is inferred
from its characters; its symbols are then tested against two hypotheses:

* it is random: a chi-squared test of uniformity over the alphabet, a runs test about the alphabet's
  middle and a test of the serial correlation at lag one, their p-values joined by Fisher's rule;
* it is text: its classes of symbols (small and capital letters, digits, separators) follow each other as in ordinary names,
  numbers and paths, and its letters are as frequent as in European languages. The likelihood ratio r of uniform symbols
  against text gives the p-value 10 / r: text reaches a ratio of r with probability 1 / r at most, whatever the encoding and the
  length, for each of two styles of letters and five alphabets.

A candidate is reported if randomness is not refused and text is, the latter at a false discovery
rate controlled within each class of length (Benjamini-Hochberg over the distinct candidates of the class outside the fixed
shapes), so that the many short candidates cannot hide the long ones nor borrow their evidence, and copies of a document
or secrets that are known by their shape count for nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import staged

ASSIGN = r"""(?=[PpSsTtAa])(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

#: The alphabet of each inferred encoding.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
}
#: All symbols of a token, and per mille how frequent each is within its class in text.
SYMBOLS = ENCODINGS["base64"] + "="
LETTERS = (80, 17, 33, 42, 140, 18, 21, 42, 73, 4, 10, 44, 27, 78, 60, 24, 5, 68, 67, 73, 42, 12, 14, 4, 10, 10)
SEPARATORS = (50, 300, 300, 300, 50)
#: Chances that a class follows another in text: per row the start, a small letter, a capital, a digit, a separator before it.
FOLLOWS = (
    (0.60, 0.25, 0.10, 0.05),
    (0.88, 0.03, 0.03, 0.06),
    (0.80, 0.12, 0.04, 0.04),
    (0.08, 0.04, 0.76, 0.12),
    (0.55, 0.15, 0.20, 0.10),
)
#: Two styles, five alphabets (hexadecimal digits in either case).
CHOICES = 10


def pieces(text: Column, pattern: str) -> Column:
    """array<struct<gap, match>>: each match, after ``gap`` characters since the match before it (or the start)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<gap:int,match:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), F.zip_with(
        F.slice(F.transform(gaps, F.length), F.lit(1), F.size(gaps) - 1), found,
        lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))).otherwise(none)


def has_match(text: Column) -> Column:
    """Whether ``scanned`` finds anything in a text: access keys and hexadecimal runs lie inside tokens."""
    text = F.coalesce(text, F.lit(""))
    return ((F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & F.regexp_like(text, F.lit(ASSIGN))) | F.regexp_like(text, F.lit(TOKEN))


def scanned(docs: DataFrame, carry: Column) -> DataFrame:
    """One scan: (rid, row, pieces of every kind), written so that rid stays what it is."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<gap:int,match:string>>")
    base = docs.select(carry.alias("row"), text.alias("text"))
    table = base.select(
        F.monotonically_increasing_id().alias("rid"), "row",
        F.when(F.contains("text", F.lit(":")) | F.contains("text", F.lit("=")), pieces(F.col("text"), ASSIGN)).otherwise(none).alias("assign"),
        # Access keys and hexadecimal runs lie inside tokens, so a text without a token has neither.
        *[F.when(F.regexp_like("text", F.lit(TOKEN)), pieces(F.col("text"), p)).otherwise(none).alias(k)
          for k, p in (("access", ACCESS), ("hex", HEX), ("random", TOKEN))])
    return staged(table, "scanned")


def placed(table: DataFrame) -> DataFrame:
    """(rid, kind, start, end, match): positions in code points, end exclusive."""
    rows = table.select("rid", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in KINDS])).alias("x")).select(
        "rid", "x.kind", F.posexplode("x.found").alias("at", "piece"))
    before = Window.partitionBy("rid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("piece.match").cast("long")
    end = F.sum(F.col("piece.gap") + size).over(before)
    return rows.select("rid", "kind", (end - size).alias("start"), end.alias("end"), F.col("piece.match").alias("match"))


LEAST_P = 1e-60


def normal_tail(z: Column) -> Column:
    """P(Z <= z) of a standard normal Z, within 2e-4 (logistic with a cubic term)."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def text_likelihood(body: Column) -> Column:
    """Logarithm of the likelihood of each string as text: the better of two styles, small letters with capitals between them or the reverse."""
    total = sum(LETTERS)
    letters = [math.log(0.9 * x / total + 0.1 / 26) for x in LETTERS]
    logs = F.array(*[F.lit(x) for x in letters * 2 + [math.log(0.1)] * 10 + [math.log(x / sum(SEPARATORS)) for x in SEPARATORS]])
    follows = F.array(*[F.lit(math.log(x)) for row in FOLLOWS for x in row])
    at = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.call_function("locate", c, F.lit(SYMBOLS)) - 1)

    def style(first: int, second: int) -> Column:
        classes = F.transform(at, lambda i: F.when(i < 26, second).when(i < 52, first).when(i < 62, 3).otherwise(4))
        return F.aggregate(classes, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last")), lambda s, k: F.struct(
            (s["sum"] + F.get(follows, s["last"] * 4 + k - 1)).alias("sum"), k.alias("last")))["sum"]

    return F.aggregate(at, F.lit(0.0), lambda s, i: s + F.get(logs, i)) + F.greatest(style(1, 2), style(2, 1))


def battery(tokens: DataFrame) -> DataFrame:
    """Adds encoding, n, p_random and p_text to rows with ``match``."""
    coded = tokens.withColumn("body", F.regexp_replace("match", "=+$", "")).withColumn(
        "encoding", F.when(F.regexp_like("body", F.lit("^([0-9a-f]+|[0-9A-F]+)$")), "hex")
        .when(F.regexp_like("body", F.lit("^[A-Z2-7]+$")), "base32").when(F.regexp_like("body", F.lit("^[A-Za-z0-9]+$")), "base62").otherwise("base64"))

    def by(values) -> Column:
        out = F.lit(values["base64"])
        for name in ("base62", "base32", "hex"):
            out = F.when(F.col("encoding") == name, F.lit(values[name])).otherwise(out)
        return out

    body = F.when(F.col("encoding") == "hex", F.lower("body")).otherwise(F.col("body"))
    coded = coded.select(
        *tokens.columns, "encoding", by({k: float(len(v)) for k, v in ENCODINGS.items()}).alias("a"),
        text_likelihood(F.col("body")).alias("as_text"), by(ENCODINGS).alias("alphabet"), body.alias("body")).withColumn(
        "codes", F.expr("transform(filter(split(body, ''), c -> c <> ''), c -> cast(locate(c, alphabet) - 1 as double))")).drop("alphabet", "body")
    number = lambda x: F.coalesce(x, F.lit(0.0))
    total = lambda items, f: F.aggregate(items, F.lit(0.0), lambda s, x: s + f(x))
    counts = F.expr("transform(array_distinct(codes), a -> cast(size(filter(codes, x -> x = a)) as double))")
    moments = coded.withColumn("n", F.size("codes").cast("double")).withColumn("counts", counts).withColumn(
        "mean", number(F.try_divide(total(F.col("codes"), lambda x: x), F.col("n")))).select(
        *tokens.columns, "encoding", "a", "as_text", "n",
        total(F.col("counts"), lambda c: c * c).alias("squares"),
        F.expr("aggregate(sequence(1, greatest(1, size(codes) - 1)), 1D, (s, i) -> s + if((get(codes, i) >= a / 2) <> (get(codes, i - 1) >= a / 2), 1D, 0D))").alias("runs"),
        F.expr("cast(size(filter(codes, x -> x >= a / 2)) as double)").alias("high"),
        F.expr("aggregate(codes, 0D, (s, x) -> s + (x - mean) * (x - mean))").alias("spread"),
        F.expr("aggregate(sequence(1, greatest(1, size(codes) - 1)), 0D, (s, i) -> s + coalesce((get(codes, i) - mean) * (get(codes, i - 1) - mean), 0D))").alias("lagged"))
    n, a = F.col("n"), F.col("a")
    chi = a * F.col("squares") / n - n
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / (a - 1), F.lit(1 / 3)) - (1 - 2 / (9 * (a - 1)))) / F.sqrt(2 / (9 * (a - 1)))
    both = 2 * F.col("high") * (n - F.col("high"))
    z_runs = number(F.try_divide(F.col("runs") - both / n - 1, F.sqrt(both * (both - n) / (n * n * (n - 1)))))
    z_lag = number(F.try_divide(F.col("lagged"), F.col("spread"))) * F.sqrt(n)
    low = lambda p: F.greatest(p, F.lit(1e-12))
    half = -(F.log(low(1 - normal_tail(z_chi))) + F.log(low(2 * normal_tail(-F.abs(z_runs)))) + F.log(low(2 * normal_tail(-F.abs(z_lag)))))
    # As base64 a token may hold = besides.
    as_random = -n * F.log(F.when(F.col("encoding") == "base64", F.lit(float(len(SYMBOLS)))).otherwise(a))
    p_text = F.least(F.lit(1.0), F.exp(F.greatest(F.lit(math.log(LEAST_P)), math.log(CHOICES) + F.col("as_text") - as_random)))
    usable = (n >= 8) & (F.col("high") > 0) & (F.col("high") < n)
    return moments.select(
        *tokens.columns, "encoding", n.cast("long").alias("n"),
        F.when(usable, F.exp(-half) * (1 + half + half * half / 2)).otherwise(0.0).alias("p_random"),
        F.when(usable, p_text).otherwise(1.0).alias("p_text"))


GRID = 40


def discoveries(tested: DataFrame, rate: float, level: float) -> DataFrame:
    """Rows of ``tested`` that are not refused as random and are discovered as no text.

    p-values are rounded up to a grid of ``GRID`` steps per factor of ten, so the step-up rule needs a small histogram per length class
    (the integer part of log2 n), not a ranking of all candidates.
    """
    graded = tested.withColumn("class", F.floor(F.log2("n"))).withColumn("step", F.floor(-F.log10(F.greatest("p_text", F.lit(LEAST_P))) * GRID).cast("int"))
    counted = graded.groupBy("class", "step").agg(F.count("*").alias("m"))
    up = Window.partitionBy("class").orderBy(F.desc("step"))
    limits = counted.select(
        "class", "step", F.sum("m").over(up).alias("rank"), F.sum("m").over(Window.partitionBy("class")).alias("all")).where(
        F.pow(F.lit(10.0), -F.col("step") / GRID) * F.col("all") <= rate * F.col("rank")).groupBy("class").agg(F.min("step").alias("least"))
    return graded.join(limits, "class").where((F.col("step") >= F.col("least")) & (F.col("p_random") > level)).select(*tested.columns)


def secret_spans(table: DataFrame, rate: float = 0.01, level: float = 0.001) -> DataFrame:
    """(rid, kind, start, end) of every span of the table of ``scanned``.

    Base matches that fail their condition are dropped; a candidate that overlaps a base span adds nothing and is dropped before the tests.
    Each distinct candidate is tested once, and all its occurrences share the verdict.
    """
    found = staged(placed(table), "matches")
    kept = found.where((F.col("kind") != "random") & (
        (F.col("kind") != "assign") | (F.length(F.regexp_extract("match", ASSIGN, 2)) >= 6)))
    base = kept.select("rid", "kind", "start", "end")
    per_row = base.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    free = staged(found.where("kind = 'random'").join(per_row, "rid", "left").where(~F.coalesce(
        F.exists("taken", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"])), F.lit(False))).drop("taken"), "candidates")
    tested = staged(battery(free.select("match").distinct()), "tested")
    random = free.join(discoveries(tested, rate, level).select("match"), "match", "left_semi").select("rid", "kind", "start", "end")
    return base.unionByName(random)


def span_digest(spans: DataFrame) -> DataFrame:
    """(rid, n_assign, n_access, n_hex, n_random, base_sha256, spans) per rid."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    name = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    listed = spans.groupBy("rid").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), name.alias("name")))).alias("all"))
    joined = lambda items: F.array_join(F.transform(items, lambda s: s["name"]), ",")
    return listed.select(
        "rid", *[f"n_{k}" for k in KINDS],
        F.sha2(joined(F.filter("all", lambda s: s["rank"] <= len(BASE_KINDS))), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def find_secrets(docs: DataFrame, carry: Column, rate: float = 0.01, level: float = 0.001) -> DataFrame:
    """(row, n_assign, n_access, n_hex, n_random, base_sha256, spans) per row of ``docs`` (text).

    ``carry`` is kept as ``row``; other columns are ignored. A null text is empty and has no spans. Repeated rows give
    repeated results. Candidates of several encodings share the length classes.
    """
    table = scanned(docs, carry)
    digest = span_digest(secret_spans(table, rate, level))
    empty = F.sha2(F.lit(""), 256)
    return table.select("rid", "row").join(digest, "rid", "left").select(
        "row", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.coalesce("base_sha256", empty).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact_secrets(docs: DataFrame, columns: tuple[str, ...], mask: str = "[SECRET]", rate: float = 0.01, level: float = 0.001) -> DataFrame:
    """``columns`` of ``docs`` with every secret span of ``text`` replaced by ``mask``; n_chars, if among them, is counted anew for changed texts.

    Every row stays. Overlapping spans are masked as one. A null text stays null.
    """
    # Spans are keyed by doc_id and a hash of the text, so that no text is written besides the result.
    table = scanned(docs, F.struct("doc_id", F.xxhash64("text").alias("hash")))
    spans = secret_spans(table, rate, level)
    order = Window.partitionBy("rid").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.when(F.coalesce(F.col("start") >= reach, F.lit(True)), 1).otherwise(0))
    merged = opened.withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).groupBy("rid", "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    masks = merged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("masks"))
    # Repeated rows share their masks.
    keyed = table.select("rid", "row").join(masks, "rid").groupBy(F.col("row.doc_id").alias("key_id"), F.col("row.hash").alias("key_hash")).agg(F.first("masks").alias("masks"))
    # Only rows with a match of any kind take part in the join; the others pass as they are.
    touched = docs.where(has_match(F.col("text"))).select(F.struct(*columns).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    joined = touched.join(keyed, F.col("own_id").eqNullSafe(F.col("key_id")) & (F.col("own_hash") == F.col("key_hash")), "left").withColumn(
        "at", F.coalesce("masks", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    rebuilt = F.expr(
        "concat(array_join(transform(at, (s, i) -> concat(substring(row.text, cast(coalesce(get(at, i - 1).end, 0) + 1 as int), "
        "cast(s.start - coalesce(get(at, i - 1).end, 0) as int)), mask)), ''), substring(row.text, cast(coalesce(get(at, size(at) - 1).end, 0) + 1 as int)))")
    changed = joined.withColumn("mask", F.lit(mask)).withColumn("new", F.when(F.size("at") > 0, rebuilt).otherwise(F.col("row.text")))
    out = []
    for name in columns:
        value = F.col(f"row.{name}")
        if name == "text":
            value = F.col("new")
        elif name == "n_chars":
            value = F.when(F.size("at") > 0, F.length("new").cast("long")).otherwise(value)
        out.append(value.alias(name))
    return changed.select(*out).unionByName(docs.where(~has_match(F.col("text"))).select(*columns))
