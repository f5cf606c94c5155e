"""Quality rules as a learned decision list, in DataFrame functions only.

Every text gets counts and shares (one scan, no shuffle). A list of rules is learned by sequential
covering from labelled rows: each rule is a conjunction of thresholds on the shares, grown on two
thirds of the rows by gain in information and pruned on the last third; rows that a rule covers are
set aside before the next rule is grown. The result is an ordered Spark CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import staged

BLANKS = " \t\n\u000b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 8

#: Shares that rules may test, each from counts of one text; all lie in 0..1 but the mean word length.
SHARES = ("symbol_share", "mark_share", "upper_share", "digit_share", "repeat_share", "distinct_share", "dup_line_share", "mean_word")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text: an empty array for a null or blank one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur at least twice in the text, the first occurrence included."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(found: Column) -> Column:
        ranked = F.sort_array(F.arrays_zip(found.alias("hash"), F.sequence(F.lit(0), F.size(found) - 1).alias("at")))
        return let(ranked, lambda z: let(F.sort_array(F.transform(
            F.filter(z, lambda x, i: F.coalesce(x["hash"] == F.get(z, i - 1)["hash"], F.lit(False)) | F.coalesce(x["hash"] == F.get(z, i + 1)["hash"], F.lit(False))),
            lambda x: x["at"])), spread))

    def spread(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - p, F.lit(window)))),
            F.lit(0).cast("long"), lambda total, step: total + step)

    def repeats(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(covered(found))

    return F.when(n <= window, F.lit(0).cast("long")).otherwise(let(hashes, repeats))


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def text_statistics(docs: DataFrame, carry: Column) -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the shares) per row of ``docs``; ``carry`` becomes ``row``."""
    base = docs.select(carry.alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    base = base.withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counted = base.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _removed(F.col("text"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        _removed(F.col("text"), "[.,;:!?\"'()\\[\\]-]").cast("long").alias("n_marks"),
        _removed(F.col("text"), "[0-9]").cast("long").alias("n_digits"),
        _removed(F.col("text"), "\\p{Lu}").cast("long").alias("n_upper"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        let(lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))
    return counted.select(
        "row", "n_words", "word_chars", "n_symbols", F.col("lines.dup").cast("long").alias("n_dup_lines"), "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_share"), share("n_marks", "word_chars").alias("mark_share"),
        share("n_upper", "word_chars").alias("upper_share"), share("n_digits", "word_chars").alias("digit_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("n_distinct", "n_words").alias("distinct_share"),
        share("lines.dup", "lines.all").alias("dup_line_share"), share("word_chars", "n_words").alias("mean_word"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Literal:
    share: str
    at_least: bool
    cut: float

    def holds(self) -> Column:
        return F.col(self.share) >= self.cut if self.at_least else F.col(self.share) < self.cut

    def __str__(self) -> str:
        return f"{self.share} {'>=' if self.at_least else '<'} {self.cut:.6g}"


Rule = tuple[Literal, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.holds()
    return out


def any_rule(rules: list[Rule]) -> Column:
    """The list as an ordered CASE: the first rule that holds rejects; without one the text stays."""
    out = None
    for rule in rules:
        out = F.when(_all(rule), F.lit(True)) if out is None else out.when(_all(rule), F.lit(True))
    return F.lit(False) if out is None else out.otherwise(F.lit(False))


def _turn(key: str) -> Column:
    """The order in which labelled rows are taken for learning."""
    return F.xxhash64(F.lit("turn"), key)


def cuts_reached(cuts: list[float], x: Column) -> Column:
    """How many of the ascending ``cuts`` are at most ``x``, by bisection of one constant: a plan of a condition per cut costs the driver memory."""
    if not cuts:
        return F.lit(0)
    constants = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    return F.reduce(F.array(*[F.lit(k) for k in steps]), F.lit(0), lambda low, step: F.when(
        F.get(constants, low + step - 1) <= x, low + step).otherwise(low))


def learn_rules(rows: DataFrame, max_rows: int = 50_000, cuts: int = 48, max_rules: int = 12, max_literals: int = 4,
                precision: float = 0.95, support: int = 5, tries: int = 2) -> list[Rule]:
    """Rules that find ``bad`` rows (0/1) of ``rows`` (key, bad and SHARES).

    Learns from at most ``max_rows`` labelled rows, those of the smallest key hash; nothing else is
    bounded. Candidate thresholds are ``cuts`` quantiles of each share among bad rows and among good
    ones. A rule is kept if at least ``precision`` of the pruning rows it covers are bad and at
    least ``support`` growing rows are. After one that fails there no rule begins with its first literal or a looser one of that share and
    direction, nor with that share and direction at all once ``tries`` rules have failed so. No labelled rows or no bad row give an empty list. Ties go to the first share and the lowest threshold.
    """
    marked = rows.where("bad is not null").withColumn("turn", _turn("key"))
    sample = staged(marked.orderBy("turn").limit(max_rows).select(
        *SHARES, F.col("bad").cast("int").alias("bad"), (F.pmod("turn", F.lit(3)) == 0).alias("prune")), "labelled")
    values = {}
    for part in (sample.where("bad = 1"), sample.where("bad = 0")):
        for share, found in zip(SHARES, part.approxQuantile(list(SHARES), [(k + 0.5) / cuts for k in range(cuts)], 0.002)):
            values.setdefault(share, set()).update(found)
    # Midway between neighbouring values, so that a rule's edge is not a training row's own value.
    cut_points = {s: [(a + b) / 2 for a, b in zip(sorted(v), sorted(v)[1:])] for s, v in values.items()}
    binned = staged(sample.withColumn("bins", F.array(*[cuts_reached(cut_points[s], F.col(s)) for s in SHARES])), "binned")
    rules: list[Rule] = []
    failed: list[Literal] = []
    while len(rules) < max_rules:
        open_rows = binned.where(~any_rule(rules))
        grown = _grown(open_rows.where("not prune"), cut_points, max_literals, support, lambda x: not _tried(x, failed, tries))
        if not grown:
            break
        if rule := _pruned(open_rows.where("prune"), grown, precision):
            rules.append(rule)
        else:
            failed.append(grown[0])
    return rules


def _tried(literal: Literal, failed: list[Literal], tries: int) -> bool:
    """Whether a rule that began with this literal or a tighter one has failed, or too many of its share and direction."""
    alike = [f.cut for f in failed if (f.share, f.at_least) == (literal.share, literal.at_least)]
    return len(alike) >= tries or any(literal.cut <= cut if literal.at_least else literal.cut >= cut for cut in alike)


def _grown(rows: DataFrame, cut_points: dict, max_literals: int, support: int, may_begin) -> Rule:
    rule: list[Literal] = []
    while len(rule) < max_literals:
        covered = rows.where(_all(tuple(rule)))
        # At most (shares x cuts) rows reach the driver.
        table = covered.select("bad", F.posexplode("bins").alias("share", "bin")).groupBy("share", "bin").agg(
            F.count("*").alias("n"), F.sum("bad").alias("bad")).collect()
        total, bad = (sum(r[k] for r in table if r["share"] == 0) for k in ("n", "bad"))
        if bad < support or bad == total:
            break
        best, gained = None, 1e-9
        for at, share in enumerate(SHARES):
            below_n = below_bad = 0
            counts = {r["bin"]: (r["n"], r["bad"]) for r in table if r["share"] == at}
            for k, cut in enumerate(cut_points[share]):
                n, b = counts.get(k, (0, 0))
                below_n, below_bad = below_n + n, below_bad + b
                for at_least, (n, b) in ((True, (total - below_n, bad - below_bad)), (False, (below_n, below_bad))):
                    if b >= support and (gain := b * (math.log2(b / n) - math.log2(bad / total))) > gained + 1e-9 and (rule or may_begin(Literal(share, at_least, cut))):
                        best, gained = Literal(share, at_least, cut), gain
        if best is None:
            break
        rule.append(best)
    return tuple(rule)


def _pruned(rows: DataFrame, rule: Rule, precision: float) -> Rule:
    """The beginning of the rule with the best (bad - good) / covered on other rows, if precise enough."""
    heads = [rule[: k + 1] for k in range(len(rule))]
    sums = rows.agg(*[F.sum(F.when(_all(h), F.col("bad")).otherwise(0)).alias(f"b{k}") for k, h in enumerate(heads)],
                    *[F.sum(F.when(_all(h), 1).otherwise(0)).alias(f"n{k}") for k, h in enumerate(heads)]).first()
    worth = [((2 * sums[f"b{k}"] - sums[f"n{k}"]) / sums[f"n{k}"], -k) for k in range(len(heads)) if sums[f"n{k}"]]
    if not worth:
        return ()
    k = -max(worth)[1]
    return heads[k] if sums[f"b{k}"] >= precision * sums[f"n{k}"] else ()


def verdicts_of(docs: DataFrame, carry: Column, rules: list[Rule]) -> DataFrame:
    """(row, kept) per row of ``docs`` by rules learned before: one scan, nothing is written.

    The statistics pass through a generator, so that the optimizer does not copy them into every place where a rule uses one.
    """
    counts = text_statistics(docs, carry)
    told = counts.select("row", F.inline(F.array(F.struct(*[c for c in counts.columns if c != "row"]))))
    return told.select("row", (~base_failed() & ~any_rule(rules)).alias("kept"))


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, quality): one label per document, the lowest of several."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))


def learned_rules(docs: DataFrame, labels: DataFrame, max_rows: int = 50_000, **limits) -> list[Rule]:
    """The rules of ``quality_verdicts``, from statistics of the labelled texts that can be among the ``max_rows`` it learns from.

    Labelled documents are taken in ranges of their turn, the lowest first, until ``max_rows`` rows that pass the base rule are found
    or no label is left. No range is read twice; a table with few labels, or with few texts that pass, is read to its end.
    """
    known = _known(labels).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    place = _turn("doc_id") / F.lit(2.0**64) + 0.5  # 0 to 1, in the order of turns
    labelled = known.count()
    parts, found, low = [], 0, 0.0
    while low < 1.0 and (found < max_rows or not parts):
        # As many labels as the share that passed so far asks for, and a tenth more.
        passed = max(found, 1) / (low * max(labelled, 1)) if parts else 1.0
        high = min(1.0, low + max(1.1 * (max_rows - found) / (passed * max(labelled, 1)), 1e-6))
        here = (place >= low) & (place < high) if high < 1.0 else place >= low
        marks = staged(known.where(here), "marks")
        texts = docs.where("doc_id is not null").where(here).select("doc_id", "text").join(marks, "doc_id")
        part = staged(text_statistics(texts, F.struct("doc_id", "quality")), "taught").where(~base_failed())
        found += part.count()
        parts.append(part.select(F.col("row.doc_id").alias("key"), (F.col("row.quality") == 0).alias("bad"), *SHARES))
        low = high
    taught = parts[0]
    for part in parts[1:]:
        taught = taught.unionByName(part)
    return learn_rules(taught, max_rows, **limits)


def quality_verdicts(docs: DataFrame, labels: DataFrame, carry: Column, **limits) -> tuple[DataFrame, list[Rule]]:
    """(row, statistics, base_failed, kept) per row of ``docs`` (doc_id, text), and the rules.

    ``labels`` (doc_id, quality) teaches the rules: quality 0 is bad, null is no label, and of several
    labels of one doc_id the lowest counts. ``carry`` is kept as ``row`` and must hold doc_id; other
    columns of either table are ignored. Texts that fail the base rule teach nothing. A null text has
    no words, so it fails the base rule. Rows of a null doc_id are judged like any other. Repeated
    rows give repeated results.
    """
    stats = staged(text_statistics(docs, carry), "statistics").withColumn("base_failed", base_failed())
    taught = stats.where("not base_failed").select(F.col("row.doc_id").alias("doc_id"), *SHARES).join(_known(labels), "doc_id").select(
        F.col("doc_id").alias("key"), (F.col("quality") == 0).alias("bad"), *SHARES)
    rules = learn_rules(taught, **limits)
    return stats.withColumn("kept", ~F.col("base_failed") & ~any_rule(rules)), rules
