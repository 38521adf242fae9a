"""Quality rules: text statistics and a learned decision list, in DataFrame expressions only.

Sequential covering learns the list from labelled statistics. A rule is a conjunction of thresholds,
grown condition by condition by information gain on one part of the labels and pruned on another;
rows it covers are set aside and the next rule is learned from the rest. Each step is one aggregate
over binned statistics of all labelled rows, whose result has one row per statistic and bin. The list
becomes an ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.frames import stored

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Statistics that rules may use, as expressions over the counted ones.
STATISTICS = {
    "words": "n_words",
    "mean_chars": "try_divide(word_chars, n_words)",
    "symbol_rate": "try_divide(n_symbols, n_words)",
    "repeat_rate": "try_divide(n_repeat_words, n_words)",
    "dup_line_rate": "try_divide(n_dup_lines, n_lines)",
    "upper_rate": "try_divide(n_upper, word_chars)",
    "bang_rate": "try_divide(n_bangs, n_words)",
    "digit_rate": "try_divide(n_digits, word_chars)",
    "distinct_rate": "try_divide(n_distinct, n_words)",
}
BINS = 24
MOST_RULES, MOST_CONDITIONS = 8, 3
#: A rule must reject this share of bad rows among those it covers, and so many rows, where it is pruned.
LEAST_PRECISION, LEAST_ROWS = 0.95, 8


@dataclass(frozen=True)
class Condition:
    """A statistic is above, or at most, a threshold; bins below and from ``bin`` on."""

    statistic: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value = F.col(self.statistic)
        return F.coalesce(value > self.threshold if self.above else value <= self.threshold, F.lit(False))

    def on_bins(self) -> Column:
        value = F.col("bins")[list(STATISTICS).index(self.statistic)]
        return value > self.bin if self.above else value <= self.bin

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _removed(text: str, characters: str) -> Column:
    """How many of the characters the text holds."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _shifted(column: str, by: int) -> Column:
    return F.slice(column, by + 1, 1 << 30)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each row of docs (doc_id, text), null texts as empty. Other columns are not read."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "text",
        F.filter(F.split("text", SPACE + "+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE + "+", "")).cast("long").alias("word_chars"),
        _removed("text", SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        _removed("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _removed("text", "!").alias("n_bangs"),
        _removed("text", "0123456789").alias("n_digits"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    both = lambda a, b: F.xxhash64(a, b)
    counted = rows.columns[:-1]
    rows = rows.select(*counted, F.size(F.array_distinct("h")).cast("long").alias("n_distinct"), "h", F.zip_with("h", _shifted("h", 1), both).alias("h2"))
    rows = rows.select(*counted, "n_distinct", "h", F.zip_with("h2", _shifted("h2", 2), both).alias("h4"))
    grams = F.slice(F.zip_with("h4", _shifted("h", 4), both), 1, F.greatest(F.size("h") - (WINDOW - 1), F.lit(0)))
    rows = rows.select(*counted, "n_distinct", grams.alias("grams"))
    repeated = F.size("grams") > F.size(F.array_distinct("grams"))
    return rows.select(*counted, "n_distinct", F.when(repeated, _covered("grams")).otherwise(0).cast("long").alias("n_repeat_words"))


def _covered(grams: str) -> Column:
    """Words in windows that occur twice or more."""
    at = F.transform(grams, lambda g, k: F.struct(g.alias("g"), k.alias("k")))
    sorted_ = F.sort_array(at)
    # Sorted, equal windows stand side by side: one that equals its neighbour on either side is repeated.
    values = F.transform(sorted_, lambda x: x["g"])
    as_next = F.zip_with(values, F.slice(values, 2, 1 << 30), lambda a, b: a.eqNullSafe(b))
    as_last = F.concat(F.array(F.lit(False)), F.slice(as_next, 1, F.greatest(F.size(as_next) - 1, F.lit(0))))
    marked = F.zip_with(sorted_, F.zip_with(as_next, as_last, lambda a, b: a | b), lambda x, same: F.struct(x["k"].alias("k"), same.alias("same")))
    spread = F.sort_array(F.transform(F.filter(marked, lambda x: x["same"]), lambda x: x["k"]))
    return F.aggregate(
        spread,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, k: F.struct(k.alias("last"), (s["n"] + F.least(F.lit(WINDOW), k - s["last"])).alias("n")),
    )["n"]


def with_statistics(counts: DataFrame) -> DataFrame:
    """Adds the statistics of STATISTICS; a rate of nothing is null."""
    return counts.withColumns({n: F.expr(e).cast("double") for n, e in STATISTICS.items()})


def _binned(labelled: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Bins of each statistic between quantiles of the labelled rows, and those quantiles."""
    shares = [k / BINS for k in range(1, BINS)]
    found = labelled.groupBy("bad").agg(*(F.percentile_approx(n, shares, 2000).alias(n) for n in STATISTICS)).collect()
    edges = {n: sorted({q for row in found for q in row[n] or []}) for n in STATISTICS}
    bins = [_bin(n, edges[n]) for n in STATISTICS]
    return labelled.select("bad", "prune", F.array(*bins).alias("bins")), edges


def _bin(name: str, edges: Sequence[float]) -> Column:
    """How many edges lie below the statistic; -1 where it is null."""
    if not edges:
        return F.lit(-1)
    below = F.filter(F.array(*map(F.lit, edges)), lambda q: q < F.col(name))
    return F.when(F.col(name).isNull(), -1).otherwise(F.size(below))


def _grown(rows: DataFrame, edges: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    names = list(STATISTICS)
    while len(rule) < MOST_CONDITIONS:
        met = rows
        for condition in rule:
            met = met.where(condition.on_bins())
        counts = met.select("bad", F.posexplode("bins").alias("k", "bin")).groupBy("k", "bin")
        table: dict[str, dict[int, tuple[int, int]]] = {n: {} for n in names}
        for r in counts.agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect():
            table[names[r["k"]]][r["bin"]] = (r["bad"], r["n"] - r["bad"])
        bad = sum(p for p, _ in table[names[0]].values())
        good = sum(q for _, q in table[names[0]].values())
        if not bad or bad / (bad + good) >= 0.99 and rule:
            break
        best, gained = None, 1e-9
        for n in names:
            for k, edge in enumerate(edges[n]):
                for above in (True, False):
                    inside = [c for b, c in table[n].items() if (b > k if above else -1 < b <= k)]
                    p, q = sum(c[0] for c in inside), sum(c[1] for c in inside)
                    gain = p * (math.log2(p / (p + q)) - math.log2(bad / (bad + good))) if p else 0
                    if gain > gained:
                        best, gained = Condition(n, above, edge, k), gain
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, float, int]:
    """The beginning of the rule that does best on the rows, its precision and the rows it covers."""
    met, sums = F.lit(True), []
    for k, condition in enumerate(rule):
        met = met & condition.on_bins()
        sums += [F.sum(met.cast("int")).alias(f"n{k}"), F.sum(F.when(met, F.col("bad")).otherwise(0)).alias(f"p{k}")]
    found = rows.agg(*sums).first()
    worth = [((2 * (found[f"p{k}"] or 0) - (found[f"n{k}"] or 0)) / ((found[f"n{k}"] or 0) + 2), -k) for k in range(len(rule))]
    k = -max(worth)[1]
    n = found[f"n{k}"] or 0
    return rule[: k + 1], (found[f"p{k}"] or 0) / max(n, 1), n


def learn(counts: DataFrame, labels: DataFrame) -> list[Rule]:
    """An ordered list of rules that tell bad rows, from counts (doc_id, ...) and labels (doc_id, quality).

    A hash of doc_id puts two thirds of the labels to growing, the rest to pruning. Of repeated labels the
    least counts; null labels are left out. Without labels, or without bad ones, the list is empty.
    """
    labels = labels.where("quality is not null").groupBy("doc_id").agg((1 - F.min(F.col("quality").cast("int"))).alias("bad"))
    prune = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")
    labelled = with_statistics(counts.join(labels, "doc_id")).select("bad", prune, *STATISTICS)
    binned, edges = _binned(stored(labelled, "labelled"))
    rows = stored(binned, "binned")
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        rule = _grown(rows.where("not prune"), edges)
        if not rule:
            break
        rule, precision, covered = _pruned(rows.where("prune"), rule)
        if precision < LEAST_PRECISION or covered < LEAST_ROWS:
            break
        rules.append(rule)
        met = F.lit(True)
        for condition in rule:
            met = met & condition.on_bins()
        rows = rows.where(~met)
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list as one conditional: false from the first rule that a row meets, true if none."""
    decision = None
    for rule in rules:
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column()
        decision = F.when(met, F.lit(False)) if decision is None else decision.when(met, F.lit(False))
    return F.lit(True) if decision is None else decision.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of each row of docs (doc_id, text).

    base_failed: fewer than 10 words, or over a fifth of the words in repeated windows. kept: not
    base_failed, and no learned rule tells the row. Null and empty texts fail.
    """
    counts = stored(statistics(docs), "statistics")
    rules = learn(counts, labels)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return with_statistics(counts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
