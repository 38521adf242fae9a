"""URL rules, and a tree of path templates per host that judges what no rule names.

DataFrame expressions only. A path is a branch of segments. A segment that holds a fair share of its
host's pages at its depth stays as it is; all others are variable and become a wildcard of their class
(figures, letters, both, an ending). From the root down, sibling branches are ordered by their share
of bad labels, and neighbours whose shares a two-proportion test cannot tell apart become one branch.
What is left are templates. The share of bad labels of each is smoothed towards its host's, which is
smoothed towards that of all; a template at or beyond the cut is rejected.

Labels and pages are summed before they are shuffled by host. A segment or branch is a row of counts,
however many pages stand behind it, and the literals of a host and depth are at most ``1 / share``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.frames import stored


@dataclass(frozen=True)
class UrlRule:
    """A verdict on a host and its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    allow: bool

    def __str__(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith(f".{self.host}")) & F.col("path").startswith(self.path)


#: Parts that the pages of a host, or of a template, are dealt out to where they meet what is known of it.
SPREAD = 16
RULES = (
    UrlRule("net", "/", False),
    UrlRule("example.net", "/en/", True),
    UrlRule("example.com", "/de/", False),
    UrlRule("org", "/fr/", True),
)


@dataclass(frozen=True)
class Tree:
    """How templates are found and judged."""

    #: Segments beyond this depth are one wildcard.
    depth: int = 16
    #: A literal segment stands in at least this share of its host's pages at its depth, and so many pages.
    share: float = 0.02
    least: int = 5
    #: Branches differ where the test statistic reaches this.
    deviations: float = 2.0
    #: Labels that the smoothing counts in at the host's share, and for a host at the share of all.
    strength: float = 10.0
    #: The smoothed share of bad labels at which a template is rejected.
    cut: float = 0.5


def located(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    mark = F.locate("://", F.col(url))
    rest = F.when(mark > 0, F.substring(F.col(url), mark + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def by_rule(rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        name = F.when(rule.fits(), str(rule)).otherwise(name)
        verdict = F.when(rule.fits(), "allow" if rule.allow else "block").otherwise(verdict)
    return name, verdict


def wildcard(segment: Column) -> Column:
    """The class of a variable segment, one of a few dozen."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    parts = [
        F.when(stem.rlike("[0-9]"), "9").otherwise(""),
        F.when(stem.rlike(r"[^0-9\-_.~%+]"), "a").otherwise(""),
        F.when(stem.rlike(r"[\-_.~%+]"), "-").otherwise(""),
        F.when(F.length(stem) > 32, "+").otherwise(""),
        F.when(F.length(stem) < F.length(segment), ".").otherwise(""),
    ]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def _segments(tree: Tree) -> Column:
    every = F.split("path", "/", -1)
    more = F.when(F.size(every) > tree.depth, F.array(F.lit("{**}"))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.slice(every, 1, tree.depth), more)


def _met(pages: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of pages (page_id, path, ...) with one row per key, copied to every part: a third of all pages may share a key."""
    part = F.pmod(F.xxhash64("page_id", "path"), F.lit(SPREAD)).alias("part")
    parts = F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))
    copies = known.select("*", F.explode(parts).alias("part"))
    return pages.select("*", part).join(copies, [*keys, "part"], "left").drop("part")


def generalised(pages: DataFrame, tree: Tree) -> DataFrame:
    """Adds ``tokens``: the segments of each path (page_id, host, path), variable ones as wildcards."""
    cut = pages.withColumn("segments", _segments(tree))
    counted = cut.select("host", F.posexplode("segments").alias("k", "segment")).groupBy("host", "k", "segment").agg(F.count("*").alias("n"))
    total = counted.groupBy("host", "k").agg(F.sum("n").alias("total"))
    # Few rows of a host and depth are left before its total joins them.
    common = counted.where(F.col("n") >= tree.least).join(total, ["host", "k"]).where(F.col("n") >= F.col("total") * tree.share)
    literals = common.groupBy("host").agg(F.collect_set(F.struct("k", "segment")).alias("literals"))
    known = _met(cut, literals, ["host"])

    def token(segment: Column, k: Column) -> Column:
        literal = F.array_contains("literals", F.struct(k.alias("k"), segment.alias("segment")))
        return F.when(F.coalesce(literal, F.lit(False)) | (segment == "") | (segment == "{**}"), segment).otherwise(wildcard(segment))

    return known.withColumn("tokens", F.transform("segments", token)).drop("segments", "literals")


def merged(branches: DataFrame, tree: Tree) -> DataFrame:
    """Final ``template`` of each row of branches (host, tokens, n, labelled, bad), siblings merged from the root down.

    Each level takes one aggregation over the templates of the level above.
    """
    rows = branches.withColumn("node", F.lit(""))
    deepest = rows.agg(F.max(F.size("tokens"))).first()[0] or 0
    for k in range(deepest):
        token = F.try_element_at("tokens", F.lit(k + 1))
        sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
        siblings = rows.where(token.isNotNull()).groupBy("host", "node", token.alias("token")).agg(*sums)
        # At most 1 / share literals and a few dozen classes stand below one node.
        order = Window.partitionBy("host", "node").orderBy(F.try_divide(F.col("bad") + 1, F.col("labelled") + 2), "token")
        apart = _apart(F.lag("labelled").over(order), F.lag("bad").over(order), F.col("labelled"), F.col("bad"))
        group = F.sum((F.coalesce(apart, F.lit(0.0)) >= tree.deviations).cast("int")).over(order)
        grouped = siblings.select("host", "node", "token", group.alias("group"))
        names = grouped.groupBy("host", "node", "group").agg(F.collect_list("token").alias("members"))
        name = F.array_join(F.sort_array("members"), "|")
        name = F.when(F.size("members") > 1, F.concat(F.lit("("), name, F.lit(")"))).otherwise(name)
        prefix = F.when(F.lit(k > 0), F.concat("node", F.lit("/"))).otherwise("")
        below = names.select("host", "node", F.explode("members").alias("token"), F.concat(prefix, name).alias("below"))
        moved = rows.withColumn("token", token).join(below, ["host", "node", "token"], "left")
        rows = stored(moved.withColumn("node", F.coalesce("below", "node")).drop("token", "below"), "branches")
    return rows.withColumnRenamed("node", "template")


def _apart(n: Column, p: Column, m: Column, q: Column) -> Column:
    """Two-proportion statistic of p of n against q of m; null where either side has no label."""
    both = F.try_divide(p + q, n + m)
    error = F.sqrt(both * (1 - both) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m)))
    return F.abs(F.try_divide(F.try_divide(p, n) - F.try_divide(q, m), error))


def templates(branches: DataFrame, tree: Tree) -> DataFrame:
    """host, tokens, template, its labels and ``purity`` of stored branches: the smoothed share of bad labels."""
    every = branches.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("labelled")), F.lit(0.0))).scalar()
    placed = merged(branches, tree)
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    found = placed.groupBy("host", "template").agg(*sums)
    hosts = found.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    host_share = (F.col("host_bad") + tree.strength * every) / (F.col("host_labelled") + tree.strength)
    purity = (F.col("bad") + tree.strength * host_share) / (F.col("labelled") + tree.strength)
    judged = found.join(hosts, "host").select("host", "template", "n", "labelled", "bad", purity.alias("purity"))
    return placed.select("host", "tokens", "template").join(judged, ["host", "template"])


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, tree: Tree = Tree()) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of each row of pages (page_id, url, bad).

    ``bad`` is 1, 0 or null (no label). The verdict is that of the longest rule that fits; without one,
    block where the smoothed purity of the page's template reaches the cut, else allow. Null urls and
    those without ``://`` have an empty host and path and form a template of their own. Without labels
    nothing is rejected. Repeated rows count as often as they stand. Other columns are not read.
    """
    host, path = located("url")
    bad = F.coalesce("bad", F.lit(0)).cast("long")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("bad").isNotNull().alias("labelled"), bad.alias("bad"))
    placed = stored(generalised(rows, tree), "placed")
    sums = (F.count("*").alias("n"), F.count_if("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    branches = stored(placed.groupBy("host", "tokens").agg(*sums), "branches")
    known = templates(branches, tree).select("host", "tokens", "template", "purity")
    rule, verdict = by_rule(rules)
    learned = F.when(F.col("purity") >= tree.cut, "block").otherwise("allow")
    both = _met(placed.select("page_id", "host", "path", "tokens"), known, ["host", "tokens"])
    return both.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "template", "purity")
