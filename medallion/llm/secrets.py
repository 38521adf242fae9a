"""Secrets in whole texts, and weak parts of credentials where their counterparts stand near.

DataFrame expressions only. Text between the matches of a pattern gives the places of the matches, in
code points. Strong findings are reported as they are. A credential often has several parts: an access
identifier, a secret and an endpoint. Parts that alone are weak evidence (an opaque token, an assigned
user or key name, a URL) are interval-joined within their scope, a paragraph and at most ``REACH`` code
points from the end of one to the start of the other, and reported only where complementary parts occur
together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.frames import stored

REACH = 400


@dataclass(frozen=True)
class Pattern:
    """Matches of ``pattern`` that pass ``test`` are parts of a role: id, secret or endpoint."""

    kind: str
    pattern: str
    role: str
    strong: bool = False
    test: Callable[[Column], Column] = lambda m: F.lit(True)


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_NAMED = r"""(?i:client_?id|user_?name|account|access_?key|key_?id|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]+"""
_PLACE = r"(?i:https?|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|ftp)://[A-Za-z0-9_.:/@%?&=+-]+"
#: In the order in which kinds at the same place are listed.
PATTERNS = (
    Pattern("assign", _ASSIGN, "secret", True, lambda m: F.length(F.regexp_extract(m, _ASSIGN, 1)) >= 6),
    Pattern("access", "AKIA[A-Z0-9]+", "id", True, lambda m: F.length(m) >= 20),
    Pattern("hex", "[0-9a-f]{24,}+", "secret", True),
    Pattern("named", _NAMED, "id"),
    Pattern(
        "opaque", "(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{32,}+={0,2}", "secret", False,
        lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]"),
    ),
    Pattern("endpoint", _PLACE, "endpoint"),
)
KINDS = [p.kind for p in PATTERNS]
_STRONG = [k for k, p in enumerate(PATTERNS) if p.strong]
_WEAK = [k for k, p in enumerate(PATTERNS) if not p.strong]
#: The kind of a break between paragraphs.
_BREAKS = len(PATTERNS)
_STEPS = "array<struct<kind:int,k:int,gap:bigint,size:bigint,keep:boolean>>"
_BREAK = r"\n[\x20\t\r]*\n"


def _steps(number: int, pattern: str, test: Callable[[Column], Column]) -> Column:
    """For each leftmost match that does not overlap: kind, order, code points since the last one, its length, and whether it passes."""
    steps = F.zip_with(
        F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)),
        lambda gap, m: F.struct(F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("size"), test(m).alias("keep")),
    )
    # The text after the last match has no match.
    steps = F.transform(steps, lambda x, k: F.struct(F.lit(number).alias("kind"), k.alias("k"), x["gap"].alias("gap"), x["size"].alias("size"), x["keep"].alias("keep")))
    return F.when(F.col("text").rlike(pattern), F.filter(steps, lambda x: x["size"].isNotNull())).otherwise(F.array().cast(_STEPS))


def matches(docs: DataFrame) -> DataFrame:
    """uid, doc_id and the steps from match to match of all patterns in each row of docs (doc_id, text)."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    steps = F.concat(*(_steps(n, p.pattern, p.test) for n, p in enumerate(PATTERNS)))
    breaks = _steps(_BREAKS, _BREAK, lambda m: F.lit(True))
    none = F.array().cast(_STEPS)

    def with_breaks(found: Column) -> Column:
        # Paragraphs matter only where something weak is found.
        weak = F.exists(found, lambda x: x["keep"] & x["kind"].isin(_WEAK))
        return F.concat(found, F.when(weak, breaks).otherwise(none))

    # Bound to a lambda's name, the steps are computed once.
    return rows.select("uid", "doc_id", F.transform(F.array(steps), with_breaks)[0].alias("steps"))


def parts(found: DataFrame) -> DataFrame:
    """uid, kind, start, end and scope (a number of its paragraph) of the matches of stored ``matches``, but for weak ones over strong ones.

    Places are running sums over the steps of a text, and what lies over what follows from running
    bounds in the order of the places: work that grows with the matches, however many a text holds.
    """
    steps = found.select("uid", F.explode("steps").alias("s")).select("uid", "s.*")
    so_far = Window.partitionBy("uid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    placed = steps.select("uid", "kind", "keep", (end - F.col("size")).alias("start"), end.alias("end")).where("keep")
    order = Window.partitionBy("uid").orderBy("start")
    before = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Backwards, as a frame without an end would be summed anew for every row.
    after = Window.partitionBy("uid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    strong = F.col("kind").isin(_STRONG)
    placed = placed.select(
        "uid", "kind", "start", "end",
        F.count_if(F.col("kind") == _BREAKS).over(before).alias("scope"),
        F.max(F.when(strong, F.col("end"))).over(before).alias("reached"),
        F.min(F.when(strong, F.col("start"))).over(after).alias("next"),
    )
    covered = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    return placed.where(strong | (F.col("kind").isin(_WEAK) & ~covered)).drop("reached", "next")


def linked(found: DataFrame) -> DataFrame:
    """(uid, start, kind, end) of those weak parts, of rows of ``parts``, whose counterparts stand in their scope.

    A weak secret needs an identifier or an endpoint; a weak identifier a secret; an endpoint both.
    """
    role = F.array(*(F.lit(p.role) for p in PATTERNS))[F.col("kind")]
    place = F.struct("start", "kind", "end").alias("p")
    every = found.select("uid", place, role.alias("role"), "scope", *(F.floor(F.col(c) / REACH).alias(n) for c, n in (("start", "first"), ("end", "last"))))
    weak = every.where(F.col("p.kind").isin(_WEAK))
    # Parts stand in all cells they cover, weak ones also in those next to them; a pair may meet more than once.
    # A cell is REACH code points wide, so it holds few parts.
    near = weak.select("uid", "p", "role", "scope", F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    others = every.select("uid", F.col("p").alias("q"), F.col("role").alias("q_role"), "scope", F.explode(F.sequence("first", "last")).alias("cell"))
    gap = F.greatest("p.start", "q.start") - F.least("p.end", "q.end")
    met = near.join(others, ["uid", "scope", "cell"]).where(gap <= REACH)
    has = {r: F.bool_or(F.col("q_role") == r).alias(r) for r in ("id", "secret", "endpoint")}
    roles = met.groupBy("uid", "p", "role").agg(*has.values())
    whole = (
        F.when(F.col("role") == "secret", F.col("id") | F.col("endpoint"))
        .when(F.col("role") == "id", F.col("secret"))
        .otherwise(F.col("id") & F.col("secret"))
    )
    return roles.where(whole).select("uid", "p.*")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (start, kind, end, strong) of each row of docs (doc_id, text), by start and kind.

    Null and empty texts have none. Rows may repeat. Other columns are not read.
    """
    rows = stored(matches(docs), "matches")
    found = stored(parts(rows), "parts")
    shown = found.where(F.col("kind").isin(_STRONG)).select("uid", "start", "kind", "end").unionByName(linked(found))
    listed = shown.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    both = rows.select("uid", "doc_id").join(listed, "uid", "left")
    spans = F.coalesce("spans", F.array().cast(listed.schema["spans"].dataType))
    kinds = F.array(*map(F.lit, KINDS))
    strong = F.array(*(F.lit(p.strong) for p in PATTERNS))
    named = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), kinds[s["kind"]].alias("kind"), s["end"].alias("end"), strong[s["kind"]].alias("strong")))
    return both.select("doc_id", named.alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the strong spans, and all spans as text, of rows of ``find_secrets``."""
    strong = F.filter("spans", lambda s: s["strong"])
    counts = [_count(strong, p.kind).alias(f"n_{p.kind}") for p in PATTERNS if p.strong]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(strong), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(strong)).cast("long").alias("n_added"),
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
