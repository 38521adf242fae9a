"""Equi joins of a large measure side with a facility side of unknown size and skew.

The facility side is broadcast when its measured size allows. Beyond that both sides are shuffled,
and a key that holds more rows than one task should take, on either side, is salted: its rows on
that side are spread over several salt values and the other side is copied once per value. No row
is dropped or capped, and the result does not depend on which way was taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024
ROWS_PER_TASK = 1_000_000
HOT_KEYS = 100_000

_ROW_OVERHEAD = 64
_LEAST_COUNTERS = 1024
_SKETCH_MERGERS = 64
_CLEARLY_TOO_LARGE = 16
_SALTS = "__salts"
_LEFT_SALT = "__left_salt"
_RIGHT_SALT = "__right_salt"


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the decoded rows of ``df`` take at most ``limit`` bytes.

    The optimizer's estimate is free, but it is drawn from compressed file sizes and proves
    nothing: it only spares measuring what is clearly too large. Everything else is measured by
    one aggregate over the few columns that would be sent.
    """
    if limit <= 0:
        return False
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if estimate > _CLEARLY_TOO_LARGE * limit:
        return False
    row_bytes = F.lit(_ROW_OVERHEAD)
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            row_bytes += F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0))
        elif isinstance(field.dataType, T.NumericType):
            row_bytes += 8
        else:
            return False
    return (df.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0) <= limit


def join_facilities(
    measures: DataFrame,
    facilities: DataFrame,
    key: str,
    *,
    broadcast: bool | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner equi join. Null keys never match; repeated facility keys repeat the measures.

    ``broadcast`` says whether the facility side is known to fit; None measures it. The shuffled
    way counts the hot keys of both sides when this is called.
    """
    if broadcast is None:
        broadcast = fits_broadcast(facilities, broadcast_limit)
    if broadcast:
        return measures.join(F.broadcast(facilities), key)
    return salted_join(measures, facilities, key, "inner", rows_per_task)


def right_join_facilities(
    measures: DataFrame,
    facilities: DataFrame,
    key: str,
    *,
    broadcast: bool | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Right outer equi join, keeping every facility; the key is the facility's.

    It is the inner join plus the facilities no measure names. A plain right outer join would
    shuffle the measures even next to a tiny facility side, since Spark cannot broadcast the side
    it preserves, and would send all facilities without a key to one task. The hot keys of a side
    are counted once, for both parts.
    """
    if broadcast is None:
        broadcast = fits_broadcast(facilities, broadcast_limit)
    if broadcast:
        matched = measures.join(F.broadcast(facilities), key)
        # A subset of the facility keys, hence within the same bound.
        seen = (
            measures.select(key)
            .join(F.broadcast(facilities.select(key)), key, "left_semi")
            .distinct()
        )
        unmatched = facilities.join(F.broadcast(seen), key, "left_anti")
    else:
        hot = hot_keys(facilities, key, rows_per_task)
        hot_measures = hot_keys(measures, key, rows_per_task)
        matched = salted_join(
            measures, facilities, key, "inner", hot_left=hot_measures, hot_right=hot
        )
        keyed = facilities.filter(F.col(key).isNotNull())
        seen = measures.select(key).filter(F.col(key).isNotNull()).distinct()
        unmatched = salted_join(keyed, seen, key, "left_anti", hot_left=hot).unionByName(
            facilities.filter(F.col(key).isNull())
        )
    return matched.unionByName(unmatched, allowMissingColumns=True)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    rows_per_task: int | None = None,
    *,
    hot_left: DataFrame | None = None,
    hot_right: DataFrame | None = None,
) -> DataFrame:
    """Shuffled equi join that splits hot keys; ``how`` is inner, or a left join.

    ``rows_per_task`` has the hot keys counted here; without it those given are taken.

    An inner join splits the hot keys of both sides: a pair of rows meets under exactly one pair
    of salts. A left join needs all partners of a left row in one place, so it splits the left
    side only, and the right side should hold few rows per key. Rows without a key are dropped
    before an inner join; left rows without one should be set apart before a left join, as they
    all hash to one task.

    The salt comes from a hash of the row position, so identical rows spread as well, and no
    regular order of the rows can pile a key up. A re-run task must give a row the salt it had
    before: a salted side should be a table scan with filters, projections or broadcast joins on
    top, which has a fixed row order. Write it to a table first if it holds a shuffle.
    """
    if how == "inner":
        left, right = (df.filter(F.col(key).isNotNull()) for df in (left, right))
    if rows_per_task is not None:
        hot_left = hot_keys(left, key, rows_per_task)
        hot_right = hot_keys(right, key, rows_per_task) if how == "inner" else None
    on = [key]
    if hot_left is not None:
        left = _spread(left, hot_left, key, _LEFT_SALT)
        right = _copied(right, hot_left, key, _LEFT_SALT)
        on.append(_LEFT_SALT)
    if hot_right is not None:
        right = _spread(right, hot_right, key, _RIGHT_SALT)
        left = _copied(left, hot_right, key, _RIGHT_SALT)
        on.append(_RIGHT_SALT)
    return left.join(right.hint("merge"), on, how).drop(_LEFT_SALT, _RIGHT_SALT)


def _spread(df: DataFrame, hot: DataFrame, key: str, salt: str) -> DataFrame:
    """Give each row of a hot key one of its salts; other rows get salt 0."""
    position = F.xxhash64(F.monotonically_increasing_id())
    place = F.pmod(position, F.coalesce(F.col(_SALTS), F.lit(1))).cast("int")
    return df.join(F.broadcast(hot), key, "left").withColumn(salt, place).drop(_SALTS)


def _copied(df: DataFrame, hot: DataFrame, key: str, salt: str) -> DataFrame:
    """One copy of a row per salt of its key."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    return df.join(F.broadcast(hot), key, "left").withColumn(salt, F.explode(salts)).drop(_SALTS)


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows and how many salts each gets, or None.

    A key gets a salt for every ``rows_per_task`` of its rows. The heaviest HOT_KEYS are taken, a
    fixed bound on what is sent to the driver and broadcast; a key left out holds less than one
    in HOT_KEYS of all rows.

    The keys are not grouped: tasks keep frequent-items sketches, which are merged in two steps, and
    only the keys these name are counted. A sketch of ``c`` counters is off by at most 3.5 / c of
    all rows. It has seven counters for each key that could be hot, so it is off by less than half
    of ``rows_per_task``, names every hot key, and names no key of fewer rows than the other half.
    """
    keyed = df.filter(F.col(key).isNotNull()).select(key)
    could_be = keyed.count() // rows_per_task
    if not could_be:
        return None
    could_be = min(could_be, HOT_KEYS)
    counters = max(7 * (could_be + 1), _LEAST_COUNTERS)
    task = (F.spark_partition_id() % _SKETCH_MERGERS).alias("task")
    sketches = keyed.groupBy(task).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {counters})").alias("sketch")
    )
    named = sketches.selectExpr(
        f"approx_top_k_estimate(approx_top_k_combine(sketch, {counters}), {2 * (could_be + 1)}) as t"
    )
    candidates = named.select(F.explode("t.item").alias(key))
    hottest = (
        # At most 2 * (HOT_KEYS + 1) keys.
        keyed.join(F.broadcast(candidates), key, "left_semi")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > rows_per_task)
        .orderBy(F.desc("n"), key)
        .limit(HOT_KEYS)
        .collect()
    )
    if not hottest:
        return None
    schema = T.StructType([df.schema[key], T.StructField(_SALTS, T.IntegerType())])
    salted = [(row[key], -(-row["n"] // rows_per_task)) for row in hottest]
    return df.sparkSession.createDataFrame(salted, schema)
