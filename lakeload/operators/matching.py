"""Key matching shared by all merges: pairing, uniqueness, membership."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.identifiers import column

# Copies of a lookup side that is too large to broadcast; a hot lookup value is
# spread over this many tasks.
SALTS = 16

# Bytes of input files that one task of a large shuffle stands for; rows in memory take many times that.
TASK_BYTES = 2 << 20
_MOST_TASKS = 20_000
# Types of which equal values are one value, unlike 0.0 and -0.0 or text under a collation.
_EXACT = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def size_estimate(df: DataFrame) -> int:
    """Spark's own upper estimate of a frame's size.

    Taken from the analysed plan: it costs no optimizer run, and joins count as the
    product of their sides, so only what is certainly small is found small.
    """
    return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """Bytes that Spark broadcasts by itself; 0 where that is switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip()
    if text.startswith("-"):
        return 0
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def fits_broadcast(df: DataFrame) -> bool:
    limit = broadcast_limit(df)
    return limit > 0 and size_estimate(df) <= limit


def tasks_for(df: DataFrame) -> int:
    """Tasks that keep a shuffle's rows small: a number in proportion to the files the frame reads.

    Each scan counts with its files once, however often the plan names it; frames without a known
    size count nothing.  0 where the session's own number of shuffle partitions is no smaller.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes: set[tuple[str, int]] = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        size = int(str(leaf.stats().sizeInBytes()))
        if size < 1 << 60:
            # One table read twice has other column numbers, but the same canonical form.
            sizes.add((str(leaf.canonicalized()), size))
    wanted = min(-(-sum(size for _, size in sizes) // TASK_BYTES), _MOST_TASKS)
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0


def spread(df: DataFrame, keys: Sequence[str], n_tasks: int) -> DataFrame:
    """Dealt by ``keys`` over ``n_tasks``, which later steps by these keys need not do again; 0: as it is."""
    return df.repartition(n_tasks, *[column(k) for k in keys]) if n_tasks else df


def any_null(cols: Sequence[str]) -> Column:
    return reduce(or_, (column(c).isNull() for c in cols))


def match_condition(cols: Sequence[str], left: str = "l", right: str = "r", null_safe: bool = True) -> Column:
    """Equality on all columns between two aliases; null-safe unless told otherwise."""
    pairs = ((column(c, left), column(c, right)) for c in cols)
    return reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def members(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left_semi",
    null_safe: bool = True,
    salts: int = SALTS,
    few: bool = False,
) -> DataFrame:
    """Join rows to a lookup frame that has each key once.

    One key may cover a large part of ``df`` (a day, a file, a region).  Small
    lookups are broadcast by Spark; otherwise both sides carry a salt so that one
    key's rows go to ``salts`` tasks, each with its own copy of the lookup row.
    ``salts=1`` is for keys that ``df`` holds once, which have nothing to spread.  ``few`` is for
    lookups known to be short though their plan does not show it, such as a list of files: they
    are broadcast, and ``df`` stays where it is.
    """
    # The salt is made from the row itself: a repeated task must route rows as before,
    # which a random number or a running one would not do.
    others = [c for c in df.columns if c not in on and _hashable(df, c)]
    left, right, salted = df, lookup, salts > 1 and bool(others) and not few and not fits_broadcast(lookup)
    if few:
        right = F.broadcast(lookup)
    if salted:
        spread = F.xxhash64(*[column(c) for c in others])
        left = df.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
        right = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    condition = match_condition(on, null_safe=null_safe)
    if salted:
        condition = condition & (F.col("l.__salt") == F.col("r.__salt"))
    joined = left.alias("l").join(right.alias("r"), condition, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("__salt")
    extra = [c for c in lookup.columns if c not in on]
    return joined.select(*[column(c, "l") for c in df.columns], *[column(c, "r") for c in extra])


def _hashable(df: DataFrame, name: str) -> bool:
    return "map<" not in df.schema[name].dataType.simpleString()


def require_unique(df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """The same rows; running them fails when a key occurs twice.

    The check is a key-only aggregation that Spark runs as a scalar subquery.
    """
    keyed = df.select(*[column(k) for k in keys])
    if not null_safe:
        keyed = keyed.where(~any_null(keys))
    repeated = (
        keyed.groupBy(*[column(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .agg(F.count(F.lit(1)).alias("__keys"))
    )
    failure = F.raise_error(F.lit(f"several source rows for one key ({', '.join(keys)})"))
    return df.where(F.when(repeated.scalar() > 0, failure.cast("boolean")).otherwise(F.lit(True)))


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by``.

    An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    """
    # Keys that the grouping returns as they are stay out of the rows, so that filters on them reach the scan.
    exact = [c for c in df.columns if c in keys and isinstance(df.schema[c].dataType, _EXACT)]
    if len(exact) == len(df.columns):
        exact = []
    rest = [c for c in df.columns if c not in exact]
    best = F.max_by(F.struct(*[column(c) for c in rest]), F.struct(*[column(c) for c in order_by]))
    last = df.groupBy(*[column(k) for k in keys]).agg(best.alias("__row"))
    return last.select(*[column(c) if c in exact else F.col("__row").getField(c).alias(c) for c in df.columns])


def unique_source(
    df: DataFrame,
    keys: Sequence[str],
    on_duplicates: str = "error",
    order_by: Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """``error`` fails on repeated keys, ``last`` keeps the greatest row, ``assume_unique`` trusts."""
    if on_duplicates == "assume_unique":
        return df
    if on_duplicates == "error":
        return require_unique(df, keys, null_safe)
    if on_duplicates == "last":
        if not order_by:
            raise ValueError("on_duplicates='last' needs order_by")
        if null_safe:
            return keep_last(df, keys, order_by)
        # A NULL key equals nothing, so such rows are not copies of each other.
        return keep_last(df.where(~any_null(keys)), keys, order_by).unionByName(df.where(any_null(keys)))
    raise ValueError(f"unknown on_duplicates: {on_duplicates}")


def pair(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    strategy: str = "auto",
    sized: DataFrame | None = None,
) -> DataFrame:
    """Target and source rows side by side: structs ``t`` and ``s``, flags ``in_t`` and ``in_s``.

    ``full``       one full outer join; both sides shuffle on the key once, over as many tasks as
                   the files that are read call for.
    ``broadcast``  for a source below Spark's broadcast limit: the target streams past
                   the broadcast source without a shuffle, and source rows without a
                   target are found from the target's key columns alone.
    ``auto``       takes ``broadcast`` when the source fits and the target is much larger;
                   ``sized`` stands for the target's size where joins already blur it.
    """
    if not null_safe:
        # NULL keys never match: kept out of the join, where they would all land in one task.
        matched = pair(
            target.where(~any_null(keys)), source.where(~any_null(keys)), keys, True, strategy, sized
        )
        return matched.unionByName(_side(target.where(any_null(keys)), source, "t")).unionByName(
            _side(source.where(any_null(keys)), target, "s")
        )

    if strategy == "auto":
        big = 16 * max(broadcast_limit(target), 1)
        small = fits_broadcast(source) and size_estimate(target if sized is None else sized) > big
        strategy = "broadcast" if small else "full"

    t = target.withColumn("__in_t", F.lit(True)).alias("l")
    s = source.withColumn("__in_s", F.lit(True)).alias("r")
    condition = match_condition(keys)
    if strategy == "full":
        joined = t.join(s, condition, "full_outer")
        n_tasks = tasks_for(joined)
        if n_tasks:
            # As one struct, NULL keys are equal to each other under a plain equality.
            key = F.struct(*[column(k) for k in keys])
            t, s = (spread(side.withColumn("__key", key), ["__key"], n_tasks) for side in (t, s))
            joined = t.alias("l").join(s.alias("r"), F.col("l.__key") == F.col("r.__key"), "full_outer")
        return _structs(joined, target, source)
    if strategy == "broadcast":
        found = (
            target.select(*[column(k) for k in keys])
            .alias("l")
            .join(source.select(*[column(k) for k in keys]).alias("r"), condition, "left_semi")
        )
        fresh = source.alias("l").join(found.alias("r"), condition, "left_anti")
        return _structs(t.join(s, condition, "left_outer"), target, source).unionByName(
            _side(fresh, target, "s")
        )
    raise ValueError(f"unknown strategy: {strategy}")


def _structs(joined: DataFrame, target: DataFrame, source: DataFrame) -> DataFrame:
    return joined.select(
        F.struct(*[column(c, "l") for c in target.columns]).alias("t"),
        F.struct(*[column(c, "r") for c in source.columns]).alias("s"),
        F.coalesce(F.col("__in_t"), F.lit(False)).alias("in_t"),
        F.coalesce(F.col("__in_s"), F.lit(False)).alias("in_s"),
    )


def _side(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
    """Rows of one side only, with a struct of NULLs for the other."""
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields])
    own = F.struct(*[column(c) for c in df.columns])
    return df.select(
        (own if name == "t" else nothing).alias("t"),
        (own if name == "s" else nothing).alias("s"),
        F.lit(name == "t").alias("in_t"),
        F.lit(name == "s").alias("in_s"),
    )
