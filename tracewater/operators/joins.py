"""Equi joins with an explicit choice of null rule.

``null_safe_*``: a missing key matches a missing key.
``strict_*``:    a missing key matches nothing.

All of them are plain Catalyst equi joins, so Spark picks broadcast, hash or
sort-merge from the statistics and AQE splits a hot key at run time. Nothing
is broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pair = tuple[str, str]


def key_pairs(on: Sequence[str | Pair]) -> list[Pair]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def _aside(name: str) -> str:
    return f"__r_{name}"


def _prepare(left: DataFrame, right: DataFrame, on, suffix: str):
    """Move right keys out of the way and suffix clashing payload names."""
    pairs = key_pairs(on)
    right_keys = [r for _, r in pairs]
    taken = set(left.columns)
    payload = [c for c in right.columns if c not in right_keys]
    shown = [c + suffix if c in taken else c for c in payload]
    prepared = right.select(
        *[F.col(f"`{r}`").alias(_aside(r)) for r in right_keys],
        *[F.col(f"`{c}`").alias(s) for c, s in zip(payload, shown)],
    )
    return pairs, prepared, shown


def null_safe_condition(pairs: Sequence[Pair]) -> Column:
    return reduce(and_, [F.col(f"`{l}`").eqNullSafe(F.col(_aside(r))) for l, r in pairs])


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str | Pair],
    how: str = "left",
    keep_keys: bool = False,
    suffix: str = "_right",
) -> DataFrame:
    """Join where null keys pair up.

    ``keep_keys`` also returns the right side's keys, named ``key + suffix``
    when the left side already has that name.
    """
    pairs, prepared, shown = _prepare(left, right, on, suffix)
    joined = left.join(prepared, null_safe_condition(pairs), how)
    kept = []
    if keep_keys:
        kept = [
            F.col(_aside(r)).alias(r + suffix if r in left.columns else r) for _, r in pairs
        ]
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *kept, *[F.col(f"`{c}`") for c in shown])


def strict_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str | Pair],
    how: str = "left",
    suffix: str = "_right",
    spread_by: Sequence[str] | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Join where a null key matches nothing.

    A left join keeps its null-key rows. They would all hash to one task, so
    they carry a spreading number next to the key; the right side only holds
    zeros there, and no null key can match anyway. The number is a hash of
    ``spread_by``, by default the first column that is no key, so that other
    columns can still be pruned, below ``spread``, by default the session's
    number of shuffle partitions.
    """
    pairs, prepared, shown = _prepare(left, right, on, suffix)
    left_keys = [l for l, _ in pairs]
    spread_by = spread_by or [c for c in left.columns if c not in left_keys][:1] or left_keys
    missing = reduce(or_, [F.col(f"`{l}`").isNull() for l in left_keys])
    width = spread or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.when(missing, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]), F.lit(width)))
    left_side = left.withColumn("__spread", F.coalesce(number, F.lit(0).cast("bigint")))
    right_side = prepared.dropna(subset=[_aside(r) for _, r in pairs]).withColumn(
        "__spread_r", F.lit(0).cast("bigint")
    )
    match = reduce(and_, [F.col(f"`{l}`") == F.col(_aside(r)) for l, r in pairs])
    joined = left_side.join(right_side, match & (F.col("__spread") == F.col("__spread_r")), how)
    return joined.select(*[F.col(f"`{c}`") for c in [*left.columns, *shown]])


def join_with_attribute(
    left: DataFrame, right: DataFrame, on: Sequence[str | Pair], attribute: str, suffix: str = "_right"
) -> DataFrame:
    """Rows of ``left`` whose partner has ``attribute`` filled.

    Unmatched rows and matched rows with an empty attribute both disappear, so
    the filter goes below an inner join.
    """
    return null_safe_join(left, right.where(F.col(f"`{attribute}`").isNotNull()), on, "inner", suffix=suffix)


def _key_set(keys: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    return keys.select(*[F.col(f"`{r}`").alias(_aside(r)) for _, r in pairs]).distinct()


def in_set(df: DataFrame, keys: DataFrame, on: Sequence[str | Pair]) -> DataFrame:
    """Rows whose key occurs in ``keys``; null counts as a member if present."""
    pairs = key_pairs(on)
    return df.join(_key_set(keys, pairs), null_safe_condition(pairs), "left_semi")


def not_in_set(df: DataFrame, keys: DataFrame, on: Sequence[str | Pair]) -> DataFrame:
    """Rows whose key does not occur in ``keys``; null is dropped only if ``keys`` holds null."""
    pairs = key_pairs(on)
    return df.join(_key_set(keys, pairs), null_safe_condition(pairs), "left_anti")


def in_each_column(df: DataFrame, keys: DataFrame, columns: Sequence[str | Pair]) -> DataFrame:
    """Rows whose columns each occur in the matching column of ``keys``.

    These are independent memberships: the values need not come from one row
    of ``keys``.
    """
    for pair in key_pairs(columns):
        df = in_set(df, keys, [pair])
    return df


def full_merge(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str | Pair],
    coalesce: Sequence[tuple[str, str, str]] = (),
) -> DataFrame:
    """Full outer join on keys that never match when null, left-first coalesce.

    ``coalesce`` lists ``(left_col, right_col, out)``; both sources are
    replaced by ``out``. Keys come back under their left names.

    A full outer join cannot be split at run time, so one hot key would end in
    one task. It is written as matches + left rest + right rest instead: the
    inner join splits on both sides, each anti join on its own side against a
    de-duplicated key list, and rows with a null key skip the shuffle. The
    shuffled, null-free sides are the same subplans in the inner and the anti
    joins, so Spark reuses their exchanges; the key lists and the null rows
    read each side again, so sides that are costly should be written out first.
    """
    pairs = key_pairs(on)
    lk, rk = [l for l, _ in pairs], [r for _, r in pairs]
    right_payload = [c for c in right.columns if c not in rk]
    clash = set(left.columns) & set(right_payload)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    types = {f.name: f.dataType for f in [*right.schema.fields, *left.schema.fields]}
    names = [*left.columns, *right_payload]
    key_of = dict(zip(lk, rk))

    def complete(df: DataFrame, side: str) -> DataFrame:
        """All output columns; those of the other side are null unless ``side`` is both."""
        out = []
        for n in names:
            if n in left.columns and side != "r":
                value = F.col(f"l.`{n}`")
            elif side == "l" or (side == "r" and n in left.columns and n not in key_of):
                value = F.lit(None).cast(types[n])
            else:
                value = F.col(f"r.`{key_of.get(n, n)}`")
            out.append(value.alias(n))
        return df.select(*out)

    def filled(keys: list[str]) -> Column:
        # Spelled as isNotNull: the filter Spark infers for an inner join is
        # then already there, and both uses of a side are the same subplan.
        return reduce(and_, [F.col(f"`{c}`").isNotNull() for c in keys])

    def missing(keys: list[str]) -> Column:
        return reduce(or_, [F.col(f"`{c}`").isNull() for c in keys])

    def keys_of(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in keys]).distinct().hint("merge")

    # All three are merge joins by statement: a side, or its key list as long as
    # it, that was written to a file that packs well would pass for small enough
    # to be sent around by the driver.
    left_full, right_full = left.where(filled(lk)), right.where(filled(rk))
    match = reduce(and_, [F.col(f"l.`{l}`") == F.col(f"r.`{r}`") for l, r in pairs])
    parts = [
        complete(left_full.alias("l").join(right_full.alias("r").hint("merge"), match, "inner"), "both"),
        complete(left_full.alias("l").join(keys_of(right_full, rk).alias("r"), match, "left_anti"), "l"),
        complete(right_full.alias("r").join(keys_of(left_full, lk).alias("l"), match, "left_anti"), "r"),
        complete(left.where(missing(lk)).alias("l"), "l"),
        complete(right.where(missing(rk)).alias("r"), "r"),
    ]
    merged = reduce(lambda a, b: a.unionByName(b), parts)
    replaced = {c for l, r, _ in coalesce for c in (l, r)}
    return merged.select(
        *[F.col(f"`{c}`") for c in names if c not in replaced],
        *[F.coalesce(F.col(f"`{l}`"), F.col(f"`{r}`")).alias(out) for l, r, out in coalesce],
    )


def attach_totals(members: DataFrame, facts: DataFrame, on: str, totals: dict[str, Column]) -> DataFrame:
    """Per-member totals next to the member list; members without facts stay."""
    return strict_join(members, facts.groupBy(on).agg(*[c.alias(n) for n, c in totals.items()]), [on])
