"""Exact quantiles that never hold a group in one task.

A sketch only *fences in* the wanted ranks. Exact counts say between which fences a
rank lies, and just the rows there, a sliver of the data, are shuffled. While a sliver holds
more than a fixed number of rows it is fenced in again, each time to a thirtieth or
less; what is left is ranked as one short array per rank. A poor sketch costs a
round more, never a wrong answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import DEFAULTS
from strata.operators.projection import quoted
from strata.plans.sizing import broadcast_if_small, materialize, measured

SLIVER = 10_000  # rows ranked at once
SPLITS = 64  # parts a sliver is cut into in a round


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys])


def _between(fences: Sequence[str], below: Sequence[str], at: str, off: str = "0L") -> list[str]:
    """SQL for the fences next to both ranks of position ``at``: the last at or before the
    lower, the first behind the upper, and how many values come before the former. Null
    means no bound."""
    reached = ", ".join(f"if({off} + {b} <= floor({at}), {f}, null)" for f, b in zip(fences, below))
    passed = ", ".join(f"if({off} + {b} > ceil({at}), {f}, null)" for f, b in zip(fences, below))
    before = ", ".join(f"if({off} + {b} <= floor({at}), {off} + {b}, null)" for b in below)
    return [f"greatest({reached})", f"least({passed})", f"coalesce(greatest({before}), {off})"]


def narrow(near: DataFrame, group: Sequence[str], limit: int = SLIVER) -> tuple[DataFrame, int]:
    """Cut slivers down to ``limit`` rows, and say in how many rounds.

    ``near`` has the group's columns, ``_n``, ``_i``, ``_at`` (the position that is looked
    for), ``_off`` (values before the sliver), and distinct values ``_v`` with counts ``_c``.
    A round reads the rows twice, and keeps those between two new fences.
    """
    by = [*group, "_i"]
    cuts = ", ".join(f"{k / SPLITS!r}D" for k in range(1, SPLITS))
    names = [f"_f{k}" for k in range(SPLITS - 1)]
    below = [f"_b{k}" for k in range(SPLITS - 1)]
    near, rounds, held = materialize(near), 0, None
    while True:
        crowded = near.groupBy(*by).agg(
            F.expr("count(1)").alias("_m"), F.expr(f"percentile_approx(_v, array({cuts}), 10000)").alias("_f"),
        ).filter(F.col("_m") > limit)
        fences = materialize(crowded.selectExpr(*[f"`{k}` as `_r_{k}`" for k in by], "_m", *[f"_f[{k}] as {f}" for k, f in enumerate(names)]))
        rows = fences.agg(F.sum("_m")).first()[0]
        if rows is None or rows == held:  # none is too long, or a round took nothing off
            return near, rounds
        held = rows
        side = broadcast_if_small(fences)
        counted = near.join(side, _match(near, side, by)).groupBy(*by).agg(
            F.expr("max(_at)").alias("_at"), F.expr("max(_off)").alias("_off"), *[F.expr(f"max({f})").alias(f) for f in names],
            *[F.expr(f"sum(if(_v < {f}, _c, 0L))").alias(b) for f, b in zip(names, below)])
        low, high, off = _between(names, below, "_at", "_off")
        spans = broadcast_if_small(counted.selectExpr(
            *[f"`{k}` as `_r_{k}`" for k in by], "true as _cut", f"{low} as _low", f"{high} as _high", f"{off} as _before"))
        near = materialize(
            near.join(spans, _match(near, spans, by), "left")
            .filter("_cut is null or ((_low is null or _v >= _low) and (_high is null or _v < _high))")
            .selectExpr(*[f"`{k}`" for k in by], "_n", "_at", "coalesce(_before, _off) as _off", "_v", "_c"))
        rounds += 1


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    accuracy: int = 10_000,
    written: bool = False,
    sliver: int = SLIVER,
) -> DataFrame:
    """One row per group with linear-interpolated quantiles; groups without a value
    are absent. Null keys form a group. No task ranks more than ``sliver`` rows of a group.

    The values are read three times. Unless the frame is a ``written`` table, keys and
    value are written once first: sums of floating numbers that are computed anew may
    differ in their last bit, and ranks need the same values each time.
    """
    slack = 2.0 / accuracy
    cuts = sorted({min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-slack, slack)})
    fence = [f"_f{i}" for i in range(len(cuts))]
    below = [f"_b{i}" for i in range(len(cuts))]
    keys = list(keys)
    group = keys or ["_all"]

    data = df.select(*[quoted(k) for k in keys], quoted(value).cast("double").alias("_v"))
    data = data.filter(F.col("_v").isNotNull())
    if not keys:
        data = data.withColumn("_all", F.lit(0))
    if not written:
        data = materialize(data)

    # Expressions are written as SQL: one call each instead of one per operator.
    by = ", ".join(f"`{k}`" for k in group)
    foreign = [f"`{k}` as `_r_{k}`" for k in group]

    cut_list = ", ".join(f"{c!r}D" for c in cuts)
    fences = data.groupBy(*group).agg(
        F.expr(f"sort_array(percentile_approx(_v, array({cut_list}), {accuracy}))").alias("_f")
    ).selectExpr(*foreign, *[f"_f[{i}] as {f}" for i, f in enumerate(fence)])
    # Without keys there is one row. With keys the size is measured, and every later
    # frame has one row of like width per group too.
    small = True
    if keys:
        fences, size = measured(fences)
        small = size <= DEFAULTS.broadcast_bytes // 4

    def with_groups(per_group: DataFrame) -> DataFrame:
        return data.join(F.broadcast(per_group) if small else per_group, _match(data, per_group, group))

    counted = with_groups(fences).groupBy(*[data[k] for k in group]).agg(
        F.expr("count(1)").alias("_n"),
        *[F.expr(f"max({f})").alias(f) for f in fence],
        *[F.expr(f"count_if(_v < {f})").alias(b) for f, b in zip(fence, below)],
    )

    # Per wanted quantile: values from _low up to, not including, _high hold its two
    # ranks, and _off values come before them.
    wanted = range(len(probabilities))
    position = [f"{float(p)!r}D * (_n - 1)" for p in probabilities]
    spans, widths = [], []
    for i, at in enumerate(position):
        low, high, off = _between(fence, below, at)
        spans += [f"{low} as _low{i}", f"{high} as _high{i}", f"{off} as _off{i}"]
        until = ", ".join(f"if({b} > ceil({at}), {b}, null)" for b in below)
        widths.append(f"coalesce(least({until}), _n) - {off}")
    spans = counted.selectExpr(*foreign, "_n", *spans, f"greatest({', '.join(widths)}, 0) as _width")
    spans = materialize(spans)
    widest = spans.agg(F.max("_width")).first()[0] or 0

    within = [f"((_low{i} is null or _v >= _low{i}) and (_high{i} is null or _v < _high{i}))" for i in wanted]
    hits = ", ".join(f"if({within[i]}, struct({i} as i, {at} as at, _off{i} as off), null)" for i, at in enumerate(position))
    near = (
        with_groups(spans).filter(" or ".join(within))
        .select(*[data[k] for k in group], "_n", "_v", F.expr(f"explode(array_compact(array({hits})))").alias("_hit"))
        .selectExpr(*[f"`{k}`" for k in group], "_n", "_hit.i as _i", "_hit.at as _at", "_hit.off as _off", "_v")
        .groupBy(*group, "_n", "_i", "_at", "_off", "_v").agg(F.expr("count(1)").alias("_c"))
    )
    if widest > sliver:
        near, _ = narrow(near, group, sliver)

    # Few enough rows for an array: the values that the two ranks fall on.
    found = near.groupBy(*group, "_n", "_i", "_at", "_off").agg(F.expr("""aggregate(
        array_sort(collect_list(struct(_v, _c))), struct(first(_off) as e, cast(null as double) as p, cast(null as double) as q),
        (s, x) -> struct(s.e + x._c as e, if(s.p is null and floor(first(_at)) < s.e + x._c, x._v, s.p) as p,
                         if(s.q is null and ceil(first(_at)) < s.e + x._c, x._v, s.q) as q))""").alias("_r"))
    picked = found.groupBy(*group, "_n").agg(
        *[F.expr(f"max(if(_i = {i}, _r.{x}, null))").alias(f"_{x}{i}") for i in wanted for x in "pq"])
    return picked.selectExpr(*[f"`{k}`" for k in keys], *[
        f"_p{i} + (_q{i} - _p{i}) * ({position[i]} - floor({position[i]})) as `{name}`" for i, name in enumerate(names)
    ])


def quantile_row(
    df: DataFrame, value: str, probabilities: Sequence[float], written: bool = False
) -> tuple[float, ...] | None:
    """Quantiles of a whole column as plain numbers; None when it has no value."""
    names = [f"p{i}" for i in range(len(probabilities))]
    row = group_quantiles(df, [], value, probabilities, names, written=written).first()
    return tuple(row) if row is not None else None
