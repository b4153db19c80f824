"""Aggregation building blocks: share of total (A10), membership flag (J4),
exact interpolated quantiles with bounded memory (A8)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, measure: str, out: str = "pct", digits: int = 1) -> DataFrame:
    """``round_half_even(measure / total * 100, digits)``.

    The grand total is a scalar subquery over ``df`` (one partial-aggregated
    row), not an unpartitioned window, so the rows stay distributed.
    """
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(out, F.bround(F.col(measure) / total * 100, digits))


def member_flag(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``(k1, k2) IN (SELECT k1, k2 FROM members)`` as a boolean column.

    Members are reduced to distinct keys first, then left-joined; when ``df``
    is already partitioned on ``keys`` (an aggregate by them), the join reuses
    that partitioning.
    """
    m = members.select(*keys).dropna(subset=list(keys)).distinct().withColumn(flag, F.lit(True))
    return (df.join(m, list(keys), "left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    accuracy: int = 10000, margin: float = 3.0, ranges: int = 32) -> Column:
    """Exact, linearly interpolated quantiles (``quantile_cont``) of ``col``, as
    ONE literal ``array<double>`` in the order of ``probs`` (nulls where there
    are no values).

    Spark's exact ``percentile`` merges every distinct value into one task.
    Here a few passes over the values, each a partial aggregation of which only
    a bounded number of figures reaches the driver; give a ``df`` that is cheap
    to read again (a stored table):

    1. a sketch (``percentile_approx``, rank error <= n/accuracy) brackets
       each target rank between values a <= v <= b;
    2. exact counts verify that each bracket holds both ranks the
       interpolation needs; a side that does not (possible only for small n)
       is opened up, so the result is always exact;
    3. the values inside a bracket (about 2*margin*n/accuracy, all of them
       where it was opened) are cut into ``ranges`` by a sketch of their own,
       each range is counted, and running sums of the counts tell which range
       holds the rank;
    4. only that range's values are ranked, from its first rank on, with ties
       collapsed.  A range is the largest group of the only window.

    Memory per task is bounded by ``accuracy`` and a range, not by n.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where("x is not null")
    v = F.col("x")
    edges = [e for q in probs for e in (max(q - margin / accuracy, 0.0), min(q + margin / accuracy, 1.0))]
    n, e = x.agg(F.count(F.lit(1)), F.percentile_approx("x", edges, accuracy)).first()
    if not n:
        return F.lit(None).cast("array<double>") if not probs else F.array(*[F.lit(None).cast("double") for _ in probs])
    found = x.agg(*[F.count_if(v < a) for a in e[::2]], *[F.count_if(v <= b) for b in e[1::2]]).first()
    targets = []
    for i, q in enumerate(probs):
        place = float(q) * (n - 1)
        low, high = math.floor(place), math.ceil(place)
        below, upto = found[i], found[len(probs) + i]
        lower, upper = (e[2 * i] if below <= low else None), (e[2 * i + 1] if upto > high else None)
        targets.append({"i": i, "lower": lower, "upper": upper, "low": low, "high": high, "frac": place - low,
                        "below": below if lower is not None else 0})

    def inside(t):
        return F.lit(True) & (v >= t["lower"] if t["lower"] is not None else F.lit(True)) \
            & (v <= t["upper"] if t["upper"] is not None else F.lit(True))

    # 3. ranges of the bracketed values; a value counts for each target whose bracket holds it
    hits = x.select("x", F.explode(F.filter(F.array(*[F.when(inside(t), F.lit(t["i"])) for t in targets]), lambda i: i.isNotNull())).alias("i"))
    steps = [j / ranges for j in range(1, ranges)]
    cuts = {r["i"]: sorted(set(r["e"])) for r in hits.groupBy("i").agg(F.percentile_approx("x", steps, 40 * ranges).alias("e")).collect()}
    numbers = F.array(*[F.array(*[F.lit(c) for c in cuts[t["i"]]]) for t in targets])
    ranged = hits.select("i", "x", F.size(F.filter(F.get(numbers, F.col("i")), lambda c: c < v)).alias("r"))
    chosen, start = [], F.lit(None).cast("long")
    counts: dict = {t["i"]: [] for t in targets}
    for r in ranged.groupBy("i", "r").count().collect():                 # at most ``ranges`` rows for each target
        counts[r["i"]].append((r["r"], r["count"]))
    for t in targets:
        at = t["below"]
        for r, c in sorted(counts[t["i"]]):
            if at <= t["high"] and at + c > t["low"]:
                here = (F.col("i") == t["i"]) & (F.col("r") == r)
                chosen.append(here)
                start = F.when(here, F.lit(at)).otherwise(start)
            at += c

    # 4. rank the values of the chosen ranges (two for a target whose ranks fall on both sides of a cut)
    grouped = ranged.where(reduce(lambda a, b: a | b, chosen)).groupBy("i", "r", "x").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("i", "r").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = grouped.withColumn("cum", start + upto)
    pick = lambda which: F.get(F.array(*[F.lit(t[which]) for t in targets]), F.col("i"))
    ends = {r["i"]: (r["lo"], r["hi"]) for r in ranked.groupBy("i").agg(
        F.min(F.when(F.col("cum") > pick("low"), v)).alias("lo"), F.min(F.when(F.col("cum") > pick("high"), v)).alias("hi")).collect()}
    return F.array(*[F.lit(lo + t["frac"] * (hi - lo)) for t in targets for lo, hi in [ends[t["i"]]]])
