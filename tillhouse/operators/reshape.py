"""Reshaping of small, already-aggregated results (R1-R4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def axis_array(axis_values: DataFrame, axis: str) -> Column:
    """The (small, bounded) axis values as one sorted array: a scalar subquery."""
    return axis_values.agg(F.array_sort(F.collect_set(axis))).scalar()


def series(facts: DataFrame, entity: str, axis: str, measure: str, axis_values: DataFrame,
           fill=0, axis_out: str = "months", measure_out: str = "data") -> DataFrame:
    """One row per entity of ``facts``: the axis values and the measure per value
    as arrays in axis order, ``fill`` where the entity has no row (R2).

    ``facts`` has one row per (entity, axis value); ``axis_values`` is small
    and bounded (e.g. the last 6 months).  One aggregation per entity collects
    only the cells on the axis into a map (at most len(axis) entries), which
    is then read out in axis order - no cross join, no second pass.  Entities
    with no cell on the axis are kept (all ``fill``).
    """
    axes = F.col("_axes")
    cell = F.when(F.array_contains(axes, F.col(axis)), F.struct(F.col(axis), F.col(measure)))
    per = (facts.select(entity, axis, measure, axis_array(axis_values, axis).alias("_axes"))
                .groupBy(entity)
                .agg(F.first("_axes").alias("_axes"), F.map_from_entries(F.collect_list(cell)).alias("_m")))
    fill_value = F.lit(fill).cast(facts.schema[measure].dataType)
    return per.select(entity, axes.alias(axis_out),
                      F.transform(axes, lambda a: F.coalesce(F.try_element_at(F.col("_m"), a), fill_value))
                       .alias(measure_out))


def densify(facts: DataFrame, entity: str, axis: str, measure: str, axis_values: DataFrame,
            fill=0) -> DataFrame:
    """Every (entity, axis value) cell, missing measure = ``fill`` (R1): the
    series exploded back into rows."""
    s = series(facts, entity, axis, measure, axis_values, fill, "_a", "_v")
    return s.select(entity, F.inline(F.arrays_zip(F.col("_a").alias(axis), F.col("_v").alias(measure))))


def pivot_wide(df: DataFrame, group: Sequence[str], pivot_col: str, values: Sequence,
               measures: dict[str, str], fill=0) -> DataFrame:
    """Pivot ``pivot_col`` (a fixed list of values) into columns.

    ``measures`` maps a measure column to a name template with ``{v}``; numeric
    cells without a row become ``fill``.  Values are listed up front, so Spark
    needs no extra pass to discover them.
    """
    aggs = [F.first(F.col(m), ignorenulls=True).alias(m) for m in measures]
    p = df.groupBy(*group).pivot(pivot_col, list(values)).agg(*aggs)
    out = list(group)
    for v in values:
        for m, tmpl in measures.items():
            src = f"{v}_{m}" if len(measures) > 1 else str(v)
            c = F.col(f"`{src}`")
            if df.schema[m].dataType.typeName() not in ("string",):
                c = F.coalesce(c, F.lit(fill).cast(df.schema[m].dataType))
            out.append(c.alias(tmpl.format(v=v)))
    return p.select(*[F.col(c) if isinstance(c, str) else c for c in out])
