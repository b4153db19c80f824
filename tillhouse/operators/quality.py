"""Data-quality checks (Q1-Q4). Each returns rows
``(model, column, check, failures bigint)``; 0 failures means the check passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ["model", "column", "check", "failures"]


def _row(df: DataFrame, model: str, column: str, check: str, failures) -> DataFrame:
    return df.select(F.lit(model).alias("model"), F.lit(column).alias("column"),
                     F.lit(check).alias("check"), failures.cast("long").alias("failures"))


def not_null(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    """NULL counts of all ``cols`` in a single pass over ``df``."""
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"_n{i}")
                      for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(c).alias("column"),
                              F.lit("not_null").alias("check"),
                              F.coalesce(F.col(f"_n{i}"), F.lit(0)).cast("long").alias("failures"))
                     for i, c in enumerate(cols)])
    return counts.select(F.inline(rows))


def unique(df: DataFrame, model: str, cols: Sequence[str] | str) -> DataFrame:
    """Number of non-NULL values (or key tuples) seen more than once."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    dup = df.where(nn).groupBy(*cols).count().where(F.col("count") > 1)
    return _row(dup.agg(F.count(F.lit(1)).alias("f")), model, ",".join(cols), "unique", F.col("f"))


def relationships(child: DataFrame, model: str, child_cols: Sequence[str] | str,
                  parent: DataFrame, parent_cols: Sequence[str] | str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (single or composite key).

    Child keys are counted per key first (partial aggregation collapses a hot
    foreign key before the shuffle), then anti-joined with the distinct parent
    keys; the failing row count is the sum of the orphan keys' counts.
    """
    cc = [child_cols] if isinstance(child_cols, str) else list(child_cols)
    pc = [parent_cols] if isinstance(parent_cols, str) else list(parent_cols)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cc])
    keys = child.where(nn).groupBy(*cc).agg(F.count(F.lit(1)).alias("_n"))
    p = parent.select(*[F.col(p_).alias(c) for p_, c in zip(pc, cc)]).distinct()
    orphans = keys.join(p, cc, "left_anti")
    return _row(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("f")), model, ",".join(cc),
                "relationships", F.col("f"))


def accepted_values(df: DataFrame, model: str, col: str, values: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values outside ``values``."""
    bad = df.select(col).where(F.col(col).isNotNull() & ~F.col(col).isin(list(values))).distinct()
    return _row(bad.agg(F.count(F.lit(1)).alias("f")), model, col, "accepted_values", F.col("f"))


def nulls_and_values(df: DataFrame, model: str, cols: Sequence[str], accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """``not_null`` of ``cols`` and ``accepted_values`` of every column of
    ``accepted`` in one scan of ``df``.

    Rows are grouped by their unexpected values (none, for most) while the nulls
    are counted: the groups are combined before the shuffle and spread over it,
    however many different unexpected values there are."""
    cols, names = list(cols), list(accepted)
    bad = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(accepted[c])), F.col(c)).alias(f"_u{i}") for i, c in enumerate(names)]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    grouped = df.groupBy(*bad).agg(*(nulls or [F.count(F.lit(1)).alias("_rows")]))
    distinct = F.count if len(names) == 1 else F.count_distinct       # one column: a group for each value
    totals = grouped.agg(*[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(cols))],
                         *[distinct(f"_u{i}").alias(f"u{i}") for i in range(len(names))])
    cells = ([(c, "not_null", f"n{i}") for i, c in enumerate(cols)]
             + [(c, "accepted_values", f"u{i}") for i, c in enumerate(names)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c).alias("column"), F.lit(check).alias("check"),
                 F.col(f).cast("long").alias("failures")) for c, check, f in cells])))


def orphans(child: DataFrame, model: str, relations: Sequence[tuple]) -> DataFrame:
    """``relationships`` of all ``relations`` (child columns, parent, parent
    columns) in one scan of ``child``: its distinct key tuples with their counts
    meet each parent's distinct keys in an outer join that leaves a flag."""
    rels = [(_list(cc), parent, _list(pc)) for cc, parent, pc in relations]
    keys = list(dict.fromkeys(c for cc, _, _ in rels for c in cc))
    met = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    for i, (cc, parent, pc) in enumerate(rels):
        p = parent.select(*[F.col(b).alias(f"_p{i}_{k}") for k, b in enumerate(pc)]).dropna().distinct().withColumn(f"_has{i}", F.lit(True))
        met = met.join(p, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}_{k}") for k, c in enumerate(cc)]), "left")

    def lost(i, cc):
        full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cc])
        return F.coalesce(F.sum(F.when(full & F.col(f"_has{i}").isNull(), F.col("_n"))), F.lit(0)).cast("long")

    totals = met.agg(*[lost(i, cc).alias(f"f{i}") for i, (cc, _, _) in enumerate(rels)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(",".join(cc)).alias("column"), F.lit("relationships").alias("check"),
                 F.col(f"f{i}").alias("failures")) for i, (cc, _, _) in enumerate(rels)])))


def _list(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def failing_rows(df: DataFrame, check: str, cols, values: Sequence[str] = (), parent: DataFrame | None = None, parent_cols=None) -> DataFrame:
    """The rows of ``df`` that make one check fail, all columns."""
    cc = _list(cols)
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cc])
    if check == "not_null":
        return df.where(~full)
    if check == "accepted_values":
        return df.where(full & ~F.col(cc[0]).isin(list(values)))
    if check == "unique":
        other = df.where(full).groupBy(*cc).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return df.join(other.select(*cc), cc, "left_semi").select(*df.columns)
    if check == "relationships":
        other = parent.select(*[F.col(b).alias(a) for a, b in zip(cc, _list(parent_cols or cols))]).distinct()
        return df.where(full).join(other, cc, "left_anti").select(*df.columns)
    raise ValueError(check)


@dataclass
class ModelChecks:
    """The checks declared for one model."""
    not_null: list[str] = field(default_factory=list)
    unique: list = field(default_factory=list)
    relationships: list = field(default_factory=list)   # (child cols, parent model, parent cols)
    accepted_values: dict = field(default_factory=dict)  # col -> values


def shared_models(specs: Sequence[Mapping[str, ModelChecks]]) -> dict[str, list[str]]:
    """Models that more than one scan of ``run_suite`` reads, with the columns
    that the checks of ``specs`` name."""
    scans: dict[str, int] = {}
    columns: dict[str, dict] = {}

    def use(model, cols, n=1):
        scans[model] = scans.get(model, 0) + n
        columns.setdefault(model, {}).update(dict.fromkeys(cols))

    for spec in specs:
        for name, chk in spec.items():
            if chk.not_null or chk.accepted_values:
                use(name, [*chk.not_null, *chk.accepted_values])
            for u in chk.unique:
                use(name, _list(u))
            if chk.relationships:
                use(name, [c for cc, _, _ in chk.relationships for c in _list(cc)])
                for _, parent, pc in chk.relationships:
                    use(parent, _list(pc))
    return {m: list(columns[m]) for m, n in scans.items() if n > 1}


def run_suite(models: dict[str, DataFrame], spec: dict[str, ModelChecks]) -> DataFrame:
    """All checks of ``spec`` over ``models`` as one DataFrame: a scan of each
    model for its nulls and values, one for all its parents, one for each
    unique key."""
    parts = []
    for name, chk in spec.items():
        df = models[name]
        if chk.not_null or chk.accepted_values:
            parts.append(nulls_and_values(df, name, chk.not_null, chk.accepted_values))
        for u in chk.unique:
            parts.append(unique(df, name, u))
        if chk.relationships:
            parts.append(orphans(df, name, [(cc, models[parent], pc) for cc, parent, pc in chk.relationships]))
    return reduce(DataFrame.unionByName, parts)
