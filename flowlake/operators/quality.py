"""Data-quality profiles. Every profile is one aggregate over one scan, then a tiny unpivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.columns import FLOATS, NUMBERS, columns_of
from flowlake.functions.safe import finite_or_null, is_infinite, quoted


def is_missing(field: T.StructField) -> Column:
    """Null; for floats also NaN; for text also the empty string and the text of a NaN."""
    col = quoted(field.name)
    if isinstance(field.dataType, FLOATS):
        return col.isNull() | F.isnan(col)
    if isinstance(field.dataType, T.StringType):
        return col.isNull() | (col == "") | (F.lower(F.trim(col)) == "nan")
    return col.isNull()


def _stacked(wide: DataFrame, structs: list[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*structs)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent; 0 for an empty whole."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits), F.lit(0.0))


def basic_stats(df: DataFrame) -> DataFrame:
    """Rows, columns and the number of columns per type, as ``(metric, value)``."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    fixed = [("total_columns", len(df.columns)), *[(f"dtype:{k}", n) for k, n in sorted(kinds.items())]]
    rows = [F.struct(F.lit("total_rows").alias("metric"), F.col("_rows").alias("value"))]
    rows += [F.struct(F.lit(m).alias("metric"), F.lit(n).cast("long").alias("value")) for m, n in fixed]
    return _stacked(df.agg(F.count(F.lit(1)).alias("_rows")), rows)


def missing_values(df: DataFrame, digits: int = 2) -> DataFrame:
    """Missing cells per column: ``column_name, missing_count, missing_pct``, most affected first."""
    fields = df.schema.fields
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(f)).alias(f"m{i}") for i, f in enumerate(fields)],
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f"m{i}").alias("missing_count"),
            percent(F.col(f"m{i}"), F.col("_rows"), digits).alias("missing_pct"),
        )
        for i, f in enumerate(fields)
    ]
    return _stacked(wide, rows).orderBy(F.desc("missing_count"), "column_name")


def missing_top(df: DataFrame, k: int = 20, digits: int = 2) -> DataFrame:
    """The ``k`` columns with the most missing cells; complete columns are left out."""
    return missing_values(df, digits).filter("missing_count > 0").limit(k)


def completeness(df: DataFrame, digits: int = 4) -> DataFrame:
    """Share of non-null cells per column, in percent, least complete first."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            percent(F.col(f"c{i}"), F.col("_rows"), digits).alias("completeness_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return _stacked(wide, rows).orderBy("completeness_pct", "column_name")


def duplicates(df: DataFrame, digits: int = 2) -> DataFrame:
    """Total, distinct and surplus rows: one shuffle of map-side folded rows."""
    totals = (
        df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows"))
    )
    surplus = F.col("total_rows") - F.col("distinct_rows")
    return totals.select(
        "total_rows", "distinct_rows", surplus.alias("duplicate_rows"),
        percent(surplus, F.col("total_rows"), digits).alias("duplicate_pct"),
    )


def frequency(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count and percentage per value, most frequent first, ties by value.

    The total comes from the same aggregated rows (the shuffle is reused), not from a second scan.
    """
    counts = df.groupBy(quoted(column).alias(column)).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return (
        counts.withColumn("percentage", percent(F.col("count"), total, digits))
        .orderBy(F.desc("count"), F.asc_nulls_last(column))
    )


def class_distribution(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Frequencies of several label columns in one scan: ``column_name, class_value, count, percentage``.

    Labels are few-valued, so their combinations are: the scan is folded to those first.
    """
    combos = df.groupBy(*[quoted(c).cast("string").alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("class_value")) for c in columns
    ])
    counts = (
        combos.select("_n", F.inline(pairs))
        .groupBy("column_name", "class_value").agg(F.sum("_n").alias("count"))
    )
    total = combos.agg(F.sum("_n")).scalar()
    return (
        counts.withColumn("percentage", percent(F.col("count"), total, digits))
        .orderBy("column_name", F.desc("count"), "class_value")
    )


def long_stats(df: DataFrame, columns: list[str] | None = None, finite: bool = False) -> DataFrame:
    """``column_name, n, mean, stddev, min_value, max_value`` for numeric columns, one aggregate.

    ``finite`` leaves NaN and infinities out; otherwise they spread into mean and stddev.
    """
    names = columns_of(df, NUMBERS) if columns is None else columns
    values = [quoted(c).cast("double") for c in names]
    if finite:
        values = [finite_or_null(v) for v in values]
    measures = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min_value": F.min, "max_value": F.max}
    wide = df.agg(*[
        f(v).alias(f"{m}{i}") for i, v in enumerate(values) for m, f in measures.items()
    ])
    return _stacked(wide, [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{m}{i}").alias(m) for m in measures])
        for i, c in enumerate(names)
    ])


def infinities(df: DataFrame) -> DataFrame:
    """Float columns that hold infinities, with their number."""
    names = columns_of(df, FLOATS)
    wide = df.agg(*[F.count_if(is_infinite(quoted(c))).alias(f"i{k}") for k, c in enumerate(names)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"i{k}").alias("infinity_count"))
        for k, c in enumerate(names)
    ]
    return _stacked(wide, rows).filter("infinity_count > 0").orderBy(F.desc("infinity_count"), "column_name")


def table_kpi(df: DataFrame, label: str, digits: int = 4) -> DataFrame:
    """One row: rows, columns, classes, null or NaN cells and their share."""
    gaps = [
        quoted(f.name).isNull() | F.isnan(quoted(f.name)) if isinstance(f.dataType, FLOATS) else quoted(f.name).isNull()
        for f in df.schema.fields
    ]
    width = len(df.columns)
    per_row = sum((g.cast("long") for g in gaps[1:]), gaps[0].cast("long"))
    # Folded to one row per class first: the distinct count then needs no second shuffle of rows.
    per_class = df.groupBy(quoted(label).alias("_class")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(per_row).alias("_gaps")
    )
    return per_class.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.lit(width).cast("long").alias("total_columns"),
        F.count("_class").alias("classes"),
        F.coalesce(F.sum("_gaps"), F.lit(0)).alias("missing_cells"),
    ).withColumn("missing_pct", percent(F.col("missing_cells"), F.col("total_rows") * width, digits))


def gate(df: DataFrame, names: list[str]) -> DataFrame:
    """Presence and completeness of required columns: ``column_name, present, null_count, passed``."""
    have = [c for c in names if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(quoted(c).isNull()).alias(f"g_{c}") for c in have])
    rows = []
    for c in names:
        nulls = F.col(f"g_{c}") if c in have else F.lit(None).cast("long")
        rows.append(F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in have).alias("present"),
            nulls.alias("null_count"),
            (F.coalesce(nulls, F.lit(1)) == 0).alias("passed"),
        ))
    return _stacked(wide, rows)


def require(df: DataFrame, names: list[str]) -> DataFrame:
    """Pass ``df`` through, or raise naming the columns that fail ``gate``."""
    failed = [r["column_name"] for r in gate(df, names).filter("not passed").collect()]
    if failed:
        raise ValueError(f"missing or incomplete columns: {failed}")
    return df


def cell_measures(fields: list[T.StructField]) -> dict[str, Column]:
    """The aggregates behind the cell-level checks: rows, missing cells ``m<i>`` per column, infinities ``i<i>`` per float column,
    and per numeric column ``n<i>``, ``s<i>`` (sum), ``lo<i>``, ``hi<i>`` of the finite values."""
    floats = [f.name for f in fields if isinstance(f.dataType, FLOATS)]
    numbers = [f.name for f in fields if isinstance(f.dataType, NUMBERS)]
    finite = {c: finite_or_null(quoted(c).cast("double")) for c in numbers}
    return {
        "_rows": F.count(F.lit(1)),
        **{f"m{i}": F.count_if(is_missing(f)) for i, f in enumerate(fields)},
        **{f"i{i}": F.count_if(is_infinite(quoted(c))) for i, c in enumerate(floats)},
        **{f"{m}{i}": f(finite[c]) for i, c in enumerate(numbers) for m, f in {"n": F.count, "s": F.sum, "lo": F.min, "hi": F.max}.items()},
    }


def assembled(cells: DataFrame, fields: list[T.StructField], dup: DataFrame, classes: DataFrame, digits: int = 2) -> DataFrame:
    """The report from its three parts: one row of ``cell_measures``, the duplicates, and the class counts."""
    def rows(frame, check, item, metrics):
        return frame.select(
            F.lit(check).alias("check"), item.alias("item"),
            F.inline(F.array(*[
                F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
            ])),
        )

    def cell(check, item, metric, value):
        return F.struct(
            F.lit(check).alias("check"), F.lit(item).alias("item"), F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
        )

    floats = [f.name for f in fields if isinstance(f.dataType, FLOATS)]
    numbers = [f.name for f in fields if isinstance(f.dataType, NUMBERS)]
    entries = [
        cell("basic", "table", "total_rows", F.col("_rows")),
        cell("basic", "table", "total_columns", F.lit(len(fields))),
    ]
    for i, f in enumerate(fields):
        entries.append(cell("missing", f.name, "missing_count", F.col(f"m{i}")))
        entries.append(cell("missing", f.name, "missing_pct", percent(F.col(f"m{i}"), F.col("_rows"), digits)))
    entries += [cell("infinity", c, "infinity_count", F.col(f"i{i}")) for i, c in enumerate(floats)]
    for i, c in enumerate(numbers):
        entries += [
            cell("numeric", c, "mean", F.try_divide(F.col(f"s{i}"), F.col(f"n{i}").cast("double"))),
            cell("numeric", c, "min_value", F.col(f"lo{i}")),
            cell("numeric", c, "max_value", F.col(f"hi{i}")),
        ]
    dup_rows = rows(dup, "duplicates", F.lit("table"), ["total_rows", "distinct_rows", "duplicate_rows", "duplicate_pct"])
    class_rows = rows(classes, "classes", F.concat_ws("=", "column_name", F.coalesce("class_value", F.lit("null"))), ["count", "percentage"])
    return _stacked(cells, entries).unionByName(dup_rows).unionByName(class_rows)


def report(df: DataFrame, labels: list[str], digits: int = 2) -> DataFrame:
    """All checks as ``(check, item, metric, value)`` rows: one scan for cell-level checks, one shuffle
    for duplicates and one for class counts. ``profiles`` keeps the same by day."""
    fields = df.schema.fields
    cells = df.agg(*[column.alias(name) for name, column in cell_measures(fields).items()])
    return assembled(cells, fields, duplicates(df, digits), class_distribution(df, labels, digits), digits)
