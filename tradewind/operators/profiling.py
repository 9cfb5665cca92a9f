"""Profiling of whole tables: nulls, summaries, exact quantiles, outliers, modes, shared columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators import quantiles
from tradewind.session import stored

# percentile_approx with this accuracy is off by at most one part in as many of the row count.
SKETCH_ACCURACY = 100_000


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    skip = set(exclude or [])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def _pairs(pairs: dict[str, Column]) -> Column:
    """``(column_name, value)`` rows from named expressions of one type."""
    return F.inline(
        F.array(*[F.struct(F.lit(name).alias("column_name"), value.alias("value")) for name, value in pairs.items()])
    )


def _held(tables: dict[str, DataFrame], columns: list[tuple[str, str]]) -> dict[str, DataFrame]:
    """The given columns of the tables, written once: several passes go over them, and a table may be a join.

    All tables go into one folder by one job. A task writes rows of one table, so a reader skips the files of others.
    """
    own = {name: [(i, c) for i, (table, c) in enumerate(columns) if table == name] for name in tables}
    own = {name: fields for name, fields in own.items() if fields}
    parts = [
        tables[name].select(F.lit(k).alias("table"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in fields))
        for k, (name, fields) in enumerate(own.items())
    ]
    held = stored(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "profiled")
    return {
        name: held.where(F.col("table") == k).select(*(F.col(f"c{i}").alias(c) for i, c in fields))
        for k, (name, fields) in enumerate(own.items())
    }


def null_counts(df: DataFrame) -> DataFrame:
    """Number of nulls per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.select(_pairs({c: F.col(c) for c in df.columns})).withColumnRenamed("value", "nulls")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every value, most frequent first; nulls are left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), column)
    )


def mode_per_group(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Most frequent value per key for each column, the lowest one on ties; NULL when there is none.

    Values are counted per key and value before a key comes together, so neither a key with very
    many rows nor one with very many distinct values has to fit into one task's memory.
    """
    # One entry per column, with only that column's value set: values keep their type and its order.
    names = [f"_v{i}" for i in range(len(columns))]
    entries = [
        F.struct(
            F.lit(i).alias("_i"),
            *[
                (F.col(c) if i == j else F.lit(None).cast(df.schema[c].dataType)).alias(names[j])
                for j, c in enumerate(columns)
            ],
        )
        for i in range(len(columns))
    ]
    counted = (
        df.select(*keys, F.inline(F.array(*entries)))
        .groupBy(*keys, "_i", *names)
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def winner(i: int, c: str) -> Column:
        # Most frequent, then lowest, as one comparable struct; NULL values never win.
        value = F.col(names[i])
        order = F.struct((-F.col("_n")).alias("n"), value.alias("v"))
        return F.min(F.when((F.col("_i") == i) & value.isNotNull(), order))["v"].alias(c)

    return counted.groupBy(*keys).agg(*[winner(i, c) for i, c in enumerate(columns)])


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: ``column_name, probability, value``. Columns without values give NULL."""
    names = [("", c) for c in columns]
    tables = _held({"": df}, names)
    found = quantiles.summaries(quantiles.long_form(tables, names), len(names))
    values = quantiles.quantiles(tables, names, found, probabilities)
    rows = [(columns[i], float(p), value) for (i, p), value in values.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, probability double, value double")


def _sketched(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """``column_name`` and an array of the quantiles of bounded sketches."""
    arrays = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probabilities, SKETCH_ACCURACY).alias(c) for c in columns])
    return arrays.select(_pairs({c: F.col(c) for c in columns}))


def bounds_of_tables(tables: dict[str, DataFrame], exclude: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Per numeric column of each table the quartiles and the bounds 1.5 interquartile ranges outside them."""
    columns = [(name, c) for name, df in tables.items() for c in numeric_columns(df, exclude)]
    held = tables if approximate or not columns else _held(tables, columns)
    return _bounds(next(iter(tables.values())).sparkSession, held, columns, approximate)


def _bounds(spark: SparkSession, tables: dict[str, DataFrame], columns: list[tuple[str, str]], approximate: bool) -> DataFrame:
    schema = "table_name string, column_name string, q1 double, q3 double"
    if not columns:
        quartiles = spark.createDataFrame([], schema)
    elif approximate:
        parts = [
            _sketched(df, own, [0.25, 0.75]).select(F.lit(name).alias("table_name"), "column_name", F.col("value")[0].alias("q1"), F.col("value")[1].alias("q3"))
            for name, df in tables.items()
            if (own := [c for table, c in columns if table == name])
        ]
        quartiles = reduce(DataFrame.unionByName, parts)
    else:
        found = quantiles.summaries(quantiles.long_form(tables, columns), len(columns))
        values = quantiles.quantiles(tables, columns, found, [0.25, 0.75])
        quartiles = spark.createDataFrame([(*c, values[i, 0.25], values[i, 0.75]) for i, c in enumerate(columns)], schema)
    iqr = F.col("q3") - F.col("q1")
    return quartiles.withColumn("lower_bound", F.col("q1") - 1.5 * iqr).withColumn("upper_bound", F.col("q3") + 1.5 * iqr)


def outlier_bounds(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Per column the quartiles and the bounds 1.5 interquartile ranges outside them."""
    return bounds_of_tables({"": df.select(*columns)}, approximate=approximate).drop("table_name")


def outlier_rows(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Rows of the table whose value lies outside the bounds, with the bounds."""
    limits = outlier_bounds(df, [column], approximate).select(F.struct("lower_bound", "upper_bound"))
    value = F.col(column).cast("double")
    return (
        df.withColumn("_limits", limits.scalar())
        .where((value < F.col("_limits.lower_bound")) | (value > F.col("_limits.upper_bound")))
        .select(*df.columns, "_limits.lower_bound", "_limits.upper_bound")
    )


def outliers_of_tables(tables: dict[str, DataFrame], exclude: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Bounds and number of outliers for every numeric column of each table that is not an identifier.

    The columns of all tables are profiled together, and counted in one pass.
    """
    columns = [(name, c) for name, df in tables.items() for c in numeric_columns(df, exclude)]
    spark = next(iter(tables.values())).sparkSession
    if not columns:
        return spark.createDataFrame([], "table_name string, column_name string, lower_bound double, upper_bound double, outliers bigint")
    tables = _held(tables, columns)
    numbers = spark.createDataFrame([(i, *c) for i, c in enumerate(columns)], "id int, table_name string, column_name string")
    limits = _bounds(spark, tables, columns, approximate).join(numbers, ["table_name", "column_name"])
    outside = (F.col("x") < F.col("lower_bound")) | (F.col("x") > F.col("upper_bound"))
    return (
        quantiles.long_form(tables, columns)
        .join(F.broadcast(limits), "id")  # one row per column
        .groupBy("table_name", "column_name", "lower_bound", "upper_bound")
        .agg(F.count_if(outside).alias("outliers"))
    )


def outliers(df: DataFrame, exclude: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Bounds and number of outliers for every numeric column that is not an identifier."""
    return outliers_of_tables({"": df}, exclude, approximate).drop("table_name")


_QUARTERS = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
_DESCRIPTION = (
    "table_name string, column_name string, count bigint, unique bigint, top string, freq bigint, "
    "mean double, std double, min double, q25 double, q50 double, q75 double, max double"
)


def describe_tables(tables: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    """One row per column of each table: count, distinct values, top value and its frequency for non-numeric
    columns; mean, deviation, minimum, quartiles and maximum for numeric ones. All columns are summarised together."""
    spark = next(iter(tables.values())).sparkSession
    columns = [(name, c) for name, df in tables.items() for c in numeric_columns(df)]
    kinds = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    others = {name: [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)] for name, df in tables.items()}
    described = columns + [(name, c) for name, own in others.items() for c in own]
    if described:
        tables = tables | _held(tables, described)
    rows = []
    if columns:
        found = quantiles.summaries(quantiles.long_form(tables, columns), len(columns))
        if approximate:
            values = {}
            for name, df in tables.items():
                own = [i for i, (table, _) in enumerate(columns) if table == name]
                for row in _sketched(df, [columns[i][1] for i in own], list(_QUARTERS.values())).collect() if own else ():
                    values |= {(columns.index((name, row["column_name"])), p): v for p, v in zip(_QUARTERS.values(), row["value"] or [None] * 3)}
        else:
            values = quantiles.quantiles(tables, columns, found, list(_QUARTERS.values()))
        for i, s in enumerate(found):
            rows.append((*columns[i], s.count, None, None, None, s.mean, s.std, s.least, *(values[i, p] for p in _QUARTERS.values()), s.most))
    parts = [spark.createDataFrame(rows, _DESCRIPTION)]
    texts = [
        tables[name].select(F.lit(name).alias("table_name"), _pairs({c: F.col(c).cast("string") for c in own}))
        for name, own in others.items()
        if own
    ]
    if texts:
        counted = reduce(DataFrame.unionByName, texts).groupBy("table_name", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        real = F.col("value").isNotNull()
        best = F.min(F.when(real, F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))))
        empty = [F.lit(None).cast("double").alias(s) for s in ["mean", "std", "min", *_QUARTERS, "max"]]
        parts.append(
            counted.groupBy("table_name", "column_name")
            .agg(
                F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("count"),
                F.count_if(real).alias("unique"),
                best.alias("best"),
            )
            .select(
                "table_name", "column_name", "count", "unique", F.col("best.v").alias("top"), (-F.col("best.n")).alias("freq"), *empty
            )
        )
    return reduce(DataFrame.unionByName, parts)


def describe(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``describe_tables`` for one table."""
    return describe_tables({"": df}, approximate).drop("table_name")


def type_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared type of every column of every table; reads schemas only."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, column_name string, type string")


def shared_columns(pairs: list[tuple[str, DataFrame, str, DataFrame]]) -> list[tuple[str, str, str]]:
    """Column names two tables have in common, as ``(left, right, column)``; reads schemas only."""
    return [
        (left, right, column)
        for left, a, right, b in pairs
        for column in sorted(set(a.columns) & set(b.columns))
    ]


def inclusion(pairs: list[tuple[str, DataFrame, str, DataFrame]]) -> DataFrame:
    """For every shared column: how many distinct left values there are and how many occur on the right."""
    parts = []
    for left, a, right, b, column in [(*p, c) for p in pairs for _, _, c in shared_columns([p])]:
        values = a.select(column).where(F.col(column).isNotNull()).distinct()
        known = b.select(F.col(column).alias("_known")).where(F.col("_known").isNotNull()).distinct()
        parts.append(
            values.join(known, F.col(column) == F.col("_known"), "left")
            .agg(F.count(F.lit(1)).alias("left_values"), F.count("_known").alias("matched_values"))
            .select(
                F.lit(left).alias("left_table"),
                F.lit(right).alias("right_table"),
                F.lit(column).alias("column_name"),
                "left_values",
                "matched_values",
            )
        )
    return reduce(DataFrame.unionByName, parts)
