"""Data-quality reports, schema checks and step counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_missing, missing_count


def quality_report(df: DataFrame) -> DataFrame:
    """One row per column, with the totals of the table beside it.

    Rows are grouped once; duplicates, row count and missing cells all come from the groups.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return _per_column(
        df,
        groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
            F.array(
                *[_column_row(df, c, F.coalesce(F.sum(F.when(is_missing(df, c), F.col("_n"))), F.lit(0))) for c in df.columns]
            ).alias("_all"),
        ),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing cells per column, in one aggregate and without looking for duplicates."""
    return _per_column(
        df,
        df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.array(*[_column_row(df, c, missing_count(df, c)) for c in df.columns]).alias("_all"),
        ),
    )


def _column_row(df: DataFrame, name: str, missing: Column) -> Column:
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
        missing.alias("missing_count"),
    )


def _per_column(df: DataFrame, totals: DataFrame) -> DataFrame:
    kept = [c for c in totals.columns if c != "_all"]
    share = F.try_divide(F.col("missing_count").cast("double"), F.col("total_rows").cast("double"))
    return (
        totals.select(*kept, F.inline("_all"))
        .withColumn("missing_pct", F.coalesce(share * 100, F.lit(0.0)))
        .withColumn("total_columns", F.lit(len(df.columns)))
    )


def completeness(df: DataFrame) -> DataFrame:
    """One row: missing cells in the table and ``(1 - missing / cells) * 100``."""
    missing = sum((missing_count(df, c) for c in df.columns), F.lit(0))
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"), missing.cast("long").alias("missing_cells"))
    cells = (F.col("total_rows") * len(df.columns)).cast("double")
    share = F.try_divide(F.col("missing_cells").cast("double"), cells)
    return totals.withColumn("completeness_pct", (1 - F.coalesce(share, F.lit(0.0))) * 100)


def validate_data(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def validate_schema(df: DataFrame, expected: T.StructType) -> bool:
    """Same columns in the same order with the same types and nullability."""
    return df.schema == expected


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column of either schema: expected, actual and status."""
    actual = {f.name: (i, f) for i, f in enumerate(df.schema.fields)}
    wanted = {f.name: (i, f) for i, f in enumerate(expected.fields)}

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in wanted:
            return "unexpected"
        (i, a), (j, w) = actual[name], wanted[name]
        if a.dataType != w.dataType:
            return "type differs"
        if a.nullable != w.nullable:
            return "nullability differs"
        return "match" if i == j else "position differs"

    def kind(fields: dict, name: str) -> str | None:
        return fields[name][1].dataType.simpleString() if name in fields else None

    rows = [(n, kind(wanted, n), kind(actual, n), status(n)) for n in dict.fromkeys([*wanted, *actual])]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, status string")


def quality_score(df: DataFrame, penalties: Mapping[str, tuple[Column, int]], name: str = "data_quality_score") -> DataFrame:
    """``100 - sum(weight)`` over the violated rules; ``penalties`` maps a rule to (violated, weight)."""
    score = F.lit(100)
    for violated, weight in penalties.values():
        score = score - F.when(violated, F.lit(weight)).otherwise(0)
    return df.withColumn(name, score)


def quality_dimensions(
    df: DataFrame,
    required: Sequence[str],
    valid: Mapping[str, Column],
    consistent: Mapping[str, Column],
    key: Sequence[str],
) -> DataFrame:
    """One row of percentages: completeness, validity, consistency and uniqueness.

    Completeness counts filled required cells, validity and consistency the rules that hold over
    all rows, uniqueness the distinct keys. Rows are grouped by key once, with partial sums before
    the shuffle.
    """

    def held(rules: Mapping[str, Column]) -> Column:
        return sum((F.count_if(F.coalesce(rule, F.lit(False))) for rule in rules.values()), F.lit(0))

    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        sum((F.count_if(~is_missing(df, c)) for c in required), F.lit(0)).alias("_filled"),
        held(valid).alias("_valid"),
        held(consistent).alias("_consistent"),
    )

    def percentage(part: Column, checks: int) -> Column:
        return F.try_divide(part.cast("double"), (F.sum("_rows") * checks).cast("double")) * 100

    return per_key.agg(
        percentage(F.sum("_filled"), len(required)).alias("completeness"),
        percentage(F.sum("_valid"), len(valid)).alias("validity"),
        percentage(F.sum("_consistent"), len(consistent)).alias("consistency"),
        percentage(F.count(F.lit(1)), 1).alias("uniqueness"),
    )


def dataset_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes behind a path, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(
        F.count("path").alias("files"), (F.sum("length") / F.lit(1024.0 * 1024.0)).alias("size_mb")
    )
