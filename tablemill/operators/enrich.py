"""Reference joins, referential checks, business rules and merged records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    is_missing,
    normalize_phone,
    normalize_status,
    normalize_whitespace,
    standard_id,
    string_columns,
)
from .joins import BROADCAST_ROWS, broadcast_if_small
from .profiling import quality_score


def enrich(df: DataFrame, reference: DataFrame, on: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Add columns of ``reference`` by key and keep rows without a match.

    The planner picks the join from measured sizes, and splits hot keys of a shuffled join.
    """
    added = [c for c in (columns or reference.columns) if c not in on]
    return df.join(reference.select(*on, *added), list(on), "left")


def lookup(df: DataFrame, dimension: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``enrich`` with a dimension that is broadcast once it is counted to be small."""
    return df.join(broadcast_if_small(dimension, max_rows), list(on), "left")


def rollup_children(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, aggregates: Mapping[str, Column]
) -> DataFrame:
    """Add aggregates of the related child rows to each parent; the child shrinks before the join."""
    totals = child.groupBy(F.col(child_key).alias("_key")).agg(*[a.alias(n) for n, a in aggregates.items()])
    return parent.join(totals, parent[parent_key] == totals["_key"], "left").drop("_key")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but absent from the parent."""
    keys = parent.select(F.col(parent_key).alias("_key"))
    return child.filter(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_key"), "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """One row per foreign key: orphan rows and orphan keys. Child rows shrink to counts per key first."""
    counts = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("_n"))
    return orphans(counts, parent, child_key, parent_key).agg(
        F.lit(child_key).alias("foreign_key"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reasons``: the names of the rules that do not hold; NULL counts as a failure."""
    failed = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*failed)))


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others with their reasons."""
    checked = check_rules(df, rules)
    passed = F.size("reject_reasons") == 0
    return checked.filter(passed).drop("reject_reasons"), checked.filter(~passed)


def golden_record(df: DataFrame, match_keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Merge rows with the same match key: per column the first value that is not missing.

    ``imputed_cells`` counts the cells that did not come from the first row. The merge is one
    aggregate with partial results, so a large group never meets in one task.
    """
    order = F.struct(*order_by)
    others = [c for c in df.columns if c not in match_keys]
    gaps = F.struct(*[is_missing(df, c).alias(c) for c in others])
    merged = df.groupBy(*match_keys).agg(
        *[F.min_by(c, F.when(~is_missing(df, c), order)).alias(c) for c in others],
        F.min_by(gaps, order).alias("_gaps"),
    )
    imputed = sum(((F.col("_gaps")[c] & F.col(c).isNotNull()).cast("int") for c in others), F.lit(0))
    return merged.select(*df.columns, imputed.alias("imputed_cells"))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_columns(df: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(expressions))


# Column names and penalties of the standard customer table.
CUSTOMER_NAMES = {
    "name": "customer_name",
    "email": "email_address",
    "status": "customer_status",
    "phone": "phone_number",
    "address": "full_address",
    "amount": "transaction_amount",
}
IMPUTED_PENALTY, MISSING_ADDRESS_PENALTY, ZERO_AMOUNT_PENALTY = 2, 10, 5


def standardize_customers(df: DataFrame, processed_date: Column) -> DataFrame:
    """Merge duplicate customers, normalise id, phone, status and whitespace, rename, score.

    Customers match on name, address and amount. Rows missing the name or the address match
    nothing but themselves.
    """
    tidy = df.withColumns({c: F.nullif(normalize_whitespace(c), F.lit("")) for c in string_columns(df)})
    alone = F.when(F.col("name").isNull() | F.col("address").isNull(), F.col("customer_id"))
    merged = golden_record(tidy.withColumn("_alone", alone), ["name", "address", "amount", "_alone"], ["customer_id"])
    normalized = merged.drop("_alone").withColumns(
        {
            "customer_id": standard_id("customer_id"),
            "phone": normalize_phone("phone"),
            "status": normalize_status("status"),
            "processed_date": processed_date,
        }
    )
    penalties = {
        "imputed": (F.col("imputed_cells") > 0, IMPUTED_PENALTY),
        "missing address": (F.col("address").isNull(), MISSING_ADDRESS_PENALTY),
        "zero amount": (F.col("amount") == 0, ZERO_AMOUNT_PENALTY),
    }
    scored = quality_score(normalized, penalties).drop("imputed_cells")
    kept = [c for c in scored.columns if c not in ("processed_date", "data_quality_score")]
    return rename_columns(scored.select(*kept, "processed_date", "data_quality_score"), CUSTOMER_NAMES)
