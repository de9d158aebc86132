"""Table schemas and the spellings of columns found in different stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Column names and types of the base tables.
SCHEMAS = {
    "aisles": "aisle_id int, aisle string",
    "departments": "department_id int, department string",
    "products": "product_id int, product_name string, aisle_id int, department_id int",
    "orders": "order_id int, user_id int, eval_set string, order_number int, order_dow int, "
    "order_hour_of_day int, days_since_prior_order int",
    "order_products_prior": "order_id int, product_id int, add_to_cart_order int, reordered int",
    "order_products_train": "order_id int, product_id int, add_to_cart_order int, reordered int",
}
PARTITION_KEYS = ("year", "month", "day", "hhmm")
LANDING_PARTITIONS = "year string, month string, day string, hhmm string"

# Other spellings of a column.
ALIASES = {
    "days_since_prior": "days_since_prior_order",
    "day_since_prior_order": "days_since_prior_order",
    "cluster": "segment",
    "pop_score": "score",
}
GAP_BEFORE = ("days_since_prior_order", "days_imp", "days_imp_imputed")
GAP_AFTER = ("days_imp_imputed", "days_imp", "days_since_prior_order_imputed", "days_since_prior_order")


def as_text(schema: str) -> str:
    """The same columns, all as text."""
    return ", ".join(f"{field.split()[0]} string" for field in schema.split(", "))


def pick_column(df: DataFrame, candidates: Sequence[str], force: str | None = None) -> str:
    """The forced column, or the first candidate the frame has."""
    if force is not None:
        if force not in df.columns:
            raise KeyError(f"no column {force}; there are {df.columns}")
        return force
    for name in candidates:
        if name in df.columns:
            return name
    raise KeyError(f"none of {list(candidates)} in {df.columns}")


def resolve_columns(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rename known spellings, unless the frame has the usual name already."""
    known = ALIASES if aliases is None else aliases
    renames: dict[str, str] = {}
    for old, new in known.items():
        if old in df.columns and new not in df.columns and new not in renames.values():
            renames[old] = new
    return df.withColumnsRenamed(renames)
