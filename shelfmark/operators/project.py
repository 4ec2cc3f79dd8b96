"""Projections to the target tables and renames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.schema import BOOK, BOOK_AUTHOR, DETAIL, FLAT, WAREHOUSE_NAMES


def book(typed: DataFrame) -> DataFrame:
    return typed.select(*BOOK.column_names)


def book_author(typed: DataFrame, blank: bool = False) -> DataFrame:
    """One row per book with the author text unsplit; null and blank texts go.

    ``blank`` keeps empty texts, as the variants do that only test for null.
    """
    rows = typed.select(*BOOK_AUTHOR.column_names).where(F.col("authors").isNotNull())
    return rows if blank else rows.where(f"{strip('authors')} <> ''")


def detail(typed: DataFrame, audience: bool = True) -> DataFrame:
    """Nine columns; eight without ``audience``."""
    return typed.select(*[c for c in DETAIL.column_names if audience or c != "audience"])


def flat(typed: DataFrame) -> DataFrame:
    """All sixteen fields, without the id the table adds."""
    return typed.select(*[c for c in FLAT.column_names if c != "id"])


def with_decimals(typed: DataFrame, precision: int = 18, scale: int = 2) -> DataFrame:
    """Prices and sizes as exact decimals, for targets that store them so."""
    exact = ("sale_price", "list_price", "length_cm", "width_cm")
    kind = f"DECIMAL({precision},{scale})"
    return typed.selectExpr(
        *[f"try_cast({c} AS {kind}) AS {c}" if c in exact else c for c in typed.columns]
    )


def renamed(records: DataFrame, names: dict[str, str] = WAREHOUSE_NAMES) -> DataFrame:
    """Other names for the fields; columns without a new name are kept as they are."""
    return records.withColumnsRenamed(names)
