"""The five-table model: dimensions, book fact, bridge (O-ROW5, K3-K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfmark.functions.text import strip
from shelfmark.operators.coerce import coerce
from shelfmark.operators.integrity import (
    accept_books,
    dimension,
    good,
    insert_if_absent,
    not_in,
    number_rows,
    row_reasons,
)
from shelfmark.schema import BOOKS, BRIDGE, FIVE_TABLES, RAW_FIELDS, SERIAL_BOOKS, Table

_TEXTS = [f for f in RAW_FIELDS if BOOKS.columns.get(f, "string") == "string"]


def trimmed(records: DataFrame) -> DataFrame:
    """Text fields stripped, absent ones empty, as the row writers store them."""
    texts = {f: strip(f"coalesce({f}, '')") for f in _TEXTS}
    return records.selectExpr(
        *[f"{texts[c]} AS {c}" if c in texts else c for c in records.columns]
    )


def checked_books(records: DataFrame, keep_missing_key: bool = False) -> DataFrame:
    """Records under policy v5 with the reasons that refuse a row."""
    rows = trimmed(coerce(records, "v5")).selectExpr("*", "authors AS author")
    return row_reasons(rows, (BOOKS, BRIDGE), "sku", keep_missing_key)


def book_fact(
    checked: DataFrame, order: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """Accepted books, one per sku, with the author text for the bridge."""
    return accept_books(checked, "sku", order, existing)


def star(
    accepted: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    model: tuple[Table, ...] = FIVE_TABLES,
) -> dict[str, DataFrame]:
    """Rows to append to each of the five tables of either form, parents first.

    Only accepted books feed the dimensions: a refused book rolls back all.
    """
    have = targets or {}
    fact, link = model[-2:]
    books = accepted.select(*fact.column_names)
    return {
        "series": dimension(accepted, "series", have.get("series")),
        "category": dimension(accepted, "category", have.get("category")),
        "author": dimension(accepted, "author", have.get("author")),
        fact.name: not_in(books, have[fact.name], fact.key) if fact.name in have else books,
        link.name: bridge(accepted, have.get(link.name), link),
    }


def bridge(
    accepted: DataFrame, target: DataFrame | None = None, link: Table = BRIDGE
) -> DataFrame:
    """Pairs of a book's key and its author, conflicts ignored (K7)."""
    pairs = accepted.select(*link.column_names)
    return insert_if_absent(pairs, target, link.key)


def serial_books(checked: DataFrame, order: Sequence[str], last_id: int = 0) -> DataFrame:
    """Books with a generated id that goes on after ``last_id``, and their author (K6).

    This form has no business key: every good row becomes a book.
    """
    numbered = number_rows(good(checked), order, "book_id", last_id)
    return numbered.select(*SERIAL_BOOKS.column_names, "author")
