"""Text record to typed record under five null policies (C-V1 to C-V5).

All policies are expressions over one row. They differ in what a text that is
no number, and an absent value, turn into:

======  ====================  ==================  ===============================
policy  not a number          absent              then
======  ====================  ==================  ===============================
v1      null                  0, prices/units     the default
                              null
v2      0, prices/units null  0, prices/units     numbers typed while parsing, so
                              null                a number sent as text is lost
v3      0                     0                   bad price or units reject
v4      null                  0                   blanks cut first
v5      0                     0                   digits only; bad price or units
                                                  reject
======  ====================  ==================  ===============================

``reasons`` lists why a row must be rejected; it is empty under v1, v2 and v4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.numbers import (
    is_digits,
    loose_double,
    loose_int,
    strict_double,
    strict_int,
    zero_if_absent,
)
from shelfmark.functions.text import reasons, remove, strip
from shelfmark.schema import RAW_FIELDS, TYPED_MESSAGE_SCHEMA

_PRICES = ("sale_price", "list_price")
_SIZES = ("length_cm", "width_cm")
_MUST_READ = [(f"unreadable_{c}", f"{c} IS NULL") for c in ("units_sold", *_PRICES)]

Rules = list[tuple[str, str]]


def _v1() -> tuple[dict[str, str], Rules]:
    typed = {
        "units_sold": loose_int("units_sold"),
        "page_count": zero_if_absent("page_count", loose_int("page_count")),
    }
    for name in _PRICES:
        typed[name] = loose_double(name)
    for name in (*_SIZES, "weight_g"):
        typed[name] = zero_if_absent(name, loose_double(name))
    return typed, []


def _parsed_late() -> dict[str, str]:
    """Units and prices of the row loaders, parsed when the row is written."""
    typed = {"units_sold": zero_if_absent("units_sold", strict_int("units_sold"))}
    for name in _PRICES:
        typed[name] = zero_if_absent(name, strict_double(remove(name, ",")))
    return typed


def _v3() -> tuple[dict[str, str], Rules]:
    typed = _parsed_late()
    for name in ("page_count", "weight_g"):
        typed[name] = f"coalesce({loose_int(name)}, 0)"
    for name in _SIZES:
        typed[name] = f"coalesce({loose_double(name)}, 0)"
    # These texts are read without a default, so an absent one rejects too.
    absent = [(f"absent_{c}", f"{c} IS NULL") for c in ("isbn", "binding", "description")]
    return typed, _MUST_READ + absent


def _v4(on_insert: bool) -> tuple[dict[str, str], Rules]:
    typed = {}
    for name in ("page_count", "weight_g", *_SIZES):
        text = f"trim({name})"
        read = loose_double if name in _SIZES else loose_int
        value = zero_if_absent(text, read(text))
        typed[name] = f"coalesce({value}, 0)" if on_insert else value
    return typed, []


def _v5() -> tuple[dict[str, str], Rules]:
    pages, grams = strip("page_count"), remove("weight_g", ".")
    typed = _parsed_late()
    for name, text in (("page_count", pages), ("weight_g", grams)):
        typed[name] = f"CASE WHEN {is_digits(text)} THEN try_cast({text} AS INT) ELSE 0 END"
    for name in _SIZES:
        gate = is_digits(remove(strip(name), "."))
        typed[name] = f"CASE WHEN {gate} THEN {strict_double(name)} ELSE 0 END"
    bad = [(f"unreadable_{c}", f"{c} IS NULL") for c in ("page_count", "weight_g", *_SIZES)]
    return typed, _MUST_READ + bad


def coerce(record: DataFrame, policy: str = "v1", on_insert: bool = False) -> DataFrame:
    """Type the numeric fields of a text record; keep all other columns.

    ``on_insert`` applies the zero that v4 puts in place of null when a row is
    written. v2 types messages while parsing: use ``parse_typed``.
    """
    if policy == "v1":
        typed, rules = _v1()
    elif policy == "v3":
        typed, rules = _v3()
    elif policy == "v4":
        typed, rules = _v4(on_insert)
    elif policy == "v5":
        typed, rules = _v5()
    else:
        raise ValueError(f"no record policy {policy!r}")
    kept = [c for c in record.columns if c not in RAW_FIELDS and c != "reasons"]
    fields = [f"{typed[f]} AS {f}" if f in typed else f for f in RAW_FIELDS]
    found = reasons(rules)
    if "reasons" not in record.columns:
        return record.selectExpr(*kept, *fields).selectExpr("*", f"{found} AS reasons")
    if rules:
        found = f"concat(reasons, {found})"
        return record.selectExpr(*kept, *fields, "reasons").selectExpr(
            *kept, *RAW_FIELDS, f"{found} AS reasons"
        )
    return record.selectExpr(*kept, *fields, "reasons")


def parse_typed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Policy v2: parse with typed numbers, then 0 for the four measured fields."""
    kept = [c for c in messages.columns if c != value]
    data = F.from_json(F.col(value).cast("string"), TYPED_MESSAGE_SCHEMA)
    zeroed = (*_SIZES, "page_count", "weight_g")
    fields = [
        f"coalesce(data.{f}, 0) AS {f}" if f in zeroed else f"data.{f} AS {f}" for f in RAW_FIELDS
    ]
    return messages.select(*kept, data.alias("data")).selectExpr(*kept, *fields)


def type_parsed(records: DataFrame) -> DataFrame:
    """Policy v2 for text records, as a sink gets them: numbers as the typed parse reads them.

    A text that is no JSON number of the field's type gives null; the four
    measured fields are 0 where null.
    """
    zeroed = (*_SIZES, "page_count", "weight_g")
    fields = []
    for f in RAW_FIELDS:
        kind = TYPED_MESSAGE_SCHEMA[f].dataType.simpleString()
        value = f if kind == "string" else f"try_cast({f} AS {kind})"
        fields.append(f"coalesce({value}, 0) AS {f}" if f in zeroed else f"{value} AS {f}")
    kept = [c for c in records.columns if c not in RAW_FIELDS and c != "reasons"]
    return records.selectExpr(*kept, *fields, "reasons")
