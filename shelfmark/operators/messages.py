"""Records to messages and back (O-PUB, O-PUBARR, P8-P10, S13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import reasons
from shelfmark.schema import RAW_FIELDS, RAW_SCHEMA

_CORRUPT = "_corrupt_record"


def to_message(
    columns: tuple[str, ...] | list[str] = RAW_FIELDS, ascii_only: bool = False
) -> Column:
    """One JSON object; null fields are left out, as if the key were absent.

    ``ascii_only`` writes other characters as escapes; readers see the same.
    """
    options = {"writeNonAsciiCharacterAsCodePoint": str(ascii_only).lower()}
    return F.to_json(F.struct(*columns), options)


def publish_frame(
    records: DataFrame,
    drop: tuple[str, ...] = ("doc_id", "sent"),
    keep: tuple[str, ...] = (),
    ascii_only: bool = False,
) -> DataFrame:
    """Topic rows: no key, one JSON object per record, id and flag removed.

    ``keep`` names columns to carry beside the message.
    """
    body = [c for c in records.columns if c not in drop and c not in keep]
    return records.select(
        *keep,
        F.lit(None).cast("binary").alias("key"),
        to_message(body, ascii_only).cast("binary").alias("value"),
    )


def array_frame(numbered: DataFrame, number: str, size: int, drop: tuple[str, ...]) -> DataFrame:
    """Topic rows that each hold up to ``size`` records as one JSON array.

    ``numbered`` has a dense number from 1, so each group is bounded by
    ``size`` whatever the data looks like.
    """
    body = [c for c in numbered.columns if c not in drop and c != number]
    member = F.struct(F.col(number).alias("n"), F.struct(*body).alias("record"))
    return (
        numbered.groupBy(F.floor((F.col(number) - 1) / size).alias("batch"))
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
        .select(
            "batch",
            F.to_json(F.transform("members", lambda m: m["record"])).alias("value"),
        )
    )


def explode_arrays(messages: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """One row per element of JSON array messages; ``pos`` is its place."""
    kept = [c for c in messages.columns if c != "value"]
    data = F.from_json(F.col("value").cast("string"), T.ArrayType(schema))
    return messages.select(*kept, F.posexplode(data).alias("pos", "data")).select(
        *kept, "pos", "data.*"
    )


def parse_messages(
    messages: DataFrame,
    schema: T.StructType = RAW_SCHEMA,
    value: str = "value",
    keep_as: str | None = None,
) -> DataFrame:
    """Message columns besides ``value``, the parsed fields, and ``reasons``.

    A message that is not one JSON object gives null fields and a reason, and
    so does an object with none of the fields. Nothing is dropped. ``keep_as``
    keeps the whole message text under that name.
    """
    kept = [c for c in messages.columns if c != value]
    names = schema.fieldNames()
    checked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType(), True)])
    data = F.from_json("_text", checked, {"columnNameOfCorruptRecord": _CORRUPT})
    no_field = " AND ".join(f"data.{n} IS NULL" for n in names)
    rules = [
        ("empty_message", "data IS NULL"),
        ("broken_json", f"data.{_CORRUPT} IS NOT NULL"),
        ("no_known_field", f"data IS NOT NULL AND data.{_CORRUPT} IS NULL AND {no_field}"),
    ]
    return (
        messages.selectExpr(*kept, f"CAST({value} AS STRING) AS _text")
        .select(*kept, "_text", data.alias("data"))
        .selectExpr(
            *kept,
            *([f"_text AS {keep_as}"] if keep_as else []),
            *[f"data.{n} AS {n}" for n in names],
            f"{reasons(rules)} AS reasons",
        )
    )
