"""Stored documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.project import renamed
from shelfmark.schema import DOCUMENT_SCHEMA


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = DOCUMENT_SCHEMA,
    names: dict[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """All documents of a store. Any Spark source will do: format and options.

    ``schema=None`` lets the source infer it. ``names`` maps the store's field
    names to ours; the schema is then in the store's names.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    documents = reader.load(path) if path else reader.load()
    return renamed(documents, names) if names else documents


#: Field names of a store, above which its documents are no records of fields.
MOST_FIELDS = 10_000
# Types a field keeps; objects and arrays, and fields of several types, are read as text.
_KEPT = ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN", "DECIMAL", "DATE", "TIMESTAMP")


def field_types(texts: DataFrame, column: str = "value") -> dict[str, str]:
    """Type of every field over all documents (JSON texts), in order of names.

    Fields meet by name with partial aggregation, each with one type for all its
    values; what is fetched is one row per name.
    """
    values = texts.select(F.try_parse_json(column).alias("_v"))
    fields = values.lateralJoin(values.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    types = fields.groupBy("key").agg(F.schema_of_variant_agg("value").alias("type"))
    found = types.where("key IS NOT NULL").limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} field names")
    return {r.key: r.type if r.type.startswith(_KEPT) else "STRING" for r in sorted(found)}


def read_inferred(
    spark: SparkSession, path: str, types: dict[str, str] | None = None
) -> DataFrame:
    """Documents of JSON lines whose fields come and go or change their type.

    One column per field. A field that is a number here and text there is text
    everywhere, as it is written; an absent field is null. A line that is no
    JSON object gives nulls. ``types`` (of an earlier ``field_types``) spares the look
    at all documents; what does not fit them is null.
    """
    texts = spark.read.text(path)
    types = field_types(texts) if types is None else types
    values = texts.select(F.try_parse_json("value").alias("_v"))
    fields = []
    for name, kind in types.items():
        quote = "'" if '"' in name else '"'
        place = f"$[{quote}{name}{quote}]"
        fields.append(F.try_variant_get("_v", place, kind).alias(name))
    return values.select(*fields)


def or_none(documents: DataFrame) -> DataFrame | None:
    """None for an empty source, so that a job can stop before writing."""
    return None if documents.isEmpty() else documents
