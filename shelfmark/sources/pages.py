"""Landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.schema import PAGE_SCHEMA


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages already fetched: id, address, body."""
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)
