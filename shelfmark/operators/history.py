"""The history of visited addresses, with a filter beside it.

The addresses lie in parts by host, a large host in several of them. Beside
them is one bit for each of a part's slots, set where a visited address hashes
to it. A found address whose bit is not set was never visited: it needs no
join. Only the others, visited ones and chance hits, meet the addresses
themselves, and only in the parts they fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.delivered import DeliveredMarks
from shelfmark.operators.links import frontier, host, normal_url
from shelfmark.session import make_folder, scratch_dir


class VisitedHistory:
    """Visited addresses in a folder that all executors share.

    ``parts`` and ``slots`` are fixed with the folder: some ten slots for each
    address a part will hold keep chance hits at a tenth. ``spread`` parts share
    a host, so that one host is never one task.
    """

    def __init__(self, folder: str, parts: int = 1024, slots: int = 1 << 22, spread: int = 16):
        self.addresses = f"{folder}/addresses"
        self.filter = DeliveredMarks(f"{folder}/filter")
        self.parts, self.slots, self.spread = parts, slots, spread

    def _part(self) -> Column:
        name = F.coalesce(host(F.col("url")), F.lit(""))
        share = F.pmod(F.xxhash64("url"), F.lit(min(self.spread, self.parts)))
        return F.pmod(F.pmod(F.xxhash64(name), F.lit(self.parts)) + share, F.lit(self.parts))

    def _placed(self, urls: DataFrame) -> DataFrame:
        """Each address once, with its part and its bit; ids of bits start at one."""
        rows = frontier(urls).where("url IS NOT NULL").withColumn("part", self._part())
        slot = F.pmod(F.xxhash64("url", F.lit("slot")), F.lit(self.slots))
        return rows.withColumn("_bit", F.col("part") * self.slots + slot + 1)

    def _visited(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        make_folder(spark, self.addresses)
        rows = spark.read.schema("url string, part long").parquet(self.addresses)
        return rows.where(f"part IN ({', '.join(map(str, parts))})" if parts else "false")

    def add(self, urls: DataFrame) -> None:
        """Addresses that were visited. The filter first: a bit without its address costs a
        look, an address without its bit would be visited twice."""
        rows = self._placed(urls)
        path = scratch_dir(urls.sparkSession, "visited")
        rows.write.parquet(path)
        rows = urls.sparkSession.read.schema(rows.schema).parquet(path)
        self.filter.mark(rows, "_bit")
        placed = rows.select("url", "part").repartition("part")
        placed.write.partitionBy("part").mode("append").parquet(self.addresses)

    def frontier(self, found: DataFrame) -> DataFrame:
        """Addresses still to visit, each once: as ``links.frontier`` with the whole history."""
        spark = found.sparkSession
        path = scratch_dir(spark, "flagged")
        flagged = self.filter.with_mark(self._placed(found), "_bit", "_hit")
        flagged.select("url", "part", "_hit").write.parquet(path)
        flagged = spark.read.parquet(path)
        hits = flagged.where("_hit").select("url", "part")
        parts = [r.part for r in hits.select("part").distinct().collect()]
        unvisited = hits.join(self._visited(spark, parts), ["part", "url"], "left_anti")
        nowhere = found.select(normal_url(F.col("url")).alias("url")).where("url IS NULL")
        return (
            flagged.where("NOT _hit").select("url")
            .union(unvisited.select("url"))
            .union(nowhere.distinct())
        )
