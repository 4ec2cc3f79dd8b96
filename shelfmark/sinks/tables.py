"""Keyed target tables: in the catalogue, or behind JDBC (O-DDL, O-3T)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import lit
from shelfmark.schema import Table
from shelfmark.session import make_folder, remove


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _one_of(column: str, keys: list[str]) -> str:
    """As text: a column object costs a call to the JVM for each key."""
    return f"{column} IN ({', '.join(map(lit, keys))})" if keys else "false"


class CatalogTables:
    """Parquet tables bucketed by the first key column.

    All tables of a model share the bucket count and the bucket column, so the
    check of a batch against a table shuffles only the batch, and the joins of
    children to parents shuffle nothing. Set ``buckets`` so that a bucket fits
    an executor's memory: thousands at 100 TB.
    """

    #: Whether readers see whole batches only.
    whole = False

    def __init__(
        self, location: str, prefix: str = "", buckets: int = 16, constraints: bool = False
    ):
        """With ``constraints`` the catalogue holds text limits and refuses null keys.

        A write past them fails as a whole, whatever was checked before it.
        """
        self.constraints = constraints
        self.location = location
        self.prefix = prefix
        self.buckets = buckets

    def name(self, table: Table) -> str:
        return f"{self.prefix}{table.name}"

    def ddl(self, table: Table, name: str | None = None, folder: str | None = None) -> str:
        columns = ", ".join(self._column(table, c, t) for c, t in table.columns.items())
        layout = ""
        if table.key:
            layout = f" CLUSTERED BY ({table.key[0]}) INTO {self.buckets} BUCKETS"
        return (
            f"CREATE TABLE IF NOT EXISTS {name or self.name(table)} ({columns}) USING parquet"
            f"{layout} LOCATION '{folder or f'{self.location}/{table.name}'}'"
        )

    def _column(self, table: Table, name: str, kind: str) -> str:
        if not self.constraints:
            return f"{name} {kind}"
        limits = dict(table.limits)
        kind = f"VARCHAR({limits[name]})" if name in limits else kind
        return f"{name} {kind} NOT NULL" if name in table.key else f"{name} {kind}"

    def _no_null(self, rows: DataFrame, table: Table) -> DataFrame:
        """Spark holds text limits on write; file tables leave NOT NULL to the writer."""
        refused = "coalesce({0}, CAST(raise_error('null in {1}.{0}') AS {2})) AS {0}"
        return rows.selectExpr(
            *[refused.format(c, table.name, t) if c in table.key else c for c, t in table.columns.items()]
        )

    def create(self, spark: SparkSession, tables: tuple[Table, ...]) -> None:
        """Make the tables that do not exist, parents before children."""
        for table in tables:
            spark.sql(self.ddl(table))

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        return spark.table(self.name(table))

    def read_keys(self, spark: SparkSession, table: Table, keys: list[str]) -> DataFrame:
        """The rows with these values of the first key column: only their buckets are read."""
        return self.read(spark, table).where(_one_of(table.key[0], keys))

    def _by_bucket(self, rows: DataFrame, table: Table) -> DataFrame:
        """One file per bucket, because tasks hold whole buckets."""
        rows = self._no_null(rows, table) if self.constraints else rows.select(*table.column_names)
        return rows.repartition(self.buckets, table.key[0]) if table.key else rows

    def append(self, rows: DataFrame, table: Table) -> None:
        self._by_bucket(rows, table).write.insertInto(self.name(table))

    def replace(self, rows: DataFrame, table: Table) -> None:
        """All rows of the table anew. They must not be read from it."""
        self._by_bucket(rows, table).write.insertInto(self.name(table), overwrite=True)

    def compact(self, spark: SparkSession, *tables: Table) -> None:
        """One file per bucket again, after many small appends. Run it between batches.

        The rows are written to a folder of their own, to which the table is then
        turned in one step of the catalogue: a failure at any point leaves the
        table whole. The old files go last. As the table's place changes, the
        catalogue must be one that outlives the session.
        """
        for table in tables:
            self._compact(spark, table)

    def _compact(self, spark: SparkSession, table: Table) -> None:
        name, mark = self.name(table), uuid.uuid4().hex
        folder, side = f"{self.location}/{table.name}-{mark}", f"{name}_{mark}"
        whole = self.read(spark, table)
        if not whole.inputFiles():
            return
        described = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
        old = described.first()["data_type"]
        spark.sql(self.ddl(table, side, folder))
        try:
            # By its folder: rows of a bucketed table would count as placed by bucket already.
            rows = spark.read.schema(whole.schema).parquet(old)
            self._by_bucket(rows, table).write.insertInto(side)
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        finally:
            spark.sql(f"DROP TABLE {side}")
        spark.catalog.refreshTable(name)
        remove(spark, old)


class DividedTables(CatalogTables):
    """Tables whose buckets are partitions as well, so that Spark replaces single buckets.

    Rows are deleted by copy-on-write: only buckets with such a row are read and
    written, by Spark's dynamic partition overwrite. A bucket is replaced whole; a
    delete that stopped between two buckets is completed by running it again.
    """

    def _part(self, column: str) -> Column:
        """The number of a row's bucket."""
        return F.pmod(F.hash(column), F.lit(self.buckets))

    def ddl(self, table: Table, name: str | None = None, folder: str | None = None) -> str:
        plain = super().ddl(table, name, folder)
        with_part = plain.replace(") USING parquet", ", part int) USING parquet", 1)
        return with_part.replace("USING parquet", "USING parquet PARTITIONED BY (part)", 1)

    def create(self, spark: SparkSession, tables: tuple[Table, ...]) -> None:
        for table in tables:
            if not spark.catalog.tableExists(self.name(table)):
                spark.sql(self.ddl(table))
                make_folder(spark, f"{self.location}/{table.name}")
                # Buckets that an earlier catalogue knew.
                spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        return super().read(spark, table).select(*table.column_names)

    def _by_bucket(self, rows: DataFrame, table: Table) -> DataFrame:
        return super()._by_bucket(rows, table).withColumn("part", self._part(table.key[0]))

    def of_buckets(self, spark: SparkSession, table: Table, parts: list[int]) -> DataFrame:
        """The rows of these buckets; no other file is opened."""
        rows = super().read(spark, table)
        return rows.where(f"part IN ({', '.join(map(str, parts))})" if parts else "false")

    def buckets_of(self, keys: DataFrame, table: Table, column: str) -> list[int]:
        """The buckets that can hold rows with these values: at most ``buckets`` numbers.

        By the bucket column they follow from the values; by another one the
        table's two columns are read.
        """
        first = table.key[0]
        if column != first:
            stored = self.read(keys.sparkSession, table).select(first, column)
            keys = stored.join(keys, column, "left_semi")
        found = keys.where(F.col(first).isNotNull()).select(self._part(first).alias("part"))
        return sorted(r.part for r in found.distinct().collect())

    def delete(self, keys: DataFrame, table: Table, column: str | None = None) -> None:
        """Delete the rows whose ``column`` (or first key column) is among the keys."""
        spark, column = keys.sparkSession, column or table.key[0]
        keys = keys.select(F.col(keys.columns[0]).alias(column)).distinct()
        touched = self.buckets_of(keys, table, column)
        if touched:
            kept = self.of_buckets(spark, table, touched).join(keys, column, "left_anti")
            self._overwrite(kept, table, touched)

    def _overwrite(self, rows: DataFrame, table: Table, parts: list[int]) -> None:
        """These buckets anew, some of them without a row left."""
        spark, name = rows.sparkSession, self.name(table)
        left = {r.part for r in rows.select("part").distinct().collect()}
        before = spark.conf.get(_OVERWRITE, None)
        spark.conf.set(_OVERWRITE, "dynamic")
        try:
            made = rows.select(*table.column_names, "part").repartition(len(parts), "part")
            made.write.insertInto(name, overwrite=True)
        finally:
            spark.conf.unset(_OVERWRITE) if before is None else spark.conf.set(_OVERWRITE, before)
        # Dynamic overwrite leaves alone what it writes no row to.
        for part in set(parts) - left:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (part = {part})")
            remove(spark, f"{self.location}/{table.name}/part={part}")

    def _compact(self, spark: SparkSession, table: Table) -> None:
        parts = list(range(self.buckets))
        self._overwrite(self.of_buckets(spark, table, parts), table, parts)


class BatchTables(CatalogTables):
    """Tables of which readers see whole batches only, over all tables at once.

    Rows lie in one partition for each batch. Writing a batch replaces its own
    partition, so a batch that failed on the way is simply written again. A
    batch counts when its name is in the table of commits, which one file adds
    in one step, after all tables are written. Under the name of each table is a
    view of the batches that count: there is no moment at which a reader finds a
    book without its details.

    One job writes at a time. Compaction writes all that counts as one batch,
    then turns the table of commits to it in one step of the catalogue; what it
    replaced is removed by the next compaction, so readers may finish.
    """

    whole = True

    def stored(self, table: Table) -> str:
        """The table that holds the rows of all batches."""
        return f"{self.prefix}{table.name}_batches"

    @property
    def commits(self) -> str:
        return f"{self.prefix}batch_commits"

    def ddl(self, table: Table, name: str | None = None, folder: str | None = None) -> str:
        plain = super().ddl(table, name or self.stored(table), folder)
        with_batch = plain.replace(") USING parquet", ", batch string) USING parquet", 1)
        return with_batch.replace("USING parquet", "USING parquet PARTITIONED BY (batch)", 1)

    def view(self, table: Table) -> str:
        return (
            f"CREATE VIEW IF NOT EXISTS {self.name(table)} AS "
            f"SELECT {', '.join(table.column_names)} FROM {self.stored(table)} "
            f"WHERE batch IN (SELECT batch FROM {self.commits})"
        )

    def create(self, spark: SparkSession, tables: tuple[Table, ...]) -> None:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.commits} (batch string) USING parquet "
            f"LOCATION '{self.location}/batch_commits'"
        )
        for table in tables:
            if not spark.catalog.tableExists(self.stored(table)):
                spark.sql(self.ddl(table))
                make_folder(spark, f"{self.location}/{table.name}")
                # Batches that an earlier catalogue knew.
                spark.sql(f"ALTER TABLE {self.stored(table)} RECOVER PARTITIONS")
            spark.sql(self.view(table))

    def batch_name(self, spark: SparkSession, batch_id: int) -> str:
        """The same for a batch of a stream that is taken again; outside of a stream, a new one.

        The number alone does not name it: a stream whose checkpoint is lost counts from zero.
        """
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        return f"{query or uuid.uuid4().hex}-{batch_id}"

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        # A stream writes from a session of its own; this one may remember older files.
        spark.catalog.refreshTable(self.commits)
        spark.catalog.refreshTable(self.stored(table))
        return super().read(spark, table)

    def holds(self, spark: SparkSession, batch: str) -> bool:
        """Does the batch count already?"""
        spark.catalog.refreshTable(self.commits)
        return not spark.table(self.commits).where(F.col("batch") == batch).isEmpty()

    def put(self, rows: DataFrame, table: Table, batch: str) -> None:
        """The rows of a batch, in place of what an earlier try wrote."""
        self._insert(rows, table, batch, "OVERWRITE TABLE")

    def _insert(self, rows: DataFrame, table: Table, batch: str, how: str) -> None:
        side = f"batch_{uuid.uuid4().hex}"
        self._by_bucket(rows, table).createOrReplaceTempView(side)
        try:
            rows.sparkSession.sql(
                f"INSERT {how} {self.stored(table)} PARTITION (batch = '{batch}') "
                f"SELECT {', '.join(table.column_names)} FROM {side}"
            )
        finally:
            rows.sparkSession.catalog.dropTempView(side)

    def commit(self, spark: SparkSession, *batches: str) -> None:
        """Let batches count, in one file."""
        self._names(spark, batches).write.insertInto(self.commits)

    @staticmethod
    def _names(spark: SparkSession, batches: tuple[str, ...]) -> DataFrame:
        names = F.explode(F.array(*[F.lit(b) for b in batches])).alias("batch")
        return spark.range(1, numPartitions=1).select(names)

    def append(self, rows: DataFrame, table: Table) -> None:
        """A batch of its own, in one table."""
        batch = self.batch_name(rows.sparkSession, 0)
        self.put(rows, table, batch)
        self.commit(rows.sparkSession, batch)

    def replace(self, rows: DataFrame, table: Table) -> None:
        raise NotImplementedError("batches of several tables count together: put and commit them")

    def compact(self, spark: SparkSession, *tables: Table) -> None:
        """All batches of all tables as one, with one file per bucket."""
        live = {r.batch for r in spark.table(self.commits).collect()}
        if len(live) < 2:
            return
        self._remove_others(spark, tables, live)
        batch = f"whole-{uuid.uuid4().hex}"
        for table in tables:
            self._insert(self.read(spark, table), table, batch, "INTO")
        folder = f"{self.location}/batch_commits-{batch}"
        described = spark.sql(f"DESCRIBE FORMATTED {self.commits}").where("col_name = 'Location'")
        old = described.first()["data_type"]
        self._names(spark, (batch,)).write.parquet(folder)
        spark.sql(f"ALTER TABLE {self.commits} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(self.commits)
        remove(spark, old)

    def _remove_others(self, spark: SparkSession, tables: tuple[Table, ...], live: set) -> None:
        """Partitions of batches that do not count: torn ones, and those that were compacted."""
        for table in tables:
            for row in spark.sql(f"SHOW PARTITIONS {self.stored(table)}").collect():
                batch = row[0].removeprefix("batch=")
                if batch not in live:
                    spark.sql(f"ALTER TABLE {self.stored(table)} DROP PARTITION (batch = '{batch}')")
                    remove(spark, f"{self.location}/{table.name}/batch={batch}")


class JdbcTables:
    """Tables of a database, through Spark's JDBC source.

    The database must exist. ``create`` makes the tables, with keys, parents and
    limits; ``ddl`` gives its text.
    """

    whole = False
    _TYPES = {"string": "TEXT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE PRECISION"}

    def __init__(
        self,
        url: str,
        properties: dict[str, str],
        batch_size: int = 10_000,
        writers: int = 16,
        splits: dict[str, list[str]] | None = None,
    ):
        """``splits`` gives, per table, conditions that divide it among reading tasks."""
        self.url = url
        self.properties = {**properties, "batchsize": str(batch_size)}
        self.writers = writers
        self.splits = splits or {}

    def ddl(self, table: Table) -> str:
        limits = dict(table.limits)
        lines = [
            f"{c} {f'VARCHAR({limits[c]})' if c in limits else self._TYPES[t]}"
            for c, t in table.columns.items()
        ]
        if table.key:
            lines.append(f"PRIMARY KEY ({', '.join(table.key)})")
        cascade = " ON DELETE CASCADE" if table.cascade else ""
        for parent, own, theirs in table.parents:
            lines.append(f"FOREIGN KEY ({own}) REFERENCES {parent}({theirs}){cascade}")
        return f"CREATE TABLE IF NOT EXISTS {table.name} ({', '.join(lines)})"

    def create(self, spark: SparkSession, tables: tuple[Table, ...]) -> None:
        """Make the tables that do not exist, parents first, over one connection of the driver."""
        jvm = spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for name, value in self.properties.items():
            properties.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            statement = connection.createStatement()
            for table in tables:
                statement.execute(self.ddl(table))
        finally:
            connection.close()

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        return spark.read.jdbc(
            self.url,
            table.name,
            predicates=self.splits.get(table.name),
            properties=self.properties,
        )

    def read_keys(self, spark: SparkSession, table: Table, keys: list[str]) -> DataFrame:
        """The rows with these values of the first key column; the database looks them up."""
        return self.read(spark, table).where(_one_of(table.key[0], keys))

    def append(self, rows: DataFrame, table: Table) -> None:
        """Append over at most ``writers`` connections; what comes before keeps its tasks."""
        rows.select(*table.column_names).repartition(self.writers).write.jdbc(
            self.url, table.name, mode="append", properties=self.properties
        )
