"""Crawls that land in one store at the same time."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from shelfmark.plans import inputs, jobs
from shelfmark.schema import FLAT, RAW_FIELDS
from shelfmark.session import create_new, names_in
from shelfmark.sinks.files import BLOCK, append_documents, claim_block, land
from shelfmark.sinks.tables import CatalogTables
from shelfmark.sources.documents import read_documents


def test_a_file_has_one_maker(spark, tmp_path):
    file = f"{tmp_path}/deep/er/1"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda _: create_new(spark, file), range(24)))
    assert made.count(True) == 1 and names_in(spark, f"{tmp_path}/deep/er") == ["1"]
    assert names_in(spark, f"{tmp_path}/absent") == []


def test_blocks_are_claimed_once(spark, tmp_path):
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda _: claim_block(spark, f"{tmp_path}/s"), range(18)))
    assert sorted(numbers) == list(range(18))


def test_crawls_at_once_share_no_id(spark, tmp_path):
    store = f"{tmp_path}/documents"

    def crawl(n):
        rows = spark.range(50).select(*[F.lit(f"{n}").alias(f) for f in RAW_FIELDS])
        land(rows, f"{tmp_path}/{n}", store=store)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(crawl, range(4)))
    stored = read_documents(spark, store)
    assert not [n for n in names_in(spark, store) if n.startswith("_crawl")]
    assert stored.count() == 200 == stored.select("doc_id").distinct().count()
    assert {r.n for r in stored.groupBy("sku").agg(F.count("*").alias("n")).collect()} == {50}
    blocks = stored.select("sku", F.expr(f"doc_id div {BLOCK} AS block")).distinct()
    assert blocks.count() == 4


def test_a_store_with_ids_from_before(spark, tmp_path):
    """The first block begins behind what is there."""
    store = f"{tmp_path}/documents"
    rows = spark.range(3).select(*[F.lit("x").alias(f) for f in RAW_FIELDS])
    append_documents(rows, store, 7)
    land(rows, f"{tmp_path}/new", store=store)
    ids = sorted(r.doc_id for r in read_documents(spark, store).collect())
    assert len(set(ids)) == 6 and all(i >= BLOCK for i in ids[3:])


def test_an_empty_source_writes_nothing(spark, sf, tmp_path):
    tables = CatalogTables(str(tmp_path / "t"), "nothing_", 2)
    jobs.load_flat(inputs.records(spark, sf).limit(0), ["seq"], tables)
    assert not spark.catalog.tableExists(tables.name(FLAT)) and not (tmp_path / "t").exists()
