"""Constraints of the catalogue, and schemas inferred over documents that drift."""

import pytest

from shelfmark.plans import inputs, jobs
from shelfmark.schema import BOOK, BOOK_AUTHOR, FIVE_TABLES
from shelfmark.sinks.tables import BatchTables, CatalogTables, DividedTables
from shelfmark.sources import documents
from shelfmark.sources.documents import field_types, read_inferred


@pytest.mark.parametrize("kind", [CatalogTables, DividedTables, BatchTables])
def test_a_write_past_the_checks_is_refused(spark, tmp_path, kind):
    tables = kind(str(tmp_path / "t"), f"limits_{kind.__name__}_", 2, constraints=True)
    tables.create(spark, (BOOK_AUTHOR,))
    schema = "sku string, authors string"
    tables.append(spark.createDataFrame([("s1", "é" * 255)], schema), BOOK_AUTHOR)
    for row, why in ((("s2", "x" * 256), "EXCEED_LIMIT_LENGTH"), ((None, "a"), "null in book_author.sku")):
        with pytest.raises(Exception, match=why):
            tables.append(spark.createDataFrame([("s3", "ok"), row], schema), BOOK_AUTHOR)
    assert [r.sku for r in tables.read(spark, BOOK_AUTHOR).collect()] == ["s1"]
    ddl = tables.ddl(BOOK)
    assert "sku VARCHAR(255) NOT NULL" in ddl and "title VARCHAR(255)," in ddl


def test_loads_keep_within_the_constraints(spark, sf, tmp_path):
    rows = inputs.records(spark, sf).limit(60)
    plain = CatalogTables(str(tmp_path / "p"), "within_p_", 2)
    bound = CatalogTables(str(tmp_path / "b"), "within_b_", 2, constraints=True)
    for tables in (plain, bound):
        jobs.load_five(rows, ["seq"], tables)
    for table in FIVE_TABLES:
        want = sorted(map(str, plain.read(spark, table).collect()))
        assert sorted(map(str, bound.read(spark, table).collect())) == want


DRIFT = [
    '{"a": 1, "b": "x", "odd name": 1, "o": {"k": [1]}}',
    '{"a": "two", "c": 1.5, "o": null}',
    '{"b": null, "a": 2.5, "n": null}',
    '{"c": 7, "d": true, "a": {"z": 1}}',
    "junk",
    "[1, 2]",
    "",
]


def test_types_over_all_documents(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(t,) for t in DRIFT], "value string").repartition(3).write.text(path)
    types = field_types(spark.read.text(path))
    assert {k: v.split("(")[0] for k, v in types.items()} == {
        "a": "STRING", "b": "STRING", "c": "DECIMAL", "d": "BOOLEAN",
        "n": "STRING", "o": "STRING", "odd name": "BIGINT",
    }
    rows = read_inferred(spark, path)
    assert rows.columns == sorted(types)
    got = sorted((r.asDict() for r in rows.collect()), key=lambda r: str(r["a"]))
    assert [r["a"] for r in got] == ["1", "2.5", None, None, None, "two", '{"z":1}']
    assert got[0]["o"] == '{"k":[1]}' and got[0]["odd name"] == 1
    assert [str(r["c"]) for r in got if r["c"] is not None] == ["1.5", "7.0"]
    # Known types: what came later and does not fit is null.
    known = read_inferred(spark, path, {"a": "BIGINT"})
    assert sorted(str(r.a) for r in known.collect()).count("None") >= 4
    empty = spark.createDataFrame([], "value string")
    assert field_types(empty) == {}


def test_too_many_names_are_refused(spark, monkeypatch):
    monkeypatch.setattr(documents, "MOST_FIELDS", 3)
    rows = spark.createDataFrame([('{"a":1,"b":1}',), ('{"c":1,"d":1}',)], "value string")
    with pytest.raises(ValueError, match="field names"):
        field_types(rows)
