"""Record and table schemas, keys and length limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: they must equal those in the data for right results. ------
# The marker a page field takes when the page does not state it.
MISSING = "không có"

# The sixteen text fields of a record, in message order.
RAW_FIELDS = (
    "title",
    "authors",
    "units_sold",
    "sale_price",
    "list_price",
    "sku",
    "isbn",
    "audience",
    "length_cm",
    "width_cm",
    "page_count",
    "binding",
    "weight_g",
    "series",
    "category",
    "description",
)

# Column order and headings of the CSV export.
CSV_COLUMNS = (
    ("title", "Tiêu đề sách"),
    ("units_sold", "Đã bán (Sách)"),
    ("sale_price", "Giá bán (VNĐ)"),
    ("list_price", "Giá gốc (VNĐ)"),
    ("sku", "Mã sách"),
    ("isbn", "ISBN (Mã quốc tế)"),
    ("authors", "Tác giả"),
    ("audience", "Đối tượng"),
    ("length_cm", "Chiều dài (cm)"),
    ("width_cm", "Chiều rộng (cm)"),
    ("page_count", "Số trang"),
    ("binding", "Định dạng"),
    ("weight_g", "Trọng lượng (gram)"),
    ("series", "Bộ sách"),
    ("category", "Loại sách"),
    ("description", "Mô tả"),
)

# Field names of the messages as the crawler sends them. The name of the sku
# field belongs to the site: give it to ``message_names``.
MESSAGE_NAMES = {
    "title": "tieuDe",
    "authors": "tacGia",
    "units_sold": "daBan",
    "sale_price": "giaSale",
    "list_price": "giaGoc",
    "isbn": "ISBN",
    "audience": "doiTuong",
    "length_cm": "chieuDai",
    "width_cm": "chieuRong",
    "page_count": "soTrang",
    "binding": "dinhDang",
    "weight_g": "trongLuong",
    "series": "boSach",
    "category": "loaiSach",
    "description": "moTa",
}

# Column names of the warehouse form, used when cleaned records are published.
WAREHOUSE_NAMES = {
    "title": "tieu_de",
    "units_sold": "da_ban",
    "sale_price": "gia_ban",
    "list_price": "gia_goc",
    "sku": "ma_sach",
    "isbn": "isbn",
    "page_count": "so_trang",
    "length_cm": "chieu_dai",
    "width_cm": "chieu_rong",
    "weight_g": "trong_luong",
    "binding": "dinh_dang",
    "description": "mo_ta",
    "audience": "doi_tuong",
    "series": "ten_bo_sach",
    "category": "ten_loai_sach",
    "authors": "ten_tac_gia",
}
# -----------------------------------------------------------------------------


def message_names(sku_field: str) -> dict[str, str]:
    """Map of our field names to the crawler's, for ``project.renamed``."""
    return {**MESSAGE_NAMES, "sku": sku_field}


RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])

# A stored document: a record, the id the store gave it, and the delivery flag.
DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType(), True)]
    + RAW_SCHEMA.fields
    + [T.StructField("sent", T.BooleanType(), True)]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("html", T.StringType(), True),
    ]
)

# The columns of a topic record that the ingest uses. ``partition`` and
# ``offset`` are its identity and its order.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
    ]
)

# Message schema of the variants that type the numbers while parsing.
TYPED_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(
            f,
            {
                "units_sold": T.IntegerType(),
                "page_count": T.IntegerType(),
                "weight_g": T.IntegerType(),
                "sale_price": T.DoubleType(),
                "list_price": T.DoubleType(),
                "length_cm": T.DoubleType(),
                "width_cm": T.DoubleType(),
            }.get(f, T.StringType()),
            True,
        )
        for f in RAW_FIELDS
    ]
)


@dataclass(frozen=True)
class Table:
    """A keyed table: columns with SQL types, primary key, parents, text limits.

    ``parents`` maps a parent table to (own column, parent column); ``cascade``
    says that deleting a parent row deletes the children.
    """

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    parents: tuple[tuple[str, str, str], ...] = ()
    limits: tuple[tuple[str, int], ...] = ()
    cascade: bool = False

    @property
    def column_names(self) -> list[str]:
        return list(self.columns)


BOOK = Table(
    "book",
    {
        "sku": "string",
        "title": "string",
        "sale_price": "double",
        "list_price": "double",
        "series": "string",
        "category": "string",
        "isbn": "string",
    },
    key=("sku",),
    limits=(("sku", 255), ("title", 255), ("series", 255), ("category", 255), ("isbn", 255)),
)

BOOK_AUTHOR = Table(
    "book_author",
    {"sku": "string", "authors": "string"},
    key=("sku", "authors"),
    parents=(("book", "sku", "sku"),),
    limits=(("sku", 255), ("authors", 255)),
    cascade=True,
)

DETAIL = Table(
    "detail",
    {
        "sku": "string",
        "page_count": "int",
        "width_cm": "double",
        "length_cm": "double",
        "binding": "string",
        "units_sold": "int",
        "weight_g": "double",
        "audience": "string",
        "description": "string",
    },
    key=("sku",),
    parents=(("book", "sku", "sku"),),
    limits=(("sku", 255), ("binding", 255), ("audience", 255)),
    cascade=True,
)

# Parents before children: the order in which tables are made and written.
THREE_TABLES = (BOOK, BOOK_AUTHOR, DETAIL)

SERIES = Table("series", {"name": "string"}, key=("name",), limits=(("name", 100),))
CATEGORY = Table("category", {"name": "string"}, key=("name",), limits=(("name", 100),))
AUTHOR = Table("author", {"name": "string"}, key=("name",), limits=(("name", 255),))

BOOKS = Table(
    "books",
    {
        "sku": "string",
        "title": "string",
        "units_sold": "int",
        "sale_price": "double",
        "list_price": "double",
        "isbn": "string",
        "page_count": "int",
        "length_cm": "double",
        "width_cm": "double",
        "weight_g": "int",
        "binding": "string",
        "description": "string",
        "audience": "string",
        "series": "string",
        "category": "string",
    },
    key=("sku",),
    parents=(("series", "series", "name"), ("category", "category", "name")),
    limits=(
        ("sku", 50),
        ("title", 255),
        ("isbn", 50),
        ("binding", 50),
        ("audience", 100),
        ("series", 100),
        ("category", 100),
    ),
)

BRIDGE = Table(
    "book_author_bridge",
    {"sku": "string", "author": "string"},
    key=("sku", "author"),
    parents=(("books", "sku", "sku"), ("author", "author", "name")),
    limits=(("sku", 50), ("author", 255)),
)

# The bridge comes last: a book is fully loaded when its bridge row is there.
FIVE_TABLES = (SERIES, CATEGORY, AUTHOR, BOOKS, BRIDGE)

# What the last load decided to add, whole, so that a failed load can be completed.
BOOKS_PENDING = Table("books_pending", {**BOOKS.columns, "author": "string"}, key=("sku",))

# The variant whose books carry a generated id instead of the business key.
SERIAL_BOOKS = Table(
    "serial_books",
    {"book_id": "bigint", **{c: t for c, t in BOOKS.columns.items() if c != "sku"}},
    key=("book_id",),
    parents=BOOKS.parents,
    limits=tuple(limit for limit in BOOKS.limits if limit[0] != "sku"),
)
SERIAL_BRIDGE = Table(
    "serial_bridge",
    {"book_id": "bigint", "author": "string"},
    key=("book_id", "author"),
    parents=(("serial_books", "book_id", "book_id"), ("author", "author", "name")),
    limits=(("author", 255),),
)
SERIAL_TABLES = (SERIES, CATEGORY, AUTHOR, SERIAL_BOOKS, SERIAL_BRIDGE)
SERIAL_PENDING = Table(
    "serial_pending", {**SERIAL_BOOKS.columns, "author": "string"}, key=("book_id",)
)

# One flat table of all typed fields, with a generated id.
FLAT = Table(
    "books_table",
    {
        "id": "bigint",
        **{c: "string" for c in RAW_FIELDS},
        "units_sold": "int",
        "page_count": "int",
        "sale_price": "double",
        "list_price": "double",
        "length_cm": "double",
        "width_cm": "double",
        "weight_g": "double",
    },
    key=("id",),
)
