"""SQL for each registered query, written for DuckDB on the same tables.

The statements share the recipe of the derived records (``inputs.RAW_TEXTS``)
and nothing else: cleaning, coercion and integrity are stated again in SQL.
"""

from __future__ import annotations

from shelfmark.plans.inputs import RAW_TEXTS, SENT
from shelfmark.schema import RAW_FIELDS, WAREHOUSE_NAMES

_M = "'không có'"
_FIELDS = ", ".join(RAW_FIELDS)

_RAW = (
    "raw AS (SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in RAW_TEXTS.items())
    + f", {SENT} AS sent FROM part)"
)

# Sixteen text fields per record; the reasons are kept apart.
_REC = f"""sized AS (
  SELECT *, CASE WHEN size_text IS NULL THEN {_M}
    ELSE trim(replace(replace(trim(size_text), 'Khuôn Khổ:', ''), 'cm', '')) END AS sz
  FROM raw),
halved AS (
  SELECT *, string_split(sz, CASE WHEN contains(sz, 'x') THEN 'x' ELSE '-' END) AS parts
  FROM sized),
rec AS (
  SELECT seq, sent,
    trim(title_text) AS title,
    coalesce(trim(authors_text), {_M}) AS authors,
    regexp_extract(trim(coalesce(units_text, {_M})), '([^ ]+)$', 1) AS units_sold,
    trim(replace(replace(coalesce(sale_text, {_M}), '₫', ''), ',', '')) AS sale_price,
    trim(replace(replace(coalesce(list_text, {_M}), '₫', ''), ',', '')) AS list_price,
    coalesce(trim(sku_text), {_M}) AS sku,
    coalesce(trim(isbn_text), {_M}) AS isbn,
    trim(split_part(audience_text, '(', 1)) AS audience,
    CASE WHEN len(parts) <= 2 THEN coalesce(nullif(trim(parts[2]), ''), {_M}) END AS length_cm,
    CASE WHEN len(parts) <= 2 THEN coalesce(nullif(trim(parts[1]), ''), {_M}) END AS width_cm,
    coalesce(nullif(trim(split_part(replace(replace(replace(pages_text, '~', ''),
      'trang/cuốn', ''), 'trang', ''), ':', -1)), ''), {_M}) AS page_count,
    coalesce(split_part(trim(binding_text), ':', -1), {_M}) AS binding,
    CASE WHEN weight_text IS NULL THEN {_M}
      ELSE nullif(split_part(trim(split_part(weight_text, ':', -1)), ' ', 1), '') END AS weight_g,
    coalesce(trim(series_text), {_M}) AS series,
    trim(category_text) AS category,
    trim(description_text) AS description,
    concat_ws('|', CASE WHEN len(parts) > 2 THEN 'unreadable_size' END,
      CASE WHEN trim(split_part(weight_text, ':', -1)) = '' THEN 'unreadable_weight' END
    ) AS unread
  FROM halved)"""

_WITH = f"WITH {_RAW}, {_REC}"


def _int(c: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({c}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS INTEGER)"


def _dbl(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _absent0(c: str, value: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 0 ELSE {value} END"


def _typed(columns: dict[str, str]) -> str:
    return ", ".join(f"{columns.get(f, f)} AS {f}" for f in RAW_FIELDS)


_V1 = {
    "units_sold": _int("units_sold"),
    "sale_price": _dbl("sale_price"),
    "list_price": _dbl("list_price"),
    "length_cm": _absent0("length_cm", _dbl("length_cm")),
    "width_cm": _absent0("width_cm", _dbl("width_cm")),
    "page_count": _absent0("page_count", _int("page_count")),
    "weight_g": _absent0("weight_g", _dbl("weight_g")),
}
_V4 = {
    "length_cm": _absent0("length_cm", _dbl("length_cm")),
    "width_cm": _absent0("width_cm", _dbl("width_cm")),
    "page_count": _absent0("page_count", _int("page_count")),
    "weight_g": _absent0("weight_g", _int("weight_g")),
}
_STRICT = {
    "units_sold": """CASE WHEN units_sold IS NULL THEN 0
        WHEN regexp_matches(units_sold, '^[+-]?[0-9]+$') THEN TRY_CAST(units_sold AS INTEGER) END""",
    "sale_price": _absent0("sale_price", _dbl("replace(sale_price, ',', '')")),
    "list_price": _absent0("list_price", _dbl("replace(list_price, ',', '')")),
}
_V3 = {
    **_STRICT,
    "length_cm": f"coalesce({_dbl('length_cm')}, 0)",
    "width_cm": f"coalesce({_dbl('width_cm')}, 0)",
    "page_count": f"coalesce({_int('page_count')}, 0)",
    "weight_g": f"coalesce({_int('weight_g')}, 0)",
}


def _v5_size(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches(replace(trim({c}), '.', ''), '^[0-9]+$') "
        f"THEN TRY_CAST(trim({c}) AS DOUBLE) ELSE 0 END"
    )


_V5 = {
    **_STRICT,
    "length_cm": _v5_size("length_cm"),
    "width_cm": _v5_size("width_cm"),
    "page_count": "CASE WHEN regexp_matches(trim(page_count), '^[0-9]+$') "
    "THEN TRY_CAST(trim(page_count) AS INTEGER) ELSE 0 END",
    "weight_g": "CASE WHEN regexp_matches(replace(weight_g, '.', ''), '^[0-9]+$') "
    "THEN TRY_CAST(replace(weight_g, '.', '') AS INTEGER) ELSE 0 END",
}
_BAD_NUMBERS = "".join(
    f", CASE WHEN {c} IS NULL THEN 'unreadable_{c}' END"
    for c in ("units_sold", "sale_price", "list_price")
)


def _cte(name: str, columns: dict[str, str], source: str = "rec") -> str:
    return f"{name} AS (SELECT seq, sent, unread, {_typed(columns)} FROM {source})"


_TYPED = "units_sold, sale_price, list_price, length_cm, width_cm, page_count, weight_g"

# Rows the three-table load checks, policy v1: one reason text per record.
_TOO_LONG = "".join(
    f", CASE WHEN length({c}) > 255 THEN 'too_long_{c}' END"
    for c in ("sku", "title", "series", "category", "isbn", "authors", "binding", "audience")
)
_CHECK = f"CASE WHEN sku = {_M} THEN 'missing_sku' END{_TOO_LONG}"
_CHECKED_V1 = f"""{_cte("v1", _V1)},
checked AS (SELECT *, concat_ws('|', nullif(unread, ''), {_CHECK}) AS reasons FROM v1)"""
_ACCEPTED_V1 = f"""{_CHECKED_V1},
accepted AS (SELECT * FROM checked WHERE reasons = ''
  QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1)"""

# Five tables: policy v5, limits of those tables.
_SHORT = "".join(
    f", CASE WHEN length({c}) > {n} THEN 'too_long_{c}' END"
    for c, n in (
        ("sku", 50), ("title", 255), ("isbn", 50), ("binding", 50), ("audience", 100),
        ("series", 100), ("category", 100), ("authors", 255),
    )
)
_PASSED = f"""{_cte("v5", {**_V5, "binding": "trim(binding)"})},
passed AS (SELECT * FROM v5 WHERE concat_ws('|', nullif(unread, ''){_BAD_NUMBERS},
  CASE WHEN sku = {_M} THEN 'missing_sku' END{_SHORT}) = '')"""
_FIVE = f"""{_PASSED},
books AS (SELECT * FROM passed QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1)"""
_BOOKS = (
    "sku, title, units_sold, sale_price, list_price, isbn, page_count, length_cm, width_cm, "
    "weight_g, binding, description, audience, series, category"
)


def _coerced(columns: dict[str, str], reasons: str = "''") -> str:
    return (
        f"{_WITH}, {_cte('typed', columns)} "
        f"SELECT seq, {_TYPED}, {reasons} AS reasons FROM typed"
    )


def _dimension(column: str, loaded: str) -> str:
    return (
        f"{_WITH} SELECT DISTINCT {column} AS name FROM rec "
        f"WHERE NOT starts_with({column}, '{loaded}')"
    )


_BASE = "regexp_extract(url, '^(https?://[^/]+)', 1)"
_LINKS = f"""WITH found AS (
  SELECT page_id, {_BASE} AS base,
    list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda p: p <> '') AS paths
  FROM pages),
links AS (
  SELECT page_id, CAST(unnest(range(len(paths))) AS INTEGER) AS pos,
    concat(base, unnest(paths)) AS url
  FROM found)"""
_NORMAL = "rtrim(split_part(url, '#', 1), '/')"
_HOST = "lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"

_PAGE = """WITH found AS (
  SELECT page_id,
    trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) AS title,
    regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
    regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS nav,
    regexp_extract_all(concat('>', regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<'),
      '>([^<]+)<', 1) AS texts
  FROM pages)"""



def _decoded(text: str) -> str:
    """Entities decoded, the ampersand last; a cut-off one may lack its semicolon."""
    for entity, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return text


# The messages of the quarantine query that are not one readable object.
_BROKEN = f"""CASE seq % 31 WHEN 1 THEN 'broken_json' WHEN 2 THEN 'empty_message'
  WHEN 3 THEN 'empty_message' WHEN 4 THEN 'broken_json' WHEN 5 THEN 'broken_json'
  WHEN 6 THEN 'no_known_field' ELSE '' END"""

_PENDING = "SELECT * FROM rec WHERE sent IS DISTINCT FROM true"

# A sku-less or over-long record never loads; of the others the first by seq.
_THREE = f"""
SELECT 'book' AS tbl, sku, title, sale_price, list_price, series, category, isbn,
  NULL::VARCHAR AS authors, NULL::INTEGER AS page_count, NULL::DOUBLE AS width_cm,
  NULL::DOUBLE AS length_cm, NULL::VARCHAR AS binding, NULL::INTEGER AS units_sold,
  NULL::DOUBLE AS weight_g, NULL::VARCHAR AS audience, NULL::VARCHAR AS description
FROM accepted
UNION ALL SELECT 'book_author', sku, NULL, NULL, NULL, NULL, NULL, NULL, authors,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM accepted
UNION ALL SELECT 'detail', sku, NULL, NULL, NULL, NULL, NULL, NULL, NULL, page_count,
  width_cm, length_cm, binding, units_sold, weight_g, audience, description FROM accepted
UNION ALL SELECT 'rejected', CAST(r.seq AS VARCHAR), r.why, NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM refused r"""


def _load(checked: str, winner: str, offset: str = "seq") -> str:
    """Result of loading messages: a dropped size or weight is an absent field."""
    return f"""{_WITH}, {_cte("v1", _V1)},
checked AS (SELECT *, concat_ws('|', {_CHECK}) AS reasons FROM v1){checked},
accepted AS (SELECT * FROM checked WHERE reasons = ''
  QUALIFY row_number() OVER (PARTITION BY sku ORDER BY {winner}) = 1),
refused AS (SELECT {offset} AS seq,
    CASE WHEN reasons = '' THEN 'duplicate_sku' ELSE reasons END AS why
  FROM checked WHERE seq NOT IN (SELECT seq FROM accepted))
{_THREE}"""


_NULLS_OF_BOOKS = ", ".join(["NULL"] * 14)


def _star(books: str, key: str, fact: str, link: str) -> str:
    """The tables of a five-table model, tagged; ``books`` ends with a table of that name."""
    key_type = "VARCHAR" if key == "sku" else "BIGINT"
    return f"""{_WITH}, {books}, names AS (
          SELECT DISTINCT 'series' AS tbl, series AS name FROM books
          UNION SELECT 'category', category FROM books
          UNION SELECT 'author', authors FROM books)
        SELECT tbl, name, NULL::VARCHAR AS author, NULL::{key_type} AS {key},
          NULL::VARCHAR AS title,
          NULL::INTEGER AS units_sold, NULL::DOUBLE AS sale_price, NULL::DOUBLE AS list_price,
          NULL::VARCHAR AS isbn, NULL::INTEGER AS page_count, NULL::DOUBLE AS length_cm,
          NULL::DOUBLE AS width_cm, NULL::INTEGER AS weight_g, NULL::VARCHAR AS binding,
          NULL::VARCHAR AS description, NULL::VARCHAR AS audience, NULL::VARCHAR AS series,
          NULL::VARCHAR AS category FROM names
        UNION ALL SELECT '{fact}', NULL, NULL, {key}, {_BOOKS[5:]} FROM books
        UNION ALL SELECT '{link}', NULL, authors, {key}, {_NULLS_OF_BOOKS}
        FROM books"""

SQL: dict[str, str] = {
    "q_docs_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "q_docs_inferred": """SELECT doc_id, text, CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang,
        CASE WHEN doc_id % 3 = 0 THEN true END AS flag,
        concat(CASE WHEN doc_id % 5 = 0 THEN 'n' ELSE '' END, CAST(n_chars AS VARCHAR)) AS n_chars
        FROM documents""",
    "q_frontier": f"""SELECT DISTINCT {_NORMAL} AS url FROM pages UNION
        SELECT concat('https://shop.example.com/books/list?order=popular&p=',
          CAST(i AS VARCHAR)) FROM range(1, 52) t(i)""",
    "q_frontier_unvisited": f"""{_LINKS} SELECT DISTINCT {_NORMAL} AS url FROM links
        WHERE {_NORMAL} NOT IN (SELECT concat({_BASE}, '/the') FROM pages)""",
    "q_frontier_history": f"""{_LINKS}, crawled AS (
          SELECT {_NORMAL} AS url FROM pages WHERE page_id % 3 < 2
          UNION SELECT {_NORMAL} FROM (SELECT concat({_BASE}, '/the') AS url FROM pages)),
        seen AS (SELECT url FROM links UNION ALL SELECT url FROM pages)
        SELECT DISTINCT {_NORMAL} AS url FROM seen
        WHERE {_NORMAL} NOT IN (SELECT url FROM crawled)""",
    "q_links": f"{_LINKS} SELECT page_id, pos, url FROM links",
    "q_tile_links": """SELECT CAST(p_partkey // 24 AS BIGINT) AS page_id,
        CAST(row_number() OVER (PARTITION BY p_partkey // 24 ORDER BY p_partkey) - 1 AS INTEGER)
          AS pos,
        concat('https://shop.example.com/products/', CAST(p_partkey AS VARCHAR)) AS url
        FROM part WHERE p_partkey % 10 <> 9""",
    "q_domain_filter": f"""SELECT page_id, url FROM pages
        WHERE {_HOST} IN ('example.net', 'spam-farm.example.org')
          OR {_HOST} LIKE '%.example.net' OR {_HOST} LIKE '%.spam-farm.example.org'""",
    "q_page_fields": f"""{_PAGE} SELECT page_id,
        coalesce(nullif(title, ''), {_M}) AS title, coalesce(nullif(lang, ''), {_M}) AS lang,
        coalesce(nullif(trim(nav[2]), ''), {_M}) AS second_nav,
        coalesce(nullif(array_to_string(nav, ', '), ''), {_M}) AS nav_texts,
        trim(array_to_string(texts, ' ')) AS article_text FROM found""",
    "q_page_tree": f"""{_PAGE} SELECT page_id,
        {_decoded("title")} AS title, {_decoded("trim(nav[2])")} AS second_nav,
        {_decoded("array_to_string(nav, ', ')")} AS nav_texts,
        {_decoded("trim(array_to_string(texts, ' '))")} AS article_text FROM found""",
    "q_product_fields": f"""{_WITH} SELECT seq, title, authors, units_sold, sale_price,
        list_price, sku, isbn, audience, length_cm, width_cm, page_count,
        CASE WHEN seq % 3 = 0 THEN binding ELSE trim(binding) END AS binding,
        CASE WHEN seq % 3 = 0 THEN weight_g ELSE coalesce(weight_g, {_M}) END AS weight_g,
        series, category, description,
        CASE WHEN seq % 3 = 0 THEN unread ELSE regexp_extract(unread, 'unreadable_size') END
          AS reasons FROM rec""",
    "q_clean_units": f"{_WITH} SELECT seq, units_sold FROM rec",
    "q_clean_price": f"{_WITH} SELECT seq, sale_price, list_price FROM rec",
    "q_clean_audience": f"{_WITH} SELECT seq, audience FROM rec",
    "q_clean_size": f"""{_WITH} SELECT seq, width_cm, length_cm,
        regexp_extract(unread, 'unreadable_size') AS reasons FROM rec""",
    "q_clean_pages": f"{_WITH} SELECT seq, page_count FROM rec",
    "q_clean_weight": f"""{_WITH} SELECT seq, weight_g, replace(weight_g, '.', '') AS grams
        FROM rec""",
    "q_clean_identity": f"""{_WITH} SELECT seq, sku, isbn, series, category, binding, title,
        authors, description FROM rec""",
    "q_publish_json": f'{_WITH} SELECT seq AS "offset", {_FIELDS} FROM rec',
    "q_publish_documents": "SELECT text, lang, source, n_chars FROM documents",
    "q_publish_renamed": f"""{_WITH}, {_cte("typed", _V4)} SELECT seq, """
    + ", ".join(f"{ours} AS {theirs}" for ours, theirs in WAREHOUSE_NAMES.items())
    + " FROM typed",
    "q_array_messages": f"""{_WITH}, numbered AS (
        SELECT *, row_number() OVER (ORDER BY seq) - 1 AS n FROM ({_PENDING}))
        SELECT CAST(n // 50 AS BIGINT) AS batch, CAST(n % 50 AS INTEGER) AS pos, {_FIELDS}
        FROM numbered""",
    "q_parse_all_string": """SELECT event_id, json_extract_string(props, '$.k') AS k,
        TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int FROM events""",
    "q_parse_quarantine": f"""{_WITH} SELECT seq AS "offset",
        CASE WHEN {_BROKEN} = '' THEN sku END AS sku,
        CASE WHEN {_BROKEN} = '' THEN title END AS title, {_BROKEN} AS reasons FROM rec""",
    "q_topic_peek": f"""{_WITH} SELECT 0 AS "partition", seq AS "offset", sku, title
        FROM rec ORDER BY seq LIMIT 100""",
    "q_topic_range": f"""{_WITH} SELECT CAST(seq // 4 // most AS INTEGER) AS run,
          CAST(seq % 4 AS INTEGER) AS partition, seq // 4 AS "offset", sku
        FROM rec, (SELECT greatest(1, count(*) // 10) AS most FROM rec)""",
    "q_coerce_v1": _coerced(_V1),
    "q_coerce_v2": f"""{_WITH}, {_cte("v1", _V1)}
        SELECT 'text' AS sent_as, seq, NULL::INTEGER AS units_sold, NULL::DOUBLE AS sale_price,
          NULL::DOUBLE AS list_price, 0::DOUBLE AS length_cm, 0::DOUBLE AS width_cm,
          0 AS page_count, 0 AS weight_g FROM rec
        UNION ALL SELECT 'number', seq, units_sold, sale_price, list_price,
          coalesce(length_cm, 0), coalesce(width_cm, 0), coalesce(page_count, 0),
          CAST(coalesce(trunc(weight_g), 0) AS INTEGER) FROM v1""",
    "q_coerce_v3": _coerced(_V3, f"concat_ws('|'{_BAD_NUMBERS})"),
    "q_coerce_v4": _coerced(_V4),
    "q_coerce_v4_insert": f"""{_WITH}, {_cte("typed", _V4)} SELECT seq,
        coalesce(page_count, 0) AS page_count, coalesce(weight_g, 0) AS weight_g,
        coalesce(length_cm, 0) AS length_cm, coalesce(width_cm, 0) AS width_cm FROM typed""",
    "q_coerce_v5": _coerced(_V5, f"concat_ws('|'{_BAD_NUMBERS})"),
    "q_book": f"""{_WITH}, {_cte("typed", _V1)}
        SELECT sku, title, sale_price, list_price, series, category, isbn FROM typed""",
    "q_book_author": f"{_WITH} SELECT DISTINCT sku, authors FROM rec WHERE trim(authors) <> ''",
    "q_detail": f"""{_WITH}, {_cte("typed", _V1)} SELECT sku, page_count, width_cm, length_cm,
        binding, units_sold, weight_g, audience, description FROM typed""",
    "q_flat": f"""{_WITH}, {_cte("typed", _V1)} SELECT {_FIELDS} FROM typed""",
    "q_pk_first_wins": f"""{_WITH} SELECT seq, {_FIELDS} FROM rec
        QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1""",
    "q_pk_order_lines": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""",
    "q_dim_series": _dimension("series", "Brand#1"),
    "q_dim_category": _dimension("category", "S"),
    "q_dim_author": _dimension("authors", "Brand#1"),
    "q_book_fact": f"{_WITH}, {_FIVE} SELECT {_BOOKS} FROM books",
    "q_bridge": f"{_WITH}, {_FIVE} SELECT sku, authors AS author FROM books",
    "q_surrogate_key": f"""{_WITH} SELECT seq, sku, title,
        1000 + row_number() OVER (ORDER BY seq) AS id FROM rec""",
    "q_number_nulls": f"""{_WITH}, placed AS (
          SELECT CASE WHEN seq % 7 <> 0 THEN seq // 3 END AS place, seq FROM rec), ids AS (
          SELECT place, row_number() OVER (ORDER BY place NULLS FIRST, seq) AS id FROM placed)
        SELECT place, id - min(id) OVER (PARTITION BY place) AS nth,
          min(id) OVER (PARTITION BY place) AS first FROM ids""",
    "q_serial_books": f"""{_WITH}, {_FIVE}
        SELECT 500 + row_number() OVER (ORDER BY seq) AS book_id, {_BOOKS[5:]} FROM passed""",
    "q_serial_bridge": f"""{_WITH}, {_FIVE}
        SELECT row_number() OVER (ORDER BY seq) AS book_id, authors AS author FROM passed""",
    "q_fk_orphans": """SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS has_parent FROM lineitem""",
    "q_fk_children": f"""{_WITH}, {_ACCEPTED_V1} SELECT seq, sku, binding, units_sold FROM v1
        WHERE sku IN (SELECT sku FROM accepted)""",
    "q_fk_refused": f"""{_WITH}, {_ACCEPTED_V1} SELECT seq, sku, binding, units_sold FROM v1
        WHERE sku NOT IN (SELECT sku FROM accepted)""",
    "q_quarantine": f"""{_WITH}, {_cte("v5", _V5)},
        checked AS (SELECT *, concat_ws('|', nullif(unread, ''){_BAD_NUMBERS}, {_CHECK}) AS why
          FROM v5),
        placed AS (SELECT *, row_number() OVER (PARTITION BY sku, why = '' ORDER BY seq) AS n
          FROM checked)
        SELECT seq, sku, CASE WHEN why = '' THEN 'duplicate_sku' ELSE why END AS reasons
        FROM placed WHERE why <> '' OR n > 1""",
    "q_accept_books": f"""{_WITH}, {_cte("v3", _V3)},
        passed AS (SELECT * FROM v3
          WHERE concat_ws('|', nullif(unread, ''){_BAD_NUMBERS}, {_CHECK}) = ''),
        first AS (SELECT * FROM passed
          QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1)
        SELECT seq, sku, {_TYPED} FROM first
        WHERE sku NOT IN (SELECT sku FROM rec WHERE category = 'SMALL')""",
    "q_cascade_delete": f"""{_WITH}, gone AS (SELECT sku FROM rec WHERE category = 'SMALL')
        SELECT 'detail' AS child, sku, binding FROM rec WHERE sku NOT IN (SELECT sku FROM gone)
        UNION ALL SELECT 'author', sku, authors FROM rec
        WHERE sku NOT IN (SELECT sku FROM gone)""",
    "q_outbox_pending": f"{_WITH} SELECT seq AS doc_id, sku, sent FROM ({_PENDING})",
    "q_outbox_batches": f"""{_WITH} SELECT seq AS doc_id, sku,
        CAST((row_number() OVER (ORDER BY seq) - 1) // 50 AS INTEGER) AS round
        FROM ({_PENDING}) ORDER BY seq LIMIT 250""",
    "q_outbox_mark": f"""{_WITH}, now AS (SELECT seq FROM ({_PENDING}) ORDER BY seq LIMIT 250)
        SELECT seq AS doc_id, sku, CASE WHEN seq IN (SELECT seq FROM now) THEN true ELSE sent END
          AS sent FROM rec""",
    "j_relay": f"""{_WITH} SELECT seq AS "offset", sku, title FROM ({_PENDING})""",
    "j_relay_bitmap": f"""{_WITH} SELECT seq AS "offset", sku, title FROM ({_PENDING})""",
    "s_ingest": _load("", "seq % 2, seq"),
    "s_ingest_restart": _load("", "seq % 3, seq"),
    "s_ingest_torn": _load("", "seq % 2, seq"),
    "s_ingest_recreated_topic": _load("", "seq % 2, seq", "seq - seq % 2 * 3"),
    "s_ingest_crawler_names": _load("", "seq"),
    "j_load_three": _load("", "seq"),
    "tables": _star(_FIVE, "sku", "books", "book_author_bridge"),
    "j_load_five_restart": _star(
        f"""{_PASSED}, books AS (SELECT * FROM passed
          QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq % 3 <> 0, seq) = 1)""",
        "sku", "books", "book_author_bridge",
    ),
    "j_load_serial": _star(
        f"""{_PASSED}, books AS (SELECT row_number() OVER (ORDER BY run, seq) AS book_id, *
          FROM passed, range(2) t(run))""",
        "book_id", "serial_books", "serial_bridge",
    ),
    "j_cascade_delete": f"""WITH loaded AS ({_load("", "seq")})
        SELECT * FROM loaded WHERE tbl = 'rejected'
          OR sku NOT IN (SELECT sku FROM loaded WHERE tbl = 'book' AND category = 'SMALL')""",
    "j_delete_five": _star(
        f"""{_PASSED}, stored AS (
          SELECT * FROM passed QUALIFY row_number() OVER (PARTITION BY sku ORDER BY seq) = 1),
        books AS (SELECT * FROM stored WHERE category <> 'SMALL')""",
        "sku", "books", "book_author_bridge",
    ),
    "j_load_flat": f"""{_WITH}, {_cte("typed", _V1)}, twice AS (
          SELECT 0 AS run, * FROM typed UNION ALL SELECT 1 AS run, * FROM typed)
        SELECT row_number() OVER (ORDER BY run, seq) AS id, {_FIELDS} FROM twice""",
    "j_csv": f"""{_WITH} SELECT title, authors, units_sold, sale_price, list_price, sku, isbn,
        audience, length_cm, width_cm, page_count, trim(binding) AS binding, weight_g, series,
        category, description FROM rec""",
    "j_json": f"{_WITH} SELECT {_FIELDS} FROM rec",
    "j_landing": f"""{_WITH} SELECT {_FIELDS}, NULL::BOOLEAN AS sent FROM rec
        WHERE unread = ''""",
    "j_two_crawls_relay": f"""{_WITH} SELECT sku, title FROM rec, range(2) WHERE unread = ''""",
    "j_parallel_crawls": f"""{_WITH} SELECT sku, title, CAST(1 AS BIGINT) AS copies FROM rec
        WHERE unread = ''""",
    "j_crawl": f"""{_WITH} SELECT title, authors, units_sold, sale_price, list_price, sku, isbn,
        audience, length_cm, width_cm, page_count,
        CASE WHEN seq % 3 = 0 THEN binding ELSE trim(binding) END AS binding,
        CASE WHEN seq % 3 = 0 THEN weight_g ELSE coalesce(weight_g, {_M}) END AS weight_g,
        series, category, description FROM rec
        WHERE seq % 10 <> 9 AND unread NOT LIKE '%size%'
          AND (unread = '' OR seq % 3 <> 0)""",
}
