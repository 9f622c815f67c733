"""The same results as `queries`, in SQL over the test tables."""

from __future__ import annotations

from corpusloom.queries import ACCENTED_TEXT, SEARCH_TEXT

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

RECORDS = """
records AS (
  SELECT doc_id, lpad(doc_id::varchar, 10, '0') || '.json' AS file_path,
         '10.5555/' || md5(text) AS doi,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN contains(text, chr(10))
              THEN substr(text, length(split_part(text, chr(10), 1)) + 2) ELSE '' END AS abstract,
         source AS issn, (1990 + doc_id % 35)::int AS pub_year
  FROM documents),
record_authors AS (
  SELECT doc_id,
         (row_number() OVER (PARTITION BY doc_id
            ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) - 1)::int AS author_order,
         'Supplier' AS first_name, s_name AS last_name, l_returnflag AS initial
  FROM (SELECT l_orderkey % (SELECT max(doc_id) + 1 FROM documents) AS doc_id, * FROM lineitem)
  JOIN supplier ON l_suppkey = s_suppkey)
"""

STORED = (
    RECORDS
    + """,
winners AS (SELECT doi, min(file_path) AS file_path FROM records GROUP BY doi),
stored AS (
  SELECT row_number() OVER (ORDER BY r.doi) AS id, r.*
  FROM records r JOIN winners w ON r.doi = w.doi AND r.file_path = w.file_path),
staged AS (
  SELECT s.id AS document_id, s.doi, ra.author_order, ra.first_name, ra.last_name, ra.initial
  FROM record_authors ra JOIN stored s ON ra.doc_id = s.doc_id),
author_rows AS (
  SELECT row_number() OVER (ORDER BY first_name, last_name, initial) AS id,
         first_name, last_name, initial
  FROM (SELECT DISTINCT first_name, last_name, initial FROM staged)),
relation_rows AS (
  SELECT s.document_id, a.id AS author_id, min(s.author_order) AS author_order
  FROM staged s JOIN author_rows a ON s.first_name = a.first_name
   AND s.last_name = a.last_name AND s.initial = a.initial
  GROUP BY ALL)
"""
)

# A first run over odd ids, then a run over all files.
TWICE = (
    RECORDS
    + """,
w1 AS (SELECT doi, min(file_path) AS file_path FROM records WHERE doc_id % 2 = 1 GROUP BY doi),
w2 AS (SELECT doi, min(file_path) AS file_path FROM records GROUP BY doi),
d1 AS (
  SELECT row_number() OVER (ORDER BY r.doi) AS id, r.*
  FROM records r JOIN w1 USING (doi, file_path)),
d2 AS (
  SELECT (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY r.doi) AS id, r.*
  FROM records r JOIN w2 USING (doi, file_path)
  WHERE r.doi NOT IN (SELECT doi FROM d1)),
stored AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2),
s1 AS (
  SELECT s.id AS document_id, ra.* FROM record_authors ra
  JOIN records r USING (doc_id) JOIN w1 USING (doi, file_path) JOIN stored s ON s.doi = r.doi),
s2 AS (
  SELECT s.id AS document_id, ra.* FROM record_authors ra
  JOIN records r USING (doc_id) JOIN w2 USING (doi, file_path) JOIN stored s ON s.doi = r.doi),
n1 AS (SELECT DISTINCT first_name, last_name, initial FROM s1),
n2 AS (SELECT DISTINCT first_name, last_name, initial FROM s2 EXCEPT SELECT * FROM n1),
author_rows AS (
  SELECT row_number() OVER (ORDER BY first_name, last_name, initial) AS id, * FROM n1
  UNION ALL
  SELECT (SELECT count(*) FROM n1)
         + row_number() OVER (ORDER BY first_name, last_name, initial), * FROM n2),
l1 AS (
  SELECT document_id, a.id AS author_id, min(author_order) AS author_order
  FROM s1 JOIN author_rows a USING (first_name, last_name, initial) GROUP BY ALL),
l2 AS (
  SELECT document_id, a.id AS author_id, min(author_order) AS author_order
  FROM s2 JOIN author_rows a USING (first_name, last_name, initial) GROUP BY ALL),
relation_rows AS (
  SELECT * FROM l1
  UNION ALL
  SELECT l2.* FROM l2 ANTI JOIN l1 USING (document_id, author_id))
"""
)


def _lowered(column: str) -> str:
    return f"encode(translate({column}, '{UPPER}', '{LOWER}'))"


def _grams(source: str, key: str, *columns: str) -> str:
    """CTE body: (doc_id, gram) for every window of every column."""
    parts = [
        f"""SELECT doc_id, unnest(list_transform(range(1, octet_length(b) - 1),
                      lambda i: hex(b[i:i+2]))) AS gram
            FROM (SELECT {key} AS doc_id, {_lowered(c)} AS b FROM {source})
            WHERE octet_length(b) >= 3"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _query_grams(source: str, key: str, column: str, windows: int | None = None) -> str:
    """CTE body: (query_id, gram), distinct among all or the first windows."""
    last = "octet_length(b) - 1" if windows is None else f"least(octet_length(b) - 1, {windows + 1})"
    return f"""SELECT DISTINCT query_id, unnest(list_transform(
                 range(1, {last}), lambda i: hex(b[i:i+2]))) AS gram
               FROM (SELECT {key} AS query_id, {_lowered(f"trim({column}, ' ')")} AS b FROM {source})
               WHERE octet_length(b) >= 3"""


def _preview(column: str) -> str:
    """The longest whole characters within 120 bytes."""
    return f"""left({column}, list_max(list_filter(range(0, 121),
                 lambda n: octet_length(encode(left({column}, n))) <= 120)))"""


def _search(corpus: str, documents: str, queries: str, columns: str) -> str:
    """Brute force: count every gram of every document."""
    return f"""
WITH {corpus},
grams AS ({_grams(documents, "id", "title", "abstract")}),
postings AS (SELECT gram, doc_id, count(*) AS tf FROM grams GROUP BY ALL),
asked AS ({queries}),
hits AS (
  SELECT query_id, doc_id, sum(tf)::bigint AS hits
  FROM asked JOIN postings USING (gram) GROUP BY ALL),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, doc_id))::int AS rank
  FROM hits)
SELECT {columns}
FROM ranked JOIN (SELECT id, title, abstract FROM {documents}) d ON d.id = ranked.doc_id
WHERE rank <= 10"""


FOUND = f"rank, doc_id, hits, title, {_preview('abstract')} AS preview"


def _one(text: str) -> str:
    literal = text.replace("'", "''")
    return _query_grams(f"(SELECT 1 AS one, '{literal}' AS query)", "one", "query")


CORPUS = RECORDS + ", corpus AS (SELECT doc_id AS id, title, abstract FROM records)"
AT_HAND = CORPUS + ", at_hand AS (SELECT * FROM corpus SEMI JOIN labels ON id = labels.doc_id)"

CODE = "('0x' || gram)::bigint"

VIEW = f"""
WITH {STORED},
listed AS (
  SELECT document_id,
         string_agg(r.author_order || ':' || first_name || ' ' || last_name, '|'
                    ORDER BY r.author_order, r.author_id) AS authors
  FROM relation_rows r JOIN author_rows a ON a.id = r.author_id GROUP BY ALL)
SELECT id, doi, title, abstract, issn, pub_year, coalesce(authors, '') AS authors
FROM stored LEFT JOIN listed ON document_id = id"""

ORACLE: dict[str, str] = {
    "ascii_lower": f"""
SELECT doc_id, md5(translate(text, '{UPPER}', '{LOWER}')) AS lowered FROM documents""",
    "query_grams": f"""
SELECT query_id AS item_id, gram FROM ({_query_grams("benchmark", "item_id", "text")})""",
    "trimmed_text": """
SELECT conv_id, turn, trim('  ' || text || chr(9) || ' ', ' ') AS query FROM conversations""",
    "duration_text": """
SELECT doc_id, printf('%02dh %02dm %02ds', (s // 3600)::int, (s % 3600 // 60)::int, (s % 60)::int)
         AS elapsed
FROM (SELECT doc_id, n_chars * 7 AS s FROM documents)""",
    "search_preview": f"""
WITH {RECORDS}
SELECT doc_id, title, {_preview("abstract")} AS preview,
       least(octet_length(encode(abstract)), 120)::int AS preview_bytes
FROM records""",
    "gram_extract": f"""
SELECT doc_id, count(*) AS grams, sum({CODE})::bigint AS code_sum, min({CODE}) AS code_min,
       max({CODE}) AS code_max
FROM ({_grams("documents", "doc_id", "text")}) GROUP BY doc_id""",
    "field_grams": f"""
WITH {CORPUS}
SELECT doc_id, count(*) AS grams, sum({CODE})::bigint AS code_sum, min({CODE}) AS code_min,
       max({CODE}) AS code_max
FROM ({_grams("corpus", "id", "title", "abstract")}) GROUP BY doc_id""",
    "postings_tf": f"""
SELECT gram, doc_id, count(*) AS tf FROM ({_grams("documents", "doc_id", "text")}) GROUP BY ALL""",
    "stored_postings": f"""
WITH {STORED}
SELECT gram, doc_id, count(*) AS tf FROM ({_grams("stored", "id", "title", "abstract")})
GROUP BY ALL""",
    "gram_vocab": f"""
SELECT gram, count(DISTINCT doc_id) AS docs, count(*) AS occurrences
FROM ({_grams("documents", "doc_id", "text")}) GROUP BY gram""",
    "index_append": f"""
WITH {STORED}
SELECT doc_id, 2 * count(*) AS index_rows FROM ({_grams("stored", "id", "title", "abstract")})
GROUP BY doc_id""",
    "index_replay": f"""
WITH {STORED}
SELECT doc_id, count(*) AS index_rows FROM ({_grams("stored", "id", "title", "abstract")})
GROUP BY doc_id""",
    "search_single": _search(STORED, "stored", _one(SEARCH_TEXT), FOUND),
    "search_accented": _search(STORED, "stored", _one(ACCENTED_TEXT), FOUND),
    "search_batch": _search(
        STORED, "stored", _query_grams("benchmark", "item_id", "text"), "query_id, " + FOUND
    ),
    "full_pipeline": _search(
        STORED, "stored", _query_grams("benchmark", "item_id", "text"), "query_id, " + FOUND
    ),
    "search_batch_conversations": _search(
        STORED,
        "stored",
        _query_grams("conversations", "conv_id * 1000 + turn", "text"),
        "query_id, " + FOUND,
    ),
    "search_batch_windows": _search(
        STORED, "stored", _query_grams("benchmark", "item_id", "text", 32), "query_id, " + FOUND
    ),
    "search_batch_repeated_ids": f"""
WITH asked_by AS (SELECT row_number() OVER () AS row_id, conv_id, text AS query
                  FROM conversations),
answers AS ({_search(STORED, "stored", _query_grams("asked_by", "row_id", "query"), "query_id, rank, doc_id, hits")})
SELECT conv_id AS query_id, rank, doc_id, hits FROM answers JOIN asked_by ON row_id = answers.query_id""",
    "search_batch_copies": _search(
        STORED,
        "stored",
        _query_grams("customer", "c_custkey", "c_mktsegment"),
        "query_id, rank, doc_id, hits",
    ),
    "search_short_query": _search(
        STORED,
        "stored",
        _query_grams(
            """(SELECT n_nationkey::bigint AS query_key,
                       CASE WHEN n_nationkey % 2 = 0 THEN substr(n_name, 1, 2)
                            ELSE '  ' || n_name || ' ' END AS query FROM nation)""",
            "query_key",
            "query",
        ),
        "query_id, " + FOUND,
    ),
    "search_existing_documents": _search(AT_HAND, "at_hand", _one(SEARCH_TEXT), FOUND),
    "records_parse": f"""
WITH {RECORDS},
listed AS (
  SELECT doc_id, string_agg(first_name || ' ' || last_name || ' ' || initial, '|'
                            ORDER BY author_order) AS authors
  FROM record_authors GROUP BY doc_id)
SELECT file_path, doi, title, abstract, issn, pub_year, coalesce(authors, '') AS authors
FROM records LEFT JOIN listed USING (doc_id)""",
    "records_rejects": f"""
WITH {RECORDS}
SELECT file_path,
       CASE WHEN doc_id % 10 IN (1, 2, 6) THEN 'bad_json'
            WHEN doc_id % 10 IN (3, 7) THEN 'no_metadata'
            ELSE 'no_doi' END AS reason
FROM records WHERE doc_id % 10 NOT IN (0, 8)""",
    "records_repeated_keys": f"""
WITH {RECORDS},
listed AS (
  SELECT doc_id, string_agg(first_name || ' ' || last_name || ' ' || initial, '|'
                            ORDER BY author_order) AS authors
  FROM record_authors GROUP BY doc_id),
good AS (SELECT *, doc_id % 5 < 4 AS ok FROM records LEFT JOIN listed USING (doc_id))
SELECT CASE WHEN NOT ok THEN 'bad_json' END AS reason, file_path, CASE WHEN ok THEN doi END AS doi,
       CASE WHEN ok THEN title END AS title, CASE WHEN ok THEN abstract END AS abstract,
       CASE WHEN ok THEN issn END AS issn, CASE WHEN ok THEN pub_year ELSE 0 END AS pub_year,
       CASE WHEN ok THEN coalesce(authors, '') ELSE '' END AS authors
FROM good""",
    "author_cap": """
SELECT l_partkey::varchar AS doi, author_order, l_orderkey AS orderkey, l_suppkey AS suppkey,
       '' AS initial
FROM (SELECT l_partkey, l_orderkey, l_suppkey,
             (row_number() OVER (PARTITION BY l_partkey
                ORDER BY l_orderkey, l_linenumber, l_suppkey) - 1)::int AS author_order
      FROM lineitem)
WHERE author_order < 32""",
    "first_wins": f"""
WITH {RECORDS}
SELECT doi, min(file_path) AS file_path FROM records GROUP BY doi""",
    "documents_dedup": f"""
WITH {STORED}
SELECT id, doi, title, abstract, issn, pub_year FROM stored""",
    "authors_distinct": f"""
WITH {STORED}
SELECT id, first_name, last_name, initial FROM author_rows""",
    "relations": f"""
WITH {STORED}
SELECT document_id, author_id, author_order FROM relation_rows""",
    "relations_staged": f"""
WITH {STORED}
SELECT doi, author_order, first_name, last_name, initial FROM staged""",
    "relations_first_order": f"""
WITH {STORED}
SELECT document_id, author_id, author_order FROM relation_rows""",
    "reingest_merge": f"""
WITH {TWICE}
SELECT s.id AS document_id, s.doi, s.issn, s.pub_year, a.id AS author_id, r.author_order,
       a.first_name, a.last_name, a.initial
FROM stored s LEFT JOIN (relation_rows r JOIN author_rows a ON a.id = r.author_id)
  ON r.document_id = s.id""",
    "document_view": VIEW,
    "document_lookup": VIEW + " WHERE id IN (SELECT doc_id FROM labels)",
    "ingest_report": f"""
WITH {STORED},
n AS (
  SELECT (SELECT count(*) FROM stored) AS d, (SELECT count(*) FROM records) AS f,
         (SELECT count(*) FROM staged) AS s, (SELECT count(*) FROM author_rows) AS a,
         (SELECT count(*) FROM relation_rows) AS r)
SELECT d AS files_processed, 0::bigint AS parse_errors, f - d AS duplicate_files,
       d AS documents_inserted, s AS authors_staged, a AS authors_inserted,
       r AS relations_inserted, 2 * d + d AS doc_ops_total, 2 * s + a AS author_ops_total,
       2 * s + r AS rel_ops_total
FROM n""",
    "ingest_progress": f"""
WITH {TWICE}
SELECT 'first' AS run_id, 0::bigint AS batch, (SELECT count(*) FROM w1) AS files,
       0::bigint AS errors, (SELECT count(*) FROM s1) AS relations
UNION ALL
SELECT 'second', 0, (SELECT count(*) FROM w2), 0, (SELECT count(*) FROM s2)""",
    "index_report": f"""
WITH {STORED},
grams AS ({_grams("stored", "id", "title", "abstract")})
SELECT (SELECT count(*) FROM stored) AS docs_indexed,
       (SELECT count(*) FROM grams) AS grams_generated,
       (SELECT count(*) FROM grams) AS grams_inserted,
       (SELECT count(*) FROM (SELECT DISTINCT gram, doc_id FROM grams)) AS postings""",
    "table_counts": f"""
WITH {STORED}
SELECT 'documents' AS table_name, count(*) AS rows FROM stored
UNION ALL SELECT 'authors', count(*) FROM author_rows
UNION ALL SELECT 'documents_x_authors', count(*) FROM relation_rows
UNION ALL SELECT 'ngrams', count(*) FROM ({_grams("stored", "id", "title", "abstract")})""",
    "sample_titles": f"""
WITH {STORED}
SELECT id, title FROM stored ORDER BY id LIMIT 5""",
    "ingest_files": f"""
WITH {STORED}
SELECT doi, title, abstract,
       (greatest(octet_length(encode(title)) - 2, 0)
        + greatest(octet_length(encode(abstract)) - 2, 0))::bigint AS grams,
       (SELECT count(*) + count(*) FILTER (doc_id % 10 = 0) FROM records) AS files_seen,
       (SELECT count(*) FILTER (doc_id % 10 = 0) FROM records) AS parse_errors,
       (SELECT count(*) FROM stored) AS files_processed
FROM stored""",
    "ingest_manifest": f"""
WITH {STORED},
n AS (
  SELECT (SELECT count(*) FROM records) AS f, (SELECT count(*) FROM records WHERE doc_id % 4 = 0) AS b,
         (SELECT count(*) FROM stored) AS d)
SELECT f + b + 3 AS files_seen, b + 3 AS parse_errors, f - d AS duplicate_files,
       d AS files_processed, d AS documents_inserted, d AS last_document_id
FROM n""",
    "stream_relations": f"""
WITH {STORED}
SELECT doi, min(author_order) AS author_order, first_name, last_name, initial
FROM staged GROUP BY doi, first_name, last_name, initial""",
    "index_compacted": f"""
WITH {STORED}
SELECT doi,
       (greatest(octet_length(encode(title)) - 2, 0)
        + greatest(octet_length(encode(abstract)) - 2, 0))::bigint AS index_rows
FROM stored
WHERE greatest(octet_length(encode(title)), octet_length(encode(abstract))) > 2""",
    "stream_ingest": f"""
WITH {STORED}
SELECT doi, title, abstract,
       (greatest(octet_length(encode(title)) - 2, 0)
        + greatest(octet_length(encode(abstract)) - 2, 0))::bigint AS grams
FROM stored""",
}
