"""Registered queries over the smallest test tables: against SQL, or brute force."""

import hashlib
import html
import os
import re
from zlib import crc32

import duckdb
import pytest
from corpusloom.llm.oracle import LLM_ORACLE
from corpusloom.llm.queries import LLM_QUERIES
from test_jaccard import brute as brute_links
from test_suffixes import brute as brute_repeats

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_equals_its_sql(spark, sql, name):
    frame = LLM_QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(repr(tuple(r)) for r in frame.select(*columns).collect())
    result = sql.execute(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLE[name]})")
    assert got == sorted(map(repr, result.fetchall()))


def documents(sql):
    return sql.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_links_of_all_documents(spark, sql):
    rows = LLM_QUERIES["op1_ngram_jaccard_join"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in rows) == brute_links(documents(sql))


def test_repeated_bytes_of_all_documents(spark, sql):
    rows = LLM_QUERIES["op9_suffix_array_dedup"](spark, SF).collect()
    got = sorted((r.doc_id, r.kept_sha256, r.n_bytes, r.n_removed, r.n_spans) for r in rows)
    texts = documents(sql)
    expected = brute_repeats([t for _, t in texts], 200)
    assert got == sorted((i, hashlib.sha256(k).hexdigest(), *n) for (i, _), (k, *n) in zip(texts, expected, strict=True))


def test_benchmark_items_of_all_documents(spark, sql):
    rows = LLM_QUERIES["op10_decontamination"](spark, SF).collect()
    squash = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = sql.execute("SELECT item_id, text FROM benchmark").fetchall()
    whole = {(d, i) for d, t in documents(sql) for i, x in items if f" {squash(x)} " in f" {squash(t or '')} "}
    assert whole <= {(r.doc_id, r.item_id) for r in rows}
    assert all(r.overlap >= 0.5 for r in rows)


def test_articles_of_all_pages(spark, sql):
    rows = {r.page_id: r for r in LLM_QUERIES["op6_html_extraction"](spark, SF).collect()}
    for page_id, url, page in sql.execute("SELECT page_id, url, html FROM pages").fetchall():
        inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        text = " ".join(html.unescape(re.sub(r"</?(?:h1|p|br)>", " ", inside).replace("<b>", "").replace("</b>", "")).split())
        assert (rows[page_id].url, rows[page_id].text, rows[page_id].n_chars) == (url, text, len(text))


def test_toxicity_scores_all_documents(spark, sql):
    rows = LLM_QUERIES["op3_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, _ in documents(sql)]
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_sequences_of_all_documents(spark, sql):
    rows = LLM_QUERIES["op2_best_fit_packing"](spark, SF).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in documents(sql)}
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 2
