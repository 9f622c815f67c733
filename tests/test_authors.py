from pyspark.sql import functions as F

from corpusloom.operators.dedup import explode_authors, first_authors
from corpusloom.plans import view
from corpusloom.plans.ingest import ingest, load_records
from corpusloom.plans.view import document_view
from corpusloom.schemas import RECORDS
from test_ingest import plan


def test_repeated_names_of_a_record_are_dropped_without_a_shuffle(spark):
    rows = [
        (1, [("B", None, "x"), ("A", "L", ""), ("B", None, "x"), ("A", "L", ""), ("A", "L", "y"), None]),
        (None, [("A", "L", "")] * 3),
        (2, []),
        (3, None),
    ]
    records = spark.createDataFrame(rows, "k int, authors array<struct<first string, last string, initial string>>")
    firsts = first_authors(records, "k")
    every = explode_authors(records, "k")
    least = every.groupBy("k", "first_name", "last_name", "initial").agg(F.min("author_order").alias("author_order"))
    assert sorted(map(repr, firsts.collect())) == sorted(map(repr, least.select(*firsts.columns).collect()))
    assert "Exchange" not in plan(firsts)


def test_relations_are_unique_where_records_share_a_path(spark, tables):
    authors = [("F", "A", ""), ("F", "B", "")]
    rows = [("p", None, "d", "t", "a", "", 0, authors), ("p", None, "d", "t", "a", "", 0, authors[::-1])]
    load_records(tables, spark.createDataFrame(rows, RECORDS), "r", "r")
    got = tables.relations().join(tables.authors().withColumnRenamed("id", "author_id"), "author_id")
    assert sorted((r.last_name, r.author_order) for r in got.collect()) == [("A", 0), ("B", 0)]


def test_view_gathers_authors_in_parts_by_their_number(spark, tables, folder, article, monkeypatch):
    names = [("F", f"a{i}", "") for i in range(9)]
    ingest(tables, folder({str(i): article(f"d{i}", authors=names[i:]) for i in range(9)}))
    asked = (tables.documents(), tables.relations(), tables.authors())
    before = document_view(*asked)
    monkeypatch.setattr(view, "_ROWS_PER_TASK", 5)
    after = document_view(*asked)
    assert "hashpartitioning(document_id" in plan(after) and "REPARTITION_BY_NUM" in plan(after)
    assert sorted(after.collect()) == sorted(before.collect())
    assert [a.author_order for a in after.where("doi = 'd3'").first().authors] == list(range(6))
