import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.keys import KEY_PARTS, dense_ids, key_part
from corpusloom.plans.ingest import ingest
from corpusloom.plans.report import ingest_report
from corpusloom.schemas import DOCUMENT_KEYS, DOCUMENTS
from corpusloom.session import Workspace, shared_folder
from corpusloom.sources.tables import Tables


def stored(tables):
    """{doi: (title, [(order, first, last)])} of everything stored."""
    authors = tables.authors().withColumnRenamed("id", "author_id")
    links = {}
    for r in tables.relations().join(authors, "author_id").collect():
        links.setdefault(r.document_id, []).append((r.author_order, r.first_name, r.last_name))
    return {d.doi: (d.title, sorted(links.get(d.id, []))) for d in tables.documents().collect()}


A, B, C = ("Ann", "A", ""), ("Bob", "B", "x"), ("Cy", "C", "")


def test_first_file_of_a_doi_wins_inside_a_run(tables, folder, article):
    root = folder({"1": article("d", "one", authors=[A]), "2": article("d", "two", authors=[B])})
    report = ingest(tables, root).first()
    assert stored(tables) == {"d": ("one", [(0, "Ann", "A")])}
    assert (report.files_seen, report.files_processed, report.duplicate_files) == (2, 1, 1)
    assert tables.authors().count() == 1


def test_later_run_keeps_metadata_and_adds_authors(tables, folder, article):
    ingest(tables, folder({"1": article("d", "one", authors=[A])}, "x"))
    ingest(tables, folder({"2": article("d", "two", authors=[B, A])}, "y"))
    assert stored(tables) == {"d": ("one", [(0, "Ann", "A"), (0, "Bob", "B")])}


def test_repeated_and_blank_authors(tables, folder, article):
    root = folder({"1": article("d", authors=[A, B, A, None, "x", B])})
    report = ingest(tables, root).first()
    assert stored(tables)["d"][1] == [(0, "Ann", "A"), (1, "Bob", "B"), (3, "", "")]
    assert (report.authors_staged, report.relations_inserted, report.authors_inserted) == (6, 3, 3)


def test_missing_fields_are_stored_empty(tables, folder):
    ingest(tables, folder({"1": '{"metadata":{"doi":"d"}}'}))
    d = tables.documents().first()
    assert (d.title, d.abstract, d.issn, d.pub_year) == ("", "", "", 0)


def test_running_again_adds_nothing(tables, folder, article):
    root = folder({str(i): article(f"d{i}", authors=[A, B] if i % 2 else [C]) for i in range(20)})
    ingest(tables, root)
    before = [sorted(map(tuple, t.collect())) for t in (tables.documents(), tables.authors(), tables.relations())]
    again = ingest(tables, root).first()
    after = [sorted(map(tuple, t.collect())) for t in (tables.documents(), tables.authors(), tables.relations())]
    assert before == after
    assert (again.documents_inserted, again.authors_inserted, again.relations_inserted) == (0, 0, 0)


def test_two_ingests_equal_one(spark, tables, folder, article, tmp_path):
    from corpusloom.sources.tables import Tables

    files = {str(i): article(f"d{i}", f"t{i}", authors=[A, B][: i % 3]) for i in range(12)}
    whole = Tables(spark, str(tmp_path / "whole"))
    ingest(whole, folder(files, "all"))
    names = list(files)
    ingest(tables, folder({n: files[n] for n in names[:5]}, "p1"))
    ingest(tables, folder({n: files[n] for n in names[5:]}, "p2"))
    assert stored(tables) == stored(whole)
    assert sorted(r.id for r in tables.documents().select("id").collect()) == list(range(1, 13))


def test_reports(tables, folder, article):
    root = folder({"1": article("d", authors=[A, A]), "2": article("d"), "3": "{", "4": article("e", authors=[B])})
    ingest(tables, root, run_id="r")
    r = ingest_report(tables.loads()).first()
    assert (r.files_processed, r.parse_errors, r.duplicate_files) == (2, 1, 1)
    assert (r.doc_ops_total, r.author_ops_total, r.rel_ops_total) == (2 * 2 + 2, 2 * 3 + 2, 2 * 3 + 2)
    counts = {x.table_name: x.rows for x in tables.counts().collect()}
    assert counts == {"documents": 2, "authors": 2, "documents_x_authors": 2, "ngrams": 0}


def test_files_that_give_no_record_are_counted(tables, folder, article, tmp_path):
    root = folder({"1": article("d", authors=[A]), "deep/2": article("e"), "deep/empty": "", "bad": "{"})
    (tmp_path / "in" / "torn.gz").write_bytes(b"\x1f\x8b no gzip at all")
    report = ingest(tables, root).first()
    assert (report.files_seen, report.parse_errors, report.files_processed) == (5, 3, 2)
    assert set(stored(tables)) == {"d", "e"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_loads_read_few_key_folders(spark, tables, folder, article):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    ingest(tables, folder({str(i): article(f"d{i}", authors=[("F", f"a{i}", "")]) for i in range(300)}, "many"))
    batch = spark.createDataFrame([(f"d{i}",) for i in range(10)], "doi string")
    known = tables.known_ids("document_keys", DOCUMENT_KEYS, batch)
    assert known.count() == 10
    parts = batch.select(key_part(["doi"])).distinct().count()
    read = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(known))[1]
    assert parts <= 10 < KEY_PARTS / 10 and re.search(r"key_part#\d+ IN(SET)? ", read)
    assert len(re.findall(r"\d+", re.search(r"key_part#\d+ IN(?:SET)? ([\d, ()]+)", read)[1])) == parts
    ids = {r.doi: r.id for r in tables.documents().collect()}
    assert {r.doi: r.id for r in known.collect()} == {d: ids[d] for d in (f"d{i}" for i in range(10))}
    assert tables.last_ids() == (300, 300)


@pytest.mark.parametrize("step", ["append_entities", "append_keys", "write_results", "write_load"])
def test_load_that_is_cut_off_is_not_seen_and_taken_back(tables, folder, article, monkeypatch, step):
    ingest(tables, folder({"1": article("d", "one", "text", authors=[A])}, "x"), run_id="first")
    before = stored(tables)
    root = folder({"2": article("e", "two", "text", authors=[B]), "3": article("d", "no", authors=[C])}, "y")
    real = getattr(Tables, step)
    calls = []

    def cut_off(self, *args):
        real(self, *args) if step != "write_load" else None
        calls.append(args)
        if step != "append_entities" or len(calls) == 2:
            raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(Tables, step, cut_off)
        with pytest.raises(RuntimeError, match="cut off"):
            ingest(tables, root, run_id="second")
    assert stored(tables) == before and tables.results().count() == 1 and tables.authors().count() == 1
    ingest(tables, root, run_id="third")
    assert stored(tables) == {"d": ("one", [(0, "Ann", "A"), (0, "Cy", "C")]), "e": ("two", [(0, "Bob", "B")])}
    assert sorted(r.id for r in tables.documents().collect()) == [1, 2]
    assert tables.read("documents", DOCUMENTS).where("load_id = 'second'").count() == 0


def test_names_of_runs_are_plain(tables, folder, article):
    with pytest.raises(ValueError, match="named by"):
        ingest(tables, folder({"1": article("d")}), run_id="a/b")


def test_hot_doi_and_hot_author(spark, tables):
    """A third of the files share a DOI; every record names the same author."""
    from corpusloom.plans.ingest import load_records
    from corpusloom.schemas import RECORDS

    n = 3000
    hot = F.col("id") % 3 == 0
    records = spark.range(n).select(
        F.format_string("%08d", "id").alias("file_path"),
        F.lit(None).cast("string").alias("reason"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("d"), "id")).alias("doi"),
        F.col("id").cast("string").alias("title"),
        F.lit("").alias("abstract"),
        F.lit("").alias("issn"),
        F.lit(0).alias("pub_year"),
        F.array(
            F.struct(F.lit("X").alias("first"), F.lit("").alias("last"), F.lit("").alias("initial"))
        ).alias("authors"),
    )
    load_records(tables, records.select(*RECORDS.names), "r", "r")
    assert tables.documents().count() == 2001
    assert tables.documents().where("doi = 'hot'").first().title == "0"
    assert tables.authors().count() == 1 and tables.relations().count() == 2001


def test_dense_ids(spark):
    rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    work = Workspace(spark)
    got = dense_ids(rows.repartition(7), ["k"], "id", 40, work).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.k)] == list(range(41, 5041))
    none = dense_ids(rows.where("k < ''"), ["k"], "id", 0, work)
    assert none.count() == 0


def test_work_area_follows_the_session():
    def session(**conf):
        return SimpleNamespace(conf=conf)

    settings = {"spark.checkpoint.dir": "hdfs://shared/dir/", "spark.master": "yarn"}
    assert shared_folder(session(**settings)) == "hdfs://shared/dir"
    with pytest.raises(ValueError):
        shared_folder(session(**{"spark.master": "yarn"}))


def test_work_area_is_cleared(spark):
    work = Workspace(spark)
    assert work.save(spark.range(3).toDF("id"), "t").count() == 3
    path = work._saved[0][0]
    work.clear()
    assert spark.read.parquet(path).count() == 0
