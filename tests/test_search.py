import json
from collections import Counter

import pyarrow as pa
import pytest

from corpusloom.operators import hits
from corpusloom.plans import index as index_plans
from corpusloom.plans import search as plans
from corpusloom.plans.full import run_all
from corpusloom.plans.index import build_index, index_load
from corpusloom.plans.ingest import ingest
from corpusloom.plans.report import index_report, timed
from corpusloom.plans.search import literal_grams, search, search_batch, search_batch_stored, search_stored
from corpusloom.plans.view import document_view
from corpusloom.sources import tables as stored_tables
from corpusloom.sources.tables import Tables

TEXTS = {
    "d1": ("Cancer diagnosis", "Early diagnosis of cancer in dogs"),
    "d2": ("Bone fracture", "cancer"),
    "d3": ("L'Été à Paris", "open access"),
    "d4": ("ab", "c"),
    "d5": ("", "diagnosis diagnosis diagnosis"),
    "d6": ("cancer", ""),
    "d7": ("", "Cancer"),
}
QUERIES = ["cancer diagnosis", "été", "open access", "ab", "  DIAGNOSIS ", "zzz", "   "]


def brute(documents, query, k=10):
    grams = set(literal_grams(query))
    hits = Counter()
    for d in documents:
        for field in (d.title, d.abstract):
            data = field.encode().lower()
            hits[d.id] += sum(data[i : i + 3] in grams for i in range(len(data) - 2))
    ranked = sorted(((n, i) for i, n in hits.items() if n), key=lambda x: (-x[0], x[1]))
    return [(r + 1, i, n) for r, (n, i) in enumerate(ranked[:k])]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """One stored and indexed corpus; a test that changes it puts it back."""
    root = tmp_path_factory.mktemp("corpus")
    (root / "in").mkdir()
    for doi, (title, abstract) in TEXTS.items():
        metadata = {"doi": doi, "title": title, "authors": [{"first": "F", "last": doi}]}
        (root / "in" / doi).write_text(json.dumps({"abstract": abstract, "metadata": metadata}))
    tables = Tables(spark, str(root / "db"))
    ingest(tables, str(root / "in"))
    build_index(tables)
    return tables


def found(df):
    return [(r["rank"], r.doc_id, r.hits) for r in df.collect()]


def asked(spark, queries):
    return spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")


def by_query(df):
    rows = {}
    for r in df.orderBy("query_id", "rank").collect():
        rows.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.hits))
    return rows


def test_single_search(corpus):
    documents = corpus.documents().collect()
    for q in QUERIES:
        assert found(search(corpus.postings(), corpus.documents(), q)) == brute(documents, q)
    top = search(corpus.postings(), corpus.documents(), "cancer diagnosis", k=2)
    assert found(top) == brute(documents, "cancer diagnosis", 2)
    rows, ms = timed(top)
    assert len(rows) == 2 and rows[0].title == "Cancer diagnosis" and ms > 0


@pytest.mark.parametrize("terms", [500_000, 4])
def test_batch_search(spark, corpus, monkeypatch, terms):
    """Also in many slices, and with copies of queries."""
    monkeypatch.setattr(plans, "TERMS_PER_SLICE", terms)
    documents = corpus.documents().collect()
    queries = QUERIES + ["cancer"] * 20
    got = by_query(search_batch(corpus.postings(), corpus.documents(), asked(spark, queries), k=3))
    expected = {i: brute(documents, q, 3) for i, q in enumerate(queries)}
    assert got == {i: rows for i, rows in expected.items() if rows}


def test_pairs_of_sets_and_documents_are_no_rows(spark, corpus):
    """Hits are summed in blocks of documents; only a task's k best per set become rows."""
    index = corpus.index()
    terms = spark.createDataFrame([(0, 10, bytearray(b"can")), (1, 10, bytearray(b"dia"))], "set_no long, tier int, gram binary")
    text = plan(plans._top_of(index.postings, corpus.documents(), terms, 2, False)).split("== Initial Plan ==")[0]
    lines = text.splitlines()
    assert any("MapInArrow" in line and "hits" in line for line in lines)
    assert not any("Aggregate(keys=[set_no" in line and "doc_id" in line for line in lines), text


def test_ties_and_blocks(spark, monkeypatch):
    """Equal hits over many blocks: the lower ids rank, also beyond 32 bits of hits."""
    monkeypatch.setattr(hits, "_DOCUMENTS", 2)
    rows = [(b"abc", d, 5) for d in range(9, 0, -1)] + [(b"bcd", 7, 2**31), (b"bcd", 3, 1), (b"xyz", 2, 9)]
    batch = pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(range(9, 0, -1)),
            "grams": pa.array([[g for g, d, _ in rows if d == i] for i in range(9, 0, -1)]),
            "tfs": pa.array([[n for _, d, n in rows if d == i] for i in range(9, 0, -1)]),
        }
    )
    sets = pa.table({"set_no": [4, 8], "grams": [[b"abc", b"bcd"], [b"xyz", b"zzz"]], "least": [0, 0]})
    out = pa.Table.from_batches(hits.top_hits(lambda: hits.sets_of(sets), 3)(iter([batch]))).to_pylist()
    assert sorted((r["set_no"], -r["hits"], r["doc_id"]) for r in out) == [
        (4, -5 - 2**31, 7), (4, -6, 3), (4, -5, 1), (8, -9, 2)
    ]


def test_rows_that_share_an_id_are_answered_apart(spark, corpus):
    documents = corpus.documents().collect()
    asked_rows = [(1, "cancer"), (1, "open access"), (1, "cancer"), (2, "text\0cancer"), (3, "ab")]
    queries = spark.createDataFrame(asked_rows, "query_id int, query string")
    got = search_batch(corpus.postings(), corpus.documents(), queries, k=2)
    expected = sorted((i, *row) for i, q in asked_rows for row in brute(documents, q, 2))
    assert sorted((r.query_id, r["rank"], r.doc_id, r.hits) for r in got.collect()) == expected


def test_append_doubles_hits(corpus):
    once = found(search(corpus.postings(), corpus.documents(), "cancer"))
    build_index(corpus, mode="append")
    twice = found(search(corpus.postings(), corpus.documents(), "cancer"))
    assert twice == [(r, i, 2 * n) for r, i, n in once]
    build_index(corpus)
    assert found(search(corpus.postings(), corpus.documents(), "cancer")) == once
    with pytest.raises(ValueError):
        build_index(corpus, mode="merge")


def test_only_documents_at_hand_are_ranked(spark, corpus):
    some = corpus.documents().where("doi <> 'd1'")
    everything = brute(some.collect(), "cancer diagnosis", 2)
    got = search(corpus.postings(), some, "cancer diagnosis", k=2, check_documents=True)
    assert found(got) == everything
    batch = search_batch(
        corpus.postings(), some, asked(spark, ["cancer diagnosis"]), k=2, check_documents=True
    )
    assert by_query(batch) == {0: everything}


def plan(df):
    """The final plan of a frame that was run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark, corpus):
    single = search(corpus.postings(), corpus.documents(), "cancer", bounds=None)
    assert "PushedFilters: [Or(Or(" in plan(single) and "EqualTo(gram" in plan(single)
    view = plan(document_view(corpus.documents(), corpus.relations(), corpus.authors(), [1, 2]))
    assert "In(id, [1,2])" in view and "id_block" in view


def test_results_read_no_texts(corpus):
    found = plan(search_stored(corpus, "cancer"))
    assert "results" in found and "preview" in found and "abstract" not in found


def test_hits_are_counted_where_postings_are_read(spark, corpus):
    """No exchange lies between the scan of the postings and the cut to k rows per task."""
    index = corpus.index()
    terms = spark.createDataFrame([(0, 10, bytearray(b"can")), (1, 10, bytearray(b"dia"))], "set_no long, tier int, gram binary")
    batch = plan(plans._top_of(index.postings, corpus.documents(), terms, 2, False))
    hits = index.postings.where("gram = X'63616E'").groupBy("doc_id").agg({"tf": "sum"})
    for text in (batch.split("== Initial Plan ==")[0], plan(hits).split("== Initial Plan ==")[0]):
        lines = text.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line)
        indent = len(lines[scan]) - len(lines[scan].lstrip(" :+-*(0123456789)"))
        above = []
        for line in reversed(lines[:scan]):
            depth = len(line) - len(line.lstrip(" :+-*(0123456789)"))
            if depth < indent:
                above.append(line)
                indent = depth
        names = [x.lstrip(" :+-*(0123456789)").split(" ")[0].split("(")[0] for x in above]
        first = names.index("Exchange") if "Exchange" in names else len(names)
        assert names[:first].count("HashAggregate") == 2, names
        if text.startswith("Adaptive") and "Window" in text and "set_no" in text:
            assert "WindowGroupLimit" in names[:first], names


def test_many_loads_are_joined(corpus, monkeypatch):
    before = found(search_stored(corpus, "cancer diagnosis"))
    monkeypatch.setattr(stored_tables, "_FEW_LOADS", 0)
    assert found(search_stored(corpus, "cancer diagnosis")) == before
    assert corpus.documents().count() == len(TEXTS)


LONG = {
    f"long{i}": ("", " ".join(f"{w} cancer diagnosis" for w in ("alpha", "beta", "gamma")[: 1 + i % 3]) * (60 + i))
    for i in range(12)
}


@pytest.fixture(scope="module")
def tiered(spark, tmp_path_factory):
    """Long and short documents, in two loads that are indexed one by one."""
    root = tmp_path_factory.mktemp("tiered")
    tables = Tables(spark, str(root / "db"))
    short = {f"s{i}": (f"note {i} cancer", "diagnosis zebra" if i % 9 == 0 else "plain") for i in range(80)}
    for name, texts in (("one", {**LONG, **dict(list(short.items())[:40])}), ("two", dict(list(short.items())[40:]))):
        (root / name).mkdir()
        for doi, (title, abstract) in texts.items():
            record = {"abstract": abstract, "metadata": {"doi": doi, "title": title, "authors": []}}
            (root / name / doi).write_text(json.dumps(record))
        ingest(tables, str(root / name), run_id=name)
        index_load(tables, name, partitions=3)
    return tables


ASKED = ["cancer", "zebra", "alpha cancer", "note 7", "cancer diagnosis", "gamma", "zz", "the zebra in plain text"]


@pytest.mark.parametrize("k", [3, 200])
def test_bounds_leave_results_as_they_are(spark, tiered, k):
    documents = tiered.documents().collect()
    got = by_query(search_batch_stored(tiered, asked(spark, ASKED), k=k))
    expected = {i: brute(documents, q, k) for i, q in enumerate(ASKED)}
    assert got == {i: rows for i, rows in expected.items() if rows}
    for q in ASKED[:4]:
        assert found(search_stored(tiered, q, k=k)) == brute(documents, q, k)


def test_postings_that_cannot_rank_are_left_out(spark, tiered):
    search_batch_stored(tiered, asked(spark, ["cancer diagnosis", "alpha cancer"]), k=3).collect()
    row = tiered.searches().orderBy("seconds").collect()[-1]
    last = [r for r in tiered.searches().collect() if (r.queries, r.rows) == (2, 6)]
    assert last and all(r.postings_skipped > 0 and r.postings_read > 0 and r.seconds > 0 for r in last), row


def test_bounds_hold_after_appending(spark, tiered):
    before = by_query(search_batch_stored(tiered, asked(spark, ASKED), k=3))
    build_index(tiered, mode="append")
    after = by_query(search_batch_stored(tiered, asked(spark, ASKED), k=3))
    assert after == {i: [(r, d, 2 * n) for r, d, n in rows] for i, rows in before.items()}
    build_index(tiered)
    assert by_query(search_batch_stored(tiered, asked(spark, ASKED), k=3)) == before


def test_documents_at_hand_with_bounds(spark, tiered):
    some = tiered.documents().where("doi NOT LIKE 'long%'")
    index = tiered.index()
    got = search_batch(
        index.postings, some, asked(spark, ASKED), k=3, check_documents=True, bounds=index.bounds, buckets=index.buckets
    )
    expected = {i: brute(some.collect(), q, 3) for i, q in enumerate(ASKED)}
    assert by_query(got) == {i: rows for i, rows in expected.items() if rows}


def test_load_that_is_cut_off_while_indexed_is_not_seen(tables, folder, article, monkeypatch):
    ingest(tables, folder({"1": article("a", "first text", "more")}, "x"), run_id="one")
    index_load(tables, "one")
    before = sorted(map(str, tables.postings().collect()))
    ingest(tables, folder({"2": article("b", "first text again", "")}, "y"), run_id="two")

    def fail(*_):
        raise RuntimeError("cut off")

    for step in ("_write_bounds", "_write_indexed"):
        with monkeypatch.context() as m:
            m.setattr(Tables, step, fail)
            with pytest.raises(RuntimeError):
                index_load(tables, "two")
        assert sorted(map(str, tables.postings().collect())) == before
        assert len(found(search_stored(tables, "first"))) == 1
    index_load(tables, "two")
    assert len(found(search_stored(tables, "first"))) == 2


def test_indexing_a_load_again_changes_nothing(tables, folder, article):
    ingest(tables, folder({"1": article("a", "first text", "more")}, "x"), run_id="one")
    index_load(tables, "one")
    ingest(tables, folder({"2": article("b", "second text", "")}, "y"), run_id="two")
    index_load(tables, "two")
    before = sorted(map(str, tables.postings().collect()))
    index_load(tables, "one")
    assert sorted(map(str, tables.postings().collect())) == before
    build_index(tables)
    whole = sorted((bytes(r.gram), r.doc_id, r.tf) for r in tables.postings().collect())
    assert len(whole) == len(before)


def test_replayed_load_and_cut_off_build(tables, folder, article, monkeypatch):
    ingest(tables, folder({"1": article("a", "first text", "more")}), run_id="one")
    index_load(tables, "one")
    build_index(tables)
    before = sorted(map(str, tables.postings().drop("load_id").collect()))
    index_load(tables, "one")
    assert sorted(map(str, tables.postings().drop("load_id").collect())) == before

    def fail(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(Tables, "_write_generation", fail)
        with pytest.raises(RuntimeError):
            build_index(tables)
    assert sorted(map(str, tables.postings().drop("load_id").collect())) == before
    build_index(tables)
    build_index(tables)
    assert sorted(map(str, tables.postings().drop("load_id").collect())) == before


def test_postings_belong_to_every_row_of_an_id(spark):
    rows = [(1, "abcd", "", "x"), (1, "", "abc", "y"), (2, "abc", None, "x")]
    documents = spark.createDataFrame(rows, "id long, title string, abstract string, load_id string")
    placed = index_plans._placed(documents, 2)
    assert sorted((bytes(r.gram), r.doc_id, r.tf, r.load_id, r.tier) for r in placed.collect()) == [
        (b"abc", 1, 2, "x", 20), (b"abc", 1, 2, "y", 20), (b"abc", 2, 1, "x", 20),
        (b"bcd", 1, 1, "x", 20), (b"bcd", 1, 1, "y", 20),
    ]
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_compaction_bounds_the_folders(spark, tables, article):
    """Fifty loads; merged postings count once, also when a load is indexed again."""
    from corpusloom.plans.compact import compact_index
    from corpusloom.schemas import POSTINGS

    loads = [f"load-{i:02d}" for i in range(50)]
    rows = [(i + 1, f"d{i}", f"title {i}", "some common text " * (1 + i % 3), loads[i]) for i in range(50)]
    documents = spark.createDataFrame(rows, "id long, doi string, title string, abstract string, load_id string")
    counted = [(x, 1, 10) for x in loads]
    counted = spark.createDataFrame(counted, "load_id string, docs_indexed long, grams_generated long")
    tables.index_all(index_plans._placed(documents, 2), counted, 2, 0.0)
    before = sorted(map(str, tables.postings().drop("load_id").collect()))
    assert compact_index(tables, fan=8) == 1
    assert sorted(map(str, tables.postings().drop("load_id").collect())) == before
    folders = tables.read("postings/000001", POSTINGS).select("load_id").distinct().count()
    assert folders <= 8 + 2 and tables.indexed().count() == folders
    index_load(tables, "load-07")
    assert sorted(map(str, tables.postings().drop("load_id").collect())) == before
    report = index_report(tables.indexed()).first()
    assert (report.docs_indexed, report.grams_generated, report.postings) == (50, 500, len(before))
    assert compact_index(tables, fan=8) == 0


def test_index_report(corpus):
    r = index_report(corpus.indexed()).first()
    grams = sum(max(len(f.encode()) - 2, 0) for t in TEXTS.values() for f in t)
    assert (r.docs_indexed, r.grams_generated, r.grams_inserted) == (7, grams, grams)
    assert r.postings == corpus.postings().count() and len(r.elapsed) == len("00h 01m 01s")
    assert corpus.indexed().first().seconds > 0


def test_document_view(spark, tables, folder, article):
    authors = [("Z", "z", "1"), ("A", "a", "2"), ("Z", "z", "1"), ("M", "m", "3")]
    ingest(tables, folder({"1": article("d", "T", "long", authors, issn="i", pub_year=1999), "2": article("e")}))
    frames = (tables.documents(), tables.relations(), tables.authors())
    ids = {r.doi: r.id for r in tables.documents().collect()}
    views = document_view(*frames, [ids["d"], 999]).collect()
    assert len(views) == 1
    v = views[0]
    assert (v.doi, v.title, v.abstract, v.issn, v.pub_year) == ("d", "T", "long", "i", 1999)
    assert [tuple(a) for a in v.authors] == [(0, "Z", "z"), (1, "A", "a"), (3, "M", "m")]
    assert document_view(*frames, [ids["e"]]).first().authors == []
    wanted = spark.createDataFrame([(ids["d"],), (999,)], "id long")
    assert document_view(*frames, wanted).collect() == views
    assert document_view(*frames).count() == 2


def test_run_all(spark, tables, folder, article):
    root = folder({"1": article("d", "open access", ""), "2": article("e", "closed", "")})
    got = by_query(run_all(tables, root, asked(spark, ["open access", "closed"])))
    assert [rows[0][1:] for rows in got.values()] == [(1, 9), (2, 4)]


def test_blocks_that_cannot_rank_are_not_counted(monkeypatch):
    """Documents come by size: once a set has its k, blocks of smaller ones are left out."""
    monkeypatch.setattr(hits, "_DOCUMENTS", 2)
    counted, block = [], hits._block

    def count(rows, *args):
        counted.append(rows.column("doc_id").to_pylist())
        block(rows, *args)

    monkeypatch.setattr(hits, "_block", count)
    sizes = [3, 9, 1, 8, 2, 7, 9, 1]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(8)), "grams": pa.array([[b"abc", b"xyz"]] * 8), "tfs": pa.array([[n, 1] for n in sizes])}
    )
    sets = pa.table({"set_no": [1], "grams": [[b"abc"]], "least": [0]})
    for rows in (batch, next(hits.packed_documents(iter([batch])))):
        out = pa.Table.from_batches(hits.top_hits(lambda: hits.sets_of(sets), 2)(iter([rows]))).to_pylist()
        assert sorted((-r["hits"], r["doc_id"]) for r in out) == [(-9, 1), (-9, 6)]
    assert counted == [[1, 6], [3, 5]] * 2
