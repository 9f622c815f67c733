import time
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import grams as g
from corpusloom.plans.search import literal_grams


def windows(text):
    data = text.encode().lower()
    return [data[i : i + 3] for i in range(len(data) - 2)]


def one(spark, column, text, kind="string"):
    df = spark.createDataFrame([(text,)], f"t {kind}")
    return df.select(column.alias("x")).first()["x"]


def test_lower_case_is_ascii_only(spark):
    assert one(spark, tx.ascii_lower("t"), "ÉTÉ Abc Ж") == "ÉtÉ abc Ж"


def test_trim_takes_spaces_only(spark):
    assert one(spark, tx.trim_spaces("t"), "  \tab\n ") == "\tab\n"


def test_query_grams(spark):
    def grams(q):
        return sorted(bytes(x) for x in one(spark, tx.query_grams("t"), q))

    assert grams("ab") == [] and grams("   ") == [] and grams("") == []
    assert grams(" ABC ") == [b"abc"]
    assert grams("aaaaaa") == [b"aaa"]
    assert grams("é1") == ["é1".encode()]
    long = "".join(chr(97 + i % 26) + str(i % 10) for i in range(30))
    assert grams(long) == sorted(set(windows(long))) == literal_grams(long)
    first = sorted(bytes(x) for x in one(spark, tx.query_grams("t", 32), long))
    assert first == sorted(set(windows(long)[:32])) == literal_grams(long, 32)
    for odd in ["text\0alpha", " \0 ", "É\0é ABC"]:
        assert grams(odd) == literal_grams(odd)


def test_query_grams_take_time_in_proportion(spark):
    """A query of 40,000 windows: made anew per window, or compared pair by pair, it took minutes."""
    text = "".join(chr(97 + i * i % 23) + chr(97 + i // 676 % 26) + chr(97 + i // 26 % 26) for i in range(13_334))
    frame = spark.createDataFrame([(text,)], "q string")
    started = time.monotonic()
    found = frame.select(tx.query_grams("q").alias("g")).first().g
    assert time.monotonic() - started < 20
    assert [bytes(x) for x in found] == list(dict.fromkeys(windows(text)))


def test_preview_keeps_whole_characters(spark):
    cases = ["é" * 100, "a" * 119 + "é", "a" * 118 + "日", "x" + "😀" * 40, "short", ""]
    for text in cases:
        shown = one(spark, tx.preview("t"), text)
        assert text.startswith(shown)
        rest = text[len(shown) : len(shown) + 1]
        assert len(shown.encode()) <= 120
        assert not rest or len((shown + rest).encode()) > 120
        assert bytes(one(spark, tx.preview_bytes("t"), text)) == text.encode()[:120]
    assert one(spark, tx.preview("t"), None) == ""


def test_shown_values(spark):
    assert one(spark, tx.shown_title("t"), None) == "(null)"
    assert one(spark, tx.shown_title("t"), "") == ""
    assert one(spark, tx.shown_text("t"), None) == ""


def test_duration(spark):
    for seconds, shown in [(0.0, "00h 00m 00s"), (59.9, "00h 00m 59s"), (3725.5, "01h 02m 05s"),
                           (360000.0, "100h 00m 00s")]:
        assert one(spark, tx.duration("t"), seconds, "double") == shown


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(max_size=40), st.text(max_size=12)), min_size=1, max_size=8))
def test_counted_grams_match_brute_force(spark, docs):
    docs = [(t.encode("utf-8", "ignore").decode(), a.encode("utf-8", "ignore").decode()) for t, a in docs]
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "id long, title string, abstract string")
    found = {
        (r.doc_id, bytes(r.gram)): r.tf
        for r in g.count_grams(frame, "id", ["title", "abstract"]).collect()
    }
    expected = Counter((i, w) for i, d in enumerate(docs) for field in d for w in windows(field))
    assert found == dict(expected)


def test_long_text_is_cut_without_losing_windows(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(3 * 65536 + 5))
    frame = spark.createDataFrame([(1, text)], "id long, text string")
    found = {bytes(r.gram): r.tf for r in g.count_grams(frame, "id", ["text"]).collect()}
    assert found == dict(Counter(windows(text)))
    exact = spark.createDataFrame([(1, "x" * (65536 + 2))], "id long, text string")
    assert [r.tf for r in g.count_grams(exact, "id", ["text"]).collect()] == [65536]


def test_grams_do_not_span_fields(spark):
    frame = spark.createDataFrame([(1, "ab", "c")], "id long, title string, abstract string")
    assert g.count_grams(frame, "id", ["title", "abstract"]).count() == 0


def test_counting_needs_no_shuffle_of_grams(spark):
    frame = spark.range(10).select("id", F.col("id").cast("string").alias("text"))
    plan = g.count_grams(frame, "id", ["text"], partitions=3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("Generate") < plan.index("Exchange")


def test_documents_are_counted_one_at_a_time(spark):
    """The memory of a task is that of a document: no hash map over its part of the grams."""
    frame = spark.range(10).select("id", F.col("id").cast("string").alias("text"))
    plan = g.count_grams(frame, "id", ["text"], partitions=3)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_rows_that_share_an_id_are_counted_together(spark, monkeypatch):
    """Also null ids, a document that spans batches, and kept columns."""
    rows = [(1, "abcd", "x"), (2, "abc" * 40_000, "y"), (None, "abc", "z"), (1, "bcde", "x"), (None, "ABC", "z"), (3, None, "x")]
    frame = spark.createDataFrame(rows, "id long, text string, kind string")
    expected = Counter()
    for i, text, kind in rows:
        expected.update((i, kind, w) for w in windows(text or ""))
    for limit in (str(1), str(10_000)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
        found = g.count_grams(frame, "id", ["text"], partitions=2, keep=["kind"]).collect()
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert {(r.doc_id, r.kind, bytes(r.gram)): r.tf for r in found} == dict(expected)
        assert len(found) == len(expected)
