import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import grams
from corpusloom.operators.grams import _count_slices, count_grams, explode_grams


@pytest.mark.parametrize("counted", [20, 1 << 20])
def test_postings_come_in_the_order_of_an_index(spark, monkeypatch, counted):
    monkeypatch.setattr(grams, "_COUNTED", counted)
    texts = [(None, 3, b"abcabc"), (1, 21, b"abcd" * 9), (1, 21, b"cdab"), (2, 20, b"zabc"), (3, 21, b"abc"), (4, 20, b"bcd")]
    batch = pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([t[0] for t in texts], pa.int64()),
            "load_id": pa.array(["b", "a", "a", "a", "a", "a"]),
            "tier": pa.array([t[1] for t in texts], pa.int32()),
            "data": pa.array([t[2] for t in texts], pa.binary()),
        }
    )
    order = ("load_id", "tier")
    found = list(_count_slices(iter([batch, batch.slice(6)]), order))
    plain = list(_count_slices(iter([batch]), ()))

    def rows(batches):
        return [tuple(r.values()) for b in batches for r in b.to_pylist()]

    assert sorted(map(repr, rows(found))) == sorted(map(repr, rows(plain)))
    assert sum(r[-1] for r in rows(found)) == sum(len(t[2]) - 2 for t in texts)
    assert len({(r[0], r[1]) for r in rows(found)}) == len(rows(found))
    for b in found:
        keys = [(r["load_id"], r["tier"], r["gram"], r["doc_id"] or 0) for r in b.to_pylist()]
        assert keys == sorted(keys)
    assert counted == 20 or len(found) == 2


def test_counts_equal_the_windows(spark, monkeypatch):
    monkeypatch.setattr(grams, "_SLICE", 50)
    texts = ["ab" * n + chr(97 + n % 5) * 7 for n in range(0, 200, 7)] + [None, "", "xy"]
    documents = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "id long, text string")
    counted = count_grams(documents, "id", ["text"], 2)
    windows = explode_grams(documents, "id", ["text"]).groupBy("gram", "doc_id").agg(F.count("*").alias("tf"))
    assert sorted(map(repr, counted.collect())) == sorted(map(repr, windows.collect()))
