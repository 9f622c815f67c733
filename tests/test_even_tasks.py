import threading

from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.session import Workspace, even_tasks
from test_ingest import plan


def test_rows_of_few_bytes_are_no_broadcast(spark):
    work = Workspace(spark)
    many = work.save(spark.range(20000).select(F.col("id").alias("k"), F.lit("same").alias("name")), "many")
    other = work.save(spark.range(20000).select(F.col("id").alias("k"), F.lit(1).alias("n")), "other")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "400000")
    try:
        assert "BroadcastHashJoin" in plan(many.join(other, "k"))
        with even_tasks(spark):
            shuffled = many.join(other, "k")
            assert "BroadcastHashJoin" not in plan(shuffled) and shuffled.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    work.clear()


def test_work_tables_are_freed_side_by_side(spark, monkeypatch):
    work = Workspace(spark)
    kept = work.save(spark.range(5).toDF("k"), "kept")
    saved = [work.save(spark.range(5).toDF("k"), name) for name in ("a", "b")]
    both = threading.Barrier(2, timeout=60)
    real = session.empty_frame

    def wait(*args):
        both.wait()
        return real(*args)

    monkeypatch.setattr(session, "empty_frame", wait)
    work.release(*saved)
    monkeypatch.undo()
    assert kept.count() == 5 and sum(spark.read.parquet(f"{work.root}/{n}").count() for n in ("01-a", "02-b")) == 0
    work.clear()
