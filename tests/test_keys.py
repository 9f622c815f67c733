import os

from corpusloom.plans.ingest import ingest
from corpusloom.sources import tables as stored_tables


def test_small_load_keeps_its_keys_in_one_file_each(spark, tables, folder, article, monkeypatch):
    batch = [article(f"d{i}", authors=[("F", f"a{i}", "")]) for i in range(60)]
    ingest(tables, folder({str(i): a for i, a in enumerate(batch[:30])}, "x"), run_id="small")
    monkeypatch.setattr(stored_tables, "_FEW_KEYS", 29)
    ingest(tables, folder({str(i): a for i, a in enumerate(batch)}, "y"), run_id="large")
    for name in ("document_keys", "author_keys"):
        at = {load: [f for _, _, files in os.walk(f"{tables.path(name)}/load_id={load}") for f in files
                     if f.endswith(".parquet")] for load in ("small", "large")}
        assert len(at["small"]) == 1 < len(at["large"])
    # Keys of both kinds of loads are found.
    assert (tables.documents().count(), tables.authors().count(), tables.relations().count()) == (60, 60, 60)
    ingest(tables, folder({str(i): a for i, a in enumerate(batch)}, "y"), run_id="again")
    assert tables.last_ids() == (60, 60)
