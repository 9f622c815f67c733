import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import build_session  # noqa: E402
from corpusloom.sources.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "corpusloom-tests",
        master="local[8]",
        **{
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "corpus"))


@pytest.fixture
def folder(tmp_path):
    """A function that writes article files and returns their folder."""

    def write(files, name="in"):
        root = tmp_path / name
        for path, content in files.items():
            target = root / path
            target.parent.mkdir(parents=True, exist_ok=True)
            text = content if isinstance(content, str) else json.dumps(content, ensure_ascii=False)
            target.write_text(text, encoding="utf-8")
        return str(root)

    return write


@pytest.fixture
def article():
    """A function that gives one article record as a dict."""

    def make(doi, title="t", abstract="a", authors=(), **metadata):
        named = [
            {"first": a[0], "last": a[1], "initial": a[2]} if isinstance(a, tuple) else a
            for a in authors
        ]
        return {
            "abstract": abstract,
            "metadata": {"doi": doi, "title": title, "authors": named, **metadata},
        }

    return make
