import pytest
from pyspark.sql import functions as F

from corpusloom.sources.files import read_files
from corpusloom.sources.records import accepted, parse_records, rejected

REJECTED = {
    "truncated": ('{"metadata":{"doi":"a"}', "bad_json"),
    "single quotes": ("{'metadata':{'doi':'a'}}", "bad_json"),
    "trailing word": ('{"metadata":{"doi":"a"}} x', "bad_json"),
    "trailing object": ('{"metadata":{"doi":"a"}} {"b":1}', "bad_json"),
    "trailing bracket": ('{"metadata":{"doi":"a"}}] [', "bad_json"),
    "two values": ('{"metadata":{"doi":"a"}},{"metadata":{"doi":"a"}}', "bad_json"),
    "trailing comma": ('{"metadata":{"doi":"a"},}', "bad_json"),
    "byte order mark": ('﻿{"metadata":{"doi":"a"}}', "bad_json"),
    "not a number": ('{"metadata":{"doi":"a","pub_year":NaN}}', "bad_json"),
    "raw tab in a string": ('{"metadata":{"doi":"a\tb"}}', "bad_json"),
    "blank": ("  ", "bad_json"),
    "no metadata": ('{"x":1}', "no_metadata"),
    "array root": ('[{"metadata":{"doi":"a"}}]', "no_metadata"),
    "scalar root": ("5", "no_metadata"),
    "metadata null": ('{"metadata":null}', "no_doi"),
    "metadata string": ('{"metadata":"doi"}', "no_doi"),
    "no doi": ('{"metadata":{"title":"t"}}', "no_doi"),
    "empty doi": ('{"metadata":{"doi":""}}', "no_doi"),
    "number doi": ('{"metadata":{"doi":7}}', "no_doi"),
}


@pytest.fixture
def parse(spark):
    def run(rows):
        frame = spark.createDataFrame(list(rows.items()), "file_path string, value string")
        return parse_records(frame)

    return run


def test_rejects_with_reason(parse):
    rows = parse({name: text for name, (text, _) in REJECTED.items()})
    found = {r.file_path: r.reason for r in rejected(rows).collect()}
    assert found == {name: reason for name, (_, reason) in REJECTED.items()}
    assert accepted(rows).count() == 0


def test_fields(parse):
    def meta(rest):
        return '{"abstract":"Été","metadata":{"doi":"d",%s}}' % rest

    rows = {
        "full": meta('"title":"T","issn":"i","pub_year":2019'),
        "spaces": '\n {"metadata":{"doi":" "}}\n',
        "title number": meta('"title":5'),
        "year string": meta('"pub_year":"2019"'),
        "year real": meta('"pub_year":2019.0'),
        "year large": meta('"pub_year":99999999999'),
        "year negative": meta('"pub_year":-5'),
        "nul escape": '{"metadata":{"doi":"a\\u0000b"}}',
    }
    found = {r.file_path: r for r in accepted(parse(rows)).collect()}
    assert set(found) == set(rows)
    full = found["full"]
    assert (full.doi, full.title, full.abstract, full.issn, full.pub_year) == ("d", "T", "Été", "i", 2019)
    assert found["spaces"].doi == " " and found["spaces"].abstract is None
    assert found["title number"].title is None
    years = ["year string", "year real", "year large", "year negative"]
    assert [found[n].pub_year for n in years] == [0, 0, 0, -5]
    assert found["nul escape"].doi == "a\0b"
    raw = parse({"nul byte": '{"metadata":{"doi":"a"}}\0 junk'})
    assert [r.reason for r in raw.collect()] == ["bad_json"]


def test_authors(parse):
    def record(authors):
        return '{"metadata":{"doi":"d","authors":%s}}' % authors

    forty = "[" + ",".join('{"first":"f","last":"%d"}' % i for i in range(40)) + "]"
    rows = {
        "object": record("{}"),
        "empty": record("[]"),
        "mixed": record('[{"first":"A","last":5,"initial":"I"},null,"x",[{"first":"q"}]]'),
        "forty": record(forty),
    }
    found = {r.file_path: [tuple(a) for a in r.authors] for r in parse(rows).collect()}
    assert found["object"] == [] and found["empty"] == []
    assert found["mixed"] == [("A", "", "I"), ("", "", ""), ("", "", ""), ("", "", "")]
    assert found["forty"] == [("f", str(i), "") for i in range(40)]


def test_author_limit(spark):
    text = '{"metadata":{"doi":"d","authors":[{"last":"a"},{"last":"b"},{"last":"c"}]}}'
    raw = spark.createDataFrame([("f", text)], "file_path string, value string")
    assert [a.last for a in parse_records(raw, author_limit=2).first().authors] == ["a", "b"]


def test_first_of_repeated_keys_counts(parse):
    rows = {
        "doi": '{"metadata":{"doi":"a","doi":"b","title":"T"}}',
        "all": '{"abstract":"one","abstract":"two","metadata":{"doi":"d","title":"x","title":5,"issn":"i",'
        '"issn":null,"pub_year":1999,"pub_year":"2000","authors":[{"last":"A","last":"B"}],"authors":[]}}',
        "metadata": ' {"metadata":{"doi":"first"},"metadata":{"doi":"second"}}\n',
        "elsewhere": '{"x":{"y":1,"y":2},"metadata":{"doi":"d","title":"say \\"hi\\" \\u00e9/","pub_year":7}}',
        "types": '{"a":1,"a":2,"metadata":{"doi":"d","title":5,"issn":["i"],"pub_year":3.5,"authors":{"last":"A"}}}',
        "authors": '{"a":1,"a":2,"metadata":{"doi":"d","authors":[{"first":"F","last":7,"initial":"I","last":"L"},null,"x",["q"]]}}',
        "number first": '{"metadata":{"doi":5,"doi":"d"}}',
        "no metadata": '{"a":1,"a":2}',
        "text metadata": '{"a":1,"a":2,"metadata":"{\\"doi\\":\\"d\\"}"}',
    }
    bad = {
        "trailing": '{"a":1,"a":2,"metadata":{"doi":"d"}} x',
        "comma": '{"a":1,"a":2,"metadata":{"doi":"d"},}',
        "quotes": "{\"a\":1,\"a\":2,'metadata':{\"doi\":\"d\"}}",
        "not a number": '{"a":1,"a":NaN,"metadata":{"doi":"d"}}',
        "zeros": '{"a":1,"a":007,"metadata":{"doi":"d"}}',
        "two values": '{"a":1,"a":2,"metadata":{"doi":"d"}},{"a":1}',
        "tab": '{"a":1,"a":"\t","metadata":{"doi":"d"}}',
    }
    found = {r.file_path: r for r in parse({**rows, **bad}).collect()}
    assert {n: found[n].reason for n in bad} == dict.fromkeys(bad, "bad_json")
    reasons = {"number first": "no_doi", "no metadata": "no_metadata", "text metadata": "no_doi"}
    assert {n: found[n].reason for n in rows} == {n: reasons.get(n) for n in rows}
    assert [found[n].doi for n in ("doi", "all", "metadata")] == ["a", "d", "first"]
    r = found["all"]
    assert (r.abstract, r.title, r.issn, r.pub_year) == ("one", "x", "i", 1999)
    assert [tuple(a) for a in r.authors] == [("", "A", "")]
    assert (found["elsewhere"].title, found["elsewhere"].pub_year) == ('say "hi" é/', 7)
    r = found["types"]
    assert (r.title, r.issn, r.pub_year, r.authors) == (None, None, 0, [])
    # A number is no string, also where a string of the same key comes later.
    assert [tuple(a) for a in found["authors"].authors] == [("F", "", "I"), ("", "", ""), ("", "", ""), ("", "", "")]


def test_filters_do_not_copy_the_parse(parse):
    plan = accepted(parse({"a": "{}"}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_files_are_read_whole_and_recursively(spark, folder):
    root = folder({"a.json": "line 1\nline 2\n", "deep/er/b": "{}", ".hidden": "x", "_skipped": "x", "empty": ""})
    found = {r.file_path.rsplit("/", 1)[1]: r.value for r in read_files(spark, root).collect()}
    assert found == {"a.json": "line 1\nline 2\n", "b": "{}"}
    assert read_files(spark, root + "/a.json").count() == 1


def test_authors_are_taken_apart_only_where_one_repeats_a_key(spark, monkeypatch):
    """A record that repeats a key elsewhere has its authors read as one VARIANT."""
    from corpusloom.sources import records

    def apart(metadata, limit):
        name = F.lit("apart")
        return F.array(F.struct(*[name.alias(p) for p in ("first", "last", "initial")]))

    monkeypatch.setattr(records, "_author_texts", apart)
    listed = '[{"first":"A","last":"\\u00e9\\"","initial":7},null,"x",{"last":"B"}]'
    rows = [
        ("once", '{"metadata":{"doi":"a","doi":"b","authors":%s}}' % listed),
        ("author", '{"metadata":{"doi":"a","authors":[{"first":"A","first":"B"}]}}'),
    ]
    parsed = parse_records(spark.createDataFrame(rows, "file_path string, value string"))
    got = {r.file_path: [tuple(a) for a in r.authors] for r in parsed.collect()}
    assert got["once"] == [("A", 'é"', ""), ("", "", ""), ("", "", ""), ("", "B", "")]
    assert got["author"] == [("apart",) * 3]
