"""Document collections from JSON exports."""

from __future__ import annotations

import json

import pytest

from stratalake import DocumentSource, extract_to_landing, read_landing
from stratalake.sources.documents import parse_nested
from tests.conftest import rows

DOCS = [
    {"_id": {"$oid": "64f0c2"}, "x": 1, "y": [1, 2]},
    {"_id": {"$oid": "64f0c3"}, "x": None, "z": {"q": 'say "hi"\n'}, "name": "é"},
    {"_id": {"$oid": "64f0c4"}, "x": 3, "z": {}},
]


@pytest.fixture
def source(tmp_path):
    (tmp_path / "docs.json").write_text("".join(json.dumps(d) + "\n" for d in DOCS))
    (tmp_path / "more.json").mkdir()
    (tmp_path / "more.json" / "part-0.json").write_text('{"a": 1}\n{"b": "t"}\n')
    (tmp_path / "readme.txt").write_text("no collection")
    return DocumentSource(str(tmp_path))


def test_collections_are_the_json_entries(spark, source):
    assert source.tables(spark) == ["docs", "more"]


def test_one_row_per_document_with_the_union_of_keys(spark, source):
    docs = source.read(spark, "docs")
    assert sorted(docs.columns) == ["_id", "name", "x", "y", "z"]
    assert rows(docs.select("_id", "x", "y", "z", "name")) == [
        ("64f0c2", "1", "[1, 2]", None, None),
        ("64f0c3", None, None, '{"q": "say \\"hi\\"\\n"}', "é"),
        ("64f0c4", "3", None, "{}", None),
    ]
    assert rows(source.read(spark, "more")) == [(None, "t"), ("1", None)]


def test_through_landing_and_back(spark, source, layout):
    results = extract_to_landing(spark, source, layout)
    assert rows(results.select("table_name", "rows_written")) == [("docs", 3), ("more", 2)]
    landed = read_landing(spark, layout.landing_path("docs"))
    parsed = landed.transform(parse_nested, "z", "q string").transform(parse_nested, "y", "array<bigint>")
    assert rows(parsed.select("_id", "x", "y", "z.q")) == [
        ("64f0c2", "1", [1, 2], None),
        ("64f0c3", None, None, 'say "hi"\n'),
        ("64f0c4", "3", None, None),
    ]


def test_given_schema_saves_the_inference(spark, source):
    typed = DocumentSource(source.root, schemas={"docs": "x bigint, z struct<q: string>"})
    assert typed.read(spark, "docs").columns == ["x", "z"]
    assert typed.read(spark, "docs").count() == 3


def test_malformed_document_stops_the_load(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        DocumentSource(str(tmp_path)).read(spark, "bad").collect()


def test_empty_collection(spark, tmp_path, layout):
    (tmp_path / "none.json").write_text("")
    results = extract_to_landing(spark, DocumentSource(str(tmp_path)), layout)
    assert rows(results.select("table_name", "status", "rows_written")) == [("none", "written", 0)]


def test_connector_source_names_its_collections_and_their_schemas(spark):
    source = DocumentSource.over_connector("mongodb", {"connection.uri": "x"}, ["a", "b"], {"a": "x bigint"})
    assert source.tables(spark) == ["a", "b"]
    with pytest.raises(Exception, match="mongodb"):
        source.read(spark, "a")
    with pytest.raises(ValueError, match="schema"):
        source.read(spark, "b")


def test_documents_that_span_lines(spark, tmp_path):
    (tmp_path / "wide.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert rows(DocumentSource(str(tmp_path), options={"multiLine": "true"}).read(spark, "wide")) == [("1",), ("2",)]
    typed = DocumentSource(str(tmp_path), options={"multiLine": "true"}, schemas={"wide": "a bigint"})
    assert rows(typed.read(spark, "wide")) == [(1,), (2,)]


def test_documents_that_span_lines_keep_all_keys_and_letters(spark, tmp_path):
    docs = ['{"a": 1.50, "t": "}\\"{[", "o": {"k" : null}}', '{"b": [1,  2.0], "a": "x"}', '{}', '{"t": true, "B": null}']
    (tmp_path / "lines.json").write_text("\n".join(docs))
    (tmp_path / "array.json").write_text("[" + ",\n".join(docs) + "]\n")
    (tmp_path / "apart.json").write_text("\n\n".join(d.replace(", ", ",\n  ") for d in docs))
    (tmp_path / "one.json").write_text("[" + ",".join(docs) + "]")
    by_lines = DocumentSource(str(tmp_path)).read(spark, "lines")
    source = DocumentSource(str(tmp_path), options={"multiLine": "true"})
    for name in ("lines", "array", "one"):
        found = source.read(spark, name)
        assert found.columns == by_lines.columns and rows(found) == rows(by_lines)
    assert rows(source.read(spark, "apart").select("a", "t")) == rows(by_lines.select("a", "t"))


def test_a_malformed_document_among_many_lines_stops_the_load(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"a": 1}\n{"a": }\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        DocumentSource(str(tmp_path), options={"multiLine": "true"}).read(spark, "bad").collect()


def test_no_key_or_digit_is_lost(spark, tmp_path):
    lines = [
        '{"Name":"x","n":1,"t":true,"b":false,"o":{"k":null,"m":1.50}}',
        '{"name":"y","n":1.50,"t":"true","o":[1,2.0,null]}',
        '{"NAME":null,"n":123456789012345678901234567890123456789012345,"name__2":"z"}',
        "  ",
    ]
    (tmp_path / "odd.json").write_text("\n".join(lines))
    odd = DocumentSource(str(tmp_path)).read(spark, "odd")
    assert len({c.lower() for c in odd.columns}) == len(odd.columns) == 8
    shown = sorted(tuple(v for v in row if v is not None) for row in odd.collect())
    assert sorted(map(sorted, shown)) == sorted(
        [
            sorted(["x", "1", "true", "False", '{"k":null,"m":1.50}']),
            sorted(["y", "1.50", "true", "[1,2.0,null]"]),
            sorted(["123456789012345678901234567890123456789012345", "z"]),
        ]
    )


def test_probe(spark, source):
    assert rows(source.probe(spark)) == [(1,)]
