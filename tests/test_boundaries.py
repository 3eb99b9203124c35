"""Files cut at the ends of their records by many tasks, against reads by one task."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.sources import boundaries
from stratalake.sources.boundaries import NotCut, QuotedLines, csv_records, json_documents, units
from stratalake.sources.files import CSV_OPTIONS, HeadersDiffer, read_landing, read_records

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one_task(spark, path):
    return spark.read.options(**CSV_OPTIONS).option("multiLine", "true").csv(path)


def write(folder, contents):
    folder.mkdir()
    for k, raw in enumerate(contents):
        (folder / f"f{k:04}.csv").write_bytes(raw)
    return str(folder)


def random_file(pick, pieces):
    return b"".join(pick.choice(pieces) for _ in range(pick.randint(0, 40)))


#: What files are put together from: mostly sound CSV, some of everything else.
SOUND = [b"a", b"b c", "é".encode(), b",", b",", b"\n", b'"x"', b'"x\ny"', b'"a""b\n"', b'""', b',"\n\n,",', b" ", b"#"]
RETURNS = [b"a", b",", b"\r\n", b"\r\n", b'"x\r\ny"', b'"x\ny"', b'"q""\r\n"', b"bb"]
RAW = [b"a", b",", b"\n", b'"', b'"', b"\r", b"\r\n", b" ", b"\x00", b"\xff", "\ufeff".encode(), "é".encode(), b"\\"]


@pytest.mark.parametrize("pieces", [SOUND, RETURNS, RAW, SOUND + RAW])
@pytest.mark.parametrize("block", [9, 64])
def test_files_are_read_as_by_one_task(spark, tmp_path, pieces, block):
    """Each file on its own decides whether it can be cut; all that can are compared in one read."""
    pick = random.Random(block * 1000 + len(pieces))
    path = write(tmp_path / "files", [b"h1,h2\n" + random_file(pick, pieces) if pieces is not RETURNS else b"h1,h2\r\n" + random_file(pick, pieces) for _ in range(60)])
    machine = QuotedLines()
    rows = units(spark, path, machine, block)
    found, begins = boundaries.scan(rows, machine), {}
    for file, blocks in found.items():
        cut, end = boundaries.prefix_scan(blocks, machine, boundaries.BETWEEN)
        returns, first, last = any(b.most[1] for b in blocks), blocks[0].first, blocks[-1].last
        if end == boundaries.BETWEEN and not first[2] and not (returns and not first[1]) and not (last[1] and boundaries._unended(blocks)):
            begins[file] = cut
    assert begins
    records = boundaries.plain_ends(boundaries.cut_records(rows.where(F.col("file").isin(list(begins))), machine, begins))
    schema = ", ".join(f"c{k} string" for k in range(12))
    parsed = records.select("file", F.from_csv("value", schema, {**CSV_OPTIONS, "multiLine": "true"}).alias("r")).select("file", "r.*")
    whole = spark.read.options(**{**CSV_OPTIONS, "header": "false", "multiLine": "true"}).schema(schema).csv(path)
    whole = whole.select(F.col("_metadata.file_path").alias("file"), *whole.columns).where(F.col("file").isin(list(begins)))
    ours, theirs = (Counter(map(tuple, df.collect())) for df in (parsed, whole))
    assert ours == theirs, list((ours - theirs).items())[:3] + ["-"] + list((theirs - ours).items())[:3]
    if pieces in (SOUND, RETURNS):
        assert len(begins) > 5


@given(st.lists(st.lists(st.one_of(st.none(), st.text(st.sampled_from('ab",\n é;\t'), max_size=12)), min_size=3, max_size=3), max_size=12), st.integers(1, 80))
@FEW
def test_written_by_the_sink_of_any_values(spark, tmp_path_factory, values, block):
    rows = [[None if v is None or not v.strip() else v for v in row] for row in values]

    def field(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"'

    folder = tmp_path_factory.mktemp("any") / "t.csv"
    path = write(folder, [("x,y,z\n" + "".join(",".join(map(field, row)) + "\n" for row in rows)).encode()])
    cut = read_records(spark, path, block)
    assert cut is not None and cut.columns == ["x", "y", "z"]
    assert Counter(map(tuple, cut.collect())) == Counter(map(tuple, one_task(spark, path).collect()))


def test_one_file_takes_several_tasks(spark, tmp_path):
    lines = [f'{k},"line one of {k}\nline ""two"" of {k}"\n' for k in range(3000)]
    path = write(tmp_path / "big", [("k,v\n" + "".join(lines)).encode()])
    cut = read_records(spark, path, 10_000)
    records = csv_records(spark, path, 10_000)
    assert records.select("block").distinct().count() > 8
    assert Counter(map(tuple, cut.collect())) == Counter(map(tuple, one_task(spark, path).collect()))


def test_a_value_longer_than_blocks(spark, tmp_path):
    path = write(tmp_path / "long", [b'a,b\n1,"' + b"word\n" * 5000 + b'"\n2,x\n'])
    rows = {tuple(r) for r in read_records(spark, path, 1000).collect()}
    assert rows == {("1", "word\n" * 5000), ("2", "x")}


def test_landing_takes_the_cut_read(spark, tmp_path):
    path = write(tmp_path / "large", [b'a,b\n1,"x\ny"\n', b'a,b\r\n2,"z\r\nw"\r\n'])
    assert {tuple(r) for r in read_landing(spark, path, large_file=1).collect()} == {("1", "x\ny"), ("2", "z\nw")}


def test_doubtful_quotes_are_left_to_one_task(spark, tmp_path):
    path = write(tmp_path / "doubt", [b'a,b\n1,x"y\n2,"p\nq"\n'])
    assert csv_records(spark, path, 8) is None
    assert Counter(map(tuple, read_landing(spark, path, large_file=1).collect())) == Counter(map(tuple, one_task(spark, path).collect()))


def test_other_headers_stop_the_read(spark, tmp_path):
    path = write(tmp_path / "heads", [b'a,b\n1,"x\ny"\n', b'a,c\n2,"z\nw"\n'])
    with pytest.raises(HeadersDiffer):
        read_records(spark, path, 4)


VALUES = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text(st.sampled_from('a"\\{}[],:\né '), max_size=6)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.sampled_from(["k", "}", "{"]), inner, max_size=3)),
    max_leaves=6,
)
DOCS = st.lists(st.dictionaries(st.sampled_from(["a", "b", "}", '"q']), VALUES, max_size=3), max_size=6)


@given(DOCS, st.integers(1, 60), st.sampled_from([None, 1]), st.booleans(), st.sampled_from(["\n", "", " \n\n"]))
@FEW
def test_documents_are_found_whole(spark, tmp_path_factory, docs, block, indent, array, end):
    texts = [json.dumps(d, indent=indent, ensure_ascii=False) for d in docs]
    whole = "[" + ",\n".join(texts) + "]" if array else "\n".join(texts)
    folder = tmp_path_factory.mktemp("docs") / "c.json"
    path = write(folder, [(whole + end).encode()])
    got = json_documents(spark, path, block).orderBy("block", "place").collect()
    assert [json.loads(r["value"]) for r in got] == docs
    assert [r["value"] for r in got] == [t.replace("\n", " ") for t in texts]


@pytest.mark.parametrize("raw", ['{"a": {"b": 1}  ', '{"a": 1', '[{"a": 1}', '[{"a": 1}, {"a": 2', '{"a": "x}'])
def test_a_file_that_ends_early_stops_the_read(spark, tmp_path, raw):
    with pytest.raises(NotCut):
        json_documents(spark, write(tmp_path / "early", [raw.encode()]), 4)


@pytest.mark.parametrize("raw", ['{"a": 1} x', '[{"a": 1},]', '[{"a": 1}x]'])
def test_what_stands_between_documents_stays_visible(spark, tmp_path, raw):
    got = [r["value"].strip() for r in json_documents(spark, write(tmp_path / "odd", [raw.encode()]), 4).orderBy("block", "place").collect()]
    assert got[0] == '{"a": 1}' and len(got) == 2
    with pytest.raises(ValueError):
        json.loads(got[1])


def test_a_missing_comma_stops_the_read(spark, tmp_path):
    with pytest.raises(Exception, match="no comma"):
        json_documents(spark, write(tmp_path / "comma", [b'[{"a": 1} {"a": 2}]']), 4).collect()


def test_several_files_of_documents(spark, tmp_path):
    path = write(tmp_path / "many", [b'[{"a":1},{"a":2}]', b'{"a":3}\n{"a":4}\n', b"", b" \n", b"[ ]"])
    by_file = defaultdict(list)
    for r in json_documents(spark, path, 3).collect():
        by_file[r["file"]].append(json.loads(r["value"])["a"])
    assert sorted(map(sorted, by_file.values())) == [[1, 2], [3, 4]]


def test_a_line_break_inside_a_text_stops_the_read(spark, tmp_path):
    path = write(tmp_path / "broken", [b'{"a": "x\ny"}'])
    with pytest.raises(Exception, match="line break inside"):
        json_documents(spark, path).collect()
