"""Landing CSV: what goes in comes out, and files from elsewhere are read as they were meant."""

from __future__ import annotations

import gzip
from pathlib import Path

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake import DocumentSource, read_landing
from stratalake.sinks import landing
from stratalake.sinks.landing import write_landing
from stratalake.sources.files import lines_are_records
from tests.conftest import rows

AWKWARD = [
    'say "hi"', "a,b", "line\nbreak", "cr\rhere", "crlf\r\nhere", " lead", "trail ", "\ttab\t", " ", "back\\slash",
    "\\", '\\"', '"', '""', "'", "#x", "null", "NaN", "é ß 漢字 🙂", "nul\x00byte", ",", "\n", "a\\,b", '"a",\n"b"',
]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t.csv")


def write_file(path: str, content: str) -> None:
    Path(path).write_bytes(content.encode())


def test_awkward_text_survives(spark, path):
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "i int, s string")
    write_landing(df, path)
    back = read_landing(spark, path)
    assert back.dtypes == [("i", "string"), ("s", "string")]
    assert {int(r.i): r.s for r in back.collect()} == dict(enumerate(AWKWARD))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(), st.one_of(st.none(), st.text())), min_size=1, max_size=40))
def test_any_text_survives_with_empty_as_null(spark, tmp_path_factory, data):
    path = str(tmp_path_factory.mktemp("landing") / "t.csv")
    # Surrogates are no characters and have no UTF-8 form.
    data = [tuple(v if v is None else v.encode("utf-8", "ignore").decode() for v in row) for row in data]
    df = spark.createDataFrame([(str(i), *row) for i, row in enumerate(data)], "i string, a string, b string")
    write_landing(df, path)
    expected = sorted((str(i), *(v or None for v in row)) for i, row in enumerate(data))
    assert sorted(map(tuple, read_landing(spark, path).collect()), key=lambda r: r[0]) == expected


def test_null_and_empty_text_both_come_back_null(spark, path):
    write_landing(spark.createDataFrame([("1", None), ("2", "")], "i string, s string"), path)
    assert rows(read_landing(spark, path)) == [("1", None), ("2", None)]


def test_single_column_keeps_its_null_rows(spark, path):
    write_landing(spark.createDataFrame([("x",), (None,), ("",)], "s string"), path)
    assert rows(read_landing(spark, path)) == [(None,), (None,), ("x",)]


def test_all_null_row_is_kept(spark, path):
    write_landing(spark.createDataFrame([(None, None)], "a string, b int"), path)
    assert rows(read_landing(spark, path)) == [(None, None)]


def test_file_written_by_a_data_frame_library_is_read_exactly(spark, path):
    numbers = [None, 1.5] * (len(AWKWARD) // 2)
    pd.DataFrame({"i": range(len(AWKWARD)), "s": AWKWARD, "n": numbers}).to_csv(path, index=False)
    back = {int(r.i): (r.s, r.n) for r in read_landing(spark, path).collect()}
    assert back == {i: (s, "1.5" if i % 2 else None) for i, s in enumerate(AWKWARD)}


def test_existing_landing_is_replaced(spark, path):
    write_landing(spark.createDataFrame([(1, "a"), (2, "b")], "a int, b string"), path)
    write_landing(spark.createDataFrame([(3,)], "c int"), path)
    assert rows(read_landing(spark, path)) == [("3",)]
    assert read_landing(spark, path).columns == ["c"]


def test_rows_per_file_bounds_the_files(spark, path):
    write_landing(spark.range(100).coalesce(1), path, rows_per_file=30)
    assert len(list(Path(path).glob("part-*"))) == 4
    assert read_landing(spark, path).count() == 100


def test_empty_table_keeps_its_columns(spark, path):
    write_landing(spark.createDataFrame([], "a int, b string"), path)
    back = read_landing(spark, path)
    assert back.columns == ["a", "b"] and back.isEmpty()


def test_table_without_columns(spark, path):
    write_landing(spark.createDataFrame([(1,)], "a int").drop("a"), path)
    assert read_landing(spark, path).columns == []


def test_short_rows_are_padded_long_rows_cut_blank_lines_skipped(spark, path):
    write_file(path, "a,b\n1\n\n2,x,y\n3,z\n")
    assert rows(read_landing(spark, path)) == [("1", None), ("2", "x"), ("3", "z")]


def test_repeated_headers_get_positions(spark, path):
    write_file(path, "CD,cd,x.y,CD\n1,2,3,4\n")
    assert read_landing(spark, path).columns == ["CD0", "cd1", "x.y", "CD3"]


@pytest.mark.parametrize(("content", "columns"), [("\n", []), ("a,b\n", ["a", "b"])])
def test_files_without_rows(spark, path, content, columns):
    write_file(path, content)
    back = read_landing(spark, path)
    assert back.columns == columns and back.isEmpty()


def test_empty_collection_has_a_landing_form(spark, tmp_path, path):
    (tmp_path / "none.json").write_text("")
    documents = DocumentSource(str(tmp_path)).read(spark, "none")
    assert documents.columns == []
    write_landing(documents, path)
    assert read_landing(spark, path).columns == []


ONE_LINE_RECORDS = 'a,b\n1,"x,y"\n\n2, lead\n3,"say ""hi"""\n4,\n5,"",\n6\n7,back\\slash\n8,é ß\n'


def test_large_file_of_one_line_records_is_read_in_pieces_with_the_same_rows(spark, path):
    body = "".join(f'{i},"text, {i}"\n' for i in range(20_000))
    write_file(path, ONE_LINE_RECORDS + body)
    whole = read_landing(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    pieces = read_landing(spark, path, large_file=1)
    assert pieces.rdd.getNumPartitions() > 4
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert pieces.columns == whole.columns
    assert rows(pieces) == rows(whole)


@pytest.mark.parametrize(
    ("content", "fits"),
    [
        (ONE_LINE_RECORDS, True),
        ('a,b\n1,"x\ny"\n', False),
        ('a,b\n1,"x\ry"\n', False),
        ('a,b\n1,"x\r\ny"\n', False),
        ('a,b\n1,"""\n"""\n', False),
        ('a,b\n1,x"y\n', False),
        ("a\n  \nx\n", False),
        ("a,b\r\n1,x\r\n", False),
        ("a,b\n1,x\r\n2,y\n", False),
    ],
)
def test_records_over_several_lines_are_noticed(spark, path, content, fits):
    write_file(path, content)
    assert lines_are_records(spark, path) is fits
    assert rows(read_landing(spark, path, large_file=1)) == rows(read_landing(spark, path))


def test_size_does_not_decide_which_rows_come_out(spark, tmp_path):
    for n, text in enumerate(
        ['a,b\nx"y,"c\nd",z"w\n1,2\n', 'a,b\n"x""y",c\n"",\n', "a\n b \n\nc", 'a,b\n"p\nq",r\n', '\ufeffa,b\n1,2\n', "a,b\r\n1,2\r\n"]
    ):
        path = tmp_path / f"t{n}.csv"
        path.write_bytes(text.encode())
        whole, pieces = (read_landing(spark, str(path), large_file=size) for size in (1 << 40, 1))
        assert whole.columns == pieces.columns and rows(whole) == rows(pieces), text


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(st.sampled_from('a1,"\n\r \x00\ufeff\t'), max_size=30))
def test_any_bytes_give_the_same_rows_whatever_the_size(spark, tmp_path, text):
    path = tmp_path / f"{abs(hash(text))}.csv"
    path.write_bytes(b"a,b\n" + text.encode())
    whole, pieces = (read_landing(spark, str(path), large_file=size) for size in (1 << 40, 1))
    assert rows(whole) == rows(pieces)


def test_swapped_headers_stop_the_read(spark, tmp_path):
    for names in (("a,b", "b,a"), ("a0,b", "b,a0")):
        folder = tmp_path / names[0]
        folder.mkdir()
        for name in names:
            (folder / f"{name}.csv").write_text(f"{name}\n1,2\n")
        with pytest.raises(Exception, match="(?i)header"):
            read_landing(spark, str(folder)).collect()


@pytest.mark.parametrize("columns", ["k", "k, v"])
def test_files_stay_bounded_when_rows_grow_a_thousandfold(spark, tmp_path, columns):
    path, goal = str(tmp_path / "t.csv"), 20_000
    wide = F.when(F.col("id") < 800, F.lit("x")).otherwise(F.repeat(F.lit('y"\n'), 700))
    df = spark.range(0, 1000, 1, 2).select(wide.alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v")).select(*columns.split(", "))
    write_landing(df, path, 500, file_bytes=goal)
    sizes = [p.stat().st_size for p in (tmp_path / "t.csv").iterdir() if p.name.startswith("part-")]
    assert max(sizes) <= 2 * goal and len(sizes) > 10
    assert not [p for p in (tmp_path / "t.csv").iterdir() if p.is_dir()]
    back = read_landing(spark, path)
    assert back.columns == df.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, df.select(*(F.col(c).cast("string") for c in df.columns)).collect()))


def test_compressed_files_are_bounded_by_their_text(spark, tmp_path):
    path, goal = str(tmp_path / "t.csv"), 20_000
    wide = F.when(F.col("id") < 800, F.lit("x")).otherwise(F.repeat(F.lit('y"\n'), 700))
    df = spark.range(0, 1000, 1, 2).select(wide.alias("k"), "id")
    write_landing(df, path, 500, file_bytes=goal, codec="gzip")
    parts = [p for p in (tmp_path / "t.csv").iterdir() if p.name.startswith("part-")]
    assert all(p.name.endswith(".csv.gz") for p in parts)
    sizes = [len(gzip.decompress(p.read_bytes())) for p in parts]
    assert max(sizes) <= 2 * goal and len(sizes) > 10
    assert sum(p.stat().st_size for p in parts) < sum(sizes) / 4
    assert rows(read_landing(spark, path)) == rows(df.select("k", F.col("id").cast("string")))


@pytest.mark.parametrize(("width", "looked_through"), [(5, 0), (200, 1)])
def test_compressed_files_are_looked_through_only_where_one_may_be_too_large(spark, path, monkeypatch, width, looked_through):
    passes, larger = [], landing._larger_files
    monkeypatch.setattr(landing, "_larger_files", lambda *args: passes.append(args) or larger(*args))
    df = spark.range(0, 100, 1, 1).select(F.when(F.col("id") == 50, F.repeat(F.lit("x"), width)).otherwise("a").alias("k"))
    write_landing(df, path, 50, file_bytes=1000, codec="gzip")
    assert len(passes) == looked_through and read_landing(spark, path).count() == 100


def test_awkward_text_survives_compression(spark, path):
    write_landing(spark.createDataFrame(list(enumerate(AWKWARD)), "i int, s string"), path, codec="gzip")
    assert {int(r.i): r.s for r in read_landing(spark, path).collect()} == dict(enumerate(AWKWARD))


def test_a_nul_beside_a_quote_stays(spark, tmp_path):
    values = ['"\x00', '\x00"', 'a"\x00b', '""\x00', "\x00", 'x"\n\x00"']
    write_landing(spark.createDataFrame(list(enumerate(values)), "k int, v string"), str(tmp_path / "t.csv"))
    assert {int(r["k"]): r["v"] for r in read_landing(spark, str(tmp_path / "t.csv")).collect()} == dict(enumerate(values))


def test_a_row_wider_than_a_file_has_a_file_of_its_own(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    df = spark.createDataFrame([("a" * 5000, 1), ("b", 2), ("c" * 9000, 3)], "k string, v int").coalesce(1)
    write_landing(df, path, 100, file_bytes=1000)
    assert len([p for p in (tmp_path / "t.csv").iterdir() if p.name.startswith("part-")]) == 3
    assert {r["v"] for r in read_landing(spark, path).collect()} == {"1", "2", "3"}
