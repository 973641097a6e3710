import datetime
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

import tablejobs as tj
from tablejobs.errors import FieldError, TableJobError
from tablejobs.storage import shared_folder

TYPES = {
    "s": "string", "b": "boolean", "y": "tinyint", "h": "smallint", "i": "int", "l": "bigint",
    "f": "float", "d": "double", "t": "timestamp_ntz", "z": "timestamp", "day": "date", "x": "binary",
    "m": "decimal(12,3)",
}
TABLE = tj.TableDescriptor("t", tuple(TYPES), tuple(TYPES.values()), storage="text")
DDL = ", ".join(f"{n} {t}" for n, t in TYPES.items())


def round_trip(spark, df, table, **options):
    path = shared_folder(spark, "text")
    tj.write_text_table(df, path, table.delimiter)
    return tj.scan_text_table(spark, table, path, **options)


@pytest.mark.parametrize("delimiter", ["\x01", "\t", ",", "|", "||", ".", "a*"])
def test_every_type_reads_back(spark, delimiter):
    data = [
        (
            "text", True, 1, 2, 3, 2**62, 0.1, 1e300, datetime.datetime(2024, 1, 2, 3, 4, 5, 678901),
            datetime.datetime(2024, 6, 2, 3, 4, 5), datetime.date(1969, 12, 31), bytearray(b"\x00\x01\n"),
            Decimal("-12.345"),
        ),
        ("", False, -1, -2, -3, -(2**62), -0.0, 0.1 + 0.2, None, None, None, bytearray(b""), None),
        (None,) * len(TYPES),
    ]
    if delimiter in (".", ","):
        data = data[-1:]
    df = spark.createDataFrame(data, DDL)
    table = tj.TableDescriptor("t", TABLE.names, TABLE.types, delimiter=delimiter)
    assert rows(round_trip(spark, df, table)) == rows(df)


@pytest.mark.parametrize("delimiter", ["|", "||", "|a|"])
@settings(max_examples=4, deadline=None)
@given(data=st.lists(st.tuples(st.text("a|\\Nü \0", max_size=4), st.none() | st.integers(-5, 5)), max_size=40))
def test_any_text_reads_back(spark, delimiter, data):
    table = tj.TableDescriptor("t", ("a", "b"), ("string", "int"), delimiter=delimiter)
    safe = [(a, b) for a, b in data if f"{a}{delimiter}".index(delimiter) == len(a) and a != "\\N"]
    df = spark.createDataFrame(safe, "a string, b int")
    assert rows(round_trip(spark, df, table)) == rows(df)


@pytest.mark.parametrize("value, delimiter", [("a|", "||"), ("|||", "||"), (1.5, "."), (-1, "-"), (True, "r")])
def test_other_values_that_would_change_are_refused(spark, value, delimiter):
    df = spark.createDataFrame([(value, "x")], ["a", "b"])
    with pytest.raises(Exception, match="holds the delimiter"):
        tj.write_text_table(df, shared_folder(spark, "text"), delimiter)


@pytest.mark.parametrize("delimiter", ["\\", "N", "\n", "", "\\N"])
def test_impossible_delimiters_are_refused(spark, delimiter):
    with pytest.raises(TableJobError):
        tj.write_text_table(spark.range(1), shared_folder(spark, "text"), delimiter)


@pytest.mark.parametrize("value", ["a|b", "a\nb", "a\rb", "\\N"])
def test_values_that_would_change_are_refused(spark, value):
    df = spark.createDataFrame([(value,)], "a string")
    with pytest.raises(Exception, match="holds the delimiter"):
        tj.write_text_table(df, shared_folder(spark, "text"), "|")


def test_bad_fields_and_short_lines_give_null(spark):
    path = shared_folder(spark, "text")
    spark.createDataFrame([("a\t1\textra",), ("b\tno",), ("c",), ("",)], "v string").write.text(path)
    table = tj.TableDescriptor("t", ("foo", "bar"), ("string", "int"), delimiter="\t")
    assert rows(tj.scan_text_table(spark, table, path)) == [("", None), ("a", 1), ("b", None), ("c", None)]
    untyped = tj.scan_text_table(spark, table, path, typed=False)
    assert ("b", "no") in rows(untyped)


@pytest.mark.parametrize("kind", ["array<int>", "map<string,int>", "struct<a:int>"])
def test_nested_columns_are_refused(spark, kind):
    table = tj.TableDescriptor("t", ("c",), (kind,))
    path = shared_folder(spark, "text")
    spark.createDataFrame([("a",)], "v string").write.text(path)
    with pytest.raises(TableJobError):
        tj.scan_text_table(spark, table, path)
    with pytest.raises(TableJobError):
        tj.write_text_table(spark.createDataFrame([], f"c {kind}"), shared_folder(spark, "text"))


def test_one_column_table_named_value(spark, database):
    table = tj.TableDescriptor("dual", ("value",), ("int",), database=database, storage="text")
    tj.write_table(spark.createDataFrame([(7,), (None,)], "value int"), table)
    assert rows(tj.scan_table(spark, table.full_name)) == [(7,), (None,)]


@pytest.mark.parametrize("delimiter", ["\x01", "|", "'", "\\|"])
def test_view_shows_rows_to_sql(spark, database, delimiter):
    kinds = {**TYPES, "p": "string"}
    table = tj.TableDescriptor("lines", tuple(kinds), tuple(kinds.values()), ("p",), database, delimiter)
    day = datetime.date(2024, 1, 2)
    data = [
        ("text", True, 1, 2, 3, 4, 0.5, 1.5, None, None, day, bytearray(b"ab"), Decimal("1.250"), "x"),
        ("", *[None] * 12, "y"),
        (None, *[None] * 12, None),
    ]
    tj.write_table(spark.createDataFrame(data, f"{DDL}, p string"), table)
    tj.create_text_view(spark, table.full_name, f"{database}.shown")
    assert rows(spark.table(f"{database}.shown")) == rows(tj.scan_table(spark, table.full_name))
    assert rows(spark.sql(f"SELECT s, m FROM {database}.shown WHERE p = 'x'")) == [("text", Decimal("1.250"))]


def test_line_column_is_no_partition_column(spark):
    with pytest.raises(FieldError):
        tj.TableDescriptor("t", ("a", "VALUE"), ("string", "string"), ("value",), storage="text")


def test_sequence_file(spark):
    table = tj.TableDescriptor("t", ("a", "b"), ("string", "int"), storage="sequencefile")
    df = spark.createDataFrame([("x", 1), (None, 2), ("", None)], "a string, b int")
    path = shared_folder(spark, "sequence")
    tj.write_sequence_table(df, table, path)
    assert rows(tj.scan_sequence_table(spark, table, path)) == rows(df)


def test_options_belong_to_one_source_or_sink(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    path = shared_folder(spark, "text")
    tj.write_text_table(df, path, options={"compression": "gzip"})
    assert all(name.endswith(".gz") for name in spark.read.text(path).inputFiles())


def test_lines_that_do_not_fit_can_be_errors(spark, tmp_path):
    table = tj.TableDescriptor("t", ("a", "b"), ("int", "string"), delimiter="|", storage="text")
    for name, line in (("long", "1|x|y"), ("short", "1"), ("bad", "one|x"), ("good", "1|x")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_text(line + "\n")
        read = tj.scan_text_table(spark, table, str(tmp_path / name), bad_rows="error")
        if name == "good":
            assert rows(read) == [(1, "x")]
            continue
        with pytest.raises(Exception):
            read.collect()
        assert tj.scan_text_table(spark, table, str(tmp_path / name)).count() == 1


def test_load_refuses_lines_that_do_not_fit(spark, database, tmp_path):
    (tmp_path / "part").write_text("1|x\n2|y|z\n")
    table = tj.TableDescriptor("t", ("a", "b"), ("int", "string"), database=database, delimiter="|", storage="text")
    with pytest.raises(Exception):
        tj.load_file(spark, str(tmp_path), table)
    tj.load_file(spark, str(tmp_path), table, bad_rows="null")
    assert rows(tj.scan_table(spark, table.full_name)) == [(1, "x"), (2, "y")]


def test_values_may_not_hold_the_line_separator(spark, tmp_path):
    df = spark.createDataFrame([("a|b", "c")], "x string, y string")
    with pytest.raises(Exception):
        tj.write_text_table(df, str(tmp_path / "out"), "\t", options={"lineSep": "|"})


def test_rejected_lines_of_a_partitioned_table(spark, tmp_path):
    table = tj.TableDescriptor("t", ("a", "b", "p"), ("int", "date", "string"), ("p",), delimiter="|", storage="text")
    (tmp_path / "p=x").mkdir()
    (tmp_path / "p=x" / "part").write_text("1|2024-01-01\n\n2\n\\N|\\N\nz|2024-01-01\n3|never\n4|2024-01-01|\n")
    judged = tj.judged_lines(spark, table, str(tmp_path))
    assert rows(tj.accepted_rows(judged).selectExpr("a", "string(b)", "p")) == [(1, "2024-01-01", "x"), (None, None, "x")]
    found = rows(tj.rejected_lines(judged).selectExpr("regexp_extract(file, '[^/]+$', 0)", "reason", "line"))
    assert sorted(found) == [
        ("part", "1 fields instead of 2", ""),
        ("part", "1 fields instead of 2", "2"),
        ("part", "3 fields instead of 2", "4|2024-01-01|"),
        ("part", "column 'a' holds text that is no int", "z|2024-01-01"),
        ("part", "column 'b' holds text that is no date", "3|never"),
    ]
    assert rows(tj.scan_text_table(spark, table, str(tmp_path), bad_rows="skip")) == rows(tj.accepted_rows(judged))
    assert judged._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    report = tj.check_contract(tj.scan_text_table(spark, table, str(tmp_path), typed=False, width=True), table)
    assert [(r.column_name, r.bad_values) for r in report.collect()] == [("a", 2), ("b", 1), ("p", 0), ("(line)", 3)]


def test_sequence_files_pass_no_python_worker(spark):
    table = tj.TableDescriptor("t", ("a", "b"), ("string", "int"), storage="sequencefile")
    df = spark.range(500).selectExpr("concat('é', id) AS a", "int(id) AS b").repartition(3)
    path = shared_folder(spark, "sequence")
    tj.write_sequence_table(df, table, path, "org.apache.hadoop.io.compress.GzipCodec")
    read = tj.scan_sequence_table(spark, table, path)
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Scan[obj" in text
    assert rows(read) == rows(df)
    # Files that others wrote, with keys of any kind.
    keyed = shared_folder(spark, "keyed")
    spark.sparkContext.parallelize([(1, "x\x01 7"), (2, "y\x018")], 1).saveAsSequenceFile(keyed)
    assert rows(tj.scan_sequence_table(spark, tj.TableDescriptor("k", ("a", "b"), ("string", "int"), storage="sequencefile"), keyed)) == [
        ("x", 7), ("y", 8),
    ]
