import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.errors import SqlStepError, TableJobError
from tablejobs.storage import shared_folder


def test_statements_run_in_order(spark, database):
    tj.run_sql_steps(
        spark,
        [
            f"CREATE TABLE {database}.words (word string, meaning string) USING orc",
            f"INSERT INTO TABLE {database}.words SELECT 'old', 'gone'",
            f"INSERT OVERWRITE TABLE {database}.words SELECT 'ja', 'yes'",
            f"INSERT INTO TABLE {database}.words SELECT 'nein', 'no'",
        ],
    )
    assert rows(spark.table(f"{database}.words")) == [("ja", "yes"), ("nein", "no")]


def test_first_failure_stops_and_names_the_statement(spark, database):
    bad = "CREAT TABLE mistyped (a int)"
    with pytest.raises(SqlStepError) as caught:
        tj.run_sql_steps(spark, [bad, f"CREATE TABLE {database}.later (a int) USING orc"])
    assert caught.value.statement == bad and bad in str(caught.value)
    assert not spark.catalog.tableExists(f"{database}.later")


def test_a_query_whose_rows_are_not_kept_still_runs(spark):
    with pytest.raises(SqlStepError):
        tj.run_sql_steps(spark, ["SELECT raise_error('no')"])


def test_results_are_those_of_the_moment(spark, database):
    table = f"{database}.t"
    kept = tj.run_sql_steps(
        spark,
        [
            f"CREATE TABLE {table} (a int) USING orc",
            f"INSERT INTO {table} VALUES (1)",
            f"SELECT a, a AS a, NULL AS nothing FROM {table}",
            f"INSERT OVERWRITE {table} VALUES (2)",
            f"SELECT a FROM {table} WHERE a > 5",
        ],
        keep_results=True,
    )
    assert [frame is None for frame in kept] == [True, True, False, True, False]
    assert rows(kept[2]) == [(1, 1, None)]
    assert kept[2].columns == ["a", "a", "nothing"]
    assert rows(kept[4]) == []


def test_step_needs_sources():
    for sources in ([], None):
        with pytest.raises(TableJobError):
            tj.SqlStep("s", ["SELECT 1"], sources)


def test_step_settings_do_not_leak(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    step = tj.SqlStep("s", "SELECT CAST('x' AS int) AS n", ["none"], settings={"spark.sql.ansi.enabled": "false"})
    assert rows(step.run(spark, keep_results=True)[0]) == [(None,)]
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    with pytest.raises(SqlStepError):
        strict = {"spark.sql.ansi.enabled": "true"}
        tj.SqlStep("s", "SELECT CAST('x' AS int) AS n", ["none"], settings=strict).run(spark)


def test_step_takes_over_the_settings_of_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        zone = tj.SqlStep("s", "SELECT current_timezone() AS z", ["none"]).run(spark, keep_results=True)[0]
        assert rows(zone) == [("Asia/Tokyo",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sink_table_is_made_before_and_after(spark, database):
    sink = tj.TableDescriptor("sink", ("a",), ("int",), (), database, storage="orc")
    tj.SqlStep("fill", f"INSERT INTO {sink.full_name} VALUES (1)", ["none"], sink).run(spark)
    assert rows(spark.table(sink.full_name)) == [(1,)]
    tj.SqlStep("drop", f"DROP TABLE {sink.full_name}", ["none"], sink).run(spark)
    assert rows(spark.table(sink.full_name)) == []


def test_caller_sees_what_a_step_wrote(spark, database):
    sink = tj.TableDescriptor("seen", ("a",), ("int",), (), database, storage="orc")
    tj.write_table(spark.createDataFrame([(1,)], "a int"), sink)
    assert rows(spark.table(sink.full_name)) == [(1,)]
    tj.SqlStep("add", f"INSERT INTO {sink.full_name} VALUES (2)", ["/some/path"], sink).run(spark)
    assert rows(spark.table(sink.full_name)) == [(1,), (2,)]
    tj.SqlStep("swap", f"INSERT OVERWRITE {sink.full_name} VALUES (3)", [sink.full_name]).run(spark)
    assert rows(spark.table(sink.full_name)) == [(3,)]


def test_inputs_of_nested_views(spark, database):
    table = f"{database}.words"
    tj.run_sql_steps(
        spark,
        [
            f"CREATE TABLE {table} (word string, meaning string) USING orc",
            f"INSERT INTO {table} VALUES ('x', 'a'), ('x', 'b'), ('y', 'c')",
            f"CREATE VIEW {database}.first AS SELECT * FROM {table} WHERE word = 'x'",
            f"CREATE VIEW {database}.second AS SELECT meaning FROM {database}.first",
        ],
    )
    found = tj.query_inputs(spark, f"SELECT * FROM {database}.second").collect()
    place = tj.table_location(spark, tj.TableDescriptor("words", ("word",), ("string",), (), database))
    assert [(row.input.replace("///", "/"), row.n_rows) for row in found] == [(place, 3)]


def test_inputs_of_partitioned_tables_and_formats(spark, database):
    df = spark.createDataFrame([(1, "a b/c"), (2, "50%")], "v int, p string")
    for storage in ("orc", "parquet", "json", "text"):
        table = tj.TableDescriptor(f"t_{storage}", ("v", "p"), ("int", "string"), ("p",), database, storage=storage)
        tj.write_table(df, table, options={"compression": "gzip"} if storage == "text" else None)
    union = " UNION ALL ".join(f"SELECT p FROM {database}.t_{s}" for s in ("orc", "parquet", "json", "text"))
    found = tj.query_inputs(spark, f"SELECT * FROM ({union}) WHERE p <> 'x'").collect()
    assert sorted(row.input.rpartition("/")[2] for row in found) == ["t_json", "t_orc", "t_parquet", "t_text"]
    assert {(row.n_files, row.n_rows) for row in found} == {(2, 2)}
    assert rows(tj.query_inputs(spark, "SELECT 1")) == []


def test_load_file(spark, database):
    path = shared_folder(spark, "lines")
    spark.createDataFrame([("a\t1",), ("b\t2",)], "v string").write.text(path)
    table = tj.TableDescriptor("loaded", ("foo", "bar"), ("string", "int"), (), database, delimiter="\t")
    tj.load_file(spark, path, table)
    tj.load_file(spark, path, table, overwrite=False)
    tj.load_file(spark, path, table)
    assert rows(tj.scan_table(spark, table.full_name)) == [("a", 1), ("b", 2)]


def test_counters_are_summed(spark):
    metrics = tj.StepMetrics()
    assert metrics.as_dict(spark) == {}
    for n in (3, 4):
        df = spark.range(n)
        tj.discard(metrics.count(df, "read", rows=F.count(F.lit(1)), total=F.sum("id")))
    tj.discard(metrics.count(spark.range(5), "write"))
    assert metrics.as_dict(spark) == {"read": {"rows": 7, "total": 9}, "write": {"rows": 5}}


def test_counters_of_statements(spark):
    metrics = tj.StepMetrics()
    for name, n in (("a", 3), ("b", 4), ("a", 5)):
        step = tj.SqlStep(name, ["SET x=1", f"SELECT * FROM range({n})", f"SELECT * FROM range({n})"], ["none"])
        step.run(spark, keep_results=n == 4, metrics=metrics)
    found = metrics.as_dict(spark)
    assert found == {"a": {"rows": 18}, "b": {"rows": 9}}


def test_discard_counts(spark):
    assert tj.discard(spark.range(10)) == 10
    assert tj.discard(spark.range(0)) == 0


def test_user_functions(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")

    def both(k: pd.Series, n: pd.Series) -> pd.Series:
        return k + n.fillna(0).astype(int).astype(str)

    assert rows(tj.apply_function(df, both, ["k", "n"], "out", "string")) == [("a", 1, "a1"), ("b", None, "b0")]
    assert rows(tj.apply_filter(df, lambda k: k == "b", ["k"])) == [("b", None)]
    some = spark.createDataFrame([("ring",), ("rung",), (None,)], "k string")
    assert rows(tj.apply_filter(some, lambda k: k.str.endswith("ing"), ["k"])) == [("ring",)]
    assert rows(tj.apply_filter(df, lambda n: n > 0, ["n"])) == [("a", 1)]


def test_row_operators(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], "k string, n int")
    assert rows(tj.map_columns(df, ["k"], F.upper)) == [("A",), ("A",), ("B",)]
    assert rows(tj.insert_constant(df, "c", 1).select("c").distinct()) == [(1,)]
    assert rows(tj.filter_rows(df, "k", "a")) == [("a", 1), ("a", 2)]
    assert rows(tj.group_count(df, ["k"])) == [("a", 2), ("b", 1)]
    assert rows(tj.distinct_values(df, ["k"])) == [("a",), ("b",)]
    assert [tuple(r) for r in tj.order_rows(df, ["k"], ["n"]).collect()] == [("a", 1), ("a", 2), ("b", 1)]
    assert [tuple(r) for r in tj.limit_rows(df, 2, ["n", "k"]).collect()] == [("a", 1), ("b", 1)]


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local[2]"])
def test_only_a_local_session_may_leave_the_shared_folder_out(master):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        pass

    class Session:
        conf, sparkContext = Conf(), Context()

    Context.master = master
    if master.startswith("local"):
        assert shared_folder(Session(), "x") != shared_folder(Session(), "x")
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(Session(), "x")


def found_inputs(spark, query):
    found = tj.query_inputs(spark, query).collect()
    return sorted(((r.table or "").rpartition(".")[2], r.input.rpartition("/")[2], r.n_files, r.n_rows) for r in found)


def test_inputs_without_rows_and_beside_each_other(spark, database):
    """Unpartitioned tables at folders that look like partitions, one without rows, one with files named by another system."""
    place = shared_folder(spark, "x")
    for day, n in ((3, 2), (4, 0), (5, 1)):
        spark.sql(f"CREATE TABLE {database}.d{day} (id bigint) USING parquet LOCATION '{place}/day={day}'")
        spark.range(n).coalesce(1).write.insertInto(f"{database}.d{day}")
    from tablejobs.storage import glob, move

    (file,) = [path for path in glob(spark, f"{place}/day=5/*.parquet")]
    move(spark, file, f"{place}/day=5/000000_0")
    spark.sql(f"REFRESH TABLE {database}.d5")
    query = f"SELECT a.id FROM {database}.d3 a LEFT JOIN {database}.d4 b USING (id) LEFT JOIN {database}.d5 c USING (id)"
    assert found_inputs(spark, query) == [("d3", "day=3", 1, 2), ("d4", "day=4", 0, 0), ("d5", "day=5", 1, 1)]
    assert found_inputs(spark, f"SELECT * FROM {database}.d3 WHERE false") == [("d3", "day=3", 0, 0)]


def test_inputs_of_self_joins_common_tables_and_subqueries(spark, database):
    df = spark.createDataFrame([(i, f"p{i % 4}") for i in range(20)], "v int, p string").coalesce(1)
    tj.write_table(df, tj.TableDescriptor("t", ("v", "p"), ("int", "string"), ("p",), database))
    tj.write_table(df, tj.TableDescriptor("u", ("v", "p"), ("int", "string"), (), database))
    both = f"SELECT * FROM {database}.t a JOIN {database}.t b ON a.v = b.v WHERE a.p = 'p1' AND b.p IN ('p1', 'p2')"
    assert found_inputs(spark, both) == [("t", "t", 2, 10)]
    common = f"WITH c AS (SELECT * FROM {database}.t) SELECT v FROM c WHERE p = 'p0' UNION ALL SELECT v FROM c WHERE p = 'p3'"
    assert found_inputs(spark, common) == [("t", "t", 2, 10)]
    scalar = f"SELECT (SELECT max(v) FROM {database}.u) AS m FROM {database}.t WHERE p = 'p2'"
    assert found_inputs(spark, scalar) == [("t", "t", 1, 5), ("u", "u", 1, 20)]
    inside = f"SELECT v FROM {database}.t WHERE p IN (SELECT p FROM {database}.u WHERE v = 1)"
    assert [row[:2] for row in found_inputs(spark, inside)] == [("t", "t"), ("u", "u")]
    path = tj.table_location(spark, tj.TableDescriptor("u", ("v",), ("int",), (), database))
    assert found_inputs(spark, f"SELECT * FROM orc.`{path}`") == [("", "u", 1, 20)]
    # Kept in memory, the table is still the input; so it is behind a view without its files' names in the driver.
    spark.sql(f"CACHE TABLE {database}.u")
    try:
        spark.sql(f"CREATE VIEW {database}.w AS SELECT count(*) AS n FROM {database}.u")
        assert found_inputs(spark, f"SELECT n FROM {database}.w") == [("u", "u", 1, 20)]
    finally:
        spark.sql(f"UNCACHE TABLE {database}.u")


def test_counting_inputs_reads_no_data_columns(spark, database):
    tj.write_table(spark.range(5), tj.TableDescriptor("n", ("id",), ("bigint",), (), database))
    plan = tj.query_inputs(spark, f"SELECT id FROM {database}.n")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
