import pytest
from conftest import rows

import tablejobs as tj
from tablejobs.errors import (
    FieldError,
    TableHasDataError,
    TableJobError,
    TableMismatchError,
    TransactionalTableError,
)
from tablejobs.sinks.tables import write_files
from tablejobs.storage import exists, shared_folder

STORAGE = ["orc", "text", "parquet", "json"]


def keyed(database, names=("key",), types=("string",), **more):
    return tj.TableDescriptor("kept", names, types, database=database, **{"storage": "orc", **more})


def test_create(spark, database):
    table = keyed(database)
    assert not spark.catalog.tableExists(table.full_name)
    tj.create_table(spark, table)
    tj.create_table(spark, table)
    assert spark.catalog.tableExists(table.full_name)


def test_create_makes_the_database(spark, database):
    table = keyed(database + "_new")
    tj.create_table(spark, table)
    assert spark.catalog.tableExists(table.full_name)


@pytest.mark.parametrize(
    "changed",
    [
        {"names": ("key", "value"), "types": ("string", "string")},
        {"names": ("key2",)},
        {"types": ("int",)},
        {"location": "/tmp/tablejobs-elsewhere"},
        {"transactional": True},
    ],
)
def test_strict_finds_a_difference(spark, database, changed):
    tj.create_table(spark, keyed(database))
    tj.create_table(spark, keyed(database, **changed))
    with pytest.raises(TableMismatchError):
        tj.create_table(spark, keyed(database, **changed), strict=True)


@pytest.mark.parametrize(
    "changed",
    [
        {"partition_keys": ()},
        {"names": ("name", "no"), "partition_keys": ("no",)},
        {"types": ("string", "int")},
    ],
)
def test_strict_finds_a_different_partitioning(spark, database, changed):
    shape = {"names": ("name", "id"), "types": ("string", "string"), "partition_keys": ("id",)}
    tj.create_table(spark, keyed(database, **shape))
    with pytest.raises(TableMismatchError):
        tj.validate_table(spark, keyed(database, **{**shape, **changed}))


@pytest.mark.parametrize("storage", STORAGE)
def test_strict_ignores_case(spark, database, storage):
    tj.create_table(
        spark, keyed(database, ("name", "id"), ("string", "string"), partition_keys=("id",), storage=storage)
    )
    same = tj.TableDescriptor(
        "KEPT", ("NAME", "ID"), ("StRinG", "string"), ("ID",), database.upper(), storage=storage
    )
    tj.create_table(spark, same, strict=True)


def test_strict_finds_another_place(spark, database):
    tj.create_table(spark, keyed(database, location=shared_folder(spark, "custom")))
    with pytest.raises(TableMismatchError, match="kind|path"):
        tj.validate_table(spark, keyed(database))


def test_strict_compares_types_not_their_spelling(spark, database):
    tj.create_table(spark, keyed(database, ("a", "b", "c"), ("integer", "long", "varchar(5)")))
    tj.validate_table(spark, keyed(database, ("a", "b", "c"), ("INT", "bigint", "VARCHAR(5)")))
    with pytest.raises(TableMismatchError):
        tj.validate_table(spark, keyed(database, ("a", "b", "c"), ("INT", "bigint", "VARCHAR(6)")))


def test_drop_removes_managed_files_and_keeps_external_ones(spark, database):
    df = spark.createDataFrame([("a",)], "key string")
    for location in (None, shared_folder(spark, "external")):
        table = keyed(database, location=location)
        tj.write_table(df, table)
        place = tj.table_location(spark, table)
        tj.drop_table(spark, table)
        assert not spark.catalog.tableExists(table.full_name)
        assert exists(spark, place) == (location is not None)


def test_place_of_an_existing_table_wins(spark, database):
    place = shared_folder(spark, "away")
    spark.sql(f"CREATE TABLE {database}.kept (one string, two string) USING orc LOCATION '{place}'")
    table = keyed(database, ("one", "two"), ("string", "string"), partition_keys=("two",))
    assert tj.table_location(spark, table).endswith(place)


def test_unknown_table_is_read_from_its_place(spark, database):
    path = shared_folder(spark, "files")
    table = keyed(database, location=path)
    write_files(spark.createDataFrame([("a",)], "key string"), table, path)
    assert rows(tj.scan_at_location(spark, table)) == [("a",)]
    assert not spark.catalog.tableExists(table.full_name)


def test_transactional_tables_are_refused(spark, database):
    table = keyed(database, transactional=True)
    df = spark.createDataFrame([("a",)], "key string")
    for call in (
        lambda: tj.create_table(spark, table),
        lambda: tj.drop_table(spark, table),
        lambda: tj.write_table(df, table),
    ):
        with pytest.raises(TransactionalTableError):
            call()
    spark.sql(f"CREATE TABLE {table.full_name} (key string) USING orc TBLPROPERTIES ('transactional'='true')")
    plain = keyed(database)
    for call in (
        lambda: tj.write_table(df, plain),
        lambda: tj.insert_into(df, plain.full_name),
        lambda: tj.drop_table(spark, plain),
        lambda: tj.truncate_table(spark, plain.full_name),
        lambda: tj.scan_table(spark, plain.full_name),
    ):
        with pytest.raises(TransactionalTableError):
            call()


@pytest.mark.parametrize("storage", STORAGE)
def test_modes(spark, database, storage):
    table = keyed(database, ("k", "v"), ("string", "int"), storage=storage)

    def frame(*data):
        return spark.createDataFrame(data, "k string, v int")

    tj.write_table(frame(("a", 1)), table)
    with pytest.raises(TableHasDataError):
        tj.write_table(frame(("b", 2)), table, "keep")
    tj.write_table(frame(("b", 2)), table, "update")
    tj.insert_into(frame((None, None)), table.full_name)
    assert rows(tj.scan_table(spark, table.full_name)) == [("a", 1), ("b", 2), (None, None)]
    tj.write_table(frame(("c", 3)), table, "replace")
    assert rows(tj.scan_table(spark, table.full_name)) == [("c", 3)]
    with pytest.raises(ValueError):
        tj.write_table(frame(), table, "other")


@pytest.mark.parametrize("storage", STORAGE)
def test_rows_follow_the_columns_of_the_existing_table(spark, database, storage):
    made = keyed(database, ("a", "b", "c"), ("string", "string", "int"), storage=storage, delimiter="|")
    tj.create_table(spark, made)
    df = spark.createDataFrame([("b1", "a1")], "b string, a string")
    tj.write_table(df, keyed(database, ("b", "a"), ("string", "string"), storage=storage), "update")
    tj.insert_into(df, made.full_name)
    assert rows(tj.scan_table(spark, made.full_name)) == [("a1", "b1", None)] * 2


@pytest.mark.parametrize("storage", STORAGE)
def test_rows_can_replace_their_own_table(spark, database, storage):
    table = keyed(database, ("a", "p"), ("string", "string"), partition_keys=("p",), storage=storage)
    tj.write_table(spark.createDataFrame([("1", "x y"), ("2", "z")], "a string, p string"), table)
    tj.write_table(tj.scan_table(spark, table.full_name).where("a = '1'"), table, "replace")
    assert rows(tj.scan_table(spark, table.full_name)) == [("1", "x y")]
    wider = keyed(database, ("a", "b", "p"), ("string", "int", "string"), partition_keys=("p",), storage=storage)
    tj.write_table(tj.scan_table(spark, table.full_name), wider, "replace")
    assert rows(tj.scan_table(spark, table.full_name)) == [("1", None, "x y")]


@pytest.mark.parametrize("storage", STORAGE)
def test_replace_that_fails_late_keeps_the_old_table(spark, database, storage):
    table = keyed(database, ("a", "p"), ("int", "string"), partition_keys=("p",), storage=storage)
    tj.write_table(spark.createDataFrame([(1, "x")], "a int, p string"), table)
    wider = keyed(database, ("a", "b", "p"), ("int", "string", "string"), partition_keys=("p",), storage=storage)
    for target, bad in (
        (table, spark.createDataFrame([("5", "x"), ("no number", "x")], "a string, p string")),
        (wider, spark.createDataFrame([("5", "t", "x"), ("no number", "t", "x")], "a string, b string, p string")),
        (wider, spark.createDataFrame([(5, "t", "x"), (6, "t", "")], "a int, b string, p string")),
    ):
        with pytest.raises(Exception):
            tj.write_table(bad, target, "replace")
        assert rows(tj.scan_table(spark, table.full_name)) == [(1, "x")]
    if storage == "text":
        with pytest.raises(Exception):
            tj.write_table(spark.createDataFrame([(5, "a\nb", "x")], "a int, b string, p string"), wider, "replace")
        assert rows(tj.scan_table(spark, table.full_name)) == [(1, "x")]


def test_failed_replace_keeps_the_old_table(spark, database):
    tj.write_table(spark.createDataFrame([("a",)], "key string"), keyed(database))
    with pytest.raises(FieldError):
        tj.write_table(spark.createDataFrame([("a",)], "other string"), keyed(database, ("key2",)), "replace")
    assert rows(tj.scan_table(spark, f"{database}.kept")) == [("a",)]


def test_replace_gives_the_new_shape(spark, database):
    tj.write_table(spark.createDataFrame([("a",)], "key string"), keyed(database))
    wider = keyed(database, ("key", "n"), ("string", "int"), partition_keys=("n",), storage="parquet")
    tj.write_table(spark.createDataFrame([("b", 1)], "key string, n int"), wider, "replace")
    assert rows(tj.scan_table(spark, wider.full_name)) == [("b", 1)]
    assert tj.describe_table(spark, wider.full_name).partition_names == ["n"]


def test_replace_leaves_no_old_external_rows(spark, database):
    place = shared_folder(spark, "external")
    old = keyed(database, ("k", "p"), ("string", "string"), partition_keys=("p",), location=place)
    tj.write_table(spark.createDataFrame([("a", "x")], "k string, p string"), old)
    new = keyed(database, ("k", "q"), ("string", "string"), partition_keys=("q",), location=place)
    tj.write_table(spark.createDataFrame([("b", "y")], "k string, q string"), new, "replace")
    assert rows(tj.scan_table(spark, new.full_name)) == [("b", "y")]
    assert rows(tj.scan_partitioned(spark, new, place)) == [("b", "y")]


def test_session_settings_are_put_back(spark, database):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    tj.write_table(spark.createDataFrame([("a",)], "key string"), keyed(database))
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("storage", STORAGE)
def test_partition_values_survive(spark, database, storage):
    """Leading zeros, slashes, equal signs, spaces and nulls in partition columns."""
    table = keyed(
        database, ("customer", "year", "month", "note"), ("string", "int", "string", "string"),
        partition_keys=("year", "month", "note"), storage=storage,
    )
    data = [("a", 2014, "03", "a/b=c"), ("b", 2014, "11", "50 %"), ("c", 2015, "03", None)]
    tj.write_partitioned(spark.createDataFrame(data, "customer string, year int, month string, note string"), table)
    assert rows(tj.scan_table(spark, table.full_name)) == sorted(data)
    place = tj.table_location(spark, table)
    assert rows(tj.scan_partitioned(spark, table, place)) == sorted(data)
    assert rows(tj.scan_partitioned(spark, table, place, ["customer"], "month = '03' AND year > 2014")) == [("c",)]


def test_trailing_path_parts_are_ignored(spark):
    root = shared_folder(spark, "parts")
    df = spark.createDataFrame([("a",)], "foo string")
    df.write.orc(f"{root}/continent=Asia/country=India/base_0000006")
    table = keyed("default", ("foo", "continent", "country"), ("string",) * 3, partition_keys=("continent", "country"))
    assert rows(tj.scan_partitioned(spark, table, root)) == [("a", "Asia", "India")]


def test_empty_partition_value_is_refused(spark, database):
    table = keyed(database, ("k", "p"), ("string", "string"), partition_keys=("p",))
    with pytest.raises(Exception, match="empty string"):
        tj.write_partitioned(spark.createDataFrame([("a", "")], "k string, p string"), table)


def test_partitioned_write_needs_partitions(spark, database):
    with pytest.raises(TableJobError):
        tj.write_partitioned(spark.createDataFrame([("a",)], "key string"), keyed(database))


def test_replace_partitions_leaves_the_others(spark, database):
    table = keyed(database, ("v", "p"), ("int", "string"), partition_keys=("p",))
    tj.write_partitioned(spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string"), table)
    tj.write_partitioned(spark.createDataFrame([(3, "y")], "v int, p string"), table, "replace_partitions")
    assert rows(tj.scan_table(spark, table.full_name)) == [(1, "x"), (3, "y")]


def test_register_partitions(spark, database):
    place = shared_folder(spark, "registered")
    table = keyed(database, ("one", "two"), ("string", "string"), partition_keys=("two",), location=place)
    tj.register_partitions(spark, table, [{"two": "2"}])
    tj.register_partitions(spark, table, [{"two": "2"}, {"two": "it's"}])
    known = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table.full_name}").collect()]
    assert known == ["two=2", "two=it%27s"]
    write_files(spark.createDataFrame([("a", "3")], "one string, two string"), table, place, mode="append")
    tj.register_partitions(spark, table)
    assert rows(tj.scan_table(spark, table.full_name)) == [("a", "3")]


def test_register_ignores_tables_without_partitions(spark, database):
    table = keyed(database)
    tj.register_partitions(spark, table, [{"two": "2"}])
    assert not spark.catalog.tableExists(table.full_name)


def test_remove_partitions(spark, database):
    table = keyed(database, ("v", "p"), ("int", "string"), partition_keys=("p",))
    tj.write_partitioned(spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string"), table)
    tj.remove_partitions(spark, table.full_name, [{"p": "x"}, {"p": "nowhere"}])
    assert rows(tj.scan_table(spark, table.full_name)) == [(2, "y")]
    tj.truncate_table(spark, table.full_name)
    assert rows(tj.scan_table(spark, table.full_name)) == []


@pytest.mark.parametrize("storage", ["sequencefile", "avro", "textfile"])
def test_hive_storage_needs_a_hive_catalog(spark, database, storage):
    with pytest.raises(TableJobError, match="Hive catalog"):
        tj.create_table(spark, keyed(database, storage=storage))


def test_avro_files_need_the_package(spark):
    with pytest.raises(TableJobError, match="Avro"):
        tj.scan_partitioned(spark, keyed("default", storage="avro"), "/nowhere")
