"""Whole flows: load, change, copy, partition, view."""

from conftest import rows
from pyspark.sql import functions as F

import tablejobs as tj
from tablejobs.storage import shared_folder

VISITS = [
    (f"2024-05-0{i + 1} 10:00:00", f"shopper{i % 3}", f"shop{i % 2}", f"item{i}", zone)
    for i, zone in enumerate(["north", "south", "west", "north", "south", "north"])
]
NAMES = ("at", "shopper", "shop", "item", "zone")
TEXTS = ("string",) * len(NAMES)


def visits(spark):
    """The rows of a text file."""
    path = shared_folder(spark, "visits")
    tj.write_text_table(spark.createDataFrame(VISITS, list(NAMES)), path, "\t")
    return tj.scan_text_table(spark, tj.TableDescriptor("f", NAMES, TEXTS, delimiter="\t"), path)


def test_load_fill_and_convert(spark, database):
    """A file loaded into a table, a second table filled by SQL from it, a third by a row function."""
    path = shared_folder(spark, "data")
    spark.createDataFrame([("only line",)], "v string").write.text(path)
    seed = tj.TableDescriptor("seed", ("line",), ("string",), database=database)
    words, loud = (
        tj.TableDescriptor(name, ("word", "meaning"), ("string", "string"), database=database)
        for name in ("words", "loud_words")
    )
    tj.load_file(spark, path, seed)
    statements = [
        f"INSERT OVERWRITE TABLE {words.full_name} SELECT 'ja', 'yes' FROM {seed.full_name}",
        f"INSERT INTO TABLE {words.full_name} SELECT 'nein', 'no' FROM {seed.full_name}",
    ]
    tj.SqlStep("fill words", statements, [seed], words).run(spark)
    upper = tj.map_columns(tj.scan_table(spark, words.full_name), ["word", "meaning"], F.upper)
    tj.copy_to_table(upper, loud, "replace")
    assert rows(tj.scan_table(spark, loud.full_name)) == [("JA", "YES"), ("NEIN", "NO")]


def test_partition_rows_and_count(spark, database):
    """Partitions come from the rows; two of them are read, two fields each, and counted into a file."""
    table = tj.TableDescriptor("visits", NAMES, TEXTS, ("zone",), database)
    tj.create_table(spark, table)
    tj.truncate_table(spark, table.full_name)
    tj.remove_partitions(spark, table.full_name, [{"zone": "north"}, {"zone": "south"}])
    tj.insert_into(visits(spark), table.full_name)
    chosen = tj.scan_table(spark, table.full_name, ["at", "zone"], "zone = 'north' OR zone = 'south'")
    path = shared_folder(spark, "counts")
    tj.copy_to_file(tj.group_count(chosen, ["zone"]), path, "\t")
    assert rows(spark.read.text(path)) == [("north\t3",), ("south\t2",)]


def test_filter_a_partitioned_text_table(spark, database):
    types = ("timestamp", *TEXTS[1:])
    table = tj.TableDescriptor("visits", NAMES, types, ("zone",), database, "\t")
    tj.write_partitioned(visits(spark), table)
    north = tj.filter_rows(tj.scan_table(spark, table.full_name), "zone", "north")
    assert [row["item"] for row in tj.order_rows(north, ["item"]).collect()] == ["item0", "item3", "item5"]
    assert dict(north.dtypes)["at"] == "timestamp"


def test_view_over_a_partitioned_table(spark, database):
    table = tj.TableDescriptor("visits", NAMES, TEXTS, ("zone",), database)
    tj.write_partitioned(visits(spark), table)
    select = f"SELECT DISTINCT shopper FROM {table.full_name} WHERE zone = 'north'"
    inputs = [row.input for row in tj.query_inputs(spark, select).collect()]
    view = f"{database}.northerners"
    tj.SqlStep("make view", f"CREATE OR REPLACE VIEW {view} AS {select}", inputs).run(spark)
    assert rows(spark.table(view)) == [("shopper0",), ("shopper2",)]
    read = tj.query_inputs(spark, f"SELECT * FROM {view}").collect()
    assert [(row.input, row.n_files, row.n_rows) for row in read] == [(inputs[0], 1, 3)]
