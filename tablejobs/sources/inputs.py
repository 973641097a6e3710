"""Which base inputs does a query read, views resolved?"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "table string, input string, n_files bigint, n_rows bigint"


def query_inputs(spark: SparkSession, query: str) -> DataFrame:
    """The base tables and folders a query reads: table, input, n_files, n_rows.

    ``table`` is the catalog name, null for files named by path; ``input`` is the table's location or the named paths.
    Both come from the relations of the analysed plan, so views, nested ones and common tables too, and subqueries are
    resolved by Spark, and inputs without files are listed with zeros. ``n_files`` and ``n_rows`` count the files that
    hold rows, and these rows, of all partitions the query does not prune; a table read twice counts once.

    Counting is one aggregation by file over all inputs; it reads no data columns. The driver handles plans only. A
    relation that is not made of files (a view over constants, a range) is no input.
    """
    plan = spark.sql(query)._jdf.queryExecution().analyzed()
    state = spark._jsparkSession.sessionState()
    listed = {_identity(leaf) for leaf in _relations(plan)}
    if not listed:
        return spark.createDataFrame([], SCHEMA)
    counted = []
    # Optimised anew: data that a session keeps in memory would hide the tables it came from.
    for part in _with_subqueries(state.optimizer().execute(plan)):
        leaves = list(_relations(part, subqueries=False))
        physical = spark._jvm.org.apache.spark.sql.execution.QueryExecution.createSparkPlan(state.planner(), part)
        for scan in _each(physical.collectLeaves()):
            if not _is(scan, "FileSourceScanExec"):
                continue
            filters = [f for f in _each(scan.partitionFilters()) if not _decided_at_run_time(spark, f)]
            leaf = _read_by(scan, filters, leaves)
            rows = _frame(spark, leaf)
            for condition in filters:
                rows = rows.where(_column(spark, condition))
            counted.append(_by_file(rows, leaf, F.col("_metadata.file_path")))
        for leaf in leaves:
            if _is(leaf, "HiveTableRelation"):
                counted.append(_by_file(_frame(spark, leaf), leaf, F.input_file_name()))
    inputs = spark.createDataFrame([(*one,) for one in listed], "table string, input string")
    if not counted:
        return inputs.select("*", *[F.lit(0).cast("bigint").alias(name) for name in ("n_files", "n_rows")])
    # Files of a table that is read more than once are the same ones.
    files = reduce(DataFrame.unionAll, counted).groupBy("of_table", "of_input", "file").agg(F.max("n").alias("n"))
    sums = files.groupBy("of_table", "of_input").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"))
    same = F.col("table").eqNullSafe(F.col("of_table")) & (F.col("input") == F.col("of_input"))
    zero = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("n_files", "n_rows")]
    return inputs.join(sums, same, "left").select("table", "input", *zero)


def _each(sequence) -> Iterator:
    """The elements of a Scala sequence."""
    return (sequence.apply(i) for i in range(sequence.size()))


def _is(node, name: str) -> bool:
    return node.getClass().getSimpleName() == name


def _with_subqueries(plan) -> list:
    return [plan, *_each(plan.subqueriesAll())]


def _relations(plan, subqueries: bool = True) -> Iterator:
    """The leaves of a plan that read files."""
    for part in _with_subqueries(plan) if subqueries else [plan]:
        for leaf in _each(part.collectLeaves()):
            files = _is(leaf, "LogicalRelation") and _is(leaf.relation(), "HadoopFsRelation")
            if files or _is(leaf, "HiveTableRelation"):
                yield leaf


def _identity(leaf) -> tuple[str | None, str]:
    """Catalog name, if any, and location."""
    if _is(leaf, "HiveTableRelation"):
        table = leaf.tableMeta()
    elif leaf.catalogTable().isDefined():
        table = leaf.catalogTable().get()
    else:
        paths = sorted(path.toString() for path in _each(leaf.relation().location().rootPaths()))
        base = leaf.relation().options().get("basePath")
        return None, base.get() if base.isDefined() else ",".join(paths)
    identifier = table.identifier()
    database = f"{identifier.database().get()}." if identifier.database().isDefined() else ""
    return f"{database}{identifier.table()}", table.location().toString()


def _read_by(scan, filters: list, leaves: list):
    """The relation a scan reads: the same files, and the attributes that the scan and its filters name."""
    same = [leaf for leaf in leaves if _is(leaf, "LogicalRelation") and leaf.relation().equals(scan.relation())]
    fitting = [leaf for leaf in same if all(f.references().subsetOf(leaf.outputSet()) for f in filters)]
    exact = [leaf for leaf in fitting if scan.outputSet().subsetOf(leaf.outputSet())]
    return (exact or fitting)[0]


def _decided_at_run_time(spark: SparkSession, condition) -> bool:
    """Is this a filter by the rows of another table? Which partitions it prunes is not known before the query runs."""
    subqueries = spark._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression
    return "DynamicPruning" in condition.getClass().getSimpleName() or subqueries.hasSubquery(condition)


def _frame(spark: SparkSession, plan) -> DataFrame:
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def _column(spark: SparkSession, condition):
    from pyspark.sql.classic.column import Column

    return Column(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(condition))


def _by_file(rows: DataFrame, leaf, file) -> DataFrame:
    table, place = _identity(leaf)
    counts = rows.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.lit(table).cast("string").alias("of_table"), F.lit(place).alias("of_input"), "file", "n")
