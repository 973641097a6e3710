"""SQL statements as steps of a job."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablejobs.descriptor import TableDescriptor
from tablejobs.errors import SqlStepError, TableJobError
from tablejobs.plans.metrics import StepMetrics
from tablejobs.sinks.discard import discard
from tablejobs.sinks.tables import create_table, write_table
from tablejobs.sources.text import accepted_rows, judged_lines, rejected_lines, scan_text_table
from tablejobs.storage import materialize, release


def run_sql_steps(
    spark: SparkSession,
    statements: Sequence[str],
    keep_results: bool = False,
    store_results: bool = True,
    metrics: StepMetrics | None = None,
    group: str = "sql",
) -> list[DataFrame | None] | None:
    """Run statements in order and stop at the first that fails.

    Without ``keep_results`` the rows of a query are computed and dropped. With it they are returned as
    frames, and a statement without rows (a command) gives ``None``. The rows are stored in the shared
    folder as they are at that moment; ``store_results=False`` spares that copy for steps whose later
    statements do not change what the query reads. ``metrics`` counts the rows of each query that is
    computed here, and the rows and files that commands write.
    """
    results = []
    for statement in statements:
        try:
            rows = spark.sql(statement)
            if metrics is not None and rows.columns and (store_results or not keep_results):
                rows = metrics.count(rows, group)
            if not rows.columns:
                if metrics is not None:
                    metrics.count_command(rows, group)
                rows = None
            elif keep_results and store_results:
                rows = materialize(rows, "result")
            elif not keep_results:
                discard(rows)
        except Exception as error:
            raise SqlStepError(statement, error) from error
        results.append(rows)
    return results if keep_results else None


@dataclass(frozen=True)
class SqlStep:
    """A named step: statements, the sources they read, the table they fill, and settings of their own.

    The step runs in a session of its own: it starts with the settings of the caller's session, its own
    settings and temporary views end with it. The sink table is made before the statements run, and again
    afterwards in case they dropped it. The caller's session is told to look at the files of sink and
    sources anew, so a step that changes other tables than its sink should name them as sources.
    """

    name: str
    statements: Sequence[str]
    sources: Sequence[str | TableDescriptor]
    sink: TableDescriptor | None = None
    settings: Mapping[str, str] | None = None

    def __post_init__(self):
        if not self.sources:
            raise TableJobError(f"step '{self.name}' needs at least one source")
        if isinstance(self.statements, str):
            object.__setattr__(self, "statements", (self.statements,))

    def run(
        self,
        spark: SparkSession,
        keep_results: bool = False,
        store_results: bool = True,
        metrics: StepMetrics | None = None,
    ) -> list[DataFrame | None] | None:
        """Run the statements as ``run_sql_steps`` does. Counters are in the group of the step's name."""
        session = spark.newSession()
        inherited = {k: v for k, v in spark.conf.getAll.items() if spark.conf.isModifiable(k)}
        for key, value in {**inherited, **(self.settings or {})}.items():
            session.conf.set(key, value)
        if self.sink is not None:
            create_table(session, self.sink)
        try:
            results = run_sql_steps(
                session, self.statements, keep_results, store_results, metrics, self.name
            )
            if self.sink is not None:
                create_table(session, self.sink)
            return results
        finally:
            self._refresh(spark)

    def _refresh(self, spark: SparkSession) -> None:
        tables = [*self.sources, *([self.sink] if self.sink is not None else [])]
        for table in tables:
            name = table.full_name if isinstance(table, TableDescriptor) else table
            if re.fullmatch(r"\w+(\.\w+)*", name) and spark.catalog.tableExists(name):
                spark.catalog.refreshTable(name)


def load_file(
    spark: SparkSession,
    path: str,
    table: TableDescriptor,
    overwrite: bool = True,
    bad_rows: str = "error",
    rejects: str | None = None,
) -> None:
    """Load delimited text files into a table.

    Lines that do not fit stop the load unless ``bad_rows`` is ``"null"`` or ``"skip"``. With ``rejects``, a folder
    that does not exist yet, such lines go there as JSON (file, reason, line) and the others into the table; the files
    are read once.
    """
    mode = "replace" if overwrite else "update"
    if rejects is None:
        write_table(scan_text_table(spark, table, path, bad_rows=bad_rows), table, mode)
        return
    judged = materialize(judged_lines(spark, table, path), "judged")
    rejected_lines(judged).write.json(rejects)
    write_table(accepted_rows(judged), table, mode)
    release(judged)
