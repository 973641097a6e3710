"""User-written generators and aggregates: any number of rows per row, and states that are merged.

Use them only for logic the built-in functions cannot express; both run on Arrow batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.errors import FieldError

#: States a task holds before it hands them on.
HELD_STATES = 20_000
#: Groups of tasks whose states of one key are merged first.
SALTS = 32


class UserAggregate(Protocol):
    """An aggregate whose states can be merged in any order. States must be picklable."""

    def zero(self) -> Any: ...

    def add(self, state: Any, *values: pd.Series) -> Any:
        """The state with some rows of one group added."""

    def merge(self, state: Any, other: Any) -> Any: ...

    def finish(self, state: Any) -> Any:
        """The result: a value of the output type."""


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise FieldError(f"no such columns: {missing}")
    return [df.schema[name] for name in names]


def apply_generator(
    df: DataFrame,
    generate: Callable[..., pd.DataFrame],
    inputs: Sequence[str],
    columns: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Any number of rows per row: the columns ``keep`` (all) of a row beside each row made of it.

    ``generate`` gets one pandas series per input, numbered from 0, and returns a frame with the ``columns`` (DDL) whose
    index holds the numbers of the rows it was made of; a row without any vanishes. Batches are cut by Spark's
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    keep = list(df.columns if keep is None else keep)
    added = T.StructType.fromDDL(columns)
    schema = T.StructType([*_fields(df, keep), *added])
    repeated = [name for name in added.names if name in keep]
    if repeated:
        raise FieldError(f"columns are there already: {repeated}")
    _fields(df, inputs)
    read = [*keep, *inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        for batch in batches:
            given = [batch.column(len(keep) + i).to_pandas() for i in range(len(inputs))]
            made = generate(*given)
            if missing := [name for name in added.names if name not in made.columns]:
                raise FieldError(f"the generated rows lack the columns {missing}")
            at = pa.array(made.index.to_numpy(np.int64))
            arrays = [batch.column(i).take(at).cast(types.field(i).type) for i in range(len(keep))]
            arrays += [pa.Array.from_pandas(made[f.name], type=types.field(f.name).type) for f in added]
            yield pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], schema=types)

    return df.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(read)]).mapInArrow(run, schema)


def aggregate_with(
    df: DataFrame, keys: Sequence[str], inputs: Sequence[str], aggregate: UserAggregate, output: str, output_type: str
) -> DataFrame:
    """One row per group: the keys and what a user-written aggregate makes of the group's rows.

    Each task adds its rows to states of its own and hands on one state per key, or more once it holds ``HELD_STATES``;
    states, never rows, are shuffled. States of a key are merged in groups of tasks first, then as a whole, so a key
    that holds most rows costs each task one state. Null keys are a group; an empty table gives no rows, with or
    without keys.
    """
    key_fields = _fields(df, keys)
    _fields(df, inputs)
    if output in keys:
        raise FieldError(f"column is there already: {output}")
    own = [f"c{i}" for i in range(len(keys))]
    places = [T.StructField(name, field.dataType) for name, field in zip(own, key_fields)]
    partial_schema = T.StructType([*places, T.StructField("salt", T.IntegerType()), T.StructField("state", T.BinaryType())])
    result_schema = T.StructType([*places, *T.StructType.fromDDL(f"result {output_type}")])

    def comparable(key: tuple) -> tuple:
        return tuple("NaN" if isinstance(v, float) and v != v else (type(v).__name__, repr(v)) for v in key)

    def rows_of(held: list[tuple[tuple, int, Any]], schema: T.StructType, pickled: bool) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        columns = [[key[i] for key, _, _ in held] for i in range(len(own))]
        if pickled:
            columns += [[salt for _, salt, _ in held], [pickle.dumps(state) for _, _, state in held]]
        else:
            columns += [[aggregate.finish(state) for _, _, state in held]]
        arrays = [pa.array(values, types.field(i).type) for i, values in enumerate(columns)]
        yield pa.RecordBatch.from_arrays(arrays, schema=types)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % SALTS
        held: dict[tuple, tuple[tuple, Any]] = {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(own))]
            found = list(zip(*columns)) if own else [()] * batch.num_rows
            codes, marks = pd.factorize(pd.Series([comparable(key) for key in found], dtype=object))
            order = np.argsort(codes, kind="stable")
            borders = np.searchsorted(codes[order], np.arange(len(marks) + 1))
            for i, mark in enumerate(marks):
                at = order[borders[i] : borders[i + 1]]
                values = [batch.column(len(own) + j).take(pa.array(at)).to_pandas() for j in range(len(inputs))]
                key, state = held.get(mark) or (found[at[0]], aggregate.zero())
                held[mark] = key, aggregate.add(state, *values)
            if len(held) > HELD_STATES:
                yield from rows_of([(key, salt, state) for key, state in held.values()], partial_schema, True)
                held.clear()
        if held:
            yield from rows_of([(key, salt, state) for key, state in held.values()], partial_schema, True)

    def merge(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Rows come sorted by key: one state is held, and those that are complete until a batch of them goes on.
            done: list[tuple[tuple, int, Any]] = []
            mark = None
            schema = result_schema if last else partial_schema
            for batch in batches:
                columns = [column.to_pylist() for column in batch.columns]
                for *key, salt, state in zip(*columns):
                    other, own_mark = pickle.loads(state), (comparable(tuple(key)), 0 if last else salt)
                    if own_mark == mark:
                        key_, salt_, held = done[-1]
                        done[-1] = key_, salt_, aggregate.merge(held, other)
                        continue
                    if len(done) >= HELD_STATES:
                        yield from rows_of(done, schema, not last)
                        done = []
                    done.append((tuple(key), salt, other))
                    mark = own_mark
            if done:
                yield from rows_of(done, schema, not last)

        return run

    read = df.select(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate([*keys, *inputs])])
    partial = read.mapInArrow(add, partial_schema)
    first = partial.repartition(*own, "salt").sortWithinPartitions(*own, "salt").mapInArrow(merge(False), partial_schema)
    whole = first.repartition(*own) if own else first.coalesce(1)
    result = whole.sortWithinPartitions(*own, "salt").mapInArrow(merge(True), result_schema)
    return result.select(*[F.col(c).alias(name) for c, name in zip(own, keys)], F.col("result").alias(output))
