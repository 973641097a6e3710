"""The description of a table: names, types, partition columns, storage and place."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import cached_property
from itertools import takewhile

from pyspark.errors import ParseException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tablejobs.errors import FieldError, TableJobError
from tablejobs.storage import quoted

# Fixed values of the data model.
DEFAULT_DATABASE = "default"
DEFAULT_DELIMITER = "\x01"
TRANSACTIONAL = "transactional"

# The column of a table of text lines, and the properties that make one a delimited text table.
LINE = "value"
COLUMNS_PROPERTY = "tablejobs.columns"
DELIMITER_PROPERTY = "tablejobs.delimiter"

# An absolute path, with or without a scheme.
_ABSOLUTE = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*:)?/")


def as_stored(data_type: T.DataType) -> T.DataType:
    """The type values have in a frame: ``char`` and ``varchar`` are strings there."""
    if isinstance(data_type, (T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(as_stored(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.MapType):
        return T.MapType(
            as_stored(data_type.keyType), as_stored(data_type.valueType), data_type.valueContainsNull
        )
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, as_stored(f.dataType), f.nullable) for f in data_type])
    return data_type


@dataclass(frozen=True, eq=False)
class TableDescriptor:
    """Declared shape of a table. Names and types are matched without regard to case.

    ``storage`` is a Spark format (``orc``, ``parquet``, ``json``, ``text``) or, in a session with a Hive
    catalog, ``textfile``, ``sequencefile`` or ``avro``. Left out, it is ``text`` if a delimiter is given
    and ``orc`` otherwise. Tables of delimited text have the delimiter ``\\1`` unless another is given.
    """

    table: str
    names: tuple[str, ...]
    types: tuple[str, ...]
    partition_keys: tuple[str, ...] = ()
    database: str | None = DEFAULT_DATABASE
    delimiter: str | None = None
    storage: str | None = None
    location: str | None = None
    transactional: bool = False
    buckets: int = 0

    def __post_init__(self):
        if not self.table:
            raise FieldError("a table name is required")
        if not self.names or len(self.names) != len(self.types):
            raise FieldError("every column needs one name and one type")
        for field in ("names", "types", "partition_keys"):
            object.__setattr__(self, field, tuple(getattr(self, field) or ()))
        object.__setattr__(self, "table", self.table.lower())
        object.__setattr__(self, "database", (self.database or DEFAULT_DATABASE).lower())
        storage = self.storage or ("orc" if self.delimiter is None else "text")
        object.__setattr__(self, "storage", storage.lower())
        if self.delimiter is None and self.storage in ("text", "textfile", "sequencefile"):
            object.__setattr__(self, "delimiter", DEFAULT_DELIMITER)
        lower = [name.lower() for name in self.names]
        if len(set(lower)) != len(lower):
            raise FieldError(f"column names repeat (case is ignored): {list(self.names)}")
        for key in self.partition_keys:
            if key.lower() not in lower:
                raise FieldError(f"partition key '{key}' is not among the columns {list(self.names)}")
        if self.storage == "text" and LINE in self.partition_names:
            raise FieldError(f"a text table cannot be partitioned by '{LINE}', the name of its line column")
        if self.location is not None and not _ABSOLUTE.match(self.location):
            raise FieldError(f"give the location from the root on, not as {self.location}")

    # -- names and types ------------------------------------------------------------------

    @property
    def partitioned(self) -> bool:
        return bool(self.partition_keys)

    @property
    def full_name(self) -> str:
        return f"{self.database}.{self.table}"

    @property
    def partition_names(self) -> list[str]:
        return [key.lower() for key in self.partition_keys]

    @property
    def data_names(self) -> list[str]:
        return [name.lower() for name in self.names if name.lower() not in self.partition_names]

    @cached_property
    def declared_types(self) -> dict[str, T.DataType]:
        """Lower-case name to declared type, in column order. Needs a running session."""
        parsed = {}
        for name, text in zip(self.names, self.types):
            try:
                parsed[name.lower()] = T.StructType.fromDDL(f"value {text.lower()}")["value"].dataType
            except ParseException as error:
                raise TableJobError(f"column '{name}' has a type Spark does not know: {text}") from error
        return parsed

    def _struct(self, names: list[str]) -> T.StructType:
        return T.StructType([T.StructField(n, as_stored(self.declared_types[n])) for n in names])

    @property
    def data_schema(self) -> T.StructType:
        return self._struct(self.data_names)

    @property
    def partition_schema(self) -> T.StructType:
        if not self.partitioned:
            raise TableJobError(f"{self.full_name} is not partitioned")
        return self._struct(self.partition_names)

    @property
    def schema(self) -> T.StructType:
        """Data columns, then partition columns."""
        return self._struct(self.data_names + self.partition_names)

    def type_text(self, name: str) -> str:
        """Declared type of one column, lower-case, as text."""
        return dict(zip((n.lower() for n in self.names), self.types))[name.lower()].lower()

    # -- place ----------------------------------------------------------------------------

    def location_in(self, warehouse: str) -> str:
        """The declared location, else the usual place below the warehouse directory."""
        if self.location is not None:
            return self.location
        if self.database == DEFAULT_DATABASE:
            return f"{warehouse}/{self.table}"
        return f"{warehouse}/{self.database}.db/{self.table}"

    # -- equality -------------------------------------------------------------------------

    def _identity(self) -> tuple:
        return (
            self.database, self.table,
            tuple(n.lower() for n in self.names), tuple(t.lower() for t in self.types),
            tuple(self.partition_names), self.delimiter, self.storage, self.location,
            self.transactional, self.buckets,
        )

    def __eq__(self, other):
        return isinstance(other, TableDescriptor) and self._identity() == other._identity()

    def __hash__(self):
        return hash(self._identity())


@dataclass(frozen=True)
class CatalogTable:
    """What the catalog says about a table. The lines of a ``delimited`` one are still to be split."""

    descriptor: TableDescriptor
    kind: str
    delimited: bool


def _storage(about: dict) -> str:
    """Storage of a table from the catalog's JSON description."""
    provider = about.get("provider", "view")
    if provider != "hive":
        return provider
    input_format = about.get("input_format", "").lower()
    for part, storage in (("sequence", "sequencefile"), ("avro", "avro"), ("orc", "orc"), ("parquet", "parquet")):
        if part in input_format:
            return storage
    return "textfile"


def split_name(name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return (database or DEFAULT_DATABASE).lower(), table.lower()


def look_up(spark: SparkSession, name: str) -> CatalogTable:
    """Read a table's description from the catalog. Columns first, partition keys after them."""
    database, table = split_name(name)
    target = quoted(f"{database}.{table}")
    if not spark.catalog.tableExists(f"{database}.{table}"):
        raise TableJobError(f"table not found: {database}.{table}")
    about = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {target} AS JSON").first()[0])
    properties = about.get("table_properties", {})
    partition_keys = about.get("partition_columns", [])
    described = spark.sql(f"DESCRIBE TABLE {target}").collect()
    columns = [
        (row["col_name"], row["data_type"])
        for row in takewhile(lambda row: not row["col_name"].startswith("#"), described)
        if row["col_name"]
    ]
    if COLUMNS_PROPERTY in properties:
        lines = [c for c in columns if c[0] in partition_keys]
        columns = [tuple(c) for c in json.loads(properties[COLUMNS_PROPERTY])] + lines
    descriptor = TableDescriptor(
        table=table,
        names=tuple(c[0] for c in columns),
        types=tuple(c[1] for c in columns),
        partition_keys=tuple(partition_keys),
        database=database,
        delimiter=properties.get(DELIMITER_PROPERTY, about.get("storage_properties", {}).get("field.delim")),
        storage=_storage(about),
        location=about.get("location"),
        transactional=properties.get(TRANSACTIONAL, "false").lower() == "true",
        buckets=int(about.get("num_buckets", 0)),
    )
    return CatalogTable(descriptor, about["type"], COLUMNS_PROPERTY in properties)


def describe_table(spark: SparkSession, name: str) -> TableDescriptor:
    """Descriptor of an existing catalog table."""
    return look_up(spark, name).descriptor
