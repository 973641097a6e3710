import pytest
from pyspark.sql import types as T

from tablejobs import TableDescriptor, create_table, describe_table
from tablejobs.descriptor import _storage
from tablejobs.errors import FieldError, TableJobError

COLUMNS = ("id", "label", "active")
TYPES = ("int", "string", "boolean")


@pytest.mark.parametrize("name", [None, ""])
def test_table_name_is_required(name):
    with pytest.raises(FieldError):
        TableDescriptor(name, ("foo",), ("string",))


@pytest.mark.parametrize("names, types", [(("foo",), ()), ((), ()), (("a", "b"), ("int",))])
def test_names_and_types_have_the_same_length(names, types):
    with pytest.raises(FieldError):
        TableDescriptor("t", names, types)


def test_partition_keys_are_columns():
    with pytest.raises(FieldError):
        TableDescriptor("t", ("foo",), ("string",), ("bar",))
    assert TableDescriptor("t", ("foo", "Bar"), ("string", "int"), ("BAR",)).partition_names == ["bar"]


def test_names_may_not_differ_in_case_only():
    with pytest.raises(FieldError):
        TableDescriptor("t", ("foo", "FOO"), ("string", "string"))


def test_table_and_database_are_lower_case():
    table = TableDescriptor("Sales", COLUMNS, TYPES, database="Shop")
    assert table.full_name == "shop.sales"
    assert TableDescriptor("T", COLUMNS, TYPES, database=None).database == "default"
    assert TableDescriptor("T", COLUMNS, TYPES, database="").database == "default"


def test_fields_have_types(spark):
    table = TableDescriptor("t", COLUMNS, TYPES)
    assert table.schema == T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("label", T.StringType()),
            T.StructField("active", T.BooleanType()),
        ]
    )


def test_types_and_names_are_matched_in_lower_case(spark):
    table = TableDescriptor("t", ("Code", "NAME"), ("INT", "STRING"))
    assert table.schema.names == ["code", "name"]
    assert table.type_text("CODE") == "int"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("string", T.StringType()), ("boolean", T.BooleanType()), ("tinyint", T.ByteType()),
        ("smallint", T.ShortType()), ("int", T.IntegerType()), ("bigint", T.LongType()),
        ("float", T.FloatType()), ("double", T.DoubleType()), ("timestamp", T.TimestampType()),
        ("date", T.DateType()), ("binary", T.BinaryType()), ("decimal(10,2)", T.DecimalType(10, 2)),
        ("varchar(10)", T.StringType()), ("char(3)", T.StringType()),
        ("array<int>", T.ArrayType(T.IntegerType())),
        ("map<string,int>", T.MapType(T.StringType(), T.IntegerType())),
        ("struct<a:int>", T.StructType([T.StructField("a", T.IntegerType())])),
    ],
)
def test_every_type(spark, text, expected):
    assert TableDescriptor("t", ("c",), (text,)).schema["c"].dataType == expected


def test_union_type_is_refused(spark):
    with pytest.raises(TableJobError):
        TableDescriptor("t", ("c",), ("uniontype<int,string>",)).schema


def test_partition_columns_are_found_by_name(spark):
    last = TableDescriptor("t", COLUMNS, TYPES, ("active",))
    assert last.data_names == ["id", "label"]
    assert last.partition_schema == T.StructType([T.StructField("active", T.BooleanType())])
    first = TableDescriptor("t", ("code", "name"), ("int", "string"), ("code",))
    assert first.data_schema == T.StructType([T.StructField("name", T.StringType())])
    assert first.schema.names == ["name", "code"]


def test_unpartitioned_table_has_no_partition_schema(spark):
    with pytest.raises(TableJobError):
        TableDescriptor("t", COLUMNS, TYPES).partition_schema


def test_delimiter_and_storage():
    assert TableDescriptor("t", COLUMNS, TYPES, storage="TEXT").delimiter == "\x01"
    tab = TableDescriptor("t", COLUMNS, TYPES, delimiter="\t")
    assert (tab.delimiter, tab.storage) == ("\t", "text")
    plain = TableDescriptor("t", COLUMNS, TYPES)
    assert (plain.delimiter, plain.storage) == (None, "orc")


def test_location():
    assert TableDescriptor("Sales", COLUMNS, TYPES).location_in("warehouse") == "warehouse/sales"
    other = TableDescriptor("Sales", COLUMNS, TYPES, database="Shop")
    assert other.location_in("warehouse") == "warehouse/shop.db/sales"
    placed = TableDescriptor("t", COLUMNS, TYPES, location="file:/data/placed")
    assert placed.location_in("warehouse") == "file:/data/placed"
    with pytest.raises(FieldError):
        TableDescriptor("t", COLUMNS, TYPES, location="not/absolute")


def test_equality_ignores_case():
    one = TableDescriptor("sales", COLUMNS, TYPES)
    two = TableDescriptor("SALES", ("ID", "label", "active"), TYPES)
    three = TableDescriptor("Sales", ("id", "active", "label"), ("int", "BOOLEAN", "string"))
    assert one == two and one != three
    assert len({one, two, three}) == 2
    assert one != TableDescriptor("sales", COLUMNS, TYPES, transactional=True)
    assert "sales" in repr(one)


def test_transactional_flag():
    assert TableDescriptor("t", COLUMNS, TYPES, transactional=True).transactional
    assert not TableDescriptor("t", COLUMNS, TYPES).transactional


@pytest.mark.parametrize("storage", ["orc", "text", "parquet"])
def test_look_up_in_catalog(spark, database, storage):
    made = TableDescriptor(
        "t", ("id", "v", "region"), ("int", "varchar(10)", "string"), ("region",), database, storage=storage
    )
    create_table(spark, made)
    found = describe_table(spark, f"{database}.t")
    assert found.names == ("id", "v", "region")
    assert found.types == ("int", "varchar(10)", "string")
    assert found.partition_names == ["region"]
    assert (found.storage, found.delimiter) == (storage, made.delimiter)
    assert found.location.endswith("/t")
    assert not found.transactional


def test_look_up_bucket_count_and_flag(spark, database):
    spark.sql(
        f"CREATE TABLE {database}.b (id int) USING orc CLUSTERED BY (id) INTO 3 BUCKETS "
        "TBLPROPERTIES ('transactional' = 'TRUE')"
    )
    found = describe_table(spark, f"{database}.b")
    assert (found.buckets, found.transactional) == (3, True)


def test_look_up_of_missing_table(spark, database):
    with pytest.raises(TableJobError, match="not found"):
        describe_table(spark, f"{database}.nothing")


def test_storage_from_catalog_description():
    assert _storage({"provider": "orc"}) == "orc"
    assert _storage({}) == "view"
    sequence = {"provider": "hive", "input_format": "org.apache.hadoop.mapred.SequenceFileInputFormat"}
    assert _storage(sequence) == "sequencefile"
    text = {"provider": "hive", "input_format": "org.apache.hadoop.mapred.TextInputFormat"}
    assert _storage(text) == "textfile"
