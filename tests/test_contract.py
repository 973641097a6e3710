import pytest

import tablejobs as tj
from tablejobs.errors import FieldError

TABLE = tj.TableDescriptor("t", ("id", "price", "day", "k"), ("int", "decimal(5,2)", "date", "string"), ("k",))


def test_report(spark):
    df = spark.createDataFrame(
        [
            ("1", "1.50", "2024-02-29", "x"),
            ("one", "9999999", "2023-02-29", None),
            (None, None, None, None),
            ("3000000000", "2", "not a day", "y"),
        ],
        "id string, price string, day string, K string",
    )
    report = [tuple(row) for row in tj.check_contract(df, TABLE).orderBy("position").collect()]
    assert report == [
        (0, "id", "int", 2, 0),
        (1, "price", "decimal(5,2)", 1, 0),
        (2, "day", "date", 2, 0),
        (3, "k", "string", 0, 2),
    ]


def test_missing_column(spark):
    with pytest.raises(FieldError, match="price"):
        tj.check_contract(spark.createDataFrame([], "id string, day string, k string"), TABLE)


def test_rows_of_the_declared_types_are_fine(spark):
    df = spark.createDataFrame([], TABLE.schema)
    report = tj.check_contract(df, TABLE).collect()
    assert [(row.bad_values, row.null_keys) for row in report] == [(0, 0)] * 4
