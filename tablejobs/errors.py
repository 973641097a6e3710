"""Errors raised by the library. All of them derive from ``TableJobError``."""


class TableJobError(Exception):
    pass


class FieldError(TableJobError, ValueError):
    """A field list does not fit a table: unknown, repeated or missing names."""


class PartitionFilterError(TableJobError, ValueError):
    """A partition predicate is not an expression over partition columns."""


class UnsafeValueError(TableJobError, ValueError):
    """A value cannot be stored without being changed."""


class TableMismatchError(TableJobError):
    """An existing table differs from its descriptor."""


class TableHasDataError(TableJobError):
    """A write that must not touch existing rows found some."""


class TransactionalTableError(TableJobError):
    """A transactional table was used where only plain tables are allowed."""


class SnapshotError(TableJobError):
    """The files of a transactional table cannot give the wanted snapshot."""


class SqlStepError(TableJobError):
    """A statement of a SQL step failed; the text of the statement is in the message."""

    def __init__(self, statement: str, cause: BaseException):
        super().__init__(f"statement failed: {statement}\n{cause}")
        self.statement = statement
