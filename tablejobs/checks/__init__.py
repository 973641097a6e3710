"""One check query per operator, each with the SQL that gives the same rows."""

from tablejobs.checks import functions, joins, reads, snapshots, statements, writes

CHECKS = {**reads.QUERIES, **snapshots.QUERIES, **writes.QUERIES, **statements.QUERIES, **joins.QUERIES, **functions.QUERIES}
