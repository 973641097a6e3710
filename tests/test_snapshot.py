"""Snapshot reads: the known cases, and random histories against a plain loop."""

import random
from dataclasses import replace

import pytest
from conftest import rows

import tablejobs as tj
from tablejobs.errors import FieldError, PartitionFilterError, SnapshotError, TransactionalTableError
from tablejobs.sinks.changes import PUBLIC_LAYOUT
from tablejobs.sources.snapshot import DELETE, INSERT, UPDATE, _choose, _Folder, change_schema
from tablejobs.storage import exists, glob, move, session_setting, shared_folder

PLAIN = tj.TableDescriptor("acid", ("id", "msg"), ("int", "string"), transactional=True)
PARTITIONED = tj.TableDescriptor(
    "acid", ("id", "msg", "continent", "country"), ("int", "string", "string", "string"),
    ("continent", "country"), transactional=True,
)
# Rows and row ids of the known cases are those every reader of such a table must give.
ASIA = ("Asia", "India")


def events(spark, table, data):
    """``data``: (op, (orig_txn, bucket, row_id), txn, row or None, *partition values)."""
    keys = "".join(f", {name} string" for name in table.partition_names)
    row_type = table.data_schema.simpleString()
    ddl = f"op int, orig_txn bigint, bucket int, row_id bigint, txn bigint, data {row_type}"
    return spark.createDataFrame([(op, *key, txn, row, *part) for op, key, txn, row, *part in data], ddl + keys)


def base_with_delta(spark, table, part=()):
    root = shared_folder(spark, "acid")
    tj.write_base(
        events(spark, table, [
            (INSERT, (1, 0, 0), 1, (1, "Welcome"), *part),
            (INSERT, (1, 0, 1), 1, (2, "Streaming to welcome"), *part),
        ]), table, root, 5,
    )
    tj.write_delta(
        events(spark, table, [(UPDATE, (1, 0, 1), 6, (2, "UPDATED: Streaming to welcome"), *part),
                              (DELETE, (1, 0, 0), 6, None, *part)]), table, root, 6)
    tj.write_delta(events(spark, table, [(INSERT, (7, 0, 0), 7, (3, "Testing Insert"), *part)]), table, root, 7)
    return root


@pytest.mark.parametrize("table, part", [(PLAIN, ()), (PARTITIONED, ASIA)])
def test_base_with_delta(spark, table, part):
    root = base_with_delta(spark, table, part)
    got = tj.snapshot_read(spark, table, root, tj.Snapshot.parse("7:"), row_id=True)
    assert got.columns == ["orig_txn", "bucket", "row_id", *table.schema.names]
    assert rows(got) == [
        (1, 0, 1, 2, "UPDATED: Streaming to welcome", *part), (7, 0, 0, 3, "Testing Insert", *part)
    ]
    before = tj.snapshot_read(spark, table, root, tj.Snapshot(5))
    assert rows(before) == [(1, "Welcome", *part), (2, "Streaming to welcome", *part)]


@pytest.mark.parametrize("table, part", [(PLAIN, ()), (PARTITIONED, ASIA)])
def test_delta_only(spark, table, part):
    root = shared_folder(spark, "acid")
    data = [(INSERT, (60, 0, i), 60, (3 - i, "zyx"[i]), *part) for i in range(3)]
    tj.write_delta(events(spark, table, data), table, root, 60)
    got = tj.snapshot_read(spark, table, root, tj.Snapshot.parse("60:"), row_id=True)
    assert rows(got) == [(60, 0, i, 3 - i, "zyx"[i], *part) for i in range(3)]


def test_insert_delete_update(spark):
    root = shared_folder(spark, "acid")
    data = [(INSERT, (67, 0, i), 67, (3 - i, "zyx"[i]), *ASIA) for i in range(3)]
    tj.write_delta(events(spark, PARTITIONED, data), PARTITIONED, root, 67)
    tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(67), 68, delete_where="id = 2")
    tj.apply_changes(
        spark, PARTITIONED, root, tj.Snapshot(68), 69, assign={"msg": "'updated'"}, update_where="id = 1"
    )
    got = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(69), row_id=True)
    assert rows(got) == [(67, 0, 0, 3, "z", *ASIA), (67, 0, 2, 1, "updated", *ASIA)]
    still = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(68), columns=["msg"])
    assert rows(still) == [("x",), ("z",)]


def test_open_transaction_inside_the_range(spark):
    root = base_with_delta(spark, PLAIN)
    got = tj.snapshot_read(spark, PLAIN, root, tj.Snapshot(7, {6}))
    assert rows(got) == [(1, "Welcome"), (2, "Streaming to welcome"), (3, "Testing Insert")]


def test_same_row_id_in_two_partitions_and_null_partition(spark):
    root = shared_folder(spark, "acid")
    places = [ASIA, ("Asia", None), ("Europe", "India")]
    tj.write_base(
        events(spark, PARTITIONED, [(INSERT, (1, 0, 0), 1, (1, "a"), *p) for p in places]), PARTITIONED, root, 1
    )
    tj.write_delta(
        events(spark, PARTITIONED, [(DELETE, (1, 0, 0), 2, None, "Asia", None)]), PARTITIONED, root, 2
    )
    for limit in ("-1", "10m"):
        with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit):
            got = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2))
            assert rows(got) == [(1, "a", "Asia", "India"), (1, "a", "Europe", "India")]
    only = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2), predicate="continent = 'Europe'")
    assert rows(only) == [(1, "a", "Europe", "India")]
    keys = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2), columns=["continent"])
    assert rows(keys) == [("Asia",), ("Europe",)]


def test_columns_named_like_those_of_an_event(spark):
    names = ("op", "bucket", "txn", "data", "event", "row_id", "region")
    table = tj.TableDescriptor("log", names, ("string",) * 7, ("region",), transactional=True)
    root = shared_folder(spark, "acid")
    data = [("GET", "b1", "t", "d", "e", "1", "EU"), ("PUT", "b2", "t", "d", "e", "2", "US")]
    df = spark.createDataFrame(data, list(names))
    tj.write_base(tj.insert_events(df, table, 1, "row_id", "0"), table, root, 1)
    tj.apply_changes(
        spark, table, root, tj.Snapshot(1), 2, assign={"data": "concat(op, bucket)"}, update_where="bucket = 'b2'"
    )
    assert rows(tj.snapshot_read(spark, table, root, tj.Snapshot(2))) == [
        ("GET", "b1", "t", "d", "e", "1", "EU"), ("PUT", "b2", "t", "PUTb2", "e", "2", "US")
    ]
    got = tj.snapshot_read(spark, table, root, tj.Snapshot(2), row_id=True, columns=["OP", "data"])
    assert rows(got) == [(1, 0, 1, "GET", "d"), (1, 0, 2, "PUT", "PUTb2")]
    with pytest.raises(FieldError):
        tj.snapshot_read(spark, table, root, tj.Snapshot(2), row_id=True)
    with pytest.raises(FieldError):
        change_schema(tj.TableDescriptor("log", names, ("string",) * 7, ("bucket",)))


def test_adopting_files_of_the_public_layout(spark):
    """Partition values with characters that paths cannot hold, and a null one."""
    places = [("Asia", "50% a+b/c=d"), ("Asia", None), ("Süd Ost", "India")]
    foreign, root = shared_folder(spark, "foreign"), shared_folder(spark, "acid")
    staged = shared_folder(spark, "staged")
    made = events(
        spark, PARTITIONED, [(INSERT, (1, 0, i), 1, (i, f"row {i}"), *p) for i in range(2) for p in places]
    )
    gone = events(spark, PARTITIONED, [(DELETE, (1, 0, 0), 2, None, *p) for p in places[1:]])
    for name, df in (("base_0000001", made), ("delta_0000002_0000002", gone)):
        public = df.toDF(*PUBLIC_LAYOUT, *PARTITIONED.partition_names)
        public.write.partitionBy(*PARTITIONED.partition_names).orc(f"{staged}/{name}")
        for folder in glob(spark, f"{staged}/{name}/*/*"):
            move(spark, folder, f"{foreign}/{'/'.join(folder.split('/')[-2:])}/{name}")
    tj.adopt_files(spark, PARTITIONED, foreign, root)
    got = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2))
    assert rows(got) == sorted([(0, "row 0", *places[0]), *[(1, "row 1", *p) for p in places]], key=repr)
    assert len(rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(1)))) == 6
    for predicate, place in (
        ("country LIKE '50% a+b/c=_'", places[0]), ("country IS NULL", places[1]), ("continent = 'Süd Ost'", places[2])
    ):
        one = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(1), predicate=predicate)
        assert rows(one) == [(i, f"row {i}", *place) for i in range(2)]
        assert len(one.inputFiles()) <= 2
    with pytest.raises(PartitionFilterError):
        tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(1), predicate="id = 1")
    with pytest.warns(UserWarning, match="ignored"):
        plain = base_with_delta(spark, PLAIN)
        assert len(rows(tj.snapshot_read(spark, PLAIN, plain, tj.Snapshot(5), predicate="id = 1"))) == 2


def test_empty_folder_gives_no_rows(spark):
    assert rows(tj.snapshot_read(spark, PLAIN, shared_folder(spark, "acid"), tj.Snapshot(3))) == []


def test_snapshot_text():
    assert tj.Snapshot.parse("7:") == tj.Snapshot(7)
    assert tj.Snapshot.parse("9:3:5") == tj.Snapshot(9, {3, 5})


def folders(*names):
    made = []
    for name in names:
        kind, *numbers = name.split("_")
        made.append(_Folder(name, kind, int(numbers[0]), int(numbers[-1])))
    return made


@pytest.mark.parametrize(
    "names, snapshot, base, deltas",
    [
        (["base_5", "base_8", "delta_6_6", "delta_9_9"], tj.Snapshot(9), "base_8", ["delta_9_9"]),
        (["base_5", "base_8", "delta_6_6", "delta_9_9"], tj.Snapshot(7), "base_5", ["delta_6_6"]),
        (["base_5", "base_8", "delta_6_8"], tj.Snapshot(8, {7}), "base_5", ["delta_6_8"]),
        (["base_5", "delta_1_3", "delta_4_7"], tj.Snapshot(9), "base_5", ["delta_4_7"]),
        (["base_5", "delta_1_3", "delta_4_5"], tj.Snapshot(3), None, ["delta_1_3"]),
        (["base_5", "delta_1_3", "delta_4_5"], tj.Snapshot(5, {4}), None, ["delta_1_3", "delta_4_5"]),
        (["delta_60_60"], tj.Snapshot(60), None, ["delta_60_60"]),
    ],
)
def test_choice_of_folders(names, snapshot, base, deltas):
    choice = _choose("t", folders(*names), snapshot)
    assert (choice.base and choice.base.path) == base
    assert [d.path for d in choice.deltas] == deltas


@pytest.mark.parametrize(
    "names, snapshot",
    [(["base_5"], tj.Snapshot(4)), (["base_5", "delta_3_5"], tj.Snapshot(4)),
     (["base_5", "delta_1_2", "delta_4_5"], tj.Snapshot(5, {2}))],
)
def test_no_base_fits(names, snapshot):
    with pytest.raises(SnapshotError):
        _choose("t", folders(*names), snapshot)


def test_one_event_per_row_and_transaction(spark):
    root = shared_folder(spark, "acid")
    twice = [(INSERT, (1, 0, 0), 1, (1, "a")), (UPDATE, (1, 0, 0), 1, (1, "b"))]
    with pytest.raises(SnapshotError, match="twice"):
        tj.write_delta(events(spark, PLAIN, twice), PLAIN, root, 1)
    assert glob(spark, f"{root}/*") == []


def test_transactions_must_be_in_the_range(spark):
    root = shared_folder(spark, "acid")
    with pytest.raises(SnapshotError, match="transactions"):
        tj.write_delta(events(spark, PLAIN, [(INSERT, (1, 0, 0), 1, (1, "a"))]), PLAIN, root, 2)
    assert not exists(spark, f"{root}/delta_0000002_0000002")


@pytest.mark.parametrize("key, part", [((None, 0, 0), ASIA), ((1, 0, None), ASIA), ((1, 0, 0), ("", "India"))])
def test_incomplete_events_are_refused(spark, key, part):
    root = shared_folder(spark, "acid")
    with pytest.raises(Exception, match="without|empty string"):
        tj.write_delta(events(spark, PARTITIONED, [(INSERT, key, 1, (1, "a"), *part)]), PARTITIONED, root, 1)
    assert not glob(spark, f"{root}/*=*")


def test_folder_is_never_written_twice(spark):
    root = base_with_delta(spark, PLAIN)
    with pytest.raises(SnapshotError, match="already"):
        tj.apply_changes(spark, PLAIN, root, tj.Snapshot(6), 7, delete_where="true")


def test_changes_are_checked(spark):
    root = base_with_delta(spark, PARTITIONED, ASIA)
    with pytest.raises(SnapshotError, match="not newer"):
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(7), 7, delete_where="true")
    with pytest.raises(FieldError):
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(7), 8)
    with pytest.raises(FieldError):
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(7), 8, assign={"country": "'x'"})


def test_plain_scan_of_a_transactional_table_is_refused(spark, database):
    spark.sql(f"CREATE TABLE {database}.a (id int) USING orc TBLPROPERTIES ('transactional'='true')")
    with pytest.raises(TransactionalTableError):
        tj.scan_table(spark, f"{database}.a")


def expected_rows(history, snapshot):
    """Newest accepted event per row, deletes left out."""
    newest = {}
    for op, key, txn, row, *part in history:
        if txn <= snapshot.high_mark and txn not in snapshot.open_txns:
            place = (*part, *key)
            if place not in newest or newest[place][0] < txn:
                newest[place] = (txn, op, row, part)
    return sorted(
        ((*place[len(part):], *row, *part) for place, (_, op, row, part) in newest.items() if op != DELETE),
        key=repr,
    )


@pytest.mark.parametrize("seed, buckets", [(0, 0), (1, 0), (2, 0), (3, 0), (4, 3), (5, 3)])
def test_random_histories(spark, seed, buckets):
    chance = random.Random(seed)
    table = replace(PARTITIONED if seed % 2 else PLAIN, buckets=buckets)
    parts = [ASIA, ("Asia", None), ("Europe", "Norway")] if seed % 2 else [()]
    root = shared_folder(spark, "acid")
    last = 12
    history, alive = [], {}
    for txn in range(1, last + 1):
        for part in chance.sample(parts, chance.randint(1, len(parts))):
            for number in range(chance.randint(0, 4)):
                key = (txn, chance.randint(0, 1), number)
                history.append((INSERT, key, txn, (txn, f"new {txn}"), *part))
                alive[(part, key)] = True
            for place in chance.sample(sorted(alive, key=repr), min(3, len(alive))):
                if place[0] == part and place[1][0] < txn:
                    op = chance.choice((UPDATE, DELETE))
                    row = (txn, f"changed {txn}") if op == UPDATE else None
                    history.append((op, place[1], txn, row, *part))
                    if op == DELETE:
                        del alive[place]
    # Deltas of one or more transactions each, in an order of their own.
    low = 1
    while low <= last:
        high = min(last, low + chance.choice((0, 0, 1, 3)))
        inside = [e for e in history if low <= e[2] <= high]
        tj.write_delta(events(spark, table, inside), table, root, low, high, check=False)
        low = high + 1
    compacted = chance.randint(3, 9)
    folded = [
        (INSERT, row[:3], max(e[2] for e in history if e[1] == row[:3] and tuple(e[4:]) == row[5:]
                              and e[2] <= compacted), row[3:5], *row[5:])
        for row in expected_rows(history, tj.Snapshot(compacted))
    ]
    tj.write_base(events(spark, table, folded), table, root, compacted)
    for snapshot in (
        tj.Snapshot(last), tj.Snapshot(compacted), tj.Snapshot(compacted - 1),
        tj.Snapshot(last, {compacted + 1, last - 1}), tj.Snapshot(last, {2}),
    ):
        for limit in ("-1", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            try:
                got = tj.snapshot_read(spark, table, root, snapshot, row_id=True)
            except SnapshotError:
                # A partition without events in some transaction has a gap between its deltas, so
                # without a base nothing proves that they are all there.
                assert table.partitioned and not snapshot.accepts_base(compacted)
                continue
            assert rows(got) == expected_rows(history, snapshot), (seed, snapshot)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stale_changes_are_refused(spark):
    root = shared_folder(spark, "acid")
    tj.write_base(events(spark, PLAIN, [(INSERT, (1, 0, i), 1, (i, "a")) for i in range(4)]), PLAIN, root, 1)
    tj.apply_changes(spark, PLAIN, root, tj.Snapshot(1), 2, assign={"msg": "'b'"}, update_where="id < 2")
    with pytest.raises(SnapshotError, match="outside the snapshot"):
        tj.apply_changes(spark, PLAIN, root, tj.Snapshot(1), 3, assign={"msg": "'c'"}, update_where="id = 1")
    tj.apply_changes(spark, PLAIN, root, tj.Snapshot(1), 3, assign={"msg": "'c'"}, update_where="id = 3")
    assert rows(tj.snapshot_read(spark, PLAIN, root, tj.Snapshot(3))) == [(0, "b"), (1, "b"), (2, "a"), (3, "c")]


def test_broken_publication_is_invisible_and_can_be_run_again(spark, monkeypatch):
    from tablejobs.sinks import changes

    root = shared_folder(spark, "acid")
    places = [ASIA, ("Europe", "Spain"), ("Europe", "India")]
    tj.write_base(
        events(spark, PARTITIONED, [(INSERT, (1, 0, 0), 1, (1, "a"), *p) for p in places]), PARTITIONED, root, 1
    )
    before = rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2)))
    moves, move = [], changes.move

    def failing(spark, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise OSError("lost")
        move(spark, source, target)

    def change():
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(1), 2, assign={"msg": "'new'"})

    monkeypatch.setattr(changes, "move", failing)
    with pytest.raises(OSError):
        change()
    assert rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2))) == before
    monkeypatch.setattr(changes, "move", move)
    change()
    assert {row[1] for row in rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2)))} == {"new"}


def change_between(spark, monkeypatch, root, step):
    """Run ``step`` in the middle of an update of several partitions, after its first folder is in place."""
    from tablejobs.sinks import changes

    moves, move = [], changes.move

    def halting(spark, source, target):
        move(spark, source, target)
        moves.append(target)
        if len(moves) == 1:
            step()

    monkeypatch.setattr(changes, "MOVES", 1)
    monkeypatch.setattr(changes, "move", halting)
    try:
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(1), 2, assign={"msg": "'new'"})
    finally:
        monkeypatch.setattr(changes, "move", move)


def places_base(spark):
    root = shared_folder(spark, "acid")
    places = [ASIA, ("Europe", "Spain"), ("Europe", "India")]
    tj.write_base(
        events(spark, PARTITIONED, [(INSERT, (1, 0, 0), 1, (1, "a"), *p) for p in places]), PARTITIONED, root, 1
    )
    return root


def test_readers_see_all_of_a_change_or_nothing(spark, monkeypatch):
    from tablejobs.sources import snapshot

    root, seen = places_base(spark), []
    read = lambda: {row[1] for row in rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2)))}
    change_between(spark, monkeypatch, root, lambda: seen.append(read()))
    assert seen == [{"a"}] and read() == {"new"}
    # A reader that has read the records before the commit, and lists folders after it.
    other, listed = places_base(spark), snapshot.glob
    old = snapshot.read_commits(spark, other)
    tj.apply_changes(spark, PARTITIONED, other, tj.Snapshot(1), 2, assign={"msg": "'new'"})
    monkeypatch.setattr(snapshot, "read_commits", lambda spark, root: old)
    assert {row[1] for row in rows(tj.snapshot_read(spark, PARTITIONED, other, tj.Snapshot(2)))} == {"a"}
    assert listed


def test_the_first_commit_of_a_table_is_seen_as_a_whole(spark, monkeypatch):
    from tablejobs.sinks import changes
    from tablejobs.sources import snapshot

    root, seen, move = shared_folder(spark, "acid"), [], changes.move

    def halting(spark, source, target):
        move(spark, source, target)
        seen.append(rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(1))))

    monkeypatch.setattr(changes, "MOVES", 1)
    monkeypatch.setattr(changes, "move", halting)
    data = [(INSERT, (1, 0, 0), 1, (1, "a"), *p) for p in (ASIA, ("Europe", "Spain"))]
    tj.write_base(events(spark, PARTITIONED, data), PARTITIONED, root, 1)
    assert seen == [[], []] and len(rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(1)))) == 2
    # A reader that finds no records, then folders, then records, begins again.
    answers = [None, snapshot.read_commits(spark, root)]
    monkeypatch.setattr(snapshot, "read_commits", lambda spark, root: answers.pop(0))
    assert len(rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(1)))) == 2 and not answers


def test_of_two_writers_of_a_transaction_one_wins(spark, monkeypatch):
    root = places_base(spark)

    def other():
        monkeypatch.undo()
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(1), 2, assign={"msg": "'other'"})

    with pytest.raises(SnapshotError, match="another writer"):
        change_between(spark, monkeypatch, root, other)
    assert [row[1] for row in rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2)))] == ["other"] * 3
    assert len(glob(spark, f"{root}/*=*/*=*/delta_*")) == 3  # the loser's folders are gone


def test_what_broken_writers_left_can_be_removed(spark, monkeypatch):
    from tablejobs.storage import create_file

    root = places_base(spark)
    with pytest.raises(ZeroDivisionError):
        change_between(spark, monkeypatch, root, lambda: 1 / 0)
    assert create_file(spark, f"{root}/_commits/delta_0000002_0000002", "")
    with pytest.raises(SnapshotError, match="another writer"):
        tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(1), 2, assign={"msg": "'b'"})
    left = tj.remove_uncommitted(spark, PARTITIONED, root)
    assert len(left) >= 3 and tj.remove_uncommitted(spark, PARTITIONED, root) == []
    tj.apply_changes(spark, PARTITIONED, root, tj.Snapshot(1), 2, assign={"msg": "'c'"})
    assert {row[1] for row in rows(tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(2)))} == {"c"}


def test_scans_do_not_follow_partitions_and_no_job_runs(spark):
    root = shared_folder(spark, "acid")
    for place in range(5):
        at = (f"c{place}", "x")
        tj.write_base(
            events(spark, PARTITIONED, [(INSERT, (1, 0, 0), 1, (1, "a"), *at)]), PARTITIONED, root, 1 + place
        )
    tj.write_delta(
        events(spark, PARTITIONED, [(UPDATE, (1, 0, 0), 6, (1, "b"), f"c{p}", "x") for p in range(5)]),
        PARTITIONED, root, 2, 6,
    )
    spark.sparkContext.setJobGroup("building", "")
    got = tj.snapshot_read(spark, PARTITIONED, root, tj.Snapshot(6))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(got) == [(1, "b", f"c{p}", "x") for p in range(5)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 5
