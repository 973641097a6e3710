"""Passages inside longer lines, against a brute force that looks for shared windows of words."""

import os
import random

import pyarrow as pa
import pytest
from llm_cases import DOCUMENTS, ODD, SMALL, empty, odd, small, texts  # noqa: F401

from tablejobs.llm import line_dedup, passages
from tablejobs.llm.words import Words

WIDTH = 50


def windows(text):
    words = (text or "").split()
    return {tuple(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)}


def plain_cut(rows):
    """Per document the places of words that an earlier one has in a row of ``WIDTH`` at least."""
    first = {}
    for key, text in sorted(rows):
        for window in windows(text):
            first.setdefault(window, key)
    gone = {}
    for key, text in rows:
        words = (text or "").split()
        at = [i for i in range(len(words) - WIDTH + 1) if first[tuple(words[i : i + WIDTH])] != key]
        gone[key] = {i + j for i in at for j in range(WIDTH)}
    return gone


def made_rows(n=60):
    """Documents of one long line each, some with a passage of another at another place."""
    random.seed(5)
    some = lambda n: [f"w{random.randrange(10**6)}" for _ in range(n)]
    shared = [some(length) for length in (49, 50, 51, 64, 120)]
    rows = []
    for key in range(n):
        words = some(random.randrange(90))
        for _ in range(random.randrange(3)):
            words += random.choice(shared) + some(random.randrange(90))
        rows.append((key, " ".join(words)))
    return rows


def check(rows, found):
    gone = plain_cut(rows)
    assert any(gone.values())
    for row in found:
        words = (dict(rows)[row.id] or "").split()
        assert (row.text or "").split() == [w for i, w in enumerate(words) if i not in gone[row.id]]
        assert row.n_cut == len(gone[row.id])


@pytest.mark.parametrize("sent", [500_000, 0])
def test_passages_against_shared_windows(spark, monkeypatch, sent):
    monkeypatch.setattr(passages, "SENT", sent)
    rows = made_rows()
    found = passages.drop_passages(spark.createDataFrame(rows, "id long, text string"), "id").select("row.id", "text", "n_cut")
    check(rows, found.collect())


def test_no_shared_window_is_left(spark, texts):
    own = texts | {9000 + key: text for key, text in made_rows()}
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in own.items()], DOCUMENTS)
    before = [(r.id, r.text) for r in line_dedup.dedup_lines(docs, similar=True).collect()]
    rows = line_dedup.dedup_texts(docs).collect()
    assert len(rows) == len(own)
    check(before, rows)
    holders = {}
    for row in rows:
        for part in row.text.split("\n"):
            for window in windows(part):
                holders.setdefault(window, set()).add(row.id)
    assert all(len(ids) == 1 for ids in holders.values())


def test_cut_keeps_the_rest_as_it_is():
    words = [f"w{i}" for i in range(60)]
    assert passages.cut("  a  b " + " ".join(words[:50]) + "\n c\td ", [2]) == ("  a  b\nc\td ", 50)
    assert passages.cut(" ".join(words), [0, 10]) == ("", 60)


def test_passages_of_odd_rows(odd, empty):
    rows = passages.drop_passages(odd).collect()
    assert len(rows) == len(ODD) and all(row.n_cut == 0 for row in rows)
    assert sorted(repr(row.text) for row in rows) == sorted(repr(row[1]) for row in ODD)
    assert passages.drop_passages(empty).count() == 0
    assert line_dedup.dedup_texts(empty).count() == 0
    long = odd.unionByName(odd.selectExpr("doc_id + 10 as doc_id", *[c for c in odd.columns if c != "doc_id"]).where("doc_id = 14"))
    assert sorted(r.n_cut for r in passages.drop_passages(long).collect())[-2:] == [0, 80_000]


def test_every_template_stays_in_some_kept_document(spark, texts):
    shared = [f"this is the common line number x{i} of all the pages we have" for i in "abcdefgh"]
    own = texts | {
        9000: "\n".join(shared),
        9001: "\n".join([*shared, "only here we say this one thing"]),
        9002: "\n".join([*shared, "first here we say that other thing"]),
        9003: "first here we say that other thing",
    }
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in own.items()], DOCUMENTS)
    rows = line_dedup.dedup_lines(docs).collect()
    kept = {tuple(line_dedup.tokens_of(line)) for row in rows if row.kept for line in row.text.split("\n")}
    assert {row.id: row.kept for row in rows if row.id >= 9000} == {9000: True, 9001: True, 9002: True, 9003: False}
    # Lines of one template differ in tokens; those made here do not.
    assert all(tuple(line.split()) in kept for key in own if key >= 9000 for line in own[key].split("\n"))
    left = {line for row in rows if row.kept for line in row.text.split("\n")}
    assert all(line in left for row in rows for line in row.text.split("\n") if line.strip())


def linked_lines(rows):
    """Places of lines whose group of similar lines, joined one by one, has an earlier document."""
    lines = [(key, n, line_dedup.tokens_of(line)) for key, text in rows for n, line in enumerate(text.split("\n"))]
    lines = [line for line in lines if len(line[2]) >= line_dedup.LEAST_TOKENS]
    leaves = {}
    for line in lines:
        leaves.setdefault((len(line[2]), *line[2][: line_dedup.DEPTH]), []).append(line)
    dropped = set()
    for leaf in leaves.values():
        groups = []
        for line in leaf:
            near = [g for g in groups if any(sum(map(str.__eq__, line[2], o[2])) >= 0.8 * len(o[2]) for o in g)]
            groups = [g for g in groups if g not in near] + [[line, *(o for g in near for o in g)]]
        for group in groups:
            first = min(key for key, _, _ in group)
            dropped |= {(key, n) for key, n, _ in group if key != first}
    return dropped


def lost(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {(row.id, row.n_dropped) for row in line_dedup.dedup_lines(docs, similar=True).collect() if row.n_dropped}


def test_values_of_fields_may_recur(spark):
    line = "Our team contact is {} and works from {} today"
    rows = [(1, line.format("Alice", "Berlin")), (2, line.format("Bob", "Paris"))]
    more = [(3, line.format("Alice", "Paris")), (4, line.format("Bob", "Berlin"))]
    assert lost(spark, rows) == {(2, 1)}
    assert lost(spark, rows + more) == {(2, 1), (3, 1), (4, 1)}


def test_similar_lines_against_brute_force(spark, texts):
    random.seed(9)
    words = "red green blue black white".split()
    rows = list(texts.items())
    for key in range(9000, 9120):
        kind, n = random.choice("ABC"), random.choice([4, 5, 9, 10, 16])
        middle = [random.choice(words) if random.random() < 0.25 else f"of{i}" for i in "abcdefghijklmnop"[: n - 3]]
        rows.append((key, " ".join([kind, "is", "there", *middle])))
    before = set()
    for some in (rows[:-60], rows):
        dropped = linked_lines(some)
        assert before <= dropped
        before = dropped
        counts = {}
        for key, _ in dropped:
            counts[key] = counts.get(key, 0) + 1
        assert lost(spark, some) == set(counts.items())


def test_texts_are_not_written_again(spark):
    random.seed(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = [" ".join("".join(random.choices(letters, k=6)) for _ in range(30)) for _ in range(2000)]
    rows = [(k, "\n".join([*lines[4 * k : 4 * k + 4], lines[k % 7]])) for k in range(500)]
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:") + "/tablejobs"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = line_dedup.dedup_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(row.n_dropped for row in found) == 499
    new = set(os.listdir(folder)) - before
    files = [os.path.join(at, name) for one in new for at, _, names in os.walk(f"{folder}/{one}") for name in names]
    written = sum(os.path.getsize(path) for path in files)
    assert written < sum(len(text) for _, text in rows) / 2


def test_words_as_python_splits_them():
    random.seed(4)
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    parts = [*spaces, *"abé19\n\n", "€", "、", "Ā", "\x00", "⁠", "long" * 30, "\U0001d400"]
    texts = [None, "", *["".join(random.choices(parts, k=random.randrange(80))) for _ in range(400)], ""]
    words, known = Words(pa.array(texts)[1:]), {}
    for i, text in enumerate(texts[1:]):
        lines = text.split("\n")
        assert words.first[i + 1] - words.first[i] == len(lines)
        for k, line in enumerate(lines, words.first[i]):
            own = words.hashes[words.lines[k] : words.lines[k + 1]].tolist()
            assert [known.setdefault(word, value) for word, value in zip(line.split(), own, strict=True)] == own
    assert len(set(known.values())) == len(known)
    assert all(value & 1 == any("0" <= c <= "9" for c in word) for word, value in known.items())
