"""The queries of this package: SQL where there is any, else brute force or accuracy on held-out rows."""

import zlib

import pytest
from llm_cases import SMALL, small, texts  # noqa: F401

import __spark_entry__ as entry_points
import corpus_pipeline
from tablejobs.llm.queries import ORACLE_SQL, QUERIES
from tablejobs.llm.simhash import fingerprint

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    found = entry_points.queries()
    assert QUERIES.keys() | {"pipeline"} <= found.keys()
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert ORACLE_SQL.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_against_sql(spark, small, name):
    df = QUERIES[name](spark, SMALL)
    answer = small.execute(ORACLE_SQL[name])
    columns = [column[0] for column in answer.description]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, answer.fetchall()))


def test_op4_against_all_pairs(spark, texts):
    bits = {key: fingerprint(text) for key, text in texts.items()}
    root = {key: key for key in bits}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for a in bits:
        for b in bits:
            if a < b and (bits[a] ^ bits[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    expected = {key: (f"{bits[key]:016x}", find(key)) for key in bits}
    found = QUERIES["op4_simhash"](spark, SMALL).collect()
    assert {row.doc_id: (row.fingerprint, row.component_id) for row in found} == expected
    assert len(found) == len(expected)


def test_op5_keeps_every_token(spark, texts):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for key, text in texts.items():
        ids = [*whole.encode(text, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4").tobytes()
            expected[key, k // 4096] = (k, len(part) // 4, zlib.crc32(part))
    rows = QUERIES["op5_packing"](spark, SMALL).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 4096) + 2


def crc(key, folds):
    return zlib.crc32(str(key).encode()) % folds


def test_op1_held_out(spark):
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    caught = [p for p, label in held if label]
    clean = [p for p, label in held if not label]
    assert sum(caught) >= 0.75 * len(caught)
    assert sum(clean) <= 0.03 * len(clean)


def test_op6_held_out(spark):
    rows = QUERIES["op6_quality_ranking"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert sum(held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_op8_held_out(spark):
    rows = QUERIES["op8_language"](spark, SF).collect()
    own = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r.lang_pred == own[r.doc_id] for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows)
    assert len(rows) == len(own)
    assert sum(held) >= 0.98 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == columns, name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    left = {row.doc_id for row in docs.collect()}
    packed = corpus_pipeline.run(spark, SMALL)
    assert {row.doc_id for row in packed.collect()} == left
