"""The near-duplicate stage against the Jaccard similarity of all pairs."""

import math
import random
import time

import numpy as np
from llm_cases import DOCUMENTS, ODD, empty, odd, small, texts  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tablejobs.llm import near_copies, packing


def plain_shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_first(rows):
    sets = {key: plain_shingles(text) for key, text in rows}
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key for key in root if root[key] == key}


def edited_rows():
    random.seed(8)
    rows = []
    for base in range(30):
        words = [f"v{random.randrange(400)}" for _ in range(random.choice([3, 6, 30, 120, 300]))]
        for copy in range(5):
            own = list(words)
            for _ in range(random.randrange(1 + len(own) // 30)):
                own[random.randrange(len(own))] = f"e{random.randrange(400)}"
            rows.append((10_000 + base * 10 + copy, " ".join(own)))
    return rows


def test_near_dedup_against_all_pairs(spark, texts, monkeypatch):
    rows = list(texts.items()) + edited_rows()
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENTS)
    expected = plain_first(rows)
    assert len(expected) < len(rows)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {row.doc_id for row in stage(spark, docs, "").collect()} == expected
    monkeypatch.setattr(near_copies, "SAMPLED", 1)
    assert {row.doc_id for row in stage(spark, docs, "").collect()} == expected


def test_fingerprints_give_candidates(spark, monkeypatch):
    """Copies with one word changed are linked by op4's search, and the stage verifies what it finds."""
    words = [f"w{i}" for i in range(400)]
    edited = [[*words[:at], f"x{at}", *words[at + 1 :]] for at in (50, 200, 350)]
    rows = [(k, " ".join(own)) for k, own in enumerate([words, *edited, [f"y{i}" for i in range(400)]])]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENTS)
    found = []

    def told(prints, nodes):
        pairs = alike(prints, nodes)
        found.extend(map(tuple, pairs.collect()))
        return pairs

    alike = near_copies.alike
    monkeypatch.setattr(near_copies, "alike", told)
    monkeypatch.setattr(near_copies, "MAX_BITS", 12)
    assert {row.doc_id for row in near_copies.first_of_each_group(docs).collect()} == plain_first(rows) == {0, 4}
    known = {near_copies._node(near_copies.shingles(t)): k for k, t in rows}
    linked = {key for pair in found for key in pair}
    assert {0, 1, 2, 3} <= {known[node] for node in linked}
    # All nodes under one fingerprint: links that are not similar enough are not followed.
    monkeypatch.setattr(near_copies.simhash, "fingerprint_of", lambda hashes: 7)
    assert {row.doc_id for row in near_copies.first_of_each_group(docs).collect()} == {0, 4}


def test_all_nodes_of_near_fingerprints_are_held_against_each_other(spark, monkeypatch):
    """Not only the first node of a fingerprint, and not only the links of a spanning forest."""
    rows = []
    for family in range(5):
        words = [f"f{family}w{i}" for i in range(200)]
        rows += [(10 * family + k, " ".join([*words[:at], f"x{at}", *words[at + 1 :]])) for k, at in enumerate((20, 90, 150))]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENTS)
    expected = plain_first(rows)
    assert expected == {0, 10, 20, 30, 40}
    nodes, candidates = near_copies._nodes, near_copies._candidates

    # Nothing but fingerprints gives candidates. They are all equal, or differ in two bits, or in eight.
    def one_print(mask):
        bits = f"shiftleft(1L, CAST(pmod(node, {mask}) AS INT))" if mask < 9 else "CASE WHEN pmod(node, 2) = 0 THEN 15L ELSE 960L END"
        return lambda texts: near_copies.materialize(nodes(texts).withColumn("fingerprint", F.expr(bits)), "nodes")

    monkeypatch.setattr(near_copies, "_candidates", lambda shared: candidates(shared).where("false"))
    for mask in (1, 6, 9):
        monkeypatch.setattr(near_copies, "_nodes", one_print(mask))
        stays = {row.doc_id for row in near_copies.first_of_each_group(docs).collect()}
        if mask < 9:
            assert stays == expected
        else:
            assert expected < stays  # eight bits apart: no candidates


def chained_rows():
    """Families whose neighbours are similar and whose ends are not, beside texts that share one long stretch."""
    random.seed(5)
    rows, stretch = [], [f"s{i}" for i in range(40)]
    for family in range(12):
        words = [f"f{family}w{i}" for i in range(200)]
        for step in range(8):
            rows.append((50_000 + 100 * family + (step * 3) % 8, " ".join(words)))
            at = random.randrange(180)
            words[at : at + 12] = [f"f{family}s{step}n{i}" for i in range(12)]
        rows.append((90_000 + family, " ".join([*stretch, *(f"o{family}w{i}" for i in range(random.choice([12, 30, 60])))])))
    return rows


def test_chains_and_common_stretches(spark, monkeypatch):
    rows = chained_rows()
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENTS)
    expected = plain_first(rows)
    assert {row.doc_id for row in near_copies.first_of_each_group(docs).collect()} == expected
    monkeypatch.setattr(near_copies, "SENT", 0)
    assert {row.doc_id for row in near_copies.first_of_each_group(docs).collect()} == expected


def test_odd_rows(odd, empty):
    """Repeated rows, null ids and null texts: one row a group, with the lowest id where there is one."""
    kept = near_copies.first_of_each_group(odd).collect()
    assert len(kept[0]) == len(odd.columns) and [row.id for row in kept] == ["clash"] * len(kept)
    # Texts without words (ids 2, 3, 3 and none) are one group, the repeated text (ids 1, 1 and none) another.
    assert sorted(row.doc_id for row in kept) == [1, 2, 4, 5, 6, 7]
    assert len(ODD) == odd.count()
    assert near_copies.first_of_each_group(odd.where("doc_id is null")).count() == 2
    assert near_copies.first_of_each_group(empty).count() == 0


def test_prefixes_do_not_sort_the_frequent_shingles_for_every_text():
    chance = np.random.default_rng(1)
    late = np.unique(chance.integers(-(2**63), 2**63 - 1, 50_000))
    sets = [np.unique(np.concatenate([chance.choice(late, 50), chance.integers(-(2**63), 2**63 - 1, 200)])) for _ in range(300)]
    began = time.process_time()
    found = [near_copies._prefix(own, late) for own in sets]
    assert time.process_time() - began < 1.0  # several seconds with all of them sorted each time
    for own, prefix in zip(sets[:20], found):
        is_late = np.isin(own, late)
        whole = np.concatenate([own[~is_late], own[is_late]])
        assert prefix.tolist() == whole[: len(own) - math.ceil(round(0.8 * len(own), 6)) + 1].tolist()
    assert near_copies._prefix(np.array([7]), late[:0]).tolist() == [7]
    assert near_copies._prefix(np.array([2**63 - 1]), np.array([1])).tolist() == [2**63 - 1]


def test_workers_keep_no_words_for_the_stages_after_packing():
    import public_tokenizers

    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encode(["some words *** of a text"])
    encode.rest()
    assert not encode.words.known and not encode.words.older and not encode.runs.known
