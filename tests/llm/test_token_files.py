"""Token files: codes, images, texts to ids, and whole round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, SMALL, empty, odd, small, texts  # noqa: F401

from tablejobs.llm import packing, token_files
from tablejobs.llm.queries import QUERIES
from tablejobs.llm.token_files import BLOCK, ByteEncoder, Code, code_lengths
from tablejobs.llm.word_ids import Usual, WordCache
from tablejobs.storage import shared_folder


def vocabulary(name="byte_bpe_50k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


@pytest.fixture(scope="module")
def encode():
    return ByteEncoder(vocabulary())


def library(encode, text):
    return np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def cost_without_limit(counts):
    """Bits of a Huffman code, by merging the two smallest counts."""
    left, total = sorted(counts), 0
    while len(left) > 1:
        pair = left[0] + left[1]
        total += pair
        left = sorted([*left[2:], pair])
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**9), min_size=2, max_size=40), st.integers(6, 12))
def test_lengths_are_those_of_a_short_code(counts, limit):
    lengths = code_lengths(np.array(counts), limit)
    assert 1 <= lengths.min() and lengths.max() <= limit
    assert sum(2.0 ** -int(n) for n in lengths) == 1
    cost = int((lengths * np.array(counts)).sum())
    free = code_lengths(np.array(counts), 40)
    assert int((free * np.array(counts)).sum()) == cost_without_limit(counts) <= cost
    if free.max() <= limit:
        assert cost == cost_without_limit(counts)


def test_too_many_symbols_for_a_limit():
    with pytest.raises(ValueError):
        code_lengths(np.ones(9, np.int64), 3)


@pytest.mark.parametrize("count", [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 7])
def test_images_and_parts_of_them(count):
    rng = np.random.default_rng(count)
    counts = rng.zipf(1.2, 3000).clip(1, 10**9)
    code = Code(np.arange(3000) * 7, code_lengths(counts, 14))
    ids = rng.choice(3000, count, p=counts / counts.sum()) * 7
    image = code.image(ids)
    assert (code.ids(image) == ids).all()
    for _ in range(20 if count else 0):
        first = int(rng.integers(0, count))
        size = int(rng.integers(0, count - first + 1))
        assert (code.ids(image, first, size) == ids[first : first + size]).all()
    with pytest.raises(ValueError):
        code.ids(b"XXXX" + image[4:])


def test_ids_are_those_of_the_library(encode, texts):
    found = encode(list(texts.values()))
    assert [bytes(ids) for ids in found] == [library(encode, text) for text in texts.values()]
    random.seed(3)
    parts = [*"ab  \n\t'sé.,1 ٣ <|endoftext|>\x1c漢\x85\xa0ª½ÿɏɐ", "<|endoftext|>", " 's", "\r\n", "foo", "'ll", " the"]
    made = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(20_000)]
    assert encode(made) == [library(encode, text) for text in made]


def test_words_are_forgotten_and_learned_again(encode, monkeypatch):
    from tablejobs.llm import word_ids

    monkeypatch.setattr(word_ids, "REMEMBERED", 50)
    made = [f"a{'b' * (i % 40)} c{'d' * (i % 7)}.\nE{i % 90}" for i in range(400)]
    for text in made:
        assert encode([text]) == [library(encode, text)]


def test_other_vocabularies_are_encoded_whole():
    whole = ByteEncoder(vocabulary("word_bpe_49k.json"))
    assert whole.by_word is False and whole(["Two words", ""]) == [library(whole, "Two words"), b""]


def plain(encode, rows, end=0):
    """Files by hand: rows ordered by id (null first), check sum and size; start, size and check sum of each."""
    made = []
    for key, text in rows:
        ids = library(encode, text or "") + np.array([end], "<u4").tobytes()
        made.append((key is not None, key or 0, zlib.crc32(ids), len(ids) // 4))
    out, start = [], 0
    for known, key, check, size in sorted(made):
        out.append((key if known else None, start, size, check))
        start += size
    return out


def test_query_against_the_library(spark, encode, texts):
    rows = [tuple(r) for r in QUERIES["op13_token_files"](spark, SMALL).collect()]
    assert sorted(rows) == plain(encode, texts.items())


def test_odd_rows_and_parts_of_the_sequence(spark, odd, encode, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 2000)
    root = shared_folder(spark, "odd_files")
    token_files.write_token_files(odd, vocabulary(), root)
    back = token_files.read_token_files(spark, root).collect()
    expected = plain(encode, [(row[0], row[1]) for row in ODD])
    assert sorted([(r.start, r.id, r.n_tokens, r.ids_crc32) for r in back], key=repr) == sorted(
        [(start, key, size, check) for key, start, size, check in expected], key=repr
    )
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in back)
    whole = np.frombuffer(b"".join(bytes(r.ids) for r in sorted(back, key=lambda r: r.start)), "<u4")
    for first, count in ((0, 1), (5, 4000), (len(whole) - 3, 3), (0, len(whole))):
        assert (token_files.token_range(spark, root, first, count) == whole[first : first + count]).all()


def test_an_empty_table_gives_empty_files(spark, empty):
    root = shared_folder(spark, "no_files")
    token_files.write_token_files(empty, vocabulary(), root)
    back = token_files.read_token_files(spark, root)
    assert back.collect() == [] and "ids" in back.columns


def test_a_hot_id_is_spread_over_parts(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 500)
    rows = [(1, f"text {i % 5}") for i in range(2000)] + [(i, "other") for i in range(2, 500)]
    root = shared_folder(spark, "hot_files")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary(), root)
    parts = spark.read.parquet(f"{root}/segments").groupBy("part").sum("n_ids").collect()
    assert len(parts) == 8 and max(r[1] for r in parts) <= 0.3 * sum(r[1] for r in parts)
    back = sorted((r.start, r.id) for r in token_files.read_token_files(spark, root, with_ids=False).collect())
    assert [key for _, key in back] == sorted(key for key, _ in rows)


def test_usual_words_and_marks_go_straight_to_the_merges():
    import public_tokenizers

    chance = random.Random(3)
    pieces = [
        "aB", "\xe9", "\xc9", "\u0131", "\xdf", ".", ",", "'s", "'", "***", "<<", "<|endoftext|>", "</w>", "12", "\xbd", "\n", "\t", "\x85",
        "\xa0", "\u6f22", "\u0301", "_", "^", "[", "]", "\\", "\xd7", "don't", " ", " ", "  ",
    ]
    odd = ["".join(chance.choices(pieces, k=chance.randint(0, 12))) for _ in range(1500)]
    usual = "Some w\xf6rds, of (all) sorts### and $$$ more*** (again) words!! \xc9t\xe9\u2026 end."
    for encode in (
        packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json")),
        token_files.ByteEncoder(public_tokenizers.path("byte_bpe_50k.json")),
    ):
        whole = [np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in [*odd, usual]]
        assert encode([*odd, usual]) == whole
        *_, others = encode.usual(usual.split(" "))
        assert [usual.split(" ")[i] for i in others] == ["(all)", "$$$", "(again)", "\xc9t\xe9\u2026"]
        # A literal end of a word is not taken for the suffix that stands for it.
        for run in ("a</w>b", "</w>", "x</w></w>"):
            ids, ends = encode.runs._merged([run, "abc", run])
            made = encode.runs.tokenizer.encode(f"{run} abc {run}", add_special_tokens=False)
            assert ids.tolist() == made.ids
            assert ends.tolist() == np.cumsum(np.bincount(made.word_ids)).tolist()
        assert Usual("a-z", ["abc"])(["abc", "x"]) == ([], pa.array([], pa.string()), [], [0, 1])


def test_older_words_are_not_all_gone_through():
    class Counted(dict):
        def __iter__(self):
            raise AssertionError("goes through all words")

    words = WordCache(lambda new: [word.encode() for word in new])
    words.older = Counted({"old": b"1", "other": b"2"})
    assert words.look_up(["old", "new"]) == [b"1", b"new"]
    assert words.known == {"old": b"1", "new": b"new"} and words.chars == 6
