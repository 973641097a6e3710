"""Token ids of texts put together from the ids of their words.

Arrow splits a batch of texts and finds its distinct words; only these are looked up, or encoded if they are new.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and characters of them, a Python worker remembers the ids of, and then as many again.
REMEMBERED, REMEMBERED_CHARS = 400_000, 24_000_000
#: Runs it remembers. Their merges cost more than taking a word apart.
REMEMBERED_RUNS, REMEMBERED_RUN_CHARS = 600_000, 24_000_000


#: What may stand behind a word without joining it: ASCII marks but the apostrophe, which contractions begin with.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS = "!-&(-/:-@\\[-`{-~"


class Usual:
    """Tells words of letters, with marks behind or without, from others.

    ``letters`` are those letters as they stand in a character class, ``added`` the added tokens of the vocabulary: if
    one could be a part of such a word, there is no usual word.
    """

    def __init__(self, letters: str, added: list[str]):
        self.pattern = f"^[{letters}]+[{_MARKS}]*\\z"
        self.none = any(re.fullmatch(f"[{letters}]*[{_MARKS}]*", token) for token in added)

    def __call__(self, words: list[str]) -> tuple[list[int], pa.Array, list[tuple[int, str]], list[int]]:
        """Places of the usual words and their letters; place among these and marks of each that has some; the others' places."""
        if self.none or not words:
            return [], pa.array([], pa.string()), [], list(range(len(words)))
        column = pa.array(words, pa.string())
        usual = pc.match_substring_regex(column, self.pattern)
        whole = column.filter(usual)
        stems = pc.utf8_rtrim(whole, MARKS)
        usual = usual.to_numpy(zero_copy_only=False)
        places = np.flatnonzero(usual)
        sizes = pc.utf8_length(stems).to_numpy()
        ending = np.flatnonzero(pc.utf8_length(whole).to_numpy() > sizes)
        marks = [(k, words[i][n:]) for k, i, n in zip(ending.tolist(), places[ending].tolist(), sizes[ending].tolist())]
        return places.tolist(), stems, marks, np.flatnonzero(~usual).tolist()


class Runs:
    """Ids of runs of characters that a BPE model merges each by itself; the last ones are remembered.

    ``model`` is the model of a vocabulary file of the ``tokenizers`` library with byte-level characters. Runs hold
    characters of the Latin blocks up to U+024F only; the library merges all new runs in one call. ``most`` are the
    runs and characters of them that are remembered.
    """

    def __init__(self, model: dict, most: tuple[int, int] = (REMEMBERED_RUNS, REMEMBERED_RUN_CHARS)):
        from tokenizers import Tokenizer, models, pre_tokenizers

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        options = {k: model[k] for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)}
        # Runs are remembered here, so the model need not do it again.
        self.tokenizer = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **options))
        self.tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Bytes as the vocabulary's characters, by the public rule of byte-level BPE; none of them is white space.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        characters = [chr(b) if b in plain else chr(next(other)) for b in range(256)]
        self.mapped: dict[int, str] = {c: "".join(characters[b] for b in chr(c).encode()) for c in range(0x250)}
        self.mapped[ord(_BORDER)] = " "
        self.known: dict[str, bytes] = {}
        self.chars, self.most = 0, most
        # Characters an id stands for, where the vocabulary has every character, so that none gets lost.
        self.sizes: np.ndarray | None = None
        suffix = model.get("end_of_word_suffix") or ""
        if not model.get("continuing_subword_prefix") and all(c + e in model["vocab"] for c in characters for e in {"", suffix}):
            self.sizes = np.zeros(max(model["vocab"].values()) + 1, np.int64)
            for token, i in model["vocab"].items():
                self.sizes[i] = len(token) - (len(suffix) if suffix and token.endswith(suffix) else 0)

    def learn(self, runs: set[str]) -> dict[str, bytes]:
        """A table in which the ids of all these runs can be looked up."""
        if len(self.known) > self.most[0] or self.chars > self.most[1]:
            self.known, self.chars = {}, 0
        new = list(runs.difference(self.known))
        self.chars += sum(map(len, new))
        if new:
            ids, ends = self._merged(new)
            every, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
            self.known.update(zip(new, [every[a:b] for a, b in zip([0, *ends], ends)]))
        return self.known

    def _merged(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all runs, one after another, and where those of each end."""
        text = _BORDER.join(runs).translate(self.mapped)
        if self.sizes is not None:
            # The library need not say which run an id belongs to: the characters ids stand for tell.
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            until = np.cumsum(np.fromiter(map(len, text.split(" ")), np.int64, len(runs)))
            reached = np.cumsum(self.sizes[ids])
            # The suffix of words written out in a run would count as one: then there are fewer characters.
            if len(reached) and reached[-1] == until[-1]:
                at = np.searchsorted(reached, until)
                if (reached[at] == until).all():
                    return ids, at + 1
        made = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(made.ids, np.int64), np.cumsum(np.bincount(np.array(made.word_ids, np.int64), minlength=len(runs)))


class WordCache:
    """Ids by word; those of the last texts stay at hand. ``encode`` gives the ids of a list of new words.

    ``most`` are the words and characters of them that are remembered, and then as many again.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[bytes]], most: tuple[int, int] = (REMEMBERED, REMEMBERED_CHARS)
    ):
        self.encode, self.known, self.older, self.chars, self.most = encode, {}, {}, 0, most

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of words."""
        if len(self.known) > self.most[0] or self.chars > self.most[1]:
            self.known, self.older, self.chars = {}, self.known, 0
        found = list(map(self.known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i in missing:
            if (ids := self.older.get(words[i])) is not None:
                found[i] = self.known[words[i]] = ids
        unseen = [i for i in missing if found[i] is None]
        if unseen:
            new = [words[i] for i in unseen]
            made = self.encode(new)
            self.known.update(zip(new, made))
            for i, ids in zip(unseen, made):
                found[i] = ids
        self.chars += sum(len(words[i]) for i in missing)
        return found

    def forget(self) -> None:
        self.known, self.older, self.chars = {}, {}, 0


#: Between runs; no run holds it.
_BORDER = "\uffff"
#: Stands for the ids of a word that cannot be encoded by itself.
WHOLE = b"?"


def joined_ids(texts: list[bytes], words: WordCache) -> list[bytes | None]:
    """Per text, the ids (little-endian unsigned 32-bit) of its words, which single spaces separate, one after another.

    None for a text with a word that cannot be encoded by itself.
    """
    cut = pc.split_pattern(pa.array(texts, pa.binary()), b" ")
    coded = cut.flatten().dictionary_encode()
    found = words.look_up(coded.dictionary.cast(pa.string()).to_numpy(zero_copy_only=False).tolist())
    unknown = np.array([ids is WHOLE for ids in found], bool)
    every = pa.array(found, pa.large_binary()).take(coded.indices)
    ends = np.frombuffer(every.buffers()[1], np.int64, len(every) + 1)
    borders = ends[cut.offsets.to_numpy()].tolist()
    held = memoryview(every.buffers()[2] or b"")
    out: list[bytes | None] = [bytes(held[a:b]) for a, b in zip(borders, borders[1:])]
    if unknown.any():
        pieces = np.flatnonzero(unknown[coded.indices.to_numpy()])
        for i in np.unique(np.searchsorted(cut.offsets.to_numpy(), pieces, "right") - 1).tolist():
            out[i] = None
    return out
