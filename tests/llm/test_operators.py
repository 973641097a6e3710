"""Each operator on odd rows and on an empty table, and against plain versions of what it computes."""

import itertools
import random

import numpy as np
import pytest
from llm_cases import DOCUMENTS, LONG, ODD, empty, odd, small, texts  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tablejobs.llm import (
    chat,
    decontaminate,
    language,
    licenses,
    line_dedup,
    packing,
    pairwise_quality,
    quality_rules,
    simhash,
    toxicity,
)
from tablejobs.llm.common import fold

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def by_text(rows, name):
    return sorted((repr(row["id"]), row[name]) for row in rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 0), (4, 1, 0), (5, 0, 1)], LABELS)


@pytest.fixture(scope="module")
def items(spark):
    data = [(10, "two three four five"), (11, None), (12, ""), (None, "one two"), (13, "word5 and5 word6 and6"), (10, "six")]
    return spark.createDataFrame(data, ITEMS)


def learn():
    return fold(F.col("id"), 5) != 0


# --- 1 and 6 -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("score", [toxicity.score_toxicity, pairwise_quality.score_quality])
def test_scores_of_odd_rows(spark, odd, empty, labels, score):
    rows = score(odd, labels, learn()).collect()
    assert len(rows) == len(ODD) and all(0 <= row.score <= 1 for row in rows)
    none = spark.createDataFrame([], LABELS)
    assert score(empty, labels, learn()).count() == 0
    assert len({row.score for row in score(odd, none, learn()).collect()}) == 1


def test_labelled_sample_counts_repetitions_once(spark):
    texts = [(key, f"text {key}") for key in range(40)] + [(1, "text 1")] * 30 + [(1, "other"), (2, None), (None, "x")]
    docs = spark.createDataFrame(texts, "id long, text string")
    marks = spark.createDataFrame([(key, key % 2) for key in range(40)] + [(1, 1), (None, 1), (3, None)], "id long, label int")
    all_of_them = toxicity.labelled_sample(docs, marks, "label", F.lit(True), {0: 100, 1: 100}).collect()
    assert sorted(map(tuple, all_of_them)) == sorted({(t, k % 2) for k, t in texts if t and k is not None})
    few = toxicity.labelled_sample(docs, marks, "label", F.lit(True), {0: 5, 1: 7}).collect()
    assert sorted(row.label for row in few) == [0] * 5 + [1] * 7 and set(few) <= set(all_of_them)


def test_toxic_words_lengthen_only_the_ordinary_result():
    plain = [f"the house number {i} of street {i % 7} has a garden and a garage" for i in range(60)]
    toxic = [f"{text} you horrible snollygoster" for text in plain]
    model = toxicity.fit([t for pair in zip(plain, toxic) for t in pair], [0, 1] * 60)
    assert model.score("what a snollygoster lives in that house with the garden") > 0.5
    assert model.score("the house has a garden and a garage of its own and a street") < 0.5
    assert model.score(None) == model.score("") < 0.5


def test_bradley_terry_orders_rows():
    random_rows = np.random.default_rng(1).normal(size=(400, 3))
    strength = random_rows @ [2.0, -1.0, 0.0]
    better, worse = random_rows[strength > 0.5][:80], random_rows[strength < -0.5][:80]
    n = min(len(better), len(worse))
    weights = pairwise_quality.bradley_terry(better[:n], worse[:n])
    assert weights[0] > 0 > weights[1] and abs(weights[2]) < abs(weights[1])
    assert (random_rows @ weights)[strength > 0.5].min() > np.median(random_rows @ weights) - 1


def test_bradley_terry_over_all_pairs(spark):
    """Sums by points give the weights of all pairs, and the threshold is judged by all rows."""
    random = np.random.default_rng(2)
    rows = random.normal(size=(160, 17)) * np.linspace(0.5, 3, 17)
    labels = (rows @ np.linspace(-1, 1, 17) + random.normal(size=160) * 4 > -2).astype(int)
    data = [(int(label), *map(float, row)) for label, row in zip(labels, rows)]
    learned = spark.createDataFrame(data, "label int, " + ", ".join(f"f{k} double" for k in range(17)))
    model = pairwise_quality.fit(learned)
    scaled = (rows - rows.mean(0)) / rows.std(0)
    better, worse = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    weights = pairwise_quality.bradley_terry(
        scaled[np.repeat(better, len(worse))], scaled[np.tile(worse, len(better))], len(better) / pairwise_quality.PAIRS
    )
    assert np.abs(weights).max() > 0.1 and np.allclose(model.weights, weights, atol=1e-5)
    strengths = model.strengths(rows)

    def accuracy(at):
        return (strengths[labels == 1] >= at).mean() + (strengths[labels == 0] < at).mean()

    assert accuracy(model.threshold) == pytest.approx(max(map(accuracy, strengths)))


def test_quality_learns_from_long_texts(spark):
    """The only worse text is longer than texts the fit used to take."""
    texts = [(key, f"A plain sentence about day {key} of the journey, told in calm words.") for key in range(30)]
    docs = spark.createDataFrame([*texts, (90, "#$%& " * 30_000)], "doc_id long, text string")
    marks = spark.createDataFrame([(key, 1) for key in range(30)] + [(90, 0)], "doc_id long, quality int")
    found = {row.id: row.score for row in pairwise_quality.score_quality(docs, marks, F.lit(True)).collect()}
    assert found[90] < 0.3 <= min(found[key] for key in range(30))


# --- 2 -------------------------------------------------------------------------------------------------------------


def plain_counts(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {t for t in triples if triples.count(t) > 1} if len(triples) < 5000 else None
    covered = set()
    if often is None:
        from collections import Counter

        counts = Counter(triples)
        often = {t for t, n in counts.items() if n > 1}
    for i, t in enumerate(triples):
        if t in often:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts(spark, odd, texts):
    made = [(i, text, "en", "s", 1) for i, text in enumerate(texts.values())]
    made += [(1000, "a b c a b c a b c d e", "en", "s", 1), (1001, " ".join(str(i % 90) for i in range(900)), "en", "s", 1)]
    made += [(1002, "x\x0by z\x0c<b>\n<b>\n\n<b>", "en", "s", 1)]
    docs = spark.createDataFrame(made, DOCUMENTS)
    for frame, rows in ((docs, made), (odd, ODD)):
        found = quality_rules.quality_rules(frame).collect()
        got = sorted(
            (repr(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found
        )
        expected = []
        for row in rows:
            n = plain_counts(row[1])
            expected.append((repr(row[0]), *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
        assert got == sorted(expected)
        assert all(not (r.base_failed and r.kept) for r in found)


def test_distances_by_hand(spark, texts):
    docs = spark.createDataFrame([(i, text, "xy"[i % 2], "s", 1) for i, text in texts.items()], DOCUMENTS)
    rows = docs.select(F.col("doc_id").alias("id"), "text", "lang")
    counts = quality_rules.counted(rows)
    references = quality_rules.references(counts)
    held = {r.id: r for r in counts.collect()}

    def distance(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda u: sum(a * np.log2(a / b) for a, b in zip(u, m) if a > 0)
        return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5

    for row in quality_rules.judge(counts, references).where("n_words >= 50").collect():
        own = held[row.id]
        best = []
        for one in references:
            classes = distance([n / sum(own.classes) for n in own.classes], one["classes"])
            shares = [0.0] * len(quality_rules.WORDS)
            for entry in own.common:
                shares[entry["at"] - 1] = entry["n"] / own.n_words
            words = distance([*shares, 1 - sum(shares)], [*one["words"], 1 - sum(one["words"])])
            best.append((classes / quality_rules.CHARACTER_LIMIT + words / quality_rules.WORD_LIMIT, classes, words))
        _, classes, words = min(best)
        assert abs(row.character_distance - classes) < 1e-6 and abs(row.word_distance - words) < 1e-6


def test_every_language_has_a_reference(spark, monkeypatch):
    """Seventy languages of one document each beside one with many: each document is nearest to its own."""
    chance = random.Random(3)

    def text(of):
        # Each language has common words of its own, and a share of capitals and figures of its own.
        own = quality_rules.WORDS[of :: 70] + quality_rules.WORDS[(of * 7) % 70 :: 70]
        return " ".join(chance.choice([*own, "Xyz" if of % 2 else "xyz", str(of) * (1 + of % 5)]) for _ in range(300))

    made = [(i, text(i), f"l{i:02d}", "s", 1) for i in range(70)]
    made += [(100 + i, text(70), "many", "s", 1) for i in range(9)]
    docs = spark.createDataFrame([*made, (200, "  ", "blank", "s", 1), (201, "a b", None, "s", 1)], DOCUMENTS)
    plain = None
    for group in (1_024, 9):
        monkeypatch.setattr(quality_rules, "GROUP", group, raising=False)
        found = {r.id: r for r in quality_rules.quality_rules(docs).collect()}
        assert len(found) == len(made) + 2 and found[200].lang_near is found[201].lang_near is None
        assert {k: r.lang_near for k, r in found.items() if k < 70} == {row[0]: row[2] for row in made[:70]}
        assert all(found[i].word_distance < 1e-6 and found[i].character_distance < 1e-6 for i in range(70))
        assert plain is None or plain == found
        plain = found
    counts = quality_rules.counted(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    assert [one["lang"] for one in quality_rules.references(counts)] == sorted({row[2] for row in made})


def test_quality_of_nothing(empty):
    assert quality_rules.quality_rules(empty).count() == 0


# --- 3 -------------------------------------------------------------------------------------------------------------


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_is_a_common_subsequence():
    random.seed(0)
    for _ in range(300):
        a = random.choices("abcdefgh", k=random.randrange(12))
        b = random.choices("abcdefgh", k=random.randrange(12))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(pairs))
        assert len(pairs) <= common_length(a, b)
        assert a != b or len(pairs) == len(a)
    values = random.sample(range(50), 30)
    best = max(len(licenses.longest_increasing(values[i:])) for i in range(30))
    kept = [values[i] for i in licenses.longest_increasing(values)]
    assert kept == sorted(set(kept)) and len(kept) == best


def test_notices(spark, odd, empty):
    text = "Intro. Released under the MIT License. Text. Released under the same MIT License!\nAll rights reserved. Rights."
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, "the license under the bridge", "en", "s", 1)], DOCUMENTS)
    found = sorted((r.id, r.license, r.coverage, r.first_word, r.end_word) for r in licenses.scan_licenses(docs).collect())
    assert found == [(1, "MIT", 1.0, 1, 6), (1, "MIT", 1.0, 7, 13), (1, "all-rights-reserved", 1.0, 13, 16)]
    assert licenses.scan_licenses(odd).count() == 0
    assert licenses.scan_licenses(empty).count() == 0
    assert licenses.scan_licenses(docs, {"none": "", "x": "bridge"}).count() == 1


# --- 4 -------------------------------------------------------------------------------------------------------------


def near_points(n, seed=0):
    generator = np.random.default_rng(seed)
    centres = generator.integers(0, 1 << 63, n // 4, dtype=np.uint64)
    flips = np.zeros(n, np.uint64)
    for _ in range(4):
        flips ^= np.uint64(1) << generator.integers(0, 64, n).astype(np.uint64)
    return np.unique(generator.choice(centres, n) ^ flips)


def groups(points, pairs):
    root = {int(p): int(p) for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in pairs:
        x, y = sorted((find(int(a)), find(int(b))))
        root[y] = x
    return {p: find(p) for p in root}


def all_pairs(points, bits=3):
    for i, p in enumerate(points):
        for j in np.flatnonzero(np.bitwise_count(points[:i] ^ p) <= bits):
            yield p, points[j]


@pytest.mark.parametrize("depth", [0, 2, 5])
def test_shards_lose_no_link(depth):
    points = near_points(3000)
    tree = simhash.grow(points[::3], depth, 3)
    shard, index, home = simhash.route(points, tree, 3)
    assert np.array_equal(np.sort(index[home]), np.arange(len(points)))
    found = []
    for one in np.unique(shard):
        own = shard == one
        a, b = simhash.shard_links(points[index[own & home]], points[index[own & ~home]], 3)
        found += zip(a, b)
        assert len(a) < own.sum()
    assert all(int(a ^ b).bit_count() <= 64 for a, b in found)
    assert groups(points, found) == groups(points, all_pairs(points))


def test_links_and_components_on_spark(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 128)
    points = near_points(2000, 3)
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fingerprint long")
    edges = simhash.links(frame, len(points))
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    expected = groups(points, all_pairs(points))
    sets = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    whole = {int(p): root.get(int(p), int(p)) for p in points.view(np.int64)}
    signed = {int(np.uint64(k).view(np.int64)): v for k, v in expected.items()}
    assert sets(whole) == sets(signed)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200)]
    random.seed(2)
    edges = [(b, a) if random.random() < 0.5 else (a, b) for a, b in edges]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def test_fingerprint_of_short_texts():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("A\x0bB") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprint("É") == xxhash.xxh64_intdigest("É".encode(), 42)
    assert simhash.fingerprint("a b c a b c a b c", 3) == simhash.fingerprint("A b C a B c a b C")


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    without_words = [row for row in rows if row.fingerprint == 0]
    assert len(without_words) == 4 and {row.component for row in without_words} == {2}
    same = [row.component for row in rows if row.fingerprint == simhash._signed(simhash.fingerprint(ODD[0][1]))]
    assert same == [1, 1, 1]
    kept = simhash.first_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(row.doc_id for row in kept.collect()) == [1, 2, 4, 5, 6, 7]
    assert simhash.near_duplicates(empty).count() == simhash.first_of_each_group(empty).count() == 0


# --- 5 -------------------------------------------------------------------------------------------------------------


def test_packs_about_as_well_as_possible():
    generator = np.random.default_rng(0)
    for lengths in (
        generator.integers(1, 4097, 5000),
        generator.geometric(1 / 900, 5000).clip(1, 4096),
        np.full(100, 4096),
        np.full(99, 2049),
        np.ones(5000, np.int64),
    ):
        sequence, offset = packing.pack(lengths, 4096)
        filled = np.bincount(sequence, lengths)
        assert filled.max() <= 4096
        for one in range(min(50, len(filled))):
            own = sequence == one
            ends = np.cumsum(lengths[own][np.argsort(offset[own])])
            assert np.array_equal(np.sort(offset[own]), np.concatenate([[0], ends[:-1]]))
        forced = max(-(-int(lengths.sum()) // 4096), int((lengths > 2048).sum()))
        assert len(filled) <= forced * 1.02 + 1


def test_words_are_encoded_like_texts(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary())
    encode = packing.encoder(vocabulary())
    odd = ["", "  ", "a b", "İstanbul", "Straße ΑΣ ΑΣ.", "é .", "don't I'll x.,y", "<|startoftext|>hi.", "a\x0bb\x1cc"]
    odd += ["１２ 3.4 ½", "日本語。", "ǅ ſ K Å", "ﬁne", ".", ",", "ª º µ", "́abc", "ÿ÷×Þ", "x\r\ny\t z", "a b"]
    for text in [*odd, *list(texts.values())[:80]]:
        assert encode([text]) == [np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()], text


def test_packing_of_odd_rows(odd, empty):
    rows = packing.pack_documents(odd, vocabulary()).collect()
    assert sum(row.length == 1 for row in rows) == 4  # two null texts, two without words
    long = sorted((row.start, row.length) for row in rows if row.id == 4)
    assert all(start == 4096 * i for i, (start, _) in enumerate(long)) and all(n == 4096 for _, n in long[:-1])
    assert packing.pack_documents(empty, vocabulary()).count() == 0


# --- 7 -------------------------------------------------------------------------------------------------------------


def test_conversations_come_back(spark):
    parts = ["<", "s>", "/s>", "[", "INST]", "\\", "<<SYS>>", "[TURN]", " ", "\n", "x", "é", "[ROLE]", "[AS]", "/ROLE]"]
    random.seed(5)
    text = lambda: "".join(random.choices(parts, k=random.randrange(9)))
    roles = ["user", "assistant", "system", "tool", "[AS]", "", None]
    rows = [(c, t, random.choice(roles), text()) for c in range(60) for t in range(random.randrange(1, 7))]
    rows += [(100, t, "assistant" if t % 3 else "user", f"turn {t} </s>") for t in range(700)]
    rows += [(101, 0, "user", None), (101, 0, "user", None), (101, None, "assistant", "first"), (None, 1, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("conv", F.lit("clash"))
    made = chat.format_conversations(turns)
    back = made.select(
        "conv", "n_turns", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss("formatted", "loss").alias("loss")
    ).collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for row in back:
        own = [r for r in rows if r[0] == row.conv]
        got = [(t["role"], t["text"]) for t in row.turns]
        if row.conv == 100 or row.conv == 101 or row.conv is None:
            assert got == [(r[2] or "", r[3] or "") for r in sorted(own, key=key)]
        assert sorted(got) == sorted((r[2] or "", r[3] or "") for r in own) and row.n_turns == len(own)
        assert row.loss == "".join(text for role, text in got if role == "assistant")
    assert {row.conv for row in back} == {r[0] for r in rows}
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_no_python_runs_for_native_operators(spark, odd):
    turns = spark.createDataFrame([(1, 1, "user", "a")], "conv_id int, turn int, role string, text string")
    made = chat.format_conversations(turns)
    plans = [made, made.select(chat.read_turns(F.col("formatted")), chat.read_loss("formatted", "loss"))]
    plans.append(quality_rules.counted(odd.select(F.col("doc_id").alias("id"), "text", "lang")))
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- 8 -------------------------------------------------------------------------------------------------------------


def test_probabilities_sum_to_one():
    seen = language.characters("the cat sat on the mat and the dog sat on the cat")
    grams, counts = np.unique(language.sequences(seen), return_counts=True)
    model = language.KneserNey(grams, counts)
    every = np.arange(1 << 16, dtype=np.uint64)
    for context in np.unique(grams >> np.uint64(16))[:20].tolist() + [int(ord("q")) << 32]:
        following = (np.uint64(context) << np.uint64(16)) | every
        assert abs(np.exp(model(following)).sum() - 1) < 1e-6


def test_language_of_odd_rows(spark, odd, empty):
    found = language.identify(odd, F.lit(True), keep_rows=True)
    rows = found.collect()
    assert len(rows) == len(ODD) and set(found.select("row.*").columns) == set(odd.columns)
    for row in rows:
        text = row.row["text"]
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= row.score <= 1
    assert language.identify(empty, F.lit(True)).count() == 0
    nothing = language.identify(odd, F.lit(False)).collect()
    assert {(row.lang_pred, row.rejected) for row in nothing} == {("und", True)}


def test_counts_cover_all_rows_and_groups_are_bounded(spark):
    rows = spark.createDataFrame([("en", "abc abd"), ("en", "abc"), (None, "abc"), ("de", "xyz")], "lang string, text string")
    counts = {(r.lang, r.gram): r.n for r in language.count_sequences(rows, "lang", "text").collect()}
    gram = int(language.sequences(language.characters("abc"))[0])
    assert counts["en", gram] == 2 and counts.get(("de", gram)) is None
    # Groups hold a bounded number of sequences or one language, and no language or sequence is left out.
    groups = list(language.fit(rows, "lang", "text", group_size=3))
    assert [models.names for models in groups] == [["de"], ["en"]]
    assert sum(len(models.keys) for models in groups) == len(counts)


def plain_bits(texts_of, text):
    """Cross-entropy of a text for each language: interpolated Kneser-Ney by recursion over dictionaries."""

    def runs(one, size):
        seen = [chr(c) for c in language.characters(one).tolist()]
        return ["".join(seen[i : i + size]) for i in range(len(seen) - size + 1)]

    out = {}
    for name, own in texts_of.items():
        levels = {4: {}}
        for one in own:
            for gram in runs(one, 4):
                levels[4][gram] = levels[4].get(gram, 0) + 1
        for size in (3, 2, 1):
            levels[size] = {}
            for gram in levels[size + 1]:
                levels[size][gram[1:]] = levels[size].get(gram[1:], 0) + 1

        def chance(gram, levels=levels):
            if not gram:
                return 1 / 65_536
            table = levels[len(gram)]
            ones, twos = (sum(1 for n in table.values() if n == k) for k in (1, 2))
            discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
            same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
            if not same:
                return chance(gram[1:])
            total = sum(same.values())
            return max(same.get(gram, 0) - discount, 0) / total + discount * len(same) / total * chance(gram[1:])

        own_runs = runs(text, 4)
        out[name] = -sum(np.log2(chance(gram)) for gram in own_runs) / max(1, len(own_runs))
    return out


def test_language_against_a_plain_model(spark):
    texts_of = {
        "aa": ["the cat sat on the mat", "a cat and the hat"], "bb": ["der hund und die katze", "die maus"], "cc": ["le chat noir et le chien"],
    }
    rows = [(i, t, name) for i, (name, t) in enumerate((n, t) for n, ts in texts_of.items() for t in ts)]
    docs = spark.createDataFrame(rows + [(9, "the hund et chat", None)], "doc_id long, text string, lang string")
    for group_size in (1, 60, 1_000_000):
        for row in language.identify(docs, F.col("lang").isNotNull(), group_size=group_size).collect():
            text = next((t for i, t, _ in rows if i == row.id), "the hund et chat")
            bits = plain_bits(texts_of, text)
            best = min(bits, key=bits.get)
            m = min(row.letters, 64)
            assert row.lang_pred == best and abs(row.entropy - bits[best]) < 1e-4
            assert abs(row.score - 1 / sum(2 ** ((bits[best] - b) * m) for b in bits.values())) < 1e-3


def test_many_languages_and_small_ones_beside_hot_ones(spark):
    """Seventy languages of random letters of their own, one of them with most of the rows, one with two."""
    random.seed(11)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 70 * 6)]
    rows = []
    for k in range(70):
        own = letters[6 * k : 6 * k + 6]
        for _ in range(300 if k == 0 else 2 if k == 1 else 6):
            rows.append((len(rows), " ".join("".join(random.choices(own, k=4)) for _ in range(8)), f"l{k:02}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(docs, F.lit(True), group_size=500).collect()
    assert {row.id: row.lang_pred for row in found} == {key: name for key, _, name in rows}


# --- 9 -------------------------------------------------------------------------------------------------------------


def plain_dedup(rows):
    """Templates by brute force over (id, text) documents with distinct ids."""
    lines = [
        (key, n, line_dedup.tokens_of(line))
        for key, text in rows
        for n, line in enumerate((text or "").split("\n"))
        if len(line.split()) >= line_dedup.LEAST_TOKENS
    ]
    leaf = lambda t: (len(t), *t[: line_dedup.DEPTH])
    template = {}
    for _, _, tokens in lines:
        same = [(k, t) for k, _, t in lines if leaf(t) == leaf(tokens)]
        constant = [len({k for k, t in same if t[i] == tokens[i]}) > 1 for i in range(len(tokens))]
        template[tuple(tokens)] = tuple(tokens)
        if len({k for k, _ in same}) > 1 and len({tuple(t) for _, t in same}) > 1:
            if sum(constant) >= line_dedup.SIMILARITY * len(tokens):
                template[tuple(tokens)] = tuple(t if c else None for t, c in zip(tokens, constant))
    first = {}
    for key, _, tokens in lines:
        own = template[tuple(tokens)]
        first[own] = min(first.get(own, key), key)
    return {(key, n) for key, n, tokens in lines if first[template[tuple(tokens)]] != key}


def test_lines_against_brute_force(spark, texts):
    rows = list(texts.items()) + [
        (5000, "Posted by alice on Monday morning here\nkeep this line of mine\nItem 12 of 40 is gone"),
        (5001, "Posted by alice on Monday evening here\nItem 7 of 9 is gone"),
        (5002, "Posted by bobby on Monday morning here\nshort one\nshort one"),
    ]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENTS)
    dropped = plain_dedup(rows)
    assert (5001, 1) in dropped
    for row in line_dedup.dedup_lines(docs).collect():
        parts = dict(rows)[row.id].split("\n")
        gone = {n for key, n in dropped if key == row.id}
        assert row.text == "\n".join(part for n, part in enumerate(parts) if n not in gone)
        assert (row.n_lines, row.n_dropped) == (len(parts), len(gone))


def test_lines_of_odd_rows(odd, empty):
    found = line_dedup.dedup_lines(odd, keep_rows=True)
    rows = [(row.id, row.text, row.n_lines, row.n_dropped, row.kept) for row in found.collect()]
    assert len(rows) == len(ODD)
    whole = ODD[0][1]
    assert rows.count((1, whole, 2, 0, True)) == 2
    assert (None, "", 2, 2, False) in rows and (None, None, 0, 0, True) in rows and (3, "", 1, 0, True) in rows
    assert (4, LONG, 1, 0, True) in rows
    assert line_dedup.dedup_lines(empty).count() == 0


# --- 10 ------------------------------------------------------------------------------------------------------------


def plain_hits(text, item_rows, width):
    words = decontaminate.terms(text)
    hit, found = set(), set()
    for key, item in item_rows:
        own = decontaminate.terms(item)
        if not own:
            continue
        size = min(width, len(own))
        for j in range(len(own) - size + 1):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[j : j + size]:
                    hit |= set(range(i, i + size))
                    found |= set() if key is None else {str(key)}
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1, 10**9])
def test_passages_against_brute_force(spark, items, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "QUERY_WORDS", block)
    random.seed(3)
    words = ["one", "two", "three", "four", "five", "six"]
    rows = [(i, " ".join(random.choices(words, k=random.randrange(40))), "en", "s", 1) for i in range(40)] + ODD[:4]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    item_rows = [tuple(r) for r in items.collect()]
    found = decontaminate.find_passages(docs, items, width=3, slop=2)
    got = sorted((repr(r.id), r.n_words, r.hit, r["items"]) for r in found.withColumn("hit", decontaminate.hit_words(F.col("spans"))).collect())
    expected = []
    for row in rows:
        n, hit, own = plain_hits(row[1], item_rows, 3)
        expected.append((repr(None if row[0] is None else str(row[0])), n, hit, own))
    assert got == sorted(expected)


def test_near_matches(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], ITEMS)
    texts = ["alpha x beta gamma delta", "delta gamma beta alpha", "alpha beta gamma delta", "alpha beta gamma", "alpha beta"]
    texts += ["alpha " + "x " * 30 + "beta gamma delta"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCUMENTS)
    found = {r.id: (r["items"], r.near_items) for r in decontaminate.find_passages(docs, items, slop=3).collect()}
    assert found == {"0": ([], ["1"]), "1": ([], ["1"]), "2": (["1"], []), "3": ([], []), "4": ([], []), "5": ([], [])}


def test_passages_of_odd_rows(spark, odd, empty, items):
    rows = decontaminate.find_passages(odd, items).collect()
    assert len(rows) == len(ODD)
    expected = sorted((repr(None if r[0] is None else str(r[0])), plain_hits(r[1], [tuple(i) for i in items.collect()], 10)[1:]) for r in ODD if r[0] != 4)
    hits = sorted((repr(r.id), (sum(s["end"] - s["first"] for s in r.spans), r["items"])) for r in rows if r.id != "4")
    assert hits == expected
    assert decontaminate.find_passages(empty, items).count() == 0
    assert decontaminate.find_passages(odd, items.limit(0)).where("size(spans) > 0").count() == 0
    clean = decontaminate.clean_rows(odd, items)
    assert clean.columns == odd.columns and {r.doc_id for r in clean.collect()} == {2, 3, 5, 6, 7, None}


def test_pieces_do_not_follow_the_parts_encoded_at_once(spark, odd, monkeypatch):
    whole = sorted(map(repr, packing.token_pieces(odd, vocabulary()).collect()))
    monkeypatch.setattr(packing, "PART", 1)
    assert sorted(map(repr, packing.token_pieces(odd, vocabulary()).collect())) == whole


# --- pipeline ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_rows(spark, odd, empty, tmp_path, name):
    spark.createDataFrame([(1, "two three four five")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    kept = stage(spark, odd, str(tmp_path))
    assert 0 < kept.count()
    assert name == "packing" or kept.columns == odd.columns
    assert stage(spark, empty, str(tmp_path)).count() == 0


def test_workers_hold_little(spark, texts, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "REMEMBERED", (50, 400))
    monkeypatch.setattr(packing, "REMEMBERED_RUNS", (50, 400))
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, some = packing.WordEncoder(path), [text for text in list(texts.values())[:40] if text]
    for text in some:
        ids = np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode([text]) == [ids]
    most = 50 + max(len(set(text.split())) for text in some)
    assert len(encode.words.known) <= most and len(encode.words.older) <= most and len(encode.runs.known) <= 2 * most
    encode.rest()
    assert not encode.words.older and not encode.runs.known

    # Counts are the same however often a worker hands them on, and rows whose texts are strings carry them only once.
    rows = spark.createDataFrame([(k, t, "en" if k % 3 else "de") for k, t in texts.items()], "doc_id long, text string, lang string")
    counts = lambda: {(r.lang, r.gram): r.n for r in language.count_sequences(rows, "lang", "text").collect()}
    usual = counts()
    monkeypatch.setattr(language, "HELD", 100)
    monkeypatch.setattr(language, "PART", 2_000)
    assert counts() == usual
    found = language.identify(rows, F.lit(True), keep_rows=True, group_size=500)
    assert found.where("row.text is distinct from null").count() == len(texts)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    sent = [line for line in plan.split("\n") if "MapInArrow" in line]
    assert sent and all("text#" not in line.split("run(")[1].split(")")[0] for line in sent)
