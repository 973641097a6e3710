"""Near copies by the similarity of their five-word shingles, exactly: no pair at ``SIMILARITY`` or more is missed.

Texts with equal sets of shingles are one node. Nodes get SimHash fingerprints of these shingles, and the vantage-point
trees of ``simhash`` find those that differ in few bits. Such a link counts only if the whole sets are similar enough,
and similar sets may differ in more bits, so a prefix filter finds all that fingerprints do not: the shingles of a node
are put into one order that holds for all texts; two sets that are similar enough share one among the first fifth of each, its prefix (prefix filter). Only prefixes are
written and shuffled, once a node; whole sets are made again for the nodes of pairs that are left to verify.

Nodes that share a prefix shingle are first held against two of them, those with the lowest and the highest hash. Where
they are one component by then, nothing is left to find; where not, those of different components are paired too, and
the number of prefix shingles they share tells which of these pairs can be similar at all. Fingerprints go the same way:
first the links of the search, then all pairs of different components whose fingerprints differ in few bits. Every link
is verified on the whole sets. Any order gives the same result: shingles that are frequent in a sample come last, which keeps groups small.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import simhash
from tablejobs.llm.common import ids_and_texts, map_texts, whole_rows
from tablejobs.llm.simhash import components
from tablejobs.storage import materialize, release

#: Words of a shingle.
WIDTH = 5
#: Least Jaccard similarity of the shingle sets of near copies.
SIMILARITY = 0.8
#: Bits in which fingerprints of a candidate pair may differ.
MAX_BITS = 3
#: One in so many texts counts for the order of shingles, and so many frequent shingles come last.
SAMPLED, FREQUENT = 16, 50_000
#: Up to so many documents to verify (24 bytes each) are sent to the texts; beyond that, texts are shuffled to them.
SENT = 500_000


def shingles(text: str | None) -> np.ndarray:
    """The hashes of all ``WIDTH`` words in a row, sorted, each once; one for a shorter text, none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    runs = {b" ".join(words[i : i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))}
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs), np.uint64, len(runs)).view(np.int64))


def _node(own: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(own.tobytes())
    return value - (1 << 64) if value >> 63 else value


def _own() -> list[Column]:
    """Hashes of a document, which is an id with a text, 96 bits in all; never null."""
    return [F.xxhash64("id", "text").alias("own"), F.hash("text", "id").alias("check")]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, and the document's hashes."""
    return ids_and_texts(docs, id_col, text_col).select("id", "text", *_own())


def _frequent(texts: DataFrame) -> np.ndarray:
    """Shingles that are frequent in a sample of the different texts, sorted; at most ``FREQUENT``."""
    sample = texts.select("text", F.xxhash64("text").alias("of")).where(F.pmod("of", F.lit(SAMPLED)) == 0)
    sample = sample.dropDuplicates(["of"])
    made = map_texts(sample, "shingles array<long>", lambda held: [list(map(shingles, held))], keep=())
    counted = made.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().where("count > 2")
    rows = counted.orderBy(F.desc("count"), "shingle").limit(FREQUENT).collect()
    return np.sort(np.array([row[0] for row in rows], np.int64))


def _prefix(own: np.ndarray, late: np.ndarray) -> np.ndarray:
    """The first shingles of a set: sets that are similar share at least ``least`` of n, so one of n - least + 1.

    ``late`` are those that come last, sorted.
    """
    least = math.ceil(round(SIMILARITY * len(own), 6))
    if len(late):
        # A search in the sorted list: ``np.isin`` would sort all of it again for every text.
        is_late = late[np.minimum(np.searchsorted(late, own), len(late) - 1)] == own
        own = np.concatenate([own[~is_late], own[is_late]])
    return own[: len(own) - least + 1] if len(own) else own


def _nodes(texts: DataFrame) -> DataFrame:
    """Per node: node, size, fingerprint, prefix, and id and hashes of its first document (``first.none``: it has no id)."""
    late = _frequent(texts)

    def marks(held):
        made = list(map(shingles, held))
        prints = [simhash._signed(simhash.fingerprint_of(own)) for own in made]
        return [list(map(_node, made)), list(map(len, made)), prints, [_prefix(own, late) for own in made]]

    marked = map_texts(texts, "node long, size int, fingerprint long, prefix array<long>", marks, keep=("id", "own", "check"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "own", "check")).alias("first")
    nodes = marked.groupBy("node").agg(first, *[F.any_value(c).alias(c) for c in ("size", "fingerprint", "prefix")])
    return materialize(nodes, "nodes")


def _sizes_fit(x: Column, y: Column) -> Column:
    return F.least(x, y) >= SIMILARITY * F.greatest(x, y) - 1e-6


def _least_shared(x: Column, y: Column) -> Column:
    """How many shingles sets of these sizes share at least if they are similar."""
    return F.ceil(F.round(SIMILARITY / (1 + SIMILARITY) * (x + y), 6))


def _least_in_prefixes(x: Column, y: Column) -> Column:
    """How many of them are in both prefixes: whichever prefix ends earlier, only what follows it in its set is not seen."""
    behind = F.ceil(F.round(SIMILARITY * F.greatest(x, y), 6)) - 1
    return F.greatest(_least_shared(x, y) - behind, F.lit(1))


def _candidates(shared: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``shared`` prefix shingles, and sizes size_a and size_b, that may be similar."""
    x, y = F.col("size_a"), F.col("size_b")
    return shared.where(_sizes_fit(x, y) & (F.col("shared") >= _least_in_prefixes(x, y))).select("a", "b")


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, written."""
    pairs = materialize(pairs, "candidates")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialize(nodes.join(wanted, "node").select("node", "first.own", "first.check"), "wanted")
    held = texts.join(F.broadcast(wanted) if wanted.count() <= SENT else wanted, ["own", "check"])
    made = map_texts(held, "shingles array<long>", lambda own: [list(map(shingles, own))], keep=("node",))
    sets = materialize(made.groupBy("node").agg(F.any_value("shingles").alias("shingles")), "sets")
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    joined = pairs.join(one, "a").join(two, "b")
    near = joined.where(both >= SIMILARITY * (F.size("of_a") + F.size("of_b") - both) - 1e-6).select("a", "b")
    near = materialize(near, "near")
    for table in (sets, wanted, pairs):
        release(table)
    return near


def _searched(nodes: DataFrame) -> DataFrame:
    """Per fingerprint: its first node, the fingerprints that the search links it with, and the lowest one that chains
    of such links reach; whatever differs in ``MAX_BITS`` bits or fewer is in one chain.
    """
    prints = nodes.groupBy("fingerprint").agg(F.min(F.struct("node", "size")).alias("first"))
    prints = materialize(prints, "fingerprints")
    found = materialize(simhash.links(prints.select("fingerprint"), prints.count(), MAX_BITS), "linked")
    linked = found.groupBy(F.col("a").alias("fingerprint")).agg(F.collect_set("b").alias("linked"))
    chains = components(found).select(F.col("node").alias("fingerprint"), F.col("root").alias("chain"))
    whole = prints.join(linked, "fingerprint", "left").join(chains, "fingerprint", "left")
    whole = whole.select("fingerprint", "first", "linked", F.coalesce("chain", "fingerprint").alias("chain"))
    whole = materialize(whole, "searched")
    for table in (prints, found):
        release(table)
    return whole


def alike(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that the search links and sizes allow: each with the first node of its fingerprint, and
    the first nodes of linked fingerprints. ``prints`` is what ``_searched`` gives; other pairs follow in ``still_alike``.
    """
    one = prints.select(F.col("first").alias("of_a"), F.explode("linked").alias("fingerprint"))
    far = one.join(prints.select("fingerprint", F.col("first").alias("of_b")), "fingerprint").select("of_a", "of_b")
    same = nodes.select("fingerprint", F.struct("node", "size").alias("of_a")).join(prints, "fingerprint")
    pairs = far.unionByName(same.select("of_a", F.col("first").alias("of_b")))
    pairs = pairs.where((F.col("of_a.node") != F.col("of_b.node")) & _sizes_fit(F.col("of_a.size"), F.col("of_b.size")))
    return pairs.select(F.col("of_a.node").alias("a"), F.col("of_b.node").alias("b"))


def still_alike(prints: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of all nodes of different components whose fingerprints differ in ``MAX_BITS`` bits or fewer and
    whose sizes fit. ``roots`` has the component (root) of each node (of) that has links.

    Of ``MAX_BITS`` + 1 parts of such fingerprints at least one is equal, so nodes of a chain meet by these. Those of a
    group's largest component meet the others only: a large group of linked copies is never paired with itself.
    """
    rooted = nodes.select("node", "size", "fingerprint").join(prints.select("fingerprint", "chain"), "fingerprint")
    rooted = rooted.join(roots, F.col("node") == F.col("of"), "left")
    rooted = rooted.select("node", "size", "fingerprint", "chain", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "chains")
    mixed = rooted.groupBy("chain").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    borders = [64 * i // (MAX_BITS + 1) for i in range(MAX_BITS + 2)]
    parts = [
        F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(borders, borders[1:])
    ]
    rest = rooted.join(mixed.select("chain"), "chain", "left_semi")
    rest = materialize(rest.select("*", F.posexplode(F.array(*parts)).alias("part", "bits")), "parts")
    release(rooted)
    key = ["chain", "part", "bits"]
    largest = rest.groupBy(*key, "root").count().groupBy(*key)
    largest = largest.agg(F.max_by("root", F.struct("count", "root")).alias("largest"), F.count("*").alias("n")).where("n > 1")
    one, two = (
        rest.select(*key, *[F.col(c).alias(f"{c}_{k}") for c in ("node", "size", "fingerprint", "root")]) for k in "ab"
    )
    pairs = one.join(largest.drop("n"), key).where("root_a <> largest").join(two, key)
    pairs = pairs.where("root_a <> root_b AND (root_b = largest OR node_a > node_b)")
    pairs = pairs.where(F.bit_count(F.col("fingerprint_a").bitwiseXOR(F.col("fingerprint_b"))) <= MAX_BITS)
    pairs = pairs.where(_sizes_fit(F.col("size_a"), F.col("size_b")))
    # A pair may meet in several parts, and either way round.
    pairs = pairs.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()
    pairs = materialize(pairs, "still")
    release(rest)
    return pairs


def links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever pairs of similar nodes connect."""
    prints = _searched(nodes)
    prefixes = nodes.select("node", F.explode("prefix").alias("shingle"))
    hubs = prefixes.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    groups = prefixes.join(hubs.where("low <> high"), "shingle").join(nodes.select("node", "size"), "node")
    groups = materialize(groups, "groups")
    sizes = nodes.select(F.col("node").alias("b"), F.col("size").alias("size_b"))

    def against(hub: str) -> DataFrame:
        held = groups.where(f"node <> {hub}").select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col(hub).alias("b"))
        return held.groupBy("a", "size_a", "b").agg(F.count("*").alias("shared")).join(sizes, "b")

    pairs = _candidates(against("low")).union(_candidates(against("high"))).union(alike(prints, nodes))
    near = _verified(pairs.distinct(), nodes, texts)
    roots = components(near).withColumnRenamed("node", "of")
    still = still_alike(prints, nodes, roots)
    release(prints)
    rooted = groups.join(roots, F.col("node") == F.col("of"), "left")
    rooted = rooted.select("shingle", "node", "size", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "rooted")
    release(groups)
    mixed = rooted.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rest = rooted.join(mixed.select("shingle"), "shingle", "left_semi")
    one, two = (rest.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "size", "root")]) for k in "ab")
    # Nodes of different components share no shingle but those of mixed groups, so all they share is counted.
    pairs = one.join(two, "shingle").where("node_a > node_b and root_a <> root_b")
    pairs = pairs.where(_sizes_fit(F.col("size_a"), F.col("size_b")))
    pairs = pairs.groupBy(F.col("node_a").alias("a"), "size_a", F.col("node_b").alias("b"), "size_b")
    pairs = _candidates(pairs.agg(F.count("*").alias("shared")))
    pairs = pairs.unionByName(still).distinct()
    return near.unionByName(_verified(pairs, nodes, texts))


def first_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: of each group of near copies the row with the lowest id.

    A group is what pairs of similarity ``SIMILARITY`` or more connect. Words are compared without regard to case of
    ASCII letters; texts without words, null texts too, are copies of each other. Rows that share id and shingles count
    as one document; one of them stays. Where no row of a group has an id, one row stays.
    """
    texts = _texts(docs, id_col, text_col)
    nodes = _nodes(texts)
    roots = components(links(nodes.where("size > 0"), texts)).withColumnRenamed("node", "of")
    rooted = nodes.join(roots, F.col("node") == F.col("of"), "left")
    # Of nodes with the lowest id, one; a null id is never the lowest.
    stays = rooted.groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
    stays = materialize(stays.select("first.own", "first.check"), "stays")
    release(nodes)
    # Repeated rows go before the join, which needs the same partitioning: whole rows are shuffled once.
    rows = whole_rows(docs, id_col, text_col).select("row", *_own()).dropDuplicates(["own", "check"])
    return rows.join(stays, ["own", "check"]).select("row.*")
