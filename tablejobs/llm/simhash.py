"""Near duplicates by SimHash fingerprints, searched with vantage-point trees.

Every document becomes a 64-bit fingerprint. Equal fingerprints are one node from then on, so a group of exact
copies of any size costs one row. A vantage-point tree over a bounded sample of fingerprints cuts the Hamming space
into shards: a node splits by the distance to its vantage point. Each fingerprint has one home shard; it also visits
those shards that the triangle inequality cannot rule out for a ball of ``max_bits`` around it. A shard goes on with a
tree of its own, compares homes with homes and visitors, and returns a spanning forest of its links, never all pairs.
The links of all shards are joined to components by alternating star contractions on Spark.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.common import ids_and_texts, map_texts, whole_rows
from tablejobs.storage import materialize

SEED = 42
#: Fingerprints the shard tree is fitted on at most; every fingerprint is then routed through it.
SAMPLE = 32_768
#: Homes a shard should hold.
SHARD = 4_096
#: Points below which a shard compares directly.
DIRECT = 512
#: Hashes whose bits are counted at once.
BLOCK = 65_536


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint of a text, unsigned. Null and texts without words have fingerprint 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    count = len(words) - width + 1
    bits = np.zeros(64, np.int64)
    for at in range(0, count, BLOCK):  # bounded memory for texts of any length
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at + width - 1 : at + width - 1 + BLOCK].tolist())
        bits += _set_bits(np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8"))
    return _majority(bits, count)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The fingerprint of a text whose shingles have these 64-bit hashes, unsigned; 0 without shingles."""
    parts = (hashes[at : at + BLOCK] for at in range(0, len(hashes), BLOCK))
    return _majority(sum(map(_set_bits, parts), np.zeros(64, np.int64)), len(hashes))


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _majority(bits: np.ndarray, count: int) -> int:
    return int(np.packbits(2 * bits > count, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Per row: id, fingerprint (the 64 bits as a signed long)."""
    return map_texts(
        ids_and_texts(docs, id_col, text_col),
        "fingerprint long",
        lambda texts: [[_signed(fingerprint(text, width)) for text in texts]],
    )


# --- vantage-point trees -------------------------------------------------------------------------------------------


def _split(points: np.ndarray, max_bits: int, random: np.random.Generator):
    """Of some candidates, the vantage point with the fewest points near its median radius; None if none splits."""
    best = None
    for vantage in points[random.integers(0, len(points), 8)]:
        distance = np.bitwise_count(points ^ vantage).astype(np.int16)
        radius = int(np.median(distance))
        inside = int((distance < radius).sum())
        if 0 < inside < len(points):
            near = int(((distance >= radius - max_bits) & (distance < radius + max_bits)).sum())
            cost = near + abs(2 * inside - len(points))
            if best is None or cost < best[0]:
                best = (cost, vantage, radius)
    return best and best[1:]


def _sides(points: np.ndarray, home: np.ndarray, vantage, radius: int, max_bits: int):
    """Who goes inside and who outside, and who of the inside also visits the outside.

    A home point lies on one side. An inside home within ``max_bits`` of the boundary visits the outside, so that each
    link across it is found once. A visitor goes wherever its ball reaches.
    """
    distance = np.bitwise_count(points ^ vantage).astype(np.int16)
    into = np.where(home, distance < radius, distance < radius + max_bits)
    out = np.where(home, distance >= radius, distance >= radius - max_bits)
    across = home & (distance < radius) & (distance >= radius - max_bits)
    return into, out, across


def grow(sample: np.ndarray, depth: int, max_bits: int) -> tuple | int:
    """A tree of ``depth`` levels: (vantage, radius, inside, outside), with shard numbers as leaves."""
    random = np.random.default_rng(0)
    shards = iter(range(1 << (depth + 1)))

    def node(points: np.ndarray, levels: int):
        found = _split(points, max_bits, random) if levels and len(points) >= 16 else None
        if not found:
            return next(shards)
        vantage, radius = found
        inside = np.bitwise_count(points ^ vantage) < radius
        return vantage, radius, node(points[inside], levels - 1), node(points[~inside], levels - 1)

    return node(sample, depth)


def route(points: np.ndarray, tree: tuple | int, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, index of the point, and whether the shard is its home; one entry per shard a point belongs to."""
    found = []
    stack = [(tree, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        node, index, home = stack.pop()
        if not len(index):
            continue
        if not isinstance(node, tuple):
            found.append((np.full(len(index), node), index, home))
            continue
        vantage, radius, inside, outside = node
        into, out, across = _sides(points[index], home, vantage, radius, max_bits)
        stack.append((inside, index[into], home[into]))
        stack.append((outside, index[out], home[out]))
        stack.append((outside, index[across], np.zeros(int(across.sum()), bool)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked points one label, the lowest. Labels always point at a root."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            next_label = label[label]
            if (next_label == label).all():
                break
            label[:] = next_label


def shard_links(homes: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among homes and between homes and visitors."""
    points = np.concatenate([homes, visitors])
    label = np.arange(len(points))
    random = np.random.default_rng(0)

    def compare(left: np.ndarray, right: np.ndarray) -> None:
        for i in range(0, len(left), DIRECT):
            for j in range(0, len(right), 4096):
                a, b = left[i : i + DIRECT], right[j : j + 4096]
                x, y = np.nonzero(np.bitwise_count(points[a][:, None] ^ points[b][None, :]) <= max_bits)
                _unite(label, a[x], b[y])

    stack = [(np.arange(len(homes)), np.arange(len(homes), len(points)))]
    while stack:
        home, visitor = stack.pop()
        if not len(home):
            continue
        found = _split(points[home], max_bits, random) if len(home) > DIRECT else None
        if not found:
            compare(home, home)
            compare(visitor, home)
            continue
        index = np.concatenate([home, visitor])
        is_home = np.arange(len(index)) < len(home)
        into, out, across = _sides(points[index], is_home, *found, max_bits)
        stack.append((index[into & is_home], index[into & ~is_home]))
        stack.append((index[out & is_home], np.concatenate([index[out & ~is_home], index[across]])))
    linked = label != np.arange(len(points))
    return points[linked], points[label[linked]]


def links(distinct: DataFrame, total: int, max_bits: int = 3) -> DataFrame:
    """Links (a, b) that connect whatever ``max_bits`` or fewer differing bits connect among distinct fingerprints."""
    rows = distinct.orderBy(F.xxhash64("fingerprint")).limit(SAMPLE).collect() if total > SHARD else []
    depth = max(0, math.ceil(math.log2(max(total, 1) / SHARD)))
    tree = grow(np.array([row[0] for row in rows], np.int64).view(np.uint64), depth, max_bits)

    def deal(frames):
        for frame in frames:
            points = frame["fingerprint"].to_numpy(np.int64)
            shard, index, home = route(points.view(np.uint64), tree, max_bits)
            yield pd.DataFrame({"shard": shard.astype(np.int64), "fingerprint": points[index], "home": home})

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        points = frame["fingerprint"].to_numpy(np.int64).view(np.uint64)
        home = frame["home"].to_numpy(bool)
        a, b = shard_links(np.sort(points[home]), np.sort(points[~home]), max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.mapInPandas(deal, "shard long, fingerprint long, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link: the root is the lowest node of its component.

    Each round turns the links of a node towards its lowest neighbour, first from the larger neighbours, then from the
    node itself; the number of rounds follows the logarithm of the longest chain. A round is written to the shared
    folder, so no lineage builds up.
    """
    def oriented(frame: DataFrame) -> DataFrame:
        return frame.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(frame: DataFrame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = materialize(oriented(edges), "links")
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = oriented(large)
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(lowest.select("a", F.col("low").alias("b")))
        edges = materialize(oriented(small), "links")
        after = mark(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _grouped(marked: DataFrame, max_bits: int) -> DataFrame:
    """Per distinct fingerprint: root of its component, the component's lowest id and the fingerprint that has it."""
    nodes = materialize(marked.groupBy("fingerprint").agg(F.min("id").alias("first")), "fingerprints")
    total = nodes.count()
    roots = components(links(nodes.select("fingerprint"), total, max_bits))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = materialize(rooted, "roots")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return rooted.join(lowest, "root")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 3
) -> DataFrame:
    """Per row: id, fingerprint (signed long), component (the lowest id reachable by links).

    Null texts and texts without words have fingerprint 0 and are linked like others. Rows with the same id are
    separate rows that share what their texts give. A null id counts for no component; a component of such rows only
    has the component null. An empty table gives no rows. Further columns are not read.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    groups = _grouped(marked, max_bits).select("fingerprint", "component")
    return marked.join(groups, "fingerprint").select("id", "fingerprint", "component")


def first_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 3
) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: of each component the row with the lowest id.

    Rows that share id and fingerprint count as one document; one of them stays. Where no row of a component has an
    id, one row stays. The rows meet the list of those that stay by id and fingerprint, a key that spreads evenly
    however large a group of copies is.
    """
    def marks(texts):
        return [[_signed(fingerprint(text, width)) for text in texts]]

    # Texts are not written to get at their fingerprints: those are computed once more where the rows are needed.
    small = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    groups = _grouped(small, max_bits)
    marked = map_texts(whole_rows(docs, id_col, text_col), "fingerprint long", marks, keep=("row", "id"))
    stays = (
        groups.where(F.col("first").eqNullSafe(F.col("component")))
        .groupBy("root")
        .agg(F.min("fingerprint").alias("fingerprint"), F.min("component").alias("first"))
        .select(F.col("fingerprint").alias("own"), F.col("first").alias("own_id"))
    )
    kept = marked.join(stays, (F.col("fingerprint") == F.col("own")) & F.col("id").eqNullSafe(F.col("own_id")))
    return kept.dropDuplicates(["fingerprint", "id"]).select("row.*")
