"""How far the sources of a language differ in their use of words.

Every language keeps the terms that enough of its documents hold. Counts of groups (language, source) by kept terms
form a matrix; a group's share of a term is ``p = 1 + floor(scale * (count + smooth) / (total + smooth * terms))``, the
same number wherever the count is zero. The matrix is cut into tiles of bounded size, each held as a K-squared tree: a
square is split into quadrants, and only quadrants with a count are split again. Two tiles over the same terms are
traversed together for all pairs of their groups: a quadrant pair that is zero on both sides costs width times the
difference of two constants, others are split until single cells are left.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm.common import slices
from tablejobs.storage import materialize

#: Groups and terms of a tile, about: hashing deals them out.
ROWS, COLUMNS = 64, 4096
#: Counts a task holds before it hands them on.
HELD = 300_000
#: Quadrant pairs that are split at a time.
FRONT = 400_000
SCALE, SMOOTH = 1_000_000_000, 5

#: Letters A-Z in lower case; what is neither a letter nor outside ASCII becomes a space.
LETTERS = bytes(
    b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents, added up within each task as far as memory allows."""
    names = {"text": text_col, "lang": lang_col, "source": source_col}
    source = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in names.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, docs) in held.items():
                found = list(counts)
                names = [[lang] * len(found), [source] * len(found)]
                arrays = [*(pa.array(own, pa.string()) for own in names), pa.array(found, pa.binary())]
                arrays += [pa.array(counts.values(), pa.int64()), pa.array(map(docs.__getitem__, found), pa.int64())]
                arrays[2] = arrays[2].cast(pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for part in slices(batch, 0):
                for text, *group in zip(*[column.to_pylist() for column in part.columns]):
                    counts, docs = held.setdefault(tuple(group), (Counter(), Counter()))
                    words = text.encode().translate(LETTERS).split()
                    counts.update(words)
                    docs.update(set(words))
                if sum(len(counts) for counts, _ in held.values()) > HELD:
                    yield from handed_on()
        yield from handed_on()

    return source.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, least: int, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n, total (in the language), for terms that ``least`` documents of the language hold.

    One shuffle by language and term serves the sums of groups and of languages.
    """
    dealt = term_counts(docs, text_col, lang_col, source_col).repartition("lang", "term")
    summed = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    whole = summed.select("*", F.sum("docs").over(same).alias("df"), F.sum("n").over(same).alias("total"))
    return whole.where(F.col("df") >= least).select("lang", "source", "term", "n", "total")


def share(count: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(SCALE * count / total)`` of smoothed counts, exact for counts and totals below 2 ** 53."""
    whole, rest = np.divmod(np.asarray(count, np.int64), total)
    for _ in range(3):  # three digits a step, so that no product leaves 64 bits
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return 1 + whole


# --- trees ---------------------------------------------------------------------------------------------------------


def _spread(numbers: np.ndarray) -> np.ndarray:
    """The bits of numbers, each with a zero before it."""
    out = np.asarray(numbers, np.int64).copy()
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = (out | (out << shift)) & mask
    return out


class Tree:
    """A K-squared tree (k = 2): for each level one bit per quadrant of the nodes above, then the counts."""

    def __init__(self, height: int, levels: list[np.ndarray], counts: np.ndarray):
        self.height, self.levels, self.counts = height, levels, counts

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, height: int) -> Tree:
        code = (_spread(rows) << 1) | _spread(columns)
        order = np.argsort(code)
        code, levels, above = code[order], [], np.zeros(min(1, len(code)), np.int64)
        for depth in range(1, height + 1):
            nodes = np.unique(code >> (2 * (height - depth)))
            bits = np.zeros(4 * len(above), bool)
            bits[4 * np.searchsorted(above, nodes >> 2) + (nodes & 3)] = True
            levels.append(bits)
            above = nodes
        return cls(height, levels, np.asarray(counts, np.int64)[order])

    def packed(self) -> tuple[bytes, bytes]:
        """Bits of all levels, and counts."""
        return np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)])).tobytes(), self.counts.astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, height: int, bits: bytes, counts: bytes) -> Tree:
        every, levels, at, nodes = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool), [], 0, min(1, len(counts))
        for _ in range(height):
            levels.append(every[at : at + 4 * nodes])
            at += 4 * nodes
            nodes = int(levels[-1].sum())
        return cls(height, levels, np.frombuffer(counts, "<i8"))

    def raised(self, height: int) -> Tree:
        """The same tree in the first quadrant of a larger square."""
        first = [np.array([True, False, False, False])] * (height - self.height)
        return Tree(height, first + self.levels, self.counts)

    def children(self) -> list[np.ndarray]:
        """For each level, the four children of every node; -1 where a quadrant is zero, and a last row of these."""
        made = [np.where(bits, np.cumsum(bits) - 1, -1).reshape(-1, 4) for bits in self.levels]
        return [np.concatenate([rows, np.full((1, 4), -1)]) for rows in made]

    def cells(self) -> np.ndarray:
        """Row of each count."""
        codes = np.zeros(min(1, len(self.counts)), np.int64)
        for bits in self.levels:
            set_bits = np.flatnonzero(bits)
            codes = codes[set_bits // 4] * 2 + (set_bits % 4) // 2
        return codes


def distances(a: Tree, b: Tree, totals_a: np.ndarray, totals_b: np.ndarray, columns: int, same: bool) -> np.ndarray:
    """Sums over ``columns`` terms of the differences of shares, for all rows of ``a`` by all rows of ``b``.

    ``totals`` are the smoothed totals of the rows; ``same`` says that both are one tile: pairs below the diagonal
    are then left out.
    """
    n, m = len(totals_a), len(totals_b)

    def shares(tree: Tree, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = tree.cells()
        zero = np.array([int(share(np.array([SMOOTH]), int(t))[0]) for t in totals], np.int64)
        cell = np.zeros(len(rows), np.int64)
        for row in np.unique(rows).tolist():
            cell[rows == row] = share(tree.counts[rows == row] + SMOOTH, int(totals[row]))
        return zero, cell

    zero_a, cell_a = shares(a, totals_a)
    zero_b, cell_b = shares(b, totals_b)
    below_a, below_b = a.children(), b.children()
    sums = np.zeros((n, m), np.int64)
    edges = np.zeros((n + 1, m + 1), np.int64)  # numbers of columns priced by constants, as steps

    def uniform(row_a, row_b, column, side) -> None:
        width = np.clip(columns - column, 0, side)
        low_a, low_b = np.minimum(row_a, n), np.minimum(row_b, m)
        high_a, high_b = np.minimum(row_a + side, n), np.minimum(row_b + side, m)
        for x, y, sign in ((low_a, low_b, 1), (high_a, high_b, 1), (low_a, high_b, -1), (high_a, low_b, -1)):
            np.add.at(edges, (x, y), sign * width)

    root = [np.array([0 if len(t.counts) else -1]) for t in (a, b)]
    start = np.zeros(1, np.int64)
    stack = [(0, *root, start, start, start)]
    while stack:
        depth, node_a, node_b, row_a, row_b, column = stack.pop()
        side = 1 << (a.height - depth)
        zero = (node_a < 0) & (node_b < 0)
        if zero.any():
            uniform(row_a[zero], row_b[zero], column[zero], side)
            node_a, node_b, row_a, row_b, column = (x[~zero] for x in (node_a, node_b, row_a, row_b, column))
        if not len(node_a):
            continue
        if depth == a.height:
            p = np.where(node_a < 0, zero_a[row_a], cell_a[node_a] if len(cell_a) else 0)
            q = np.where(node_b < 0, zero_b[row_b], cell_b[node_b] if len(cell_b) else 0)
            np.add.at(sums, (row_a, row_b), np.abs(p - q))
            continue
        if len(node_a) > FRONT // 8 and len(node_a) > 1:
            half = len(node_a) // 2
            every = (node_a, node_b, row_a, row_b, column)
            stack += [(depth, *(x[:half] for x in every)), (depth, *(x[half:] for x in every))]
            continue
        side //= 2
        parts = []
        for right in (0, 1):
            for down_a in (0, 1):
                for down_b in (0, 1):
                    parts.append((
                        below_a[depth][node_a, 2 * down_a + right],
                        below_b[depth][node_b, 2 * down_b + right],
                        row_a + down_a * side,
                        row_b + down_b * side,
                        column + right * side,
                    ))
        split = [np.concatenate(x) for x in zip(*parts)]
        inside = (split[2] < n) & (split[3] < m) & (split[4] < columns)
        if same:
            inside &= split[2] <= split[3]
        stack.append((depth + 1, *(x[inside] for x in split)))
    widths = np.cumsum(np.cumsum(edges, 0), 1)[:n, :m]
    return sums + widths * np.abs(zero_a[:, None] - zero_b[None, :])


# --- tiles ---------------------------------------------------------------------------------------------------------


def _numbered(frame: DataFrame, name: str, most: int, tiles: Column) -> DataFrame:
    """Deals the values of ``name`` of every language to tiles and numbers them in each, in ascending order."""
    placed = frame.withColumn("tile", F.pmod(F.xxhash64(name), F.greatest(F.lit(1), tiles)).cast("int"))
    order = Window.partitionBy("lang", "tile").orderBy(name)
    return placed.withColumn("place", F.row_number().over(order) - 1)


def _height(n: int) -> int:
    return max(1, (max(1, n) - 1).bit_length())


def pair_values(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, other, value for all pairs with ``source`` before ``other`` of a language that keeps terms.

    ``groups``: lang, source, smoothed (total of the group plus smoothing); ``counts``: lang, source, term, n.
    """
    n_groups = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / ROWS).alias("tiles"))
    rows = _numbered(groups.join(n_groups, "lang"), "source", ROWS, F.col("tiles"))
    rows = materialize(rows.select("lang", "source", "smoothed", F.col("tile").alias("row_tile"), F.col("place").alias("row")), "rows")
    vocabulary = counts.select("lang", "term").distinct()
    n_terms = vocabulary.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / COLUMNS).alias("tiles"))
    columns = _numbered(vocabulary.join(n_terms, "lang"), "term", COLUMNS, F.col("tiles"))
    columns = materialize(columns.select("lang", "term", F.col("tile").alias("column_tile"), F.col("place").alias("column")), "columns")
    # A tile for every group of rows and of columns, with or without counts. A tile's rows are about ROWS numbers.
    row_tiles = rows.groupBy("lang", "row_tile").agg(F.array_sort(F.collect_list(F.struct("row", "smoothed"))).alias("of_rows"))
    row_tiles = row_tiles.select("lang", "row_tile", F.col("of_rows.smoothed").alias("totals"))
    column_tiles = columns.groupBy("lang", "column_tile").agg(F.count(F.lit(1)).alias("n_columns"))
    every = row_tiles.join(column_tiles, "lang")
    placed = counts.join(columns, ["lang", "term"]).join(rows.select("lang", "source", "row_tile", "row"), ["lang", "source"])
    placed = placed.select("lang", "row_tile", "column_tile", "row", "column", "n")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        place = [table.column(name).to_numpy() for name in ("row", "column", "n")]
        height = _height(int(max(place[0].max(), place[1].max())) + 1)
        bits, values = Tree.of(*place, height).packed()
        names = ["lang", "row_tile", "column_tile", "height", "bits", "counts"]
        return pa.table([pa.array([v.as_py()], v.type) for v in key] + [pa.array([height], pa.int32()), pa.array([bits]), pa.array([values])], names=names)

    schema = "lang string, row_tile int, column_tile int, height int, bits binary, counts binary"
    trees = placed.groupBy("lang", "row_tile", "column_tile").applyInArrow(build, schema)
    tiles = materialize(every.join(trees, ["lang", "row_tile", "column_tile"], "left"), "tiles")
    left = tiles.select(*["lang", "column_tile", "n_columns"], *[F.col(c).alias(f"a_{c}") for c in _OF_TILE])
    right = tiles.select("lang", "column_tile", *[F.col(c).alias(f"b_{c}") for c in _OF_TILE])
    joined = left.join(right, ["lang", "column_tile"]).where("a_row_tile <= b_row_tile")

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                totals = [np.array(row[f"{side}_totals"], np.int64) for side in "ab"]
                height = _height(max(row["n_columns"], *map(len, totals)))
                sides = []
                for side in "ab":
                    tree = Tree(height, [np.zeros(0, bool)] * height, np.zeros(0, np.int64))
                    if row[f"{side}_bits"] is not None:
                        tree = Tree.unpacked(row[f"{side}_height"], row[f"{side}_bits"], row[f"{side}_counts"]).raised(height)
                    sides.append(tree)
                same = row["a_row_tile"] == row["b_row_tile"]
                values = distances(*sides, *totals, row["n_columns"], same)
                x, y = np.nonzero(np.triu(np.ones_like(values), 1) if same else np.ones_like(values))
                size = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["lang"]] * size, pa.string()),
                        pa.array(np.full(size, row["a_row_tile"]), pa.int32()),
                        pa.array(x, pa.int32()),
                        pa.array(np.full(size, row["b_row_tile"]), pa.int32()),
                        pa.array(y, pa.int32()),
                        pa.array(values[x, y], pa.int64()),
                    ],
                    names=["lang", "a_tile", "a", "b_tile", "b", "value"],
                )

    priced = joined.mapInArrow(price, "lang string, a_tile int, a int, b_tile int, b int, value long")
    keys = ["lang", "a_tile", "a", "b_tile", "b"]
    summed = priced.groupBy(*keys).agg(F.sum("value").alias("value"))
    for side, name in (("a", "source"), ("b", "other")):
        own = rows.select("lang", F.col("row_tile").alias(f"{side}_tile"), F.col("row").alias(side), F.col("source").alias(name))
        summed = summed.join(own, ["lang", f"{side}_tile", side])
    return summed.select("lang", "source", "other", "value")


_OF_TILE = ("row_tile", "totals", "height", "bits", "counts")


def audit_sources(
    docs: DataFrame,
    least: int = 30,
    best: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per language and source: lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language with the summed difference of shares. Part ``term``: the ``best``
    terms of which the source has a larger share than its language, with the difference. Ranks go by descending value,
    then by item.

    Null texts, languages and sources count as empty ones. A group without terms has rows of part ``pair`` like others;
    in a language that keeps no term every value is 0. Repeated rows count each; an empty table gives no rows. Further
    columns are not read.
    """
    counts = materialize(kept_counts(docs, least, text_col, lang_col, source_col), "kept_counts")
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang_col), ("source", source_col))]
    groups = docs.select(*empty).distinct()
    n_terms = counts.groupBy("lang").agg(F.count_distinct("term").alias("n_terms"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    smoothed = F.coalesce("total", F.lit(0)) + SMOOTH * F.col("n_terms")
    groups = groups.join(n_terms, "lang", "left").join(sums, ["lang", "source"], "left")
    groups = materialize(groups.select("lang", "source", "n_terms", smoothed.alias("smoothed")), "groups")

    values = pair_values(groups.where("n_terms IS NOT NULL").select("lang", "source", "smoothed"), counts)
    both = values.unionByName(values.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    # A language without kept terms: all of its pairs differ by nothing.
    without = groups.where("n_terms IS NULL").select("lang", "source")
    others = without.select("lang", F.col("source").alias("other"))
    nothing = without.join(others, "lang").where("source <> other").select("*", F.lit(0).cast("long").alias("value"))
    pairs = both.unionByName(nothing).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")

    whole = counts.groupBy("lang").agg(F.sum("n").alias("whole"))
    of_lang = counts.join(groups, ["lang", "source"]).join(whole, "lang")

    def exact(count: str, total: Column) -> Column:
        scaled = F.lit(SCALE).cast("decimal(10,0)") * (F.col(count) + SMOOTH).cast("decimal(20,0)")
        return F.call_function("div", scaled, total.cast("decimal(20,0)"))

    more = exact("n", F.col("smoothed")) - exact("total", F.col("whole") + SMOOTH * F.col("n_terms"))
    terms = of_lang.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), more.alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = terms.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
