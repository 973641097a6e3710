"""Ranked lexical search over an index whose documents are grouped by length.

A document's score for a query adds, for every term of the query, ``weight * (10**9 * tf div (1000 * tf + 12 * m))``,
where ``m`` grows with the length of the document. Documents with the same ``m`` form a stratum: in it a term's impact
depends on ``tf`` alone, so impacts are computed once per stratum and ``tf``, and the largest ``tf`` of a term bounds
what it can add there. A query visits strata in descending order of their bounds and stops where no bound reaches the
worst of its best documents.

The index is a table: blocks of documents, numbered by length, and per block and term the documents that hold it, by
length and descending ``tf``. It is built in one pass over the texts without a shuffle, since ``m`` follows from the
length once the corpus is counted. A search reads the postings of its own terms only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm.common import ids_and_texts, slices
from tablejobs.storage import materialize

#: Bytes of text a block holds, or one document.
BLOCK = 16_000_000
#: Terms of queries that search a block together.
GROUP_TERMS = 200_000
#: Distinct terms up to which a list of weights is sent to every task; beyond, Spark shuffles postings to it.
BROADCAST_TERMS = 100_000
#: Strata a query visits before it looks at its bounds again, at first.
FIRST_VISIT = 4

#: Letters A-Z in lower case; what is neither a letter, a digit nor outside ASCII becomes a space.
TERMS = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERMS).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all rows of ``docs``, written to the shared folder: block, term, docs, tfs, ids.

    A block's row without term holds the ids of its documents (``ids``) and their numbers of terms (``docs``). Null and
    empty texts are documents without terms; null ids and repeated rows are documents like others.
    """
    source = ids_and_texts(docs, id_col, text_col)
    schema = T.StructType.fromDDL("block string, term binary, docs array<int>, tfs array<int>")
    schema = schema.add("ids", T.ArrayType(source.schema["id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, 1, BLOCK):
                yield from block(types, f"{task}-{number}", part.column(0), part.column(1).to_pylist())
                number += 1

    def block(types: pa.Schema, name: str, ids: pa.Array, texts: list) -> Iterator[pa.RecordBatch]:
        cut = pc.split_pattern(pa.array([(t or "").encode().translate(TERMS) for t in texts], pa.binary()), b" ")
        words = cut.flatten().dictionary_encode()
        codes = words.indices.to_numpy()
        owner = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
        empty = pc.index(words.dictionary, pa.scalar(b"", pa.binary())).as_py()
        codes, owner = codes[codes != empty], owner[codes != empty]
        lengths = np.bincount(owner, minlength=len(texts))
        order = np.argsort(lengths, kind="stable")
        place = np.empty(len(texts), np.int64)
        place[order] = np.arange(len(texts))
        sizes = lengths[order].astype(np.int32)

        def lists(values, offsets, kind) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

        own = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), ids.take(pa.array(order)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name]),
                pa.array([None], pa.binary()),
                lists(sizes, [0, len(sizes)], pa.int32()).cast(types.field("docs").type),
                pa.nulls(1, types.field("tfs").type),
                own.cast(types.field("ids").type),
            ],
            schema=types,
        )
        if not len(codes):
            return
        entries, tfs = np.unique(codes * np.int64(len(texts)) + place[owner], return_counts=True)
        term, doc = entries // len(texts), entries % len(texts)
        by = np.lexsort((doc, -tfs, sizes[doc], term))
        term, doc, tfs = term[by], doc[by].astype(np.int32), tfs[by].astype(np.int32)
        begins = np.flatnonzero(np.diff(term, prepend=-1))
        ends = np.append(begins, len(term))
        names = words.dictionary.take(pa.array(term[begins]))
        for i in range(0, len(begins), 50_000):
            offsets = ends[i : i + 50_001]
            rows = len(offsets) - 1
            span = slice(int(offsets[0]), int(offsets[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * rows),
                    names.slice(i, rows),
                    lists(doc[span], offsets - offsets[0], pa.int32()).cast(types.field("docs").type),
                    lists(tfs[span], offsets - offsets[0], pa.int32()).cast(types.field("tfs").type),
                    pa.nulls(rows, types.field("ids").type),
                ],
                schema=types,
            )

    return materialize(source.mapInArrow(run, schema), "ranked_index")


class BlockSearch:
    """The strata of a block and the postings of some terms in it."""

    def __init__(self, lengths: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], documents: int, total: int):
        """``postings``: documents and tfs of each term; ``documents``, ``total``: those with terms, and their terms."""
        sizes, back = np.unique(lengths, return_inverse=True)
        # Plain integers: the product may need more than 64 bits.
        normal = np.array([75 + 25 * n * documents // total for n in sizes.tolist()], np.int64)
        values, of_size = np.unique(normal, return_inverse=True)
        stratum = of_size[back] if len(lengths) else np.zeros(0, np.int64)
        self.n_docs, self.n_strata = len(lengths), len(values)
        counts = np.array([len(docs) for docs, _ in postings], np.int64)
        self.docs = np.concatenate([docs for docs, _ in postings]) if postings else np.zeros(0, np.int64)
        tfs = np.concatenate([tfs for _, tfs in postings]).astype(np.int64) if postings else np.zeros(0, np.int64)
        # One impact for each stratum and tf.
        width = int(tfs.max()) + 1 if len(tfs) else 1
        pairs, of_pair = np.unique(stratum[self.docs] * np.int64(width) + tfs, return_inverse=True)
        tf, m = pairs % width, values[pairs // width]
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 12 * m))[of_pair]
        # Runs: the documents of one term in one stratum, with the largest impact among them.
        of_term = np.repeat(np.arange(len(postings)), counts)
        key = of_term * np.int64(max(1, self.n_strata)) + stratum[self.docs]
        self.begin = np.flatnonzero(np.diff(key, prepend=-1))
        self.end = np.append(self.begin[1:], len(key))
        self.run_stratum = stratum[self.docs[self.begin]]
        self.best = np.maximum.reduceat(self.impact, self.begin) if len(key) else np.zeros(0, np.int64)
        self.runs_of = np.searchsorted(of_term[self.begin], np.arange(len(postings) + 1))

    def top(self, query: list[tuple[int, int]], k: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best: (term, weight) in ``query``; ``rank`` orders documents of one score."""
        runs = [np.arange(self.runs_of[t], self.runs_of[t + 1]) for t, _ in query]
        weights = np.repeat(np.array([w for _, w in query], np.int64), [len(r) for r in runs])
        runs = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        bound = np.zeros(self.n_strata, np.int64)
        np.add.at(bound, self.run_stratum[runs], weights * self.best[runs])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        # Runs in the order in which their strata are visited.
        turn = np.full(self.n_strata, len(order))
        turn[order] = np.arange(len(order))
        by = np.argsort(turn[self.run_stratum[runs]], kind="stable")
        runs, weights = runs[by], weights[by]
        turns = turn[self.run_stratum[runs]]
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, FIRST_VISIT
        while at < len(order):
            if len(found) == k and bound[order[at]] < scores[-1]:
                break  # an equal bound may hide an equal score with a lower id
            low, high = np.searchsorted(turns, [at, at + step])
            some, sizes = runs[low:high], (self.end - self.begin)[runs[low:high]]
            places = np.repeat(self.begin[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            docs, back = np.unique(self.docs[places], return_inverse=True)
            own = np.zeros(len(docs), np.int64)
            np.add.at(own, back, np.repeat(weights[low:high], sizes) * self.impact[places])
            found, scores = np.concatenate([found, docs[own > 0]]), np.concatenate([scores, own[own > 0]])
            kept = np.lexsort((rank[found], -scores))[:k]
            found, scores = found[kept], scores[kept]
            at, step = at + step, step * 2
        return found, scores


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item (a number of its own for each row), id, term, n; rows without terms give none."""
    source = ids_and_texts(queries, id_col, text_col).withColumn("item", F.monotonically_increasing_id())
    schema = T.StructType([source.schema["item"], source.schema["id"], *T.StructType.fromDDL("term binary, n long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, n = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for word, count in sorted(_counted(terms(text)).items()):
                    row.append(i)
                    term.append(word)
                    n.append(count)
            at = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(term, pa.binary()), pa.array(n, pa.int64())],
                names=schema.names,
            )

    return materialize(source.select("item", "id", "text").mapInArrow(run, schema), "query_terms")


def _counted(words: list[bytes]) -> dict[bytes, int]:
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    return counts


def rank_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``search`` over an index made for it."""
    return search(build_index(docs, id_col, text_col), queries, k, item_col, item_text_col)


def search(index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of every row of ``queries``: item, rank (from 1), id, score; all with a score above 0 if fewer.

    Equal scores are ordered by ascending document id, a null id last. A query without terms, or whose terms occur
    nowhere, gives no rows; repeated queries are answered each, a null id stays null. An index without documents and
    an empty table of queries give no rows. The result is exact: bounds only spare work.
    """
    blocks, postings = index.where("term IS NULL"), index.where("term IS NOT NULL")
    one = blocks.select(
        F.sum(F.size(F.filter("docs", lambda n: n > 0)).cast("long")),
        F.sum(F.aggregate("docs", F.lit(0).cast("long"), lambda a, n: a + n)),
    ).first()
    documents, total = one[0] or 0, one[1] or 0
    wanted = query_terms(queries, id_col, text_col)
    kind, key = index.schema["ids"].dataType.elementType, wanted.schema["id"]
    n_terms, n_rows = wanted.select(F.count_distinct("term"), F.count(F.lit(1))).first()
    if not total or not n_terms:
        spark = index.sparkSession
        empty = T.StructType([T.StructField("item", key.dataType), T.StructField("rank", T.IntegerType())])
        return spark.createDataFrame([], empty.add("id", kind).add("score", "long"))

    def held(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if n_terms <= BROADCAST_TERMS else frame

    found = postings.join(held(wanted.select("term").distinct()), "term", "left_semi")
    df = found.groupBy("term").agg(F.sum(F.size("docs").cast("long")).alias("df"))
    odds = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weighted = df.select("term", F.floor(F.lit(1000.0) * F.log(odds)).alias("w")).where("w > 0")
    groups = max(1, -(-n_rows // GROUP_TERMS))
    of_group = wanted.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int")).join(weighted, "term")
    # A term's queries within a group: at most GROUP_TERMS of them, or those of one query.
    lists = of_group.groupBy("group", "term").agg(
        F.collect_list(F.struct("item", (F.col("n") * F.col("w")).alias("w"))).alias("queries")
    )
    lists = materialize(lists, "query_lists")
    needed = postings.join(held(lists), "term").select("block", "group", "queries", "docs", "tfs", "ids")
    no_queries = F.lit(None).cast(lists.schema["queries"].dataType).alias("queries")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    needed = needed.unionByName(blocks.select("block", numbers, no_queries, "docs", "tfs", "ids"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths, ids, postings, by_item = None, None, [], {}
        for batch in table.to_batches():
            for i in range(batch.num_rows):
                of_query = batch.column("queries")[i].as_py()
                numbers = batch.column("docs")[i].values.to_numpy(zero_copy_only=False)
                if of_query is None:
                    lengths, ids = numbers, batch.column("ids")[i].values
                    continue
                for one in of_query:
                    by_item.setdefault(one["item"], []).append((len(postings), one["w"]))
                postings.append((numbers, batch.column("tfs")[i].values.to_numpy(zero_copy_only=False)))
        block = BlockSearch(lengths, postings, documents, total)
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        items, places, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for item, query in by_item.items():
            docs, points = block.top(query, k, rank)
            items += [item] * len(docs)
            places.append(docs)
            scores.append(points)
        return pa.table({
            "item": pa.array(items, pa.int64()),
            "id": ids.take(pa.array(np.concatenate(places))),
            "score": pa.array(np.concatenate(scores), pa.int64()),
        })

    schema = T.StructType().add("item", "long").add("id", kind).add("score", "long")
    best = needed.groupBy("block", "group").applyInArrow(run, schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = wanted.select("item", F.col("id").alias("of_item")).distinct()
    return best.join(names, "item").select(F.col("of_item").alias("item"), "rank", "id", "score")
