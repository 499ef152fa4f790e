"""Ranked lexical search: item tiles times document tiles, as dense matrix products.

Each document is read once: its terms are looked up in the compact vocabulary of the items
and the counts are staged as tiles of some hundred documents, with what the corpus
statistics need. From these come the numbers of documents N and of terms L and the document
frequency of every item term, and from those the weights.

A tile of items (rows) and the terms it has in common with a tile of documents (columns)
give two dense float64 matrices, weights times repeats and document impacts; their BLAS
product adds up the scores. All entries are whole numbers, and the columns are cut so that
no partial sum reaches 2^53, so every product is exact in whatever order it is added;
products of several cuts are added as 64-bit integers. A task keeps the best `top` of each
item over its tiles. Ties are decided by doc_id before anything is cut, in a tile, in a
task and over all tasks, so the result does not depend on how rows are dealt.

Items are taken in blocks of about `block_words` words, so what is sent to tasks is bounded;
each block reads the documents once.

A null text has no terms. An item without terms, or whose terms no document has, gets no
rows; every row of the items is ranked on its own, so a repeated one is answered twice. A
null doc_id ranks after all others of its score and comes back null; rows that share a
doc_id are ranked each. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillspark.llm.text import byte_column, packed, runs_of, unpacked
from tillspark.sources.staging import stage

TOP = 20
BLOCK_WORDS = 500_000
TILE_BYTES = 1 << 20
TILE_DOCS = 512
TILE_ITEMS = 256
TILE_TERMS = 2_048
SAFE = 1 << 53
LAST = np.iinfo(np.int64).max  # stands for a null doc_id while rows are ordered
DEALT = 1_024

# Letters and digits stay, A-Z become lower case, bytes of other characters stay, the rest parts.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class Items:
    """The items of a block: their vocabulary, and (item, term, repeats) sorted by item."""

    def __init__(self, texts: list[bytes]):
        self.vocabulary: dict[bytes, int] = {}
        rows: list[tuple[int, int, int]] = []
        for item, text in enumerate(texts):
            for term, times in Counter(terms(text)).items():
                rows.append((item, self.vocabulary.setdefault(term, len(self.vocabulary)), times))
        table = np.array(rows, np.int64).reshape(-1, 3)
        self.count = len(texts)
        self.item, self.term, self.times = table.T
        self.weight = np.zeros(len(self.vocabulary), np.int64)

    def weighted(self, frequency: dict[int, int], documents: int) -> Items:
        """With the weight of every term; a term that no document has weighs nothing."""
        for term, df in frequency.items():
            self.weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        return self


def tiles(docs: DataFrame, vocabulary) -> DataFrame:
    """Rows of some hundred documents: n_docs and n_terms for the statistics; ids, sizes, and
    per document the item terms it has and how often, packed. `vocabulary` is a broadcast."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, texts = batch.column(0), byte_column(batch, "text")
            for run in runs_of([len(t) for t in texts], TILE_BYTES):
                for first in range(run.start, run.stop, TILE_DOCS):
                    rows = slice(first, min(first + TILE_DOCS, run.stop))
                    yield _tile(ids[rows.start : rows.stop], texts[rows], known)

    schema = (
        "n_docs long, n_terms long, ids array<long>, sizes array<long>, "
        "held binary, terms binary, times binary"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, schema)


def _tile(ids: pa.Array, texts: list[bytes], known: dict[bytes, int]) -> pa.RecordBatch:
    split = [terms(text) for text in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    codes = chain.from_iterable(map(known.get, row, repeat(-1)) for row in split)
    codes = np.fromiter(codes, np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(split)), sizes)[codes >= 0]
    width = max(1, len(known))
    pairs, times = np.unique(doc * width + codes[codes >= 0], return_counts=True)
    held = np.bincount(pairs // width, minlength=len(split))
    return pa.RecordBatch.from_pydict(
        {
            "n_docs": [int((sizes > 0).sum())],
            "n_terms": [int(sizes.sum())],
            "ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "held": [packed(held.astype(np.int32))],
            "terms": [packed((pairs % width).astype(np.int32))],
            "times": [packed(times.astype(np.int32))],
        }
    )


def _frequencies(tiled: DataFrame, width: int) -> dict[int, int]:
    """Documents that hold each item term: folded per task, then by Spark; one row per term."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                total += np.bincount(unpacked(blob.as_py(), np.int32), minlength=width)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": term, "df": total[term]})

    folded = tiled.select("terms").mapInArrow(fold, "term long, df long")
    return {r[0]: int(r[1]) for r in folded.groupBy("term").agg(F.sum("df")).collect()}


def impacts(times: np.ndarray, sizes: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m) for each count, m from the size of its document."""
    if int(sizes.max(initial=0)) * 25 * documents >= 1 << 62:
        m = np.array([75 + 25 * int(n) * documents // all_terms for n in sizes], np.int64)
    else:
        m = 75 + (25 * sizes * documents) // max(all_terms, 1)
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def cuts(bounds: np.ndarray, most: int = TILE_TERMS, safe: int = SAFE) -> Iterator[slice]:
    """Columns in runs of at most `most` whose bounds add up to less than `safe`."""
    start, held = 0, 0
    for at, bound in enumerate(bounds.tolist()):
        if at > start and (at - start >= most or held + bound >= safe):
            yield slice(start, at)
            start, held = at, 0
        held += bound
    if start < len(bounds):
        yield slice(start, len(bounds))


def scores(wanted: np.ndarray, impact: np.ndarray, safe: int = SAFE) -> np.ndarray:
    """Exact product of item weights (items x terms) and impacts (terms x documents), both whole."""
    total = np.zeros((wanted.shape[0], impact.shape[1]), np.int64)
    bounds = wanted.max(axis=0, initial=0).astype(np.int64) * impact.max(axis=1, initial=0).astype(np.int64)
    for run in cuts(bounds, safe=safe):
        if bounds[run.start] >= safe:  # one term repeated too often for a double
            total += np.outer(wanted[:, run].astype(np.int64), impact[run].astype(np.int64))
        else:
            total += (wanted[:, run] @ impact[run]).astype(np.int64)
    return total


class Best:
    """The best `top` documents of each item so far: item, score, doc_id and whether it is null."""

    def __init__(self, count: int, top: int):
        self.top = top
        self.rows = np.empty((4, 0), np.int64)
        self.floor = np.ones(count, np.int64)  # the least score that can still come in

    def add(self, items: np.ndarray, found: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(found >= self.floor[items][:, None])
        new = np.stack([items[item], found[item, doc], ids[doc], null[doc]])
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        heads = np.flatnonzero(np.diff(rows[0], prepend=-1))
        place = np.arange(rows.shape[1]) - np.repeat(heads, np.diff(np.append(heads, rows.shape[1])))
        self.rows = rows[:, place < self.top]
        full = rows[:, place == self.top - 1]
        self.floor[full[0]] = full[1]


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block_words: int = BLOCK_WORDS,
    tile_items: int = TILE_ITEMS,
    safe: int = SAFE,
) -> DataFrame:
    """item_id, rank, doc_id and score of the `top` documents of every item."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * block_words)))  # a term and its gap take 2 characters or more
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    answers = [
        _search_block(docs, items.where(block == at).select("item_id", "text"), top, tile_items, safe)
        for at in range(blocks)
    ]
    whole = answers[0]
    for more in answers[1:]:
        whole = whole.unionByName(more)
    return whole


def _search_block(
    docs: DataFrame, items: DataFrame, top: int, tile_items: int, safe: int
) -> DataFrame:
    spark = docs.sparkSession
    rows = items.collect()
    held = Items([(r["text"] or "").encode() for r in rows])
    tiled = stage(tiles(docs, spark.sparkContext.broadcast(held.vocabulary)), "search-tiles")
    documents, all_terms = (
        int(x or 0) for x in tiled.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    )
    sent = spark.sparkContext.broadcast(
        held.weighted(_frequencies(tiled, len(held.vocabulary)), documents)
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        best = Best(wanted.count, top)
        for batch in batches:
            for row in batch.to_pylist():
                _rank_tile(best, wanted, row, documents, all_terms, tile_items, safe)
        item, score, doc_id, null = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc_id, mask=null.astype(bool)), pa.array(score)],
            names=["item", "doc_id", "score"],
        )

    found = tiled.select("ids", "sizes", "held", "terms", "times").mapInArrow(
        rank, "item long, doc_id long, score long"
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Every task sends `top` rows an item; two steps keep an item's rows of all tasks apart.
    for by in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(DEALT))], ["item"]):
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
        found = found.where(F.col("rank") <= top)
    kind = items.schema["item_id"].dataType
    names = spark.createDataFrame(
        [(at, r["item_id"]) for at, r in enumerate(rows)], f"item long, item_id {kind.simpleString()}"
    )
    # One row per item of the block.
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _rank_tile(best: Best, wanted: Items, row: dict, documents: int, all_terms: int,
               tile_items: int, safe: int) -> None:
    sizes = np.array(row["sizes"], np.int64)
    term = unpacked(row["terms"], np.int32).astype(np.int64)
    times = unpacked(row["times"], np.int32).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), unpacked(row["held"], np.int32))
    impact = impacts(times, sizes[doc], documents, all_terms)
    ids = np.array([LAST if x is None else x for x in row["ids"]], np.int64)
    null = np.array([x is None for x in row["ids"]], np.int64)
    present = np.unique(term)
    for first in range(0, wanted.count, tile_items):
        i, j = np.searchsorted(wanted.item, (first, first + tile_items))
        item, asked = wanted.item[i:j] - first, wanted.term[i:j]
        shared = np.intersect1d(present, asked)
        if not len(shared):
            continue
        rows = np.arange(first, min(first + tile_items, wanted.count))
        left = np.zeros((len(rows), len(shared)))
        chosen = np.isin(asked, shared)
        column = np.searchsorted(shared, asked[chosen])
        left[item[chosen], column] = wanted.weight[asked[chosen]] * wanted.times[i:j][chosen]
        right = np.zeros((len(shared), len(sizes)))
        chosen = np.isin(term, shared)
        right[np.searchsorted(shared, term[chosen]), doc[chosen]] = impact[chosen]
        best.add(rows, scores(left, right, safe), ids, null)
