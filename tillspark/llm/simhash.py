"""SimHash near-duplicates by a binary trie self-join.

A fingerprint is the majority of the 64-bit hashes of a document's word
shingles. Distinct fingerprints are joined with themselves in binary tries: pairs
of nodes are walked down together, their differing bits are added up, and a pair
over the error budget is pruned, and so is a pair whose fingerprints all hang
together already. What comes out is a spanning set of links, not all pairs.

The join is dealt out by tries with other bit orders. With the bits cut into
`blocks`, two fingerprints within the budget agree on `blocks - budget` of them,
so they meet in the trie that puts those blocks first, under one node there. That
node is one group; more blocks make longer prefixes, and the number of blocks is
chosen by the number of fingerprints so that groups stay small. A group that is
still over `group_rows` is cut into parts, and every pair of parts is a group of
its own. A task takes many groups, whose node pairs share one frontier. Copies of a
fingerprint are one row throughout.

Null and empty texts have fingerprint zero and are linked like any other. A
null doc_id is ignored as a component id; if a component has no other, its id is
null. Repeated rows fall together. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.components import smallest_reachable
from tillspark.llm.text import byte_column, with_column
from tillspark.operators.lookup import lookup
from tillspark.sources.staging import stage, stage_counted

BITS = 64
SHINGLE = 4
BUDGET = 4
SEED = 42
MEAN_GROUP = 64
GROUP_ROWS = 8_000
TASK_ROWS = 100_000
# Node pairs of a trie that are walked together: a large group of near copies leaves up to four
# times as many waiting at every level.
PAIRS_AT_ONCE = 32_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if set in over half of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(plain[i:j], SEED) for i, j in zip(starts, stops)])
    ones = np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, len(rows), 1 << 15):
        ones += np.unpackbits(rows[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`docs` with `fp`, the fingerprint as a signed 64-bit number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle) for text in byte_column(batch, "text")]
            values = np.array(found, np.uint64).view(np.int64)
            yield with_column(batch, "fp", values, pa.int64())

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], "fp long"])
    return docs.mapInArrow(add, schema)


def _orders(count: int, budget: int) -> list[tuple[int, np.ndarray]]:
    """(bits of the shared prefix, order of all bits) of each trie."""
    blocks = budget + 1
    while count >> (BITS * (blocks - budget) // blocks) > MEAN_GROUP and comb(blocks, budget) < 100:
        blocks += 1
    cuts = np.array_split(np.arange(BITS), blocks)
    orders = []
    for agreed in combinations(range(blocks), blocks - budget):
        first = np.concatenate([cuts[b] for b in agreed])
        rest = np.setdiff1d(np.arange(BITS), first)
        orders.append((len(first), np.concatenate([first, rest])))
    return orders


def _reordered(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for bit in order:
        out = (out << np.uint64(1)) | ((values >> np.uint64(BITS - 1 - bit)) & np.uint64(1))
    return out


def fingerprint_links(distinct: DataFrame, count: int, budget: int = BUDGET,
                      group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) that connect all of `distinct` (fp) that are within `budget` bits."""
    orders = _orders(count, budget)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for trie, (prefix, order) in enumerate(orders):
                moved = _reordered(values, order)
                node = (moved >> np.uint64(BITS - prefix)).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "trie": np.full(len(values), trie, np.int32),
                        "node": node,
                        "moved": moved.view(np.int64),
                        "fp": values.view(np.int64),
                    }
                )

    nodes = distinct.select("fp").mapInArrow(dealt, "trie int, node long, moved long, fp long")
    nodes = stage(nodes, "simhash-nodes")
    sizes = nodes.groupBy("trie", "node").agg(F.count("*").alias("n")).where("n > 1")
    nodes = nodes.join(sizes, ["trie", "node"])
    # A large group's fingerprints are cut into `parts` sub-tries; a task gets two of them.
    parts = F.ceil(F.col("n") / group_rows).cast("int")
    nodes = nodes.withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    pairs = nodes.select("trie", "node", "moved", "fp", "part", other).select(
        "trie", "node", "moved", "fp",
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
    )

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        moved = rows["moved"].to_numpy().view(np.uint64)
        keys = [rows[name].to_numpy() for name in ("high", "low", "trie")]
        order = np.lexsort((moved, keys[0], keys[1], rows["node"].to_numpy(), keys[2]))
        moved = moved[order]
        new = np.ones(len(order), bool)
        new[1:] = moved[1:] < moved[:-1]
        for values in (*keys, rows["node"].to_numpy()):
            new[1:] |= np.diff(values[order]) != 0
        label = trie_components(moved, np.flatnonzero(new), budget)
        own = rows["fp"].to_numpy()[order]
        linked = label != np.arange(len(label))
        return pd.DataFrame({"a": own[linked], "b": own[label[linked]]})

    tasks = 1 + count * len(orders) // TASK_ROWS
    task = F.pmod(F.xxhash64("trie", "node", "low", "high"), F.lit(tasks))
    return pairs.groupBy(task.alias("task")).applyInPandas(connect, "a long, b long")


def trie_components(values: np.ndarray, heads: np.ndarray, budget: int) -> np.ndarray:
    """Least index that each value reaches within its group by steps of `budget` bits.

    Groups start at `heads` and hold ascending distinct values. A node of a trie is
    a range of values that share their leading bits. The frontier of node pairs
    starts with each group's root and itself, and is walked depth-first in pieces.
    """
    label = np.arange(len(values))
    ends = np.append(heads[1:], len(values))
    roots = np.stack([heads, ends, heads, ends, np.zeros_like(heads)], 1)[ends - heads > 1]
    stack = [(0, roots)]
    while stack:
        depth, pairs = stack.pop()
        pairs = pairs[_open(pairs, label)]
        single = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        ends = pairs[single]
        if len(ends):
            apart = np.bitwise_count(values[ends[:, 0]] ^ values[ends[:, 2]])
            near = ends[apart <= budget]
            label = _hooked(label, near[:, 0], near[:, 2])
        pairs = pairs[~single]
        if not len(pairs):
            continue
        below = _children(values, pairs, depth, budget)
        for at in range(0, len(below), PAIRS_AT_ONCE):
            stack.append((depth + 1, below[at : at + PAIRS_AT_ONCE]))
    return label


def _open(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Pairs that can still join two components: not a value with itself, not all one label."""
    low = np.minimum(label[pairs[:, 0]], label[pairs[:, 2]])
    changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
    one = (changes[pairs[:, 1] - 1] == changes[pairs[:, 0]]) & (
        changes[pairs[:, 3] - 1] == changes[pairs[:, 2]]
    )
    return ~(one & (label[pairs[:, 0]] == low) & (label[pairs[:, 2]] == low))


def _children(values: np.ndarray, pairs: np.ndarray, depth: int, budget: int) -> np.ndarray:
    bit = np.uint64(BITS - 1 - depth)
    ones = np.concatenate(([0], np.cumsum((values >> bit) & np.uint64(1)).astype(np.int64)))

    def middle(first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return end - (ones[end] - ones[first])

    a, b, c, d, error = pairs.T
    left, right = middle(a, b), middle(c, d)
    whole = np.concatenate(
        [
            np.stack([a, left, c, right, error], 1),
            np.stack([left, b, right, d, error], 1),
            np.stack([a, left, right, d, error + 1], 1),
            np.stack([left, b, c, right, error + 1], 1)[a != c],  # a node with itself: once
        ]
    )
    filled = (whole[:, 0] < whole[:, 1]) & (whole[:, 2] < whole[:, 3])
    return whole[filled & (whole[:, 4] <= budget)]


def _hooked(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]: hang roots on smaller ones until nothing changes."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
    return label


def grouped(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, fp, root (the least fingerprint of the component) and component_id of every row."""
    wanted = list(dict.fromkeys([*keep, "doc_id", "text"]))
    marked = fingerprints(docs.select(*wanted), shingle)
    marked = stage(marked.select(*dict.fromkeys([*keep, "doc_id"]), "fp"), "simhash-fingerprints")
    least, count = stage_counted(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct"
    )
    roots = smallest_reachable(fingerprint_links(least, count, budget))
    roots = stage(least.join(roots, least["fp"] == roots["node"], "left")
                  .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.select("fp", "root").join(named, "root")
    # A fingerprint that a third of all rows have, as empty texts or copies do, is one key.
    return lookup(marked, named, "fp", ["doc_id"], at_most=count).select(
        *keep, "fp", "root", "component_id"
    )


def components(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET,
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, fp and component_id of every row."""
    return grouped(docs, shingle, budget, keep).drop("root")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row of `docs` for each component: that with the smallest doc_id.

    Of rows that share it, the first by a hash of the text, then by the other columns, stays.
    Rows without a doc_id all stay.
    """
    text = F.coalesce("text", F.lit(""))
    key = ["doc_id", "_text_a", "_text_b"]
    keyed = docs.withColumns(dict(zip(key[1:], (F.xxhash64(text), F.xxhash64(F.lit(SEED), text)))))
    found = grouped(keyed, shingle, budget, tuple(key)).where("doc_id = component_id")
    chosen = found.groupBy("root").agg(F.min(F.struct(*key)).alias("row")).select("row.*")
    rest = [c for c in docs.columns if c != "doc_id"]
    small = F.to_json(F.struct(*[c for c in rest if c != "text"], F.lit(0).alias("_")))
    one = keyed.join(chosen, key, "left_semi").groupBy(*key).agg(
        F.min_by(F.struct(*rest), small).alias("_row")
    )
    kept = one.select("doc_id", "_row.*").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
