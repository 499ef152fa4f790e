"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

A text is the set of its distinct five-word shingles; two texts are linked from a Jaccard
similarity of `PERCENT` on. Equal texts are one class throughout, found by two 64-bit hashes.

A set can only be linked with another if that share of it lies in some other set. So a first
pass, over all texts, counts for every class how many of its shingles another class has: tasks
send shortened hashes, sorted and packed, to the range of hashes they belong to, which answers
with counts. Shortened hashes can only make this count too large. Rows are one for each task's
share of a range, and never more than shingles. Classes that fall short take no further part.

The others are put in rare-first order: by the number of classes that hold a shingle, then by
its hash. Of n shingles the first n - ceil(p n / 100) + 1 are the prefix, and linked sets share
one there. All classes that hold a prefix shingle meet in the group of the least of them, the
pivot; a class is sent once to each of its pivots, however many shingles lead there. In a group,
a set is compared with the larger ones after it: those within the length limit that share prefix
shingles, whose first shared one belongs to this group (so a pair is verified once, in one
group), whose places in the order leave room for enough shared shingles (positional filter), and
whose shingles, counted by `BINS` ranges of hashes, could overlap enough (suffix filter). What
passes is verified by the whole sets. Pairs whose classes already hang together are passed over,
and only links that join two components come out, so a group of copies gives no pairs of its own.

A group of over `part_rows` classes is first compared with its pivot. Classes linked with it need
no comparison among themselves; the rest are cut into parts, and each part meets every other part
in a task of its own. Nothing is cut off, capped or sampled.

Fewer than five words are one shingle; no words are none, and link with nothing. A null text has
no words. A null doc_id is ignored as a component id; a component that has no other is null.
Repeated rows fall together. Extra columns are ignored; an empty table gives no rows. Shingles
are compared by 64-bit hashes, and classes that have near copies are named by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.components import smallest_reachable
from tillspark.llm.text import byte_column, mixed, packed, runs_of, unpacked
from tillspark.operators.lookup import lookup
from tillspark.sources.staging import stage, stage_counted

SHINGLE = 5
PERCENT = 80
SEED = 42
CHUNK_BYTES = 4 << 20
SENT_BYTES = 16 << 20
RANGE_CHARS = 10 << 20
SPARE_BITS = 6
PART_ROWS = 2_000
PART_TOKENS = 2_000_000
TASK_TOKENS = 2_000_000
PIVOTS_SENT = 200
BINS = 64

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
SHORT = _random.integers(0, 1 << 64, SHINGLE, np.uint64)


def shingled(texts: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct shingles of all texts, by hash, then text."""
    rows = [text.lower().split() for text in texts]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    total = int(sizes.sum())
    known: dict[bytes, int] = {}
    codes = np.fromiter(map(known.setdefault, chain.from_iterable(rows), count()), np.int64, total)
    digests = np.zeros(total, np.uint64)
    digest = xxhash.xxh64_intdigest
    digests[np.fromiter(known.values(), np.int64, len(known))] = np.fromiter(
        (digest(word, SEED) for word in known), np.uint64, len(known)
    )
    digests = digests[codes]
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(rows)), sizes)
    at = np.flatnonzero(np.arange(total) + shingle <= ends[text])
    tokens = np.zeros(len(at), np.uint64)
    for k in range(shingle):
        tokens += digests[at + k] * FACTORS[k]
    text = text[at]
    few = np.flatnonzero((sizes > 0) & (sizes < shingle))
    short = np.array(
        [(digests[ends[k] - sizes[k] : ends[k]] * FACTORS[: sizes[k]]).sum() for k in few], np.uint64
    )
    tokens = mixed(np.concatenate([tokens, short + SHORT[sizes[few]]]))
    text = np.concatenate([text, few])
    order = np.lexsort((text, tokens)) if len(few) else np.argsort(tokens, kind="stable")
    tokens, text = tokens[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(tokens) != 0) | (np.diff(text) != 0)
    return tokens[new], text[new]


def hashed(docs: DataFrame) -> DataFrame:
    """`docs` with a and b, two hashes of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"a": F.xxhash64(text), "b": F.xxhash64(F.lit(SEED), text)})


def shared_counts(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """a, b, size (of the set) and shared (how many of it another text may have) of every
    distinct text of `docs` (a, b, text)."""
    total = int(docs.agg(F.sum(F.length("text"))).first()[0] or 0)
    ranges = 1 + total // range_chars
    bits = min(64, SPARE_BITS + total.bit_length())
    cuts = np.array([-(-(k << bits) // ranges) for k in range(1, ranges)], np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sent = TaskContext.get().partitionId(), 0
        held = _Sent(ranges)
        for batch in batches:
            texts = byte_column(batch, "text")
            a, b = (batch.column(k).to_numpy() for k in (0, 1))
            for part in runs_of([len(t) for t in texts], CHUNK_BYTES):
                held.add(a[part], b[part], texts[part], cuts, bits)
                if held.bytes >= SENT_BYTES:
                    yield held.rows((task << 24) + sent)
                    held, sent = _Sent(ranges), sent + 1
        if held.sizes:
            yield held.rows((task << 24) + sent)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        heads = rows[rows["a"].notna()]
        rows = rows[rows["a"].isna()]
        tokens, owners, origin = [], [], []
        for at, (first, second) in enumerate(zip(rows["tokens"], rows["holders"])):
            for gaps, holders in zip(first, second, strict=True):
                tokens.append(np.cumsum(unpacked(gaps, np.uint64)))
                owners.append(unpacked(holders, np.uint32).astype(np.int64) + (at << 32))
        out = heads[["chunk", "a", "b", "sizes"]].assign(holders=None, counts=None)
        if not tokens:
            return out
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        owner = owner[np.repeat(several, np.diff(np.append(first, len(token))))]
        owner, times = np.unique(owner, return_counts=True)
        ends = np.searchsorted(owner, np.arange(len(rows) + 1) << 32)
        answers = pd.DataFrame({"chunk": rows["chunk"], "a": None, "b": None, "sizes": None})
        answers["holders"] = [
            packed((owner[i:j] & 0xFFFFFFFF).astype(np.uint32)) for i, j in zip(ends, ends[1:])
        ]
        answers["counts"] = [packed(times[i:j].astype(np.uint32)) for i, j in zip(ends, ends[1:])]
        return pd.concat([out, answers[np.diff(ends) > 0]])

    def total_up(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows[rows["a"].notna()].iloc[0]
        shared = np.zeros(len(head["a"]), np.int64)
        for holders, counts in zip(rows["holders"], rows["counts"], strict=True):
            if holders is not None:
                shared[unpacked(holders, np.uint32)] += unpacked(counts, np.uint32)
        return pd.DataFrame({"a": head["a"], "b": head["b"], "size": head["sizes"], "shared": shared})

    # Equal texts are folded where they are read; sorted, so that a task run anew sends the same.
    distinct = docs.groupBy("a", "b").agg(F.first("text").alias("text"))
    sent = distinct.sortWithinPartitions("a", "b").mapInArrow(
        send,
        "chunk long, range long, tokens array<binary>, holders array<binary>, "
        "a array<long>, b array<long>, sizes array<long>",
    )
    met = sent.groupBy("range").applyInPandas(
        meet,
        "chunk long, a array<long>, b array<long>, sizes array<long>, holders binary, counts binary",
    )
    return met.groupBy("chunk").applyInPandas(total_up, "a long, b long, size long, shared long")


class _Sent:
    """What a task sends: per range of hashes packed shingles with their holders, and the classes."""

    def __init__(self, ranges: int):
        self.tokens: list[list[bytes]] = [[] for _ in range(ranges)]
        self.holders: list[list[bytes]] = [[] for _ in range(ranges)]
        self.a: list[int] = []
        self.b: list[int] = []
        self.sizes: list[int] = []
        self.bytes = 0

    def add(self, a: np.ndarray, b: np.ndarray, texts: list[bytes], cuts: np.ndarray, bits: int) -> None:
        tokens, text = shingled(texts)
        sizes = np.bincount(text, minlength=len(texts))
        tokens = tokens >> np.uint64(64 - bits)
        edges = [0, *np.searchsorted(tokens, cuts).tolist(), len(tokens)]
        text = (text + len(self.sizes)).astype(np.uint32)
        for at, (i, j) in enumerate(zip(edges, edges[1:])):
            if j > i:
                self.tokens[at].append(packed(np.diff(tokens[i:j], prepend=np.uint64(0))))
                self.holders[at].append(packed(text[i:j]))
                self.bytes += len(self.tokens[at][-1]) + len(self.holders[at][-1])
        self.a += a.tolist()
        self.b += b.tolist()
        self.sizes += sizes.tolist()

    def rows(self, chunk: int) -> pa.RecordBatch:
        chosen = [k for k, blobs in enumerate(self.tokens) if blobs]
        none = [None] * len(chosen)
        columns = {
            "chunk": pa.array([chunk] * (len(chosen) + 1), pa.int64()),
            "range": pa.array([*chosen, chunk % len(self.tokens)], pa.int64()),
            "tokens": pa.array([*(self.tokens[k] for k in chosen), None], pa.list_(pa.binary())),
            "holders": pa.array([*(self.holders[k] for k in chosen), None], pa.list_(pa.binary())),
        } | {
            name: pa.array([*none, getattr(self, name)], pa.list_(pa.int64()))
            for name in ("a", "b", "sizes")
        }
        return pa.RecordBatch.from_pydict(columns)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """name and tokens (hashes of the distinct shingles) of each row of `docs` (name, text)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_column(batch, "text")
            for part in runs_of([len(t) for t in texts], CHUNK_BYTES):
                tokens, text = shingled(texts[part])
                by = np.argsort(text, kind="stable")
                ends = np.searchsorted(text[by], np.arange(part.stop - part.start + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens[by].view(np.int64))
                names = batch.column(0)[part.start : part.stop]
                yield pa.RecordBatch.from_arrays([names, lists], names=["name", "tokens"])

    return docs.select("name", "text").mapInArrow(add, "name long, tokens array<long>")


def rare_first(sets: DataFrame) -> DataFrame:
    """name, size, tokens in rare-first order and alone, how many of them no other set has."""
    rows = sets.select("name", F.explode("tokens").alias("token"))
    frequency = rows.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    rows = lookup(rows, frequency, "token", ["name"])
    one = F.struct(F.coalesce("n", F.lit(1)).alias("n"), "token")
    ordered = rows.groupBy("name").agg(
        F.count("*").alias("size"),
        F.array_sort(F.collect_list(one)).alias("ranked"),
        F.count_if(F.col("n").isNull()).alias("alone"),
    )
    return ordered.select("name", "size", "alone", F.col("ranked.token").alias("tokens"))


def members(ordered: DataFrame, percent: int = PERCENT) -> DataFrame:
    """pivot, name and own: the places of the prefix shingles that lead a class to this pivot."""
    least = F.ceil(F.col("size") * percent / F.lit(100))
    prefix = F.slice("tokens", 1, (F.col("size") - least + 1).cast("int"))
    places = ordered.select("name", "alone", F.posexplode(prefix).alias("at", "token"))
    places = stage(places.where(F.col("at") >= F.col("alone")).drop("alone"), "jaccard-prefixes")
    pivots = places.groupBy("token").agg(F.min("name").alias("pivot"), F.count("*").alias("n"))
    led = lookup(places, pivots.where("n > 1").drop("n"), "token", ["name", "at"])
    return led.where("pivot is not null").groupBy("pivot", "name").agg(
        F.array_sort(F.collect_list("at")).alias("own")
    )


def links(ordered: DataFrame, percent: int = PERCENT, part_rows: int = PART_ROWS) -> DataFrame:
    """(a, b): names that connect all linked sets of `ordered`."""
    rows = stage(members(ordered, percent).join(ordered.drop("alone"), "name"), "jaccard-members")
    sizes = rows.groupBy("pivot").agg(F.count("*").alias("n"), F.sum("size").alias("held"))
    sizes = stage(sizes.where("n > 1"), "jaccard-groups")
    large = (F.col("n") > part_rows) | (F.col("held") > PART_TOKENS)
    wide = sizes.where(large).select("pivot")
    pivots = wide.join(
        ordered.select(F.col("name").alias("pivot"), F.col("tokens").alias("star")), "pivot"
    )
    held = rows.join(wide, "pivot", "left_semi")
    held = lookup(held, pivots, "pivot", ["name"], broadcast_rows=PIVOTS_SENT, measured_on=rows)
    both = F.size(F.array_intersect("tokens", "star"))
    near = both * (100 + percent) >= (F.col("size") + F.size("star")) * percent
    held, any_large = stage_counted(held.select(*rows.columns, near.alias("near")), "jaccard-stars")
    small = rows.join(sizes.where(~large).select("pivot"), "pivot", "left_semi").select(
        "pivot", "name", "size", "tokens", "own",
        F.lit(0).alias("part"), F.lit(0).alias("low"), F.lit(0).alias("high"),
    )
    dealt = small
    stars = None
    if any_large:
        stars = held.where("near and name <> pivot").select(
            F.col("pivot").alias("a"), F.col("name").alias("b")
        )
        dealt = small.unionByName(_parts(held, part_rows))
    tasks = 1 + int(rows.agg(F.sum("size")).first()[0] or 0) // TASK_TOKENS

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = [np.empty((0, 2), np.int64)]
        for (_, low, high), part in group.groupby(["pivot", "low", "high"], sort=False):
            if len(part) > 1:
                found.append(group_links(part, percent, apart=low != high))
        a, b = np.concatenate(found).T
        return pd.DataFrame({"a": a, "b": b})

    task = F.pmod(F.xxhash64("pivot", "low", "high"), F.lit(tasks))
    out = dealt.groupBy(task.alias("task")).applyInPandas(compare, "a long, b long")
    return out if stars is None else out.unionByName(stars)


def _parts(held: DataFrame, part_rows: int) -> DataFrame:
    """The rows of large groups, once for each pair of parts a row is compared in."""
    far = F.col("near") == F.lit(False)
    cut = lambda which: F.greatest(
        F.ceil(F.count_if(which) / part_rows),
        F.ceil(F.sum(F.when(which, F.col("size")).otherwise(0)) / PART_TOKENS),
    ).cast("int")
    counts = held.groupBy("pivot").agg(cut(far).alias("rest"), cut(F.col("near")).alias("linked"))
    rows = lookup(held, counts.where("rest > 0"), "pivot", ["name"]).where("rest is not null")
    draw = F.xxhash64("name")
    part = F.when(far, F.pmod(draw, F.col("rest"))).otherwise(
        F.col("rest") + F.pmod(draw, F.greatest("linked", F.lit(1)))
    )
    rows = rows.withColumn("part", part.cast("int"))
    others = F.when(far, F.col("rest") + F.col("linked")).otherwise(F.col("rest"))
    other = F.explode(F.sequence(F.lit(0), (others - 1).cast("int"))).alias("other")
    return rows.select("pivot", "name", "size", "tokens", "own", "part", other).select(
        "pivot", "name", "size", "tokens", "own", "part",
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
    )


def group_links(rows: pd.DataFrame, percent: int, apart: bool) -> np.ndarray:
    """Links that connect the linked sets of a group; `apart`: only between its two parts."""
    rows = rows.sort_values(["size", "name"], kind="stable")
    name, size, part = (rows[c].to_numpy() for c in ("name", "size", "part"))
    tokens = [np.asarray(t, np.int64) for t in rows["tokens"]]
    flat = np.concatenate(tokens)
    _, codes = np.unique(flat, return_inverse=True)
    ends = np.cumsum(np.concatenate(([0], size)))
    bin_ = (flat.view(np.uint64) >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    bins = np.bincount(np.repeat(np.arange(len(size)), size) * BINS + bin_, minlength=len(size) * BINS)
    bins = bins.reshape(-1, BINS)
    prefix = size - -(-size * percent // 100) + 1
    heads = np.cumsum(np.concatenate(([0], prefix)))
    row = np.repeat(np.arange(len(size)), prefix)
    at = np.arange(heads[-1]) - heads[row]
    code = codes[ends[row] + at]
    leads = np.zeros(len(row), bool)
    for k, own in enumerate(rows["own"]):
        leads[heads[k] + np.asarray(own, np.int64)] = True
    place = np.full(int(codes.max()) + 1, -1)
    within = np.zeros(len(place), bool)
    label = np.arange(len(size))
    longest = np.searchsorted(size * percent, size * 100, "right")  # rows within the length limit
    out = [np.empty((0, 2), np.int64)]
    for i in range(len(size) - 1):
        first, last = heads[i + 1], heads[longest[i]]
        if last <= first:
            continue
        mine = code[heads[i] : heads[i + 1]]
        place[mine] = np.arange(len(mine))
        hit = first + np.flatnonzero(place[code[first:last]] >= 0)
        hit = hit[label[row[hit]] != label[i]]
        if apart:
            hit = hit[part[row[hit]] != part[i]]
        if len(hit):
            new = np.flatnonzero(np.diff(row[hit], prepend=-1))
            other = row[hit[new]]
            shared = np.diff(np.append(new, len(hit)))
            rest = np.minimum(
                size[i] - 1 - np.maximum.reduceat(place[code[hit]], new),
                size[other] - 1 - np.maximum.reduceat(at[hit], new),
            )
            need = (size[i] + size[other]) * percent
            fits = leads[hit[new]] & ((shared + rest) * (100 + percent) >= need)
            other, need = other[fits], need[fits]
            overlap = np.minimum(bins[other], bins[i]).sum(axis=1)
            fits = overlap * (100 + percent) >= need
            other, need = other[fits], need[fits]
            if len(other):
                within[codes[ends[i] : ends[i + 1]]] = True
                starts = np.cumsum(np.concatenate(([0], size[other[:-1]])))
                held = np.concatenate([codes[ends[k] : ends[k + 1]] for k in other])
                both = np.add.reduceat(within[held], starts, dtype=np.int64)
                within[codes[ends[i] : ends[i + 1]]] = False
                linked = other[both * (100 + percent) >= need]
                if len(linked):
                    labels, one = np.unique(label[linked], return_index=True)
                    out.append(np.stack([np.full(len(one), name[i]), name[linked[one]]], 1))
                    label[np.isin(label, labels)] = label[i]
        place[mine] = -1
    return np.concatenate(out)


def components(
    docs: DataFrame,
    percent: int = PERCENT,
    part_rows: int = PART_ROWS,
    range_chars: int = RANGE_CHARS,
) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id its links reach, of every row."""
    docs = hashed(docs.select("doc_id", "text"))
    classes = stage(shared_counts(docs, range_chars), "jaccard-classes")
    alive = F.col("shared") * 100 >= F.col("size") * percent
    alive, many = stage_counted(
        classes.where((F.col("size") > 0) & alive).select(F.struct("a", "b").alias("text_key"), F.lit(True).alias("alive")),
        "jaccard-alive",
    )
    keyed = docs.withColumn("text_key", F.struct("a", "b"))
    chosen = lookup(
        keyed.select("text_key", "text", "doc_id"), alive, "text_key", ["doc_id"],
        measured_on=keyed.select("text_key", "doc_id"), at_most=many,
    )
    chosen = chosen.where("alive").groupBy("text_key").agg(F.first("text").alias("text"))
    sets = shingle_sets(chosen.select(F.col("text_key.a").alias("name"), "text"))
    ordered = stage(rare_first(stage(sets, "jaccard-sets")), "jaccard-ordered")
    roots = smallest_reachable(links(ordered, percent, part_rows))
    ids = stage(docs.select("doc_id", F.struct("a", "b").alias("text_key")), "jaccard-ids")
    least = ids.groupBy("text_key").agg(F.min("doc_id").alias("least"))
    named = classes.select(F.struct("a", "b").alias("text_key"), F.col("a").alias("node"), "size")
    named = named.join(least, "text_key").join(roots, "node", "left")
    named = stage(named.select("text_key", "size", "least", "root"), "jaccard-named")
    met = named.where("root is not null")
    reached = met.groupBy("root").agg(F.min("least").alias("reached"))
    # The many classes without links do not meet under the missing root.
    alone = named.where("root is null").withColumn("reached", F.col("least"))
    named = met.join(reached, "root").unionByName(alone).select(
        "text_key", F.col("size").alias("n_shingles"), "reached"
    )
    answered = lookup(ids, named, "text_key", ["doc_id"])
    own = F.when(F.col("n_shingles") > 0, F.col("reached")).otherwise(F.col("doc_id"))
    return answered.select("doc_id", "n_shingles", own.alias("component_id"))
