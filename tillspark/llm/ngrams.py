"""LM scoring with an Elias-Fano n-gram trie.

The model is a bigram trie with interpolated absolute discounting. The first
level is the word counts; below each context word stand its successors with the
quantised probability the context adds for them. It is cut into shards by
context; a context holding over 1/`HOT` of all words has its successors cut by
their own shard, so no shard gets a hot word whole. No shard leaves its task.

Documents are packed into chunks of word codes, written once. A chunk asks each
word shard for its distinct words, and each trie shard for its distinct pairs of
words, giving its own training counts with the question; the shard adds them up,
builds its levels, looks every question up in them, and answers. So both what is
asked and what is counted are folded per chunk before they are shuffled, and the
answers are bytes. The counts cover every training document.

A level is a sorted sequence in Elias-Fano form. Successors of one context are
stored relative to the last one of the context before, so the whole level
ascends; the pointers of a context, monotone as well, tell where its successors
start and stop, and a word is sought among them. The levels lie in one file that is mapped into memory and already
unlinked, so nothing stays on the executor.

Words are compared by 64-bit hashes. Tokens are the words of the lower-cased (A-Z) text and one end. Null and empty
texts have the end only. A null doc_id is never held out. Repeated rows count
each time. Without training documents everything is scored by the uniform law.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.text import byte_column, packed, runs_of, unpacked, word_codes, word_hashes
from tillspark.sources.staging import stage

FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 6 << 20
SHARD_CHARS = 16 << 20
HOT = 500
SEED = 7
END = b""  # no word is empty
#: Codes from 1 up stand for log10 probabilities in even steps from this one to 0; 0 is none.
LOWEST = -9.0


class EliasFano:
    """An ascending sequence: low bits in full, high bits as a unary run in a bit vector.

    The bit vector lies in 64-bit words with the ones before each word; the k-th one or zero is
    found by a search among these and inside one word, all in the mapped file.
    """

    def __init__(self, values: np.ndarray, levels: Levels):
        self.size = len(values)
        top = int(values[-1]) + 1 if self.size else 1
        self.shift = np.uint64(max(0, (top // max(1, self.size)).bit_length() - 1))
        high = (values >> self.shift).astype(np.int64)
        self.zeros = (int(high[-1]) if self.size else 0) + 1
        bits = np.zeros(-(-(self.size + self.zeros) // 64) * 64, bool)
        bits[high + np.arange(self.size)] = True
        low = values & ((np.uint64(1) << self.shift) - np.uint64(1))
        width = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64)
                     if int(self.shift) <= np.dtype(k).itemsize * 8)
        words = np.packbits(bits, bitorder="little").view("<u8")
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
        self.low = levels.kept(low.astype(width))
        self.words = levels.kept(words)
        self.before = levels.kept(before.astype(np.uint32 if self.size < 1 << 32 else np.int64))

    def _placed(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Where in the bit vector the k-th one, or zero, stands."""
        words, before = self.words(), self.before()
        if ones:
            word = np.searchsorted(before, k.astype(before.dtype), "right") - 1
            left = k - before[word].astype(np.int64)
            bits = words[word]
        else:
            gone = np.arange(len(before)) * 64 - before
            word = np.searchsorted(gone, k, "right") - 1
            left = k - gone[word]
            bits = ~words[word]
        place = word * 64
        for width in (32, 16, 8, 4, 2, 1):
            part = bits & np.uint64((1 << width) - 1)
            held = np.bitwise_count(part).astype(np.int64)
            further = left >= held
            left = np.where(further, left - held, left)
            bits = np.where(further, bits >> np.uint64(width), part)
            place = place + further * width
        return place

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at some places."""
        high = (self._placed(places, True) - places).astype(np.uint64)
        return (high << self.shift) | self.low()[places].astype(np.uint64)

    def decoded(self) -> np.ndarray:
        return self.at(np.arange(self.size))

    def found(self, wanted: np.ndarray) -> np.ndarray:
        """Position of each wanted value, or -1. Successor search: the unary run of the high bits
        gives the range in which the low bits are sought."""
        if not self.size:
            return np.full(len(wanted), -1)
        high = (wanted >> self.shift).astype(np.int64)
        inside = high < self.zeros
        high = np.minimum(high, self.zeros - 1)
        first = np.where(high > 0, self._placed(np.maximum(high - 1, 0), False) - (high - 1), 0)
        end = self._placed(high, False) - high
        low = self.low()
        sought = (wanted & ((np.uint64(1) << self.shift) - np.uint64(1))).astype(low.dtype)
        at, stop = first.copy(), end.copy()
        while (at < stop).any():
            middle = (at + stop) >> 1
            less = (at < stop) & (low[np.minimum(middle, self.size - 1)] < sought)
            stop = np.where((at < stop) & ~less, middle, stop)
            at = np.where(less, middle + 1, at)
        held = inside & (at < end)
        held &= low[np.minimum(at, self.size - 1)] == sought
        return np.where(held, at, -1)


class Levels:
    """Arrays laid down one after the other in a mapped, unlinked file."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.map: mmap.mmap | None = None

    def kept(self, values: np.ndarray):
        start, size, kind = self.file.tell(), len(values), values.dtype
        self.file.write(values.tobytes())
        self.file.write(bytes(-values.nbytes % 8))
        return lambda: np.frombuffer(self.map, kind, size, start) if size else values

    def mapped(self) -> None:
        self.file.write(bytes(8))
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)


class TrieShard:
    """Contexts, pointers to their successors, successors, and quantised probabilities."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray):
        """Distinct (context, word) pairs in order, their counts and the context's count."""
        levels = Levels()
        heads = np.flatnonzero(np.diff(context, prepend=context[:1] ^ np.uint64(1)) != 0)
        self.words, word_rank = np.unique(word, return_inverse=True)
        self.contexts = EliasFano(context[heads], levels)
        self.pointers = EliasFano(np.append(heads, len(context)).astype(np.uint64), levels)
        # A context's successors stand above the last one of the context before.
        last = np.append(heads[1:], len(context)) - 1
        above = np.cumsum(np.concatenate(([0], word_rank[last][:-1] + 1))) if len(heads) else heads
        base = np.repeat(above, np.diff(np.append(heads, len(context))))
        self.successors = EliasFano((base + word_rank).astype(np.uint64), levels)
        taken = np.minimum(discount(count), count)
        self.codes = levels.kept(quantised((count - taken) / np.maximum(total, 1)))
        share = taken / np.maximum(total, 1)
        share = np.add.reduceat(share, heads) if len(heads) else share
        self.freed = levels.kept(quantised(share, np.uint16))
        levels.mapped()

    def freed_by(self, context: np.ndarray) -> np.ndarray:
        """Quantised probability each context hands to the shorter model."""
        if not self.contexts.size:
            return np.zeros(len(context), np.uint16)
        at = self.contexts.found(context)
        return np.where(at >= 0, self.freed()[at], 0).astype(np.uint16)

    def codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Quantised probability that each context adds for each word."""
        if not self.contexts.size:
            return np.zeros(len(context), np.uint8)
        rank = self.contexts.found(context)
        place = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        known = (rank >= 0) & (self.words[place] == word)
        # The pointers name the context's range; its successors are relative to the one before.
        start = self.pointers.at(np.maximum(rank, 0)).astype(np.int64)
        stop = self.pointers.at(np.maximum(rank, 0) + 1).astype(np.int64)
        before = self.successors.at(np.maximum(start - 1, 0)).astype(np.int64)
        base = np.where(start > 0, before + 1, 0)
        at = self.successors.found((base + place).astype(np.uint64))
        known &= (at >= start) & (at < stop)
        return np.where(known, self.codes()[at], 0).astype(np.uint8)


def discount(count: np.ndarray) -> np.ndarray:
    """Discounts of pairs seen once, twice and more, from how many pairs were seen 1 to 4 times."""
    n = [max(1, int((count == k).sum())) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    steps = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.02) for k in (1, 2, 3)]
    return np.select([count == 0, count == 1, count == 2], [0.0, steps[0], steps[1]], steps[2])


def quantised(share: np.ndarray, kind=np.uint8) -> np.ndarray:
    top = np.iinfo(kind).max
    with np.errstate(divide="ignore"):
        code = top + np.rint(np.log10(share) * ((top - 1) / -LOWEST))
    return np.where(share > 0, np.clip(code, 1, top), 0).astype(kind)


def restored(code: np.ndarray) -> np.ndarray:
    top = float(np.iinfo(code.dtype).max)
    return np.where(code > 0, 10.0 ** ((code - top) * (-LOWEST / (top - 1))), 0.0)


_CHUNKS = (
    "chunk long, ids binary, nulls binary, held binary, ends binary, codes binary, "
    "sizes binary, hashes binary, tokens long"
)


def pack(docs: DataFrame, shards: int) -> DataFrame:
    """Documents in chunks of word codes; codes ascend by (shard, hash) of the word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_column(batch, "text")
            keys, held, number = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for part in runs_of([len(t) for t in texts], CHUNK_BYTES):
                rows = [[*text.lower().split(), END] for text in texts[part]]
                codes, distinct, ends = word_codes(rows)
                hashes = word_hashes(distinct, SEED)
                order = np.lexsort((hashes, hashes % np.uint64(shards)))
                place = np.empty(len(order), np.uint32)
                place[order] = np.arange(len(order), dtype=np.uint32)
                hashes = hashes[order]
                sizes = np.bincount((hashes % np.uint64(shards)).astype(np.int64), minlength=shards)
                out = np.array(held[part], bool)
                ids = np.array([k or 0 for k in keys[part]], np.int64)
                row = {
                    "chunk": number[part.start],
                    "ids": packed(ids),
                    "nulls": packed(np.array([k is None for k in keys[part]])),
                    "held": packed(out),
                    "ends": packed(ends.astype(np.int64)),
                    "codes": packed(place[codes]),
                    "sizes": packed(sizes),
                    "hashes": packed(hashes),
                    "tokens": int(np.diff(ends)[~out].sum()),
                }
                yield pa.RecordBatch.from_pylist([row])

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT
    rows = docs.select(
        "doc_id", "text", F.coalesce(held_out, F.lit(False)), F.monotonically_increasing_id()
    )
    return rows.mapInArrow(work, _CHUNKS)


class _Chunk:
    """A chunk's tokens as codes, its distinct words by shard and hash, its distinct pairs."""

    def __init__(self, row: dict):
        self.ends = unpacked(row["ends"], np.int64)
        self.held = unpacked(row["held"], bool)
        self.codes = unpacked(row["codes"], np.uint32)
        self.sizes = unpacked(row["sizes"], np.int64)
        self.edges = np.concatenate(([0], np.cumsum(self.sizes)))
        self.trained = np.repeat(~self.held, np.diff(self.ends))

    def counts(self) -> np.ndarray:
        return np.bincount(self.codes[self.trained], minlength=int(self.edges[-1]))

    def pairs(self, hot: np.ndarray):
        """(context, word, training count, first pair of each shard and end, pair of each token).

        The context of a first word is the end. Pairs ascend by shard, context, word.
        A hot context's pairs stand in the shard of the word.
        """
        words = int(self.edges[-1])
        shard = np.repeat(np.arange(len(self.sizes)), self.sizes)
        before = np.concatenate(([0], self.codes[:-1])).astype(np.int64)
        if len(self.codes):
            before[self.ends[:-1]] = self.codes[-1]  # a text ends with the end
        owner = np.where(hot[before], shard[self.codes], shard[before])
        key = (owner * words + before) * words + self.codes
        distinct, token = np.unique(key, return_inverse=True)
        count = np.bincount(token[self.trained], minlength=len(distinct))
        owner, rest = np.divmod(distinct, words * words)
        edges = np.searchsorted(owner, np.arange(len(self.sizes) + 1))
        return rest // words, rest % words, count, edges, token

    @staticmethod
    def asked(context: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts to ask a shard for, and their number of pairs: hot ones are asked of all."""
        own = np.union1d(context, np.flatnonzero(hot))
        return own, np.searchsorted(context, own, "right") - np.searchsorted(context, own)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = 1 + total // SHARD_CHARS
    chunks = stage(pack(docs, shards), "lm-chunks")
    trained = int(chunks.agg(F.sum("tokens")).first()[0] or 0)

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _Chunk(row)
                hashes, counts = unpacked(row["hashes"], np.uint64), found.counts()
                for s, (i, j) in enumerate(zip(found.edges, found.edges[1:])):
                    if j > i:
                        yield pa.RecordBatch.from_pydict(
                            {
                                "chunk": [row["chunk"]],
                                "shard": [s],
                                "hashes": [packed(np.diff(hashes[i:j], prepend=np.uint64(0)))],
                                "counts": [packed(counts[i:j])],
                            }
                        )

    def answer_words(rows: pd.DataFrame) -> pd.DataFrame:
        asked = [np.cumsum(unpacked(b, np.uint64)) for b in rows["hashes"]]
        known, place = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.concatenate([unpacked(b, np.int64) for b in rows["counts"]])
        count = np.bincount(place, counts, len(known)).astype(np.int64)
        ends = np.cumsum([0, *map(len, asked)])
        answers = [packed(_narrow(place[i:j])) for i, j in zip(ends, ends[1:])]
        return pd.DataFrame(
            {
                "chunk": rows["chunk"],
                "shard": rows["shard"],
                "ranks": answers,
                "counts": [packed(_narrow(count[place[i:j]])) for i, j in zip(ends, ends[1:])],
                "known": [int((count > 0).sum())] + [0] * (len(asked) - 1),
            }
        )

    asked = chunks.select("chunk", "ends", "held", "codes", "sizes", "hashes").mapInArrow(
        ask_words, "chunk long, shard long, hashes binary, counts binary"
    )
    words = stage(
        asked.groupBy("shard").applyInPandas(
            answer_words, "chunk long, shard long, ranks binary, counts binary, known long"
        ),
        "lm-words",
    )
    vocabulary = int(words.agg(F.sum("known")).first()[0] or 0)
    hot_count = max(1, trained // HOT)

    def word_table(replies: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(id, training count) of each word of a chunk, by code."""
        replies = replies.sort_values("shard")
        ranks = [_wide(b) for b in replies["ranks"]]
        ids = [r * shards + s for r, s in zip(ranks, replies["shard"], strict=True)]
        counts = [_wide(b) for b in replies["counts"]]
        return np.concatenate(ids).astype(np.uint64), np.concatenate(counts)

    def ask_pairs(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            found = _Chunk(row)
            ids, counts = word_table(replies)
            hot = counts > hot_count
            context, word, count, edges, _ = found.pairs(hot)
            for s, (i, j) in enumerate(zip(edges, edges[1:])):
                own, spans = found.asked(context[i:j], hot)
                if len(own):
                    out.append(
                        (row["chunk"], s, packed(ids[own]), packed(counts[own]),
                         packed(_narrow(spans)),
                         packed(_narrow(ids[word[i:j]].astype(np.int64))),
                         packed(_narrow(count[i:j])))
                    )
        return pd.DataFrame(out, columns=PAIRS)

    def answer_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [
            (unpacked(r.contexts, np.uint64), unpacked(r.totals, np.int64), _wide(r.spans),
             _wide(r.words).astype(np.uint64), _wide(r.counts))
            for r in rows.itertuples()
        ]
        context = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
        total = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
        word = np.concatenate([p[3] for p in parts])
        count = np.concatenate([p[4] for p in parts])
        seen = count > 0
        trie = _merged(context[seen], word[seen], count[seen], total[seen])
        answers = []
        for contexts, _, spans, asked, _ in parts:
            answers.append(
                (packed(trie.freed_by(contexts)),
                 packed(trie.codes_of(np.repeat(contexts, spans), asked)))
            )
        return pd.DataFrame(
            {
                "chunk": rows["chunk"],
                "shard": rows["shard"],
                "ranks": [a[0] for a in answers],
                "counts": [a[1] for a in answers],
                "known": -1,
            }
        )

    packs = chunks.drop("hashes", "tokens")
    asked = packs.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInPandas(
        ask_pairs,
        "chunk long, shard long, contexts binary, totals binary, spans binary, words binary, "
        "counts binary",
    )
    pairs = asked.groupBy("shard").applyInPandas(
        answer_pairs, "chunk long, shard long, ranks binary, counts binary, known long"
    )

    def scored(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            found = _Chunk(row)
            _, counts = word_table(replies[replies["known"] >= 0])
            hot = counts > hot_count
            context, word, _, edges, token = found.pairs(hot)
            freed = np.zeros(len(counts))
            added = np.empty(len(context))
            for reply in replies[replies["known"] < 0].itertuples():
                i, j = edges[reply.shard], edges[reply.shard + 1]
                own, _ = found.asked(context[i:j], hot)
                freed[own] += restored(unpacked(reply.ranks, np.uint16))
                added[i:j] = restored(unpacked(reply.counts, np.uint8))
            single = (counts + 1) / (trained + vocabulary + 1)
            left = np.where(counts > 0, freed, 1.0)  # an unseen context hands on everything
            chosen = np.log10(added + left[context] * single[word])
            starts = found.ends[:-1]
            sums = [
                np.add.reduceat(values, starts) if len(starts) else values
                for values in (
                    (counts[found.codes] > 0).astype(np.int64),
                    np.log10(single)[found.codes],
                    chosen[token],
                )
            ]
            ids = unpacked(row["ids"], np.int64)
            nulls = unpacked(row["nulls"], bool)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(np.where(nulls, 0, ids), "Int64"),
                        "held_out": found.held,
                        "n_tokens": np.diff(found.ends),
                        "n_known": sums[0],
                        "train_tokens": trained,
                        "base_score": sums[1],
                        "score": sums[2],
                    }
                )
            )
            out[-1].loc[nulls, "doc_id"] = pd.NA
        return pd.concat(out)

    answers = words.unionByName(pairs)
    return packs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        scored,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


PAIRS = ["chunk", "shard", "contexts", "totals", "spans", "words", "counts"]


def _merged(context, word, count, total) -> TrieShard:
    """The trie over equal pairs added up."""
    order = np.lexsort((word, context))
    context, word, count, total = (v[order] for v in (context, word, count, total))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(context) != 0) | (np.diff(word) != 0)
    heads = np.flatnonzero(new)
    sums = np.add.reduceat(count, heads) if len(heads) else count
    return TrieShard(context[heads], word[heads], sums, total[heads])


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the fewest bytes."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64)
                              if top <= np.iinfo(k).max))


def _wide(blob: bytes) -> np.ndarray:
    width = int(np.frombuffer(blob[:8], np.int64)[0]) % 16
    return unpacked(blob, f"u{width}").astype(np.int64)
