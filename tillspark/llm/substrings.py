"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

A word is removed if a window covering it also starts in a document with a
smaller doc_id. Documents are dealt into chunks of about `chunk_chars` by a hash
of doc_id. A chunk hashes all its windows with a rolling hash and, per distinct
hash, sends the smallest doc_id holding it to the bucket that owns the hash: one
entry however often a passage occurs in the chunk, so no hash is hot. The bucket
finds the smallest doc_id of all and answers one bit per entry: whether a
smaller document elsewhere has the window. The chunk, hashed again from the same
shuffled texts, turns bits into covered words and merges them into maximal
intervals. Chunks and buckets are sized by the total text, so they stay bounded.

The hash has 64 bits and 16 check bits from a second polynomial, and buckets are
ranges of the first, so both decide; windows are not compared word by word.

Null and empty texts have no words. A null doc_id counts as larger than any
other. Rows that share a doc_id do not remove each other's words. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.text import mixed, packed, unpacked, word_digests

WINDOW = 13
CHUNK_CHARS = 8 << 20
BUCKET_CHARS = 12 << 20
LAST = np.iinfo(np.int64).max  # stands for a null doc_id
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    chunk_chars: int = CHUNK_CHARS,
    bucket_chars: int = BUCKET_CHARS,
) -> DataFrame:
    """doc_id, n_words, n_removed, intervals (first word and end of each, in turn), kept (text),
    kept_sha256."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = 1 + total // chunk_chars
    buckets = 1 + total // bucket_chars
    dealt = docs.select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    )

    def entries(rows: pd.DataFrame) -> pd.DataFrame:
        found = _Chunk(rows, window)
        edges = found.edges(buckets)
        chosen = [(b, i, j) for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
        return pd.DataFrame(
            {
                "chunk": [rows["chunk"].iloc[0]] * len(chosen),
                "bucket": [b for b, _, _ in chosen],
                "first": [packed(_gaps(found.first[i:j])) for _, i, j in chosen],
                "second": [packed(found.second[i:j]) for _, i, j in chosen],
                "holder": [packed(_ranked(found.holder[i:j])[1]) for _, i, j in chosen],
                "ids": [packed(_ranked(found.holder[i:j])[0]) for _, i, j in chosen],
            }
        )

    def answers(rows: pd.DataFrame) -> pd.DataFrame:
        first = np.concatenate([np.cumsum(unpacked(b, np.uint64)) for b in rows["first"]])
        second = np.concatenate([unpacked(b, np.uint16) for b in rows["second"]])
        holders = [
            unpacked(ids, np.int64)[unpacked(ranks, np.uint32)]
            for ids, ranks in zip(rows["ids"], rows["holder"], strict=True)
        ]
        holder = np.concatenate(holders)
        order = np.argsort(first)
        new, other = (np.diff(v[order], prepend=v[order[:1]] + v.dtype.type(1)) != 0 for v in (first, second))
        if (other & ~new).any():  # equal in the first hash alone
            order = np.lexsort((second, first))
            new, other = (np.diff(v[order], prepend=v[order[:1]] + v.dtype.type(1)) != 0 for v in (first, second))
            new |= other
        least = np.minimum.reduceat(holder[order], np.flatnonzero(new))
        beaten = np.empty(len(order), bool)
        beaten[order] = holder[order] > least[np.cumsum(new) - 1]
        ends = np.cumsum([0, *map(len, holders)])
        bits = [np.packbits(beaten[i:j]).tobytes() for i, j in zip(ends, ends[1:])]
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "bits": bits})

    def removed(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        found = _Chunk(rows, window)
        edges = found.edges(buckets)
        beaten = np.zeros(len(found.first), bool)
        for bucket, bits in zip(replies["bucket"], replies["bits"], strict=True):
            i, j = edges[bucket], edges[bucket + 1]
            beaten[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i)
        return found.without(beaten)

    sent = dealt.groupBy("chunk").applyInPandas(
        entries, "chunk long, bucket long, first binary, second binary, holder binary, ids binary"
    )
    replies = sent.groupBy("bucket").applyInPandas(
        answers, "chunk long, bucket long, bits binary"
    )
    return dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(
        removed,
        "doc_id long, n_words long, n_removed long, intervals array<int>, kept string, "
        "kept_sha256 string",
    )


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.uint64(0))


def _ranked(holder: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, ranks = np.unique(holder, return_inverse=True)
    return ids, ranks.astype(np.uint32)


class _Chunk:
    """The windows of some documents: distinct hashes ascending, the smallest doc_id of each."""

    def __init__(self, rows: pd.DataFrame, window: int):
        self.window = window
        ids = rows["doc_id"]
        self.null = ids.isna().to_numpy()
        self.ids = np.array([LAST if n else int(i) for i, n in zip(ids, self.null)], np.int64)
        self.rows = [t.encode().split() if isinstance(t, str) else [] for t in rows["text"]]
        digests, sizes = word_digests(self.rows)
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        starts = np.arange(len(digests))
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.starts = starts[starts + window <= np.repeat(self.ends[1:], sizes)]
        first, second = (
            _rolling(digests[:, k], self.starts, window, base) for k, base in enumerate(BASES)
        )
        second = (second >> np.uint64(48)).astype(np.uint16)
        owner = self.ids[self.doc[self.starts]]
        # Equal windows are equal in both; windows equal in the first alone, if there are any,
        # may give more entries than needed, and the bucket joins those again.
        order = np.argsort(first)
        first, second, owner = first[order], second[order], owner[order]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(first) != 0) | (np.diff(second) != 0)
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        self.first, self.second = first[heads], second[heads]
        self.holder = np.minimum.reduceat(owner, heads) if len(heads) else owner
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = group
        self.owner = owner

    def edges(self, buckets: int) -> np.ndarray:
        """First entry of each range of hashes, and the end."""
        cuts = [(b << 64) // buckets for b in range(1, buckets)]
        inner = np.searchsorted(self.first, np.array(cuts, np.uint64))
        return np.concatenate(([0], inner, [len(self.first)])).astype(np.int64)

    def without(self, beaten: np.ndarray) -> pd.DataFrame:
        own = self.ids[self.doc[self.starts]] if len(self.starts) else self.owner
        gone = self.starts[beaten[self.entry] | (own > self.holder[self.entry])]
        change = np.zeros(int(self.ends[-1]) + 1, np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + self.window, -1)
        covered = np.cumsum(change)[:-1] > 0
        out = []
        for at, words in enumerate(self.rows):
            i, j = self.ends[at], self.ends[at + 1]
            hit = covered[i:j]
            count = int(hit.sum())
            spans: list[int] = []
            if count:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                spans = edge.tolist()
                words = [words[k] for k in np.flatnonzero(~hit)]
            kept = b" ".join(words)
            digest = hashlib.sha256(kept).hexdigest()
            doc_id = None if self.null[at] else int(self.ids[at])
            out.append((doc_id, j - i, count, spans, kept.decode(), digest))
        frame = pd.DataFrame(
            out, columns=["doc_id", "n_words", "n_removed", "intervals", "kept", "kept_sha256"]
        )
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame


@lru_cache(maxsize=2 * len(BASES))
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of `base` and of its inverse modulo 2^64."""
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        powers = np.full(size + 1, factor, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers, dtype=np.uint64))
    return both[0], both[1]


def _rolling(digests: np.ndarray, starts: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash of the window at each start, from prefix sums modulo 2^64."""
    size = len(digests)
    powers, back = _powers(base, 1 << max(16, size.bit_length()))
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(digests * powers[:size], out=sums[1:])
    return mixed((sums[starts + window] - sums[starts]) * back[starts])
