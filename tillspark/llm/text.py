"""Words, hashes and table access shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of words `[^\\x20\\x09-\\x0D]+`; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def with_column(batch: pa.RecordBatch, name: str, values, kind: pa.DataType) -> pa.RecordBatch:
    columns = [*batch.columns, pa.array(values, kind)]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])


def runs_of(sizes: Sequence[int], limit: int) -> Iterator[slice]:
    """Consecutive rows whose sizes add up to about `limit`; a larger row stands alone."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if held and held + size > limit:
            yield slice(start, at)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def word_codes(documents: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(code of each word in order, words by code, first position of each document and the end)."""
    ends = np.cumsum([0, *map(len, documents)])
    seen: dict[bytes, int] = {}
    for row in documents:
        for word in set(row).difference(seen):
            seen[word] = len(seen)
    codes = np.empty(int(ends[-1]), np.int32)
    for at, row in enumerate(documents):
        codes[ends[at] : ends[at + 1]] = list(map(seen.__getitem__, row))
    return codes, list(seen), ends


def word_hashes(distinct: Sequence[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(word, seed) for word in distinct), np.uint64, len(distinct))


def word_digests(documents: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(two 64-bit hashes of each word in order, words of each document). A word is hashed once."""
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    seen: dict[bytes, int] = {}
    # A word's code is where it occurs first.
    codes = np.fromiter(
        map(seen.setdefault, chain.from_iterable(documents), count()), np.int64, int(sizes.sum())
    )
    digests = np.empty((len(codes), 2), np.uint64)
    whole = b"".join(map(xxhash.xxh3_128_digest, seen))
    digests[np.fromiter(seen.values(), np.int64, len(seen))] = np.frombuffer(whole, ">u8").reshape(-1, 2)
    return digests[codes], sizes


def mixed(values: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser that makes every output bit depend on every input bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes, the first four bytes their count and width."""
    plain = np.ascontiguousarray(values)
    planes = plain.view(np.uint8).reshape(len(plain), plain.itemsize).T
    head = np.array([len(plain) * 16 + plain.itemsize], np.int64).tobytes()
    return head + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, kind) -> np.ndarray:
    head = int(np.frombuffer(blob[:8], np.int64)[0])
    size, width = divmod(head, 16)
    raw = pa.decompress(blob[8:], decompressed_size=size * width, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, size).T
    return np.ascontiguousarray(planes).reshape(-1).view(kind)
