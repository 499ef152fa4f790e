"""Periodic runs of words, by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least `least` and 2 q words
long, that no neighbouring word extends. All runs of a text are found, whatever their period.

Periods below `DIRECT` are read off by comparing the words with themselves, moved by the
period. Longer ones are sought at dyadic scales t, each for the periods from 3 t to 6 t. At a
scale, every place has a hash of its next t words; a place is chosen if its own hash, or that
of the place t further on, is the least of the t + 1 hashes from it on. Whether a place is
chosen depends on its next 2 t words alone, and of any t places in a row one is chosen, unless
the words there are highly periodic (a period of t / 3 or less), whose places take no part. So
a run repeats its chosen places one period apart: chosen places with the same 2 t words and a
distance in range propose the distance as a period. As chosen places are not highly periodic,
equal ones lie more than t / 3 apart, so each proposes a bounded number of periods.

What this omits are runs one of whose periods lies wholly in a highly periodic region. Such
regions are runs of a smaller period, which an earlier scale has found, and the next period lies
in another region that touches it: two regions that meet propose the distances from the end of
the first at which its words occur again. Every proposal is compared word by word, in both
directions as far as words agree; proposals of one run are linked, so none is compared twice.

Texts of an Arrow batch are joined, parted by marks that equal nothing, and handled as one
array, the longest first, so that a scale only reads texts long enough for it. Memory is about
200 bytes a word of the longest text. No text is cut, and no text meets another.

A null or empty text has no words and no runs. A null doc_id is handed on; its words are left
as they are by `repeating`. Rows are handled each by itself, repeated ones too. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillspark.llm.text import byte_column, mixed, runs_of

LEAST = 12
DIRECT = 12  # the first scale, 4, takes periods from here on
RUN_BYTES = 1 << 20
CELLS = 1 << 20
WIDEST = 4_096
NONE = np.iinfo(np.uint64).max
FACTOR = np.uint64(0x9E3779B97F4A7C15)

Words = list[bytes]


def repeating(doc_id: int | None, words: Words) -> Words:
    """The words, those from some place on repeated with a period, for one doc_id in ten.

    Fixed values, all from h, the CRC-32 of the decimal doc_id: h % 10 = 0 chooses, and with
    g = h div 10 the place is g % n and the period 1 + (n - place) div (3 + g % 8).
    """
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    size = len(words)
    place = g % size
    period = 1 + (size - place) // (3 + g % 8)
    block = words[place : place + period]
    return words[:place] + (block * (1 + (size - place) // period))[: size - place]


def find_runs(texts: list[Words], least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs of all texts, by text, start and period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    heads = np.cumsum(np.concatenate(([1], sizes + 1)))
    known: dict[bytes, int] = {}
    codes = np.full(int(heads[-1]), -1, np.int64)
    inside = np.ones(len(codes), bool)
    marks = np.concatenate(([0], heads[1:] - 1))
    inside[marks] = False
    flat = chain.from_iterable(texts[k] for k in order)
    codes[inside] = np.fromiter(map(known.setdefault, flat, count()), np.int64, int(sizes.sum()))
    codes[marks] = -1 - np.arange(len(marks))

    def reach(size: int) -> int:
        """End of the texts of at least `size` words, with their last mark."""
        return int(heads[np.searchsorted(-sizes, -size, "right")])

    found = _smallest(_direct(codes, reach))
    scale, names = 1, mixed(codes.view(np.uint64) * FACTOR)
    while len(sizes) and 6 * scale <= sizes[0]:
        end = reach(6 * scale)
        names = names[: max(0, end - scale + 1)]
        further = mixed(names[:-scale] * FACTOR + names[scale:])
        if scale >= 4:
            proposed = [_synchronised(names, further, found, scale), _meeting(codes, found, scale)]
            at, period = np.concatenate(proposed, axis=1)
            found = _smallest(np.concatenate([found, _grown(codes[:end], at, period)], axis=1))
        scale, names = 2 * scale, further
    start, stop, period = found[:, found[1] - found[0] >= least]
    place = np.searchsorted(heads, start, "right") - 1
    text = np.array(order, np.int64)[place]
    start, length = start - heads[place], stop - start
    by = np.lexsort((period, start, text))
    return text[by], start[by], length[by], period[by]


def _direct(codes: np.ndarray, reach: Callable[[int], int]) -> np.ndarray:
    """(start, end, period) of the stretches of short periods."""
    out = []
    for period in range(1, DIRECT):
        part = codes[: reach(2 * period)]
        same = np.flatnonzero(part[:-period] == part[period:])
        first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
        size = np.diff(np.append(first, len(same)))
        long = size >= period
        start = same[first[long]]
        out.append(np.stack([start, start + size[long] + period, np.full(len(start), period)]))
    return np.concatenate(out, axis=1)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, by start and end."""
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    new = np.ones(runs.shape[1], bool)
    new[1:] = (np.diff(runs[0]) != 0) | (np.diff(runs[1]) != 0)
    return runs[:, new]


def _synchronised(names: np.ndarray, further: np.ndarray, found: np.ndarray, scale: int) -> np.ndarray:
    """(place, period) proposed by chosen places with equal words; `names` hashes `scale` words
    of each place, `further` twice as many."""
    if not len(further):
        return np.empty((2, 0), np.int64)
    start, stop, period = found
    calm = (period * 3 <= scale) & (stop - start >= scale) & (start < len(names))
    change = np.zeros(len(names) + 1, np.int64)
    np.add.at(change, start[calm], 1)
    np.add.at(change, np.minimum(stop[calm] - scale + 1, len(names)), -1)
    own = np.where(np.cumsum(change)[:-1] > 0, NONE, names)
    least = _least(own, scale + 1)
    chosen = (least != NONE) & ((least == own[: len(least)]) | (least == own[scale:]))
    place = np.flatnonzero(chosen)
    key = further[place]
    order = np.argsort(key, kind="stable")
    place, key = place[order], key[order]
    out, step = [], 1
    while step < len(place):
        near = np.flatnonzero((key[step:] == key[:-step]) & (place[step:] - place[:-step] < 6 * scale))
        if not len(near):
            break
        apart = place[near + step] - place[near]
        wide = apart >= 3 * scale
        out.append(np.stack([place[near[wide]], apart[wide]]))
        step += 1
    return np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    size = len(values) - width + 1
    whole = np.full(-(-len(values) // width) * width, NONE, np.uint64)
    whole[: len(values)] = values
    rows = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:size], ahead[width - 1 : width - 1 + size])


def _meeting(codes: np.ndarray, found: np.ndarray, scale: int) -> np.ndarray:
    """(place, period) proposed by highly periodic regions that touch the next one."""
    calm = found[:, (found[2] * 3 <= scale) & (found[1] - found[0] >= 3 * scale)]
    start, stop, period = calm
    met = np.flatnonzero((start[1:] <= stop[:-1]) & (period[1:] == period[:-1]))
    out = [np.empty((2, 0), np.int64)]
    for k in met.tolist():
        end = stop[k]
        most = min(6 * scale - 1, end - start[k], stop[k + 1] - start[k + 1])
        apart = np.arange(3 * scale, most + 1)
        apart = apart[codes[end - apart] == codes[end]]
        out.append(np.stack([end - apart, apart]))
    return np.concatenate(out, axis=1)


def _grown(codes: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """(start, end, period) of the proposed runs: at least two periods long, grown to the full."""
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (np.diff(place) != 0) | (np.diff(period) != 0)
    place, period = place[fresh], period[fresh]
    if not len(place):
        return np.empty((3, 0), np.int64)
    gap = np.full(len(place), len(codes))
    same = np.diff(period) == 0
    gap[:-1][same] = np.diff(place)[same]
    ahead = _agreed(codes, place, place + period, gap, 1)
    head = np.concatenate(([True], ahead[:-1] < gap[:-1]))
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(place)) - 1
    start, period = place[first], period[first]
    behind = _agreed(codes, start - 1, start + period - 1, start, -1)
    start, stop = start - behind, place[last] + ahead[last] + period
    whole = stop - start >= 2 * period
    return np.stack([start, stop, period])[:, whole]


def _agreed(codes: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words from `a` and from `b` on agree, at most `most`."""
    out = np.zeros(len(a), np.int64)
    live, width, last = np.arange(len(a)), 8, len(codes) - 1
    while len(live):
        more = []
        for part in np.array_split(live, 1 + len(live) * width // CELLS):
            at = out[part, None] + np.arange(width)
            left = np.clip(a[part, None] + step * at, 0, last)
            right = np.clip(b[part, None] + step * at, 0, last)
            same = (codes[left] == codes[right]) & (at < most[part, None])
            size = np.where(same.all(axis=1), width, same.argmin(axis=1))
            out[part] += size
            more.append(part[size == width])
        live, width = np.concatenate(more), min(2 * width, WIDEST)
    return out


def collapse(
    docs: DataFrame,
    least: int = LEAST,
    change: Callable[[int | None, Words], Words] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and kept, the text
    without the words that any run holds beyond its first period, of every row.

    `change` is applied to the words of a document before runs are sought.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), byte_column(batch, "text")
            for part in runs_of([len(t) for t in texts], RUN_BYTES):
                words = [text.split() for text in texts[part]]
                chosen = ids[part.start : part.stop]
                if change is not None:
                    words = list(map(change, chosen.to_pylist(), words))
                yield _collapsed(chosen, words, least)

    return docs.select("doc_id", "text").mapInArrow(
        sought,
        f"doc_id {kind}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, kept string",
    )


def _collapsed(ids: pa.Array, words: list[Words], least: int) -> pa.RecordBatch:
    text, start, length, period = find_runs(words, least)
    ends = np.searchsorted(text, np.arange(len(words) + 1))
    fields = {"start": start, "length": length, "period": period}
    runs = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields))
    kept = []
    for at, row in enumerate(words):
        held = slice(ends[at], ends[at + 1])
        if held.stop > held.start:
            change = np.zeros(len(row) + 1, np.int64)
            np.add.at(change, start[held] + period[held], 1)
            np.add.at(change, start[held] + length[held], -1)
            row = [row[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
        kept.append(b" ".join(row))
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([len(row) for row in words], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "kept"],
    )
