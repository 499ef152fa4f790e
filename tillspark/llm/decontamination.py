"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised test items is built on the driver from at most
`block_words` words of the benchmark at a time and sent to the tasks, which
stream each document through it. The state after a word stands for the longest
text ending there that occurs in an item; where that is at least `window` words
long, a window has occurred. An item of fewer words counts as one window. A
larger benchmark takes one pass over the documents for each block of items;
the passes hand on what they found with the row, so nothing is shuffled.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Null and
empty texts have no words and are clean; items without words match nothing;
items that share an id count once, and a null id counts as the empty id.
Repeated rows each get their result; an empty benchmark leaves every row clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark.llm.text import byte_column
from tillspark.sources.staging import stage

WINDOW = 10
BLOCK_WORDS = 500_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
COVERAGE_LIMIT = 0.5
RESULTS = ("n_words", "hit_spans", "hit_items")


class SuffixAutomaton:
    """Substrings of many word sequences, with the items each window belongs to."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(n, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for n, ws in items if ws]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extended(last, code)
        self.whole: dict[int, list[tuple[int, str]]] = {}  # short items by state
        self.holders: dict[int, set[str]] = {}  # items by state of a window
        self.shortest = min((min(len(codes), window) for _, codes in coded), default=0)
        for name, codes in coded:
            state = 0
            for at, code in enumerate(codes, 1):
                state = self.step[state][code]
                if at >= window:
                    self.holders.setdefault(self._window_state(state), set()).add(name)
            if len(codes) < window:
                self.whole.setdefault(state, []).append((len(codes), name))

    def _extended(self, last: int, code: int) -> int:
        step, link, length = self.step, self.link, self.length

        def split(parent: int, state: int) -> int:
            if length[parent] + 1 == length[state]:
                return state
            step.append(dict(step[state]))
            link.append(link[state])
            length.append(length[parent] + 1)
            link[state] = copy = len(step) - 1
            while parent >= 0 and step[parent].get(code) == state:
                step[parent][code] = copy
                parent = link[parent]
            return copy

        if code in step[last]:
            return split(last, step[last][code])
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        new, at = len(step) - 1, last
        while at >= 0 and code not in step[at]:
            step[at][code] = new
            at = link[at]
        if at >= 0:
            link[new] = split(at, step[at][code])
        return new

    def _window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def matches(self, codes: list[int], offset: int) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of every window occurrence among known words."""
        state = held = 0
        for at, code in enumerate(codes, offset + 1):
            while state and code not in self.step[state]:
                state = self.link[state]
                held = self.length[state]
            state = self.step[state].get(code, 0)
            held = held + 1 if state else 0
            if held >= self.window:
                yield at - self.window, at, self.holders[self._window_state(state)]
            above = state
            while self.whole and above > 0:
                for size, name in self.whole.get(above, ()):
                    if size <= held:
                        yield at - size, at, {name}
                above = self.link[above]

    def scanned(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged hit intervals, items found."""
        known = np.array(list(map(self.ids.get, WORD.findall(text.lower()), repeat(-1))), np.int64)
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.shortest or len(known) < self.shortest:
            return len(known), spans, found
        gaps = np.flatnonzero(np.concatenate(([True], known < 0, [True])))
        for k in np.flatnonzero(np.diff(gaps) > self.shortest):
            first, end = gaps[k], gaps[k + 1] - 1
            for start, stop, names in self.matches(known[first:end].tolist(), int(first)):
                spans.append((start, stop))
                found |= names
        return len(known), merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    whole: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if whole and start <= whole[-1][1]:
            whole[-1] = (whole[-1][0], max(stop, whole[-1][1]))
        else:
            whole.append((start, stop))
    return whole


def mark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """All rows and columns of `docs`, and n_words, hit_spans (first word and end of each run,
    in turn), hit_items (ids as strings), which replace columns of those names."""
    spark = docs.sparkSession
    docs = docs.drop(*RESULTS)
    sized = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * block_words)))  # a word and its gap take 2 characters or more
    marked = docs.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hit_spans"),
        F.array().cast("array<string>").alias("hit_items"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in marked.schema])
    for block in range(blocks):
        chosen = sized.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        items = sorted((r[0], WORD.findall(r[1].encode().lower())) for r in chosen.collect())
        sent = spark.sparkContext.broadcast(SuffixAutomaton(items, window))

        def scan(batches, sent=sent):
            for batch in batches:
                yield _scanned(batch, sent.value)

        marked = marked.mapInArrow(scan, schema)
        if block < blocks - 1:
            marked = stage(marked, "decontaminate-block")
    return marked


def _scanned(batch: pa.RecordBatch, automaton: SuffixAutomaton) -> pa.RecordBatch:
    names = batch.schema.names
    before = batch.column(names.index("hit_spans")).to_pylist()
    items = batch.column(names.index("hit_items")).to_pylist()
    counts, hits, held = [], [], []
    for text, old, known in zip(byte_column(batch, "text"), before, items, strict=True):
        count, spans, found = automaton.scanned(text)
        if old:
            spans = merged([*spans, *zip(old[::2], old[1::2], strict=True)])
        counts.append(count)
        hits.append([edge for span in spans for edge in span])
        held.append(sorted(found.union(known)))
    columns = dict(zip(names, batch.columns, strict=True))
    columns["n_words"] = pa.array(counts, pa.int64())
    columns["hit_spans"] = pa.array(hits, batch.schema.field("hit_spans").type)
    columns["hit_items"] = pa.array(held, batch.schema.field("hit_items").type)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=names)


def hit_words(spans: str = "hit_spans"):
    """Words inside the runs: ends less starts."""
    signed = F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage_limit: float = COVERAGE_LIMIT,
) -> DataFrame:
    """`docs` without their runs of hit words, each `window` words or a whole item at least, and
    without documents of which more than `coverage_limit` is hit. Clean texts stay as they are.
    Columns named like those of `mark` go."""
    docs = docs.drop(*RESULTS)
    marked = mark(docs, benchmark, window)
    share = hit_words() / F.greatest("n_words", F.lit(1))
    marked = marked.where(share <= coverage_limit)
    kept = docs.columns

    def cut(batches):
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            spans = batch.column(names.index("hit_spans")).to_pylist()
            for at, edges in enumerate(spans):
                if edges:
                    texts[at] = _without(texts[at], edges)
            columns = dict(zip(names, batch.columns, strict=True))
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays([columns[name] for name in kept], kept)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return marked.mapInArrow(cut, schema)


def _without(text: str, edges: list[int]) -> str:
    raw = text.encode()
    places = [m.span() for m in WORD.finditer(raw.lower())]
    kept, done = [], 0
    for first, end in zip(edges[::2], edges[1::2], strict=True):
        kept.append(raw[done : places[first][0]])
        done = places[end - 1][1]
    return b"".join([*kept, raw[done:]]).decode()
