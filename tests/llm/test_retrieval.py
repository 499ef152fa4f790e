"""Ranked search against scores added up term by term, with every limit forced."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillspark.llm import retrieval

DOCS = "doc_id long, text string, rank string, item_id int, score string, n_docs long"
ITEMS = "item_id string, text string, item string, doc_id long"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    raw = (text or "").encode()
    return TERM.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in raw))


def plain(docs, items, top):
    """(item_id, rank, doc_id, score) in whole numbers."""
    held = [Counter(terms(text)) for _, text in docs]
    sizes = [sum(h.values()) for h in held]
    n_docs, all_terms = sum(1 for s in sizes if s), sum(sizes)
    df = Counter(t for h in held for t in h)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, _), h, n in zip(docs, held, sizes):
            m = 75 + (25 * n * n_docs) // all_terms if n else 0
            score = 0
            for t, times in Counter(terms(text)).items():
                if h[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1_000_000_000 * h[t]) // (1000 * h[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda row: row[:3])
        out += [(item_id, k, row[3], -row[0]) for k, row in enumerate(scored[:top], 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    vocabulary = [f"t{int(rng.paretovariate(0.8))}" for _ in range(400)] + ["Été", "ÉTÉ", "x_y", "Foo-bar"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    docs = [(k, prose(rng.randrange(1, 80))) for k in range(150)]
    same = prose(20)
    docs += [(300 + k, same) for k in range(60)]  # more ties than places
    docs += [(10, same), (10, same), (None, same), (None, None), (400, None), (401, ""), (402, " -- "),
             (403, prose(9_000)), (404, "\U0001f600 t1 T1")]
    rng.shuffle(docs)
    items = [(f"i{k}", prose(rng.randrange(1, 30))) for k in range(40)]
    items += [("same", same), ("same", same), (None, "t1 t2"), ("none", None), ("empty", ""), ("unknown", "qqqq")]
    return docs, items


@pytest.mark.parametrize(
    "limits", [{}, {"top": 3, "block_words": 60, "tile_items": 5, "safe": 1 << 34}, {"safe": 1 << 20}]
)
def test_ranks_equal_plain_scores(spark, tables, limits):
    docs, items = tables
    frame = spark.createDataFrame([(*d, "r", 1, "s", 2) for d in docs], DOCS).repartition(7)
    asked = spark.createDataFrame([(*i, "x", 5) for i in items], ITEMS)
    found = retrieval.search(frame, asked, **limits)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = plain(docs, items, limits.get("top", 20))
    if "block_words" in limits:  # a repeated item is answered once for each of its rows
        assert set(map(tuple, found.collect())) == set(expected)
    assert Counter(map(tuple, found.collect())) == expected


def test_empty_tables(spark, tables):
    docs, items = tables
    frame = spark.createDataFrame([(*d, "r", 1, "s", 2) for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, "x", 5) for i in items], ITEMS)
    assert not retrieval.search(frame.limit(0), asked).count()
    assert not retrieval.search(frame, asked.limit(0)).count()


def test_products_are_exact_beyond_doubles():
    rng = np.random.default_rng(1)
    wanted = rng.integers(0, 30_000, (7, 300)).astype(float)
    impact = rng.integers(0, 1_000_000, (300, 40)).astype(float)
    exact = wanted.astype(np.int64) @ impact.astype(np.int64)
    for safe in (1, 1 << 36, 1 << 53):
        assert (retrieval.scores(wanted, impact, safe) == exact).all()
    cut = list(retrieval.cuts(np.array([5, 5, 5, 50, 1]), most=2, safe=11))
    assert [(s.start, s.stop) for s in cut] == [(0, 2), (2, 3), (3, 4), (4, 5)]
