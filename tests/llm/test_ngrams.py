"""The n-gram trie, level by level, and the scores of a plain model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillspark.llm import ngrams
from tillspark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size, top", [(0, 1), (1, 1), (1, 1 << 60), (7, 9), (500, 510), (3_000, 1 << 40), (900, 1 << 63)])
def test_sequences_are_read_back_and_searched(size, top):
    rng = np.random.default_rng(size)
    values = np.unique(rng.integers(0, top, size, np.uint64, endpoint=True))
    levels = ngrams.Levels()
    level = ngrams.EliasFano(values, levels)
    levels.mapped()
    assert (level.decoded() == values).all()
    wanted = np.concatenate([values, rng.integers(0, top, 300, np.uint64, endpoint=True), np.array([0, top], np.uint64)])
    places = {int(v): k for k, v in enumerate(values)}
    assert level.found(wanted).tolist() == [places.get(int(w), -1) for w in wanted]


def test_pointers_lead_to_the_successors_of_a_context():
    rng = np.random.default_rng(3)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 40, 600), rng.integers(0, 90, 600))})
    context, word = (np.array(v, np.uint64) * np.uint64(1 << 50) // np.uint64(97) for v in zip(*pairs))
    count = rng.integers(1, 9, len(pairs))
    total = np.array([sum(c for p, c in zip(pairs, count) if p[0] == a) for a, _ in pairs])
    trie = ngrams.TrieShard(context, word, count, total)
    every = [(a, b) for a in range(41) for b in range(91)]
    a, b = (np.array(v, np.uint64) * np.uint64(1 << 50) // np.uint64(97) for v in zip(*every))
    found = trie.codes_of(a, b)
    taken = np.minimum(ngrams.discount(count), count)
    held = dict(zip(pairs, ngrams.quantised((count - taken) / total)))
    assert found.tolist() == [held.get(pair, 0) for pair in every]


def test_scores_equal_a_plain_model(spark):
    """Interpolated absolute discounting over word pairs; probabilities in steps of 9/254 and
    9/65534 of a decade, as the levels hold them."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    lower = {c: c + 32 for c in range(65, 91)}
    tokens = {r[0]: [*re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(lower)), ""] for r in docs}
    trained = [ws for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    words = Counter(w for ws in trained for w in ws)
    pairs = Counter(p for ws in trained for p in zip(["", *ws], ws))
    total, size = sum(words.values()), len(words)
    n = [max(1, sum(1 for c in pairs.values() if c == k)) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    steps = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.02) for k in (1, 2, 3)]

    def stepped(share, top):
        if share <= 0:
            return 0.0
        code = min(max(top + round(math.log10(share) * (top - 1) / 9), 1), top)
        return 10 ** ((code - top) * 9 / (top - 1))

    freed = Counter()
    for (a, _), c in pairs.items():
        freed[a] += steps[min(c, 3) - 1] / words[a]
    freed = {a: stepped(share, 65_535) for a, share in freed.items()}
    found = {r["doc_id"]: r["score"] for r in QUERIES["op7_ngram_scores"](spark, SF_DIR).collect()}
    for d, ws in tokens.items():
        score = 0.0
        for a, b in zip(["", *ws], ws):
            c = pairs[a, b]
            more = stepped((c - steps[min(c, 3) - 1]) / words[a], 255) if c else 0.0
            score += math.log10(more + freed.get(a, 1.0) * (words[b] + 1) / (total + size + 1))
        assert math.isclose(found[d], score, rel_tol=2e-3), d
