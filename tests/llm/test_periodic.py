"""Periodic runs against a search by every period, on texts made to be hard."""

import random
import zlib

import pytest

from tillspark.llm import periodic

SCHEMA = "doc_id long, text string, runs string, kept string, n_words int, start long"


def plain(words, least=12):
    """(start, length, period) of every run, by comparing the words with themselves moved."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end - at >= period:
                found.setdefault((at, end + period), period)
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= least)


def plain_kept(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return [w for i, w in enumerate(words) if i not in gone]


def fibonacci(n):
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def hard_text(rng):
    size, letters = rng.randrange(500), rng.choice([1, 2, 2, 3, 5, 20])
    kind = rng.randrange(6)
    if kind == 0:
        return [b"%d" % rng.randrange(letters) for _ in range(size)]
    if kind == 1:  # one period, broken in places
        block = [b"%d" % rng.randrange(letters) for _ in range(rng.randrange(1, 80))]
        text = (block * size)[:size]
        for _ in range(rng.randrange(4)):
            if text:
                text[rng.randrange(len(text))] = b"z"
        return text
    if kind == 2:
        return fibonacci(size)
    if kind == 3:  # no cube, and many squares
        return [b"%d" % (i.bit_count() % 2) for i in range(size)]
    if kind == 4:  # two periodic regions that meet in the middle of a longer period
        half = [b"a", b"b"] * rng.randrange(1, 120)
        text = half + [b"a"] * rng.randrange(3) + half[::-1]
        return text + text if rng.random() < 0.5 else text
    word = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 5))] * 40)[: rng.randrange(12, 100)]
    between = [b"%d" % rng.randrange(9) for _ in range(rng.randrange(10))]
    return between + word + word + between + word + word


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_a_search_by_every_period(seed):
    rng = random.Random(seed)
    for _ in range(25):
        texts = [hard_text(rng) for _ in range(rng.randrange(1, 15))]
        found = {}
        for text, *run in zip(*(v.tolist() for v in periodic.find_runs(texts)), strict=True):
            found.setdefault(text, []).append(tuple(run))
        for k, words in enumerate(texts):
            assert found.get(k, []) == plain(words), b" ".join(words)


def test_lengths_at_the_edges():
    for size, expected in ((11, []), (12, [(0, 12, 1)])):
        assert plain([b"a"] * size) == expected
        found = zip(*(v.tolist() for v in periodic.find_runs([[b"a"] * size])))
        assert [tuple(run[1:]) for run in found] == expected
    block = [b"%d" % k for k in range(40)]
    for extra in (-1, 0, 1):
        words = (block * 3)[: 80 + extra]
        found = [tuple(map(int, run[1:])) for run in zip(*periodic.find_runs([words]))]
        assert found == plain(words) == ([(0, 80 + extra, 40)] if extra >= 0 else [])


def test_neighbouring_texts_do_not_meet():
    words = [b"%d" % k for k in range(30)]
    assert not len(periodic.find_runs([words, words, [], words])[0])


def test_repeating_words():
    words = [b"%d" % k for k in range(50)]
    chosen = [d for d in range(300) if zlib.crc32(str(d).encode()) % 10 == 0]
    for doc_id in range(300):
        found = periodic.repeating(doc_id, words)
        if doc_id not in chosen:
            assert found == words
            continue
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert found == [words[i if i < a else a + (i - a) % p] for i in range(50)]
    assert periodic.repeating(None, words) == words and periodic.repeating(chosen[0], []) == []


def test_odd_rows(spark):
    long = " ".join(f"w{k % 700}" for k in range(9_000))
    same = "ha " * 40
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, same), (5, same), (5, same), (6, long), (7, "x" * 90_000),
        (8, "Ha ha " * 20), (9, "é   é   " * 9),
    ]
    docs = spark.createDataFrame([(*r, "a", "b", 1, 2) for r in rows], SCHEMA)
    found = periodic.collapse(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "kept"]
    answers = sorted(map(repr, ((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in found.collect())))
    expected = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        runs = plain(words) if doc_id != 6 else [(0, 9_000, 700)]
        expected.append((doc_id, len(words), runs, b" ".join(plain_kept(words, runs)).decode()))
    assert answers == sorted(map(repr, expected))
    assert not periodic.collapse(docs.limit(0)).count()
