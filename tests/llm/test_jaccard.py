"""The n-gram Jaccard join against all pairs of a small table, with every path forced."""

import random
from collections import Counter

import pytest

from tillspark.llm import jaccard

SCHEMA = "doc_id long, text string, name string, size long, a string, text_key string, pivot int"


def sets_of(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in words.replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain(docs, percent=80):
    """(doc_id, n_shingles, component_id) of every row, by all pairs."""
    held = [sets_of(text) for _, text in docs]
    label = list(range(len(docs)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, x in enumerate(held):
        for j in range(i):
            y = held[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                label[root(i)] = root(j)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return Counter((d, len(held[k]), least.get(root(k))) for k, (d, _) in enumerate(docs))


def family(rng, words, count, edits):
    base = [rng.choice(words) for _ in range(80)]
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(len(text))] = rng.choice(words)
        yield " ".join(text)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    texts = [None, "", " \n", "one", "ONE", "one two", "one two three four five", "é É", "É É"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 120))) for _ in range(60)]
    for edits in (1, 2, 3, 4, 6):
        texts += family(rng, words, 40, edits)
    shared = " ".join(rng.choice(words) for _ in range(60))
    texts += [f"{shared} {' '.join(rng.choice(words) for _ in range(n))}" for n in range(2, 60, 2)]
    texts += ["copy " * 30] * 40 + [" ".join(["long"] + [rng.choice(words) for _ in range(6_000)])] * 2
    rows = [(k, text) for k, text in enumerate(texts)]
    rows += [(7, "one two"), (3, "one"), (None, "one two"), (None, "seldom seen words stand here"), (None, None)]
    rng.shuffle(rows)
    return rows


def found(spark, docs, **limits):
    frame = spark.createDataFrame([(*d, "x", 1, "y", "z", 3) for d in docs], SCHEMA)
    out = jaccard.components(frame.repartition(5), **limits)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return Counter(map(tuple, out.collect()))


@pytest.mark.parametrize("limits", [{}, {"part_rows": 7, "range_chars": 3_000}, {"percent": 60, "part_rows": 15}])
def test_components_equal_all_pairs(spark, docs, limits):
    assert found(spark, docs, **limits) == plain(docs, limits.get("percent", 80))


def test_empty_table(spark):
    assert not found(spark, [])


def test_a_group_of_copies_is_sent_once_and_gives_a_spanning_set(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    texts = list(family(rng, words, 400, 2))
    docs = spark.createDataFrame(list(enumerate(texts)), "name long, text string")
    ordered = jaccard.rare_first(jaccard.shingle_sets(docs))
    links = jaccard.links(ordered)
    assert links.count() < 3 * len(texts)


def test_shingles_do_not_depend_on_their_neighbours():
    texts = [b"a b c d e f", b"b c d e f", b"x", b"", b"X", b"a b c d"]
    tokens, text = jaccard.shingled(texts)
    alone = [set(jaccard.shingled([t])[0].tolist()) for t in texts]
    assert [set(tokens[text == k].tolist()) for k in range(len(texts))] == alone
    assert [len(a) for a in alone] == [2, 1, 1, 0, 1, 1]
    assert alone[1] < alone[0] and alone[2] == alone[4] and alone[5] & alone[0] == set()
