import math
import re
from collections import Counter
from random import Random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillspark.functions.text import STOP_WORDS, terms
from tillspark.operators.similarity import content_similar, tfidf_terms
from tillspark.settings import Recommend


def bag_of(text):
    words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in STOP_WORDS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_vectors(catalogue):
    bags = {k: Counter(bag_of(t)) for k, t in catalogue.items()}
    df = Counter(term for bag in bags.values() for term in bag)
    floor = min(2, max(df.values(), default=1))
    vectors = {}
    for key, bag in bags.items():
        raw = {
            t: n * (math.log((1 + len(bags)) / (1 + df[t])) + 1)
            for t, n in bag.items()
            if df[t] >= floor
        }
        length = math.sqrt(sum(v * v for v in raw.values()))
        vectors[key] = {t: v / length for t, v in raw.items()}
    return vectors


def brute_neighbours(catalogue, cold, top_n):
    vectors = brute_vectors(catalogue)
    found = []
    for src in sorted(cold):
        scores = []
        for dst, other in vectors.items():
            cosine = round(sum(w * other.get(t, 0.0) for t, w in vectors[src].items()), 9)
            if dst != src and cosine > 0:
                scores.append((-cosine, dst))
        found += [(src, dst, at) for at, (_, dst) in enumerate(sorted(scores)[:top_n], 1)]
    return sorted(found)


def catalogue_of(seed, size, words):
    random = Random(seed)
    vocabulary = [f"word{i}" for i in range(words)]
    # Few words are on most products, as in a real catalogue; some texts repeat.
    weights = [1 / (i + 1) for i in range(words)]
    texts = [" ".join(random.choices(vocabulary, weights, k=random.randrange(1, 6))) for _ in range(size)]
    return {f"P{i:03d}": random.choice(texts) if i % 3 == 0 else texts[i] for i in range(size)}


def frames(spark, catalogue, covered):
    products = spark.createDataFrame(list(catalogue.items()), "stock_code string, description string")
    return products, spark.createDataFrame([(c,) for c in covered], "stock_code string")


def test_terms_pair_up_after_stop_words_go(spark):
    text = spark.createDataFrame([("The Box of É_1 and x ring!",), ("a",), ("",)], "t string")
    assert [r[0] for r in text.select(terms(F.col("t"))).collect()] == [
        ["box", "é_1", "ring", "box é_1", "é_1 ring"], [], [],
    ]


def test_weights_match_the_formula(spark):
    catalogue = catalogue_of(1, 40, 20)
    products, _ = frames(spark, catalogue, ["none"])
    found = {
        (r["stock_code"], r["term"]): r["weight"]
        for r in tfidf_terms(products, "stock_code", "description").collect()
    }
    expected = {(k, t): w for k, v in brute_vectors(catalogue).items() for t, w in v.items()}
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k], abs=1e-12) for k in found)


def test_single_use_words_serve_when_nothing_else_does(spark):
    products, _ = frames(spark, {"A": "red", "B": "blue"}, ["none"])
    assert rows(tfidf_terms(products, "stock_code", "description"), "term", "weight") == [
        ("blue", 1.0), ("red", 1.0),
    ]


@pytest.mark.parametrize(
    "seed, common_term, block, broadcast_rows",
    [(2, 256, 512, 200_000), (3, 3, 512, 200_000), (4, 2, 7, 200_000), (5, 0, 5, 200_000), (6, 4, 9, 0)],
)
def test_neighbours_match_brute_force(spark, seed, common_term, block, broadcast_rows):
    """Through rare terms alone, through common terms alone, and through both together."""
    catalogue = catalogue_of(seed, 90, 25)
    covered = [k for i, k in enumerate(catalogue) if i % 4 == 0]
    products, ruled = frames(spark, catalogue, covered)
    found = content_similar(
        products, ruled, Recommend(top_n=4), common_term, block, broadcast_rows
    )
    expected = brute_neighbours(catalogue, set(catalogue) - set(covered), 4)
    assert rows(found, "stock_code", "recommended_stock_code", "rank") == expected


def test_unusable_or_small_catalogues_give_nothing(spark):
    small, none = frames(spark, {"A": "red mug", "B": "red mug"}, ["x"])
    assert content_similar(small, none).count() == 0
    unknown, none = frames(spark, {f"P{i}": "UNKNOWN" for i in range(9)}, ["x"])
    assert content_similar(unknown, none).count() == 0
    wordless, none = frames(spark, {f"P{i}": "the a" for i in range(9)}, ["x"])
    assert content_similar(wordless, none).count() == 0
