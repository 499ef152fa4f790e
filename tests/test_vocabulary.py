"""Terms of a single document do not count towards a vocabulary too large to be sent."""

import math
from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from tillspark.operators import similarity


def _weights(spark, docs, broadcast_rows):
    frame = spark.createDataFrame(list(docs.items()), "k long, found array<string>")
    return similarity.term_weights(frame, "k", F.col("found"), broadcast_rows=broadcast_rows)


def _rows(weights):
    return sorted((*r[:5], round(r["weight"], 12)) for r in weights.collect())


def test_single_terms_are_left_out_before_they_are_counted(spark):
    docs = {n: [f"own{n}", f"mine{n}", "all", "even" if n % 2 == 0 else "odd"] for n in range(20)}
    sent = _weights(spark, docs, 5)
    assert "_deal" not in sent._jdf.queryExecution().optimizedPlan().toString()
    assert {r["term"] for r in sent.collect()} == {"all", "even", "odd"}
    assert _rows(sent) == _rows(_weights(spark, docs, 200_000)) == _rows(_weights(spark, docs, 1))


def test_a_vocabulary_of_single_terms_stays_whole(spark):
    docs = {n: [f"own{n}", f"mine{n}"] for n in range(20)}
    found = _rows(_weights(spark, docs, 1))
    assert len(found) == 40 and found == _rows(_weights(spark, docs, 200_000))


def _texts(size, words):
    random = Random(size)
    weights = [1 / (i + 1) for i in range(words)]
    return [random.choices([f"word{i}" for i in range(words)], weights, k=12) for _ in range(size)]


def _by_hand(docs):
    """Rows of documents that may share a key or have none; lengths are by key."""
    counts = [(key, Counter(found or [])) for key, found in docs]
    df = Counter(term for _, bag in counts for term in bag)
    floor = min(2, max(df.values(), default=1))
    raw = [
        (key, term, tf, df[term], tf * (math.log((1 + len(docs)) / (1 + df[term])) + 1))
        for key, bag in counts for term, tf in bag.items() if df[term] >= floor
    ]
    square = Counter()
    for key, *_, weight in raw:
        square[key] += weight * weight
    return sorted(
        ((k, t, tf, n, n, round(w / math.sqrt(square[k]), 12)) for k, t, tf, n, w in raw), key=repr
    )


@pytest.mark.parametrize(
    "broadcast_rows, round_rows", [(0, 0), (30, 0), (200_000, 0), (1, 2_000_000)]
)
def test_rounds_give_every_row_of_repeated_and_missing_keys(spark, broadcast_rows, round_rows):
    docs = [(n % 50 or None, found) for n, found in enumerate(_texts(60, 80))]
    docs += [(7, None), (None, []), (8, ["alone"]), (9, ["word0", "word0 word1"] * 3)]
    frame = spark.createDataFrame(docs, "k long, found array<string>")
    found = similarity.term_weights(
        frame, "k", F.col("found"), broadcast_rows=broadcast_rows, round_rows=round_rows
    )
    rows = sorted(((*r[:5], round(r["weight"], 12)) for r in found.collect()), key=repr)
    assert rows == _by_hand(docs)


def test_rounds_keep_a_vocabulary_of_single_terms(spark):
    docs = [(n, [f"own{n}", f"mine{n}"]) for n in range(20)]
    frame = spark.createDataFrame(docs, "k long, found array<string>")
    found = similarity.term_weights(frame, "k", F.col("found"), round_rows=0)
    assert sorted(((*r[:5], round(r["weight"], 12)) for r in found.collect()), key=repr) == _by_hand(docs)


def test_terms_of_documents_stay_where_they_are_counted(spark, monkeypatch):
    """What the caller reads has no shuffle, and only one round's terms without their documents."""
    docs = list(enumerate(_texts(300, 200)))
    frame = spark.createDataFrame(docs, "k long, found array<string>")
    staged = []
    once = similarity.stage_observed

    def noted(df, name, *args, **totals):
        out = once(df, name, *args, **totals)
        staged.append((name, out[1]["rows"]))
        return out

    monkeypatch.setattr(similarity, "stage_observed", noted)
    found = similarity.term_weights(frame, "k", F.col("found"), broadcast_rows=20, round_rows=100)
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
    parts = [rows for name, rows in staged if name == "vocabulary"]
    assert len(parts) == similarity.SLICES and max(parts) < sum(parts)
    # The tables of documents with all their terms are gone by then.
    assert not any("/terms-" in file or "/vocabulary-" in file for file in found.inputFiles())
    assert found.count() == len(_by_hand(docs))
