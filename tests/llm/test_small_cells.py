"""Small (language, source) cells are judged by the language, then by all documents."""

import random

from tillspark.llm import quality


def test_outliers_of_small_cells(spark):
    rng = random.Random(1)

    def prose():
        return " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(80, 160)))

    odd = " ".join(f"#${i}%&*" for i in range(100))
    rows = [(i, prose(), "en", "large") for i in range(200)]
    rows += [(300, prose(), "en", "tiny"), (301, odd, "en", "tiny")]
    rows += [(400, prose(), "mt", "tiny"), (401, odd, "mt", "tiny"), (402, odd, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r for r in quality.assess(frame).collect()}
    assert all(r["distance"] is not None for r in found.values() if not r["base_failed"])
    assert not found[301]["base_failed"] and not found[401]["base_failed"]
    assert [found[d]["kept"] for d in (300, 301, 400, 401, 402)] == [True, False, True, False, False]
