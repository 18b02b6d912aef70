import numpy as np
from pyspark.sql import functions as F

from fareloom.llm import ngram_jaccard


def test_first_block_sends_no_more_than_an_entry(spark):
    """The widest shuffle of the join: an n-gram, a class and a place, nothing that can be found later."""
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g x"), (3, None)], "doc_id long, text string")
    texts = ngram_jaccard._texts(docs, "doc_id", "text")
    block = ngram_jaccard._first_block(texts, np.zeros(ngram_jaccard.COUNT_BUCKETS, np.int64), 4, 50)
    assert block.columns == ["gram", "class", "pos"]
    rows = block.collect()
    assert sorted(r["pos"] for r in rows) == [0, 0, 1, 1, 2, 2]


def test_prev_is_the_ngram_before_or_null(spark):
    column = spark.createDataFrame(
        [(10, 1, 0), (11, 1, 1), (13, 1, 3), (11, 2, 5), (14, 2, 6)], "gram long, class long, pos int"
    )
    found = ngram_jaccard._with_prev(column)
    assert found.columns == ["gram", "class", "pos", "prev"]
    assert {(r["class"], r["pos"]): r["prev"] for r in found.collect()} == {
        (1, 0): None, (1, 1): 10, (1, 3): None, (2, 5): None, (2, 6): 11,
    }


def test_second_round_misses_no_component(spark):
    """Near copies in several groups under common n-grams, against every pair compared."""
    rng = np.random.default_rng(11)
    texts = []
    for g in range(12):
        base = [f"w{w}" for w in rng.integers(0, 60, 40)]
        for _ in range(8):
            own = list(base)
            for at in rng.integers(0, 40, rng.integers(0, 3)):
                own[at] = f"w{rng.integers(0, 60)}"
            texts.append(" ".join(own))
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(4)
    sets = [{tuple(w[i : i + 2]) for i in range(len(w) - 1)} for w in (t.split() for t in texts)]
    smallest = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 70 * len(a | b):
                    smallest[i] = min(smallest[i], smallest[j])
    found = ngram_jaccard.jaccard_components(docs, 2, 70).select("doc_id", F.col("component_id")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(smallest))
