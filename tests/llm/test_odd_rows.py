"""Rows that are legal but unusual: huge headers, hosts and vectors, shared ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import ngram_jaccard, url_filter, vector_graph, warc


@pytest.mark.parametrize("split", [100_000, warc.SPLIT_BYTES])
def test_long_headers_come_back(spark, split):
    # Random, so that the header is long in compressed form too; and a blank line on a block's edge.
    letters = np.random.default_rng(1).integers(97, 123, 3_000_000, np.uint8).tobytes().decode()
    urls = [f"http://a/{letters}", "http://b/", f"http://c/{letters[: (1 << 20) - 200]}", "x" * 5_000_000]
    urls += [f"http://d/{letters[: (1 << 20) - k]}" for k in range(236, 260)]
    pages = spark.createDataFrame([(i, u, f"<p>{i % 3}") for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in warc.archive_round_trip(pages, split_bytes=split).collect()}
    assert sorted(got) == list(range(len(urls)))
    assert all(got[i]["url"] == u and got[i]["payload_bytes"] == 4 for i, u in enumerate(urls))
    assert [i for i in got if got[i]["record_type"] == "response"].__len__() == 3


def test_cut_off_header_is_an_error(spark, tmp_path):
    data = warc.record_bytes(1, "http://a/" + "".join(map(str, range(200_000))), b"<p>", None, "1970-01-01T00:00:00Z")
    (tmp_path / "cut.warc.gz").write_bytes(data[: len(data) // 2])
    with (tmp_path / "cut.warc.gz").open("rb") as f, pytest.raises(ValueError, match="header"):
        list(warc.records_in(f, len(data) // 2, 0, len(data) // 2))


def test_hosts_of_many_labels(spark):
    urls = ["http://" + "a." * n + "example.com/en/x" for n in (0, 1, 8_000, 40_000)]
    urls += ["http://" + "b" * 100_000 + ".net/es/", "http://" + "." * 50_000, "http://" + "c" * 100_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame(
        [("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()}
    assert [got[i] for i in range(7)] == [("example.com/en/", "block")] * 4 + [("net/es/", "block")] + [(None, "allow")] * 2


def _recall(spark, x, **options):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {}
    for q, _, v, s in vector_graph.nearest(df, **options).collect():
        found.setdefault(q, []).append((s, v))
    hit = total = 0
    for q in range(0, len(x), 100):
        d = vector_graph.distances(x, x[q])
        best = sorted((d[v], v) for v in range(len(x)) if v != q)[:10]
        assert len(found[q]) == 10 and all(s == pytest.approx(d[v], rel=1e-12) for s, v in found[q])
        # A distance as small as the tenth's counts: which of equal ones is met is chance.
        hit += sum(s <= best[-1][0] for s, _ in found[q])
        total += 10
    return hit / total


@pytest.mark.parametrize("kind", ["huge", "largest", "tiny", "shifted", "outlier", "outliers", "spread"])
def test_vectors_anywhere(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 16))
    if kind == "huge":
        x *= 1e19
    elif kind == "largest":
        x *= 1.7e308 / np.abs(x).max()
    elif kind == "tiny":
        x *= 1e-30
    elif kind == "shifted":
        x = 1000 + 0.1 * x
    elif kind == "outlier":
        x[100] *= 1e19
    elif kind == "outliers":
        x[::7] *= 1e40
    elif kind == "spread":
        x *= 10.0 ** rng.integers(-5, 6, 1200)[:, None]
    assert _recall(spark, x, shard_rows=500) >= 0.95


def test_one_of_each_by_row(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    rows = [
        (1, a, "s"), (1, b, "s"),  # two texts under one id: both stay
        (2, a, "s"), (None, b, "s"), (3, b.upper(), "s"),  # copies go, also those without an id
        (None, c, "s"), (None, c, "t"),  # copies without ids: one stays
        (4, "", "s"), (5, None, "s"), (4, "", "t"),  # without words: one row for each id
        (None, None, "u"), (None, "  ", "v"), (None, None, "w"),  # nothing tells these apart: all stay
        (1, a, "s"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _key string").repartition(3)
    left = ngram_jaccard.one_of_each(docs, 5, 80)
    assert left.columns == docs.columns
    got = left.withColumn("_key", F.when(F.col("text") != c, F.col("_key"))).collect()
    want = [(1, a, "s"), (1, b, "s"), (None, c, None), (5, None, None), (None, None, None), (None, "  ", "v"), (None, None, None)]
    assert sorted(map(repr, (tuple(r) for r in got if r["doc_id"] != 4))) == sorted(map(repr, want))
    assert [r["text"] for r in got if r["doc_id"] == 4] == [""]
