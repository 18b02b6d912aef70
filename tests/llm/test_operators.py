"""Brute force on small inputs: every operator on nulls, blanks, long texts, ties and repeated rows."""

import hashlib
import random
import re
import struct
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import parity
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from fareloom.llm import (
    fingerprints,
    licenses,
    mixing,
    ngram_jaccard,
    packing,
    quality,
    token_counts,
    url_filter,
    vector_graph,
    warc,
)
from fareloom.llm.components import components

BPE = public_tokenizers.path("word_bpe_49k.json")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi".split()
LICENCE = "Licensed under the Apache License, Version 2.0."


def _texts():
    rnd = random.Random(7)

    def prose(n):
        return " ".join(rnd.choice(WORDS) + rnd.choice(("", "s", "ed", "ly")) for _ in range(n))

    base = prose(120).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in (3, 60, 117)]
    far = " ".join(base[:60]) + " " + prose(60)
    return [
        None, "", " \t\n ", "one", "one two three", " ".join(base), " ".join(base), *near, far,
        prose(30_000), "x" * 50_000, prose(5) + "\n" + LICENCE + "\nend of it", LICENCE.upper(),
        "naïve ÉTÉ ǅ İstanbul don't I'LL 3½ <|endoftext|> \x1c \u2028 e\u0301 😀 ſ", *[prose(40) for _ in range(20)],
    ]


SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, size string, "
    "class string, n string, fill string, parts string, h string, bucket string, key string"
)


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with clashing extra columns, a null id, a null source and a repeated row."""
    clash = ("x",) * 9
    rows = [
        (i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), *clash) for i, t in enumerate(_texts())
    ]
    rows += [rows[5], (None, "no id here", None, None, None, *clash)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_token_counts(docs, empty):
    tok = Tokenizer.from_file(BPE)
    want = Counter()
    for d, t in docs.select("doc_id", "text").collect():
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want[(d, len((t or "").encode()), n, n > 2048)] += 1
    assert Counter(_rows(token_counts.token_counts(docs, BPE))) == want
    assert _rows(token_counts.token_counts(empty, BPE)) == []


def test_chunk_maps_compose():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice("ab \n") for _ in range(rnd.randrange(60)))
        assert token_counts.count_text(text, lambda t: len(t.split()), rnd.randrange(1, 9)) == len(text.split())


def test_other_tokenizers(spark):
    df = spark.createDataFrame([(1, "A  b\n<s> é"), (2, None)], "doc_id bigint, text string")
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = dict(r[::2] for r in (x[:3] for x in _rows(token_counts.token_counts(df, public_tokenizers.path("piece_bpe_32k.model")))))
    assert got == {1: len(sp.encode("A  b\n<s> é")), 2: 0}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r[0]: r[2] for r in _rows(token_counts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")))}
    assert got == {1: len(tok.encode("A  b\n<s> é").ids), 2: 0}


def test_packing(docs, empty):
    tok, cap = Tokenizer.from_file(BPE), 512
    rows = packing.best_fit_packing(docs, BPE, cap).collect()
    want = Counter()
    for d, t in docs.select("doc_id", "text").collect():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), cap)):
            part = ids[at : at + cap]
            want[(d, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= cap
    assert len(places) <= -(-sum(r["length"] for r in rows) // cap) + 1
    assert _rows(packing.best_fit_packing(empty, BPE)) == []


def test_bin_completion_beats_best_fit():
    sizes = [6, 5, 5, 4, 4, 3, 3]  # best fit needs four bins of ten
    for sizes, cap in ((sizes, 10), ([7, 6, 5, 4, 3, 3, 2], 10), ([44, 24, 24, 22, 21, 17, 8, 8, 6, 6], 60)):
        bins = packing.bin_completion(sizes, cap)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= cap for b in bins)
        assert len(bins) == -(-sum(sizes) // cap)


def test_quality(spark, docs, empty):
    good = [(i, " ".join(random.Random(i).choices(WORDS, k=80)), 1) for i in range(0, 200)]
    bad = [(i, " ".join(random.Random(i).choices(["BUY", "NOW!!", "$$$", "free"], k=80)), 0) for i in range(200, 400)]
    table = spark.createDataFrame(good + bad, "doc_id bigint, text string, quality int")
    labels = table.select("doc_id", "quality").unionByName(
        spark.createDataFrame([(None, 1), (3, None)], "doc_id bigint, quality int")
    )
    rows = quality.quality_scores(table, labels).collect()
    assert len(rows) == 400
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.5) == int(r["doc_id"] < 200)
    assert quality.quality_scores(docs, labels).count() == docs.count()
    assert quality.quality_scores(empty, labels).count() == 0
    assert quality.quality_scores(docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_good(docs, labels).columns == docs.columns


def _fingerprint(text):
    """The definition, element by element."""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return [tuple(w[i : i + fingerprints.WORDS]) for i in range(max(1, len(w) - 1))] if w else []


def test_fingerprints(docs, empty):
    rows = fingerprints.fingerprints(docs).collect()
    texts = [(d, t or "") for d, t in docs.select("doc_id", "text").collect()]
    assert len(rows) == len(texts)
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0)))
    want = Counter()
    for i, (d, t) in enumerate(order):
        n = len(t)
        edited = t[: n - n // 2] + order[(i + 1) % len(order)][1][: n // 2]
        want[(d, n, hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:3] for r in rows) == want
    own = {r["doc_id"]: r for r in rows}
    assert own[5]["fingerprint"] == [r for r in rows if r["doc_id"] == 5][1]["fingerprint"]
    assert own[0]["fingerprint"] == own[1]["fingerprint"] == own[2]["fingerprint"] == ""
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    parts = {d: own[d]["fingerprint"] for d in (6, 7, 10)}

    def alike(a, b):
        pairs = list(zip(re.findall(".{16}", a), re.findall(".{16}", b)))
        return sum(x == y for x, y in pairs) / len(pairs)

    assert alike(parts[6], parts[7]) > 0.7 > alike(parts[6], parts[10])
    assert _rows(fingerprints.fingerprints(empty)) == []


def test_fingerprint_by_definition(spark):
    """Occurrence numbers, the circle and the text order against a plain version with Spark's hash."""
    texts = ["a b a b a b c", "x", "a b c d e f g h a b c d", "q q q q q"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["p"] for r in fingerprints.with_parts(df, "text", "p").collect()}
    places, bits, n = fingerprints.PLACES, fingerprints.PLACE_BITS, fingerprints.SMALLEST

    def hashes(values, kind):
        frame = spark.createDataFrame(values, kind)
        return [r[0] for r in frame.selectExpr(f"xxhash64({', '.join(frame.columns)})").collect()]

    for t in texts:
        w = t.split()
        grams = [(w[i], w[i + 1] if i + 1 < len(w) else None) for i in range(max(1, len(w) - 1))]
        first = [h >> bits for h in hashes(grams, "a string, b string")]
        seen, numbers = Counter(), []
        for h in first:
            numbers.append(seen[h])
            seen[h] += 1
        final = hashes(list(zip(first, numbers)), "h bigint, n int")
        packed = sorted((h & ~places) | i for i, h in enumerate(final))
        want = []
        for p in fingerprints._points():
            after = [x for x in packed if x > p] + [x for x in packed if x < p]
            chosen = sorted(after[:n], key=lambda x: x & places)
            cols = ", ".join(f"array({', '.join(f'{x >> bits}L' for x in chosen)})" for _ in (1,))
            want.append(cols)
        expected = spark.sql("select " + ", ".join(f"xxhash64({c})" for c in want)).first()
        assert list(expected) == got[t]


def _shares(sizes):
    """Water filling, step by step."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: rate * weight[s] for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing(docs, empty):
    rows = mixing.mix_sizes(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_sizes(docs).collect()))
    sizes, source = Counter(), {}
    for d, t, s in docs.select("doc_id", "text", "source").collect():
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        source[d] = s
    goal = _shares(dict(sizes))
    taken = Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    largest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - goal[s]) <= largest for s in sizes)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    assert Counter(r["doc_id"] for r in mix.collect()) == Counter(
        r["doc_id"] for r in rows for _ in range(r["taken"] // r["size"] if r["size"] else 0)
    )
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mixing_targets(spark):
    for sizes in ({"a": 10, "b": 500, "c": 3, None: 80}, {"a": 0}, {"a": 5, "b": 5}, {None: 9}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(_shares(sizes))


def _groups(texts, words, percent):
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[d] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    group = {d: d for d in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = {d: lo if g == hi else g for d, g in group.items()}
    return sets, group


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard(spark, docs, empty, words, percent):
    named = docs.filter("doc_id is not null")
    texts = {r["doc_id"]: r["text"] for r in named.collect()}
    sets, group = _groups(texts, words, percent)
    for d, n, c in _rows(ngram_jaccard.jaccard_components(docs, words, percent)):
        if d is None:
            assert c is None
        else:
            assert (n, c) == (len(sets[d]), group[d])
    if words == 4:
        assert _rows(ngram_jaccard.jaccard_components(empty)) == []
        left = ngram_jaccard.one_of_each(docs, words, percent)
        assert left.columns == docs.columns
        kept = [r["doc_id"] for r in left.collect()]
        assert sorted(k for k in kept if k is not None) == sorted(set(group.values())) and kept.count(None) == 1


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 140)]
    got = dict(_rows(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    group = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in group:
        for a, b in edges:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    assert got == group


def _dice(text):
    known = [(n, set(g)) for n, _, g in licenses.template_bigrams()]
    lines = re.split("\r\n|\r|\n", text or "")
    best = []
    for s in lines + ([text] if len(lines) > 1 else []):
        w = licenses.normalised_words(s)
        own = set(zip(w, w[1:]))
        own = {f"{a} {b}" for a, b in own}
        each = [(-2 * len(own & g) / (len(own) + len(g)), n) for n, g in known if own]
        each = [e for e in each if -e[0] >= licenses.THRESHOLD]
        best += [min(each)] if each else []
    return (min(best)[1], -min(best)[0], len({n for _, n in best})) if best else (None, None, 0)


def test_licenses(docs, empty):
    want = Counter((d, *_dice(t)) for d, t in docs.select("doc_id", "text").collect())
    assert Counter(_rows(licenses.license_scan(docs))) == want
    assert sum(k[3] for k in want) == 2
    assert _rows(licenses.license_scan(empty)) == []


def test_licenses_between_lines_and_texts(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    gpl3, apache = licenses.TEMPLATES["GPL-3.0"][1], licenses.full_texts()["Apache-2.0"][0]
    prose = " ".join(f"{WORDS[i % 14]} word{i}" for i in range(150))
    texts = {
        "wrapped": (prose + "\n" + textwrap.fill(mit, 78) + "\n" + prose, ("MIT", 1.0, 1)),
        "sentence": ("This project is released under the MIT License.", ("MIT", 1.0, 1)),
        "see": ("Licensed under the Apache License, Version 2.0. See LICENSE for details.", ("Apache-2.0", 1.0, 1)),
        "nearest": (f"{prose} {gpl3} {prose}", ("GPL-3.0", 1.0, 1)),
        "two": (f"{prose} {gpl3} {prose} {textwrap.fill(mit, 60)} {prose}", ("GPL-3.0", 1.0, 2)),
        "full": (prose + "\n" + apache + "\n" + prose, ("Apache-2.0", 1.0, 1)),
        "prose": (prose, (None, None, 0)),
    }
    table = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id string, text string")
    got = {r[0]: tuple(r[1:]) for r in licenses.license_scan(table).collect()}
    assert got == {k: want for k, (_, want) in texts.items()}


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://x.net/es/1",
        "http://netx/es/1", "ftp://com", "http://com/", "http://b.www.example.com/en/y", "x://a.com/p://q.net/es/",
        "http://a.net/fr", "http://a.net/fr/\nz", "://net/es/?a",
    ]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(3, urls[3], "x"), (None, urls[3], "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    rules = spark.createDataFrame(
        [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")], "host string, path string, verdict string",
    )

    def judge(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = host.lower()
        fits = [
            (len(h + p), h + p, v) for h, p, v in _rows(rules)
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        return host, path, *(max(fits)[1:] if fits else (None, "allow"))

    want = Counter((i, *judge(u)) for i, u, _ in rows)
    assert Counter(_rows(url_filter.judge_urls(pages, rules))) == want
    assert Counter(_rows(url_filter.judge_urls(pages, rules, most_filter_bytes=32))) == want
    assert _rows(url_filter.judge_urls(pages.limit(0), rules)) == []
    assert {r[4] for r in _rows(url_filter.judge_urls(pages, rules.limit(0)))} == {"allow"}


def test_warc(spark):
    big = "".join(random.Random(2).choices("abcdefgh <>\n", k=3_000_000))
    rows = [
        (5, "http://a/", "<p>é"), (3, "http://b/\r\nx", "<p>é"), (4, None, None), (9, "u", ""), (None, "u", "<p>é"),
        (None, "v", "alone"), (7, "w", big), (7, "w", big), (8, "WARC/1.1", "WARC/1.1\r\n\r\n"),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, payload int")
    firsts = {}
    for i, _, h in rows:
        h = h or ""
        firsts[h] = min((x for x in (firsts.get(h), i) if x is not None), default=None)
    want = Counter()
    for i, _, h in rows:
        data, f = (h or "").encode(), firsts[h or ""]
        import base64

        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = f is not None and f != i
        want[(i, len(data), digest, "revisit" if again else "response", f if again else None)] += 1
    for split in (1000, 100_000, warc.SPLIT_BYTES):
        got = warc.archive_round_trip(pages, split_bytes=split).drop("url", "payload")
        assert Counter(_rows(got)) == want
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    assert {r["record_type"] for r in warc.archive_round_trip(pages, least_bytes=10**9).collect()} == {"response"}


def test_warc_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>1"), (2, "u", "<p>2")], "page_id bigint, url string, html string")
    files = warc.write_warc(warc.with_first(pages), str(tmp_path / "w"))
    back = warc.read_warc(files, str(tmp_path / "w"), with_payload=True)
    assert {(r["page_id"], bytes(r["payload"]), r["url"]) for r in back.collect()} == {(1, b"<p>1", "u"), (2, b"<p>2", "u")}


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16)).round(3)
    x[100:160] = x[100]  # equal vectors: ties by id
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [None] * 16), (None, x[0].tolist())]
    rows += [rows[0]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, score int")
    got = defaultdict(list)
    for q, rank, v, s in _rows(vector_graph.nearest(df, shard_rows=300)):
        got[q].append((rank, s, v))
    assert sorted(got) == [i for i in range(900) if i % 100 == 0]
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = sorted((d[v], v) for v in range(900) if v != q)[:10]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        assert all(s == pytest.approx(d[v], rel=1e-12) for _, s, v in found)
        hit += len({v for _, _, v in found} & {v for _, v in best})
    assert hit >= 0.95 * 10 * len(got)
    assert [v for _, _, v in sorted(got[100])] == list(range(101, 111))
    assert vector_graph.nearest(df.limit(0)).count() == 0
    assert vector_graph.nearest(df.filter("vec_id in (0, 5)")).count() == 1


@pytest.mark.parametrize("name", ["op1_url_filters", "op9_warc"])
def test_against_sql(spark, small, name):
    why = parity.compare(spark, parity.connect(small), small, entry.queries()[name], entry.oracle_sql()[name])
    assert why is None, why


def test_pipeline(spark, small, docs):
    """Each stage against what it was given."""
    labels = spark.read.parquet(f"{small}/labels.parquet")
    before = spark.read.parquet(f"{small}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, before, small)
        rows = after.collect()
        if name == "best_fit_packing":
            assert sum(r["piece"] == 0 for r in rows) == before.count()
            assert max(r["offset"] + r["length"] for r in rows) <= 4096
            break
        assert after.columns == before.columns
        own = {r["doc_id"]: r for r in before.collect()}
        assert all(own[r["doc_id"]] == r for r in rows)
        ids = [r["doc_id"] for r in rows]
        if name == "ngram_jaccard_join":
            _, group = _groups({d: r["text"] for d, r in own.items()}, 5, 80)
            assert sorted(ids) == sorted(set(group.values()))
        if name == "quality_classifier":
            marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
            good = [d for d in own if marks.get(d) == 1]
            assert len(set(good) & set(ids)) >= 0.9 * len(good)
        before = spark.createDataFrame(rows, after.schema)
    # Odd rows pass every stage.
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, odd, small).count() > 0
        assert step(spark, odd.limit(0), small).count() == 0
