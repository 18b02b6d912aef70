"""Merkle manifest, ranked search and circulant MinHash against plain Python on small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import parity
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fareloom.llm import merkle, minhash, ranked_search
from fareloom.llm.ngram_jaccard import set_maker

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, idx string, "
    "size string, digest string, leaf string, root string, n string, bag string, word string, key string, class string"
)
CLASH = ("x",) * 11
WORDS = "alpha Beta gamma delta epsilon zeta Eta theta iota kappa lamda mu nu xi".split()


def _frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(3)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _texts():
    rnd = random.Random(11)

    def prose(n):
        return " ".join(rnd.choice(WORDS) for _ in range(n))

    base = prose(120).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in (3, 60, 117)]
    return [
        None, "", " \t\n ", "one", "One", "one two three", " ".join(base), " ".join(base).upper(), *near,
        prose(20_000), "x" * 40_000, "naïve ÉTÉ İstanbul ǅ 3½ \x00 \x85   😀", *[prose(60) for _ in range(20)],
    ]


@pytest.fixture(scope="module")
def docs(spark):
    """Null ids, texts, languages and sources; repeated ids and repeated rows."""
    langs = ["en", None, "de", "é", "en"]
    rows = [(i, t, langs[i % 5], None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(_texts())]
    rows += [rows[5], rows[5], (5, "another", "en", None, None), (None, "no id", None, "s", None), (None, "No id", "fr", "s", 1)]
    return _frame(spark, rows)


# Merkle manifest


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _lower(text):
    return text if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _tree(hashes):
    """Root, and per leaf the list of (left, right) siblings."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for leaf, k in enumerate(at):
            first = k - k % 8
            paths[leaf].append(("".join(hashes[first:k]), "".join(hashes[k + 1 : first + 8])))
        hashes = [_sha("".join(hashes[k : k + 8])) for k in range(0, len(hashes), 8)]
        at = [k // 8 for k in at]
    return hashes[0], paths


def _manifest(rows):
    leaves = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        own = [_sha("".join(map(_field, (doc_id, source, lang, n_chars, t)))) for t in (text, _lower(text))]
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaves[lang].append((doc_id is not None, doc_id or 0, own[0], own[hit], doc_id))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = [_tree([r[2] for r in sorted(leaves[x])]) for x in langs]
    root, over = _tree([t[0] for t in trees])
    out = []
    for lang, (subroot, paths), above in zip(langs, trees, over):
        for own, path in zip(sorted(leaves[lang]), paths):
            folded = own[3]
            for left, right in path + above:
                folded = _sha(left + folded + right)
            proof = _sha("".join(left + right for left, right in path + above))
            out.append((own[4], own[2], subroot, root, proof, folded, folded == root))
    return Counter(out)


def _own(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_manifest(docs):
    got = merkle.manifest(docs)
    assert Counter(_rows(got)) == _manifest(_own(docs))
    assert {r["verified"] for r in got.collect()} == {True, False}
    assert _rows(merkle.manifest(docs.limit(0))) == []


@pytest.mark.parametrize("langs", [["en"] * 1, ["en"] * 9, ["en"] * 600, [f"l{i}" for i in range(70)], ["en"] * 65 + [None, "a"]])
def test_manifest_shapes(spark, langs):
    df = _frame(spark, [(i * 3, f"Text {i}", x, "s", i) for i, x in enumerate(langs)])
    assert Counter(_rows(merkle.manifest(df))) == _manifest(_own(df))


def test_manifest_of_one_row_repeated(spark):
    """A third of a table may be one row: its copies are told apart by place alone."""
    df = _frame(spark, [(1, "Same", "en", "s", 4)] * 100 + [(i, "t", "en", "s", 1) for i in range(100)])
    assert Counter(_rows(merkle.manifest(df))) == _manifest(_own(df))


def test_proofs_lead_to_the_root(docs):
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest([F.col("text")]).alias("leaf"), F.lit(1).alias("root"), F.lit(2).alias("subroot"))
    proofs = merkle.merkle_proofs(leaves.drop("root", "subroot"), "lang", "doc_id")
    assert proofs.filter(merkle.fold(F.col("leaf"), F.col("proof")) != F.lower(F.hex("root"))).count() == 0
    assert proofs.select("root").distinct().count() == 1


# Ranked search

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return _TERM.findall(_lower(text)) if text else []


def _search(docs, items, top=10):
    counts = [(d, Counter(_terms(t))) for d, t in docs]
    n_docs, words = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        own, scored = Counter(_terms(text)), []
        for doc_id, c in counts:
            score = 0
            for word, times in own.items():
                if c[word]:
                    m = 100 - 75 + (75 * sum(c.values()) * n_docs) // words
                    w = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[word] + 1)))
                    score += times * w * ((1_000_000_000 * c[word]) // (1000 * c[word] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda x: x[:3])
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(scored[:top])]
    return Counter(out)


ITEMS = [(1, "One alpha BETA, alpha; été naïve"), (2, None), (3, "..."), (4, "nowhere 3½ no id"), (None, "gamma one"), (1, "xi"), (5, "alpha " * 3000)]


@pytest.mark.parametrize("block_chars", [1 << 20, 1])
def test_search(spark, docs, block_chars):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = _rows(ranked_search.ranked_search(docs, items, block_chars=block_chars))
    own = _search(docs.select("doc_id", "text").collect(), ITEMS)
    assert Counter(got) == own


def test_search_of_copies_and_nothing(spark, docs):
    """Thousands of copies are one class; the smallest ids come first, across classes of one score."""
    rows = [(i, "Alpha beta" if i % 2 else "beta, alpha!", "en", "s", 1) for i in range(3000, 0, -1)]
    rows += [(i, "gamma delta", "en", "s", 1) for i in range(5000, 5003)] + [(7, "alpha alpha gamma", "en", "s", 1)]
    df = _frame(spark, rows)
    items = spark.createDataFrame([("a", "alpha"), ("b", "delta")], "item_id string, text string")
    assert Counter(_rows(ranked_search.ranked_search(df, items))) == _search([r[:2] for r in rows], items.collect())
    assert _rows(ranked_search.ranked_search(docs, items.limit(0))) == []
    assert _rows(ranked_search.ranked_search(docs.limit(0), items)) == []


# Circulant MinHash


def _groups(rows, words, percent):
    """Sizes and smallest reachable ids by comparing every pair."""
    make = set_maker(words)
    sets = [set(make((t or "").encode()).tolist()) for _, t in rows]
    to = list(range(len(rows)))

    def root(i):
        while to[i] != i:
            i = to[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                to[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        least = min(ids[root(i)], default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, least is None or doc_id == least))
    return Counter(out)


@pytest.mark.parametrize("words,percent", [(4, 80), (2, 80), (5, 90)])
def test_near_duplicates(docs, words, percent):
    got = Counter(_rows(minhash.near_duplicates(docs, words, percent)))
    assert got == _groups(docs.select("doc_id", "text").collect(), words, percent)
    assert _rows(minhash.near_duplicates(docs.limit(0))) == []


def test_near_duplicates_in_loose_groups(spark):
    """Texts that share buckets but mostly miss the bound: pivots alone do not find all links."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        own = list(base)
        for k in rnd.sample(range(200), rnd.choice((2, 5, 8, 10))):
            own[k] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(own), "en", "s", 1))
    got = Counter(_rows(minhash.near_duplicates(_frame(spark, rows))))
    want = _groups([r[:2] for r in rows], 4, 80)
    assert got == want
    assert 1 < len({r[2] for r in want}) < 120


def test_shingles_of_one_class_alone(spark):
    texts = {1: "a b c d e f", 2: "a b c d e g", 3: "x y z w"}
    rows = [(k, t.encode()) for k, t in texts.items()]
    make = set_maker(4)
    sets = {k: make(t) for k, t in rows}
    got = {r["class"]: r for r in minhash._alone(spark.createDataFrame(rows, "class bigint, text binary"), 4).collect()}
    for k, own in sets.items():
        others = np.concatenate([s for j, s in sets.items() if j != k])
        alone = own[~np.isin(own, others)]
        assert got[k]["alone"] == len(alone)
        assert [got[k][f"x{i}"] for i in range(4)] == minhash.parity(alone).tolist()


def test_circulant_signatures_estimate_likeness():
    """Agreement of coordinates is an unbiased estimate of the likeness, from two permutations."""
    rnd = np.random.default_rng(3)
    sign = minhash.signer(100, 4)
    for share in (0.2, 0.5, 0.8):
        seen = []
        for _ in range(20):
            pool = rnd.integers(0, 1 << 63, 400, dtype=np.uint64)
            common = int(400 * share)
            a, b = pool[: common + (400 - common) // 2], np.concatenate((pool[:common], pool[common + (400 - common) // 2 :]))
            seen.append(float((sign.coordinates(a) == sign.coordinates(b)).mean()))
        assert abs(np.mean(seen) - share) < 0.03
    for shift in (0, 1, 77):  # pi keeps distinct places distinct
        assert len(np.unique(sign(np.arange(1, 50, dtype=np.uint64) + np.uint64(shift)))) == 100


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_ranked_search", "op13_minhash_near_dedup"])
def test_against_sql(spark, small, name):
    con = parity.connect(small)
    assert parity.compare(spark, con, small, entry.queries()[name], entry.oracle_sql()[name]) is None
