"""Near duplicates by circulant MinHash, confirmed on whole sets.

A signature needs many permutations of the shingles' universe, here only two: the first, sigma,
places a shingle on a circle of 2^32 places; the second, pi, is shifted round the circle by k for
coordinate k, which is the smallest pi(sigma(shingle) + k) of a set. Rows of ROWS coordinates are
bands; sets that agree in a band share a bucket. A pair at the bound of 0.8 shares none of 40 bands
of 4 with a chance of 7e-10 (at 0.85: 1.5e-13).

1. Documents with the same set are one class, by a 64-bit hash of the set; copies never meet.
2. A bucket's classes are held against its pivot, the smallest class. A group of near copies has
   nearly the same pivot in all buckets, so it costs few pairs a member, however large it is.
3. Of what buckets still hold of different components, shingles that no other such class has are
   counted: they cannot be part of an overlap. A class with too many of them links with none.
4. The rest meets other pivots in further rounds, and after those only pairs from different
   components are left to look at.
5. Before a pair is compared, exact bounds drop it: the sizes, and parity words (the parity of
   shingles per hash bit differs in at most as many bits as two sets differ in elements). From step
   4 on both are taken without the shingles of one class alone, which no overlap can use.
6. The pairs left are confirmed on the full sets, made again from the texts.

Pivots come from aggregates combined before the shuffle and go back by a join, which splits a hot
bucket; no bucket is gathered in one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from fareloom.llm.components import components
from fareloom.llm.ngram_jaccard import class_id, overlap_reaches, parity, set_maker
from fareloom.llm.url_filter import build_filter, may_hold
from fareloom.sources.staging import stage

WORDS = 4
PERCENT = 80
BANDS, ROWS = 40, 4
PIVOT_ROUNDS = 2  # besides the first pivot
SKETCH = ("s0", "s1", "s2", "s3")  # 256 parity bits
MOST_SENT = 1_000_000  # classes a task remembers to have signed
STEP_SHINGLES = 1024  # shingles signed in one numpy step


def signer(bands: int, rows: int):
    """Sorted 64-bit shingle hashes -> one 64-bit key per band."""
    import numpy as np

    shift = np.arange(bands * rows, dtype=np.uint32)[:, None]
    number = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def sigma(shingles):
        x = shingles * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32)

    def pi(x):
        # A bijection of 32 bits: shifts that xor and odd factors can be undone.
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        return x

    def coordinates(shingles):
        places = sigma(shingles)
        least = np.full(len(shift), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(places), STEP_SHINGLES):
            least = np.minimum(least, pi(places[None, at : at + STEP_SHINGLES] + shift).min(axis=1))
        return least

    def keys(shingles):
        key = number.copy()
        for part in coordinates(shingles).reshape(bands, rows).T:
            key = (key ^ part) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(29)
        return key.view(np.int64)

    keys.coordinates = coordinates
    return keys


def _signed(texts: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, class, n, parity words and band keys of each row; a task signs a class once."""
    schema = StructType(
        [
            texts.schema["doc_id"],
            *(StructField(c, LongType()) for c in ("class", "n", *SKETCH)),
            StructField("keys", ArrayType(LongType())),
        ]
    )

    def run(batches):
        import numpy as np

        make, sign, sent = set_maker(words), signer(bands, rows), set()
        for batch in batches:
            classes, sizes, keys = [], [], []
            odd = np.zeros((batch.num_rows, len(SKETCH)), np.int64)
            for i, text in enumerate(batch.column(1)):
                grams = make(text.as_py() or b"")
                own = class_id(grams) if len(grams) else None
                classes.append(own)
                sizes.append(len(grams))
                odd[i] = parity(grams)
                if own is None or own in sent:
                    keys.append(None)
                    continue
                if len(sent) >= MOST_SENT:
                    sent.clear()
                sent.add(own)
                keys.append(sign(grams))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(classes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(odd[:, k]) for k in range(len(SKETCH))),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return texts.mapInArrow(run, schema)


def _end(rows: DataFrame, side: str) -> DataFrame:
    """One end of a pair: the class gets the side's name, other columns the side as suffix."""
    return rows.select(
        *[F.col(c).alias(side if c == "class" else c if c == "key" else f"{c}_{side}") for c in rows.columns]
    )


def _possible(percent: int) -> Column:
    """What the sizes, the shingles others have too (m) and the parity words ask of a pair."""
    need = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    differ = " + ".join(f"bit_count({s}_a ^ {s}_b)" for s in SKETCH)
    return F.expr(f"least(m_a, m_b) >= {need} and {differ} <= m_a + m_b - 2 * {need}")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the bounds leave possible."""
    ends = classes.select("class", "n", "m", *SKETCH)
    pairs = pairs.join(_end(ends, "a"), "a").join(_end(ends, "b"), "b")
    return pairs.filter(_possible(percent)).select("a", "b")


def _texts_of(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """class, text of one document for each class in `wanted` (class, first_id).

    A Bloom filter of bounded size over the wanted documents' ids lets few texts past the scan; the
    class, made again, is joined exactly.
    """
    wanted = stage(wanted, "wanted")
    shared = texts.sparkSession.sparkContext.broadcast(build_filter(wanted.select(F.col("first_id").alias("key"))))

    def run(batches):
        import numpy as np

        make, table = set_maker(words), shared.value
        for batch in batches:
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            some = batch.column(0).filter(pa.array(may_hold(table, hashes), pa.bool_()))
            for at in range(0, len(some), 1024):
                part = some.slice(at, 1024)
                sets = [make(t.as_py() or b"") for t in part]
                ids = [class_id(g) if len(g) else None for g in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), part], names=["class", "text"])

    made = texts.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "class bigint, text binary")
    return stage(made.join(wanted, "class", "left_semi").dropDuplicates(["class"]), "texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()


def _alone(texts: DataFrame, words: int) -> DataFrame:
    """class, alone, x0..x3: how many of its shingles no other class of `texts` has, and their parity.

    Classes without such a shingle have no row.
    """

    def run(batches):
        import numpy as np

        make = set_maker(words)
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams = make(text.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams), pa.array(np.full(len(grams), own, np.int64))], names=["shingle", "class"]
                )

    held = texts.select("class", "text").mapInArrow(run, "shingle bigint, class bigint")
    single = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("class").alias("class")).filter("c = 1")
    # The bit of a shingle, where `parity` has it.
    bit = "cast(shiftrightunsigned(shingle, 20) & 255 as int)"
    single = single.withColumn("bit", F.expr(bit)).withColumn(
        "mask", F.expr("shiftleft(1L, 8 * cast(bit div 8 % 8 as int) + 7 - bit % 8)")
    )
    odd = [
        F.bit_xor(F.when(F.expr(f"bit div 64 = {k}"), F.col("mask")).otherwise(F.lit(0).cast("long"))).alias(f"x{k}")
        for k in range(len(SKETCH))
    ]
    return single.groupBy("class").agg(F.count(F.lit(1)).alias("alone"), *odd)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the bound; `texts` has the text of each class."""
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        make, last, held = set_maker(words), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, hit = batch.slice(at, 256), []
                for b, ta, tb in zip(part.column(1).to_pylist(), part.column(2), part.column(3)):
                    if held is None or last != b:  # a pivot's rows come together
                        last, held = b, make(tb.as_py())
                    hit.append(overlap_reaches(make(ta.as_py()), held, percent))
                yield part.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def _mixed(members: DataFrame, label: str, pivot: Column) -> DataFrame:
    """key, pivot of the buckets that hold more than one `label`."""
    ends = members.groupBy("key").agg(F.min(label).alias("low"), F.max(label).alias("high"), pivot.alias("pivot"))
    return ends.filter("low <> high").select("key", "pivot")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    pivot_rounds: int = PIVOT_ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Two rows link when 100 * common >= percent * union of their sets of word shingles; component_id
    is the smallest id that links lead to, the row's own included (null ids are passed over: null
    only if no row reached has one); kept says that it is the row's own, or that there is none. Null,
    empty and blank texts have an empty set and link with nothing. Repeated rows each get a row and
    one id. An empty table gives an empty result. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    signed = stage(_signed(texts, words, bands, rows), "signed")
    firsts = [F.first(c).alias(c) for c in ("n", *SKETCH)]
    classes = signed.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"), *firsts)
    classes = stage(classes.withColumn("m", F.col("n")), "classes")

    members = signed.filter("keys is not null").select("class", F.explode("keys").alias("key"))
    pivots = stage(_mixed(members, "class", F.min("class")), "pivots")
    members = stage(members.join(pivots, "key"), "members")
    pairs = members.filter("class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()
    compared = stage(_bounded(pairs, classes, percent), "pairs")
    own = _texts_of(texts, classes.join(_ends(compared), "class").select("class", "first_id"), words)
    links = stage(_confirmed(compared, own, words, percent), "links")
    label = _components_of(links)

    # What is left apart, with what it may share.
    members = _labelled(members.select("key", "class"), label)
    members = stage(members.join(_mixed(members, "component", F.min("class")).select("key"), "key"), "members")
    rest = classes.join(members.select("class").distinct(), "class", "left_semi")
    own = _texts_of(texts, rest.select("class", "first_id"), words)
    rest = rest.join(_alone(own, words), "class", "left").select(
        "class",
        "n",
        (F.col("n") - F.coalesce("alone", F.lit(0))).alias("m"),
        *[F.col(s).bitwiseXOR(F.coalesce(f"x{k}", F.lit(0).cast("long"))).alias(s) for k, s in enumerate(SKETCH)],
    )
    rest = stage(rest.filter(f"100 * m >= {percent} * n"), "rest")
    members = members.join(rest.select("class"), "class")
    for k in range(1, pivot_rounds + 1):
        # Another pivot for what is still apart: the least in another order in each round.
        pivots = stage(_mixed(members, "component", F.min_by("class", F.xxhash64("class", F.lit(k)))), "pivots")
        members = stage(members.join(pivots, "key"), "members")
        of_pivot = label.select(F.col("class").alias("pivot"), F.col("component").alias("of_pivot"))
        pairs = members.join(of_pivot, "pivot", "left").filter("component <> coalesce(of_pivot, pivot)")
        pairs = pairs.select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()
        pairs = stage(_new(_bounded(pairs, rest, percent), compared), "pairs")
        links, compared, label = _compare(own, pairs, links, compared, label, words, percent)
        members = _labelled(members.select("key", "class"), label)
    left = _mixed(members, "component", F.min("class")).select("key")
    left = stage(members.join(left, "key").join(rest.select("class", "n", "m", *SKETCH), "class"), "members")
    pairs = _end(left, "a").join(_end(left, "b"), "key")
    pairs = pairs.filter(F.expr("a > b and component_a <> component_b") & _possible(percent))
    pairs = stage(_new(pairs.select("a", "b").distinct(), compared), "pairs")
    links, compared, label = _compare(own, pairs, links, compared, label, words, percent)

    owner = _labelled(classes.select("class", "first_id"), label)
    least = owner.groupBy("component").agg(F.min("first_id").alias("least_id"))
    owner = owner.join(least, "component").select("class", "least_id")
    out = signed.select("doc_id", "class", "n").join(owner, "class", "left")
    out = out.withColumn("component_id", F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def _new(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """The pairs that were not compared yet, either way round."""
    either = compared.unionByName(compared.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(either, ["a", "b"], "left_anti")


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    return rows.join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))


def _components_of(links: DataFrame) -> DataFrame:
    return stage(components(links).select(F.col("node").alias("class"), "component"), "label")


def _compare(texts, pairs, links, compared, label, words, percent):
    """Links, compared pairs and component of each linked class, with `pairs` looked at as well."""
    if pairs.isEmpty():
        return links, compared, label
    more = stage(_confirmed(pairs, texts, words, percent), "links")
    compared = compared.unionByName(pairs)
    if more.isEmpty():
        return links, compared, label
    links = links.unionByName(more)
    return links, compared, _components_of(links)
