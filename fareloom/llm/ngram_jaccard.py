"""Exact Jaccard join on word n-grams as a blocked sparse product of the incidence matrix.

The overlap of two documents is an entry of A times A transposed, A being document by n-gram. The
product is never formed in full:

1. Documents with the same n-gram set are one row of A (a class). Copies never meet each other.
2. The first column block is each row's rarest n-grams, just so many that two rows similar enough
   must share one: for a bound on the overlap that their sizes set, n - bound + 1 of each. Rarity is
   by counts over all documents, in a fixed number of hash buckets, so n-grams of passages that many
   documents share stay out of this block.
3. Pairs with an entry there must be able to reach the bound: the parity of n-grams per hash bit
   differs in at most as many bits as the sets differ in elements, so four words of parity tell most
   pairs apart before they are made.
4. The remaining column blocks are accumulated pair by pair; a pair is dropped as soon as what is
   left of the shorter row cannot lift its overlap to the bound that the two sizes set.

A large group of near copies would still have a pair for every two of them. So the rows under an
n-gram are first held against two of them, which links most of the group; then only pairs from
different components are looked at. No link between components is lost.

Hashes of n-grams and of sets have 64 bits: two different ones agree with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from fareloom.llm.components import components
from fareloom.llm.url_filter import build_filter, may_hold
from fareloom.sources.staging import stage

WORDS = 4
PERCENT = 85
COUNT_BUCKETS = 1 << 18  # counts of n-grams by hash; 2 MB, whatever the corpus
COLUMN_BLOCKS = 4
SKETCH = ("s0", "s1", "s2", "s3")  # 256 parity bits
MOST_WORDS_KEPT = 300_000  # word hashes a task remembers


def set_maker(words: int) -> Callable:
    """bytes -> sorted distinct 64-bit hashes of its word n-grams.

    Words are what blanks separate, A-Z lower-cased. With fewer words than `words`, the whole
    sequence is the one element.
    """
    import numpy as np
    import xxhash

    class Words(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= MOST_WORDS_KEPT:
                self.clear()
            h = self[word] = xxhash.xxh3_64_intdigest(word)
            return h

    known = Words()
    factor, mix = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
    half = np.uint64(33)

    def finish(h):
        h = (h ^ (h >> half)) * mix
        return h ^ (h >> half)

    def make(text: bytes):
        own = text.lower().split()
        w = np.fromiter(map(known.__getitem__, own), np.uint64, len(own))
        width = min(words, len(w))
        if not width:
            return w
        h = np.full(len(w) - width + 1, width, np.uint64)
        for k in range(width):
            h = finish(h * factor + w[k : len(w) - width + 1 + k])
        return np.unique(h)

    return make


def class_id(grams) -> int:
    """Signed 64-bit id of an n-gram set."""
    import xxhash

    h = xxhash.xxh3_64_intdigest(grams.tobytes())
    return h - (1 << 64) if h >> 63 else h


def parity(grams):
    """Parity of the number of elements per hash bit, as four signed 64-bit numbers."""
    import numpy as np

    odd = np.bincount(((grams >> np.uint64(20)) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def _classify(texts: DataFrame, words: int) -> DataFrame:
    """doc_id, class, n and parity of each row; and each task's n-gram counts (bucket in class, count in n)."""
    schema = StructType(
        [
            StructField("doc_id", texts.schema["doc_id"].dataType),
            StructField("class", LongType()),
            StructField("n", LongType()),
            *(StructField(s, LongType()) for s in SKETCH),
            StructField("is_count", BooleanType()),
        ]
    )
    def run(batches):
        import numpy as np

        make = set_maker(words)
        counts = np.zeros(COUNT_BUCKETS, np.int64)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            ids, sizes = [], []
            odd = np.zeros((batch.num_rows, len(SKETCH)), np.int64)
            for i, text in enumerate(batch.column(1).to_pylist()):
                grams = make(text or b"")
                ids.append(class_id(grams) if len(grams) else None)
                sizes.append(len(grams))
                odd[i] = parity(grams)
                np.add.at(counts, (grams & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(odd[:, k]) for k in range(len(SKETCH))),
                    pa.array(np.zeros(len(ids), bool)),
                ],
                names=schema.names,
            )
        if kind is not None:
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(some), kind),
                    pa.array(some),
                    pa.array(counts[some]),
                    *[pa.nulls(len(some), pa.int64())] * len(SKETCH),
                    pa.array(np.ones(len(some), bool)),
                ],
                names=schema.names,
            )

    return texts.mapInArrow(run, schema)


def _bucket_counts(rows: DataFrame):
    """Total per bucket as an array of COUNT_BUCKETS numbers."""
    import numpy as np

    total = np.zeros(COUNT_BUCKETS, np.int64)
    per = rows.groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    total[per.column("class").to_numpy()] = per.column("n").to_numpy()
    return total


def _first_block(texts: DataFrame, counts, words: int, percent: int) -> DataFrame:
    """gram, class, pos: every class's rarest n-grams in order, one row each. A task sends a class once."""
    schema = StructType(
        [
            StructField("gram", LongType()),
            StructField("class", LongType()),
            StructField("pos", IntegerType()),
        ]
    )
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        import numpy as np

        make, count, sent = set_maker(words), shared.value, set()
        mask = np.uint64(COUNT_BUCKETS - 1)
        for batch in batches:
            grams, classes, places = [], [], []
            for text in batch.column(1).to_pylist():
                own = make(text or b"")
                n = len(own)
                key = class_id(own) if n else None
                if not n or key in sent:
                    continue
                sent.add(key)
                keep = n - (percent * n + 99) // 100 + 1
                order = np.lexsort((own, count[(own & mask).astype(np.int64)]))[:keep]
                grams.append(own[order].view(np.int64))
                classes.append(np.full(keep, key, np.int64))
                places.append(np.arange(keep, dtype=np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (grams, classes, places)], names=schema.names
                )

    return texts.select("doc_id", "text").mapInArrow(run, schema)


def _with_prev(column: DataFrame) -> DataFrame:
    """Adds `prev`, the n-gram before in a class's order; null if it is not among these rows.

    A column left out has no two components under it, so no pair looked for here has met there.
    """
    order = Window.partitionBy("class").orderBy("pos")
    before = F.lag(F.struct("gram", "pos")).over(order)
    column = column.withColumn("before", before)
    prev = F.when(F.col("before.pos") == F.col("pos") - 1, F.col("before.gram"))
    return column.withColumn("prev", prev).drop("before")


def _needed_texts(texts: DataFrame, classes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """class, text of one document for each class in `pairs`.

    Texts are not shuffled to be found: a Bloom filter of bounded size tells which documents may be
    wanted, and an exact join drops those it let through by mistake.
    """
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    wanted = stage(wanted.distinct(), "wanted")
    bloom = build_filter(classes.join(wanted, "class").select(F.col("first_id").alias("key")))
    shared = texts.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        import numpy as np

        make, table = set_maker(words), shared.value
        for batch in batches:
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            some = batch.column(0).filter(pa.array(may_hold(table, hashes), pa.bool_()))
            for at in range(0, len(some), 1024):
                part = some.slice(at, 1024)
                sets = [make(t or b"") for t in part.to_pylist()]
                ids = [class_id(g) if len(g) else None for g in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), part], names=["class", "text"])

    made = texts.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "class bigint, text binary")
    return made.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def overlap_reaches(a, b, percent: int) -> bool:
    """Whether 100 * common >= percent * union, block of columns by block of columns."""
    import numpy as np

    need = -(-percent * (len(a) + len(b)) // (100 + percent))
    if min(len(a), len(b)) < need:
        return False
    edges = [np.uint64(k * ((1 << 64) // COLUMN_BLOCKS)) for k in range(1, COLUMN_BLOCKS)]
    cut_a = [0, *np.searchsorted(a, edges).tolist(), len(a)]
    cut_b = [0, *np.searchsorted(b, edges).tolist(), len(b)]
    common = 0
    for k in range(COLUMN_BLOCKS):
        x, y = a[cut_a[k] : cut_a[k + 1]], b[cut_b[k] : cut_b[k + 1]]
        both = np.concatenate((x, y))
        both.sort()
        common += int((both[1:] == both[:-1]).sum())
        if common + min(len(a) - cut_a[k + 1], len(b) - cut_b[k + 1]) < need:
            return False
    return common >= need


def _linked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose overlap reaches the bound; `texts` has the text of each class."""
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b"
    )

    def run(batches):
        make, last = set_maker(words), (None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hit = []
                for b, ta, tb in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    if last[0] != b:  # rows come sorted by b
                        last = (b, make(tb))
                    hit.append(overlap_reaches(make(ta), last[1], percent))
                yield part.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def _end(column: DataFrame, side: str) -> DataFrame:
    """Columns renamed for one end of a pair; the class itself gets the side's name."""
    return column.select(
        "gram",
        F.col("class").alias(side),
        *[F.col(c).alias(f"{c}_{side}") for c in column.columns if c not in ("gram", "class")],
    )


def _can_link(percent: int):
    """What the sizes ask of a pair that meets in a column of the first block."""
    need = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    differ = " + ".join(f"bit_count({s}_a ^ {s}_b)" for s in SKETCH)
    return F.expr(
        f"pos_a <= n_a - {need} and pos_b <= n_b - {need} and {differ} <= n_a + n_b - 2 * {need}"
    )


def jaccard_components(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two rows link when 100 * common >= percent * union of their n-gram sets; component_id is the
    smallest id that links lead to, the row's own included (null ids are passed over: null only if
    no row reached has one). Null, empty and blank texts have an empty set and link with nothing,
    not even each other. Repeated rows each get a row. An empty table gives an empty result.
    """
    texts = _texts(docs, id_col, text_col)
    seen = stage(_classify(texts, words), "classified")
    counts = _bucket_counts(seen.filter("is_count"))
    rows = seen.filter("not is_count")
    firsts = [F.first(c).alias(c) for c in ("n", *SKETCH)]
    classes = stage(
        rows.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"), *firsts), "classes"
    )

    # The block is made and shuffled once; n-grams of a single row go no further.
    by_gram = Window.partitionBy("gram")
    column = _first_block(texts, counts, words, percent).withColumns(
        {"low": F.min("class").over(by_gram), "high": F.max("class").over(by_gram)}
    )
    column = column.filter("low <> high").drop("low", "high").distinct()
    column = stage(column.join(classes.drop("first_id"), "class"), "columns")

    # Each row of a column against two of them, other ones in every column: the extremes of class
    # xor n-gram.
    other, row = F.col("class").bitwiseXOR(F.col("gram")), F.struct("class", "pos", "n", *SKETCH)
    pivots = F.array(F.min_by(row, other).over(by_gram), F.max_by(row, other).over(by_gram))
    first = _end(column.withColumn("pivots", pivots), "a")
    first = first.withColumn("pivot", F.explode("pivots_a")).drop("pivots_a")
    first = first.withColumn("b", F.col("pivot.class")).withColumns(
        {f"{c}_b": F.col(f"pivot.{c}") for c in ("pos", "n", *SKETCH)}
    )
    first = first.filter(F.expr("a <> b") & _can_link(percent))
    first = first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    first = stage(first, "pairs")
    known = stage(_needed_texts(texts, classes, first, words), "texts")
    links = stage(_linked(first, known, words, percent), "links")

    # Then pairs from different components, if they share a column and were not compared yet. Rows
    # with the same n-gram before this one have met there already, under bounds no tighter than here.
    label = components(links).select(F.col("node").alias("class"), "component")
    column = column.join(label, "class", "left")
    column = column.withColumn("component", F.coalesce("component", "class")).withColumns(
        {"low": F.min("component").over(by_gram), "high": F.max("component").over(by_gram)}
    )
    column = _with_prev(column.filter("low <> high").drop("low", "high"))
    second = _end(column, "a").join(_end(column, "b"), "gram")
    unmet = F.expr("coalesce(prev_a <> prev_b, true)")
    second = second.filter(F.expr("a > b and component_a <> component_b") & unmet & _can_link(percent))
    second = second.select("a", "b").distinct().join(first, ["a", "b"], "left_anti")
    second = stage(second, "pairs")
    if not second.isEmpty():
        more = stage(_needed_texts(texts, classes, second, words), "texts")
        links = links.unionByName(_linked(second, more, words, percent))
        label = components(links).select(F.col("node").alias("class"), "component")

    owner = classes.join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = owner.groupBy("component").agg(F.min("first_id").alias("least_id"))
    owner = owner.join(least, "component").select("class", "least_id")
    out = rows.join(owner, "class", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest id, rows without one last.

    Rows are told apart by id and text, so different texts under one id are judged each by itself,
    and a copy without an id gives way to one with an id. A row repeated with its id and text stays
    once; rows with neither an id nor a word all stay. Columns of any other name are left alone.
    """
    # Two independent 64-bit hashes of the text beside the id: only rows of one id could collide.
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(text).alias("hash"),
        F.xxhash64(F.lit(1), text).alias("other"),
    )
    found = jaccard_components(docs.select(key.alias("doc_id"), "text"), words, percent)
    kept = found.filter("doc_id = component_id").select("doc_id.*").distinct()
    kept = stage(kept.withColumn("id", F.coalesce("id", F.lit(0))), "kept")
    # One column beside the user's own, whatever their names.
    own = "_key"
    while own in docs.columns:
        own += "_"
    row = F.struct(key["no_id"].alias("no_id"), F.coalesce(key["id"], F.lit(0)).alias("id"), key["hash"].alias("hash"), key["other"].alias("other"))
    wanted = kept.select(F.struct(*kept.columns).alias("_wanted"))
    nameless = F.col("doc_id").isNull() & ~text.rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.filter(~nameless).withColumn(own, row)
    named = keyed.join(wanted, keyed[own] == wanted["_wanted"], "left_semi").dropDuplicates([own])
    return named.drop(own).unionByName(docs.filter(nameless))
