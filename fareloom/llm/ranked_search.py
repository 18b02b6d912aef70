"""Ranked lexical search for a table of items, scored once per bag of words.

Only words of the items can add to a score, so a document is reduced to its bag: how often it holds
each word of the vocabulary. Its score then rests on the bag and on its length weight m alone.
Documents with the same bag and m are one class; classes are dealt by a hash of both, and the bag
itself is part of the grouping key, so that two bags with one hash stay apart. A class is scored
once against all items and expanded to its members by ascending doc_id.

A class takes at most `top` members into the result, those with the smallest ids; tasks keep no more
before the shuffle, so a bag that a third of the documents have is no hot group. Documents without a
word of the vocabulary have score 0 for every item and end at the bag.

Items are read in blocks whose words are broadcast: a block is closed at BLOCK_CHARS characters, so
its size is bounded by that and one item, however many items there are. Each block is a pass over the
documents; counts are over all documents in each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.sources.staging import stage

TOP = 10
BLOCK_CHARS = 16 << 20
ITEM_CHARS = 64  # what an item counts for besides its text, so that empty ones fill a block too
LENGTH_PERCENT = 75  # of a document's length that its weight m follows
SCALE, TF_SCALE, M_SCALE = 1_000_000_000, 1000, 8  # div terms of the score
STEP_ENTRIES = 1 << 20  # (class, item) sums a scoring step holds

_BAGS = "doc_id {kind}, n bigint, bag binary, word int, documents bigint"
_CLASS = ["h", "m", "bag"]


def word_splitter():
    """UTF-8 bytes -> its words: runs of 0-9, A-Z, a-z and all beyond ASCII, A-Z lower-cased."""
    table = bytes(
        c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
    )
    return lambda text: text.translate(table).split()


class Block:
    """Items of one block: their words numbered from 0, and a postings list per word."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.items: list[dict[int, int]] = []
        self.ids: list = []

    def add(self, item_id, words: list[bytes]) -> None:
        own: dict[int, int] = {}
        for word in words:
            k = self.words.setdefault(word, len(self.words))
            own[k] = own.get(k, 0) + 1
        self.items.append(own)
        self.ids.append(item_id)

    def postings(self):
        """start per word (and the end), item and times for each entry."""
        import numpy as np

        word = np.array([w for own in self.items for w in own], np.int64)
        item = np.repeat(np.arange(len(self.items)), [len(own) for own in self.items])
        times = np.array([n for own in self.items for n in own.values()], np.int64)
        order = np.lexsort((item, word))
        start = np.searchsorted(word[order], np.arange(len(self.words) + 1))
        return start, item[order], times[order]


def blocks(items: DataFrame, item_id: str, text: str, chars: int) -> Iterator[Block]:
    """The items, block by block; the driver holds one."""
    split, block, size = word_splitter(), Block(), 0
    for item, own in items.select(F.col(item_id), F.col(text).cast("binary")).filter(F.col(text).isNotNull()).toLocalIterator():
        block.add(item, split(bytes(own)))
        size += len(own) + ITEM_CHARS
        if size >= chars:
            yield block
            block, size = Block(), 0
    if block.items:
        yield block


def _bags(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id, n and bag of every document; and how many of a task's documents hold each word."""
    shared = docs.sparkSession.sparkContext.broadcast(block.words)
    schema = _BAGS.format(kind=docs.schema["doc_id"].dataType.simpleString())

    def run(batches):
        import numpy as np

        split, words = word_splitter(), shared.value
        held = np.zeros(len(words), np.int64)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, bags = [], []
                for text in part.column(1):
                    own = split(text.as_py() or b"")
                    known = [k for k in map(words.get, own) if k is not None]
                    k, n = np.unique(np.array(known, np.int32), return_counts=True)
                    held[k] += 1
                    sizes.append(len(own))
                    bags.append(np.concatenate((k, n.astype(np.int32))).tobytes() if len(k) else None)
                none = [pa.nulls(part.num_rows, t) for t in (pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary()), *none],
                    names=["doc_id", "n", "bag", "word", "documents"],
                )
        some = np.flatnonzero(held)
        if kind is not None and len(some):
            none = [pa.nulls(len(some), t) for t in (kind, pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(some.astype(np.int32)), pa.array(held[some])],
                names=["doc_id", "n", "bag", "word", "documents"],
            )

    return docs.mapInArrow(run, schema)


def _classes(bags: DataFrame, words: int, documents: int, top: int) -> DataFrame:
    """h, m, bag and the `top` smallest ids of each class of documents with one bag and one m."""
    m = F.expr(f"{100 - LENGTH_PERCENT} + ({LENGTH_PERCENT}L * n * {documents}L) div {words}L")
    keyed = bags.select("doc_id", m.alias("m"), "bag").withColumn("h", F.xxhash64("bag", "m"))
    order = Window.partitionBy(*_CLASS).orderBy(F.col("doc_id").asc_nulls_last())
    least = keyed.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    return least.groupBy(*_CLASS).agg(F.array_sort(F.collect_list(F.struct("place", "doc_id"))).alias("ids"))


def _scored(classes: DataFrame, block: Block, weights, top: int) -> DataFrame:
    """item (its number in the block), score, ids: the best `top` classes per item and task."""
    ids_type = classes.schema["ids"].dataType.simpleString()
    shared = classes.sparkSession.sparkContext.broadcast((*block.postings(), len(block.items), weights))

    def run(batches):
        import numpy as np

        start, item, times, items, weight = shared.value
        best: list[list] = [[] for _ in range(items)]  # (-score, no id, least id, ids)
        floor = np.zeros(items, np.int64)  # a score has to reach this to enter

        def offer(sums, ids) -> None:
            hit = (sums > 0) & (sums >= floor)
            for c, k in zip(*np.nonzero(hit)):
                own, least = best[k], ids[c][0]["doc_id"]
                own.append((-int(sums[c, k]), least is None, least or 0, ids[c]))
                if len(own) >= 4 * top:
                    own.sort(key=lambda x: x[:3])
                    del own[top:]
                    floor[k] = -own[-1][0]

        for batch in batches:
            step = max(1, STEP_ENTRIES // items)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n, m, ids = part.num_rows, part.column(0).to_numpy(), part.column(2).to_pylist()
                sums = np.zeros(n * items, np.int64)
                for c, (bag, own_m) in enumerate(zip(part.column(1), m.tolist())):
                    word, tf = np.frombuffer(bag.as_py(), np.int32).reshape(2, -1).astype(np.int64)
                    value = weight[word] * ((SCALE * tf) // (TF_SCALE * tf + M_SCALE * own_m))
                    count = start[word + 1] - start[word]
                    entry = np.repeat(start[word] - np.cumsum(count) + count, count) + np.arange(count.sum())
                    # 64-bit sums from two exact sums in doubles
                    value = np.repeat(value, count)
                    low = np.bincount(item[entry], (value & 0xFFFFF) * times[entry], items)
                    high = np.bincount(item[entry], (value >> 20) * times[entry], items)
                    sums[c * items : (c + 1) * items] = low.astype(np.int64) + (high.astype(np.int64) << 20)
                offer(sums.reshape(n, items), ids)
        rows = []
        for k, own in enumerate(best):
            own.sort(key=lambda x: x[:3])
            rows += [(k, -x[0], x[3]) for x in own[:top]]
        yield pa.RecordBatch.from_pylist([{"item": k, "score": s, "ids": i} for k, s, i in rows], schema=out)

    ids = pa.list_(pa.struct([("place", pa.int32()), ("doc_id", pa.int64())]))
    out = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("ids", ids)])
    return classes.select("m", "bag", "ids").mapInArrow(run, f"item bigint, score bigint, ids {ids_type}")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` documents with a score above 0.

    Equal scores go by ascending doc_id (null last); repeated documents are documents of their own.
    Null texts and texts without a word count nowhere and score nothing, and items of that kind get
    no row. Every row of `items` is an item, so a repeated item gets its ranks again. Without
    documents or items the result is empty. Scores are as in the contract of the query: 64-bit
    integers but for the words' weights, which are floors of doubles. doc_id is a long.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    found = [_search_block(texts, block, top) for block in blocks(items, item_id, text, block_chars)]
    kind = items.schema[item_id].dataType.simpleString()
    spark = docs.sparkSession
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    found = [
        rows.join(F.broadcast(spark.createDataFrame(list(enumerate(ids)), f"item bigint, item_id {kind}")), "item")  # one block's ids
        for rows, ids in found
    ]
    return functools.reduce(DataFrame.unionByName, found).select("item_id", "rank", "doc_id", "score")


def _search_block(texts: DataFrame, block: Block, top: int) -> tuple[DataFrame, list]:
    import numpy as np

    bags = stage(_bags(texts, block), "bags")
    documents, words = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = np.zeros(len(block.words), np.int64)
    per = bags.filter("word is not null").groupBy("word").agg(F.sum("documents").alias("n")).toArrow()
    counts[per.column("word").to_numpy()] = per.column("n").to_numpy()
    weights = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * counts + 1))).astype(np.int64)
    # Without words there is no bag, hence no division by 0.
    classes = stage(_classes(bags.filter("bag is not null"), max(words, 1), documents, top), "classes")
    best = _scored(classes, block, weights, top).select("item", "score", F.explode("ids.doc_id").alias("doc_id"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return stage(ranked, "ranked"), block.ids
