"""Order MinHash fingerprints from DataFrame functions only.

A text's k-mers of words are numbered by occurrence, so repeats count. For each of M hash functions
the L smallest numbered k-mers are taken, put back into text order and hashed together: one part of
the fingerprint. Two texts agree in a part if they share these k-mers in the same order, which is
what edit distance preserves and plain MinHash does not see.

The hash functions are one 64-bit hash seen from M fixed points of the number circle: an element's
value is its distance after the point. So one sorted array serves all of them, and the L smallest
are the L elements that follow the point. A k-mer's hash keeps its upper bits for its place on the
circle, the lower ones hold its place in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORDS = 2  # words in a k-mer
PARTS = 32
SMALLEST = 2  # k-mers per part
BUCKETS_PER_PARTITION = 4

PLACE_BITS = 26  # k-mers of a text that can be told apart by place
PLACES = (1 << PLACE_BITS) - 1
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def _points() -> list[int]:
    """M numbers evenly over the signed 64-bit range, with the lower bits all set as a mark."""
    step = (1 << 64) // PARTS
    return [(-(1 << 63) + j * step + step // 3) | PLACES for j in range(PARTS)]


def _indexes(array: Column, count: Column | None = None) -> Column:
    n = F.size(array) if count is None else count
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def with_parts(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """`df` with array column `out`: the PARTS numbers of the text's fingerprint.

    None for a null or empty text, or one of blanks only. Works within the row, in linear steps
    and two sorts: sorted by hash and place, equal k-mers are runs. With e elements before index i
    that are not the first of their run, the run of i is the (i - e)-th, so its first index is
    known, and the distance to it is the occurrence number.
    """
    w, s, r, f = (F.col(c) for c in ("_w", "_s", "_r", "_f"))

    def packed(h: Column, place: Column) -> Column:
        return h.bitwiseAND(F.lit(~PLACES)).bitwiseOR(place.cast("long").bitwiseAND(F.lit(PLACES)))

    def kmer(i: Column) -> Column:
        return F.shiftright(F.get(s, i), PLACE_BITS)

    def numbered(i: Column, number: Column) -> Column:
        return packed(F.xxhash64(kmer(i), number), F.get(s, i))

    words = F.split(F.coalesce(F.trim(F.col(text_col), F.lit(" \t\n\x0b\f\r")), F.lit("")), BLANKS)
    words = F.when(F.get(words, F.lit(0)) != "", words).otherwise(F.array().cast("array<string>"))
    count = F.when(F.size(w) > 0, F.greatest(F.size(w) - (WORDS - 1), F.lit(1))).otherwise(0)
    kmers = F.transform(
        _indexes(w, count), lambda i: packed(F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]), i)
    )
    repeats = F.filter(_indexes(s), lambda i: (i > 0) & (kmer(i) == kmer(i - 1)))
    starts = F.filter(_indexes(s), lambda i: (i == 0) | (kmer(i) != kmer(i - 1)))
    first = F.transform(F.col("_p"), lambda i: numbered(i, F.lit(0)))
    again = F.transform(r, lambda i, e: numbered(i, i - F.get(F.col("_p"), i - e - 1)))
    points = _points()
    circle = F.sort_array(F.concat(first, again, F.array(*[F.lit(p) for p in points])))

    def part(point: int) -> Column:
        # The elements after the point; marks of other points in between are skipped.
        after = F.slice(f, F.array_position(f, F.lit(point)).cast("int") + 1, SMALLEST + PARTS)
        marks_out = F.filter(after, lambda x: x.bitwiseAND(F.lit(PLACES)) != PLACES)
        chosen = F.slice(marks_out, F.lit(1), F.least(F.size(s), F.lit(SMALLEST)))
        in_text = F.sort_array(
            F.transform(chosen, lambda x: F.struct(x.bitwiseAND(F.lit(PLACES)), F.shiftright(x, PLACE_BITS)))
        )
        return F.xxhash64(in_text["col2"])

    # Around the circle: the first elements once more behind the last.
    circle = F.concat(circle, F.slice(circle, 1, SMALLEST + PARTS))
    parts = F.when(F.size(s) > 0, F.array(*[part(p) for p in points])).otherwise(F.array().cast("array<bigint>"))
    return (
        df.withColumn("_w", words)
        .withColumn("_s", F.sort_array(kmers))
        .withColumns({"_r": repeats, "_p": F.when(F.size(s) > 0, starts).otherwise(_indexes(s))})
        .withColumn("_f", circle)
        .withColumn(out, parts)
        .drop("_w", "_s", "_r", "_p", "_f")
    )


def as_string(p: Column) -> Column:
    return F.array_join(F.transform(p, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts; two empty fingerprints are alike, an empty and another are not."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, 1.0).otherwise(equal / most).cast("double")


def _bounds(docs: DataFrame, buckets: int) -> list:
    found = docs.agg(F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 10_000)).first()[0]
    return sorted(set(found or []), reverse=True)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, parts, and next_text, next_parts of the next document by falling doc_id.

    Null ids come last; equal ids are ordered by their text. After the last document comes the
    first. Documents are bucketed by ranges of ids, at most a few thousand however many rows there
    are, and each bucket ends with a copy of the next one's first document, so the order is never
    sorted in one task.
    """
    spark = docs.sparkSession
    buckets = max(2, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(docs.select("doc_id"), buckets)
    edges = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    # Bucket 0 holds the largest ids; nulls are in the last.
    bucket = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(
        F.size(F.filter(edges, lambda b: b > F.col("doc_id")))
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bucket.alias("bucket"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    # One row per bucket, of two numbers: its first document.
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).orderBy("bucket").collect()
    if not heads:
        return with_parts(rows, "text", "parts").selectExpr(
            "doc_id", "text", "parts", "text as next_text", "parts as next_parts"
        )
    follows = [(heads[i - 1]["bucket"], h["bucket"], h["doc_id"]) for i, h in enumerate(heads)]
    guests = spark.createDataFrame(follows, "bucket int, _from int, _id bigint")
    first = rows.withColumnRenamed("bucket", "_from").join(
        F.broadcast(guests), ["_from"]  # at most `buckets` rows
    )
    first = first.filter(F.col("doc_id").eqNullSafe(F.col("_id")))
    first = first.groupBy("bucket", "doc_id").agg(F.min(F.struct("key", "text")).alias("m"))
    guest = first.select("doc_id", F.col("m.text").alias("text"), "bucket", F.col("m.key").alias("key"), F.lit(1).alias("guest"))
    all_rows = rows.withColumn("guest", F.lit(0)).unionByName(guest)
    all_rows = with_parts(all_rows, "text", "parts")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "key")
    return (
        all_rows.withColumns(
            {"next_text": F.lead("text").over(order), "next_parts": F.lead("parts").over(order)}
        )
        .filter("guest = 0")
        .select("doc_id", "text", "parts", "next_text", "next_parts")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text keeps the first code points and replaces the last floor(n / 2) by the first as
    many of the next document (all of a shorter one). Null texts count as empty; equal texts have
    equal fingerprints; repeated rows each get a row; a single row is its own next document. Texts
    with over 2^26 k-mers reuse places, which only blurs their order. An empty table stays empty.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    out = with_next(docs.select("doc_id", "text")).select(
        "doc_id", n.cast("long").alias("n_chars"), "parts", "next_parts", edited.alias("edited")
    )
    out = with_parts(out.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_parts")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("parts")).alias("fingerprint"),
        as_string(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
    )
