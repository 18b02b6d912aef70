"""URL allow and block rules: a blocked Bloom filter in front of an exact hash join.

A rule is a canonical URL prefix: a host, meant with all its subdomains, and a path prefix. The
filter holds every rule's key, 256 bits to a block, eight of them set per key. A url's keys are its
host suffixes times the path lengths rules have; those the filter may hold go to an exact join with
the rules, which removes false positives. Urls without such a key never meet the join.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

BITS_PER_KEY = 16
BLOCK_WORDS = 8
# The filter is broadcast, so its size is bounded whatever the list: beyond it, more keys pass and
# the join removes them.
MOST_FILTER_BYTES = 16 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Odd multipliers, one per word of a block, as in the Parquet split-block filter.
SALTS = (
    0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D,
    0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31,
)


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def _keys(host: Column, path: Column, lengths: list[int], most_labels: int, longest: int) -> Column:
    """Host suffixes at a label boundary that a rule could have, with path prefixes of the given lengths.

    No rule's host has more than `most_labels` labels or `longest` characters, so a url has at most
    that many suffixes, whatever the length of its own host.
    """
    ends = F.slice(_labels(host), F.greatest(F.lit(-most_labels), -F.size(_labels(host))), F.lit(most_labels))
    ends = F.transform(ends, lambda label: F.substring(label, F.lit(1), F.lit(longest + 1)))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(ends)), lambda k: F.array_join(F.slice(ends, k, F.size(ends)), "."))
    suffixes = F.filter(suffixes, lambda s: F.length(s) <= longest)
    prefixes = F.array_distinct(
        F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _masks(hashes):
    """Block-independent part of the filter: eight one-bit words per hash."""
    import numpy as np

    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    salt = np.array(SALTS, np.uint32)
    return np.uint32(1) << ((low[:, None] * salt[None, :]) >> np.uint32(27))


def _blocks(hashes, count: int):
    import numpy as np

    return ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def may_hold(table, hashes):
    """Which hashes the filter may hold."""
    mask = _masks(hashes)
    return ((table[_blocks(hashes, len(table))] & mask) == mask).all(axis=1)


def build_filter(keys: DataFrame, most_bytes: int = MOST_FILTER_BYTES):
    """The filter over column `key`, as an array of blocks; built in tasks, merged by block."""
    import numpy as np

    total = keys.count()
    count = max(1, min(most_bytes // (4 * BLOCK_WORDS), -(-total * BITS_PER_KEY // 256)))
    names = [f"w{k}" for k in range(BLOCK_WORDS)]

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            masks = _masks(h).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_blocks(h, count)), *(pa.array(masks[:, k]) for k in range(BLOCK_WORDS))],
                names=["block", *names],
            )

    schema = ", ".join(f"{n} bigint" for n in ("block", *names))
    set_bits = keys.select(F.xxhash64("key").alias("h")).mapInArrow(run, schema)
    out = np.zeros((count, BLOCK_WORDS), np.uint32)
    for r in set_bits.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names]).toLocalIterator():
        out[r["block"]] = r[1:]
    return out


def possible_hits(urls: DataFrame, blocks) -> DataFrame:
    """`urls` with array column `keys` reduced to the keys the filter may hold."""
    shared = urls.sparkSession.sparkContext.broadcast(blocks)
    own = urls.withColumn("_h", F.transform("keys", lambda k: F.xxhash64(k)))
    schema = StructType([f for f in urls.schema.fields if f.name != "keys"] + [StructField("keys", ArrayType(StringType()))])

    def run(batches):
        import numpy as np

        table = shared.value
        for batch in batches:
            keys, hashes = batch.column("keys"), batch.column("_h")
            h = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            hit = may_hold(table, h)
            lengths = keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lengths)), lengths)
            kept = np.bincount(row[hit], minlength=len(lengths))
            offsets = np.concatenate(([0], np.cumsum(kept))).astype(np.int32)
            values = keys.flatten().filter(pa.array(hit, pa.bool_()))
            rest = [batch.column(n) for n in batch.schema.names if n not in ("keys", "_h")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.ListArray.from_arrays(pa.array(offsets), values)], names=schema.names
            )

    return own.mapInArrow(run, schema)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    most_filter_bytes: int = MOST_FILTER_BYTES,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    `rules` has host, path and verdict; a rule fits its host and all subdomains if the url's path
    starts with the rule's. The longest rule string wins (of equal length, the longer host). Without
    a rule the verdict is `default`, the rule null. A null url or one without :// has empty host and
    path. Null ids and repeated rows are kept as they are; an empty table gives an empty result, and
    empty rules give `default`. Of a rule given twice with different verdicts, block counts. A url may
    be of any length: the work on it grows with its length times the labels of the longest rule.
    """
    listed = rules.select(F.concat("host", "path").alias("key"), "host", "path", "verdict")
    listed = listed.filter("key is not null").groupBy("key").agg(
        F.max("verdict").alias("verdict"), F.max(F.length("host")).alias("host_length")
    )
    # The lengths rule paths have: at most as many as a url is long.
    lengths = [r[0] for r in rules.filter("path is not null").select(F.length("path")).distinct().collect()]
    size = rules.filter("host is not null and path is not null").agg(F.max(F.size(_labels(F.col("host")))), F.max(F.length("host"))).first()
    most_labels, longest = size[0] or 1, size[1] or 0
    blocks = build_filter(listed, most_filter_bytes)
    url = F.col(url_col)
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = urls.withColumn("keys", _keys(F.col("host"), F.col("path"), lengths, most_labels, longest))
    hits = possible_hits(urls, blocks)
    # Each different host and path is judged once; rows fetch the verdict by an equi join.
    asked = hits.filter(F.size("keys") > 0)
    found = asked.select("host", "path", F.explode("keys").alias("key")).distinct().join(listed, "key")
    longest = F.max(F.struct(F.length("key"), "host_length", F.col("key").alias("rule"), F.col("verdict").alias("said")))
    found = found.groupBy("host", "path").agg(longest.alias("m")).select("host", "path", "m.rule", "m.said")
    judged = asked.join(found, ["host", "path"], "left").select("page_id", "host", "path", "rule", "said")
    free = hits.filter(F.size("keys") == 0).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("said")
    )
    return judged.unionByName(free).select(
        "page_id", "host", "path", "rule", F.coalesce("said", F.lit(default)).alias("verdict")
    )
