"""Merkle manifest of a table: a hash tree per group, a tree over the groups, a proof for every row.

Leaves of a group ascend by the order column; eight consecutive nodes make a run whose hash is the
node above, until one node, the group's root, is left. The group roots are the leaves of one more
tree, which ends in the root of the table.

Proofs come from pointer jumping. Every inner node starts with the siblings in its own run and a
pointer to the node above. In a round, the table of nodes is joined with itself: a node appends the
siblings its pointer's node holds and takes over that node's pointer, so the distance covered doubles
and about log2(height) rounds reach the root. The leaves of a run share all that is above it, so they
take part in the last jump only, and the growing proofs are shuffled once for every eight leaves.

Places in a group are found by a range sort of narrow rows (order column and two digests) whose tie
breaker is unique: a group, an order value or a row that makes up a third of the table is cut into
several ranges. Texts are hashed where they are read and never shuffled. Every table that another
step builds on is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.sources.staging import stage

FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS
DIGEST_BYTES = 32
GROUPS = -1  # the tree over the groups' roots; groups are numbered from 0
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PROOF = "array<struct<left:binary,right:binary>>"


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _hash(digests: Column) -> Column:
    """Digest of the concatenated digests, as bytes; the input is their hex text."""
    return F.unhex(F.sha2(_hex(digests).cast("binary"), 256))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field `-` if null, else its UTF-8 byte count, `:` and its value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _placed(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """`rows` with `idx`, the place within the group from 0, and `size`, the group's rows.

    The group column leads `order`. Rows are range-sorted and numbered within their partition; what
    each partition holds of each group is a small table whose running sums give the rest.
    """
    own = rows.columns
    at = F.monotonically_increasing_id()
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    numbered = stage(numbered.withColumn("_part", F.shiftright("_at", 33)), "sorted")
    held = numbered.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    held = stage(held, "held")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias("size"),
    )
    held = stage(held, "held")
    same = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group"))
    found = numbered.join(held, same)
    return found.select(*own, (F.col("_at") + F.col("_shift")).alias("idx"), "size")


def _node(tree: Column, level: Column, idx: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


def _runs(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """The levels above `leaves` (tree, idx, size, digest), one table each, by a fold of runs.

    A level has the columns of `leaves` and `run`, the digests below it in order. A tree ends with
    the level whose size is 1.
    """
    levels = []
    while largest > 1:
        below = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        up = leaves.filter("size > 1").groupBy(
            "tree",
            F.shiftright("idx", FANOUT_BITS).alias("up"),
            F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("above"),
        )
        run = F.aggregate(below, F.expr("X''"), lambda all, one: F.concat(all, one["digest"]))
        up = up.agg(run.alias("run")).select(
            "tree", F.col("up").alias("idx"), F.col("above").alias("size"), _hash(F.col("run")).alias("digest"), "run"
        )
        leaves = stage(up, "level")
        levels.append(leaves)
        largest = -(-largest // FANOUT)
    return levels


def _siblings(run: str, place: Column) -> Column:
    """What is left and right of the place in a run."""
    at = place * DIGEST_BYTES
    left = F.substring(F.col(run), F.lit(1), at.cast("int"))
    right = F.substring(F.col(run), (at + DIGEST_BYTES + 1).cast("int"), F.lit(FANOUT * DIGEST_BYTES))
    return F.struct(left.alias("left"), right.alias("right"))


def _up(level: Column, groups: int) -> tuple[Column, Column]:
    """The node above (null for the root) and the place in its run, from columns tree, idx, size."""
    tree, idx, place = F.col("tree"), F.col("idx"), FANOUT - 1
    inside = F.col("size") > 1
    crosses = (tree != GROUPS) & F.lit(groups > 1)
    above = F.when(inside, _node(tree, level + 1, F.shiftright(idx, FANOUT_BITS))).when(
        crosses, _node(F.lit(GROUPS), F.lit(1), F.shiftright(tree, FANOUT_BITS))
    )
    return above, F.when(inside, idx.bitwiseAND(F.lit(place))).when(crosses, tree.bitwiseAND(F.lit(place)))


def _paths(levels: list[tuple[int, DataFrame]], groups: int, height: int) -> DataFrame:
    """here, path: the siblings from every inner node to the root, by pointer jumping."""
    runs, nodes = None, None
    for level, rows in levels:
        own = rows.select(_node(F.col("tree"), F.lit(level), F.col("idx")).alias("up"), "run")
        runs = own if runs is None else runs.unionByName(own)
        above, place = _up(F.lit(level), groups)
        here = _node(F.col("tree"), F.lit(level), F.col("idx"))
        own = rows.select(here.alias("here"), above.alias("up"), place.alias("place"))
        nodes = own if nodes is None else nodes.unionByName(own)
    first = nodes.join(runs, "up").select("here", "up", F.array(_siblings("run", F.col("place"))).alias("path"))
    root = nodes.filter("up is null").select("here", "up", F.array().cast(_PROOF).alias("path"))
    paths, reach = stage(first.unionByName(root), "paths"), 1
    while reach < height:
        further = paths.select(F.col("here").alias("up"), F.col("up").alias("next"), F.col("path").alias("rest"))
        jumped = paths.join(further, "up").select("here", F.col("next").alias("up"), F.concat("path", "rest").alias("path"))
        paths = stage(jumped.unionByName(paths.filter("up is null")), "paths")
        reach *= 2
    return paths.join(runs.withColumnRenamed("up", "here"), "here").select("here", "run", "path")


def merkle_proofs(leaves: DataFrame, group: str, order: str, leaf: str = "leaf") -> DataFrame:
    """`leaves` with `subroot` and `root` (bytes) and `proof`, the sibling digests from row to root.

    `proof` is an array with one struct per level, `left` and `right` of the node on the way, each
    the concatenated digests of the run's others. Groups are ordered null first, then by bytes. Rows
    of a group are ordered by `order`, null first, then by digest; repeated rows are leaves of their
    own, in any order. A group of one row has that leaf for its subroot, one group has its subroot
    for root, and a proof has no level there. An empty table gives an empty result.
    """
    own = leaves.columns
    names = {c: f"_own{i}" for i, c in enumerate(own)}  # no clash with the columns made here
    rows = leaves.select(
        *[F.col(c).alias(n) for c, n in names.items()],
        F.col(group).alias("_g"),
        F.col(leaf).alias("digest"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Written once: digests are not taken again, and the tie breaker stays what it is.
    rows = stage(rows, "leaves")
    keys = [F.col("_g").asc_nulls_first(), F.col(names[order]).asc_nulls_first(), F.col("digest"), F.col("_row")]
    placed = stage(_placed(rows, "_g", keys), "places")
    groups = placed.filter("idx = 0").select("_g", "size")
    numbered = _placed(groups.select("_g", F.col("size").alias("rows"), F.lit(GROUPS).alias("all")), "all", [F.col("all"), F.col("_g").asc_nulls_first()])
    numbered = stage(numbered.select(F.col("_g").alias("_of"), F.col("idx").alias("tree"), "rows", "size"), "groups")
    most, count = numbered.agg(F.max("rows"), F.max("size")).first()
    placed = placed.join(numbered.select("_of", "tree"), F.col("_g").eqNullSafe(F.col("_of"))).drop("_of", "_g", "_row")

    node = ["tree", "idx", "size", "digest"]
    below = _runs(placed.select(*node), most or 0)
    tops = placed.select(*node)
    for level in below:
        tops = tops.unionByName(level.select(*node))
    tops = stage(tops.filter("size = 1").select("tree", F.col("digest").alias("subroot")), "subroots")
    over = _runs(
        tops.select(F.lit(GROUPS).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count or 0).cast("long").alias("size"), F.col("subroot").alias("digest")),
        count or 0,
    )
    if over:
        root = over[-1].first()["digest"]
    else:
        top = tops.first()
        root = top and top["subroot"]
    root = F.lit(None).cast("binary") if root is None else F.lit(bytes(root))

    above, place = _up(F.lit(0), count or 0)
    placed = placed.withColumns({"_up": above, "_place": place})
    out = [F.col(n).alias(c) for c, n in names.items()]
    levels = [(k + 1, rows) for k, rows in enumerate(below)] + [(k + 1, rows) for k, rows in enumerate(over)]
    if not levels:  # no row, or one: it is the root
        return placed.select(*out, F.col("digest").alias("subroot"), root.alias("root"), F.array().cast(_PROOF).alias("proof"))
    shared = _paths(levels, count, len(levels))
    # The runs' subroots go with the paths, an eighth of the leaves; a lone leaf is its own.
    shared = shared.join(tops, F.col("here.tree") == F.col("tree"), "left").drop("tree")
    found = placed.join(shared, F.col("_up") == F.col("here"))
    proof = F.concat(F.array(_siblings("run", F.col("_place"))), F.col("path"))
    return found.select(*out, F.coalesce("subroot", "digest").alias("subroot"), root.alias("root"), proof.cast(_PROOF).alias("proof"))


def fold(leaf: Column, proof: Column) -> Column:
    """Hex root that a leaf (bytes) and its proof lead to."""
    return F.aggregate(
        proof,
        _hex(leaf),
        lambda own, level: F.sha2(F.concat(_hex(level["left"]), own, _hex(level["right"])).cast("binary"), 256),
    )


def proof_digest(proof: Column) -> Column:
    """Hex digest of all digests of a proof, level by level, left to right."""
    all = F.aggregate(proof, F.lit(""), lambda own, level: F.concat(own, _hex(level["left"]), _hex(level["right"])))
    return F.sha2(all.cast("binary"), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """Manifest of `documents` with a tampering check, one row per row.

    doc_id, leaf, subroot, root, proof_sha256, and folded_root and verified for a tampered copy: A-Z
    of the text lower-cased where 3 divides crc32 of the decimal doc_id. Null fields are hashed as
    `-`; a null doc_id comes first in its group and is not tampered with; empty and null texts and
    texts without A-Z verify. Only FIELDS are read.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = [lower_ascii(c) if n == "text" else c for n, c in zip(FIELDS, fields)]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        "doc_id", "lang", leaf_digest(fields).alias("leaf"), F.when(hit, leaf_digest(changed)).alias("tampered")
    )
    found = merkle_proofs(leaves, "lang", "doc_id")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
