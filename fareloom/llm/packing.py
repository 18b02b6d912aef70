"""Packing token pieces into as few fixed-size sequences as possible: bin completion.

Documents become pieces in one pass, without their ids leaving the task (a piece carries the CRC of
its ids). Pieces are dealt evenly over groups of bounded size; each group is packed on its own by
bin completion, with best fit as the first incumbent. A group's badly filled sequences are opened
again and their pieces packed in a second round over all groups, so the loss does not grow with the
number of groups.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from fareloom.llm.tokens import compile_tokenizer, read_tokenizer
from fareloom.sources.staging import stage

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 8192
MOST_STEPS = 200_000  # search steps per group after best fit
WELL_FILLED = 0.98


# --- bin completion --------------------------------------------------------------------------


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit, largest first: indexes of each bin. `sizes` is sorted, largest first."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has room r
    for i, size in enumerate(sizes):
        fits = rooms >> size
        if fits:
            room = (fits & -fits).bit_length() - 1 + size
            own = by_room[room]
            b = own.pop()
            if not own:
                rooms &= ~(1 << room)
        else:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        room -= size
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """The larger of the total-size bound and the bound by items that exclude each other.

    For a threshold t: items over capacity - t stand alone, those over half of it exclude each
    other, and what the smaller ones down to t need beyond the room beside these takes more bins.
    """
    best = -(-sum(sizes) // capacity)
    for t in sorted({s for s in sizes if s <= capacity // 2})[:256]:
        alone = sum(1 for s in sizes if s > capacity - t)
        half = [s for s in sizes if capacity // 2 < s <= capacity - t]
        rest = sum(s for s in sizes if t <= s <= capacity // 2)
        spare = len(half) * capacity - sum(half)
        best = max(best, alone + len(half) + max(0, -(-(rest - spare) // capacity)))
    return best


class Effort:
    """Steps left in a search."""

    def __init__(self, steps: int):
        self.steps = steps

    def spend(self) -> bool:
        self.steps -= 1
        return self.steps >= 0


def fillings(counts: dict[int, int], room: int, most_waste: int, effort: Effort) -> Iterator[tuple[int, ...]]:
    """Undominated ways to fill `room` with the items left, wasting at most `most_waste`.

    Items are chosen largest first. A filling is skipped when an item left over would still fit, or
    when one of its items could be swapped for a larger one left over without exceeding the room:
    the filling after the swap dominates it. A branch ends when all items left cannot fill the room.
    """
    sizes = sorted(counts, reverse=True)
    below = [0] * (len(sizes) + 1)
    for j in range(len(sizes) - 1, -1, -1):
        below[j] = below[j + 1] + sizes[j] * counts[sizes[j]]

    def dominated(chosen: list[int], left: int) -> bool:
        used: dict[int, int] = {}
        for s in chosen:
            used[s] = used.get(s, 0) + 1
        spare = [s for s in sizes if counts[s] > used.get(s, 0)]
        if any(s <= left for s in spare):
            return True
        return any(c < s <= c + left for c in used for s in spare)

    def go(k: int, left: int, chosen: list[int]) -> Iterator[tuple[int, ...]]:
        if left <= most_waste and not dominated(chosen, left):
            yield tuple(chosen)
        for j in range(k, len(sizes)):
            if left - below[j] > most_waste or not effort.spend():
                return
            s = sizes[j]
            if s <= left and counts[s] > chosen.count(s):
                chosen.append(s)
                yield from go(j, left - s, chosen)
                chosen.pop()

    return go(0, room, [])


def bin_completion(sizes: list[int], capacity: int, most_steps: int = MOST_STEPS) -> list[list[int]]:
    """Bins as lists of indexes into `sizes`, which is sorted, largest first.

    Depth-first: the largest item left opens a bin, each undominated filling around it is a branch,
    fullest first as found. A branch is cut when its waste exceeds what a solution better than the
    incumbent may waste in all. Best fit is the first incumbent; a solution at the lower bound ends
    the search, and so do `most_steps` steps (the incumbent is then kept: still a full packing).
    """
    incumbent = best_fit(sizes, capacity)
    total = sum(sizes)
    if len(incumbent) <= -(-total // capacity):
        return incumbent
    bound = lower_bound(sizes, capacity)
    if len(incumbent) <= bound:
        return incumbent
    places: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        places.setdefault(s, []).append(i)
    counts = {s: len(p) for s, p in places.items()}
    best: list[tuple[int, ...]] | None = None
    aim = len(incumbent) - 1  # bins of a better solution
    done: list[tuple[int, ...]] = []
    wasted, effort = 0, Effort(most_steps)

    def take(filling: tuple[int, ...], sign: int) -> None:
        for s in filling:
            counts[s] = counts.get(s, 0) - sign
            if not counts[s]:
                del counts[s]

    def branches() -> Iterator[tuple[int, ...]]:
        largest = max(counts)
        take((largest,), 1)
        allowed = aim * capacity - total - wasted
        found = fillings(dict(counts), capacity - largest, allowed, effort)
        take((largest,), -1)
        return ((largest, *f) for f in found)

    stack = [branches()]
    while stack:
        filling = next(stack[-1], None) if effort.spend() else None
        if filling is None:
            stack.pop()
            if done:
                last = done.pop()
                take(last, -1)
                wasted -= capacity - sum(last)
            if effort.steps < 0:
                break
            continue
        waste = capacity - sum(filling)
        if wasted + waste > aim * capacity - total:
            continue
        take(filling, 1)
        done.append(filling)
        wasted += waste
        if counts:
            stack.append(branches())
            continue
        best, aim = list(done), len(done) - 1
        if len(done) <= bound:
            break
        take(done.pop(), -1)
        wasted -= waste
    if best is None:
        return incumbent
    return [[places[s].pop() for s in filling] for filling in best]


# --- Spark -----------------------------------------------------------------------------------


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids plus the end id, cut at `capacity`."""
    content = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))
    schema = StructType(
        [
            StructField("doc_id", docs.schema[id_col].dataType),
            StructField("piece", IntegerType()),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids_crc32", LongType()),
        ]
    )

    def run(batches):
        compiled = compile_tokenizer(content.value)
        end, step = struct.pack("<I", END_ID), 4 * capacity
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = compiled.ids(text or "") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                ],
                names=schema.names,
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _packed(pieces: DataFrame, groups: int, first: int, capacity: int, most_steps: int) -> DataFrame:
    """One round: every piece with sequence_id, offset and its sequence's fill."""
    # Rows are told apart by their place, not by their ids: repeated rows spread like any other.
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    names = [*pieces.columns, "sequence_id", "offset", "fill"]
    schema = StructType(
        [*pieces.schema.fields, *(StructField(n, LongType()) for n in ("sequence_id", "offset", "fill"))]
    )

    def pack(table: pa.Table) -> pa.Table:
        import numpy as np

        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * capacity))
        length = table.column("length").to_numpy()
        order = np.lexsort((table.column("piece").to_numpy(), -length))
        sizes = length[order].tolist()
        base = (first + int(table.column("grp")[0].as_py())) << 32
        seq, off, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
        for b, members in enumerate(bin_completion(sizes, capacity, most_steps)):
            at = 0
            for i in members:
                seq[i], off[i] = base + b, at
                at += sizes[i]
            fill[members] = at
        out = table.drop_columns(["grp"]).take(pa.array(order))
        return pa.table([*out.columns, pa.array(seq), pa.array(off), pa.array(fill)], names=names)

    return dealt.groupBy("grp").applyInArrow(pack, schema)


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    most_steps: int = MOST_STEPS,
) -> DataFrame:
    """`pieces` with sequence_id and offset. No piece is split, lost or changed.

    `group_pieces` bounds what one task packs; `most_steps` bounds the effort per group, never
    the result. `pieces` has to be a stored table: it is read more than once.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    if groups == 1:
        return _packed(pieces, 1, 0, capacity, most_steps).drop("fill")
    once = stage(_packed(pieces, groups, 0, capacity, most_steps), "packed")
    full = F.col("fill") >= int(WELL_FILLED * capacity)
    rest = once.filter(~full).drop("sequence_id", "offset", "fill")
    again = max(1, -(-rest.count() // group_pieces))
    packed = _packed(rest, again, groups, capacity, most_steps)
    return once.filter(full).unionByName(packed).drop("fill")


def best_fit_packing(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A null or empty text is one piece: the end id. Only documents longer than `capacity` are cut.
    Repeated rows and rows with a null id are packed like any other; an empty table gives no rows.
    Sequence ids are unique numbers without meaning; offsets run from 0 without gaps.
    """
    pieces = stage(token_pieces(docs, tokenizer, capacity, id_col, text_col), "pieces")
    return pack_pieces(pieces, capacity)

