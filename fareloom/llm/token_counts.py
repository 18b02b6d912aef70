"""Token counts by a compiled tokenizer, long texts by composed chunk maps.

The map of a chunk says what it does to any state the automaton may enter it in. A state is the
unfinished stretch read so far; the first blank of a chunk ends it and the last one starts the next,
so the map is three values: what is added to the stretch that comes in, the tokens emitted strictly
inside, and the stretch handed on. Maps compose associatively; a text's count is the last element
of the prefix scan over its chunks' maps. Only texts longer than a chunk have more than one.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from fareloom.llm.tokens import ASCII_BLANK, WholeText, compile_tokenizer, read_tokenizer

CHUNK_CHARS = 1 << 16


class ChunkMap(NamedTuple):
    head: str  # goes to the incoming stretch
    emitted: int  # tokens of the stretches that lie inside
    tail: str | None  # the outgoing stretch; None: no blank, the stretch stays open


def chunk_map(text: str, count) -> ChunkMap:
    first = ASCII_BLANK.search(text)
    if first is None:
        return ChunkMap(text, 0, None)
    cut = max(text.rfind(b) for b in " \t\n\r\x0b\x0c")
    return ChunkMap(text[: first.start()], count(text[first.end() : cut + 1]), text[cut + 1 :])


def compose(a: ChunkMap, b: ChunkMap, count) -> ChunkMap:
    if a.tail is None:
        return ChunkMap(a.head + b.head, b.emitted, b.tail)
    if b.tail is None:
        return ChunkMap(a.head, a.emitted, a.tail + b.head)
    return ChunkMap(a.head, a.emitted + count(a.tail + b.head) + b.emitted, b.tail)


def prefix_scan(maps: list[ChunkMap], count) -> list[ChunkMap]:
    """Inclusive scan in log2(n) levels: pairs first, then the odd places from their neighbours."""
    if len(maps) < 2:
        return maps
    pairs = [compose(maps[i], maps[i + 1], count) for i in range(0, len(maps) - 1, 2)]
    odd = prefix_scan(pairs, count)
    out = [maps[0]]
    for i in range(1, len(maps)):
        out.append(odd[i // 2] if i % 2 else compose(odd[i // 2 - 1], maps[i], count))
    return out


def count_text(text: str, count, chunk: int = CHUNK_CHARS) -> int:
    if len(text) <= chunk:
        return count(text)
    maps = [chunk_map(text[i : i + chunk], count) for i in range(0, len(text), chunk)]
    total = prefix_scan(maps, count)[-1]
    return count(total.head) + total.emitted + (count(total.tail) if total.tail else 0)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; `tokenizer` is the vocabulary file.

    Counts are those of the library on the whole text, without added special tokens. A null text
    counts as empty: no bytes, no tokens. Null ids and repeated rows are kept as they are; an empty
    table gives an empty result. One pass, no shuffle; a task holds one Arrow batch of rows.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))
    fields = [
        StructField("doc_id", docs.schema[id_col].dataType),
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType()),
    ]

    def run(batches):
        compiled = compile_tokenizer(content.value)
        chunk = 1 << 62 if isinstance(compiled, WholeText) else CHUNK_CHARS
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [count_text(t, compiled.count, chunk) for t in texts]
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=[f.name for f in fields],
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, StructType(fields))
