"""Quality by compression: texts are scored by which class's dictionary compresses them better.

A zstandard dictionary is built from a bounded sample of good labelled texts and one from bad ones.
Each text is compressed piece by piece with both; the difference of the two sizes over the larger
is the evidence, and a logistic curve fitted on labelled texts kept out of the dictionaries turns
it into a probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from fareloom.sources.staging import stage

# The sample the classifier is fitted on: at most so many texts and characters per class, half of
# them for the dictionaries and half for the curve.
SAMPLE_ROWS = 3_600
SAMPLE_CHARS = 16_000_000
DICTIONARY_BYTES = 64_000
PIECE_BYTES = 2_048  # short pieces keep the dictionary in play through a long text
LEVEL = 3
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo FOLDS."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def evidence_of(good: bytes, bad: bytes):
    """text -> normalised compressed-size difference, in (-1, 1); positive speaks for good."""
    import zstandard

    def sizes_with(content: bytes):
        d = zstandard.ZstdCompressionDict(content)
        c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False)
        return c.compress

    with_good, with_bad = sizes_with(good), sizes_with(bad)

    def evidence(text: bytes) -> float:
        if not text:
            return 0.0
        g = b = 0
        for at in range(0, len(text), PIECE_BYTES):
            piece = text[at : at + PIECE_BYTES]
            g += len(with_good(piece))
            b += len(with_bad(piece))
        return (b - g) / max(b, g)

    return evidence


def logistic_fit(
    x: list[float], y: list[int], share: float = 0.5, rounds: int = 50
) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with smoothed targets (Platt) against separable samples.

    Rows are weighted so that ones have the `share` they have among all labelled rows.
    """
    import numpy as np

    x, y = np.asarray(x, float), np.asarray(y, float)
    weight = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    design = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.array([0.0, math.log((pos + 1) / (neg + 1))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (p - target)) + 1e-6 * w
        hess = design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _sample(sizes: DataFrame, texts: DataFrame, label: int, rows: int, chars: int) -> list[bytes]:
    """Texts of one class in order of their id's hash: at most `rows` of at most `chars` in all.

    Chosen by id and length alone; only the chosen texts leave the scan.
    """
    heads = sizes.filter(F.col("label") == label).orderBy("key", "id", "n").limit(rows).collect()
    ids, room = [], chars
    for h in heads:
        room -= h["n"]
        if room < 0 and ids:
            break
        ids.append(h["id"])
    if not ids:
        return []
    own = texts.filter(F.col("id").isin(ids)).select("id", F.col("text").cast("binary").alias("text"))
    return [bytes(r["text"]) for r in own.orderBy(F.xxhash64("id"), "id", "text").limit(rows).collect()]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train on."""
    import zstandard

    pieces = [t[at : at + PIECE_BYTES] for t in texts for at in range(0, len(t), PIECE_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[:DICTIONARY_BYTES]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> QualityModel:
    """Fit on labelled rows outside the held-out fold; `rows` and `chars` bound the sample per class.

    Null ids, labels and texts are left out. With no row of a class, its dictionary is empty and
    every score is the smoothed share of good rows.
    """
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .filter(fold(id_col) != HELD_OUT)
        .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        .distinct()
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull() & (fold("id") != HELD_OUT)
    )
    sizes = texts.select("id", F.length("text").alias("n")).join(known, "id")
    sizes = stage(sizes.withColumn("key", F.xxhash64("id")), "labelled")
    seen = {r["label"]: r["count"] for r in sizes.groupBy("label").count().collect()}
    good, bad = (_sample(sizes, texts, label, rows, chars) for label in (1, 0))
    dicts = _dictionary(good[::2]), _dictionary(bad[::2])
    if not (good and bad):
        share = math.log((len(good) + 1) / (len(bad) + 1))
        return QualityModel(*dicts, 0.0, share)
    evidence = evidence_of(*dicts)
    rest = [(evidence(t), 1) for t in good[1::2] or good] + [(evidence(t), 0) for t in bad[1::2] or bad]
    share = seen[1] / (seen[0] + seen[1])
    return QualityModel(*dicts, *logistic_fit([x for x, _ in rest], [y for _, y in rest], share))


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    text_col: str = "text",
    score: str = "score",
    predicted: str = "predicted",
) -> DataFrame:
    """The frame's columns plus `score` (0 to 1, higher is better) and `predicted` (1 if score >= 0.5).

    Only the text is read by the score. A null or empty text has no evidence: it scores as the
    curve says at zero. Repeated rows score alike; an empty table stays empty. Columns of the frame
    named like an output are replaced. One pass, no shuffle.
    """
    own = docs.drop(score, predicted)
    # A plain tuple: workers need not have this package to read it.
    shared = docs.sparkSession.sparkContext.broadcast((model.good, model.bad, model.slope, model.intercept))
    schema = StructType(
        [*own.schema.fields, StructField(score, DoubleType()), StructField(predicted, IntegerType())]
    )
    where = own.columns.index(text_col)

    def run(batches):
        good, bad, slope, intercept = shared.value
        evidence = evidence_of(good, bad)
        for batch in batches:
            scores = []
            for text in batch.column(where).to_pylist():
                z = slope * evidence((text or "").encode()) + intercept
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                names=schema.names,
            )

    return own.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit_quality(docs, labels)
    scored = score_quality(docs.select("doc_id", "text"), model)
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, all their columns as they were."""
    score, predicted = "score", "predicted"
    while {score, predicted} & set(docs.columns):
        score, predicted = f"_{score}", f"_{predicted}"
    scored = score_quality(docs, fit_quality(docs, labels), score=score, predicted=predicted)
    return scored.filter(f"`{predicted}` = 1").drop(score, predicted)
