"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

A bounded sample of labelled documents becomes tf-idf vectors of hashed character trigrams
and of pseudo-terms for the shape of the text (how much of it repeats, in words and lines),
a truncated singular value decomposition turns them into latent vectors, and those are
broadcast. Every document is projected into the same space; its cosine with every labelled
vector is computed in exact blocked matrix products, and the nearest labels vote, weighted
by similarity.

What is broadcast has a fixed bound: ``sample x rank`` and ``BUCKETS x rank`` floats.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, pick, pieces, shown_id

BUCKETS = 2048
#: Pseudo-terms: a one-hot bin for each of three shares, with this weight beside unit trigrams.
BINS = 8
SHAPE_WEIGHT = 0.35
WIDTH = BUCKETS + 3 * BINS
#: Bound on the labelled documents that are fitted and broadcast.
SAMPLE = 4000
RANK = 48
NEIGHBOURS = 25
#: Votes of the base rate: decide where no labelled document is similar.
PRIOR_WEIGHT = 0.25
ACCEPT = 0.3


class Model(NamedTuple):
    """``axes``: bucket x latent dimension, idf folded in. ``points``: unit vectors."""

    axes: np.ndarray
    points: np.ndarray
    labels: np.ndarray
    prior: float


def learnable(c: Column) -> Column:
    """Whether labels of this id may be learned; a null id never is."""
    return F.coalesce(F.crc32(c.cast("string")) % 5 != 0, F.lit(False))


def bucket_counts(text: str) -> np.ndarray:
    """Counts of the text's character trigrams in ``BUCKETS`` hash buckets."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(c) < 3:
        c = np.concatenate([c, np.full(3 - len(c), 32, np.uint32)]) if len(c) else c
    if not len(c):
        return np.zeros(BUCKETS, np.float32)
    h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return np.bincount(h >> np.uint32(21), minlength=BUCKETS).astype(np.float32)


def shape_bins(text: str) -> list[int]:
    """Bins of: words that equal the word before, distinct words per square root of the words
    (long texts repeat more), lines that equal an earlier line."""
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    again = sum(map(eq, words, islice(words, 1, None))) / n
    rich = len(set(words)) / n ** 0.5
    double = 1 - len(set(lines)) / len(lines)
    return [min(int(again * 16), BINS - 1), min(int(rich * 0.8), BINS - 1), min(int(double * 10), BINS - 1)]


def weights(texts: list[str]) -> np.ndarray:
    """One row per text: dampened, length-free trigram weights and shape bins; empty: zeros."""
    x = np.log1p(np.stack([bucket_counts(t) for t in texts]))
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    out = np.zeros((len(texts), WIDTH), np.float32)
    out[:, :BUCKETS] = x / np.where(norm > 0, norm, 1)
    for row, text in zip(out, texts):
        if text:
            row[[BUCKETS + k * BINS + b for k, b in enumerate(shape_bins(text))]] = SHAPE_WEIGHT
    return out


def _weight_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        x = weights(b.column(1).to_pylist()).astype(np.float16)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "x"])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE, rank: int = RANK,
) -> Model:
    """Latent space and labelled points from at most ``sample`` labelled documents.

    The sample is the ids with the smallest hash among labelled ids that may be learned.
    Null ids and null labels are not learned; a label of repeated rows counts once (the
    larger one if they differ). Without any label the model has no points and every score
    is 0.5.
    """
    ids = (
        pick(labels, id=id_col, label=label_col)
        .select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"))
        .where(learnable(F.col("id")) & F.col("label").isNotNull())
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    # At most ``sample`` rows of two numbers are broadcast.
    texts = documents(docs, id_col, text_col).join(F.broadcast(ids), "id").groupBy("id").agg(
        F.first("label").alias("label"), F.max("text").alias("text")
    )
    rows = texts.orderBy(F.xxhash64("id"), "id").select("label", "text").mapInArrow(_weight_rows, "label int, x binary").collect()
    if not rows:
        return Model(np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    y = np.array([r["label"] for r in rows], np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x *= idf
    # Right singular vectors from the small bucket-by-bucket Gram matrix.
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = vectors[:, ::-1][:, : min(rank, len(x))]
    axes = (idf[:, None] * axes).astype(np.float32)
    points = unit((x / idf) @ axes)
    return Model(axes, points, y, float(y.mean()))


def unit(z: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    return z / np.where(norm > 0, norm, 1)


def votes(z: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled points.

    All points as similar as the last neighbour vote, so ties do not depend on an order.
    """
    if not len(model.points):
        return np.full(len(z), model.prior)
    sim = z @ model.points.T
    k = min(neighbours, sim.shape[1])
    least = np.partition(sim, sim.shape[1] - k, axis=1)[:, sim.shape[1] - k, None]
    w = np.where(sim >= least, np.clip(sim, 0, None), 0).astype(np.float64) ** 4
    total = w.sum(1) + PRIOR_WEIGHT
    return np.clip((w @ model.labels.astype(np.float64) + PRIOR_WEIGHT * model.prior) / total, 0, 1)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id (null stays null), text_key, score in 0..1.

    A null or empty text has no trigram and gets the base rate of the labels.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches, 256):
            z = unit(weights(b.column(2).to_pylist()) @ m.axes)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(votes(z, m))], ["id", "text_key", "score"])

    out = documents(docs, id_col, text_col).mapInArrow(scored, "id long, text_key long, score double")
    return out.select(shown_id().alias("doc_id"), "text_key", "score")


def accepted(docs: DataFrame, model: Model, threshold: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns kept.

    Decided in the pass that reads the rows: no shuffle, repeated rows stay repeated.
    """
    names = docs.columns
    at = names.index("text")
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches, 256):
            z = unit(weights([t or "" for t in b.column(at).to_pylist()]) @ m.axes)
            yield b.filter(pa.array(votes(z, m) >= threshold))

    return flat.mapInArrow(kept, flat.schema).toDF(*names)
