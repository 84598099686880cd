"""A quality classifier by compression.

Two zstandard dictionaries are built from labelled text, one from good and one from bad documents. A text is cut into
blocks of BLOCK bytes, so that a dictionary matters as much at the end of a long text as in a short one, and every block is
compressed with either. The evidence is (bytes with the bad dictionary - bytes with the good one) / bytes of the text, where
every text counts as having some more bytes of average evidence, as a short text says little; a logistic curve, fitted
on whole labelled texts that neither dictionary has seen, turns it into a probability. How many bytes those are is fitted with it:
the number of PRIORS whose curve has the least loss on the same texts.

What is fitted is a bounded sample of labelled rows: SAMPLE_DOCS documents of each class. A quarter of them calibrates, and its
texts are compressed whole, by the executors. The others are cut into blocks, of which SAMPLE_BLOCKS of each class, dealt by
hash over all blocks of all these texts, make the dictionaries, which hold no more than DICT_BYTES.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import dropped, release, remainder, written

BLOCK = 1024
LEVEL = 3
DICT_BYTES = 110_000
#: The bound of the fitted sample: labelled documents of each class, and blocks of each class that make its dictionary.
SAMPLE_DOCS = 2500
SAMPLE_BLOCKS = 12_000
#: Every so many-th sampled document calibrates, the others make the dictionaries.
CALIBRATE_EVERY = 4
REJECT_BELOW = 0.7
PRIORS = (0, 64, 128, 256, 512, 1024)


@dataclass(frozen=True)
class Model:
    """Dictionaries and the logistic curve: a few hundred KB, sent to the executors."""

    good: bytes
    bad: bytes
    prior: int
    mean: float
    slope: float
    offset: float

    def score(self, text: bytes) -> float:
        z = self.slope * evidence(gain(self.good, self.bad, text), len(text), self.prior, self.mean) + self.offset
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, z))))


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def gain(good: bytes, bad: bytes, text: bytes) -> int:
    """Bytes that the good dictionary saves over the bad one."""
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    return sum(len(by_bad(b)) - len(by_good(b)) for b in blocks(text))


def evidence(saved: int, size: int, prior: int, mean: float) -> float:
    """The higher, the better the good dictionary fits; ``mean`` for an empty text."""
    return (saved + prior * mean) / (size + prior) if size + prior else mean


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; with too few samples to train on, their own bytes."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _curve(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float, float]:
    """(slope, offset, loss): logistic regression on one feature, with smoothed marks and classes weighted to the share of good labels."""
    if not len(x) or y.min() == y.max():
        return 0.0, math.log(max(share, 1e-3) / max(1 - share, 1e-3)), 0.0
    mean, std = x.mean(), x.std() + 1e-12
    at = np.stack([(x - mean) / std, np.ones_like(x)], 1)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    good, bad = (y == 1).sum(), (y == 0).sum()
    y = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))  # smoothed, so that separable samples give no infinite slope
    theta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(at @ theta, -50, 50)))
        hess = (at * (weight * p * (1 - p))[:, None]).T @ at + 1e-3 * np.eye(2)
        theta -= np.linalg.solve(hess, at.T @ (weight * (p - y)) + 1e-3 * theta)
    p = np.clip(1 / (1 + np.exp(-np.clip(at @ theta, -50, 50))), 1e-12, 1 - 1e-12)
    loss = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()
    return float(theta[0] / std), float(theta[1] - theta[0] * mean / std), float(loss)


def _calibrated(good: bytes, bad: bytes, y: np.ndarray, saved: np.ndarray, size: np.ndarray, share: float) -> Model:
    """The prior with the least loss (ties: the smaller one) and its curve."""
    each, mean = saved / np.maximum(1, size), 0.0
    if len(y) and y.min() < y.max():
        mean = float(share * np.median(each[y == 1]) + (1 - share) * np.median(each[y == 0]))
    best = None
    for prior in PRIORS:
        slope, offset, loss = _curve(np.array([evidence(a, b, prior, mean) for a, b in zip(saved, size, strict=True)]), y, share)
        if best is None or loss < best[0] - 1e-9:
            best = (loss, Model(good, bad, prior, mean, slope, offset))
    return best[1]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled documents of ``docs`` whose crc32(doc_id) mod 4 is not 2.

    Of each class the SAMPLE_DOCS labels with the smallest hash of their id; a document labelled both ways counts as
    neither. The texts of that bounded list are found by a broadcast join.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (remainder("doc_id", 4) != 2))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .select("doc_id", "quality", F.xxhash64("doc_id").alias("place"))
    )
    have = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = (have.get(1, 0) + 0.5) / (sum(have.values()) + 1)
    picked = []
    for quality in (1, 0):
        rows = usable.where(F.col("quality") == quality).orderBy("place", "doc_id").limit(SAMPLE_DOCS).collect()
        picked += [(r["doc_id"], quality, r["place"], k % CALIBRATE_EVERY == CALIBRATE_EVERY - 1) for k, r in enumerate(rows)]
    spark = docs.sparkSession
    kind = labels.schema["doc_id"].dataType.simpleString()
    listed = spark.createDataFrame(picked, f"doc_id {kind}, quality int, place long, calibrates boolean")
    texts = written(docs.select("doc_id", "text").join(F.broadcast(listed), "doc_id").select("place", "quality", "calibrates", "text"), "labelled-texts")

    def cut(batches):
        for batch in batches:
            for place, quality, text in zip(batch.column("place").to_pylist(), batch.column("quality").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                found = blocks(text.as_buffer().to_pybytes() if text.is_valid else b"")
                yield pa.RecordBatch.from_arrays([pa.array([quality] * len(found), pa.int32()), pa.array([place] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], ["quality", "place", "at", "block"])

    every = texts.where("not calibrates").select("place", "quality", "text").mapInArrow(cut, "quality int, place long, at int, block binary")
    every = written(every, "labelled-blocks")
    order = [F.xxhash64("place", "at"), F.col("place"), F.col("at"), F.col("block")]
    good, bad = (_dictionary([bytes(r["block"]) for r in every.where(F.col("quality") == q).orderBy(*order).limit(SAMPLE_BLOCKS).select("block").collect()]) for q in (1, 0))
    held = spark.sparkContext.broadcast((good, bad))

    def compressed(batches):
        for batch in batches:
            raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("quality"), pa.array([gain(*held.value, t) for t in raw], pa.int64()), pa.array([len(t) for t in raw], pa.int64())], ["place", "quality", "saved", "size"])

    rows = texts.where("calibrates").select("place", "quality", "text").mapInArrow(compressed, "place long, quality int, saved long, size long")
    rows = sorted(rows.collect(), key=tuple)
    dropped(texts, every)
    y, saved, size = (np.array([r[c] for r in rows], float) for c in ("quality", "saved", "size"))
    return _calibrated(good, bad, y, saved, size, share)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores every whole text of ``docs``.

    Returns doc_id, held_out (never learned from: crc32 of the id mod 4 is 2; false for a null id), score and predicted
    (1 if score >= REJECT_BELOW). Null and empty texts get the score of average evidence. Equal texts score alike. Without
    labels of both classes every score is the smoothed share of good labels. Other columns are not read.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(fit(docs, labels))

    def scored(batches):
        model = held.value
        for batch in batches:
            text = batch.column("text")
            out = np.fromiter((model.score(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in text.cast(pa.binary())), float, len(text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted")
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores REJECT_BELOW or more."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def filtered(batches):
        model = held.value
        for batch in batches:
            keep = [model.score(t.as_buffer().to_pybytes() if t.is_valid else b"") >= REJECT_BELOW for t in batch.column("text").cast(pa.binary())]
            yield batch.filter(pa.array(keep, pa.bool_()))
            release()

    return docs.mapInArrow(filtered, docs.schema)
