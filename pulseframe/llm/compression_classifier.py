"""Quality by compression: dictionaries of good and of bad text, and which of them makes a document smaller.

A document's bytes are cut into pieces of ``PIECE`` bytes, each compressed alone with either dictionary, so that long
texts are judged all over and not only while the window is young. The difference of the two total sizes over the raw size,
(bad - good) / raw, goes through a logistic curve fitted on labelled rows that made no dictionary.

Fitting uses a bounded sample: the ``SAMPLE_ROWS`` labels of each class with the smallest hashes, whose ids are few
enough to go to the texts by broadcast, so that no text is shuffled; of those rows the pieces of labelled text with the smallest hashes, at most ``SAMPLE_PIECES`` of each
class, and the differences of at most ``CALIBRATION_ROWS`` rows. Everything else covers all rows.

Defined results: null and empty texts have difference 0 and the score the curve gives there; rows without label or
with a null label are not learned; a document with several labels is learned with each; without labels of both
classes every score is the share of good labels, or 0.5 without any. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .textnum import column_bytes

PIECE = 2048
LEVEL = 3
DICTIONARY_BYTES = 96 * 1024
SAMPLE_PIECES = 3000
SAMPLE_ROWS = 4000
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3


class Model:
    """Two dictionaries and the curve ``1 / (1 + exp(-(slope * difference + offset)))``."""

    def __init__(self, good: bytes, bad: bytes, slope: float = 0.0, offset: float = 0.0):
        self.good, self.bad, self.slope, self.offset = good, bad, slope, offset

    def compressors(self) -> list[zstandard.ZstdCompressor] | None:
        if not (self.good and self.bad):
            return None
        made = []
        for data in (self.good, self.bad):
            words = zstandard.ZstdCompressionDict(data)
            words.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False))
        return made

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -60, 60)))


def difference(text: bytes, compressors: list[zstandard.ZstdCompressor] | None) -> float:
    if not text or compressors is None:
        return 0.0
    good = bad = 0
    for i in range(0, len(text), PIECE):
        piece = text[i : i + PIECE]
        good += len(compressors[0].compress(piece))
        bad += len(compressors[1].compress(piece))
    return (bad - good) / len(text)


def differences(docs: DataFrame, model: Model, text: str = "text", out: str = "difference") -> DataFrame:
    """Add the normalised difference of compressed sizes to every row."""
    common.ship_package(docs.sparkSession)
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out])
    at = kept.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = shared.value.compressors()
        for batch in batches:
            found = [difference(t, compressors) for t in column_bytes(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))


def dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; pieces too few or too alike to train from serve as they are."""
    if not pieces:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY_BYTES]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method with a slight penalty on the slope, in units of the spread of ``x``."""
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    z = np.stack([(x - mean) / spread, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    penalty = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def train(labelled: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id") -> Model:
    """Fit on rows of ``text`` and ``label`` (1 good, 0 bad): half of the ids make the dictionaries, half the curve."""
    rows = labelled.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label"),
        F.xxhash64(F.col(key).cast("string")).alias("h"),
    ).filter("label in (0, 1)")
    halves = F.pmod(F.col("h"), F.lit(2))
    bytes_ = F.encode("text", "UTF-8")
    piece = rows.filter(halves == 0).withColumn("bytes", bytes_).filter("octet_length(bytes) > 0").select(
        "label", "h", "bytes",
        F.explode(F.sequence(F.lit(0), F.floor((F.octet_length("bytes") - 1) / PIECE).cast("int"))).alias("k"),
    )
    chosen = piece.select(
        "label", F.substring("bytes", F.col("k") * PIECE + 1, F.lit(PIECE)).alias("piece"), F.xxhash64("h", "k").alias("o")
    )
    made = [
        dictionary([bytes(r["piece"]) for r in chosen.filter(F.col("label") == k).orderBy("o", "piece").limit(SAMPLE_PIECES).collect()])
        for k in (1, 0)
    ]
    model = Model(*made)
    if not all(made):
        good, n = rows.agg(F.sum("label"), F.count("label")).first()
        share = (good + 0.5) / (n + 1) if n else 0.5
        model.offset = float(np.log(share / (1 - share)))
        return model
    held = rows.filter(halves == 1).orderBy(F.xxhash64("h"), "text").limit(CALIBRATION_ROWS)
    points = differences(held, model).select("difference", "label").collect()
    y = np.array([p["label"] for p in points], dtype=float)
    if 0 < y.sum() < len(y):
        model.slope, model.offset = logistic(np.array([p["difference"] for p in points]), y)
    return model


def sampled_labels(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labels (doc_id, label) of each class, by hash of the id."""
    order = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    good, bad = (labels.filter(F.col("label") == k).orderBy(*order).limit(rows) for k in (1, 0))
    return good.unionByName(bad)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    found = differences(docs.drop(out), model, text, "difference")
    curve = 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.col("difference") * model.slope + model.offset))))
    return found.withColumn(out, curve)


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.id_remainder("doc_id", 5) == 0
    labels = common.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # at most 2 * SAMPLE_ROWS rows of two numbers
    learn = docs.join(F.broadcast(sampled_labels(labels.filter(~held_out))), "doc_id")
    scored = score(docs, train(learn))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
