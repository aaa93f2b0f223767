"""Quality rules: counts of each text and a hashed n-gram likelihood ratio between trusted and raw text.

Word 1- and 2-grams are hashed into ``CELLS`` cells. Two multinomials over the cells are estimated: one from the
trusted rows, one from every row, whatever their number. A document's score is the mean, over its n-grams, of log(trusted / raw); it is kept
when it passes the base rules and its score reaches a fixed threshold.

Defined results: null and blank texts have no words, score 0 and fail the base rules; a document without label is
judged like any other; repeated rows count each for themselves; without trusted rows both multinomials are the raw
one and every score is 0. A document labelled twice is trusted if any of its labels says so. Other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .textnum import IS_SPACE, Words, column_bytes, slices

CELLS = 1 << 17
#: Least mean log ratio of a kept document.
THRESHOLD = -0.2
#: Pseudo-counts that the raw distribution lends to the trusted one, as a share of the trusted total.
SMOOTHING = 0.01
#: Trusted ids that go to the texts in one broadcast; more go in turns, each with a pass over the texts.
BROADCAST_IDS = 1_000_000
REPEAT_WIDTH = 5
_CHUNK = 1 << 14

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True


def cells(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text index and cell of every word and every pair of neighbouring words."""
    at, pair = words.windows(2)
    shift = np.uint64(64 - CELLS.bit_length() + 1)
    return (
        np.concatenate((words.doc, words.doc[at])),
        np.concatenate(((words.hash >> shift), (pair >> shift))).astype(np.int64),
    )


def repeated_words(words: Words, width: int = REPEAT_WIDTH) -> np.ndarray:
    """Per text, the words inside windows of ``width`` words that its text holds twice or more."""
    at, value = words.windows(width)
    hit = np.zeros(len(words.hash) + 1, dtype=np.int64)
    begin = np.searchsorted(at, words.first)
    for d in np.flatnonzero(words.count > width):
        own = value[begin[d] : begin[d + 1]]
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        twice = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        start = at[begin[d] + twice]
        np.add.at(hit, start, 1)
        np.add.at(hit, start + width, -1)
    covered = np.cumsum(hit)[:-1] > 0
    return _per_text(covered, words.first)


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[first])


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def base_counts(texts: list[bytes], words: Words) -> dict[str, np.ndarray]:
    return {
        "n_words": words.count,
        "word_chars": _per_text(~IS_SPACE[words.raw] & ~_CONTINUES[words.raw], words.text_start),
        "n_symbols": _per_text(_SYMBOL[words.raw], words.text_start),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeated_words(words),
    }


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, CELLS))
    for batch in batches:
        texts, trusted = column_bytes(batch.column(0)), np.array(batch.column(1).to_pylist(), dtype=bool)
        for a, b in slices(texts):
            doc, cell = cells(Words(texts[a:b], lower=True))
            total[0] += np.bincount(cell, minlength=CELLS)
            total[1] += np.bincount(cell[trusted[a:b][doc]], minlength=CELLS)
    chunks = common.array_chunks(total, _CHUNK)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _ in chunks], pa.int32()),
            pa.array([TaskContext.get().partitionId()] * len(chunks), pa.int32()),
            pa.array([x for _, x in chunks], pa.binary()),
        ],
        names=["key", "salt", "data"],
    )


def counted(rows: DataFrame, text: str = "text", trusted: str = "trusted") -> np.ndarray:
    """Occurrences of each cell in all rows, and in those that ``trusted`` marks."""
    common.ship_package(rows.sparkSession)
    rows = rows.select(F.col(text).alias("text"), F.coalesce(F.col(trusted), F.lit(False)).alias("trusted"))
    sums = common.summed_arrays(rows.mapInArrow(_count, "key int, salt int, data binary"))
    return np.concatenate([sums[k] for k in sorted(sums)]).reshape(2, CELLS) if sums else np.zeros((2, CELLS))


def train(rows: DataFrame, text: str = "text", trusted: str = "trusted") -> np.ndarray:
    """Log ratio of each cell, from all rows: ``trusted`` marks those of the target multinomial."""
    return ratios(*counted(rows, text, trusted))


def ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each cell from its occurrences in all rows and in the trusted ones."""
    if not raw.any():
        return np.zeros(CELLS)
    p_raw = (raw + 0.5) / (raw + 0.5).sum()
    lent = SMOOTHING * max(target.sum(), 1.0)
    return np.log((target + lent * p_raw) / (target.sum() + lent)) - np.log(p_raw)


def mean_ratios(words: Words, ratio: np.ndarray) -> np.ndarray:
    doc, cell = cells(words)
    n = len(words.count)
    return np.bincount(doc, weights=ratio[cell], minlength=n) / np.maximum(np.bincount(doc, minlength=n), 1)


OUTPUT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("log_ratio", T.DoubleType()),
]


def score(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """Add the base counts, ``log_ratio``, ``base_failed`` and ``kept`` to every row; such columns are replaced."""
    common.ship_package(docs.sparkSession)
    made = {f.name for f in OUTPUT} | {"base_failed", "kept"}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made])
    at = kept.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # CELLS numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column(at))
            parts: dict[str, list] = {f.name: [] for f in OUTPUT}
            for a, b in slices(texts):
                words = Words(texts[a:b], lower=False)
                for name, values in base_counts(texts[a:b], words).items():
                    parts[name].append(values)
                parts["log_ratio"].append(mean_ratios(Words(texts[a:b], lower=True), shared.value))
            if not batch.num_rows:
                continue
            made = [pa.array(np.concatenate(parts[f.name]), pa.float64() if f.name == "log_ratio" else pa.int64()) for f in OUTPUT]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *parts])

    out = kept.mapInArrow(run, T.StructType([*kept.schema.fields, *OUTPUT]))
    out = out.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= THRESHOLD))


def train_labelled(docs: DataFrame, labels: DataFrame, most: int = BROADCAST_IDS) -> np.ndarray:
    """Log ratio of each cell, from all rows of ``docs`` and all of them whose id some label calls good.

    No text is shuffled: the ids are dealt by hash into parts of about ``most``, and each part meets the texts by
    broadcast. The first pass counts every row; the others count only the rows of their own part.
    """
    docs = docs.select("doc_id", "text")
    ids = common.written(labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct(), "trusted")
    parts = max(1, -(-ids.count() // most))
    total = np.zeros((2, CELLS))
    for k in range(parts):
        part = F.broadcast(ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == k).withColumn("trusted", F.lit(True)))
        raw, target = counted(docs.join(part, "doc_id", "inner" if k else "left"))
        total += (np.zeros(CELLS) if k else raw, target)
    return ratios(*total)


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    ratio = train_labelled(docs, common.table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), ratio).drop("text")
