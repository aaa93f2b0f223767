"""Language identification by rank-order profiles of character n-grams.

``train`` counts the n-grams (of 1 to 3 characters, words padded by a blank) of all training rows and keeps, for each
language, the most frequent ones in order. ``predict`` ranks a document's own n-grams in the same way and adds up how
far each is out of place in every profile; the language with the least distance wins.

Defined results: a null text and a text without a letter give ``und`` with score 0; a null language is not learned;
equal counts are ranked by code point order; equal distances go to the language that sorts first; without any
training row every document is ``und``; repeated rows count, and are predicted, each for itself. Other columns pass
through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

UNDETERMINED = "und"
#: Length of a profile: n-grams a language and a document are ranked by.
PROFILE_SIZE = 400
_SHIFT = np.uint64(21)
#: Characters handled at once while counting.
_PIECE = 1 << 18


@cache
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint64)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def ngram_codes(text: str) -> np.ndarray:
    """Every 1-, 2- and 3-gram of the text's words as a number: 21 bits a character, 0 for the blank at a word's ends."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.zeros(len(raw) + 2, dtype=np.uint64)
    c[1:-1] = _letters()[raw]
    letter = c != 0
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    two = (c[:-1] << _SHIFT) | c[1:]
    three = (two[:-1] << _SHIFT) | c[2:]
    # a blank is part of an n-gram only at one of its ends
    return np.concatenate(
        (c[letter], two[letter[:-1] | letter[1:]] | np.uint64(1 << 63), three[letter[1:-1]] | np.uint64(3 << 62))
    )


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    value, count = np.unique(codes, return_counts=True)
    return value[np.lexsort((value, -count))[:size]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush(lang: str) -> None:
        value, count = np.unique(ngram_codes(" ".join(held.pop(lang))), return_counts=True)
        size.pop(lang)
        if lang in total:
            old, have = total[lang]
            value, back = np.unique(np.concatenate((old, value)), return_inverse=True)
            count = np.bincount(back, weights=np.concatenate((have, count))).astype(np.int64)
        total[lang] = value, count

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= _PIECE:
                flush(lang)
    for lang in list(held):
        flush(lang)
    for lang, (value, count) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(value), pa.string()), pa.array(value.view(np.int64)), pa.array(count)],
            names=["lang", "code", "n"],
        )


def train(rows: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """Profiles from all rows with a text and a language. Fixed size: ``size`` codes for each language."""
    common.ship_package(rows.sparkSession)
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter(
        "lang is not null and text is not null"
    )
    counts = rows.mapInArrow(_counted, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(
        F.sum("n").alias("n")
    )
    # unsigned order of the codes, as ranked() uses it
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.col("code").bitwiseXOR(F.lit(-(2**63))))
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    profiles: dict[str, list] = {}
    for r in top.orderBy("lang", "rank").collect():
        profiles.setdefault(r["lang"], []).append(r["code"])
    return {k: np.array(v, dtype=np.int64).view(np.uint64) for k, v in profiles.items()}


def distances(text: str, index: tuple[np.ndarray, np.ndarray], size: int) -> tuple[np.ndarray, int] | None:
    """Sum over the document's profile of the rank differences, ``size`` for an n-gram a profile lacks."""
    codes = ngram_codes(text)
    if not len(codes):
        return None
    own = ranked(codes, size)
    known, place = index
    at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
    found = (known[at] == own) if len(known) else np.zeros(len(own), dtype=bool)
    there = np.where(found, place[:, at], -1) if len(known) else np.full((len(place), len(own)), -1)
    out = np.where(there >= 0, np.abs(there - np.arange(len(own))), size)
    return out.sum(axis=1), len(own)


def profile_index(profiles: dict[str, np.ndarray]) -> tuple[list[str], tuple[np.ndarray, np.ndarray]]:
    """Languages in order, all known codes sorted, and each code's rank in each profile (-1: absent)."""
    langs = sorted(profiles)
    known = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.zeros(0, dtype=np.uint64)
    place = np.full((len(langs), len(known)), -1, dtype=np.int64)
    for k, lang in enumerate(langs):
        place[k, np.searchsorted(known, profiles[lang])] = np.arange(len(profiles[lang]))
    return langs, (known, place)


def predict_text(text: str | None, langs: list[str], index, size: int) -> tuple[str, float]:
    found = distances(text, index, size) if text and langs else None
    if found is None:
        return UNDETERMINED, 0.0
    total, n = found
    best = int(np.argmin(total))
    return langs[best], float(1 - total[best] / (n * size))


def predict(
    docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", lang_out: str = "lang_pred",
    score_out: str = "score", size: int = PROFILE_SIZE,
) -> DataFrame:
    """Add the predicted language and a score (1: every n-gram in its place, 0: none known) to every row.

    Columns named like the outputs are replaced.
    """
    common.ship_package(docs.sparkSession)
    langs, index = profile_index(profiles)
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (lang_out, score_out)])
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict_text(x, langs, index, size) for x in batch.column(at).to_pylist()]
            arrays = [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, lang_out, score_out])

    return kept.mapInArrow(run, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: crc32 of doc_id as text modulo 4 is not 2."""
    return docs.filter(common.id_remainder("doc_id", 4) != 2)


def identify(docs: DataFrame) -> DataFrame:
    """Profiles from the training rows of ``docs``, applied to all its rows."""
    return predict(docs, train(training_rows(docs)))


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), train(training_rows(docs)))
    return found.select(
        "doc_id", (common.id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def accept(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents whose language can be told; those without any letter are rejected.

    Where no row has a language to learn from, every document with a letter stays.
    """
    profiles = train(training_rows(docs))
    if not profiles:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = predict(docs, profiles)
    return found.filter(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)
