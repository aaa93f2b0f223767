"""Benchmark decontamination with a generalised suffix automaton over the normalised items.

Training text streams through the automaton one word at a time; the state and the length of the longest match that
ends at each word say which item windows end there. A window is ``WINDOW`` consecutive item words; an item with fewer
words, but not none, is one window. Words under a window are hit. A document whose hit words reach ``COVERAGE`` of its
words is contaminated; from the others the operator cuts the hit spans.

Items are dealt by hash into blocks whose total size is bounded (``BLOCK_BYTES``; one item is never split), an
automaton is built for each block inside the tasks, and documents pass through the blocks one after another, so any
number of items works and no document is shuffled.

Defined results: null and wordless texts have no words, no hits, and are clean; null and wordless items never occur;
equal item texts under several ids all count; rows repeating an item id count once; a null item id counts as the
empty text; repeated documents are judged each for itself. Columns of documents that clash with outputs are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .textnum import column_bytes

WINDOW = 13
#: Contaminated: 20 times the hit words reach the number of words.
COVERAGE = 20
BLOCK_BYTES = 8 << 20
#: A word, once A-Z are lower case: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Automaton:
    """States are ``length``, suffix ``link`` and ``next`` (word number to state); state 0 is the empty match."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        split = [(name, [self.number.setdefault(w, len(self.number)) for w in WORD.findall(text.lower())]) for name, text in items]
        for _, words in split:
            last = 0
            for w in words:
                last = self._extended(last, w)
        n = len(self.length)
        order = sorted(range(1, n), key=self.length.__getitem__)
        # the state that holds the suffix of exactly ``window`` words of a state's matches
        self.full = [-1] * n
        for s in order:
            if self.length[s] >= window:
                self.full[s] = s if self.length[self.link[s]] < window else self.full[self.link[s]]
        self.items: dict[int, set[str]] = {}
        short: dict[int, dict[int, set[str]]] = {}
        for name, words in split:
            s = 0
            for k, w in enumerate(words):
                s = self.next[s][w]
                if k + 1 >= window:
                    self.items.setdefault(self.full[s], set()).add(name)
            if 0 < len(words) < window:
                while self.length[self.link[s]] >= len(words):
                    s = self.link[s]
                short.setdefault(s, {}).setdefault(len(words), set()).add(name)
        # short items that end with a state's matches: (words needed, ids), shortest first
        self.short: list[tuple] = [()] * n
        for s in order:
            above = self.short[self.link[s]]
            self.short[s] = above + tuple(sorted(short[s].items())) if s in short else above

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """Where ``q`` also stands for longer matches, a state of its own for the match of ``p`` and ``w``."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extended(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        s, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = s
            p = self.link[p]
        if p >= 0:
            self.link[s] = self._split(p, w, self.next[p][w])
        return s

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [begin, end) word spans under item windows, and the ids of the items."""
        number, length, link, following, full, short, window = self.number, self.length, self.link, self.next, self.full, self.short, self.window
        found: set[str] = set()
        spans: list[tuple[int, int]] = []
        s = match = 0
        for at, w in enumerate(map(number.get, words)):
            if w is None:
                s = match = 0
                continue
            while s and w not in following[s]:
                s = link[s]
                match = length[s]
            if w not in following[s]:
                continue
            s = following[s][w]
            match += 1
            reach = 0
            if match >= window:
                reach = window
                found |= self.items[full[s]]
            for need, names in short[s]:
                if need <= match:
                    reach = max(reach, need)
                    found |= names
            if reach:
                begin = at + 1 - reach
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at + 1))
        return spans, found


@lru_cache(maxsize=2)
def _built(items: tuple[tuple[str, bytes], ...], window: int) -> Automaton:
    return Automaton(list(items), window)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
MADE = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _pass(docs: DataFrame, items: list[tuple[str, bytes]], text: str, window: int) -> DataFrame:
    """One block of items: adds its spans and item ids to those a row already has."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(items))
    names = docs.columns
    at = names.index(text)
    earlier = (names.index("spans"), names.index("items")) if "spans" in names else None
    kept = [k for k, c in enumerate(names) if c not in {f.name for f in MADE}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(shared.value, window)
        for batch in batches:
            counts, spans, ids = [], [], []
            for words in map(WORD.findall, map(bytes.lower, column_bytes(batch.column(at)))):
                mine, found = automaton.spans(words)
                counts.append(len(words))
                spans.append(mine)
                ids.append(found)
            if earlier:
                old = zip(batch.column(earlier[0]).to_pylist(), batch.column(earlier[1]).to_pylist(), strict=True)
                for k, (before, known) in enumerate(old):
                    spans[k] = merged(spans[k] + [(x["begin"], x["end"]) for x in before])
                    ids[k] = ids[k] | set(known)
            made = [
                pa.array(counts, pa.int64()),
                pa.array([[{"begin": a, "end": b} for a, b in x] for x in spans], _ARROW_SPANS),
                pa.array([sorted(x) for x in ids], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *made], names=[*(names[k] for k in kept), *(f.name for f in MADE)])

    return docs.mapInArrow(run, T.StructType([*(docs.schema.fields[k] for k in kept), *MADE]))


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``spans`` (hit word ranges), ``items`` (ids as text, sorted) and ``contaminated``."""
    common.ship_package(docs.sparkSession)
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")
    ).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    docs = docs.drop(*[f.name for f in MADE], "n_hit", "contaminated")
    for k in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        docs = _pass(docs, sorted((r["id"], r["text"].encode()) for r in own.collect()), text, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["begin"])
    return docs.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (COVERAGE * F.col("n_hit") >= F.col("n_words"))
    )


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` and what stands between them."""
    raw = text.encode()
    place = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : place[a][0]])
        at = place[b - 1][1]
    out.append(raw[at:])
    return b"".join(out).decode()


def cut(found: DataFrame, text: str = "text") -> DataFrame:
    """Rewrite the text of rows with spans; other rows pass without Python."""
    at = found.columns.index(text)
    spans_at = found.columns.index("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist(), strict=True)
            new = pa.array([cut_text(t, [(x["begin"], x["end"]) for x in s]) for t, s in pairs], batch.schema.field(at).type)
            yield batch.set_column(at, text, new)

    hit = F.size("spans") > 0
    return found.filter(~hit).unionByName(found.filter(hit).mapInArrow(run, found.schema))


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: contaminated documents go, the others lose the spans that items share with them.

    The hits are written once: finding them is the dear part, and both branches of ``cut`` read them.
    """
    found = find(docs, benchmark).filter(~F.col("contaminated"))
    return cut(common.written(found, "decontaminated")).select(*docs.columns)


_LOWER_FROM, _LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_LOWER_FROM}', '{_LOWER_TO}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id, {_SQL_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT id, least(len(w), {WINDOW}) AS size, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS phrase
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS row, doc_id, {_SQL_WORDS} AS w FROM documents
), place AS (
  SELECT row, size, i, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT row, p.size, i, id FROM place p JOIN windows v ON p.size = v.size AND p.phrase = v.phrase
), hits AS (
  SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS word FROM found) GROUP BY row
), ids AS (
  SELECT row, count(DISTINCT id) AS n_items, array_to_string(list_sort(list(DISTINCT id)), ',') AS joined FROM found GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {COVERAGE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (row) LEFT JOIN ids USING (row)
"""
