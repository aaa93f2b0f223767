"""Best-fit packing of documents into sequences under conflicts.

A sequence ("bin") holds at most ``capacity`` tokens and never two pieces of one source or of one duplicate cluster.
Documents are taken longest first. Bins stand in order of their residual space; the search begins at the tightest
residual that is large enough and goes on to the next larger one until a bin is found whose source and cluster bitmaps
have neither of the document's bits, else a new bin is opened. Longer documents are cut: full stretches fill bins
of their own, the rest is packed.

Rows are dealt by hash of the id and text into packs of about ``PACK_ROWS``; each pack is packed for itself, so the
work for a row does not grow with the input, and a source that owns a third of all rows owns a third of every pack.
The packs shuffle only ids, lengths and hashes, never texts. Duplicate clusters are classes of near copies (``near_copies``):
documents linked, directly or by others, by five-word shingles at a similarity of 0.8 or more of their lower-case letters and
digits; so exact copies share a cluster, whatever their marks and case. The verdict for a row depends on the rows of its pack only.
A bin's id is its pack in the high bits and its number in the low ``_PACK_SHIFT``, which no pack outgrows.

Defined results: null, empty and wordless texts have no tokens: one row without a bin. A null source conflicts with
nothing, a null or single cluster neither. Equal lengths follow the id, then the text's hash. Repeated rows are pieces
of their own and, being copies, go to different bins. Other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, near_copies

CAPACITY = 4096
PACK_ROWS = 4096
_PACK_SHIFT = 40


class Bins:
    """Open bins in order of residual, with bitmaps of sources and clusters, 64 to a word."""

    def __init__(self, capacity: int, sources: int, clusters: int, most: int):
        self.capacity = capacity
        self.residual = np.zeros(most, dtype=np.int64)  # sorted
        self.order = np.zeros(most, dtype=np.int64)  # bin at that place
        self.source = np.zeros((most, -(-max(1, sources) // 64)), dtype=np.uint64)
        self.cluster = np.zeros((most, -(-max(1, clusters) // 64)), dtype=np.uint64)
        self.n = 0

    def _successor(self, length: int, source: int, cluster: int) -> int:
        """Place of the tightest compatible bin, or -1; the search looks at runs of bins that double."""
        at, run = int(np.searchsorted(self.residual[: self.n], length)), 16
        while at < self.n:
            some = self.order[at : min(self.n, at + run)]
            free = np.ones(len(some), dtype=bool)
            if source >= 0:
                free &= (self.source[some, source >> 6] >> np.uint64(source & 63)) & np.uint64(1) == 0
            if cluster >= 0:
                free &= (self.cluster[some, cluster >> 6] >> np.uint64(cluster & 63)) & np.uint64(1) == 0
            if free.any():
                return at + int(np.argmax(free))
            at, run = at + len(some), run * 2
        return -1

    def put(self, length: int, source: int, cluster: int) -> int:
        place = self._successor(length, source, cluster)
        if place < 0:
            which, left = self.n, self.capacity - length
            end = self.n
            self.n += 1
        else:
            which, left = int(self.order[place]), int(self.residual[place]) - length
            self.residual[place : self.n - 1] = self.residual[place + 1 : self.n]
            self.order[place : self.n - 1] = self.order[place + 1 : self.n]
            end = self.n - 1
        # ties of residual keep the order in which bins reached it
        to = int(np.searchsorted(self.residual[:end], left, side="right"))
        self.residual[to + 1 : end + 1] = self.residual[to:end].copy()
        self.order[to + 1 : end + 1] = self.order[to:end].copy()
        self.residual[to], self.order[to] = left, which
        if source >= 0:
            self.source[which, source >> 6] |= np.uint64(1 << (source & 63))
        if cluster >= 0:
            self.cluster[which, cluster >> 6] |= np.uint64(1 << (cluster & 63))
        return which


def codes(values: pd.Series, single: bool) -> tuple[np.ndarray, int]:
    """Numbers of the distinct values; null, and with ``single`` a value that occurs once, is -1."""
    if single:
        values = values.where(values.duplicated(keep=False))
    found, names = pd.factorize(values)
    return found, len(names)


def packed(rows: pd.DataFrame, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in the bin of each row, in the order of ``rows`` (sorted longest first)."""
    source, n_source = codes(rows["source"], False)
    cluster, n_cluster = codes(rows["cluster"], True)
    bins = Bins(capacity, n_source, n_cluster, len(rows))
    which = np.array([bins.put(*x) for x in zip(rows["n_tokens"].tolist(), source.tolist(), cluster.tolist(), strict=True)], dtype=np.int64)
    return which, pd.Series(which).groupby(which).cumcount().to_numpy()


SCHEMA = "doc_id bigint, piece int, begin long, n_tokens long, bin_id long, place int"


def pack(rows: DataFrame, capacity: int = CAPACITY, pack_rows: int = PACK_ROWS) -> DataFrame:
    """Pack rows (doc_id, source, cluster, n_tokens, key) where ``key`` is a hash that deals and breaks ties."""
    common.ship_package(rows.sparkSession)
    n = rows.count()
    packs = max(1, -(-n // pack_rows))
    full = F.floor(F.col("n_tokens") / capacity).cast("int")
    rest = F.col("n_tokens") - full * capacity
    dealt = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "cluster", "key",
        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), F.pmod("key", F.lit(packs)).alias("pack"),
    ).select(
        "doc_id", F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source"), "cluster", "key", "pack",
        full.alias("piece"), (full * capacity).cast("long").alias("begin"), rest.cast("long").alias("n_tokens"),
    )

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_tokens", "doc_id", "key"], ascending=[False, True, True], na_position="last", kind="stable")
        base = int(key[0]) << _PACK_SHIFT
        open_ = part[part["n_tokens"] > 0]
        which, place = packed(open_, capacity)
        out = open_[["doc_id", "piece", "begin", "n_tokens"]].assign(bin_id=which + base, place=place)
        none = part[(part["n_tokens"] == 0) & (part["piece"] == 0)]
        long = part[part["piece"] > 0]
        at = np.repeat(np.arange(len(long)), long["piece"])
        piece = np.arange(len(at)) - np.repeat(np.cumsum(long["piece"].to_numpy()) - long["piece"].to_numpy(), long["piece"])
        first = base + (int(which.max()) + 1 if len(which) else 0)
        if first + len(at) > base + (1 << _PACK_SHIFT):
            raise ValueError("a pack has more bins than their numbers have room for")
        whole = pd.DataFrame(
            {"doc_id": long["doc_id"].array[at] if len(long) else long["doc_id"].array, "piece": piece, "begin": piece * capacity, "n_tokens": capacity, "bin_id": first + np.arange(len(at)), "place": 0}
        )
        empty = none[["doc_id", "piece", "begin", "n_tokens"]].assign(bin_id=None, place=None)
        parts = [x.astype({"doc_id": "Int64", "piece": "Int32", "begin": "Int64", "n_tokens": "Int64", "bin_id": "Int64", "place": "Int32"}) for x in (out, whole, empty)]
        return pd.concat(parts, ignore_index=True)

    return dealt.groupBy("pack").applyInPandas(run, SCHEMA)


def documents_to_pack(docs: DataFrame) -> DataFrame:
    """Rows for ``pack``; a text without letters and digits is in a cluster with its like only."""
    text = F.col("text").cast("string")
    wanted = docs.select(text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("doc_id", "text").alias("key"))
    rows = common.written(near_copies.scanned(wanted, "doc_id bigint, source string, key bigint"), "to-pack")
    near = near_copies.clusters(rows)
    return rows.select("doc_id", "source", "key", "n_tokens", "same").join(near, "same", "left").select(
        "doc_id", "source", F.coalesce("component", "same").alias("cluster"), "n_tokens", "key"
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Lengths, hashes and clusters are taken from whole texts once and written; counting and packing read those."""
    return pack(common.written(documents_to_pack(docs), "clustered"), capacity)


def query(spark, sf_dir):
    return pack_documents(common.table(spark, sf_dir, "documents"))
