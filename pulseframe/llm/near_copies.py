"""Clusters of near copies for packing, by banded min-hashes taken in the scan that counts tokens.

A text's words are its runs of a-z (A-Z made small), digits and everything beyond ASCII; its set is that of its five-word shingles.
``BANDS`` hashes, each of ``ROWS`` min-hashes, bring texts of similar sets together: at a similarity of 0.8 all bands fail
with probability (1 - 0.8 ** 4) ** 12, about 0.002. Two texts of a band link if sizes and parity bitmaps allow a similarity of 0.8; clusters are the
components of these links, whatever the size of a band. First every text meets one representative of each of its bands, another one in each band. Bands whose
texts then lie in one cluster need nothing more; in the others all texts of different clusters meet, in blocks of ``BLOCK`` texts against
``BLOCK``, which pass on no more rows than joining their clusters takes. Texts with equal words are one node from the start. Only hashes, sizes and
bitmaps of 256 bytes are shuffled, once a different text and once an open band; a text of an open band of b blocks goes to b tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, graph
from .textnum import Words, column_bytes, mixed, slices

WIDTH, NUM, DEN = 5, 80, 100
BANDS, ROWS = 12, 4
BITS = 2048
#: Texts of a block; what a task holds are two of them.
BLOCK = 2048
_CHUNK = 1 << 14
_FACTORS = np.random.default_rng(41).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
#: A-Z to a-z, all other ASCII but letters and digits to blanks.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """One hash for each band; the band's number is part of it."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), _CHUNK):
        least = np.minimum(least, (shingles[k : k + _CHUNK, None] * _FACTORS).min(axis=0))
    rows = mixed(least).reshape(BANDS, ROWS) * _FACTORS[:ROWS]
    return mixed(rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def parity(shingles: np.ndarray) -> np.ndarray:
    """Parity of the elements at each of ``BITS`` places, as numbers of 64 bits."""
    place = (mixed(shingles) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=BITS) & 1).astype(bool)).view(np.int64)


SCANNED = "same bigint, n_tokens bigint, n bigint, bands array<bigint>, parity array<bigint>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column_bytes(batch.column(0))
        tokens = [len(t.split()) for t in texts]
        same, n, bands, bits = [], [], [], []
        for a, b in slices(texts):
            plain = [b" ".join(t.translate(_PLAIN).split()) for t in texts[a:b]]
            same += [xxhash.xxh64_intdigest(t) - (1 << 63) for t in plain]
            for own in Words(plain, lower=False).shingle_sets(WIDTH):
                n.append(len(own))
                bands.append(band_hashes(own).view(np.int64) if len(own) else [])
                bits.append(parity(own) if len(own) else [])
        columns = [pa.array(same, pa.int64()), pa.array([t + 1 if t else 0 for t in tokens], pa.int64()), pa.array(n, pa.int64())]
        columns += [pa.array(x, pa.list_(pa.int64())) for x in (bands, bits)]
        yield pa.RecordBatch.from_arrays([*columns, *batch.columns[1:]], names=["same", "n_tokens", "n", "bands", "parity", *batch.schema.names[1:]])


def scanned(rows: DataFrame, more: str) -> DataFrame:
    """Columns of ``SCANNED`` for the first column, a text; the others, ``more`` in DDL, stay. Tokens: words and one end mark."""
    common.ship_package(rows.sparkSession)
    return rows.mapInArrow(_scanned, f"{SCANNED}, {more}")


def _near(x: str, y: str) -> Column:
    """Whether sizes and bitmaps allow a similarity of 0.8.

    Bitmaps never differ in more places than sets do. Where many differences fall on the same places, they differ in about as many as
    that number of differences leaves, and three deviations more let nearly all of these pass.
    """
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = a + b - 2 * F.ceil((a + b) * NUM / F.lit(NUM + DEN))
    usual = (BITS / 2) * (1 - F.exp(-2.0 * differ / BITS))
    apart = F.aggregate(F.zip_with(f"{x}.parity", f"{y}.parity", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    return (F.least(a, b) * DEN >= F.greatest(a, b) * NUM) & (apart <= differ) & (apart <= usual + 3 * F.sqrt(usual * (1 - usual / BITS)))


def _met(bits: np.ndarray, n: np.ndarray, root: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` in a different class that ``_near`` links with row ``i``."""
    others = others[root[others] != root[i]]
    total = n[others] + n[i]
    differ = total - 2 * -(-total * NUM // (NUM + DEN))
    usual = (BITS / 2) * (1 - np.exp(-2.0 * differ / BITS))
    apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
    sized = np.minimum(n[others], n[i]) * DEN >= np.maximum(n[others], n[i]) * NUM
    return others[sized & (apart <= differ) & (apart <= usual + 3 * np.sqrt(np.maximum(usual * (1 - usual / BITS), 0)))]


def _blocks_joined(rows: pa.Table) -> pa.Table:
    """Classes (a, b) that a link between the two sides of a band joins; a side without another meets itself."""
    band, label, n, side = (rows.column(c).to_numpy() for c in ("band", "label", "n", "side"))
    bits = rows.column("parity").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(rows), BITS // 64)
    order = np.argsort(band, kind="stable")
    found = []
    for own in np.split(order, np.flatnonzero(np.diff(band[order])) + 1):
        root = label.copy()
        left, right = own[side[own] == 0], own[side[own] == 1]
        for at, i in enumerate(left):
            for k in _met(bits, n, root, i, right if len(right) else left[at + 1 :]):
                if root[k] != root[i]:
                    found.append((root[i], root[k]))
                    root[own] = np.where(root[own] == root[k], root[i], root[own])
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _open_bands(shared: DataFrame, label: DataFrame) -> DataFrame:
    """(band, texts, same, label) of bands whose texts lie in different classes; two texts alone have met."""
    named = shared.join(label.withColumnRenamed("node", "same"), "same", "left").select("band", "same", F.coalesce("component", "same").alias("label"))
    apart = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("texts"))
    return named.join(apart.filter("low <> high and texts > 2").select("band", "texts"), "band")


def joined_classes(rest: DataFrame, sides: DataFrame) -> DataFrame:
    """(a, b): classes joined by links inside the bands of ``rest`` (band, texts, same, label).

    Bands of one block are dealt together, about a block's worth to a task; a larger band is cut into blocks, and each two of
    them meet in a task of their own.
    """
    blocks, own = F.ceil(F.col("texts") / BLOCK), F.col("own")
    deals = max(1, -(-rest.count() // BLOCK))
    placed = rest.join(sides, "same").withColumn("own", F.pmod(F.xxhash64("same"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = placed.select(
        F.when(F.col("texts") <= BLOCK, F.pmod(F.xxhash64("band"), F.lit(deals))).otherwise(F.col("band")).alias("deal"), F.least(own, "other").alias("i"),
        F.greatest(own, "other").alias("j"), (own > F.col("other")).cast("int").alias("side"), "band", "label", "n", "parity",
    )
    return dealt.groupBy("deal", "i", "j").applyInArrow(_blocks_joined, "a bigint, b bigint")


def clusters(found: DataFrame) -> DataFrame:
    """(same, component) of the texts of ``found`` (same, n, bands, parity) that have near copies with other words."""
    nodes = found.filter("n > 0").groupBy("same").agg(F.struct(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity")).alias("t"))
    nodes = common.written(nodes.select("same", "t.*"), "texts")
    banded = nodes.select("same", F.explode("bands").alias("band"))
    # another order in each band: what one representative does not reach, the next one may
    order = F.xxhash64("same", "band")
    leads = banded.groupBy("band").agg(F.min_by("same", order).alias("lead"), F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts")
    shared = common.written(banded.join(leads, "band"), "bands")
    met = common.written(shared.filter("same <> lead").select(F.col("same").alias("a"), F.col("lead").alias("b")).distinct(), "met")
    sides = nodes.select("same", "n", "parity")
    pairs = met.join(sides.alias("x"), F.col("a") == F.col("x.same")).join(sides.alias("y"), F.col("b") == F.col("y.same"))
    links = pairs.filter(_near("x", "y")).select("a", "b")
    label = graph.components(links, "near-copies")
    rest = common.written(_open_bands(shared, label), "open-bands")
    joined = graph.components(common.written(joined_classes(rest, sides), "joined"), "joined-copies")
    # a class that is joined takes the new name; a text without a link so far is a class of its own
    renamed = label.join(joined.select(F.col("node").alias("component"), F.col("component").alias("new")), "component", "left")
    alone = joined.join(label, "node", "left_anti")
    every = renamed.select("node", F.coalesce("new", "component").alias("component")).unionByName(alone)
    return every.select(F.col("node").alias("same"), "component")
