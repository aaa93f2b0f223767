"""Hard-negative mining with an inverted multi-index.

Vectors are cut into two halves; each half has a codebook of ``CODES`` centroids, and a pair of codes is a cell. For an anchor,
no vector of a half-code scores more than ``anchor . centroid + |anchor| * radius`` in that half, so the sum of two half
bounds limits a cell. Cells are visited by a multi-sequence heap: both lists of half-codes are sorted by their bounds,
and the heap yields pairs by falling sum without forming all of them first. A search stops where the bound falls below what
it still needs: the worst of the positives found, or, for each window of negative scores, the larger of its low end and
the worst of the negatives found in it. Cells that lie wholly above all windows, or whose own radii rule them out, are passed over. So
the result is certified: it is that of a full search.

Jobs: codebooks are fitted on ``SAMPLE`` vectors chosen by hash (a bounded sample; every vector is indexed, and a poor codebook
costs time, not results). One scan gives each vector its cell; counts and radii of the at most ``CODES ** 2`` cells are
broadcast. Each search has two visits: the first cells until ``SEED`` vectors are seen give the worst score to beat, then all
cells that may beat it. A visit is one cogroup of (cell, piece, block): a piece has about ``PIECE`` vectors of a cell, a
block about ``BLOCK`` anchors, so no group grows with the input, whatever share of vectors a cell holds; from each only the
best few rows of an anchor leave.

Defined results: rows with a null id, label or vector or a component that is null or not finite take no part; nor do vectors
without components, of another length than most have (of equally many: the shortest), or with a component beyond 2**28 after
scaling, as their scores are not defined or fit no long. Rows that repeat an id are rows of their own, but no positives of an anchor of that id; an
anchor given twice alike counts once. Other columns are not used. An anchor without positives, and a positive whose window
is empty, give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CODES = 16
SAMPLE = 4096
SEED = 512
PIECE = 4096
BLOCK = 4096
CHUNK = 128
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 30, 90
_LARGEST = 1 << 28


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, labels and components as the contract changes them."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"))
    wide = F.exists("v", lambda x: x.isNull() | F.isnan(x) | ~(F.abs(x.cast("double") * 256) <= _LARGEST))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & ~wide)
    usual = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.join(F.broadcast(usual), F.size("v") == F.col("size"), "left_semi").select(
        "vec_id", label.alias("label"), F.transform("v", lambda x: F.floor(x.cast("double") * 256).cast("int")).alias("vector")
    )


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """List column to rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 0)


def codebook(rows: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Centroids by Lloyd's iterations from rows drawn with a fixed seed."""
    some = np.unique(rows, axis=0)
    centres = some[np.random.default_rng(5).permutation(len(some))[:codes]].astype(np.float64)
    for _ in range(rounds):
        nearest = assigned(rows, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        count = np.bincount(nearest, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def assigned(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row and the distance to it."""
    nearest = np.argmin((centres**2).sum(1) - 2 * rows @ centres.T, axis=1)
    return nearest, np.sqrt(((rows - centres[nearest]) ** 2).sum(1))


class Cells:
    """Centroids of both halves, and count and radii of the cells that occur."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], stats: dict[int, tuple[int, float, float]]):
        self.books, self.stats = books, stats
        self.radius = [np.full(len(b), -np.inf) for b in books]
        for cell, (_, *radii) in stats.items():
            for half, code in enumerate(divmod(cell, CODES)):
                self.radius[half][code] = max(self.radius[half][code], radii[half])

    def halves(self, anchor: np.ndarray) -> tuple[list[np.ndarray], list[float]]:
        """Products with the centroids, and length, of both halves of an anchor."""
        cut = len(anchor) // 2
        both = anchor[:cut], anchor[cut:]
        return [b @ x for b, x in zip(self.books, both, strict=True)], [float(np.sqrt((x**2).sum())) for x in both]

    def visited(self, anchor: np.ndarray) -> Iterator[tuple[float, float, float, int, int]]:
        """(bound of this and all later cells, own upper, own lower bound, cell, vectors in it), by falling bound."""
        dots, norms = self.halves(anchor)
        slack = 1.0 + 1e-9 * float((anchor**2).sum())
        order, sums = [], []
        for half in (0, 1):
            bound = dots[half] + norms[half] * self.radius[half]
            keep = np.argsort(-bound, kind="stable")
            keep = keep[np.isfinite(bound[keep])]
            order.append(keep.tolist())
            sums.append(bound[keep].tolist())
        if not order[0]:
            return
        heap, seen = [(-(sums[0][0] + sums[1][0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            for step in ((i + 1, j), (i, j + 1)):
                if step not in seen and step[0] < len(order[0]) and step[1] < len(order[1]):
                    seen.add(step)
                    heapq.heappush(heap, (-(sums[0][step[0]] + sums[1][step[1]]), *step))
            a, b = order[0][i], order[1][j]
            found = self.stats.get(a * CODES + b)
            if found:
                n, r1, r2 = found
                middle, reach = dots[0][a] + dots[1][b], norms[0] * r1 + norms[1] * r2 + slack
                yield -bound + slack, middle + reach, middle - reach, a * CODES + b, n


def index(rows: DataFrame) -> tuple[DataFrame, Cells]:
    """Every vector with its cell (vec_id, label, vector, cell, piece), written, and the cells."""
    spark = rows.sparkSession
    common.ship_package(spark)
    sample = rows.select("vector", F.xxhash64("vec_id", "vector").alias("h")).orderBy("h").limit(SAMPLE).select("vector").toArrow()
    known = matrix(sample.column("vector"))
    cut = known.shape[1] // 2
    books = (codebook(known[:, :cut], CODES), codebook(known[:, cut:], CODES)) if len(known) else (np.zeros((0, 0)), np.zeros((0, 0)))
    shared = spark.sparkContext.broadcast(books)  # 2 * CODES centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = shared.value
        for batch in batches:
            x = matrix(batch.column(2))
            if len(x):
                (a, d1), (b, d2) = assigned(x[:, :cut], one), assigned(x[:, cut:], two)
                added = [pa.array(a * CODES + b, pa.int32()), pa.array(d1), pa.array(d2)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["vec_id", "label", "vector", "cell", "d1", "d2"])

    placed = common.written(rows.mapInArrow(run, "vec_id bigint, label bigint, vector array<int>, cell int, d1 double, d2 double"), "cells")
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect()
    return placed, Cells(books, {r.cell: (r.n, r.d1, r.d2) for r in stats})


#: What a search wants of an anchor: scores of rows of its own label or of others, from ``least`` to ``most`` in each window.
_WANTED = "cell int, anchor bigint, vec_id bigint, label bigint, vector array<int>, least array<bigint>, most array<bigint>"
_NONE = -(1 << 62)


def _planned(cells: Cells, seed: bool):
    """Cells to visit for anchors (anchor, vec_id, label, vector, least, most): the first ones, or all others needed.

    ``least`` has, for each window, the score below which nothing more is needed; ``most`` its upper end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cell = [], []
            x = matrix(batch.column(3))
            for k in range(batch.num_rows):
                # the low ends without what the first visit found decide which cells the first visit had
                least, low, most = (batch.column(c)[k].as_py() for c in (4, 5, 6))
                if not most:
                    continue
                seen, stop, top = 0, min(least), max(most)
                for bound, upper, lower, name, n in cells.visited(x[k]):
                    if bound < (min(low) if seed else stop):
                        break
                    if lower > top or upper < min(low):
                        continue
                    first = seen < SEED
                    seen += n
                    needed = any(upper >= a and lower <= b for a, b in zip(least, most, strict=True))
                    if first if seed else not first and needed:
                        at.append(k)
                        cell.append(name)
                    if seed and seen >= SEED:
                        break
            take = pa.array(at, pa.int64())
            columns = [batch.column(c).take(take) for c in (0, 1, 2, 3, 4, 6)]
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *columns], names=[f.split()[0] for f in _WANTED.split(", ")])

    return run


def _scored(same: bool, best: int):
    """The ``best`` rows of each (anchor, window) of one piece of a cell; ``CHUNK`` anchors at a time."""

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        v = matrix(rows.column("vector"), np.int64)
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        for begin in range(0, wanted.num_rows if rows.num_rows else 0, CHUNK):
            some = wanted.slice(begin, CHUNK)
            q = matrix(some.column("vector"), np.int64)
            largest = int(np.abs(v).max()) * int(np.abs(q).max()) * v.shape[1]
            # below 2**53 products of floats are exact, and much faster
            scores = (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64) if largest < 1 << 53 else q @ v.T
            anchor, own, theirs = (some.column(c).to_numpy() for c in ("anchor", "vec_id", "label"))
            fits = labels[None, :] == theirs[:, None]
            fits = fits & (ids[None, :] != own[:, None]) if same else ~fits
            least, most = some.column("least").to_pylist(), some.column("most").to_pylist()
            for w in range(max(map(len, most))):
                low = np.array([x[w] if w < len(x) else 1 for x in least], dtype=np.int64)
                high = np.array([x[w] if w < len(x) else 0 for x in most], dtype=np.int64)
                i, j = np.nonzero(fits & (scores >= low[:, None]) & (scores <= high[:, None]))
                order = np.lexsort((ids[j], -scores[i, j], i))
                i, j = i[order], j[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[place < best], j[place < best]
                out.append((anchor[i], np.full(len(i), w), ids[j], scores[i, j]))
        columns = [np.concatenate(c) if out else np.zeros(0, dtype=np.int64) for c in (zip(*out, strict=True) if out else [()] * 4)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "window", "vec_id", "score"), columns, strict=True)})

    return run


class Search:
    """Best rows of anchors (anchor, vec_id, label, vector, low, most), in windows of scores given by arrays."""

    def __init__(self, placed: DataFrame, cells: Cells, same: bool, best: int, anchors: int):
        self.cells, self.same, self.best = cells, same, best
        self.blocks = max(1, -(-anchors // BLOCK))
        pieces = {c: -(-n // PIECE) for c, (n, *_) in cells.stats.items()}
        self.pieces = placed.sparkSession.createDataFrame(list(pieces.items()) or [(0, 1)], "cell int, pieces int")  # CODES ** 2 rows at most
        self.placed = placed

    def visit(self, anchors: DataFrame, seed: bool) -> DataFrame:
        """(anchor, window, vec_id, score) of the cells that the heap gives."""
        count = F.broadcast(self.pieces)
        wanted = anchors.select("anchor", "vec_id", "label", "vector", "least", "low", "most").mapInArrow(_planned(self.cells, seed), _WANTED)
        wanted = wanted.join(count, "cell").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
        wanted = wanted.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(self.blocks)).cast("int"))
        rows = self.placed.join(count, "cell").select(
            "cell", F.pmod(F.xxhash64("vec_id", "vector"), F.col("pieces")).cast("int").alias("piece"), "vec_id", "label", "vector",
            F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("block"),
        )
        key = ["cell", "piece", "block"]
        found = rows.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(_scored(self.same, self.best), "anchor bigint, window bigint, vec_id bigint, score bigint")
        return self.top(found)

    def top(self, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.best)

    def run(self, anchors: DataFrame) -> DataFrame:
        """(anchor, window, vec_id, score, rank) of the ``best`` rows of each window."""
        seeds = common.written(self.visit(anchors.withColumn("least", F.col("low")), True), "seeds")
        # a window that is full needs nothing below its worst score; equal scores may still win by id
        floors = seeds.filter(F.col("rank") == self.best).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floor"))
        least = F.transform("low", lambda x, k: F.greatest(x, F.coalesce(F.element_at("floor", k.cast("long")), x)))
        rest = anchors.join(floors, "anchor", "left").withColumn("least", F.when(F.col("floor").isNull(), F.col("low")).otherwise(least)).drop("floor")
        return self.top(seeds.drop("rank").unionByName(self.visit(rest, False).drop("rank")))


def mine(embeddings: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """For each anchor (an id divisible by ``every``) and each of its positives the hardest negatives inside the window."""
    placed, cells = index(common.written(vectors(embeddings), "vectors"))
    anchors = placed.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "vector").distinct()
    anchors = common.written(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    n = anchors.count()
    limit = F.lit(1 << 62)
    whole = anchors.withColumns({"low": F.array(F.lit(_NONE)), "most": F.array(limit)})
    good = common.written(Search(placed, cells, True, positives, n).run(whole).select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # positives of one score share a window
    score = F.array_sort(F.collect_set("positive_score"))
    windows = good.filter("positive_score >= 0").groupBy("anchor").agg(score.alias("scores"))
    low = F.transform("scores", lambda s: F.ceil(s * F.lit(LOW).cast("decimal(20,0)") / 100).cast("long"))
    most = F.transform("scores", lambda s: F.floor(s * F.lit(HIGH).cast("decimal(20,0)") / 100).cast("long"))
    ranged = common.written(anchors.join(windows, "anchor").withColumns({"low": low, "most": most}), "windows")
    bad = Search(placed, cells, False, negatives, n).run(ranged)
    named = ranged.select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("scores").alias("window", "positive_score"))
    pairs = good.join(named, ["anchor", "positive_score"])
    return pairs.withColumn("window", F.col("window").cast("long")).join(bad, ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def query(spark, sf_dir):
    return mine(common.table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, label::BIGINT AS label, list_transform(embedding, lambda x: x::DOUBLE * 256) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
), ok AS (
  SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT abs(x) <= 268435456)) = 0
), usual AS (
  SELECT len(e) AS n FROM ok GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1
), r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(e, lambda x: floor(x)) AS e
  FROM ok JOIN usual ON len(e) = n
), a AS (
  SELECT *, row_number() OVER () AS anchor FROM (SELECT DISTINCT vec_id, label, e FROM r WHERE vec_id % 100 = 0)
), s AS (
  SELECT anchor, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.e, r.e)::BIGINT AS score FROM a, r
), p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS nth
  FROM s WHERE same AND vec_id <> anchor_id QUALIFY nth <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor, positive_id, nth ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""
