"""Jaccard join on word shingles: grouped prefix join, returning classes of documents joined by links.

Two documents link when ``den * |A & B| >= num * |A | B|`` for their shingle sets. Steps:

1. Count shingles over all documents in a sketch of fixed size. It only ranks shingles from rare to common, so that
   prefixes hold rare ones; any error in it costs time, not results.
2. Each document gives its set's size, a 128-bit signature and its prefix: the first ``n - ceil(t n) + 1`` shingles in
   rank order. Two sets that link share a prefix shingle.
3. Documents of one signature are one node; nodes of one prefix and size are one group. Only groups enter the join.
4. Group pairs that share a prefix shingle pass the size and position filters; then groups are expanded and the
   nodes' texts verified exactly.

Only classes are wanted, so no bucket of a shingle is expanded into all its pairs at first: each bucket's members meet
its pivot (the node of the group with most copies), and only what is then still in different classes is compared:
pairs in buckets of up to ``SMALL`` members, and blocks of members against blocks in larger ones, where blocks that
already lie in one class are skipped. A pair reaches verification only if parity bitmaps allow it: each set has
``BITS`` bits, each the parity of the elements that hash there, so two bitmaps differ in no more places than the sets
do; sets beyond ``WIDE_FROM`` elements fill these and have a wide one as well. A block passes on, for each class, the
closest pairs that both bitmaps allow, so it makes no more rows than a few for each class in it; while it holds some back,
another round with the classes joined so far asks for more. Two nodes of many large buckets count in the first one that both
list. This is exact: every pair of a bucket is in one class, or verified, or ruled out by a bound, or met in another bucket.

Defined results: null, empty and blank texts have no shingle, link with nothing and are a class of their own; a text
of fewer words than a shingle is one shingle. Rows that repeat an id are separate documents, whose class is the least
id in reach; a null id is never the least unless there is no other. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, graph
from .textnum import Words, column_bytes, mixed, slices

#: Cells of the shingle sketch and values of one chunk of it.
CELLS, _CHUNK = 1 << 20, 1 << 16
#: Members of a bucket up to which its remaining pairs are listed; larger buckets are compared in blocks.
SMALL = 48
BLOCK = 2048
#: Pairs of a class that a block passes on in the first round; each further round takes 8 times as many.
FIRST = 4
#: Pairs that a block holds before it lets all but the closest of each class go.
HELD = 1 << 18
#: Large buckets of a node that travel with it; two nodes that share several meet in the first of these.
LISTED = 16
#: Bits of the parity bitmap, and of the wide one that sets beyond ``WIDE_FROM`` elements have besides.
BITS, WIDE_BITS, WIDE_FROM = 512, 8192, 1024
#: Up to so many keys (16 bytes each) go to the texts by broadcast, counted first; more are joined by a shuffle.
BROADCAST_KEYS = 50_000


class Rule:
    """Shingle width and threshold as a fraction."""

    def __init__(self, width: int, num: int, den: int):
        self.width, self.num, self.den = width, num, den

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def links(self, both: int, a: int, b: int) -> bool:
        return self.den * both >= self.num * (a + b - both)

    def size_filter(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * self.den >= F.greatest(a, b) * self.num

    def overlap(self, a: Column, b: Column) -> Column:
        """Least intersection of two linked sets of these sizes."""
        return F.ceil((a + b) * self.num / F.lit(self.num + self.den))

    def differs(self, a: Column, b: Column) -> Column:
        """Most elements by which two linked sets of these sizes differ."""
        return a + b - 2 * self.overlap(a, b)

    def may_link(self, x: str, y: str) -> Column:
        """Size and position filter for aliases ``x`` and ``y``, which meet at their prefix places ``at``."""
        a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
        most = F.least(a - F.col(f"{x}.at"), b - F.col(f"{y}.at"))
        return self.size_filter(a, b) & (most >= self.overlap(a, b))


def _sketched(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS)
        for batch in batches:
            texts = column_bytes(batch.column(0))
            for a, b in slices(texts):
                sets = Words(texts[a:b], lower=True).shingle_sets(rule.width)
                total += np.bincount((np.concatenate(sets) >> _CELL_SHIFT).astype(np.int64), minlength=CELLS)
        chunks = common.array_chunks(total, _CHUNK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in chunks], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(chunks), pa.int32()),
                pa.array([x for _, x in chunks], pa.binary()),
            ],
            names=["key", "salt", "data"],
        )

    return run


_CELL_SHIFT = np.uint64(64 - CELLS.bit_length() + 1)


def rarity(docs: DataFrame, rule: Rule) -> np.ndarray:
    """For each cell of shingle hashes a rank from 0 to 31 by its count.

    Up to six deviations above the median a rank is half a deviation wide, so that cells below it, which hold no frequent
    shingle, come first; beyond, ranks go in powers of two. Shingles of few documents stand out only in such narrow ranks.
    """
    sums = common.summed_arrays(docs.select("text").mapInArrow(_sketched(rule), "key int, salt int, data binary"))
    if not sums:
        return np.zeros(CELLS, dtype=np.uint8)
    count = np.concatenate([sums[k] for k in sorted(sums)])
    usual = np.median(count)
    apart = (count - usual) / np.sqrt(usual + 1)
    narrow, broad = np.floor(2 * apart) + 8, 20 + np.log2(np.maximum(apart / 6, 1))
    return np.clip(np.where(apart < 6, narrow, broad), 0, 31).astype(np.uint8)


_PRINT_FIELDS = "n bigint, s1 bigint, s2 bigint, prefix array<bigint>, parity binary, wide array<bigint>"


def parity_bits(elements: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the elements at each of ``bits`` places, as bytes."""
    place = (mixed(elements) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(bool))
_SIGN = np.random.default_rng(77).integers(1, 2**63, 2, dtype=np.uint64) | np.uint64(1)


def _printed(rule: Rule, rank: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column_bytes(batch.column(1))
        n, s1, s2, prefixes, parity, wide = [], [], [], [], [], []
        for a, b in slices(texts):
            for own in Words(texts[a:b], lower=True).shingle_sets(rule.width):
                n.append(len(own))
                s1.append(mixed(own * _SIGN[0]).sum(dtype=np.uint64))
                s2.append(mixed(own ^ _SIGN[1]).sum(dtype=np.uint64))
                size = rule.prefix(len(own)) if len(own) else 0
                key = (rank[(own >> _CELL_SHIFT).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (own >> np.uint64(6))
                if size < len(key):
                    key = np.partition(key, size - 1)[:size]
                prefixes.append(np.sort(key))
                parity.append(parity_bits(own, BITS).tobytes())
                wide.append(parity_bits(own, WIDE_BITS).view(np.int64) if len(own) > WIDE_FROM else None)
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
        flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2), pa.array(n, pa.int64()),
                *(pa.array(np.array(s, dtype=np.uint64).view(np.int64)) for s in (s1, s2)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(parity, pa.binary()),
                pa.array(wide, pa.list_(pa.int64())),
            ],
            names=["doc_id", "row_key", "n", "s1", "s2", "prefix", "parity", "wide"],
        )


def fingerprints(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document: id, key of the row's content, set size, signature, prefix. Written once."""
    common.ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs, rule))  # CELLS numbers, whatever the input
    printed = docs.select("doc_id", "text", "row_key").mapInArrow(
        lambda batches: _printed(rule, shared.value, batches), f"doc_id bigint, row_key bigint, {_PRINT_FIELDS}"
    )
    return common.written(printed, "fingerprints")


def prepared(docs: DataFrame) -> DataFrame:
    """Id, text and a key of both, by which later passes find a row again."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("row_key"),
    )


def _verified(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, frozenset] = {}
    for batch in batches:
        left, right = [], []
        for k in range(batch.num_rows):  # one pair at a time: two long texts are enough to hold
            a, b, x, y = (c[k].as_py() for c in batch.columns)
            if x not in known:
                known = {x: shingles(x, rule.width)}
            one, two = known[x], shingles(y, rule.width)
            if rule.links(len(one & two), len(one), len(two)):
                left.append(a)
                right.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def shingles(text: str, width: int) -> frozenset:
    """The exact shingle set of a text, words and all."""
    words = text.encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[j:] for j in range(width)), strict=False))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of nodes whose texts link. ``a`` is the side that recurs: its set is kept while it does."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    keys = common.written(wanted.join(nodes.select("node", "row_key"), "node"), "keys")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    texts = common.written(
        docs.select("row_key", "text").join(side, "row_key").dropDuplicates(["node"]).select("node", "text"), "texts"
    )
    first = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = first.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(lambda batches: _verified(rule, batches), "a bigint, b bigint")


def parity_words(nodes: DataFrame, *more: str) -> DataFrame:
    """(node, p0, p1, ...): the parity bitmaps as numbers."""
    return nodes.select(
        "node", *more, *[F.conv(F.hex(F.substring("parity", 8 * k + 1, 8)), 16, -10).cast("long").alias(f"p{k}") for k in range(BITS // 64)]
    )


def places_apart(x: str, y: str) -> Column:
    """In how many places the bitmaps of aliases ``x`` and ``y`` differ."""
    return sum((F.bit_count(F.col(f"{x}.p{k}").bitwiseXOR(F.col(f"{y}.p{k}"))) for k in range(BITS // 64)), F.lit(0))


def near_enough(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b, more) whose parity bitmaps differ in no more places than linked sets may."""
    bits = parity_words(nodes, "n")
    met = pairs.alias("p").join(bits.alias("x"), F.col("p.a") == F.col("x.node")).join(bits.alias("y"), F.col("p.b") == F.col("y.node"))
    passed = met.filter(places_apart("x", "y") <= rule.differs(F.col("x.n"), F.col("y.n"))).select(
        "a", "b", "more", F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")
    )
    # large sets fill the bitmap; the few pairs of them that are left meet by the wide one
    large = nodes.filter(F.col("wide").isNotNull()).select("node", "wide")
    both = passed.join(large.select(F.col("node").alias("b"), F.col("wide").alias("w_b")), "b", "left").join(
        large.select(F.col("node").alias("a"), F.col("wide").alias("w_a")), "a", "left"
    )
    wide = F.aggregate(F.zip_with("w_a", "w_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    out = F.coalesce(wide > rule.differs(F.col("n_a"), F.col("n_b")), F.lit(False))
    return both.filter(~out).select("a", "b", "more")


def _closest(found: list[np.ndarray], most: int) -> tuple[np.ndarray, bool]:
    """The rows (p, q, apart, a, b) among the ``most`` closest of one of their classes p and q, and whether there were others."""
    rows = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 5), dtype=np.int64)
    rows = rows[np.argsort(rows[:, 2], kind="stable")]
    ends = np.concatenate((rows[:, 0], rows[:, 1]))
    row = np.tile(np.arange(len(rows)), 2)
    order = np.lexsort((row, ends))
    first = np.flatnonzero(np.diff(ends[order], prepend=ends[order][:1] - 1))
    place = np.arange(len(ends)) - np.repeat(first, np.diff(np.append(first, len(ends))))
    kept = np.zeros(len(rows), dtype=bool)
    kept[row[order][place < most]] = True
    return rows[kept], not kept.all()


def _listed(rows: pa.Table) -> np.ndarray:
    """The numbers of the large buckets that each row lists, in lines of ``LISTED``; places left are below any number."""
    lists = rows.column("listed").combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    found = np.full((len(rows), LISTED), np.iinfo(np.int64).min)
    found[np.arange(LISTED) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return found


def _blocks_compared(rule: Rule, most: int):
    """Pairs of two blocks that may link and lie in different classes: the ``most`` closest of each class.

    ``more`` tells that some were held back. Both bitmaps are tested before pairs are ranked, so no row that is passed on,
    and with it ``more``, falls to ``near_enough``. Pairs that both list a bucket of a lesser number are left to that one.
    """

    def run(rows: pa.Table) -> pa.Table:
        bits = np.frombuffer(b"".join(column_bytes(rows.column("parity").combine_chunks())), dtype=np.uint64).reshape(len(rows), BITS // 64)
        large = rows.column("wide").is_valid().to_numpy()
        at_wide = np.cumsum(large) - 1
        wide = rows.column("wide").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, WIDE_BITS // 64).view(np.uint64)
        n, label, node, side = (rows.column(c).to_numpy() for c in ("n", "label", "node", "side"))
        listed, number = _listed(rows), rows.column("number")[0].as_py()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):
            right = left
        found, held, bound, more = [], 0, HELD, False
        for i in left:
            apart = np.bitwise_count(bits[right] ^ bits[i]).sum(axis=1, dtype=np.int64)
            total = n[right] + n[i]
            limit = total - 2 * -(-rule.num * total // (rule.num + rule.den))
            sized = rule.den * np.minimum(n[right], n[i]) >= rule.num * np.maximum(n[right], n[i])
            near = np.flatnonzero(sized & (apart <= limit) & (label[right] != label[i]))
            if large[i] and len(near):
                both = near[large[right[near]]]
                far = np.bitwise_count(wide[at_wide[right[both]]] ^ wide[at_wide[i]]).sum(axis=1, dtype=np.int64) > limit[both]
                near = np.setdiff1d(near, both[far], assume_unique=True)
            if len(near):
                before = listed[i][listed[i] > np.iinfo(np.int64).min]
                before = before if number is None else before[before < number]
                near = near[~np.isin(listed[right[near]], before).any(axis=1)]
            if len(near):
                k = right[near]
                first = label[i] < label[k]
                p, q = np.minimum(label[i], label[k]), np.maximum(label[i], label[k])
                found.append(np.column_stack((p, q, apart[near], np.where(first, node[i], node[k]), np.where(first, node[k], node[i]))))
                held += len(near)
            if held > bound:
                kept, left_out = _closest(found, most)
                found, held, more = [kept], len(kept), more or left_out
                bound = max(HELD, 2 * held)
        out, left_out = _closest(found, most)
        token = pa.array(rows.column("token")[:1].to_pylist() * len(out), pa.string())
        return pa.table({"token": token, "a": pa.array(out[:, 3]), "b": pa.array(out[:, 4]), "more": pa.array([more or left_out] * len(out), pa.bool_())})

    return run


def large_bucket_pairs(rest: DataFrame, nodes: DataFrame, rule: Rule, most: int) -> DataFrame:
    """(token, a, b, more) across classes inside large buckets (``rest``: token, node, label of their members).

    Members of a class with a block's worth in the bucket stand in blocks of that class alone, the others in shared
    ones; two blocks of one same class never meet. Each node lists its ``LISTED`` buckets of least number; groups have none.
    """
    number = F.expr("try_cast(token as bigint)")
    listed = rest.groupBy("node").agg(F.slice(F.sort_array(F.collect_set(number)), 1, LISTED).alias("listed"))
    sizes = rest.groupBy("token", "label").agg(F.count(F.lit(1)).alias("members"))
    shared = sizes.filter(F.col("members") < BLOCK).groupBy("token").agg(F.ceil(F.sum("members") / BLOCK).cast("int").alias("shared"))
    large = F.col("members") >= BLOCK
    own = F.concat_ws(":", F.lit("own"), "label", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)).cast("string"))
    among = F.concat_ws(":", F.lit("shared"), F.pmod(F.xxhash64("label"), F.col("shared")).cast("string"))
    placed = rest.join(sizes, ["token", "label"]).join(shared, "token", "left").select(
        "token", "node", "label", F.when(large, own).otherwise(among).alias("block"), F.when(large, F.col("label")).alias("only")
    )
    placed = placed.withColumn("number", number).join(listed, "node").join(nodes.select("node", "n", "parity", "wide"), "node")
    placed = common.written(placed, "blocks")
    blocks = placed.select("token", "block", "only").distinct()
    x, y = blocks.alias("x"), blocks.alias("y")
    meet = x.join(y, F.col("x.token") == F.col("y.token")).filter(
        (F.col("x.block") <= F.col("y.block")) & ~F.coalesce(F.col("x.only") == F.col("y.only"), F.lit(False))
    ).select(F.col("x.token").alias("token"), F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    sides = meet.select("token", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionByName(
        meet.filter("i <> j").select("token", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side"))
    )
    dealt = sides.join(placed, ["token", "block"]).select("token", "i", "j", "side", "node", "label", "n", "parity", "wide", "number", "listed")
    return dealt.groupBy("token", "i", "j").applyInArrow(_blocks_compared(rule, most), "token string, a bigint, b bigint, more boolean")


def bucketed(prints: DataFrame, leads: DataFrame, group: list[str]) -> DataFrame:
    """(token, node, n, at): the leads of groups that share a prefix shingle with another group."""
    prefixes = prints.filter("n > 0").groupBy(*group).agg(F.first("prefix").alias("prefix")).join(leads.select(*group, "node"), group)
    # size and place travel in one number: these rows are the widest shuffle of the join
    tokens = prefixes.select("node", "n", F.posexplode("prefix").alias("at", "token")).select(
        "token", "node", F.shiftleft("n", 31).bitwiseOR(F.col("at").cast("long")).alias("place")
    )
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("token")
    return common.written(tokens.join(shared, "token"), "buckets").select(
        "token", "node", F.shiftright("place", 31).alias("n"), F.col("place").bitwiseAND(F.lit((1 << 31) - 1)).alias("at")
    )


def still_open(buckets: DataFrame, known: DataFrame) -> DataFrame:
    """(token, lead, at, size) of buckets, and of groups, whose members are in different classes, and that hold more than two.

    ``known`` (lead, node, n, label) has every node. The least and greatest label of each group tell which buckets are open,
    before any group is expanded; two nodes alone have met already.
    """
    ranges = common.written(known.groupBy("lead").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members")), "ranges")
    open_ = buckets.join(ranges, "lead").groupBy("token").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("members").alias("size")
    ).filter("low <> high and size > 2").select("token", "size")
    return buckets.select("token", "lead", "at").join(open_, "token")


def apart(open_: DataFrame, known: DataFrame) -> DataFrame:
    """(token, node, label, n, at, size): the members of open buckets. Groups are expanded here: every member is where its lead is."""
    return common.written(open_.join(known, "lead").select("token", "node", "label", "n", "at", "size"), "rest")


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, row_key, n, component, component_id) for every row of ``docs`` (doc_id, text)."""
    docs = prepared(docs)
    prints = fingerprints(docs, rule).withColumns({"g1": F.xxhash64("prefix"), "g2": F.xxhash64(F.lit("again"), "prefix")})
    signature, group = ["n", "s1", "s2"], ["n", "g1", "g2"]
    nodes = common.written(
        prints.filter("n > 0").groupBy(*signature, "g1", "g2")
        .agg(F.min("doc_id").alias("least"), F.min("row_key").alias("row_key"), F.count(F.lit(1)).alias("copies"), F.first("parity").alias("parity"), F.first("wide").alias("wide"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    # groups: equal prefix and size; the member with most copies leads
    weight = F.struct("copies", (-F.col("node")).alias("first"), F.col("node").alias("node"))
    leads = common.written(
        nodes.groupBy(*group).agg(F.max(weight).alias("lead")).select(*group, F.col("lead.node").alias("node"), F.col("lead.copies").alias("copies")),
        "leads",
    )
    members = nodes.select(*group, "node").join(leads.select(*group, F.col("node").alias("lead")), group).select("lead", "node", "n")
    inside = members.filter("lead <> node").select(F.col("lead").alias("a"), F.col("node").alias("b"))

    buckets = bucketed(prints, leads, group)
    best = F.max(F.struct("copies", (-F.col("node")).alias("first"), "node", "n", "at")).alias("p")
    pivots = buckets.join(leads.select("node", "copies"), "node").groupBy("token").agg(best).select(
        "token", F.col("p.node").alias("node"), F.col("p.n").alias("n"), F.col("p.at").alias("at")
    )
    to_pivot = pivots.alias("x").join(buckets.alias("y"), F.col("x.token") == F.col("y.token")).filter(
        (F.col("x.node") != F.col("y.node")) & rule.may_link("x", "y")
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    # the pivots recur on the left, so their sets are built once for a run of rows
    tried = common.written(near_enough(inside.unionByName(to_pivot).distinct().withColumn("more", F.lit(False)), nodes, rule).drop("more"), "pairs")
    links = common.written(verified(tried, nodes, docs, rule), "links")
    label, renamed = graph.components(links), None

    def labelled(rows: DataFrame) -> DataFrame:
        """``rows`` (node and others) with the class each node is in so far."""
        named = rows.join(label, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        return named if renamed is None else named.join(renamed, "label", "left").withColumn("label", F.coalesce("new", "label")).drop("new")

    # a group is a bucket as well; its name cannot be a shingle's, whose two highest bits are a rank's
    met = buckets.select(F.col("token").cast("string").alias("token"), F.col("node").alias("lead"), "at")
    grouped = leads.select(F.concat(F.lit("g"), F.col("node")).alias("token"), F.col("node").alias("lead"), F.lit(0).cast("long").alias("at"))
    open_, within = met.unionByName(grouped), members
    most = FIRST
    while True:
        known_at = common.written(labelled(within).select("lead", "node", "n", "label"), "known")
        # classes only grow, so what is closed stays closed, and only members of open buckets are looked at again
        open_ = common.written(still_open(open_, known_at), "open")
        within = known_at.select("lead", "node", "n").join(open_.select("lead").distinct(), "lead", "left_semi")
        rest = apart(open_, known_at)
        # the bitmaps are part of the join's condition: what they rule out is never a row
        few = rest.filter(F.col("size") <= SMALL).join(parity_words(nodes), "node")
        pairs = few.alias("x").join(few.alias("y"), F.col("x.token") == F.col("y.token")).filter(
            (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & rule.may_link("x", "y")
            & (places_apart("x", "y") <= rule.differs(F.col("x.n"), F.col("y.n")))
        ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().withColumn("more", F.lit(False))
        near = near_enough(pairs, nodes, rule) if most == FIRST else None
        many = rest.filter(F.col("size") > SMALL).select("token", "node", "label")
        held = None
        if not many.isEmpty():
            passed = common.written(large_bucket_pairs(many, nodes, rule, most), "passed")  # by both bitmaps
            held = passed.filter("more").select("token").distinct()
            passed = passed.select("a", "b", "more")
            near = passed if near is None else near.unionByName(passed)
        if near is None:
            break
        ordered = near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("more").alias("more"))
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(True).alias("known")).distinct()
        listed = common.written(ordered.join(known, ["a", "b"], "left"), "pairs")
        untried = listed.filter("known is null").select("a", "b")
        if not untried.isEmpty():
            found = common.written(verified(untried, nodes, docs, rule), "links")
            # the new links join classes, and only these get other names
            one = labelled(found.withColumnRenamed("a", "node")).select(F.col("label").alias("a"), F.col("b").alias("node"))
            joined = graph.components(labelled(one).select("a", F.col("label").alias("b")))
            changed = joined.select(F.col("node").alias("label"), F.col("component").alias("new"))
            if renamed is not None:
                earlier = renamed.join(joined, F.col("new") == F.col("node"), "left").select("label", F.coalesce("component", "new").alias("new"))
                changed = earlier.unionByName(changed).distinct()
            renamed = common.written(changed, "renamed")
            tried = tried.unionByName(untried)
        if held is None or held.isEmpty():
            break
        # all pairs of the other buckets are in one class, tried or ruled out: only those that held some back go on
        open_, most = open_.join(held, "token", "left_semi"), most * 8

    component = labelled(nodes.select(*signature, "node", "least")).withColumnRenamed("label", "component")
    least = component.groupBy("component").agg(F.min("least").alias("component_id"))
    named = component.join(least, "component").select(*signature, "component", "component_id")
    linked = prints.filter("n > 0").select("doc_id", "row_key", *signature).join(named, signature)
    single = prints.filter("n = 0").select(
        "doc_id", "row_key", "n", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id")
    )
    return linked.select("doc_id", "row_key", "n", "component", "component_id").unionByName(single)


CONTRACT = Rule(3, 90, 100)
#: Near duplicates in the pipeline: five words, similarity 0.8.
NEAR = Rule(5, 80, 100)


def query(spark, sf_dir):
    found = classes(common.table(spark, sf_dir, "documents").select("doc_id", "text"), CONTRACT)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, rule: Rule = NEAR) -> DataFrame:
    """Pipeline stage: of each class one row stays, the one with the least id; documents without words all stay."""
    rows = docs.withColumn("row_key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    found = common.written(classes(docs, rule), "classes").filter("n > 0")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first"))
    keys = first.select(F.col("first.row_key").alias("row_key"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x09-\x0D ]"), F.lit(False))
    # a row given twice has one key: one of it stays
    kept = rows.filter(worded).join(keys, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.select(*docs.columns).unionByName(docs.filter(~worded))


SQL = """
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT r, doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT r, doc_id, count(*) AS n FROM s GROUP BY ALL
), common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS overlap FROM s x JOIN s y ON x.s = y.s AND x.r < y.r GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * overlap >= 90 * (x.n + y.n - overlap)
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT DISTINCT a AS r, a AS q FROM edge UNION SELECT reach.r, edge.b FROM reach JOIN edge ON reach.q = edge.a
), least AS (
  SELECT reach.r, min(n.doc_id) AS component_id FROM reach JOIN n ON n.r = reach.q GROUP BY reach.r
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (r) LEFT JOIN least USING (r)
"""
