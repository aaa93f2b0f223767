"""Prefix trie of conversations from vertical bitmaps.

Index: (position, turn) -> bitset of the conversations that have this turn at this position. A node's children are the
intersections of its bitset with the postings of the next position; a depth-first walk gives every node with its popcount,
its members and the list of those that end there.

Conversations are dealt into shards of ``1 << SHARD_BITS`` consecutive ids, so a bitset has a fixed width, and positions into slabs
of ``SLAB``; one (shard, slab) is one group, whose size is bounded whatever the input. A node's id is the exclusive or of
128-bit hashes of its (position, turn) pairs, so that a slab knows the ids of its first nodes from sums over the slabs
before, and shards agree on ids. What shards found is then added up by id. Texts never leave the first scan: from there on
a turn is a 128-bit digest and its number of words.

Subtree sums need no walk over the merged tree: a node belongs to its smallest member, the nodes of one member are a run of
depths, and below a node lie exactly the runs of its members from that depth on. So a member's total goes to all
nodes above its run, and inside the run a sum from below is enough.

Defined results: turns follow ``turn`` (null first), equal turn numbers the SHA-256 of role and text; repeated rows are
turns of their own; null role and text are empty; rows without a conversation id belong to no conversation; an empty
table has no nodes. Other columns are not used. Rows of one conversation within ``SLICE`` turn numbers are numbered in one
sort, and the ids that end at one node pass through one task as a stream, since a digest is taken in order.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARD_BITS = 10
SLAB = 64
SLICE = 1024
#: A parent with more than this share of all nodes as children is joined by broadcast; there can be no more than its inverse.
HOT_PARENT = 1000
_NODE = ["depth", "e1", "e2"]


def turn_key(role: Column, text: Column) -> Column:
    """First 16 bytes of the SHA-256 of role and text; the role's length keeps them apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos from 1, key, words): original turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), turn_key(role, text).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).withColumn("slice", F.floor(F.col("turn") / SLICE))
    inside = Window.partitionBy("conv", "slice").orderBy(F.asc_nulls_first("turn"), "key")
    placed = common.written(rows.withColumn("at", F.row_number().over(inside)), "turns")
    before = Window.partitionBy("conv").orderBy(F.asc_nulls_first("slice")).rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("conv", "slice").agg(F.max("at").cast("long").alias("size")).select(
        F.col("conv").alias("c"), F.col("slice").alias("s"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    return placed.join(offset, F.col("conv").eqNullSafe(F.col("c")) & F.col("slice").eqNullSafe(F.col("s"))).select(
        "conv", (F.col("at") + F.col("offset")).alias("pos"), "key", "words"
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c takes its first h turns from conversation c - c % 20; h is crc32(c) % 4.

    Gives (conv, length) of all conversations, and (conv, length, pos, key, words) of their turns.
    """
    head = F.when(F.col("pos") <= 3, F.struct("pos", "key", "words"))
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(head)).alias("heads"))
    sizes = common.written(sizes, "conversations")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(4)).cast("int")
    heads = sizes.select(F.col("conv").alias("base"), F.col("heads").alias("base_heads"))
    own = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % 20).alias("base"))
    # slice of a null array is null: where the base is absent, nothing is borrowed
    borrowed = F.coalesce(F.slice("base_heads", F.lit(1), F.col("h")), F.array().cast(heads.schema["base_heads"].dataType))
    known = own.join(heads, "base", "left").select("conv", "n", "h", borrowed.alias("borrowed"))
    known = common.written(
        known.select("conv", "h", "borrowed", (F.size("borrowed") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("length")), "rebuilt"
    )
    first = known.select("conv", "length", F.inline("borrowed"))
    rest = turns.join(known.select("conv", "length", "h", F.size("borrowed").alias("k")), "conv").filter("pos > h").select(
        "conv", "length", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "key", "words"
    )
    return known.select("conv", "length"), first.unionByName(rest)


def members(bits: int) -> list[int]:
    """Places of the bits that are set, ascending."""
    if bits.bit_count() < 16:
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out
    raw = np.frombuffer(bits.to_bytes((1 << SHARD_BITS) // 8, "little"), dtype=np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


class Postings:
    """Vertical index of one slab of one shard: bitset of every (position, turn), turn of every (position, conversation)."""

    def __init__(self):
        self.bits: dict[int, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        self.turn: dict[int, dict[int, bytes]] = defaultdict(dict)
        self.present: dict[int, int] = defaultdict(int)
        self.told: dict[tuple[int, bytes], tuple[int, int, int]] = {}

    def add(self, place: int, pos: int, key: bytes, words: int, e1: int, e2: int) -> None:
        self.bits[pos][key] |= 1 << place
        self.turn[pos][place] = key
        self.present[pos] |= 1 << place
        self.told[pos, key] = words, e1, e2

    def children(self, parent: int, pos: int) -> Iterator[tuple[int, bytes]]:
        """Intersections of the parent's bitset with the postings of ``pos`` that are not empty."""
        left = parent & self.present.get(pos, 0)
        while left:
            key = self.turn[pos][(left & -left).bit_length() - 1]
            child = parent & self.bits[pos][key]
            yield child, key
            left &= ~child


_PARTIAL = (
    "depth bigint, e1 bigint, e2 bigint, p1 bigint, p2 bigint, n bigint, least bigint, words bigint, shard bigint, "
    "members array<smallint>, ends string"
)


def _walked(depths: int, table: pa.Table) -> pa.Table:
    """Nodes of one (shard, slab of ``depths``): rows without a key are conversations at the slab's begin, the others turns."""
    index, starts, ended = Postings(), defaultdict(int), defaultdict(int)
    columns = [table.column(c).to_pylist() for c in ("conv", "pos", "key", "words", "e1", "e2", "length")]
    shard, slab = table.column("shard")[0].as_py(), table.column("slab")[0].as_py()
    mask = (1 << SHARD_BITS) - 1
    for conv, pos, key, words, e1, e2, length in zip(*columns, strict=True):
        if key is None:
            starts[e1, e2] |= 1 << (conv & mask)
            ended[length] |= 1 << (conv & mask)
        else:
            index.add(conv & mask, pos, key, words, e1, e2)
    out: dict[str, list] = {c.split()[0]: [] for c in _PARTIAL.split(", ")}
    first, base = slab * depths, shard << SHARD_BITS
    stack = [(bits, first, e1, e2, None, None, 0) for (e1, e2), bits in starts.items()]
    while stack:
        bits, depth, e1, e2, p1, p2, words = stack.pop()
        if depth > first or slab == 0:  # the begin of a later slab is a node of the slab before
            inside = members(bits)
            over = bits & ended.get(depth, 0)
            ends = ",".join(str(base + k) for k in members(over)) if over else None
            for name, value in zip(out, (depth, e1, e2, p1, p2, len(inside), base + inside[0], words, shard, inside, ends), strict=True):
                out[name].append(value)
        if depth < first + depths:
            for child, key in index.children(bits, depth + 1):
                words, x1, x2 = index.told[depth + 1, key]
                stack.append((child, depth + 1, e1 ^ x1, e2 ^ x2, e1, e2, words))
    types = {"members": pa.list_(pa.int16()), "ends": pa.string()}
    return pa.table({name: pa.array(values, types.get(name, pa.int64())) for name, values in out.items()})


def shard_nodes(known: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes as each shard sees them; ``known`` (conv, length), ``turns`` (conv, length, pos, key, words)."""
    common.ship_package(known.sparkSession)
    hashed = turns.select(
        "conv", "length", "pos", "key", "words", F.floor((F.col("pos") - 1) / SLAB).alias("slab"),
        F.xxhash64("pos", "key").alias("e1"), F.xxhash64(F.lit("again"), "key", "pos").alias("e2"),
    )
    # ids at the begin of later slabs: exclusive or over the slabs before
    long = F.col("length") > SLAB
    before = Window.partitionBy("conv").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.filter(long).groupBy("conv", "slab").agg(F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"), F.first("length").alias("length"))
    later = sums.select("conv", "slab", F.bit_xor("e1").over(before).alias("e1"), F.bit_xor("e2").over(before).alias("e2"), "length").filter("slab > 0")
    zero = F.lit(0).cast("long")
    begins = known.select("conv", zero.alias("slab"), zero.alias("e1"), zero.alias("e2"), "length").unionByName(later).select(
        "conv", "length", (F.col("slab") * SLAB).alias("pos"), F.lit(None).cast("binary").alias("key"), zero.alias("words"), "slab", "e1", "e2"
    )
    rows = begins.unionByName(hashed).withColumn("shard", F.shiftright("conv", SHARD_BITS))
    depths = SLAB
    return common.written(rows.groupBy("shard", "slab").applyInArrow(lambda table: _walked(depths, table), _PARTIAL), "shard-nodes")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists, joined by commas; rows come sorted by node and shard."""
    now, state = None, None

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(_NODE, now, strict=True), ends_sha256=state.hexdigest())], _DIGESTS)

    for batch in batches:
        for depth, e1, e2, ends in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if now != (depth, e1, e2):
                if now is not None:
                    yield row()
                now, state = (depth, e1, e2), hashlib.sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
    if now is not None:
        yield row()


_DIGESTS = pa.schema([("depth", pa.int64()), ("e1", pa.int64()), ("e2", pa.int64()), ("ends_sha256", pa.string())])


def trie(known: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    found = shard_nodes(known, turns)
    nodes = common.written(
        found.groupBy(*_NODE).agg(
            F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("words").alias("words")
        ),
        "nodes",
    )
    lists = found.filter("ends is not null").select(*_NODE, "ends", "shard").repartition(*_NODE).sortWithinPartitions(*_NODE, "shard")
    digests = lists.mapInArrow(_digested, "depth bigint, e1 bigint, e2 bigint, ends_sha256 string")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("e1"), F.col("p2").alias("e2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    tree = nodes.join(children, _NODE, "left").join(digests, _NODE, "left").select(
        *_NODE, "p1", "p2", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    tree = common.written(
        tree.select(
            *_NODE, "p1", "p2", "conv_id", "n_convs", "n_children", "ends_sha256", F.sum("leaf").over(up).alias("leaves"), F.sum("saved").over(up).alias("saved"),
            F.min("depth").over(Window.partitionBy("conv_id")).alias("top"),
        ),
        "tree",
    )
    # what a run adds to every node above it
    runs = tree.filter("depth = top").select(F.col("conv_id").alias("conv"), "top", "leaves", "saved")
    paths = found.select(*_NODE, "shard", F.explode("members").alias("m")).select(*_NODE, (F.shiftleft("shard", SHARD_BITS) + F.col("m")).alias("conv"))
    above = paths.join(runs, "conv").filter("depth < top").groupBy(*_NODE).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    parents = _parents(tree)
    no = F.lit(0).cast("long")
    full = tree.join(above, _NODE, "left").join(parents, _NODE, "left")
    return full.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", no)).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", no)).alias("saved_tokens"), "ends_sha256",
    )


def _parents(tree: DataFrame) -> DataFrame:
    """(depth, e1, e2, parent) for the first node of each run; inside a run the parent has the same conversation."""
    tops = tree.filter("depth = top and depth > 0").select(*_NODE, (F.col("depth") - 1).alias("pd"), "p1", "p2")
    named = tree.filter("n_children > 0").select(F.col("depth").alias("pd"), F.col("e1").alias("p1"), F.col("e2").alias("p2"), F.col("conv_id").alias("parent"), "n_children")
    hot = F.col("n_children") * HOT_PARENT > tree.count()
    key = ["pd", "p1", "p2"]
    wide = F.broadcast(named.filter(hot))  # at most HOT_PARENT rows: the children of all nodes are no more than the nodes
    both = tops.join(wide, key).unionByName(tops.join(wide, key, "left_anti").join(named.filter(~hot), key))
    return both.select(*_NODE, "parent")


def query(spark, sf_dir):
    turns = common.written(numbered_turns(common.table(spark, sf_dir, "conversations")), "numbered")
    return trie(*rebuilt_turns(turns))


#: crc32 byte by byte and bit by bit; the polynomial is a fixed value.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"
)

SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), k AS (
  SELECT conv_id, turn, sha256(length(role) || ':' || role || text) AS key, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM t
), o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos, key, words FROM k
), c AS (
  SELECT conv_id, {_CRC} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM o)
), r AS (
  SELECT c.conv_id, 0 AS part, o.pos, key, words FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, key, words FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h
), s AS (
  SELECT conv_id, list(key ORDER BY part, pos) AS keys, list(words ORDER BY part, pos) AS words FROM r GROUP BY conv_id
), p AS (
  SELECT c.conv_id, unnest(range(0, coalesce(len(keys), 0) + 1)) AS depth, coalesce(len(keys), 0) AS length, keys, words FROM c LEFT JOIN s USING (conv_id)
), m AS (
  SELECT conv_id, depth, length, CASE WHEN depth = 0 THEN '' ELSE sha256(array_to_string(keys[1:depth], ',')) END AS node,
    CASE WHEN depth = 0 THEN 0 ELSE words[depth] END AS words
  FROM p
), n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    count(*) FILTER (length > depth) = 0 AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL
), sub AS (
  SELECT m.node, m.depth, count(*) FILTER (n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens,
    count(*) FILTER (n.depth = m.depth + 1) AS n_children
  FROM m JOIN n ON n.conv_id = m.conv_id AND n.depth >= m.depth GROUP BY ALL
), up AS (
  SELECT DISTINCT a.node, a.depth, b.node AS parent FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, sub.n_children, sub.n_leaves,
  sub.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN sub USING (node, depth) LEFT JOIN up USING (node, depth) LEFT JOIN n q ON q.node = up.parent AND q.depth = n.depth - 1
"""
