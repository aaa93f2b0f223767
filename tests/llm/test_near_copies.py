"""Clusters of near copies against classes of exact links, and packs whose bins do not meet."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import jaccard_join, near_copies, packing


def copies(seed=5):
    """Texts with near copies: words changed, lost and added, other marks and case."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows = []
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 120, 700, 3000]))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(5)):
            other = list(words)
            for _ in range(max(1, len(words) // rng.choice([40, 100, 400]))):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(rng.choice([" ".join(other), ", ".join(other).upper(), " ".join(words) + "!"]))
    rows += [rows[0]] * 40 + [None, "", "?!", "...", "short text", "Short, text"]
    return list(enumerate(rows))


def pairs(groups):
    return {(a, b) for g in groups.values() for a in g for b in g if a < b}


def test_clusters_find_the_classes_of_exact_links(spark):
    docs = spark.createDataFrame(copies(), "doc_id long, text string").repartition(3)
    plain = F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " ")
    exact, got, words = {}, {}, {}
    for r in jaccard_join.classes(docs.select("doc_id", plain.alias("text")), jaccard_join.NEAR).filter("n > 0").collect():
        exact.setdefault(r.component, []).append(r.doc_id)
    rows = packing.documents_to_pack(docs.withColumn("source", F.lit(None).cast("string"))).collect()
    for r in rows:
        got.setdefault(r.cluster, []).append(r.doc_id)
        words[r.doc_id] = r.n_tokens
    want, found = pairs(exact), pairs(got)
    assert len(want & found) >= 0.97 * len(want) and len(want) > 900
    # bitmaps let a few texts of a similarity somewhat lower pass; each text counts once here
    texts = {t: k for k, t in reversed(copies())}
    assert len({(a, b) for a, b in found - want if {a, b} <= set(texts.values())}) <= 0.1 * len(want)
    assert words == {k: len(t.split()) + 1 if t and t.split() else 0 for k, t in copies()}


def test_clusters_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.documents_to_pack(docs).count() == 0
    assert near_copies.clusters(near_copies.scanned(docs.select("text", "doc_id"), "doc_id bigint")).count() == 0


def scanned_rows(bands, seed=11):
    """For each band (a list of sets), one text a set with that band alone; bitmaps are those of the sets."""
    rng, rows = np.random.default_rng(seed), []
    for band, sets in enumerate(bands):
        for elements in sets:
            rows.append((int(rng.integers(-(2**62), 2**62)), len(elements), [band], near_copies.parity(elements).tolist()))
    return rows


def sets_of(rng, size=100):
    """A set, and one that shares all but two of its elements."""
    one = np.unique(rng.integers(1, 2**63, size, dtype=np.uint64))
    return one, np.unique(np.concatenate((one[2:], rng.integers(1, 2**63, 2, dtype=np.uint64))))


FOUND = "same long, n long, bands array<long>, parity array<long>"


def test_texts_link_without_the_representative_of_their_band(spark):
    rng = np.random.default_rng(3)
    bands = [[*sets_of(rng), sets_of(rng)[0]] for _ in range(20)]
    rows = scanned_rows(bands)
    got = {r.same: r.component for r in near_copies.clusters(spark.createDataFrame(rows, FOUND)).collect()}
    for a, b, c in zip(rows[::3], rows[1::3], rows[2::3], strict=True):
        assert got[a[0]] == got[b[0]] == min(a[0], b[0]) and c[0] not in got


def test_a_band_of_many_texts_is_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    rng = np.random.default_rng(4)
    rows = scanned_rows([[x for _ in range(30) for x in sets_of(rng)], [x for _ in range(3) for x in sets_of(rng)]])
    got = {r.same: r.component for r in near_copies.clusters(spark.createDataFrame(rows, FOUND)).collect()}
    assert len(got) == 66
    assert all(got[a[0]] == got[b[0]] == min(a[0], b[0]) for a, b in zip(rows[::2], rows[1::2], strict=True))


@pytest.mark.parametrize("capacity, tokens", [(1, 40_000), (7, 20)])
def test_packs_do_not_share_bins(spark, capacity, tokens):
    rows = spark.range(64).select(
        F.col("id").alias("doc_id"), (F.col("id") % 5).cast("string").alias("source"), F.col("id").alias("cluster"), F.lit(tokens).cast("long").alias("n_tokens"), F.xxhash64("id").alias("key")
    )
    packed = packing.pack(rows, capacity, pack_rows=16)
    bins = packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("held"))
    assert bins.agg(F.max("held"), F.sum("held")).first()[:] == (capacity, 64 * tokens)
    packs = packed.select(F.shiftright("bin_id", packing._PACK_SHIFT).alias("pack")).distinct().count()
    assert packs == 4


def test_later_turns_look_at_large_buckets_with_pairs_held_back_only(spark, monkeypatch):
    """A chain of texts, each linked with the next three; every pair of a small bucket is settled in the first turn."""
    seen, real = [], jaccard_join.still_open
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "FIRST", 1)
    monkeypatch.setattr(jaccard_join, "still_open", lambda buckets, known: seen.append(buckets) or real(buckets, known))
    words = [f"w{k}" for k in range(140)]
    rows = [(i, " ".join(words[i : i + 60])) for i in range(80)]
    found = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), jaccard_join.CONTRACT)
    assert {r.component_id for r in found.collect()} == {0}
    assert len(seen) > 1
    for buckets in seen[1:]:
        assert buckets.filter(F.col("size") <= 4).isEmpty()  # all open buckets went on, before


def test_large_buckets_pass_on_a_few_pairs_of_each_class_and_each_pair_once(spark):
    """Forty copies of one set, each of a class of its own, in three buckets and one group: all 780 pairs came from each, before."""
    rule, rng = jaccard_join.NEAR, np.random.default_rng(6)
    base = rng.integers(1, 2**63, 300, dtype=np.uint64)
    sets = [np.concatenate((np.delete(base, k), rng.integers(1, 2**63, 1, dtype=np.uint64))) for k in range(40)]
    rows = [(k, len(s), bytearray(jaccard_join.parity_bits(s, jaccard_join.BITS).tobytes()), None) for k, s in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, n long, parity binary, wide array<long>")
    rest = nodes.crossJoin(spark.createDataFrame([(t,) for t in ("5", "70", "8", "g3")], "token string")).select("token", "node", F.col("node").alias("label"))
    few = jaccard_join.large_bucket_pairs(rest, nodes, rule, 4).collect()
    assert {r.token for r in few} == {"5"} and len(few) <= 4 * 40 and all(r.more for r in few)
    assert {x for r in few for x in (r.a, r.b)} == set(range(40))
    every = jaccard_join.large_bucket_pairs(rest, nodes, rule, 40).collect()
    assert sorted((r.a, r.b) for r in every) == [(a, b) for a in range(40) for b in range(a + 1, 40)]
    assert {(r.token, r.more) for r in every} == {("5", False)}
