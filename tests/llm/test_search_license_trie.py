"""Hard negatives, license scans and the prefix trie against plain versions, and on nulls, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from pulseframe.llm import hard_negatives, license_scan, prefix_trie

# hard negatives


def plain_negatives(rows):
    """Full search over rows (vec_id, embedding, label)."""
    kept = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for vec_id, label, v in sorted({r for r in kept if r[0] % 100 == 0}):
        score = [(-sum(a * b for a, b in zip(v, w, strict=True)), i, other) for i, other, w in kept]
        for s, positive, _ in sorted(x for x in score if x[2] == label and x[1] != vec_id)[:5]:
            fits = sorted(x for x in score if x[2] != label and -30 * s <= -100 * x[0] <= -90 * s)
            out += [(vec_id, positive, rank, i, -s, -t) for rank, (t, i, _) in enumerate(fits[:10], 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


def mined(spark, rows, schema=SCHEMA, **how):
    return sorted(tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, schema).repartition(3), **how).collect())


def clustered(n, dims=6, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(k, [float(np.float32(x)) for x in centres[k % 12] + 0.2 * rng.normal(size=dims)], int(k % 12 % 5)) for k in range(n)]


def test_hard_negatives_equal_a_full_search(spark):
    rows = clustered(1200)
    rows += [(2000, None, 1), (2001, [1.0] * 6, None), (2002, [1.0, None] * 3, 1), (2003, [float("nan")] * 6, 1), (2100, [float("inf")] * 6, 2), (None, [1.0] * 6, 1)]
    rows += rows[:40]  # repeated rows, anchor 0 among them
    assert mined(spark, rows) == plain_negatives(rows)


def test_hard_negatives_with_ties_and_one_hot_vector(spark):
    v = [0.5, 0.25, 0.125, 0.0]
    rows = [(k, v if k % 3 else [0.4, 0.2, 0.1, 0.01], k % 2) for k in range(700)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_hard_negatives_in_pieces_and_blocks(spark, monkeypatch):
    for name, value in (("PIECE", 16), ("BLOCK", 2), ("SEED", 8), ("CHUNK", 1)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(600, dims=5)
    assert mined(spark, rows) == plain_negatives(rows)


def test_hard_negatives_of_odd_input(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0, 2.0], 1)]) == []
    # other lengths take no part, nor components no long could hold products of
    rows = [(100, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.5], 2), (3, [9.0], 2), (4, [], 2), (5, [1e30, 0.0], 2)]
    assert mined(spark, rows) == [(100, 1, 1, 2, 3 * 65536, 2 * 65536)] == plain_negatives(rows[:3])
    # negative positive scores have empty windows, a score of zero admits zeros
    rows = [(100, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 3.0], 2), (4, [1.0, 1.0], 2)]
    assert mined(spark, rows) == [(100, 2, 1, 3, 0, 0)] == plain_negatives(rows)
    big = [(100, [2.0**19, 2.0**19], 1), (1, [2.0**19 - 1, 2.0**19], 1), (2, [2.0**18, 2.0**19], 2)]
    assert mined(spark, big) == plain_negatives(big)
    extra = [(*r, "a", 1) for r in clustered(300)]
    assert mined(spark, extra, SCHEMA + ", cell string, anchor int") == plain_negatives(clustered(300))


def test_cells_come_by_falling_bound_and_bounds_hold():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(500, 8)))
    books = hard_negatives.codebook(x[:, :4], 16), hard_negatives.codebook(x[:, 4:], 16)
    (a, d1), (b, d2) = hard_negatives.assigned(x[:, :4], books[0]), hard_negatives.assigned(x[:, 4:], books[1])
    cell = a * hard_negatives.CODES + b
    cells = hard_negatives.Cells(books, {int(c): (int((cell == c).sum()), d1[cell == c].max(), d2[cell == c].max()) for c in np.unique(cell)})
    for q in x[:20]:
        scores, bounds, seen = x @ q, [], []
        for bound, upper, lower, c, n in cells.visited(q):
            bounds.append(bound)
            seen.append(c)
            assert lower <= scores[cell == c].min() and scores[cell == c].max() <= upper <= bound + 1e-6 and n == (cell == c).sum()
        assert bounds == sorted(bounds, reverse=True) and sorted(seen) == np.unique(cell).tolist()


# license scans


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def accepts(tokens, words, at):
    """Ends of runs from ``at`` that a template (nested lists, (a, b) for replaceable) accepts, by plain recursion."""
    if not tokens:
        return {at}
    head, rest = tokens[0], tokens[1:]
    if isinstance(head, list):
        return accepts(rest, words, at) | {e for m in accepts(head, words, at) for e in accepts(rest, words, m)}
    if isinstance(head, tuple):
        return {e for k in range(head[0], head[1] + 1) if at + k <= len(words) for e in accepts(rest, words, at + k)}
    return accepts(rest, words, at + 1) if at < len(words) and words[at] == head else set()


def nested(template):
    stack = [[]]
    for token in re.findall(r"\[|\]|<[^>]*>|[^\[\]<> ]+", template):
        if token == "[":
            stack.append([])
        elif token == "]":
            done = stack.pop()
            stack[-1].append(done)
        elif token[0] == "<":
            stack[-1].append(tuple(int(x) for x in re.search(r"(\d+)-(\d+)", token).groups()))
        else:
            stack[-1].append(token)
    return stack[0]


EVERY = [(a, nested(t)) for a, t in zip(license_scan.automata(), [*license_scan.BASE, *(t for _, t in license_scan.TEMPLATES)], strict=True)]


def filled(tokens, rng):
    """A text that the template accepts."""
    out = []
    for t in tokens:
        if isinstance(t, list):
            out += filled(t, rng) if rng.random() < 0.5 else []
        elif isinstance(t, tuple):
            out += [rng.choice(["acme", "mit", "the", "2024"]) for _ in range(rng.randint(*t))]
        else:
            out.append(t)
    return out


def license_texts():
    rng = random.Random(4)
    texts = [None, "", " \n", "one", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
             "under the mit\tlicense under the MIT-license cc BY nc", "Straße ünder under the mit license漢", "apache license version 2", "under the", "cc by nc cc by nc"]
    for automaton, tokens in EVERY:
        for _ in range(6):
            words = filled(tokens, rng)
            if rng.random() < 0.4:  # a mandatory or optional word changed or lost
                k = rng.randrange(len(words))
                words[k : k + 1] = [["other"], []][rng.randrange(2)]
            texts.append(" ".join(["before", "licensed", *words, "version", "after"]).title())
    texts.append(" ".join(rng.choice(["under", "the", "mit", "license", "licensed", "apache", "version", "2", "0", "by"]) for _ in range(20000)))
    return texts


def test_license_scan_equals_plain_recursion(spark):
    rows = [(k, t, "x", "y") for k, t in enumerate(license_texts())]
    rows += [rows[4], (None, "cc by nc", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, spans string").repartition(3)
    got = sorted(((r.doc_id, r.n_words, r.spans) for r in license_scan.scan(docs).collect()), key=lambda r: -1 if r[0] is None else r[0])
    want = []
    for k, text, *_ in rows:
        words = plain_words(text)
        spans = []
        for i in range(len(words)):
            for a, tokens in EVERY:
                ends = accepts(tokens, words, i)
                if ends:
                    spans.append((a.label, i, max(ends), a.base, a.mandatory))
        want.append((k, len(words), spans))
    want.sort(key=lambda r: -1 if r[0] is None else r[0])
    assert [(a, b, sorted(map(tuple, s))) for a, b, s in got] == [(a, b, sorted(s)) for a, b, s in want]
    assert sum(len(s) for _, _, s in want) > 60
    found = {r.doc_id: r for r in license_scan.verdicts(license_scan.scan(docs)).collect()}
    assert (found[7].n_base, found[7].first_word, found[7].last_word, found[7].base_labels) == (3, 0, 8, "cc-by-nc,mit")
    assert (found[0].n_base, found[0].first_word, found[0].base_labels, found[0].labels, found[0].score) == (0, None, "", "", 0.0)
    assert found[5].labels == "apache-2,apache-2.0" and 0 < found[5].score < 1
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_template_markup():
    one = license_scan.Automaton("x", "a [b [c]] <n 1-2> d")
    for text, end in (("a q d", 3), ("a b q d", 4), ("a b c q d", 5), ("a b c q r d", 6), ("a d", -1), ("a c d", 3), ("a q r s d", -1), ("b q d", -1)):
        assert one.end(text.encode().split(), 0, len(text.split())) == end, text
    with pytest.raises(ValueError):
        license_scan.Automaton("x", "[a]")
    with pytest.raises(ValueError):
        license_scan.Automaton("x", "a [b")


# prefix trie


def plain_trie(rows):
    """Nodes of rows (conv_id, turn, role, text) by dictionaries of prefixes."""

    def order(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())

    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, convs in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == path)
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def grown(spark, rows, schema="conv_id long, turn long, role string, text string"):
    turns = prefix_trie.numbered_turns(spark.createDataFrame(rows, schema).repartition(3))
    return sorted(tuple(r) for r in prefix_trie.trie(*prefix_trie.rebuilt_turns(turns)).collect())


def conversations(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 70), 1023, 1024, 1025, 2**40, -3, -20, -41]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "d  e\tf", None])))
    rows += [(3, None, None, None), (3, None, "user", "null turn"), (5, 0, "user", "same turn"), (5, 0, "user", "same turn"), (None, 0, "user", "x")]
    return rows


def test_trie_equals_plain_prefixes(spark):
    rows = conversations()
    assert grown(spark, rows) == plain_trie(rows)
    assert grown(spark, [(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, n int") == plain_trie(rows)
    assert grown(spark, []) == []
    # a conversation left without turns is a member of the root alone
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    assert grown(spark, [(alone, 0, "user", "hi")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_trie_over_slabs_shards_and_hot_parents(spark, monkeypatch):
    for name, value in (("SLAB", 2), ("SLICE", 3), ("HOT_PARENT", 20)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = conversations(5)
    # long ones that part late, and one conversation repeated over shards
    rows += [(c, t, "user", "long" if t < 9 else f"end {c % 2}") for c in (200, 201, 1500) for t in range(11)]
    rows += [(1024 * k, t, "user", "hot") for k in range(3, 9) for t in range(3)]
    assert grown(spark, rows) == plain_trie(rows)
