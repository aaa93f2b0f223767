"""Each text operator against a plain version, and on nulls, empty and repeated rows, and clashing columns."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import (
    chat_format, common, compression_classifier, decontamination, graph, jaccard_join, language_id, masked_lm, packing, quality_rules,
    surrogates, textnum, warc,
)

WORDS = "the of and tion ing river stone light window garden morning people water mountain letter paper answer".split()


def prose(seed, n):
    random.seed(seed)
    return " ".join(random.choice(WORDS) for _ in range(n))


#: id, text, lang, source: nulls, empty, blank, short, repeated, long
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n ", None, "a"), (4, "one", "en", "a"), (5, prose(5, 60), "en", "b"),
    (5, prose(5, 60), "en", "b"), (6, prose(6, 5000), "en", "b"), (None, prose(7, 40), None, None), (8, "1234 !!! ###", "en", "c"),
    (9, "Straße über Öl 漢字 " + prose(9, 30), "de", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # columns with the names that operators make are part of the input
    schema = "doc_id long, text string, lang string, source string, score string, kept string, n_words string, n_entities string, spans string"
    return spark.createDataFrame([(*r, "s", "k", "n", "e", "x") for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def words3(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_words_and_windows_agree_with_plain_python():
    texts = [(t or "").encode() for _, t, *_ in ROWS]
    words = textnum.Words(texts, lower=True)
    assert words.count.tolist() == [len(words3(t)) for _, t, *_ in ROWS]
    plain = [w for _, t, *_ in ROWS for w in words3(t)]
    assert len(set(zip(plain, words.hash.tolist()))) == len(set(plain)) == len(set(words.hash.tolist()))
    assert [len(s) for s in words.shingle_sets(3)] == [len(jaccard_join.shingles(t or "", 3)) for _, t, *_ in ROWS]


# language ID


def test_language_profiles(spark, docs, nothing):
    learn = spark.createDataFrame([("the river and the stone", "en"), ("le fleuve et la pierre", "fr"), (None, "en"), ("x", None)], "text string, lang string")
    profiles = language_id.train(learn)
    assert set(profiles) == {"en", "fr"}
    found = {r.doc_id: r for r in language_id.predict(docs, profiles).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4 and found[5].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language_id.identify(nothing).count() == 0
    grams = [" ".join([]), *(x for w in ("ab",) for x in ("a", "b", " a", "ab", "b ", " ab", "ab "))][1:]
    assert len(language_id.ngram_codes("ab")) == len(grams)
    assert language_id.predict(docs, {}).filter("lang_pred <> 'und'").count() == 0


# quality rules


def plain_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)})


def test_quality_rules(spark, docs, nothing):
    text = "a b c d e a b c d e f\nsame line\nsame line\n\n\nsame line #*\n" + "x y z w v " * 3
    more = docs.select("doc_id", "text", "kept").unionByName(spark.createDataFrame([(50, text, "k")], "doc_id long, text string, kept string"))
    ratio = quality_rules.train(more.withColumn("trusted", F.col("doc_id") == 6))
    assert len(ratio) == quality_rules.CELLS
    for r in quality_rules.score(more, ratio).collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == plain_repeats(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.log_ratio >= quality_rules.THRESHOLD)
    assert quality_rules.score(nothing, ratio).count() == 0
    assert not quality_rules.train(nothing.withColumn("trusted", F.lit(True))).any()


# compression classifier


def test_compression_classifier(spark, docs, nothing):
    rows = [(k, prose(k, 120), 1) for k in range(200)] + [(1000 + k, "WIN $$$ NOW!! " * 3 + " ".join(w.upper() + "%%%" for w in prose(k, 60).split()), 0) for k in range(200)]
    model = compression_classifier.train(spark.createDataFrame([*rows, (7, None, 1), (8, "x", None)], "doc_id long, text string, label int"))
    test = spark.createDataFrame([(1, prose(777, 100)), (2, " ".join(w.upper() + "%%%" for w in prose(778, 60).split()))], "doc_id long, text string")
    good, bad = (r.score for r in compression_classifier.score(test, model).orderBy("doc_id").collect())
    assert good > 0.7 and bad < 0.3
    assert all(0 <= r.score <= 1 for r in compression_classifier.score(docs, model).collect())
    assert compression_classifier.score(docs, compression_classifier.train(nothing.withColumn("label", F.lit(1)))).first().score == 0.5
    assert compression_classifier.score(nothing, model).count() == 0


# decontamination


def plain_hits(text, items, window=13):
    w = re.findall(r"[0-9a-z\x80-￿]+", (text or "").lower())
    hit, ids = set(), set()
    for name, item in items:
        v = re.findall(r"[0-9a-z\x80-￿]+", (item or "").lower())
        size = min(window, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1 if v else 0):
            if tuple(w[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                ids.add(name)
    return len(w), len(hit), sorted(ids)


def test_suffix_automaton_against_brute_force(spark):
    random.seed(3)
    for small in (3, 13):
        items = [(str(k), " ".join(random.choice("abc") for _ in range(random.randint(0, 9)))) for k in range(12)]
        automaton = decontamination.Automaton([(n, t.encode()) for n, t in items], small)
        for _ in range(60):
            text = " ".join(random.choice("abcd") for _ in range(random.randint(0, 40)))
            spans, ids = automaton.spans(text.encode().split())
            n, hit, names = plain_hits(text, items, small)
            assert (sum(b - a for a, b in spans), sorted(ids)) == (hit, names)


def test_decontamination(spark, docs, nothing):
    item = prose(5, 60)
    bench = spark.createDataFrame([(1, item), (2, "ONE"), (3, None), (4, ""), (None, prose(900, 20))], "item_id long, text string")
    items = [("1", item), ("2", "ONE"), ("", prose(900, 20))]
    for block in (decontamination.BLOCK_BYTES, 200):
        found = decontamination.find(docs, bench, block_bytes=block).collect()
        assert len(found) == len(ROWS)
        for r in found:
            assert (r.n_words, r.n_hit, r["items"]) == plain_hits(r.text, items)
    assert decontamination.find(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontamination.find(nothing, bench).count() == 0
    kept = {r.doc_id: r for r in decontamination.clean(docs.withColumn("text", F.when(F.col("doc_id") == 6, F.concat(F.col("text"), F.lit(" " + item))).otherwise(F.col("text"))), bench).collect()}
    assert 5 not in kept and 4 not in kept and kept[6].text.strip() == prose(6, 5000) and kept[6].kept == "k"


# chat


def test_chat_fold_and_round_trip(spark):
    log = [
        (1, 1, 1, "delta", "user", "Hel"), (1, 2, 1, None, "user", "lo"), (1, 3, 2, "delta", "assistant", "bad"), (1, 4, 3, "delta", "user", "why?"),
        (1, 5, 2, "regenerate", "assistant", ""), (1, 6, 2, "delta", "assistant", "good"), (1, 7, 2, "edit", "assistant", "better"), (1, 8, 2, "delta", "assistant", "!"),
        (None, 1, 1, "delta", None, None), (2, 1, 1, "delta", "a:b\\c", "x\\e\\\\</turn>\n### y: </turn>"),
    ]
    frame = spark.createDataFrame(log, "conv_id long, seq long, turn long, kind string, role string, text string")
    out = chat_format.render(chat_format.fold(frame)).withColumn("turns", chat_format.parsed_turns(F.col("formatted"))).withColumn(
        "loss", chat_format.masked_text(F.col("formatted"), F.col("loss_spans")))
    found = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in found[1].turns] == [("user", "Hello"), ("assistant", "better!")] and found[1].loss == "better!"
    assert [tuple(t) for t in found[None].turns] == [("", "")]
    assert [tuple(t) for t in found[2].turns] == [("a:b\\c", "x\\e\\\\</turn>\n### y: </turn>")]
    assert chat_format.render(chat_format.fold(frame.limit(0))).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# WARC


def test_warc_round_trip(spark, monkeypatch):
    big = "x" * 1500 + "é"
    rows = [(1, "u\r\nv", big), (2, None, big), (3, "u", big), (4, "u", None), (5, "u", "tiny"), (6, "u", "tiny"), (None, "u", big), (3, "u", big), (7, "u", "y" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    folder = common.new_path(spark, "warc")
    index = warc.write(pages.repartition(2), folder)
    found = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload) if r.payload is not None else None) for r in warc.read(index, folder).collect()), key=str)
    full = big.encode()
    assert found == sorted([
        (1, "revisit", 3, len(full), None), (2, "revisit", 3, len(full), None), (3, "response", None, len(full), full), (3, "response", None, len(full), full),
        (0, "revisit", 3, len(full), None), (4, "response", None, 0, b""), (5, "response", None, 4, b"tiny"), (6, "response", None, 4, b"tiny"), (7, "response", None, 5000, b"y" * 5000),
    ], key=str)
    assert warc.read(index.filter("page_id = 7"), folder).first().payload == b"y" * 5000
    empty = common.new_path(spark, "warc")
    assert warc.read(warc.write(pages.limit(0), empty), empty).count() == 0


# packing


def test_best_fit_against_plain_search():
    random.seed(4)
    bins, plain = packing.Bins(100, 70, 70, 300), []
    for length in sorted((random.randint(1, 100) for _ in range(300)), reverse=True):
        source, cluster = random.randint(-1, 69), random.randint(-1, 69)
        fits = [b for b in plain if b["left"] >= length and source not in b["s"] and cluster not in b["c"]]
        which = bins.put(length, source, cluster)
        if fits:
            assert plain[which]["left"] == min(b["left"] for b in fits) and plain[which] in fits
        else:
            assert which == len(plain)
            plain.append({"left": 100, "s": set(), "c": set()})
        plain[which]["left"] -= length
        plain[which]["s"] |= {source} - {-1}
        plain[which]["c"] |= {cluster} - {-1}


def test_packing(spark, docs, nothing):
    found = packing.pack_documents(docs, capacity=64).toPandas()
    assert (found[found.bin_id.notna()].groupby("bin_id").n_tokens.sum() <= 64).all()
    tokens = found.groupby("doc_id", dropna=False).n_tokens.sum()
    assert tokens[6] == 5001 and tokens[5] == 122 and tokens[1] == tokens[2] == tokens[3] == 0
    twice = found[found.doc_id == 5]
    assert twice.bin_id.nunique() == 2
    whole = found[found.doc_id == 6].sort_values("piece")
    assert (whole.begin.diff().dropna() == 64).all()
    assert packing.pack_documents(nothing).count() == 0


# Jaccard join


def plain_components(rows, width, num, den):
    sets = [jaccard_join.shingles(t or "", width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return [(name, len(sets[i]), least.get(root(i))) for i, (name, _) in enumerate(rows)]


@pytest.mark.parametrize("small,block", [(48, 2048), (2, 16)])
def test_jaccard_classes_against_all_pairs(spark, monkeypatch, small, block):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(k, random.choice([None, "", " ", "One two", "one TWO"])) for k in range(8)]
    shared = [random.choice(vocabulary) for _ in range(15)]
    for base in range(5):
        words = [random.choice(vocabulary) for _ in range(80)] + shared
        for _ in range(14):
            copy = list(words)
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            rows.append((100 * base + len(rows), " ".join(copy)))
    rows += [(3, rows[-1][1]), (None, rows[20][1]), (900, rows[30][1].upper())]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    found = jaccard_join.classes(frame, jaccard_join.CONTRACT).select("doc_id", "n", "component_id").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, plain_components(rows, 3, 90, 100)))


def test_jaccard_on_nothing_and_keep_one(spark, nothing, docs):
    assert jaccard_join.classes(nothing, jaccard_join.NEAR).count() == 0
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, None, 8, 9]))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.node: r.component for r in graph.components(edges).collect()}
    assert found == {k: 0 for k in range(31)} | {100: 100, 101: 100}


# surrogates


def test_surrogates(spark, docs, nothing):
    text = 'Mr. John Smith and Ms. Smith: a.b@corp.com, A.B@corp.com; +1 (017) 555-7713 = +1 017 555 7713; 4111 1111 1111 1111; 10.2.3.4; 123-45-6789; token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"; госпожа Анна'
    rows = spark.createDataFrame([(1, text, 0), (2, text, 0), (3, "version 2.0.1, 1999", 0), (4, None, 0)], "doc_id long, text string, row_ int")
    found = {r.doc_id: r for r in surrogates.replace_entities(rows).collect()}
    new = found[1].text
    assert new == found[2].text and found[3].text == "version 2.0.1, 1999" and found[4].text is None
    m = re.fullmatch(r'Mr\. (\w+) (\w+) and Ms\. (\w+): (\S+@\S+), (\S+@\S+); (\+1 \(\d{3}\) \d{3}-\d{4}) = (\+1 \d{3} \d{3} \d{4}); (\d{4} \d{4} \d{4} \d{4}); (\d+\.\d+\.\d+\.\d+); (\d{3}-\d\d-\d{4}); token = "([0-9a-f]{40})"; госпожа ([А-Яа-я]+)', new)
    assert m and m[2] == m[3] and m[4] == m[5] and re.sub(r"\D", "", m[6]) == re.sub(r"\D", "", m[7]) and m[1].endswith("n")
    for secret in ("John", "Smith", "corp", "7713", "4111", "10.2.3.4", "123-45", "04dbebab", "Анна"):
        assert secret not in new
    assert surrogates.replace_entities(docs).filter("n_entities > 0").count() == 0 and surrogates.replace_entities(nothing).count() == 0
    plan = surrogates.replace_entities(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_surrogates_stay_distinct(spark):
    entities = spark.createDataFrame([("email", f"{c}@x.org") for c in "abcdefghijklmnopqrstuvwxyz"] + [("email", "a@x.org")], "kind string, canonical string")
    found = surrogates.mapping(entities).collect()
    assert len(found) == 26 == len({r.surrogate for r in found}) and not {r.surrogate for r in found} & {r.canonical for r in found}


def test_crowded_formats_are_permuted(spark):
    phones = [("phone", f"+7|{k:04d}") for k in range(10000)] + [("phone", f"+49|{k}") for k in range(10)] + [("phone", "+1|0175557713")]
    cards = [("card", "4111111111111111"), ("ssn", "123456789"), ("ip", "10.2.3.4")]
    found = {(r.kind, r.canonical): r.surrogate for r in surrogates.mapping(spark.createDataFrame(phones + cards, "kind string, canonical string")).collect()}
    assert found.keys() == set(phones + cards)
    by = {country: {old: new for (_, old), new in found.items() if old.startswith(country + "|")} for country in ("+7", "+49")}
    # every form is an entity, so the surrogates are all forms again, and none is its own
    assert all(set(x.values()) == set(x) and all(a != b for a, b in x.items()) for x in by.values())
    assert all(found[x] != x[1] and found[x] not in {y for _, y in found} for x in [*cards, phones[-1]])
    texts = spark.createDataFrame([(k, f"call +7 {k // 100:02d} {k % 100:02d} now") for k in range(6000)], "doc_id long, text string")
    new = surrogates.replace_entities(texts).collect()
    assert len({r.text for r in new}) == 6000 and all(re.fullmatch(r"call \+7 \d\d \d\d now", r.text) for r in new)


def test_permutation_is_one_cycle(spark):
    from pyspark.sql import functions as F

    def followed(kind, size):
        old = F.concat(F.lit("+1|"), F.lpad(F.col("id").cast("string"), size, "0")) if kind == "phone" else F.lpad(F.col("id").cast("string"), size, "0")
        rows = spark.range(10**size).select(old.alias("old"), surrogates.permuted(F.lit(kind), old, "k").alias("new")).collect()
        return {r.old: r.new for r in rows}

    for kind, size in (("phone", 1), ("phone", 3), ("ssn", 4)):
        step = followed(kind, size)
        at = start = next(iter(step))
        for k in range(1, len(step) + 1):
            at = step[at]
            if at == start:
                break
        assert k == len(step)
    ip = spark.createDataFrame([(f"{a}.2.3.{b}",) for a in range(0, 256, 5) for b in range(256)], "old string")
    new = [r.new for r in ip.select(surrogates.permuted(F.lit("ip"), F.col("old"), "k").alias("new")).collect()]
    assert len(set(new)) == len(new) and all(len(x.split(".")) == 4 and all(0 <= int(y) < 256 for y in x.split(".")) for x in new)


# language model


def test_masked_lm(spark, docs, nothing):
    train = spark.createDataFrame([(k, prose(k, 300)) for k in range(60)], "doc_id long, text string")
    model = masked_lm.train(train)
    weights = masked_lm.unflat(model.weights)
    # every conditional distribution adds up to one, and the sum over a text is the sum over its tokens
    context = np.array([[3, 4, 5, 6]])
    everything = masked_lm.log_probabilities(weights, np.repeat(context, masked_lm.VOCABULARY, 0), np.arange(masked_lm.VOCABULARY))
    assert abs(np.exp(everything.astype(float)).sum() - 1) < 1e-4
    text = "the river of stone"
    w = masked_lm.token_words([text.encode()])
    numbers = [0, 0, *model.words.numbers(w.hash).tolist(), 0, 0]
    plain = sum(
        masked_lm.log_probabilities(weights, np.array([[numbers[i - 2], numbers[i - 1], numbers[i + 1], numbers[i + 2]]]), np.array([numbers[i]]))[0]
        for i in range(2, len(numbers) - 2)
    )
    n, total = masked_lm.text_scores([b"", text.encode()], model.words, weights)
    assert n.tolist() == [0, 4] and total[0] == 0 and abs(total[1] - plain) < 1e-3
    before = masked_lm.text_scores([prose(999, 200).encode()], model.words, masked_lm.initial())[1][0]
    after = masked_lm.text_scores([prose(999, 200).encode()], model.words, weights)[1][0]
    assert after > before
    found = {r.doc_id: r for r in masked_lm.score(docs, model).collect()}
    assert found[1].n_tokens == 0 and found[1].log_likelihood == 0 and found[1].mean_log_likelihood is None and found[6].n_tokens == 5000
    assert masked_lm.score(nothing, masked_lm.train(nothing)).count() == 0


def test_gradients_by_differences():
    random_ = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in masked_lm.initial().items()}
    context, target = random_.integers(0, 50, (6, 4)), random_.integers(0, masked_lm.VOCABULARY, 6)
    g = masked_lm.gradients(w, context, target)
    for k, at in (("scale", (1, 3)), ("shift", (4,)), ("to_class", (2, 5)), ("embed", (int(context[0, 1]), 7)), ("to_word", (int(target[0]) // 32, 3, 2))):
        up, down = ({**w, k: w[k].copy()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        slope = -(masked_lm.log_probabilities(up, context, target).sum() - masked_lm.log_probabilities(down, context, target).sum()) / 2e-4
        assert abs(slope - g[k][at]) < 1e-3


def test_block_does_not_lose_links_behind_pairs_that_only_the_wide_bitmap_rules_out(spark):
    rule, random_ = jaccard_join.CONTRACT, np.random.default_rng(5)
    fresh = lambda n: random_.integers(1, 2**63, n, dtype=np.uint64)
    place = lambda e: textnum.mixed(e) >> np.uint64(55)  # noqa: E731  the element's place in the narrow bitmap
    base, spare = fresh(5000), fresh(200_000)
    by_place = {k: list(spare[place(spare) == k]) for k in range(jaccard_join.BITS)}
    # 400 elements change for others of the same narrow place: similarity 0.85, narrow bitmaps equal
    misses = [np.concatenate((base[400:], [by_place[int(k)].pop() for k in place(base[:400])])).astype(np.uint64) for _ in range(10)]
    link = np.concatenate((base[200:], fresh(200)))  # similarity 0.92
    sets = [base, *misses, link]
    assert [rule.links(len(np.intersect1d(base, s)), len(s), len(base)) for s in sets[1:]] == [False] * 10 + [True]
    rows = [
        (k, len(s), bytearray(jaccard_join.parity_bits(s, jaccard_join.BITS).tobytes()), jaccard_join.parity_bits(s, jaccard_join.WIDE_BITS).view(np.int64).tolist())
        for k, s in enumerate(sets)
    ]
    nodes = spark.createDataFrame(rows, "node long, n long, parity binary, wide array<long>")
    rest = nodes.select(F.lit("t").alias("token"), "node", F.least("node", F.lit(1)).cast("long").alias("label"))
    found = jaccard_join.near_enough(jaccard_join.large_bucket_pairs(rest, nodes, rule, jaccard_join.FIRST), nodes, rule)
    assert [tuple(r) for r in found.collect()] == [(0, len(sets) - 1, False)]


def test_quality_counts_every_trusted_row(spark, tmp_path):
    # more trusted ids than any fixed sample; the words of each are its own
    docs = spark.range(20_400).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 20_200, 1).otherwise(0).alias("quality"))
    twice = labels.unionByName(spark.createDataFrame([(3, 1), (None, 1)], "doc_id long, quality int"))
    plain = quality_rules.train(docs.withColumn("trusted", F.col("doc_id") < 20_200))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    twice.write.parquet(f"{tmp_path}/labels.parquet")
    found = {r.doc_id: r.log_ratio for r in quality_rules.query(spark, str(tmp_path)).collect()}
    wanted = {r.doc_id: r.log_ratio for r in quality_rules.score(docs, plain).collect()}
    assert found == pytest.approx(wanted)
    assert np.allclose(quality_rules.train_labelled(docs, twice, most=3000), plain)
    assert np.allclose(quality_rules.train_labelled(docs, twice.filter("false")), 0)


def test_masked_lm_tells_rare_words_of_a_bucket_apart(spark):
    common_words = " ".join(f"c{k}" for k in range(1000)) + " "
    words = [f"r{k}" for k in range(3000)]
    hashes = masked_lm.token_words([" ".join(words).encode()]).hash
    often, once = [w for w, h in zip(words, hashes % np.uint64(masked_lm.BUCKETS), strict=True) if h == hashes[0] % np.uint64(masked_lm.BUCKETS)][:2]
    rows = [(1, common_words * 9), (2, f"c1 {often} c2"), (3, f"c1 {once} c2"), (3, f"c1 {often} c2"), (4, f"{often} " * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = masked_lm.train(frame)
    found = {(r.doc_id, r.text): r.log_likelihood for r in masked_lm.score(frame, model).collect()}
    # 5 occurrences against 1 of words that the network cannot tell apart; the copy scores the same
    assert found[2, rows[1][1]] - found[3, rows[2][1]] == pytest.approx(np.log(5), abs=1e-4)
    assert found[2, rows[1][1]] == pytest.approx(found[3, rows[3][1]], abs=1e-4)
    assert len(found) == 5 and model.words.rare.sum() == sum(len(t.split()) for _, t in rows) - 9 * 927 - 3 * 2


def test_masked_lm_learns_every_position(spark, monkeypatch):
    texts = [b"", b"one", b"one two three", prose(1, 301).encode(), b"four five"]
    w = masked_lm.token_words(texts)
    rounds = [masked_lm.masked_positions(w, k, masked_lm.ROUNDS) for k in range(masked_lm.ROUNDS)]
    assert sorted(np.concatenate(rounds).tolist()) == list(range(len(w.hash)))
    # what the training itself takes as targets, over all rounds
    seen, learn = [], masked_lm.Trainer.learn
    monkeypatch.setattr(masked_lm.Trainer, "learn", lambda self, c, target: (seen.extend(target.tolist()), learn(self, c, target))[1])
    words = masked_lm.Vocabulary(np.unique(w.hash))
    shared = type("Shared", (), {"value": masked_lm.flat(masked_lm.initial())})
    monkeypatch.setattr(masked_lm, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})())}))
    for turn in range(masked_lm.ROUNDS):
        list(masked_lm._trained(shared, words, turn, masked_lm.ROUNDS)(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])])))
    assert sorted(seen) == sorted(words.numbers(w.hash).tolist())


def test_packing_parts_near_copies(spark):
    base = prose(21, 60).split()
    near = " ".join([*base[:30], "changed", *base[31:]])
    rows = [(1, " ".join(base), "a"), (2, near, "b"), (3, ", ".join(base).upper() + "!", "c"), (4, "?? !!", "d"), (5, prose(22, 60), "e"), (5, prose(22, 60), "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = packing.pack_documents(frame).toPandas()
    bins = found.groupby("doc_id").bin_id.agg(list).to_dict()
    assert len(found) == len(rows) and len({*bins[1], *bins[2], *bins[3]}) == 3 and len(set(bins[5])) == 2
    # what is no near copy still shares bins
    assert found.bin_id.nunique() == 3


def test_long_secrets_are_replaced_whole(spark):
    random.seed(3)
    secrets = [
        "".join(random.choice("0123456789abcdef") for _ in range(200)), "".join(random.choice("0123456789ABCDEF") for _ in range(300)),
        "sk-" + "".join(random.choice("abcXYZ019") for _ in range(400)), "ghp_" + "-".join("".join(random.choice("abcXYZ019") for _ in range(60)) for _ in range(5)),
    ]
    frame = spark.createDataFrame([(k, f"key {s} end") for k, s in enumerate(secrets)], "doc_id long, text string")
    for r in surrogates.replace_entities(frame).collect():
        old, new = secrets[r.doc_id], r.text.split()[1]
        assert r.n_entities == 1 and len(new) == len(old) and r.text == f"key {new} end"
        assert not any(old[k : k + 16] in new for k in range(5, len(old) - 16))


def test_names_are_replaced_wherever_their_document_has_them(spark):
    rows = [
        (1, "Byron came. Dr. Ada Byron spoke; Ms. Ada Byron left. Byron's friend BYRON and Ada (Byron) met Byronic Adalbert."),
        (2, "Byron is nobody's name here, mail x@corp.com"), (3, "Mr. Ada-Lee O'Neil and Mrs. O'Neil: O'Neil, Ada-Lee, Ada"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in surrogates.replace_entities(frame).collect()}
    m = re.fullmatch(r"(\w+) came\. Dr\. (\w+) (\w+) spoke; Ms\. (\w+) (\w+) left\. (\w+)'s friend (\w+) and (\w+) \((\w+)\) met Byronic Adalbert\.", found[1].text)
    assert m and m[1] == m[3] == m[5] == m[6] == m[9] != "Byron" and m[7] == m[1].upper() and m[2] == m[4] == m[8] != "Ada"
    # the title that tells a gender gives the ending
    assert m[2].endswith("a") and found[1].n_entities == 9
    assert found[2].text.startswith("Byron is nobody's name here") and found[2].n_entities == 1
    m = re.fullmatch(r"Mr\. (\w+) (\w+) and Mrs\. (\w+): (\w+), (\w+), Ada", found[3].text)
    assert m and m[2] == m[3] == m[4] and m[1] == m[5]
    one = surrogates.mapping(spark.createDataFrame([("given:u", "ada"), ("given:f", "ada")], "kind string, canonical string")).collect()
    assert [(r.kind, r.canonical) for r in one] == [("given:f", "ada")]


def test_language_stage_keeps_lettered_documents_without_profiles(spark, docs):
    kept = language_id.accept(docs.withColumn("lang", F.lit(None).cast("string")))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [4, 5, 5, 6, None, 9]))
