"""Masked pseudo-likelihood of documents under a bidirectional window network trained with numpy.

The network predicts a token from the two tokens on either side: their embeddings, scaled by position, are added,
squashed, and read by a two-level softmax (class of the token, then token in the class). A document's score is the
sum, over its tokens, of the log-probability given both sides, each token hidden in its turn.

Tokens are lower-case words of the whole corpus: the most frequent have numbers of their own, the others share
``BUCKETS`` numbers by hash, so every word is predicted and none is left out. The probability of such a word is that of
its bucket, given both sides, times the word's share of the bucket: its count over the bucket's. Counts of all words are
kept as a table, which grows with the corpus and meets the documents by a join of (text, word); a word that was never
counted is taken to have occurred once.

Word counts and training cover every document. In each round every partition trains a copy of the network, from the
common weights, on a share of masked positions that differs by round, and the copies are averaged by the positions they
saw; together the rounds mask every position once. The weights have a fixed size; the averages are formed chunk by chunk in a shuffle, so what is gathered grows with
the number of partitions and no task holds more than a few chunks. So scores depend a little on how rows are dealt to
partitions, as averaged copies do.

Defined results: null, empty and wordless texts have no token, log-likelihood 0 and a null mean; a single token is
predicted from the text's ends alone; repeated rows count as often as they occur. On an empty table nothing is trained
and nothing returned. Columns named like the outputs are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .textnum import Words, column_bytes, slices

CLASSES = CLASS_SIZE = 32
VOCABULARY = CLASSES * CLASS_SIZE
BUCKETS = 96
WIDTH = 32
OFFSETS = (-2, -1, 1, 2)
BATCH = 8192
#: Each round masks, and learns, one position in so many of every text, so that all are learned.
ROUNDS = 2
RATE = 0.08
_CHUNK = 1 << 14

#: Letters, digits and all bytes beyond ASCII make words.
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def token_words(texts: list[bytes]) -> Words:
    return Words(texts, lower=True, separator=SEPARATOR)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def folded() -> tuple[np.ndarray, np.ndarray]:
        value, back = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
        return value, np.bincount(back, weights=np.concatenate([c for _, c in held])).astype(np.int64)

    for batch in batches:
        texts = column_bytes(batch.column(0))
        for a, b in slices(texts):
            held.append(np.unique(token_words(texts[a:b]).hash, return_counts=True))
            if len(held) >= 16:
                held[:] = [folded()]
    if held:
        value, count = folded()
        bucket = (value % np.uint64(BUCKETS)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(bucket), pa.array(count)], names=["word", "bucket", "n"])


class Vocabulary:
    """Sorted hashes of the frequent words and their numbers; number 0 is the end of the text.

    ``rare`` has the occurrences of all other words by bucket.
    """

    def __init__(self, words: np.ndarray, rare: np.ndarray | None = None):
        words = words.astype(np.uint64)
        self.rare = np.zeros(BUCKETS) if rare is None else rare
        self.order = np.argsort(words, kind="stable")
        self.known = words[self.order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        bucket = VOCABULARY - BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
        if not len(self.known):
            return bucket
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.order[at] + 1, bucket)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, bucket, n) of every word of all documents. Written once."""
    found = docs.select(F.col(text).alias("text")).mapInArrow(_counted, "word bigint, bucket int, n bigint")
    return common.written(found.groupBy("word", "bucket").agg(F.sum("n").alias("n")), "words")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The words that occur most often in all documents, ties by hash, and the occurrences of the others by bucket."""
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - BUCKETS - 1).collect()
    rare = np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        rare[r["bucket"]] = r["n"]
    for r in top:
        rare[r["bucket"]] -= r["n"]
    return Vocabulary(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64), rare)


SHAPES = {
    "embed": (VOCABULARY, WIDTH), "scale": (len(OFFSETS), WIDTH), "shift": (WIDTH,),
    "to_class": (WIDTH, CLASSES), "class_bias": (CLASSES,), "to_word": (CLASSES, WIDTH, CLASS_SIZE), "word_bias": (CLASSES, CLASS_SIZE),
}


def initial() -> dict[str, np.ndarray]:
    random = np.random.default_rng(7)
    out = {k: np.zeros(s, dtype=np.float32) for k, s in SHAPES.items()}
    for k in ("embed", "to_class", "to_word"):
        out[k] = random.normal(0, 0.1, SHAPES[k]).astype(np.float32)
    out["scale"] += 1
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k], at = values[at : at + size].reshape(shape).astype(np.float32), at + size
    return out


def contexts(numbers: np.ndarray, doc: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers of the tokens around the positions ``at``; 0 beyond the ends of the text."""
    own = doc[at]
    begin, end = first[own], first[own + 1]
    out = np.empty((len(at), len(OFFSETS)), dtype=np.int64)
    for k, offset in enumerate(OFFSETS):
        j = at + offset
        inside = (j >= begin) & (j < end)
        out[:, k] = np.where(inside, numbers[np.where(inside, j, at)], 0)
    return out


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of positions by the class of their target; in that order the class, the token in it, and where each class begins."""
    order = np.argsort((target // CLASS_SIZE).astype(np.uint8), kind="stable")
    group, word = np.divmod(target[order], CLASS_SIZE)
    return order, group, word, np.searchsorted(group, np.arange(CLASSES + 1))


def forward(w: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    """Hidden units, a row for each position."""
    scaled = w["embed"] * w["scale"][:, None, :]
    hidden = scaled[0][context[:, 0]]
    for k in range(1, len(OFFSETS)):
        hidden += scaled[k][context[:, k]]
    hidden += w["shift"]
    return np.tanh(hidden, out=hidden)


def _class_logits(w: dict[str, np.ndarray], hidden: np.ndarray) -> np.ndarray:
    """A column for each position, so that sums over the outcomes run along whole rows; so in ``_word_logits``."""
    return w["to_class"].T @ hidden.T + w["class_bias"][:, None]


def _word_logits(w: dict[str, np.ndarray], hidden: np.ndarray, edge: np.ndarray) -> np.ndarray:
    out = np.empty((CLASS_SIZE, len(hidden)), dtype=hidden.dtype)
    for k in range(CLASSES):
        rows = slice(edge[k], edge[k + 1])
        out[:, rows] = w["to_word"][k].T @ hidden[rows].T + w["word_bias"][k][:, None]
    return out


def _picked(logits: np.ndarray, outcome: np.ndarray) -> np.ndarray:
    """Log-probability of one outcome a column. The logits are used up."""
    logits -= logits.max(axis=0)
    own = logits[outcome, np.arange(len(outcome))]
    return own - np.log(np.exp(logits, out=logits).sum(axis=0))


def _errors(logits: np.ndarray, outcome: np.ndarray) -> np.ndarray:
    """Probabilities less 1 at the outcome, in the place of the logits."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    logits[outcome, np.arange(len(outcome))] -= 1
    return logits


def log_probabilities(w: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each target given its context."""
    order, group, word, edge = _by_class(target)
    hidden = forward(w, context[order])
    out = np.empty(len(target), dtype=hidden.dtype)
    out[order] = _picked(_class_logits(w, hidden), group) + _picked(_word_logits(w, hidden, edge), word)
    return out


def _sums_by_number(numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each token number."""
    order = np.argsort(numbers.astype(np.uint16), kind="stable")
    found = numbers[order]
    begin = np.flatnonzero(np.diff(found, prepend=-1))
    out = np.zeros((VOCABULARY, rows.shape[1]), dtype=rows.dtype)
    if len(begin):
        out[found[begin]] = np.add.reduceat(np.ascontiguousarray(rows[order].T), begin, axis=1).T
    return out


def gradients(w: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the summed negative log-probability."""
    order, group, word, edge = _by_class(target)
    context = context[order]
    hidden = forward(w, context)
    g = {k: np.zeros(s, dtype=np.float32) for k, s in SHAPES.items()}
    p = _errors(_class_logits(w, hidden), group)
    g["to_class"], g["class_bias"] = (p @ hidden).T, p.sum(axis=1)
    back = p.T @ w["to_class"].T
    q = _errors(_word_logits(w, hidden, edge), word)
    and_one = np.append(hidden, np.ones((len(hidden), 1), dtype=hidden.dtype), axis=1)
    for k in range(CLASSES):
        rows = slice(edge[k], edge[k + 1])
        both = q[:, rows] @ and_one[rows]
        g["to_word"][k], g["word_bias"][k] = both[:, :-1].T, both[:, -1]
        back[rows] += q[:, rows].T @ w["to_word"][k].T
    back *= 1 - hidden * hidden
    g["shift"] = back.sum(axis=0)
    for k in range(len(OFFSETS)):
        sums = _sums_by_number(context[:, k], back)
        g["embed"] += sums * w["scale"][k]
        g["scale"][k] = (w["embed"] * sums).sum(axis=0)
    return g


class Trainer:
    """Adagrad on batches of masked positions."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: v.copy() for k, v in weights.items()}
        self.squares = {k: np.full(s, 1e-6, dtype=np.float32) for k, s in SHAPES.items()}
        self.seen = 0

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        for k, g in gradients(self.w, context, target).items():
            g /= len(target)
            self.squares[k] += g * g
            self.w[k] -= RATE * g / np.sqrt(self.squares[k])
        self.seen += len(target)


def masked_positions(w: Words, turn: int, rounds: int) -> np.ndarray:
    """Positions whose place in their text is ``turn`` modulo ``rounds``."""
    return np.flatnonzero((np.arange(len(w.hash)) - w.first[w.doc]) % rounds == turn)


def _trained(shared, words: Vocabulary, turn: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(unflat(shared.value))
        for batch in batches:
            texts = column_bytes(batch.column(0))
            for a, b in slices(texts):
                w = token_words(texts[a:b])
                numbers = words.numbers(w.hash)
                masked = masked_positions(w, turn, rounds)
                for i in range(0, len(masked), BATCH):
                    at = masked[i : i + BATCH]
                    trainer.learn(contexts(numbers, w.doc, w.first, at), numbers[at])
        if not trainer.seen:
            return
        weighed = np.append(flat(trainer.w).astype(np.float64) * trainer.seen, trainer.seen)
        chunks = common.array_chunks(weighed, _CHUNK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in chunks], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(chunks), pa.int32()),
                pa.array([x for _, x in chunks], pa.binary()),
            ],
            names=["key", "salt", "data"],
        )

    return run


class Model:
    """Frequent words and weights, of fixed size, and the table of all word counts."""

    def __init__(self, words: Vocabulary, weights: np.ndarray, counts: DataFrame):
        self.words, self.weights, self.counts = words, weights, counts


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> Model:
    """Vocabulary and weights from all rows."""
    common.ship_package(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    counts = word_counts(docs, text)
    words, weights = vocabulary(counts), flat(initial())
    for turn in range(rounds):
        run = _trained(context.broadcast(weights), words, turn, rounds)
        sums = common.summed_arrays(docs.select(F.col(text).alias("text")).mapInArrow(run, "key int, salt int, data binary"))
        if sums:
            total = np.concatenate([sums[k] for k in sorted(sums)])
            weights = (total[:-1] / total[-1]).astype(np.float32)
    return Model(words, weights, counts)


def text_scores(texts: list[bytes], words: Vocabulary, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Token count and summed log-probability of each text, as if every rare word had occurred once in the corpus."""
    t = token_words(texts)
    numbers = words.numbers(t.hash)
    total = np.zeros(len(texts))
    for i in range(0, len(numbers), BATCH):
        at = np.arange(i, min(len(numbers), i + BATCH))
        lp = log_probabilities(w, contexts(numbers, t.doc, t.first, at), numbers[at])
        total += np.bincount(t.doc[at], weights=lp, minlength=len(texts))
    rare = numbers >= VOCABULARY - BUCKETS
    in_bucket = np.log(np.maximum(words.rare, 1))[numbers[rare] - (VOCABULARY - BUCKETS)]
    return t.count, total - np.bincount(t.doc[rare], weights=in_bucket, minlength=len(texts))


def _rare_words(shared):
    """(key, word, n) of the words without a number of their own, from (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(), column_bytes(batch.column(1))
            for a, b in slices(texts):
                t = token_words(texts[a:b])
                rare = shared.value.numbers(t.hash) >= VOCABULARY - BUCKETS
                key, word = keys[a:b][t.doc[rare]], t.hash[rare].view(np.int64)
                order = np.lexsort((word, key))
                key, word = key[order], word[order]
                first = np.flatnonzero(np.diff(key, prepend=~key[:1]).astype(bool) | np.diff(word, prepend=~word[:1]).astype(bool))
                n = np.diff(np.append(first, len(key)))
                yield pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(word[first]), pa.array(n, pa.int64())], names=["key", "word", "n"])

    return run


def rare_shares(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """(key, share): by hash of the text, the sum of log counts over its rare words. No text is shuffled here; ``score`` joins the result to its rows,
    so a caller with wide rows selects what it needs first.

    Words that occurred once add nothing and are left out of the join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.words)  # fixed size: frequent words
    keyed = docs.select(F.xxhash64(text).alias("key"), F.col(text).cast("string").alias("text"))
    found = keyed.mapInArrow(_rare_words(shared), "key bigint, word bigint, n bigint")
    logs = model.counts.filter("n > 1").select("word", F.log("n").alias("log_n"))
    sums = found.join(logs, "word").groupBy("key").agg(F.sum(F.col("n") * F.col("log_n")).alias("sum"))
    # equal texts have one key, and their words were counted once for each
    copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return sums.join(copies, "key").select("key", (F.col("sum") / F.col("copies")).alias("share"))


MADE = [T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType())]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``log_likelihood`` and ``mean_log_likelihood`` to every row."""
    common.ship_package(docs.sparkSession)
    made = [*(f.name for f in MADE), "mean_log_likelihood"]
    kept = docs.drop(*made)
    names = kept.columns
    at, key = names.index(text), "key_"
    while key in names:
        key += "_"
    kept = kept.withColumn(key, F.xxhash64(text))
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.weights))  # fixed size: frequent words and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value[0], unflat(shared.value[1])
        for batch in batches:
            texts = column_bytes(batch.column(at))
            found = [text_scores(texts[a:b], words, weights) for a, b in slices(texts)]
            if found:
                new = [pa.array(np.concatenate([n for n, _ in found]), pa.int64()), pa.array(np.concatenate([s for _, s in found]), pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *made[:2]])

    out = kept.mapInArrow(run, T.StructType([*kept.schema.fields, *MADE]))
    shares = rare_shares(docs, model, text).select(F.col("key").alias(key), F.col("share").alias(f"{key}share"))
    out = out.join(shares, key, "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce(f"{key}share", F.lit(0.0)))
    out = out.select(*names, *made[:2])
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs)).drop("text")
