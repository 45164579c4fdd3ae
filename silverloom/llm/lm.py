"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Word counts cover all training documents. The model predicts the class of the next token
from the two before it. The most frequent words are classes of their own; the next most
frequent ones are grouped by spelling, so that words of one language or ending are a class;
all others are one class. Within a class the smoothed counts decide. The vector predicted for the next class
is the sum of the context words' vectors, each weighted by its position; its product with
the class vectors, plus a bias, is the score. Each task trains on its own documents by
noise-contrastive estimation in numpy, and the tasks' weights are averaged. For scoring,
batched matrix products normalise the scores of all contexts once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import map_texts, materialised

#: Words that are classes of their own, and the length of the vectors.
CLASSES, WIDTH = 512, 24
#: Held words of a spelling class at least, and spelling classes at most; numbers that describe a spelling, and rounds of grouping.
MEMBERS, SPELLINGS, TRAITS, ROUNDS = 64, 192, 64, 8
#: Words whose counts every task holds; a bound of the broadcast. The others' counts are joined.
HELD = 1 << 17
#: The end of a text as a token: white space, so no word is like it.
END = b"\n"
#: Tokens of a training step, noise samples of a step, and the learning rate.
STEP, NOISE, RATE = 4096, 64, 0.05
#: Counts that a task gathers before it hands them on; a bound of memory.
GATHER = 1_000_000


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased, then one end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n) over all rows; null texts have only an end. Summed in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.binary()), pa.array(sums.values(), pa.int64())], names=["word", "n"])
            sums.clear()
            return batch

        for b in batches:
            for t in b.column(0).to_pylist():
                sums.update(tokens(t or ""))
                if len(sums) > GATHER:
                    yield out()
        yield out()

    return df.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HELD) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, in order: `most` of them, or all if there are fewer.

    Counts are put in steps of about one in a hundred; whole steps are taken while they fit, then the first
    words of the next one. Neither the few thousand sums of the steps nor the words that the driver gets
    grow with the input.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    sums = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    taken, whole, part = 0, [], None
    for s, n in sums:
        if taken + n > most:
            part = s
            break
        taken, whole = taken + n, [*whole, s]
    rows = counts.where(step >= min(whole)).select("word", "n").collect() if whole else []
    if part is not None and taken < most:
        rows += counts.where(step == part).select("word", "n").orderBy(F.desc("n"), "word").limit(most - taken).collect()
    return sorted(((bytes(w), int(n)) for w, n in rows), key=lambda r: (-r[1], r[0]))


def spelling(words: list[bytes]) -> np.ndarray:
    """What pairs of neighbouring bytes each word has, its ends counted as spaces: a row of TRAITS numbers of length 1."""
    size = np.asarray([len(w) + 2 for w in words], np.int64)
    buf = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8).astype(np.int64)
    word = np.repeat(np.arange(len(words)), size)
    same = word[1:] == word[:-1]
    pair = (buf[:-1] * 256 + buf[1:])[same] * 40503 % 65536 * TRAITS // 65536
    found = np.bincount(word[:-1][same] * TRAITS + pair, minlength=len(words) * TRAITS).astype(np.float32).reshape(-1, TRAITS)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def grouped(words: list[bytes]) -> np.ndarray:
    """A group of each word, by the means of their spellings; a group for each MEMBERS words, SPELLINGS at most."""
    n = min(SPELLINGS, len(words) // MEMBERS)
    if n < 2:
        return np.zeros(len(words), np.int64)
    x = spelling(words)
    rng, first = np.random.default_rng(7), []
    far = np.ones(len(words))
    for _ in range(n):  # a word is the likelier to start a group, the less it is like those that do
        first.append(int(rng.choice(len(words), p=far / far.sum())) if far.any() else 0)
        far = np.minimum(far, np.maximum(0, 1 - x @ x[first[-1]].astype(np.float64)) ** 2)
    means = x[first]
    for _ in range(ROUNDS):
        group = (x @ means.T).argmax(axis=1)
        means = np.stack([np.bincount(group, x[:, t], n) for t in range(TRAITS)], axis=1).astype(np.float32)
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    return np.unique(group, return_inverse=True)[1]


@dataclass
class Classes:
    """Classes of the held words: `of` each word, how likely each class is, and the log10 share of one count in it; the last class is all other words'."""

    of: np.ndarray
    share: np.ndarray
    one: np.ndarray

    @classmethod
    def made(cls, top: list[tuple[bytes, int]], total: int, distinct: int) -> Classes:
        """Of the held words in order, the number of training tokens and of distinct ones; one count is for what is unknown."""
        n = np.asarray([n for _, n in top], np.int64)
        of = np.arange(len(top))
        if len(top) > CLASSES:
            of[CLASSES:] = CLASSES + grouped([w for w, _ in top[CLASSES:]])
        k = int(of.max(initial=-1)) + 1
        mass = np.bincount(of, n + 1, k)
        rest = max(1, total + distinct + 1 - mass.sum())
        share = np.append(np.bincount(of, n + (of < CLASSES), k), max(1, total - n.sum()))
        one = -np.log10(np.append(mass, rest))
        return cls(of, share / share.sum(), one)


@dataclass
class Model:
    """Weights of the model; contexts are classes, then 'before the start'."""

    context: np.ndarray  # (classes + 2) x width
    place: np.ndarray  # 2 x width: how the last and the last but one word count
    target: np.ndarray  # (classes + 1) x width
    bias: np.ndarray  # classes + 1

    @classmethod
    def start(cls, share: np.ndarray, width: int = WIDTH) -> Model:
        """The unigram model with small random vectors."""
        rng = np.random.default_rng(11)
        k = len(share)
        return cls(rng.normal(0, 0.1, (k + 1, width)), np.ones((2, width)), rng.normal(0, 0.1, (k, width)), np.log(share))

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.place[0] * self.context[one] + self.place[1] * self.context[two]

    def log_totals(self) -> np.ndarray:
        """ln of the sum over all classes, for each pair (last word, last but one)."""
        n = len(self.context)
        out = np.empty((n, n))
        for i in range(n):
            s = self.predicted(np.full(n, i), np.arange(n)) @ self.target.T + self.bias
            top = s.max(axis=1)
            out[i] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.place, self.target, self.bias)])

    def filled(self, flat: np.ndarray) -> Model:
        parts, at = [], 0
        for x in (self.context, self.place, self.target, self.bias):
            parts.append(flat[at : at + x.size].reshape(x.shape))
            at += x.size
        return Model(*parts)


def _spread(ids: np.ndarray, grad: np.ndarray, n: int) -> np.ndarray:
    """Sums of the gradient rows of each id."""
    out = np.zeros((n, grad.shape[1]), grad.dtype)
    order = np.argsort(ids.astype(np.uint16) if n <= 1 << 16 else ids, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) > 0]))
    out[ids[order][first]] = np.add.reduceat(grad[order], first, axis=0)
    return out


def train_step(m: Model, squares: list[np.ndarray], one: np.ndarray, two: np.ndarray, word: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> None:
    """One step of noise-contrastive estimation with shared noise samples and adaptive rates, in the weights' precision."""
    last, target, samples = m.context[one], m.target[word], m.target[noise]
    before = m.context[two]
    q = m.place[0] * last + m.place[1] * before
    shift = m.bias - log_noise - math.log(len(noise))
    good = np.einsum("ij,ij->i", q, target) + shift[word]
    bad = q @ samples.T
    bad += shift[noise]
    d_good = 1 / (1 + np.exp(np.clip(good, -30, 30)))
    np.clip(bad, -30, 30, out=bad)
    np.exp(np.negative(bad, out=bad), out=bad)
    bad += 1
    d_bad = np.divide(-1, bad, out=bad)
    dq = d_good[:, None] * target + d_bad @ samples
    n = len(m.bias)
    g_target = _spread(word, d_good[:, None] * q, n) + _spread(noise, d_bad.T @ q, n)
    g_bias = np.bincount(word, d_good, n) + np.bincount(noise, d_bad.sum(axis=0), n)
    g_context = _spread(one, dq * m.place[0], n + 1) + _spread(two, dq * m.place[1], n + 1)
    g_place = np.stack([np.einsum("ij,ij->j", dq, last), np.einsum("ij,ij->j", dq, before)])
    for w, g, s in zip((m.context, m.place, m.target, m.bias), (g_context, g_place, g_target, g_bias), squares, strict=True):
        s += g * g
        w += RATE * g / np.sqrt(s + 1e-8)


def classed(texts: list[str], classes: dict[bytes, int], other: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens of the texts, and of the last and the last but one token before each."""
    start = other + 1
    one, two, word = [], [], []
    for t in texts:
        ids = [classes.get(w, other) for w in tokens(t)]
        word += ids
        one += [start, *ids[:-1]]
        two += [start, start, *ids[:-2]][: len(ids)]
    return tuple(np.asarray(x, np.int64) for x in (word, one, two))


def train(df: DataFrame, classes: dict[bytes, int], share: np.ndarray, text_col: str = "text") -> Model:
    """The model after one pass over all rows of df: the tasks' weights averaged by their tokens.

    Each task hands on one row for each weight; Spark sums them, and the driver gets as many
    numbers as the model has weights, whatever the input.
    """
    first = Model.start(share)
    log_noise = np.log(share).astype(np.float32)
    shared = df.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = first.filled(first.flat().astype(np.float32))
        squares = [np.full_like(x, 1.0) for x in (m.context, m.place, m.target, m.bias)]
        rng, seen = np.random.default_rng(5), 0
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for at in range(0, len(texts), 512):
                word, one, two = classed(texts[at : at + 512], shared.value, len(share) - 1)
                order = rng.permutation(len(word))
                for lo in range(0, len(word), STEP):
                    s = order[lo : lo + STEP]
                    train_step(m, squares, one[s], two[s], word[s], rng.choice(len(share), NOISE, p=share), log_noise)
                seen += len(word)
        if seen:
            w = m.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w))), pa.array(w * seen), pa.array(np.full(len(w), float(seen)))], names=["i", "w", "n"])

    if len(share) < 2:
        return first
    sums = df.select(text_col).mapInArrow(run, "i long, w double, n double").groupBy("i").agg(F.sum("w").alias("w"), F.sum("n").alias("n"))
    got = sums.select("i", (F.col("w") / F.col("n")).alias("w")).toPandas()
    flat = first.flat()
    flat[got["i"].to_numpy()] = got["w"].to_numpy()
    return first.filled(flat)


def score(df: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, trained, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows where `training` is true are learned from; a null condition counts as false. Scores
    are log10 probabilities of the whole text with its end. base_score uses counts c smoothed
    as (c+1)/(N+V+1). A null or empty text is its end alone. Without training rows every word
    is unknown. Repeated rows are scored each; extra columns are ignored.

    Frequent words' counts are broadcast (at most HELD); the rare words of each row go through
    one join with the counts and are summed by row. More than HELD words are as frequent as any
    word left out (within a hundredth), so none has more than about a 1/HELD share: no key is hot.
    """
    rows = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(training, F.lit(False)).alias("trained")
    )
    counts = materialised(word_counts(rows.where("trained")))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bottom = total + distinct + 1
    top = frequent(counts)
    words, classes = {w: i for i, (w, _) in enumerate(top)}, Classes.made(top, total, distinct)
    k = len(classes.share) - 1
    model = train(rows.where("trained"), dict(zip(words, classes.of.tolist())), classes.share)
    shared = df.sparkSession.sparkContext.broadcast(
        (model, model.log_totals(), words, np.append(classes.of, k), np.log10([*(n + 1 for _, n in top), bottom]), classes.one)
    )

    def parts(texts: list[str]) -> tuple[list[int], list]:
        m, totals, known, class_of, logs, share = shared.value
        words = [tokens(t) for t in texts]
        sizes = np.asarray([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)
        at = np.fromiter((known.get(w, -1) for ws in words for w in ws), np.int64, int(sizes.sum()))
        cls = class_of[at]  # words that aren't held are -1: the last
        one = np.concatenate([[k + 1], cls[:-1]]) if len(cls) else cls
        first = ends - sizes
        one[first] = k + 1
        two = np.concatenate([[k + 1], one[:-1]]) if len(cls) else cls
        two[first] = k + 1
        ln = np.empty(len(cls))
        for lo in range(0, len(cls), 200_000):
            s = slice(lo, lo + 200_000)
            ln[s] = (m.predicted(one[s], two[s]) * m.target[cls[s]]).sum(axis=1) + m.bias[cls[s]] - totals[one[s], two[s]]
        held = at >= 0
        base = np.where(held, logs[at] - math.log10(bottom), 0.0)
        within = logs[at] + share[cls]
        sums = [np.bincount(doc, x, len(texts)) for x in (held, base, ln / np.log(10) + within)]
        at_rows = list(range(len(texts)))
        columns = [[None] * len(texts), [0] * len(texts), sizes.tolist(), sums[0].astype(np.int64).tolist(), sums[1].tolist(), sums[2].tolist()]
        rare = np.flatnonzero(~held)
        rare_words: dict[tuple[int, bytes], int] = {}
        for i in rare.tolist():
            d = int(doc[i])
            key = (d, words[d][i - int(first[d])])
            rare_words[key] = rare_words.get(key, 0) + 1
        for (d, w), n in rare_words.items():
            at_rows.append(d)
            for c, v in zip(columns, (w, n, 0, 0, 0.0, 0.0)):
                c.append(v)
        return at_rows, columns

    fields = {"word": "binary", "times": "long", "n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    found = map_texts(numbered, ["row", "id", "trained"], "text", fields, parts)
    own = F.coalesce("word", F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary"))  # matches no word, deals rows evenly
    found = found.withColumn("word", own).join(counts.withColumnRenamed("n", "c"), "word", "left")
    rare = F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - F.lit(float(np.log10(bottom))))
    out = found.groupBy("row", "id", "trained").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.sum(F.col("base_score") + rare).alias("base_score"),
        F.sum(F.col("score") + rare).alias("score"),
    )
    return out.drop("row").withColumnRenamed("id", id_col)
