"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The corpus gives the count of every word. Words are parted into classes: each of the most frequent words has
its own, the others share classes by their hash. The log-bilinear model predicts a word's class from the
classes of the two tokens before it; within a class, words have the shares of their counts. Both factors are
normalised, so the score of a text is the log probability of a distribution over all words and one unseen.

Every training task fits a copy of the model on the texts it holds, starting from the same parameters; the
copies are averaged by their tokens. The normalisers of all contexts come from batched matrix products,
once, so scoring a token takes a few lookups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import broadcast_value, map_batches, named, release, row_keys
from linkloom.session import settle

END = b""              # the token after the last word; no word is empty
CLASSES = 512          # of which the first has the end, then the most frequent words
OWN = 384              # classes of one word each, the end included
WIDTH = 16             # length of the vectors
HEAD = 1 << 17         # most frequent words whose counts every task gets; all others are joined
ADDED = 0.1            # to every count


def tokens(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []  # bytes: only A-Z are lowered, only ASCII white space parts
    words.append(END)
    return words


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` over all texts (one column, ``text``), ends included; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in tokens(text):
                    counts[word] = counts.get(word, 0) + 1
            if len(counts) > 400_000:
                yield {"word": list(counts), "n": list(counts.values())}
                counts = {}
        yield {"word": list(counts), "n": list(counts.values())}

    return map_batches(texts, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Parameters:
    """C: what a class at each of two places before says; Q and b: what a class answers to."""

    context: np.ndarray   # (2, CLASSES, WIDTH)
    target: np.ndarray    # (CLASSES, WIDTH)
    bias: np.ndarray      # (CLASSES,)

    @staticmethod
    def new(share: np.ndarray, seed: int = 0) -> Parameters:
        draw = np.random.default_rng(seed)
        return Parameters(draw.normal(0, 0.1, (2, CLASSES, WIDTH)).astype(np.float32), draw.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32),
                          np.log(share).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.target.ravel(), self.bias])

    @staticmethod
    def from_flat(flat: np.ndarray) -> Parameters:
        context, target, bias = np.split(flat.astype(np.float32), [2 * CLASSES * WIDTH, 3 * CLASSES * WIDTH])
        return Parameters(context.reshape(2, CLASSES, WIDTH), target.reshape(CLASSES, WIDTH), bias)


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add values to the rows named, which may repeat."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    edges = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    into[ordered[edges]] += np.add.reduceat(values[order], edges, axis=0)


class Trainer:
    """Noise-contrastive estimation with AdaGrad; each batch shares its noise classes."""

    def __init__(self, parameters: Parameters, noise: np.ndarray, rate: float = 0.1, noises: int = 32, seed: int = 0):
        self.p, self.noise, self.rate, self.noises = parameters, noise, rate, noises
        self.log_noise = np.log(noise).astype(np.float32)
        self.cumulated = np.cumsum(noise)
        self.draw = np.random.default_rng(seed)
        self.squares = [np.full_like(x, 1e-3) for x in (parameters.context[0], parameters.context[1], parameters.target, parameters.bias)]

    def step(self, before: np.ndarray, last: np.ndarray, target: np.ndarray) -> float:
        """One batch of (class two before, class before, class); the loss per token."""
        p, k, n = self.p, self.noises, len(target)
        noise = np.searchsorted(self.cumulated, self.draw.random(k) * self.cumulated[-1]).clip(0, CLASSES - 1)
        state = p.context[0][before] + p.context[1][last]
        # the model tells data from k times as much noise: logit = score - log(k * noise probability)
        data = (state * p.target[target]).sum(1) + p.bias[target] - self.log_noise[target] - np.log(np.float32(k))
        other = state @ p.target[noise].T + p.bias[noise] - self.log_noise[noise] - np.log(np.float32(k))
        data_error = -1 / (1 + np.exp(np.minimum(data, 60)))          # d loss / d logit
        other_error = 1 / (1 + np.exp(np.minimum(-other, 60)))
        grad_state = data_error[:, None] * p.target[target] + other_error @ p.target[noise]
        g_target, g_bias = np.zeros_like(p.target), np.zeros_like(p.bias)
        _add_rows(g_target, target, data_error[:, None] * state)
        _add_rows(g_target, noise, other_error.T @ state)
        g_bias += np.bincount(target, data_error, CLASSES).astype(np.float32) + np.bincount(noise, other_error.sum(0), CLASSES).astype(np.float32)
        g_context = [np.zeros_like(p.target), np.zeros_like(p.target)]
        _add_rows(g_context[0], before, grad_state)
        _add_rows(g_context[1], last, grad_state)
        for value, grad, square in zip((p.context[0], p.context[1], p.target, p.bias), (*g_context, g_target, g_bias), self.squares):
            grad /= n
            square += grad * grad
            value -= self.rate * grad / np.sqrt(square)
        return float((np.log1p(np.exp(-np.clip(data, -60, 60))).sum() + np.log1p(np.exp(np.clip(other, -60, 60))).sum()) / n)


class Classes:
    """The class of a word: its own for frequent ones, else one by hash. CRC-32 is the same on every worker."""

    def __init__(self, frequent: list[bytes]):
        self.own = {word: k for k, word in enumerate([END, *(w for w in frequent if w != END)][:OWN])}

    def of(self, words: list[bytes]) -> np.ndarray:
        get, crc = self.own.get, zlib.crc32
        return np.array([c if (c := get(w)) is not None else OWN + crc(w) % (CLASSES - OWN) for w in words], np.int64)


def contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes of the two tokens before each; before the first word stands an end."""
    start = np.zeros(2, np.int64)
    padded = np.concatenate([start, classes])
    return padded[:-2], padded[1:-1]


def train(texts: DataFrame, frequent: list[bytes], class_tokens: np.ndarray, batch: int = 2048) -> Parameters:
    """One pass over all training texts (one column, ``text``): a copy a task, averaged by tokens.

    The sums are made of 2048 values at a time, so neither the shuffle nor the driver gets more than one
    model from each task and one in all.
    """
    share = (class_tokens + 1.0) / (class_tokens.sum() + CLASSES)
    start = Parameters.new(share)
    given = broadcast_value(texts, (frequent, share, start.flat()))
    size = len(start.flat())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words, noise, flat = given.value
        classes = Classes(words)
        trainer = Trainer(Parameters.from_flat(flat.copy()), noise)
        waiting, held, total = [], 0, 0
        for part in batches:
            for text in part.column(0).to_pylist():
                own = classes.of(tokens(text))
                waiting.append((*contexts(own), own))
                held += len(own)
                if held >= 16 * batch:
                    total += _feed(trainer, waiting, batch)
                    waiting, held = [], 0
        total += _feed(trainer, waiting, batch)
        if total:
            yield {"place": np.arange(size, dtype=np.int32), "value": trainer.p.flat().astype(np.float64) * total, "tokens": np.full(size, total)}

    copies = map_batches(texts, run, "place int, value double, tokens long")
    mean = copies.groupBy("place").agg((F.sum("value") / F.sum("tokens")).alias("value")).toPandas()
    flat = start.flat().astype(np.float64)
    flat[mean["place"]] = mean["value"]
    return Parameters.from_flat(flat)


def _feed(trainer: Trainer, waiting: list[tuple], batch: int) -> int:
    if not waiting:
        return 0
    before, last, target = (np.concatenate(x) for x in zip(*waiting))
    order = trainer.draw.permutation(len(target))
    for at in range(0, len(order), batch):
        chosen = order[at:at + batch]
        trainer.step(before[chosen], last[chosen], target[chosen])
    return len(target)


def normalisers(p: Parameters, block: int = 8) -> np.ndarray:
    """(CLASSES, CLASSES): the log of the sum over all classes for each pair of classes before."""
    made = np.empty((CLASSES, CLASSES), np.float32)
    for at in range(0, CLASSES, block):
        state = p.context[0][at:at + block, None, :] + p.context[1][None, :, :]
        scores = state.reshape(-1, WIDTH) @ p.target.T + p.bias
        top = scores.max(1)
        made[at:at + block] = (top + np.log(np.exp(scores - top[:, None]).sum(1))).reshape(-1, CLASSES)
    return made


@dataclass
class Model:
    frequent: list[bytes]
    head: dict[bytes, int]
    parameters: Parameters
    log_sums: np.ndarray
    class_total: np.ndarray   # tokens and words of each class, as counted
    class_words: np.ndarray
    tokens: int
    words: int

    def base(self) -> float:
        return float(np.log10(self.tokens + ADDED * (self.words + 1)))


def fit(training: DataFrame, text_column: str = "text", head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model, and the written counts of all words (``word``, ``n``)."""
    texts = training.select(named(text_column).cast("binary").alias("text"))
    counts = settle(count_words(texts), "word-counts")
    release(training.sparkSession)
    top = _most_frequent(counts, head)
    frequent = [w for w, _ in top[:OWN]]
    own = training.sparkSession.createDataFrame([(bytearray(w), k) for w, k in Classes(frequent).own.items()], "word binary, own int")
    # OWN rows, so the join is a lookup; classes by hash are those of the tasks, the same CRC-32
    by_class = counts.join(F.broadcast(own), "word", "left").select(
        "n", F.coalesce("own", (F.lit(OWN) + F.crc32("word") % (CLASSES - OWN)).cast("int")).alias("class"))
    totals = by_class.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toPandas()
    class_total, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    class_total[totals["class"]], class_words[totals["class"]] = totals["n"], totals["words"]
    parameters = train(texts, frequent, class_total)
    model = Model(frequent, dict(top), parameters, normalisers(parameters), class_total, class_words, int(class_total.sum()), int(class_words.sum()))
    return model, counts


def _most_frequent(counts: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``head``, by falling count.

    Counts fall into eighths of powers of two (some hundred classes); as many whole classes from the top are
    taken as fit. Only these words reach the driver, however many tasks there are.
    """
    level = F.floor(F.log2("n") * 8)
    sizes = sorted((r.level, r.words) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect())
    least, held = None, 0
    for at, words in reversed(sizes):
        if held + words > head:
            break
        least, held = at, held + words
    if least is None:
        return []
    found = counts.where(level >= least).collect()
    return sorted(((bytes(r.word), r.n) for r in found), key=lambda w: (-w[1], w[0]))


def score(df: DataFrame, model: Model, counts: DataFrame, text_column: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """``n_tokens``, ``n_known``, ``base_score``, ``score`` (log10) of every row, with what ``carry`` names.

    Null is an empty text: one end. Words beyond the head are looked up by a join with their counts; they are
    rare by definition, so no key of that join is hot. A word not seen in training has count zero, and in its
    class the share of one unseen word. Rows are named by keys written with the first pass, so repeated or
    missing ids do no harm.
    """
    carry, shared = carry or {}, broadcast_value(df, model)
    rows = df.select(named(text_column).cast("binary").alias("text"), F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("carried"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        m = shared.value
        classes, p, head, seen = Classes(m.frequent), m.parameters, m.head, 0
        log_class = np.log10(m.class_total + ADDED * (m.class_words + 1))
        for batch in batches:
            out: dict = {"n_tokens": [], "n_known": [], "sure": [], "model": [], "rare": [], "times": []}
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                own = classes.of(words)
                before, last = contexts(own)
                state = p.context[0][before] + p.context[1][last]
                logs = (state * p.target[own]).sum(1) + p.bias[own] - m.log_sums[before, last]
                known = np.array([head.get(w, 0) for w in words], np.float64)
                rare: dict[bytes, int] = {}
                for k in np.flatnonzero(known == 0).tolist():
                    rare[words[k]] = rare.get(words[k], 0) + 1
                sure = known > 0
                out["n_tokens"].append(len(words))
                out["n_known"].append(int(sure.sum()))
                out["sure"].append(float(np.log10(known[sure] + ADDED).sum()))
                out["model"].append(float(logs.sum(dtype=np.float64) / np.log(10) - log_class[own].sum()))
                out["rare"].append(list(rare))
                out["times"].append(list(rare.values()))
            yield out | {"row": row_keys(seen, batch.num_rows), "carried": batch.column(1)}
            seen += batch.num_rows

    schema = (f"row long, carried {rows.schema['carried'].dataType.simpleString()}, n_tokens long, n_known long, sure double, model double, "
              "rare array<binary>, times array<int>")
    first = settle(map_batches(rows, run, schema), "scores")
    rare = first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    looked = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADDED))).alias("more"))
    all_counts = F.col("sure") + F.coalesce("more", F.lit(0.0))
    return first.join(looked, "row", "left").select(
        *[F.col(f"carried.{k}").alias(k) for k in carry], "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (all_counts - F.col("n_tokens") * F.lit(model.base())).alias("base_score"),
        (F.col("model") + all_counts).alias("score"))
