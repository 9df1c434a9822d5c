"""Language identification as a mixture of languages.

Every language has a table of n-gram probabilities. A document is a mixture of languages: expectation
maximisation finds the proportions under which its n-grams are likeliest, then languages are dropped
while the likelihood, less a charge for each language kept, does not fall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import broadcast_value, map_batches, named, texts

UNDETERMINED = "und"
BITS = 15          # n-grams are counted in 2**BITS buckets for each language
BUCKETS = 1 << BITS
SMOOTHING = 0.5    # added to each bucket's count
LETTER = regex.compile(r"\p{L}")

_SEPARATE = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


def ngram_buckets(text: bytes) -> np.ndarray:
    """Buckets of the 4-byte windows of the lower-cased text; runs of other than letters count as one space.

    A text whose only letter is one of a to z has one window, filled up with a space.
    """
    data = text.decode("utf-8", "replace").lower().encode().translate(_SEPARATE)
    words = data.split()
    if not words:
        return np.empty(0, np.uint32)
    data = (b" " + b" ".join(words) + b" ").ljust(4)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    return (window * np.uint32(2654435761)) >> np.uint32(32 - BITS)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order of their names; probabilities[l, b] of bucket b in language l."""

    languages: list[str]
    probabilities: np.ndarray


def fit(labelled: DataFrame, text_column: str = "text", language_column: str = "lang",
        max_languages: int = 256) -> LanguageModel:
    """Count the n-grams of every labelled text by language.

    Counts are added up inside a task before they are shuffled, so a language that holds most rows
    costs no more than another. The model has languages x 2**15 numbers. The charge of more than
    ``max_languages`` different labels is an error, not a cut: the model is broadcast.

    Rows without text or label teach nothing; without labelled rows the model has no language.
    """
    rows = labelled.select(named(language_column).cast("string").alias("lang"), named(text_column).cast("binary").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = totals.get(lang)
                if total is None:
                    total = totals[lang] = np.zeros(BUCKETS, np.int64)
                total += np.bincount(ngram_buckets(text), minlength=BUCKETS)
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            yield {"lang": [lang] * len(seen), "bucket": seen.astype(np.int32), "n": total[seen]}

    counts = map_batches(rows, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # languages x buckets rows at most; one row more than allowed shows that there are too many labels
    found = counts.limit(max_languages * BUCKETS + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > max_languages:
        raise ValueError(f"{len(languages)} languages; raise max_languages to allow a larger model")
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    if languages:
        np.add.at(table, (np.searchsorted(languages, found["lang"]), found["bucket"]), found["n"])
        table /= table.sum(1, keepdims=True)
    return LanguageModel(languages, table.astype(np.float32))


def _improve(p: np.ndarray, counts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Expectation maximisation of the proportions; the log likelihood of the result."""
    total = counts.sum()
    for _ in range(rounds):
        old, share = share, share * (p @ (counts / (share @ p))) / total
        if np.abs(share - old).max() < 1e-3:
            break
    return share, float(counts @ np.log(share @ p))


def mixture(model: LanguageModel, text: bytes, rounds: int = 30, charge: float = 4.0) -> dict[int, float]:
    """The languages of a text and their proportions, by number in the model; empty without n-grams.

    A language stays if leaving it out costs more than ``charge`` times half the logarithm of the number
    of windows (they overlap, so one letter counts up to four times).
    """
    counts = np.bincount(ngram_buckets(text), minlength=BUCKETS)
    seen = np.flatnonzero(counts)
    if not len(seen) or not model.languages:
        return {}
    counts = counts[seen].astype(np.float32)
    p = model.probabilities[:, seen]
    kept = np.arange(len(p))
    share, best = _improve(p, counts, np.full(len(p), 1 / len(p), np.float32), rounds)
    price = charge * 0.5 * np.log(counts.sum() + 1)
    while len(kept) > 1:
        weakest = int(np.argmin(share))
        rest = np.delete(kept, weakest)
        start = np.delete(share, weakest)
        start = start / start.sum() if start.sum() > 0 else np.full(len(rest), 1 / len(rest), np.float32)
        fewer, value = _improve(p[rest], counts, start, rounds)
        if value + price < best:
            break
        kept, share, best = rest, fewer, value
    return dict(zip(kept.tolist(), share.tolist()))


def predict(df: DataFrame, model: LanguageModel, text_column: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """``lang_pred``, ``score`` and ``languages`` (every language kept, largest first) for each row.

    The text is the only input; ``carry`` names columns to pass through. A text that is null or has no
    letter, and any text when the model knows no language, is ``und`` with score 0. The score is the
    proportion of the predicted language in the mixture; equal proportions go to the first name.
    """
    spark_model = broadcast_value(df, model)
    carry = carry or {}
    rows = df.select(named(text_column).cast("binary").alias("text"), F.struct(*[v.alias(k) for k, v in carry.items()]).alias("carried"))
    schema = f"carried {rows.schema['carried'].dataType.simpleString()}, lang_pred string, score double, languages array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = spark_model.value
        for batch in batches:
            names, scores, sets = [], [], []
            for text in batch.column(0).to_pylist():
                found = {}
                if text is not None and LETTER.search(text.decode("utf-8", "replace")):
                    found = mixture(known, text)
                order = sorted(found, key=lambda k: (-found[k], k))
                names.append(known.languages[order[0]] if order else UNDETERMINED)
                scores.append(min(1.0, found[order[0]]) if order else 0.0)
                sets.append([known.languages[k] for k in order])
            yield {"carried": batch.column(1), "lang_pred": names, "score": scores, "languages": sets}

    return map_batches(rows, run, schema).select("carried.*", "lang_pred", "score", "languages")
