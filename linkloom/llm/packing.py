"""Harmonic packing of documents into sequences of fixed capacity.

Class k holds pieces longer than capacity / (k + 1) and at most capacity / k, and each of its bins takes
exactly k pieces. A document is cut into whole sequences first. What is left is cut to the largest
harmonic length below it, capacity // k, where k such pieces fill a bin to within k - 1 ids, again and
again, until a short rest remains that goes whole to its class. Workers fill their bins alone: nothing
is shuffled, and no worker waits for another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_batches, named, partition_number

CAPACITY = 2048
END = 1
#: Up to here (the end of Latin Extended-B) both tokenizer libraries part texts alike.
LATIN = "ɏ"


class Tokens:
    """Token ids of texts with a public byte-level vocabulary.

    ``tokenizers`` gives the ids. Texts in Latin letters go through ``tiktoken`` with the same vocabulary as
    ranks, which gives the same ids several times faster. Special tokens' strings are ordinary text.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        self.vocabulary, self.ranks = vocabulary, ranks
        self._slow = self._fast = None

    def ids(self, text: str) -> list[int]:
        if self.ranks and (text.isascii() or max(text) <= LATIN):
            if self._fast is None:
                self._fast = _ranked(self.ranks)
            return self._fast.encode_ordinary(text)
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.vocabulary)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids


def _ranked(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(length: int, capacity: int = CAPACITY, shortest: int = 64) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document: whole sequences, harmonic cuts, a rest.

    A piece in class k has at most capacity // k ids. Rests of fewer than ``shortest`` are not cut further.
    """
    made = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        cut = capacity // (k + 1)
        if rest == capacity // k or rest < shortest:
            made.append((rest, k))
            break
        made.append((cut, k + 1))
        rest -= cut
    return made


class Bins:
    """The open bins of one worker, one for each class."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.open: dict[int, list] = {}
        self.closed: list[list] = []

    def add(self, piece: tuple, k: int) -> None:
        """``piece`` is (document, start, ids)."""
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            self.closed.append(self.open.pop(k))

    def finish(self) -> None:
        """Close what is open: the leftover pieces end to end, cut where a sequence is full.

        At most k - 1 pieces of each class are left, whatever the worker's share. The last sequence falls
        apart into powers of two, which need no padding.
        """
        left = [piece for k in sorted(self.open) for piece in self.open[k]]
        self.open = {}
        total = sum(len(ids) for _, _, ids in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        at = iter(left)
        document, start, ids = next(at, (None, 0, ()))
        for size in sizes:
            bin_ = []
            while size:
                if not len(ids):
                    document, start, ids = next(at)
                taken = ids[:size]
                bin_.append((document, start, taken))
                ids, start, size = ids[len(taken):], start + len(taken), size - len(taken)
            self.closed.append(bin_)

    def take(self) -> list[list]:
        done, self.closed = self.closed, []
        return done


def pack(df: DataFrame, text_column: str = "text", carry: dict[str, Column] | None = None, vocabulary: str | None = None,
         ranks: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, what
    ``carry`` names, and ``ids`` where asked for.

    A text's ids are followed by one end id. Null is an empty text: the end id alone. Pieces of a sequence
    lie end to end from offset 0; each id is in one piece. Sequence ids are unique: the worker's number
    above 33 bits of running number. The files named by ``vocabulary`` and ``ranks`` must be on every worker;
    by default they are those of the installed public tokenizers.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    carry = carry or {}
    rows = df.select(named(text_column).cast("string").alias("text"), F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("carried"))
    schema = (f"carried {rows.schema['carried'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + ", ids array<int>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokens, bins, made, base = Tokens(vocabulary, ranks), Bins(capacity), 0, partition_number() << 33
        carried_type = None

        def rows_of(done: list[list], first: int) -> dict:
            out: dict = {name: [] for name in ("carried", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for number, bin_ in enumerate(done, first):
                offset = 0
                for (carried, total), start, ids in bin_:
                    out["carried"].append(carried)
                    out["start"].append(start)
                    out["length"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    out["doc_tokens"].append(total)
                    out["sequence_id"].append(base + number)
                    out["offset"].append(offset)
                    if with_ids:
                        out["ids"].append(ids.astype(np.int32))
                    offset += len(ids)
            return out | {"carried": pa.array(out["carried"], carried_type)}

        for batch in batches:
            carried_type = batch.column(1).type
            for text, carried in zip(batch.column(0), batch.column(1).to_pylist()):
                ids = np.array([*tokens.ids(text.as_py() or ""), END], "<u4")
                document, start = (carried, len(ids)), 0
                for length, k in pieces(len(ids), capacity):
                    bins.add((document, start, ids[start:start + length]), k)
                    start += length
                if len(bins.closed) >= 1024:
                    done = bins.take()
                    yield rows_of(done, made)
                    made += len(done)
        if carried_type is not None:
            bins.finish()
            yield rows_of(bins.take(), made)

    return map_batches(rows, run, schema).select(
        *[F.col(f"carried.{k}").alias(k) for k in carry], "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        *["ids"] * with_ids)
