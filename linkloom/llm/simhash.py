"""Near duplicates by SimHash, compared bit-sliced.

Fingerprints are gathered into buckets that agree in some of their bits, so that any two fingerprints
within the radius share a bucket. Inside a bucket the members' bits stand in vertical planes, 64 members
to a word; the distance of one fingerprint to 64 others is counted with carry-save adders, and a word
is abandoned as soon as all its members are too far. A bucket gives a spanning forest of its links,
never all pairs. The forests are joined to components by alternating star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_batches, row_keys, texts
from linkloom.session import settle

SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ONE = np.uint64(1)


def fingerprint(text: bytes | None, words_in_shingle: int = 4) -> int:
    """64 bits: bit k is one if it is set in over half the hashes of the text's shingles."""
    words = text.lower().split() if text else []  # bytes: only A-Z are lowered, only ASCII white space parts
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= words_in_shingle:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-words_in_shingle].tolist()]
    stops = (ends[words_in_shingle - 1:] - 1).tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row`` (a key of the row), ``id`` and ``fingerprint`` (signed long) of every row. Null text: no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen = 0
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield {"row": row_keys(seen, len(prints)), "id": batch.column(0), "fingerprint": prints}
            seen += len(prints)

    source = texts(df, id_column, text_column)
    return map_batches(source, run, f"row long, id {source.schema['id'].dataType.simpleString()}, fingerprint long")


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks for buckets: fingerprints within ``radius`` agree in at least ``blocks - radius`` whole blocks."""
    if not radius < blocks <= 64:
        raise ValueError("there must be more blocks than bits that may differ")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - 1) & ~((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def bit_planes(members: np.ndarray) -> np.ndarray:
    """(64, words) planes of up to 64 x words fingerprints; member j is bit j % 64 of word j // 64."""
    words = -(-len(members) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:len(members)] = members
    bits = np.unpackbits(padded.view(np.uint8).reshape(words, 64, 8), axis=2, bitorder="little")  # word, member, bit
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(64, words)


def within(planes: np.ndarray, allowed: np.ndarray, queries: np.ndarray, word_of: np.ndarray, radius: int,
           every: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Compare query ``i`` with those of the 64 members of word ``word_of[i]`` that ``allowed[i]`` has.

    Returns which comparisons have a member within the radius, and the mask of those members. Three
    carry-save counters hold the low bits of the 64 distances; what leaves them, or passes the radius,
    is marked as too far. Every few planes, words with no member left are abandoned.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the counters hold distances up to 7")
    live = np.arange(len(queries))
    ones, twos, fours = (np.zeros(len(queries), np.uint64) for _ in range(3))
    near = allowed.copy()
    for k in range(0, 64, 2):
        a, b = (planes[j][word_of] ^ (np.uint64(0) - ((queries >> np.uint64(j)) & _ONE)) for j in (k, k + 1))
        half = ones ^ a
        carry = (ones & a) | (half & b)
        ones = half ^ b
        carry, twos = twos & carry, twos ^ carry
        carry, fours = fours & carry, fours ^ carry
        near &= ~(carry | _over(ones, twos, fours, radius))
        if (k + 2) % every == 0:
            kept = near != 0
            if not kept.all():
                live, ones, twos, fours, near, queries, word_of = (
                    x[kept] for x in (live, ones, twos, fours, near, queries, word_of))
                if not len(live):
                    break
    return live, near


def _over(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Members whose three-bit count is greater than the radius."""
    over, same = np.zeros_like(ones), np.full_like(ones, _ALL)
    for bit, plane in ((2, fours), (1, twos), (0, ones)):
        if radius >> bit & 1:
            same = same & plane
        else:
            over = over | (same & plane)
            same = same & ~plane
    return over


def links(bucket: np.ndarray, members: np.ndarray, side: np.ndarray, radius: int,
          step: int = 1 << 15) -> list[tuple[int, int]]:
    """(fingerprint, smaller fingerprint) links that connect whatever is linked inside each bucket.

    ``bucket`` is sorted. In a bucket dealt out in parts, ``side`` has both values and members are
    compared across the sides only. A group of n gives n - 1 links.
    """
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(bucket)]))
    split = np.logical_and(*(np.bincount(number, side == s, len(starts)) > 0 for s in (0, 1)))[number]
    is_lane, is_asked = ~split | (side == 1), ~split | (side == 0)

    lanes = np.bincount(number[is_lane], minlength=len(starts))
    words = -(-lanes // 64)
    first_word = np.r_[0, np.cumsum(words)]
    rank = np.cumsum(is_lane) - 1
    rank = rank - np.r_[0, np.cumsum(lanes)][number]
    place = first_word[number] * 64 + rank
    padded, used = np.zeros(first_word[-1] * 64, np.uint64), np.zeros(first_word[-1] * 64, bool)
    padded[place[is_lane]] = members[is_lane]
    used[place[is_lane]] = True
    planes = bit_planes(padded)
    valid = np.packbits(used, bitorder="little").view("<u8")

    asked = np.flatnonzero(is_asked)
    each = words[number[asked]]
    ends = np.cumsum(each)
    trees = _Trees(members, padded)
    at = 0
    while at < len(asked):  # a part of the asked rows whose comparisons fit the step
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right")))
        part, count = asked[at:to], each[at:to]
        row = np.repeat(part, count)
        word = first_word[number[row]] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        allowed = valid[word]
        mine = ~split[row] & (place[row] // 64 == word)  # a member is not compared with itself
        allowed[mine] &= ~(_ONE << (place[row[mine]] % 64).astype(np.uint64))
        live, near = within(planes, allowed, members[row], word, radius)
        trees.add(row[live].tolist(), word[live].tolist(), near.tolist())
        at = to
    return trees.links()


class _Trees:
    """Union of the links of a batch of buckets. Each member's lane is looked at once, then by group."""

    def __init__(self, members: np.ndarray, padded: np.ndarray):
        self.members, self.padded = members, padded
        self.parent: dict[int, int] = {}
        self.seen: dict[int, dict[int, int]] = {}  # word -> group's root -> mask of its lanes

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def add(self, rows: list[int], words: list[int], masks: list[int]) -> None:
        for row, word, mask in zip(rows, words, masks):
            mine = self.root(int(self.members[row]))
            groups = self.seen.setdefault(word, {})
            merged = mask
            for other in [g for g, lanes in groups.items() if lanes & mask]:
                lanes = groups.pop(other)
                merged |= lanes
                mask &= ~lanes
                mine = self._join(mine, other)
            while mask:  # lanes nobody has linked to yet
                low = mask & -mask
                mine = self._join(mine, int(self.padded[word * 64 + low.bit_length() - 1]))
                mask ^= low
            groups[mine] = groups.get(mine, 0) | merged

    def _join(self, x: int, y: int) -> int:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return min(x, y)

    def links(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.parent) if (r := self.root(x)) != x]


def near_links(prints: DataFrame, radius: int = 4, blocks: int = 6, bucket_rows: int = 4096) -> DataFrame:
    """``src``, ``dst``: links that connect all distinct fingerprints (one column, ``fingerprint``) within the radius.

    With b blocks, buckets agree in b - radius of them: 6 blocks give 15 tables with keys of 21 bits; more
    blocks give longer keys and more tables (7: 35 tables of 27 bits), which pays beyond some hundred
    million distinct fingerprints. A bucket of over ``bucket_rows`` members is dealt out in parts, each
    pair of parts compared in a task of its own, so none outgrows a task and no pair is lost.
    """
    masks = [mask - (1 << 64) if mask >> 63 else mask for mask in block_masks(radius, blocks)]
    keyed = prints.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(k).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("key"))
        for k, mask in enumerate(masks)])).alias("b")).select("b.table", "b.key", "fingerprint")
    large = settle(
        keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
        .select("table", "key", F.ceil(F.col("n") / (bucket_rows // 2)).cast("int").alias("parts")), "large-buckets")
    dealt = keyed.join(large, ["table", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    dealt = dealt.select("table", "key", "part", "fingerprint", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cells = dealt.select(
        "table", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "fingerprint")
    order = ["table", "key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for columns in _whole_buckets(batches):
            bucket = columns[0]
            found = links(bucket, columns[2].view(np.uint64), columns[1], radius)
            if found:
                pairs = np.array(found, np.uint64).view(np.int64)
                yield {"src": pairs[:, 0], "dst": pairs[:, 1]}

    source = cells.repartition(*order).sortWithinPartitions(*order)
    return map_batches(source, run, "src long, dst long").distinct()


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket number, side, fingerprint) of whole buckets of two and more, some thousand rows at a time."""
    rest = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])) + 1
        last = int(change[-1]) if len(change) else 0
        if last:
            yield from _pairs(columns, change[:-1], last)
        rest = [c[last:] for c in columns]
    if rest is not None and len(rest[0]):
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in rest[:4]])) + 1
        yield from _pairs(rest, change, len(rest[0]))


def _pairs(columns: list[np.ndarray], change: np.ndarray, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    sizes = np.diff(np.r_[0, change, end])
    number = np.repeat(np.arange(len(sizes)), sizes)
    kept = sizes[number] > 1
    if kept.any():
        yield number[kept], columns[4][:end][kept], columns[5][:end][kept]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``vertex``, ``root``: the least vertex reachable, for every vertex of ``src``, ``dst`` that is not the least.

    Large-star and small-star steps in turn, each round written to the shared folder, until nothing
    changes; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = settle(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src != dst"), "links")
    before = None
    for _ in range(most_rounds):
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first()
        if now == before:
            return edges.select(F.col("src").alias("vertex"), F.col("dst").alias("root"))
        before = now
        edges = settle(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("least"))
    joined = both.join(least, "src").where("dst > src")
    return joined.select(F.col("dst").alias("src"), F.col("least").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("least"))
    moved = down.join(least, "src").where("dst != least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.union(least.select("src", F.col("least").alias("dst"))).distinct()


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 4,
                    blocks: int = 6, bucket_rows: int = 4096) -> DataFrame:
    """``row``, ``id``, ``fingerprint`` (signed long) and ``component`` of every row.

    The component is the smallest id reachable over links of ``radius`` differing bits or fewer. Equal
    fingerprints are one vertex, so copies, however many, are never compared with each other. Texts
    without words (null or empty ones too) have fingerprint zero and are linked like any other. Rows may
    repeat and ids may be null: a component whose ids are all null has a null component.
    """
    prints = settle(fingerprints(df, id_column, text_column), "fingerprints")
    vertices = settle(prints.groupBy("fingerprint").agg(F.min("id").alias("id")), "vertices")
    roots = components(near_links(vertices.select("fingerprint"), radius, blocks, bucket_rows))
    rooted = vertices.join(roots, vertices.fingerprint == roots.vertex, "left").select(
        "fingerprint", "id", F.coalesce("root", "fingerprint").alias("root"))
    named_roots = rooted.groupBy("root").agg(F.min("id").alias("component"))
    labels = settle(rooted.join(named_roots, "root").select("fingerprint", "component"), "components")
    return prints.join(labels, "fingerprint").select("row", "id", "fingerprint", "component")


def one_of_each(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 4) -> DataFrame:
    """The input with one row of each component: that with the least id, then the first as read. Columns stay.

    The rows are written with their keys once; the choice is made on keys, ids and fingerprints alone,
    each task keeping its best row of a component before the shuffle.
    """
    taken = {c.lower() for c in df.columns}
    key = next(name for name in (f"row_{k}" for k in range(len(taken) + 1)) if name not in taken)
    rows = settle(df.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.struct(id_column, key).alias("id"), F.col(text_column).alias("text")), "id", "text", radius)
    kept = found.groupBy("component").agg(F.lit(1)).select(F.col(f"component.{key}").alias(key))
    return rows.join(kept, key, "left_semi").drop(key)
