"""Personal data: fixed patterns, and a character BiLSTM with CRF for what they miss.

The patterns give the base spans. The tagger learns from labelled spans, and from the same spans rewritten
as people write them to get past patterns (``name [at] host dot org``, a number without its plus), and
adds spans. Only text near a digit, an @, or a spelled "at" or "dot" between the parts of an address is
decoded: no span of the four kinds is possible elsewhere. Long stretches are decoded in overlapping windows; a span must be found by most of
the windows that hold it, and where spans overlap the best supported set over the whole text is kept.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import broadcast_value, map_batches, named
from linkloom.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The local part is looked for backwards from the @, and an address only at the start of its digits: the
# matches are those of the full patterns, without their quadratic time on long runs.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _is_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (part.lstrip("0") or "0" for part in text.split(".")))


def _is_card(text: str) -> bool:
    return 13 <= len(d := _digits(text)) <= 19 and luhn(d)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind's pattern that pass its check, in code points."""
    found: list[Span] = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append(("email", start, last := m.end()))
    if _DIGIT.search(text):
        for kind, pattern, right in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
            if kind != "phone" or "+" in text:
                found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if right(m[0])]
    return found


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


# --- what the tagger may find -----------------------------------------------------------------------

_SPELLED_AT = re.compile(r"\s*[\[({<]\s*(?:at|AT|@)\s*[\])}>]\s*|\s+(?:at|AT)\s+|\s*@\s*")
_SPELLED_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|DOT|\.)\s*[\])}>]\s*|\s+(?:dot|DOT)\s+")
_FULL_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_FULL_PHONE = re.compile(r"(?:\+|00)?[0-9]{0,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20./-]{1,2}[0-9]{2,4}){2,4}")


def plausible(kind: str, text: str) -> bool:
    """Whether a span that the tagger found has the form of its kind once spelled-out marks are undone."""
    if kind == "email":
        plain = _SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", text))
        return plain != text and bool(_FULL_EMAIL.fullmatch(plain))
    if kind == "ip":
        plain = _SPELLED_DOT.sub(".", text)
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", plain)) and _is_ip(plain)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9]+(?:[\x20./-][0-9]+)*", text)) and _is_card(text)
    return bool(_FULL_PHONE.fullmatch(text)) and _is_phone(text)


REACH = 48      # characters of context around a trigger
WINDOW = 128    # characters decoded together
STRIDE = 64
_TRIGGER = re.compile("[0-9@]")
# The spelled marks of ``plausible`` as they stand in an address: an "at" after a local part and before a host of two
# labels, a "dot" between address characters. Matches may overlap and each run of white space is looked at a few times only.
_DOT_MARK = r"(?:\s*+[\[({<]\s*+(?:dot|DOT|\.)\s*+[\])}>]\s*+|\s++(?:dot|DOT)\s++)"
_AT_MARK = r"(?:\s*+[\[({<]\s*+(?:at|AT)\s*+[\])}>]\s*+|\s++(?:at|AT)\s++)"
_SPELLED = re.compile(
    rf"(?=[\s\[({{<])(?<=[A-Za-z0-9._%+\-\])}}>])(?=({_AT_MARK}[A-Za-z0-9-]++(?:\.|{_DOT_MARK})|{_DOT_MARK})[A-Za-z0-9-])")


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around everything that a span of any kind must hold, merged where they touch."""
    marks = [m.start() for m in _TRIGGER.finditer(text)]
    spelled = [at for m in _SPELLED.finditer(text) for at in m.span(1)]
    if spelled:
        marks = sorted(marks + spelled)
    made: list[tuple[int, int]] = []
    for at in marks:
        a, b = max(0, at - REACH), min(len(text), at + REACH)
        if made and a <= made[-1][1]:
            made[-1] = (made[-1][0], b)
        else:
            made.append((a, b))
    return made


_SYMBOLS = {chr(c): c - 30 for c in range(32, 127)}
_OTHER_LETTER, _OTHER = 97, 98
SYMBOLS = 99
TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind


def symbols_of(text: str) -> np.ndarray:
    """Symbol numbers of a window, zero beyond its end."""
    made = np.zeros(WINDOW, np.int16)
    made[:len(text)] = [_SYMBOLS.get(c) or (_OTHER_LETTER if c.isalpha() else _OTHER) for c in text]
    return made


def new_tagger() -> Tagger:
    allowed = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        allowed[:, 2 + 2 * k] = False
        allowed[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    first = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])
    return Tagger(SYMBOLS, allowed, first)


def tagged(tags: np.ndarray) -> list[Span]:
    """Spans of a tag sequence."""
    found, t = [], 0
    while t < len(tags):
        if tags[t] and tags[t] % 2:
            kind, start = int(tags[t] - 1) // 2, t
            t += 1
            while t < len(tags) and tags[t] == 2 + 2 * kind:
                t += 1
            found.append((KINDS[kind], start, t))
        else:
            t += 1
    return found


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping windows over a stretch; the last one ends with it."""
    if end - start <= WINDOW:
        return [(start, end)]
    return [(a, a + WINDOW) for a in [*range(start, end - WINDOW, STRIDE), end - WINDOW]]


def reconcile(found: dict[Span, int], seen: list[tuple[int, int]]) -> list[Span]:
    """Spans most of whose windows agree; of overlapping ones the set with most votes in the whole text.

    ``found`` counts the windows that give a span, ``seen`` are all windows in order. A window speaks about
    a span if it holds it whole.
    """
    starts = [a for a, _ in seen]
    agreed = []
    for (kind, a, b), votes in found.items():
        to = bisect_right(starts, a)
        holding = sum(1 for w in seen[max(0, to - WINDOW // STRIDE - 2):to] if w[0] <= a and b <= w[1])
        if 2 * votes > holding:
            agreed.append((b, a, kind, votes))
    agreed.sort()
    best, chosen = [0], [[]]
    ends = [s[0] for s in agreed]
    for k, (b, a, kind, votes) in enumerate(agreed):
        before = bisect_right(ends, a, 0, k)
        with_it = best[before] + votes
        if with_it > best[k]:
            best.append(with_it)
            chosen.append([before, (kind, a, b)])
        else:
            best.append(best[k])
            chosen.append([k])
    picked, at = [], len(agreed)
    while at:
        step = chosen[at]
        if len(step) == 2:
            picked.append(step[1])
        at = step[0]
    return picked[::-1]


def added_spans(tagger: Tagger, texts: list[str], base: list[list[Span]], batch: int = 256) -> list[list[Span]]:
    """Spans of the tagger that overlap no base span, for each text; windows of all texts are decoded together."""
    work = [(k, a, b) for k, text in enumerate(texts) for start, end in regions(text) for a, b in windows(start, end)]
    found: list[dict[Span, int]] = [{} for _ in texts]
    for at in range(0, len(work), batch):
        part = work[at:at + batch]
        tags = tagger.decode(np.stack([symbols_of(texts[k][a:b]) for k, a, b in part]))
        for (k, a, b), row in zip(part, tags):
            for kind, s, e in tagged(row[:b - a]):
                span = (kind, a + s, a + e)
                found[k][span] = found[k].get(span, 0) + 1
    by_text: dict[int, list] = {}
    for k, a, b in work:
        by_text.setdefault(k, []).append((a, b))
    return [_new(texts[k], reconcile(spans, by_text[k]), base[k]) if spans else [] for k, spans in enumerate(found)]


def _new(text: str, spans: list[Span], base: list[Span]) -> list[Span]:
    taken = sorted((a, b) for _, a, b in base)
    made = []
    for kind, a, b in spans:
        near = text[a - 1:a] + text[b:b + 1]
        if any(c.isalnum() for c in near) or any(x < b and a < y for x, y in taken):
            continue
        if plausible(kind, text[a:b]):
            made.append((kind, a, b))
    return made


# --- training ---------------------------------------------------------------------------------------


def _rewritten(draw: random.Random, kind: str, text: str) -> str:
    """A labelled span as it may be written otherwise."""
    if kind == "email":
        user, _, host = text.partition("@")
        at = draw.choice(["@", " at ", " [at] ", "[at]", " (at) ", "(at)", " AT ", " @ "])
        dot = draw.choice([".", " dot ", "[dot]", " [dot] ", "(dot)", " DOT "])
        return user + at + host.replace(".", dot)
    if kind == "ip":
        return text.replace(".", draw.choice([".", "[.]", " dot ", "(.)"]))
    digits = _digits(text)
    if kind == "card":
        mark = draw.choice(["", " ", "-", ".", "/"])
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if len(digits) >= 10:
        country, a, b, c = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
        mark = draw.choice(["-", ".", " "])
        form = draw.choice([f"({a}) {b}{mark}{c}", f"{a}{mark}{b}{mark}{c}", f"+{country or 1} ({a}) {b}-{c}", f"00{country or 1} {a} {b} {c}", f"+{country or 1}{mark}{a}{mark}{b}{mark}{c}"])
        return form
    return text


def _made_span(draw: random.Random, kind: str) -> str:
    word = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, n)))
    if kind == "email":
        return f"{word(9)}{draw.choice(['', '.', '_', '-'])}{draw.choice([word(7), str(draw.randint(1, 99))])}@{word(9)}.{draw.choice(['', word(6) + '.'])}{draw.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'edu'])}"
    if kind == "ip":
        return ".".join(str(draw.randint(0, 255)) for _ in range(4))
    if kind == "card":
        start = "".join(str(draw.randint(0, 9)) for _ in range(draw.choice([12, 14, 15, 15, 15, 18])))
        return next(start + str(d) for d in range(10) if luhn(start + str(d)))
    return f"+{draw.randint(1, 99)} ({draw.randint(200, 999)}) {draw.randint(200, 999)}-{draw.randint(0, 9999):04d}"


def _harmless(draw: random.Random) -> str:
    """Digits that are not personal data."""
    n = lambda k: "".join(str(draw.randint(0, 9)) for _ in range(k))
    return draw.choice([
        lambda: f"{draw.randint(1900, 2050)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}",
        lambda: f"{draw.randint(1, 28)}.{draw.randint(1, 12)}.{draw.randint(1900, 2050)}",
        lambda: f"{draw.randint(0, 23)}:{draw.randint(0, 59):02d}", lambda: n(draw.randint(1, 12)), lambda: n(draw.randint(20, 40)),
        lambda: f"{draw.randint(0, 99)}.{draw.randint(0, 99)}", lambda: f"v{draw.randint(0, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 9)}",
        lambda: f"{draw.randint(1, 999)},{n(3)},{n(3)}", lambda: "".join(draw.choice("0123456789abcdef") for _ in range(40)),
        lambda: f"{n(3)}-{n(1)}-{n(4)}-{n(4)}-{n(1)}", lambda: f"#{n(5)}", lambda: f"{n(4)} {n(2)}", lambda: "at", lambda: "dot", lambda: "@",
        lambda: f"{n(2)} at {n(2)}", lambda: f"{draw.randint(300, 999)}.{n(3)}.{n(3)}.{n(3)}",
    ])()


def examples(labelled: list[tuple[str, list[Span]]], count: int = 3000, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags: labelled spans as they are or rewritten, between the words of the labelled texts."""
    draw = random.Random(seed)
    words = [w for text, _ in labelled for w in text.split() if not _TRIGGER.search(w)] or ["text"]
    own = {kind: [text[a:b] for text, spans in labelled for k, a, b in spans if k == kind] for kind in KINDS}
    symbols, tags = np.zeros((count, WINDOW), np.int16), np.zeros((count, WINDOW), np.int64)
    for row in range(count):
        text, marks = "", []
        while len(text) < WINDOW:
            at = draw.randrange(len(words))
            text += " ".join(words[at:at + draw.randint(1, 6)]) + draw.choice([" "] * 8 + [": ", ", ", ".\n", " ("])
            what = draw.random()
            if what < 0.45:
                kind = draw.choice(KINDS)
                span = draw.choice(own[kind]) if own[kind] and draw.random() < 0.5 else _made_span(draw, kind)
                span = _rewritten(draw, kind, span) if draw.random() < 0.6 else span
                marks.append((kind, len(text), len(text) + len(span)))
                text += span
            elif what < 0.8:
                text += _harmless(draw)
            text += draw.choice([" "] * 6 + [". ", ", ", ";\n", ") "])
        cut = draw.randint(0, max(0, len(text) - WINDOW))
        end = cut + draw.choice([WINDOW, WINDOW, draw.randint(16, WINDOW)])
        symbols[row] = symbols_of(text[cut:end])
        for kind, a, b in marks:
            if cut <= a and b <= end:  # a span cut by the window's edge is left to another window
                k = KINDS.index(kind)
                tags[row, a - cut:b - cut] = 2 + 2 * k
                tags[row, a - cut] = 1 + 2 * k
    return symbols, tags


def fit(df: DataFrame, text_column: str = "text", max_stretches: int = 1000, count: int = 3000, epochs: int = 6) -> Tagger | None:
    """Train on a bounded sample of labelled stretches: at most ``max_stretches``, those with the least hashes.

    The labels are the base spans. None if no text has any: then the made spans alone would have to do, in
    no one's words. Equal stretches count once.
    """
    rows = df.select(named(text_column).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {"stretch": [], "spans": []}
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for a, b in regions(text) if spans else ():
                    inside = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= b]
                    if inside and b - a <= 4 * WINDOW:
                        out["stretch"].append(text[a:b])
                        out["spans"].append(join_spans(inside))
            yield out

    found = map_batches(rows, cut, "stretch string, spans string").distinct()
    sample = found.orderBy(F.xxhash64("stretch"), "stretch").limit(max_stretches).collect()
    if not sample:
        return None
    labelled = [(r.stretch, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(","))]) for r in sample]
    tagger = new_tagger()
    tagger.train(*examples(labelled, count), epochs=epochs)
    return tagger


# --- finding and redacting ---------------------------------------------------------------------------


def _texts_with_spans(tagger: Tagger | None, texts: list[str | None]) -> Iterator[tuple[str, list[Span], list[Span]]]:
    plain = [t or "" for t in texts]
    base = [base_spans(t) for t in plain]
    added = added_spans(tagger, plain, base) if tagger else [[] for _ in plain]
    return zip(plain, base, added)


def find(df: DataFrame, tagger: Tagger | None, text_column: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """``base`` and ``added``: arrays of (kind, start, end) of every row, with what ``carry`` names.

    Positions are code points, ends exclusive. Null is an empty text. Nothing is shuffled.
    """
    carry, shared = carry or {}, broadcast_value(df, tagger)
    rows = df.select(named(text_column).cast("string").alias("text"), F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("carried"))
    spans = "array<struct<kind: string, start: int, stop: int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        as_rows = lambda spans: [{"kind": k, "start": a, "stop": b} for k, a, b in spans]
        for batch in batches:
            found = list(_texts_with_spans(shared.value, batch.column(0).to_pylist()))
            yield {"carried": batch.column(1), "base": [as_rows(b) for _, b, _ in found], "added": [as_rows(a) for _, _, a in found]}

    found = map_batches(rows, run, f"carried {rows.schema['carried'].dataType.simpleString()}, base {spans}, added {spans}")
    return found.select(*[F.col(f"carried.{k}").alias(k) for k in carry], "base", "added")


def digest(df: DataFrame, tagger: Tagger | None, text_column: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as one string."""
    names = list(carry or {})
    found = find(df, tagger, text_column, carry)
    joined = lambda spans: F.concat_ws(",", F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"], s["stop"], s["kind"].alias("kind")))),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))
    count_of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count_of(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        *names, *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, last, end = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= end:
            out += [text[last:a], f"<{kind.upper()}>"]
        last = end = max(end, b)
    return "".join(out) + text[last:]


def redact(df: DataFrame, tagger: Tagger | None, text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """The input with every span in the text replaced; null stays null. All columns, in their order.

    ``length_column`` names a column that holds the text's length in code points, to be kept true.
    """
    shared, at = broadcast_value(df, tagger), df.columns.index(text_column)
    renamed = df.toDF(*[f"c{k}" for k in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = [None if t is None else masked(t, b + a) for t, (_, b, a) in zip(texts, _texts_with_spans(shared.value, texts))]
            yield {f"c{k}": clean if k == at else batch.column(k) for k in range(batch.num_columns)}

    schema = ", ".join(f"c{k} {t}" for k, (_, t) in enumerate(renamed.dtypes))
    made = map_batches(renamed, run, schema)
    if length_column is not None:
        k = df.columns.index(length_column)
        made = made.withColumn(f"c{k}", F.coalesce(F.length(f"c{at}").cast(df.dtypes[k][1]), F.col(f"c{k}")))
    return made.toDF(*df.columns)
