"""Truth values, codes, times, JSON bodies, tokens of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SESSION_LIFE = "interval 1 day"
RECRAWL_AGE = "interval 30 days"
# The default analyzer's word boundaries, after the Unicode rules for words.
LETTERS, DIGITS = r"\p{L}\p{M}", r"\p{N}"
INSIDE_LETTERS = "'‘’.:·"  # between two letters they are part of the word
INSIDE_DIGITS = "'‘’.,;"  # between two digits
SINGLE = r"[\p{IsHan}\p{IsHiragana}]"  # each is a word of its own
RUN = "[\\p{IsKatakana}ー]++"  # a word, whatever stands beside it
# The address coupons lead to.
COUPON_URL = "http://getcolor.ru/#"


def truthy(value: Column, data_type: T.DataType) -> Column:
    """Python truth of a value: numbers differ from zero, texts and arrays are not empty.

    A cast would call the text '0' false and refuse 'abc'; here both are true.
    """
    if isinstance(data_type, T.BooleanType):
        return value
    if isinstance(data_type, T.NumericType):
        return value != 0
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.length(value) > 0
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return F.size(value) > 0
    return F.when(value.isNotNull(), F.lit(True))


def pad_code(code: Column) -> Column:
    """Right-pad with zeros to six characters; longer codes stay whole."""
    text = code.cast("string")
    return F.when(F.length(text) >= 6, text).otherwise(F.rpad(text, 6, "0"))


def coupon_number(*keys: Column) -> Column:
    """A repeatable code between 0 and 0xFFFFF drawn from the digest of the keys."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("bigint")


def random_coupon_number() -> Column:
    """A random code between 0 and 0xFFFFF, another one on every run."""
    return F.floor(F.rand() * 0x100000).cast("bigint")


def coupon_url(code: Column, address: str = COUPON_URL) -> Column:
    return F.concat(F.lit(address), pad_code(code))


def repeatable_id(*keys: Column) -> Column:
    """An id that a re-run of the same input gives again."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))


def random_id() -> Column:
    return F.uuid()


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def parse_time(text: Column) -> Column:
    """The time a text states, or null when it is not in the format."""
    stated = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")
    return F.when(stated, text.try_cast("timestamp_ntz"))


def session_expiry(ts: Column) -> Column:
    return ts + F.expr(SESSION_LIFE)


def still_valid(expire_date: Column, as_of: Column) -> Column:
    """A session ends at its expiry time: it must lie strictly later than ``as_of``."""
    return expire_date > as_of


def is_fresh(crawled_at: Column, as_of: Column) -> Column:
    """Crawled less than 30 days before ``as_of``; exactly 30 days is no longer fresh."""
    return crawled_at + F.expr(RECRAWL_AGE) > as_of


def decode_body(body: Column, schema: T.StructType | str) -> Column:
    return F.from_json(body, schema)


def encode_body(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def body_field(body: Column, name: str) -> Column:
    return F.get_json_object(body, f"$.{name}")


def _between_words() -> str:
    word = f"{LETTERS}{DIGITS}_{INSIDE_LETTERS}{INSIDE_DIGITS}"
    joins = f"(?<=[{LETTERS}])[{INSIDE_LETTERS}](?=[{LETTERS}])|(?<=[{DIGITS}])[{INSIDE_DIGITS}](?=[{DIGITS}])"
    return f"[^{word}]++|(?!{joins})[{INSIDE_LETTERS}{INSIDE_DIGITS}]"


# each match is a run or one character: nothing repeats a group, so texts of any length and kind are split in linear time
BETWEEN_WORDS = _between_words()


def tokens(text: Column) -> Column:
    """The words of a text in order, lower-case, repeats kept, as the default analyzer cuts them.

    A word is a run of letters, digits and underscores with a letter or digit. An apostrophe, a point or a colon
    between two letters, and an apostrophe, a point, a comma or a semicolon between two digits belong to it: "don't" and
    "3.14" are one word each. Ideographs and Hiragana are words one by one, Katakana runs are words.
    """
    apart = F.regexp_replace(F.lower(text), f"{SINGLE}|{RUN}", " $0 ")
    return F.filter(F.split(apart, BETWEEN_WORDS), lambda t: F.btrim(t, F.lit("_")) != "")
