"""HTML to text, links of a page, character references."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text nodes lose the white space that Python's str.strip() removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# What is never closed runs to the end of the page, as it does for a browser; this also keeps a page
# full of openers from being searched again and again. A quoted attribute value is taken as a unit, whatever it
# holds. Repeats of groups are possessive: the JVM then runs them in a loop, so no tag is too long for its stack.
ATTRIBUTES = r"""(?:=\s*+"[^"]*+(?:"|\z)|=\s*+'[^']*+(?:'|\z)|[^>=]++|=)*+"""
COMMENT = r"<!--.*?(?:-->|\z)"
SCRIPT = rf"<script(?:\s{ATTRIBUTES})?(?:>.*?(?:</script\s*>|\z)|\z)"
STYLE = rf"<style(?:\s{ATTRIBUTES})?(?:>.*?(?:</style\s*>|\z)|\z)"
HEAD = rf"<head(?:\s{ATTRIBUTES})?(?:>.*?(?:</head\s*>|<body(?:\s{ATTRIBUTES})?(?:>|\z)|\z)|\z)"
TAG = rf"<[a-z/!?]{ATTRIBUTES}(?:>|\z)"

# One alternation, tried at each '<' from left to right, so whichever construct opens first wins:
# a script inside a comment is a comment, a comment inside a script is a script.
MARKUP = f"(?is){COMMENT}|{HEAD}|{SCRIPT}|{STYLE}|{TAG}"
MARKUP_KEEP_SCRIPTS = f"(?is){COMMENT}|{HEAD}|{TAG}"
NOT_CONTENT = f"(?is){COMMENT}|{SCRIPT}|{STYLE}"
FIRST_SCRIPT = rf"(?is)^(.*?)<script(?:\s{ATTRIBUTES})?>.*?</script\s*>(.*)$"
HEAD_ONLY = f"(?is){HEAD}"

# a page is cut into tags first, each character looked at once; the href is read inside an anchor's short tag
ANY_TAG = f"(?is){TAG}"
ANCHOR = r"(?i)^<a[\s/]"
OTHER_ATTRIBUTES = r"""(?:(?!href[\s=])[^\s=/>]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']*+))?+[\s/"'=]*+)*+"""
HREF = rf"""(?is)^<a[\s/]++{OTHER_ATTRIBUTES}href\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"']+)"""
CHARACTER_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)"

# the named references of HTML 5, as the standard library lists them; the old ones also count without their
# semicolon, and then with whatever letters follow
NAMED_REFERENCES = "\x01".join(f"{name}\x02{text}" for name, text in html5.items() if name.endswith(";"))
OLD_REFERENCES = "\x01".join(f"{name}\x02{text}" for name, text in html5.items() if not name.endswith(";"))
OLD_NAMES = "^&(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")(.*)$"


def _code_point(n: Column) -> Column:
    """The character with code point n; none where n is not a character."""
    valid = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n <= 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def _reference_value(ref: Column) -> Column:
    # constant texts instead of thousands of literals keep the plan small
    named, old = (F.str_to_map(F.lit(t), F.lit("\x01"), F.lit("\x02")) for t in (NAMED_REFERENCES, OLD_REFERENCES))
    digits = F.regexp_extract(ref, r"^&#([0-9]+);?$", 1)
    hexits = F.regexp_extract(ref, r"^&#[xX]([0-9a-fA-F]+);?$", 1)
    old_name = F.regexp_extract(ref, OLD_NAMES, 1)
    return (
        F.when(ref == "&amp;", F.lit("&"))
        .when(ref == "&lt;", F.lit("<"))
        .when(ref == "&gt;", F.lit(">"))
        .when(ref == "&quot;", F.lit('"'))
        .when(ref == "&nbsp;", F.lit("\xa0"))
        .when(digits != "", _code_point(digits.try_cast("bigint")))
        .when((hexits != "") & (F.length(hexits) <= 8),
              _code_point(F.conv(hexits, 16, 10).try_cast("bigint")))
        .otherwise(F.coalesce(
            F.try_element_at(named, F.substr(ref, F.lit(2))),
            F.concat(F.try_element_at(old, old_name), F.regexp_extract(ref, OLD_NAMES, 2)),
        ))
    )


def decode_references(text: Column) -> Column:
    """Replace character references in one pass; an unknown reference stays as written.

    One pass matters: ``&amp;lt;`` is the text ``&lt;``, not ``<``.
    """
    pieces = F.split(text, CHARACTER_REFERENCE)
    refs = F.regexp_extract_all(text, F.lit(CHARACTER_REFERENCE), F.lit(0))
    joined = F.zip_with(
        pieces,
        refs,
        lambda piece, ref: F.concat(
            F.coalesce(piece, F.lit("")), F.coalesce(_reference_value(ref), ref, F.lit(""))
        ),
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)


def text_nodes(html: Column, first_only: bool = False) -> Column:
    """Stripped, non-empty text nodes of a page, outside head, scripts, styles and comments.

    ``first_only`` drops only the first script element and keeps what later ones contain.
    """
    if first_only:
        body = F.regexp_replace(html, HEAD_ONLY, " <p> ")
        opened = F.regexp_extract(body, FIRST_SCRIPT, 1)
        closed = F.regexp_extract(body, FIRST_SCRIPT, 2)
        body = F.when(body.rlike(FIRST_SCRIPT), F.concat(opened, F.lit("<p>"), closed)).otherwise(body)
        nodes = F.split(body, MARKUP_KEEP_SCRIPTS)
    else:
        nodes = F.split(html, MARKUP)
    stripped = F.transform(nodes, lambda node: F.btrim(decode_references(node), F.lit(WHITESPACE)))
    return F.filter(stripped, lambda node: node != "")


def html_text(html: Column, first_only: bool = False) -> Column:
    """Readable text of a page: its text nodes joined by one space."""
    return F.array_join(text_nodes(html, first_only), " ")


def hrefs(html: Column) -> Column:
    """Distinct href values of the page's anchors; an empty page has none."""
    content = F.regexp_replace(html, NOT_CONTENT, "<p>")
    tags = F.filter(F.regexp_extract_all(content, F.lit(ANY_TAG), F.lit(0)), lambda tag: tag.rlike(ANCHOR))
    raw = F.filter(F.transform(tags, lambda tag: F.regexp_extract(tag, HREF, 1)), lambda v: v != "")
    quoted = lambda v: F.substr(v, F.lit(1), F.lit(1)).isin('"', "'")
    plain = F.transform(
        raw,
        lambda v: decode_references(
            F.when(quoted(v), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
        ),
    )
    return F.array_distinct(plain)
