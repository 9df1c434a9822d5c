"""URL parts, reference resolution and index names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme, authority, path, query, fragment of a URL reference (RFC 3986, appendix B)
REFERENCE = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)
PART_NAMES = ("scheme", "authority", "path", "query", "fragment")
# schemes in which a relative reference can be resolved
HIERARCHICAL = ("http", "https", "ftp", "file", "ws", "wss", "sftp", "svn")
# characters an index name may not hold
INDEX_NAME_FORBIDDEN = '"*\\<|>/?:'


def url_part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, REFERENCE, group)


def site_root(url: Column) -> Column:
    """``scheme://host`` of an absolute URL; empty for a relative one."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", 0)


def host(url: Column) -> Column:
    return F.lower(url_part(url, 2))


def index_name(root: Column) -> Column:
    """A root URL without the characters that index names may not hold."""
    return F.translate(root, INDEX_NAME_FORBIDDEN, "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate a value once and use it several times in an expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _front(parts: Column) -> Column:
    """An array without its last element."""
    return F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))


def _folded_path(segments: Column) -> Column:
    """Join path segments after folding ``.`` and ``..``; the result starts with a slash."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", _front(done))
        .when(part == ".", done)
        .otherwise(F.array_append(done, part)),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    closing = F.when(ends_in_dots, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return _rooted(F.array_join(F.concat(kept, closing), "/"))


def _rooted(path: Column) -> Column:
    return _let(path, lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p)))


def _merged(base_path: Column, ref_path: Column) -> Column:
    """Segments of the base's folder and of a relative path; empty ones inside are dropped."""
    folder = F.split(F.regexp_replace(base_path, r"[^/]*$", ""), "/")
    together = F.concat(_front(folder), F.split(ref_path, "/"))

    def without_gaps(parts: Column) -> Column:
        inner = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), lambda p: p != "")
        whole = F.concat(F.slice(parts, 1, 1), inner, F.slice(parts, -1, 1))
        return F.when(F.size(parts) > 2, whole).otherwise(parts)

    return _let(together, without_gaps)


def _parts(url: Column) -> Column:
    return F.struct(*[url_part(url, i + 1).alias(n) for i, n in enumerate(PART_NAMES)])


def _with_mark(mark: str, text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(mark), text)).otherwise(F.lit(""))


def _resolved(base: Column, ref: Column) -> Column:
    """The reference resolved, from the parts of base and reference."""
    elsewhere, bare = ref["authority"] != "", ref["path"] == ""
    rooted = F.startswith(ref["path"], F.lit("/"))
    has_dots = ref["path"].rlike(r"(^|/)\.\.?(/|$)")
    path = (
        F.when(elsewhere, ref["path"])
        .when(bare, base["path"])
        .when(rooted & ~has_dots, ref["path"])
        .when(rooted, _folded_path(F.split(ref["path"], "/")))
        .otherwise(_let(_merged(base["path"], ref["path"]), _folded_path))
    )
    inherited = ~elsewhere & bare & (ref["query"] == "")
    return F.concat(
        F.lower(base["scheme"]),
        F.lit("://"),
        F.when(elsewhere, ref["authority"]).otherwise(base["authority"]),
        _let(path, lambda p: F.when(p == "", p).otherwise(_rooted(p))),
        _with_mark("?", F.when(inherited, base["query"]).otherwise(ref["query"])),
        _with_mark("#", ref["fragment"]),
    )


def url_join(base: Column, ref: Column) -> Column:
    """Absolute URL that ``ref`` means on the page ``base``.

    A plain rooted path, the commonest link, is put behind the site directly; only other
    references are taken apart.
    """
    plain = (
        base.rlike("^https?://[^/?#]")
        & ref.rlike("^/[^/?#][^?#]*$")
        & ~F.contains(ref, F.lit("/."))
    )

    def general(both: Column) -> Column:
        b, r = both["b"], both["r"]
        foreign = (r["scheme"] != "") & (F.lower(r["scheme"]) != F.lower(b["scheme"]))
        flat = ~F.lower(b["scheme"]).isin(*HIERARCHICAL)
        return F.when(foreign | flat, ref).otherwise(_resolved(b, r))

    return (
        F.when(ref == "", base)
        .when(base == "", ref)
        .when(plain, F.concat(site_root(base), ref))
        .otherwise(_let(F.struct(_parts(base).alias("b"), _parts(ref).alias("r")), general))
    )
