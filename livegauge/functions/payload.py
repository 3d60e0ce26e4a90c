"""Functions on landed payloads: page text and JSON replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livegauge.schemas import REPLY_BODY
from livegauge.settings import PAGE_PATTERNS, PagePatterns

# Markup in one scan of a page. Every alternative takes in all it has looked at, whether it is closed or not, and no
# quantifier gives back what it took, so that no text is looked at again: the time is in proportion to the page.
_VALUE = r"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|(?!["'])[^\s>]*+)"""
_ATTRIBUTE = rf"""[^\s/>][^\s/=>]*+(?:\s*+=\s*+{_VALUE})?+"""
_INSIDE = rf"(?:[\s/]*+{_ATTRIBUTE})*+[\s/]*+"
# Comments, scripts and styles, in which an href is no link, run to their end or that of the page. Otherwise a start tag; the group
# is the whole tag if it is closed, and empty in all other cases.
MARKUP = (
    rf"""(?is)<(?:!--(?:-?>|.*?(?:--!?>|\z))|(script|style)(?=[\s/>]){_INSIDE}(?:>.*?(?:</\1(?=[\s/>])|\z)|\z)"""
    rf"""|(?=[a-z])([a-z][^\s/>]*+{_INSIDE}>)|[a-z][^\s/>]*+{_INSIDE})"""
)
# The value, with its quotes and the sign before it, of the first href of a tag.
HREF = rf"""(?is)^[a-z][^\s/>]*+(?:[\s/]*+(?!href(?:\s*+=|[\s/>])){_ATTRIBUTE})*+[\s/]*+href\s*+(=\s*+{_VALUE})"""
# The character references that links hold; numeric ones are computed.
ENTITIES = {"quot;": '"', "apos;": "'", "lt;": "<", "gt;": ">", "amp;": "&", "nbsp;": "\u00a0"}
_NUMERIC = r"(?is)^#(?:x([0-9a-f]{1,6})|([0-9]{1,7}));"


def ascii_strip(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def is_live(html: Column, marker: str = PAGE_PATTERNS.live_marker) -> Column:
    """The page holds the marker once its non-ASCII characters are dropped."""
    # A page is stripped only if that can change the answer: no marker as it is, and more bytes than characters.
    wide = F.octet_length(html) > F.char_length(html)
    return F.contains(html, F.lit(marker)) | (wide & F.contains(ascii_strip(html), F.lit(marker)))


def _reference(piece: Column) -> Column:
    """Text that stood behind an ampersand, with the character reference it may begin with replaced."""
    sixteen, ten = (F.regexp_extract(piece, _NUMERIC, group) for group in (1, 2))
    code = F.when(sixteen != "", F.conv(sixteen, 16, 10)).otherwise(ten).cast("int")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    numeric = F.when(valid, character).otherwise(F.lit("\ufffd"))
    found = F.when(piece.rlike(_NUMERIC), F.concat(numeric, F.regexp_replace(piece, _NUMERIC, "")))
    for reference, text in ENTITIES.items():
        found = found.when(F.startswith(piece, F.lit(reference)), F.concat(F.lit(text), F.substring(piece, len(reference) + 1, 2**31 - 1)))
    return found.otherwise(F.concat(F.lit("&"), piece))


def _attribute_value(found: Column) -> Column:
    bare = F.regexp_replace(found, r"^=\s*", "")
    quoted = F.left(bare, F.lit(1)).isin('"', "'")
    value = F.when(quoted, F.substring(bare, F.lit(2), F.length(bare) - F.lit(2))).otherwise(bare)
    # Every ampersand is looked at once, so that nothing is decoded twice.
    pieces = F.transform(F.split(value, "&"), lambda piece, place: F.when(place == 0, piece).otherwise(_reference(piece)))
    return F.when(F.contains(value, F.lit("&")), F.array_join(pieces, "")).otherwise(value)


def _hrefs(html: Column) -> Column:
    """The first href of each of the page's closed start tags, in document order, as it stands there with its sign."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(MARKUP), F.lit(2)), lambda tag: F.contains(F.lower(tag), F.lit("href")))
    return F.filter(F.transform(tags, lambda tag: F.regexp_extract(tag, HREF, 1)), lambda found: found != F.lit(""))


def links(html: Column) -> Column:
    """The first href of each of the page's closed start tags, in document order."""
    return F.transform(_hrefs(html), _attribute_value)


def watch_link(html: Column, watch_url: str = PAGE_PATTERNS.watch_url) -> Column:
    """The page's :func:`first_watch_link`. Only links that hold the URL, or a reference that may stand for part of it, are decoded."""
    near = F.filter(
        _hrefs(html), lambda found: F.contains(found, F.lit("&")) | F.contains(F.lower(found), F.lit(watch_url))
    )
    return first_watch_link(F.transform(near, _attribute_value), watch_url)


def first_watch_link(hrefs: Column, watch_url: str = PAGE_PATTERNS.watch_url) -> Column:
    """The first link, case ignored, in which the URL occurs once and nothing else fits it as a pattern."""

    def matches(href: Column) -> Column:
        found = F.regexp_extract_all(F.lower(href), F.lit(watch_url), F.lit(0))
        return found == F.array(F.lit(watch_url))

    return F.get(F.filter(hrefs, matches), F.lit(0))


def canonical_link(watch_link: Column, patterns: PagePatterns = PAGE_PATTERNS) -> Column:
    """Short link with the video id that follows the watch URL."""
    video = F.substring(watch_link, patterns.id_offset + 1, 2**31 - 1)
    return F.concat(F.lit(patterns.short_url), video)


def last_count_token(html: Column, patterns: PagePatterns = PAGE_PATTERNS) -> Column:
    """The last comma-separated piece that names the count, without the wrapping; NULL where none does."""
    pieces = F.filter(F.split(html, ","), lambda piece: F.contains(piece, F.lit(patterns.count_token)))
    last = F.try_element_at(pieces, F.lit(-1))
    unwrapped = F.replace(last, F.lit(patterns.count_prefix), F.lit(""))
    return F.replace(unwrapped, F.lit(patterns.count_suffix), F.lit(""))


def parse_count(text: Column) -> Column:
    """Text as a whole number; NULL where it is not one."""
    return text.try_cast("bigint")


def reply_count(body: Column, schema: T.StructType = REPLY_BODY, default: int = 0) -> Column:
    """``data[0].viewer_count`` of a reply; the default for an empty, malformed or missing one."""
    first = F.get(F.from_json(body, schema)["data"], F.lit(0))
    return F.coalesce(first["viewer_count"], F.lit(default).cast("bigint"))


def reply_field(body: Column, path: str, default: int = 0) -> Column:
    """A whole number at any JSON path, with the same default rule."""
    return F.coalesce(F.get_json_object(body, path).try_cast("bigint"), F.lit(default).cast("bigint"))
