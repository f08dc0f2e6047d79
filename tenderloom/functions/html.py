"""Elements and texts of stored pages as Column expressions.

One pattern describes an element with everything inside it: its content runs to its own closing tag, over
elements of the same name nested in it. Every loop of the pattern is possessive, so it is linear in the page
and needs no stack. What nests deeper than the pattern is found by a fold over the closing tags.
"""

from __future__ import annotations

import html as _html
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, functions as F

from . import text as T

#: Levels of equally named elements that the pattern itself follows.
DEPTH = 8

_TOKEN = r"&#[0-9]{1,7};?|&#[xX][0-9a-fA-F]{1,6};?|&[A-Za-z][A-Za-z0-9]{1,31};?|[^&]+|&"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ------------------------------------------------------------------------------- character references
#: All names of HTML, each followed by its characters: one text a first letter, from "A" to "z".
_NAMES = tuple(
    "".join(f"\x01&{name}\x02{char}" for name, char in sorted(html5.items()) if name[0] == chr(letter)) + "\x01" for letter in range(65, 123))
#: The characters of the codes 128 to 159, which browsers read as Windows-1252.
_CODES_128 = "".join(_html.unescape(f"&#{code};") for code in range(128, 160))


def _reference(token: Column) -> Column:
    decimal = F.regexp_extract(token, r"^&#([0-9]{1,7});?$", 1)
    hexed = F.regexp_extract(token, r"^&#[xX]([0-9a-fA-F]{1,6});?$", 1)

    def char(code):
        wrong = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)  # codes of no character
        return F.when(wrong, F.lit("\ufffd")).when(code.between(128, 159), F.substring(F.lit(_CODES_128), code - 127, F.lit(1))).otherwise(
            F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32"))

    coded = let(F.coalesce(F.conv(F.nullif(hexed, F.lit("")), 16, 10), decimal).try_cast("int"), char)
    names = F.get(F.split(F.lit("\x03".join(_NAMES)), "\x03"), F.ascii(F.substring(token, 2, 1)) - 65)
    place = F.instr(names, F.concat(F.lit("\x01"), token, F.lit("\x02")))
    named = let(place, lambda at: F.when(at > 0, F.substring_index(
        F.substring(names, at + F.length(token) + 2, F.lit(8)), "\x01", 1)).otherwise(token))
    return F.when(~token.startswith("&") | (token == "&"), token).when(
        token.startswith("&#"), F.coalesce(coded, token)).otherwise(named)


def unescape(c) -> Column:
    """Character references to characters: all names of HTML, decimal and hexadecimal codes; others stay as they are."""
    def decoded(text):
        tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
        return F.when(text.contains("&"), F.array_join(F.transform(tokens, _reference), "")).otherwise(text)

    return let(T.col(c), decoded)


# ------------------------------------------------------------------------------- texts
def inner_text(fragment) -> Column:
    """Text of a fragment with its tags removed, ends trimmed."""
    return T.strip(unescape(F.regexp_replace(T.null_to_empty(fragment), r"<[^>]*>", "")))


def joined_text(fragment) -> Column:
    """Text pieces between tags, each trimmed, joined with single spaces."""
    pieces = F.transform(F.split(T.null_to_empty(fragment), r"<[^>]*>"), lambda p: T.strip(unescape(p)))
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def page_text(html) -> Column:
    """All visible text: scripts, styles, comments and tags removed."""
    bare = F.regexp_replace(
        T.null_to_empty(html), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>", "")
    return unescape(bare)


# ------------------------------------------------------------------------------- elements
def opening(tag: str, cls: str | None = None) -> str:
    """Pattern of an opening tag after its "<"; ``cls`` is one of its classes, in either kind of quotes."""
    if cls is None:
        return rf"{tag}\b[^>]*>"
    quoted = "|".join(rf"{q}(?:[^{q}>]*\s)?{cls}(?:\s[^{q}>]*)?{q}" for q in "\"'")
    return rf"{tag}\b[^>]*\bclass=(?:{quoted})[^>]*>"


def balanced(tag: str, depth: int = DEPTH) -> str:
    """Pattern of a text in which every ``tag`` that is opened is closed, nested up to ``depth`` levels."""
    flat = rf"[^<]*+(?:<(?!/?(?i:{tag})\b)[^<]*+)*+"
    pattern = flat
    for _ in range(depth):
        pattern = rf"{flat}(?:<(?i:{tag})\b[^>]*+>{pattern}</(?i:{tag})\s*>{flat})*+"
    return pattern


def _content(tag: str, otherwise: str) -> str:
    whole = balanced(tag)
    return rf"(?:(?={whole}(?:</(?i:{tag})\s*>|\z)){whole}|{otherwise})"


def _upto_own_end(rest: Column, tag: str) -> Column:
    """What comes before the closing tag of the element whose content starts ``rest``, however deep it nests.

    The text is cut at closing tags of that name; the element ends at the first cut where no more of them
    were opened than closed, or with the text if it is never closed.
    """
    def upto_end(pieces):
        opened = F.transform(pieces, lambda p: F.regexp_count(p, F.lit(rf"(?i)<{tag}\b")))
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end"))
        found = F.aggregate(opened, start, lambda s, n: F.struct(
            (s["depth"] + n - 1).alias("depth"), (s["seen"] + 1).alias("seen"),
            F.when((s["end"] == 0) & (s["depth"] + n == 1), s["seen"] + 1).otherwise(s["end"]).alias("end")))["end"]
        return let(found, lambda end: F.array_join(
            F.slice(pieces, F.lit(1), F.when(end > 0, end).otherwise(F.size(pieces))), f"</{tag}>"))

    return let(F.split(rest, rf"(?i)</{tag}\s*>"), upto_end)


def _ended(content: Column, tag: str) -> Column:
    deep = F.regexp_count(content, F.lit(rf"(?i)<{tag}\b")) > DEPTH
    return F.when(deep, _upto_own_end(content, tag)).otherwise(content)


def element(html, tag: str, cls: str | None = None) -> Column:
    """Content of the first ``tag`` (of class ``cls``) up to its own closing tag, or to the end if it is never closed; "" if there is none."""
    found = F.regexp_extract(T.null_to_empty(html), rf"(?s)<{opening(tag, cls)}({_content(tag, '.*')})", 1)
    return let(found, lambda c: _ended(c, tag))


def own_content(rest, tag: str) -> Column:
    """The part of ``rest`` that belongs to the ``tag`` whose content it starts."""
    return let(F.regexp_extract(rest, rf"(?s)^({_content(tag, '.*')})", 1), lambda c: _ended(c, tag))


def elements(html, *wanted: tuple[str, str | None]) -> Column:
    """All elements of the wanted (tag, class) kinds in page order, found in one pass, also those inside each other.

    Each is a string: the opening tag after its "<", then its content. An element without an own end
    within :data:`DEPTH` levels has no content here; :func:`field` looks it up again.
    """
    kinds = "|".join(rf"{opening(tag, cls)}{_content(tag, '')}" for tag, cls in wanted)
    return F.regexp_extract_all(T.null_to_empty(html), F.lit(rf"(?s)<(?=({kinds}))"), F.lit(1))


def content_of(item: Column) -> Column:
    """Content of one of :func:`elements`."""
    return F.regexp_replace(item, r"^[^>]*>", "")


def field(found: Column, html, tag: str, cls: str | None = None) -> Column:
    """Content of the first of its kind among the ``found`` elements of ``html``, as :func:`element` gives it."""
    first = F.get(F.filter(found, lambda e: e.rlike(rf"^{opening(tag, cls)}")), F.lit(0))
    return F.coalesce(let(content_of(first), lambda c: F.when(c == "", element(html, tag, cls)).otherwise(c)), F.lit(""))
