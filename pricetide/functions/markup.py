"""Fields of HTML pages as Spark expressions.

An element is found by tag name and class token, cut out with its nested elements, and
turned into text. Comments, scripts and styles are to be dropped first (`visible`).
"""

import json
import re
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_HIDDEN = (
    r"(?s)<(?:!--.*?--|(?i:script)\b.*?</(?i:script)\s*|(?i:style)\b.*?</(?i:style)\s*)>"
)
# The rest of a start tag: quoted values may hold ``>``.
_TO_TAG_END = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
_TAG = f"(?s)<{_TO_TAG_END}"
# One attribute other than ``class``, with its value.
_ATTRIBUTE = (
    r"(?!(?i:class)\s*=)[^\s>][^\s=>]*+"
    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+\s*+"""
)
_EDGES = r"(?U)^\s+|\s+$"
_BREAK = "\u0001"


def visible(html: Column) -> Column:
    return F.regexp_replace(html, _HIDDEN, "")


def _start_tag(tag: str, classes: tuple[str, ...]) -> str:
    name = f"<(?i:{tag})"
    if not classes:
        return rf"{name}(?=[\s>]){_TO_TAG_END}"
    token = "(?:" + "|".join(re.escape(c) for c in classes) + ")"
    quoted = "|".join(
        rf"{quote}(?:[^{quote}]*\s)?{token}(?:\s[^{quote}]*)?{quote}" for quote in "\"'"
    )
    own = rf"(?i:class)\s*=\s*(?:{quoted}|{token}(?=[\s>]))"
    return rf"{name}\s++(?:{_ATTRIBUTE})*+{own}{_TO_TAG_END}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """A regex group, or NULL where the pattern is not found or the group is empty."""
    return let(F.regexp_extract(text, pattern, group), lambda hit: F.when(hit != "", hit))


def find_element(html: Column, tag: str, *classes: str) -> Column:
    """First ``tag`` element with one of the class tokens (any, if none is given), or NULL.

    The result starts with the start tag and lacks the end tag. An element that is never
    closed runs to the end of the page.
    """
    start = _start_tag(tag, classes)
    to_first_end = F.regexp_extract(html, rf"(?s){start}.*?(?:</(?i:{tag})\s*>|\z)", 0)
    to_page_end = F.regexp_extract(html, rf"(?s){start}.*\z", 0)
    holds_same_tag = rf"(?is)^<{_TO_TAG_END}.*?<{tag}[\s>/]"
    return let(
        to_first_end,
        lambda short: F.when(short == "", F.lit(None).cast("string"))
        .when(short.rlike(holds_same_tag), _up_to_own_end(to_page_end, tag))
        .otherwise(F.regexp_replace(short, rf"(?is)</{tag}\s*>\z", "")),
    )


def _up_to_own_end(markup: Column, tag: str) -> Column:
    """Cut where the number of start and end tags of ``tag`` first balances."""
    pieces = F.split(markup, rf"(?i)(?=</?{tag}[\s>/])")

    def step(state: Column, piece: Column) -> Column:
        closed = (state["depth"] == 0) & (state["taken"] > 0)
        change = F.when(piece.startswith("</"), -1).otherwise(1)
        further = F.struct(
            (state["depth"] + change).alias("depth"), (state["taken"] + 1).alias("taken")
        )
        return F.when(closed, state).otherwise(further)

    def kept(all_pieces: Column) -> Column:
        begin = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"))
        inside = F.aggregate(
            all_pieces,
            begin,
            step,
            lambda end: F.when(end["depth"] == 0, end["taken"] - 1).otherwise(end["taken"]),
        )
        return F.array_join(F.slice(all_pieces, 1, inside), "")

    return let(pieces, kept)


def _characters() -> dict[str, str]:
    """Text of each named reference, and of the numbers that stand for windows-1252 bytes."""
    named = {f"&{name}": text for name, text in html5.items()}
    bytes_ = {n: bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}
    return named | {f"#{n}": text for n, text in bytes_.items() if text}


def _reference() -> str:
    """Pattern of a character reference; old names need no semicolon, the longest wins."""
    old = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
    return "&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;|(?:" + "|".join(old) + "))"


def unescape(text: Column) -> Column:
    """Decode character references as HTML does, each once; unknown names stay as they are."""
    known = F.from_json(F.lit(json.dumps(_characters())), "map<string,string>")
    pattern = _reference()
    old = pattern[pattern.rindex("(?:") :].removesuffix(")")

    def character(code: Column) -> Column:
        is_scalar = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
        by_number = F.when(is_scalar, F.decode(utf32, "UTF-32")).otherwise("\ufffd")
        listed = F.element_at(known, F.concat(F.lit("#"), code.cast("string")))
        return F.when(code.between(128, 159), F.coalesce(listed, by_number)).otherwise(by_number)

    def numbered(reference: Column, digits: str, base: int) -> Column:
        # leading zeros say nothing, and eight further digits are beyond all characters
        significant = F.regexp_extract(reference, rf"^&#[xX]?0*({digits}*)", 1)
        code = F.conv(F.when(F.length(significant) < 8, significant), base, 10).cast("bigint")
        return let(F.coalesce(code, F.lit(0)), character)

    def named(reference: Column) -> Column:
        def beginning(name: Column) -> Column:
            rest = F.substring(reference, F.length(name) + 1, F.length(reference))
            return F.when(name != "", F.concat(F.element_at(known, name), rest))

        start = F.regexp_extract(reference, f"^&{old}", 0)
        return F.coalesce(F.element_at(known, reference), let(start, beginning), reference)

    def decode(reference: Column) -> Column:
        return (
            F.when(reference.rlike("^&#[0-9]"), numbered(reference, "[0-9]", 10))
            .when(reference.startswith("&#"), numbered(reference, "[0-9a-fA-F]", 16))
            .otherwise(named(reference))
        )

    def decoded(raw: Column) -> Column:
        references = F.transform(F.regexp_extract_all(raw, F.lit(pattern), F.lit(0)), decode)
        between = F.split(raw, pattern, -1)
        pairs = F.zip_with(between, references, lambda t, c: F.concat(t, F.coalesce(c, F.lit(""))))
        return F.array_join(pairs, "")

    return let(text, lambda raw: F.when(raw.contains("&"), decoded(raw)).otherwise(raw))


def plain(element: Column) -> Column:
    """An element's text as it stands; `clean_texts` finishes it."""
    return F.regexp_replace(element, _TAG, "")


def by_node(element: Column) -> Column:
    """An element's text with its text nodes still apart; `clean_texts` trims and joins them."""
    return F.regexp_replace(element, _TAG, _BREAK)


def clean_texts(*texts: Column) -> Column:
    """Array of the texts, decoded and trimmed of all Unicode white space."""

    def clean(text: Column) -> Column:
        joined = F.regexp_replace(unescape(text), rf"(?U)\s*{_BREAK}[\s{_BREAK}]*", "")
        return F.regexp_replace(joined, _EDGES, "")

    return F.transform(F.array(*texts), clean)


def text_node_with(html: Column, sign: str) -> Column:
    """First text node of the page that holds the character ``sign``, or NULL."""
    return first_match(html, rf"(?:^|>)([^<>{sign}]*+{sign}[^<]*)", 1)
