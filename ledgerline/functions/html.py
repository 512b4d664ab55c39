"""Finding the document link of a landing page with built-in expressions."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.fixed_values import (
    DOCUMENT_TABLE_CLASS,
    DOCUMENT_TABLE_SUMMARY,
    DOCUMENT_TABLE_TAG,
    SITE_BASE,
)

# Comments, scripts and styles hold text that looks like tags but is none.
_NOT_MARKUP = r"(?s)<(?:!--.*?-->|(?i:script)\b.*?</(?i:script)\s*>|(?i:style)\b.*?</(?i:style)\s*>)"
_HREF = r"""(?is)^<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""

# Character references as browsers read them: a number, or a name that may lack its semicolon.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_PIECES = rf"(?s){_REFERENCE}|&|[^&]+"
# Names that count without a semicolon, also in front of other letters.
_BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_LONGEST_BARE = max(map(len, _BARE))
_LARGEST = 0x10FFFF


def _odd_numbers() -> dict[int, str]:
    """Numbers that stand for something else than their code point: controls, surrogates' neighbours, non-characters."""
    planes = (plane << 16 | last for plane in range(17) for last in (0xFFFE, 0xFFFF))
    read = {number: html.unescape(f"&#{number};") for number in (*range(0xA0), *range(0xFDD0, 0xFDF0), *planes)}
    return {number: text for number, text in read.items() if text != chr(number)}


@dataclass(frozen=True)
class LinkSection:
    """The element that holds the document links: its tag, one of its classes and its summary."""

    tag: str = DOCUMENT_TABLE_TAG
    class_name: str | None = DOCUMENT_TABLE_CLASS
    summary: str | None = DOCUMENT_TABLE_SUMMARY

    def opening(self) -> str:
        """Pattern of the opening tag, whatever the order and quoting of its attributes."""
        pattern = rf"<(?i:{re.escape(self.tag)})\b"
        if self.class_name is not None:
            name = re.escape(self.class_name)
            pattern += (
                rf"""(?=[^>]*\s(?i:class)\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?\""""
                rf"""|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>])))"""
            )
        if self.summary is not None:
            text = re.escape(self.summary)
            pattern += rf"""(?=[^>]*\s(?i:summary)\s*=\s*(?:"{text}"|'{text}'))"""
        return pattern + "[^>]*>"


def _literal_map(values: dict) -> Column:
    """A constant map of strings, made from one literal: no value holds the signs between them."""
    written = "\x01".join(f"{key}\x02{value}" for key, value in values.items())
    return F.str_to_map(F.lit(written), F.lit("\x01"), F.lit("\x02"))


def _numbered(digits: Column, base: int) -> Column:
    """The character of a number; the replacement character where there is none."""
    significant = F.regexp_replace(digits, "^0+", "")
    number = F.when(F.length(significant) > 8, _LARGEST + 1).otherwise(
        F.conv(F.concat(F.lit("0"), significant), base, 10).cast("long"))
    none = (number > _LARGEST) | number.between(0xD800, 0xDFFF)
    point = F.decode(F.unhex(F.lpad(F.hex(F.when(~none, number)), 8, "0")), "UTF-32")
    return F.when(none, F.lit("\ufffd")).otherwise(F.coalesce(F.element_at(_literal_map(_odd_numbers()), number.cast("string")), point))


def _named(name: Column) -> Column:
    """What a name stands for; else the longest name it begins with counts; else it is text."""
    starts = F.transform(F.sequence(F.lit(_LONGEST_BARE), F.lit(2), F.lit(-1)), lambda size: F.substr(name, F.lit(1), size))
    bare = _literal_map(_BARE)
    begins = F.get(F.filter(starts, lambda start: (F.length(start) < F.length(name)) & F.map_contains_key(bare, start)), F.lit(0))
    return F.coalesce(
        F.element_at(_literal_map(html5), name),
        F.concat(F.element_at(bare, begins), F.substr(name, F.length(begins) + 1)),
        F.concat(F.lit("&"), name),
    )


def decoded_references(text: Column) -> Column:
    """``text`` with its character references read as browsers read them; each once, so what they yield is text."""

    def read(piece: Column) -> Column:
        name = F.substr(piece, F.lit(2))
        digits = F.regexp_replace(name, "^#[xX]?|;$", "")
        return (
            F.when(~F.rlike(piece, F.lit("(?s)^&.")), piece)
            .when(F.rlike(name, F.lit("^#[xX]")), _numbered(digits, 16))
            .when(name.startswith("#"), _numbered(digits, 10))
            .otherwise(_named(name))
        )

    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), read), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def first_text_anchor(html: Column, section: LinkSection = LinkSection()) -> Column:
    """The first ``<a>`` with non-empty text inside the section, as markup; null if there is none.

    Blank text counts as text. Sections of the same tag may nest: the walk over opening tags, closing
    tags and anchors keeps the depth and stops when the section that was found is closed.
    """
    tag = re.escape(section.tag)
    markup = F.regexp_replace(html, _NOT_MARKUP, "")
    inside = F.regexp_extract(markup, rf"(?s){section.opening()}(.*)$", 1)
    pieces = F.regexp_extract_all(
        inside,
        F.lit(rf"(?is)<{tag}\b[^>]*>|</{tag}\s*>|<a\b[^>]*>.*?</a\s*>"),
        F.lit(0),
    )

    def walk(state: Column, piece: Column) -> Column:
        done = (state["depth"] == 0) | state["anchor"].isNotNull()
        closes = F.rlike(piece, F.lit(r"^</"))
        opens = F.rlike(piece, F.lit(rf"(?i)^<{tag}\b"))
        has_text = F.regexp_replace(piece, r"(?s)<[^>]*>", "") != ""
        return (
            F.when(done, state)
            .when(closes, _state(state["depth"] - 1, F.lit(None)))
            .when(opens, _state(state["depth"] + 1, F.lit(None)))
            .when(has_text, _state(state["depth"], piece))
            .otherwise(state)
        )

    return F.aggregate(pieces, _state(F.lit(1), F.lit(None)), walk, lambda state: state["anchor"])


def _state(depth: Column, anchor: Column) -> Column:
    return F.struct(depth.cast("int").alias("depth"), anchor.cast("string").alias("anchor"))


def link_target(anchor: Column) -> Column:
    """The ``href`` of an anchor, or null if it has none."""
    target = F.concat(*[F.regexp_extract(anchor, _HREF, group) for group in (1, 2, 3)])
    return F.when(F.rlike(anchor, F.lit(_HREF)), decoded_references(target))


def document_link(html: Column, section: LinkSection = LinkSection(), base: str = SITE_BASE) -> Column:
    """Absolute address of the first document; null if the page names none.

    If the first anchor with text has no target, the page counts as naming none.
    """
    return F.concat(F.lit(base), link_target(first_text_anchor(html, section)))
