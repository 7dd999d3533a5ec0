"""Links in stored web pages."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A name, then a value in quotes, in apostrophes, bare, or left out. What is matched
# is never given back, so a long tag costs no more than its length, and a quote that
# is not closed ends the walk.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>))"""
ATTRIBUTE = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+{VALUE}|(?!\s*+=))"
# An anchor tag, or a part of the page in which a tag is no link. The parts are
# matched whole, in one pass, so that anchors inside them are passed over. A part
# that is never closed reaches to the end of the page.
TAGS = (
    rf"(?is)<(?:a(?=[\s/])(?:[\s/]++|{ATTRIBUTE})*+>|!--.*?(?:-->|\z)"
    r"|(script|style|textarea|title)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\z))"
)
# A value in pieces: an entity, any other run, or an ampersand of its own.
PIECES = r"(?i)&(?:#x[0-9a-f]{1,6}|#[0-9]{1,7}|[a-z][a-z0-9]*);|[^&]+|&"
LAST_CODE_POINT = 0x10FFFF


def _character(code: Column) -> Column:
    """The character of a code point; a wrong one becomes the replacement character."""
    wrong = ~code.between(1, LAST_CODE_POINT) | code.between(0xD800, 0xDFFF)
    known = F.lpad(F.hex(F.when(wrong, 0xFFFD).otherwise(code)), 8, "0")
    return F.decode(F.unhex(known), "UTF-32")


def _decoded(piece: Column) -> Column:
    named = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (f"&{name};", chr(code))])
    number = F.regexp_extract(piece, r"(?i)^&#(x?[0-9a-f]+);$", 1)
    hexadecimal = F.lower(F.substring(number, 1, 1)) == "x"
    code = F.when(hexadecimal, F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).cast("bigint")
    return (
        F.when(number != "", _character(code))
        .when(piece == "&apos;", "'")
        .when(piece.startswith("&"), F.coalesce(F.try_element_at(named, piece), piece))
        .otherwise(piece)
    )


def _value(written: Column) -> Column:
    """The value of an attribute as it is meant: without quotes, with its entities decoded."""
    value = F.regexp_replace(written, r"^.[^\s=]*+\s*+=?\s*+", "")
    quoted = F.regexp_extract(value, r"""(?s)^(["'])(.*)\1$""", 2)
    value = F.when(value.rlike("""^["']"""), quoted).otherwise(value)
    pieces = F.transform(F.regexp_extract_all(value, F.lit(PIECES), F.lit(0)), _decoded)
    return F.when(value.contains("&"), F.array_join(pieces, "")).otherwise(value)


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name; empty if it has none, NULL if it is absent."""
    written = F.regexp_extract_all(F.substr(tag, F.lit(3)), F.lit(f"(?s){ATTRIBUTE}"), F.lit(0))
    named = F.filter(written, lambda a: F.lower(F.regexp_extract(a, r"(?s)^.[^\s=]*", 0)) == name.lower())
    return F.get(F.transform(F.slice(named, 1, 1), _value), F.lit(0))


def page_links(pages: DataFrame, html: str, name: str, pattern: str, link: str = "link") -> DataFrame:
    """``href`` of the first anchor whose attribute ``name`` matches ``pattern``.

    Pages without such an anchor are left out. The anchors are searched inside
    the row of their page: no row per anchor and no shuffle. Exploding the at
    most one fitting tag lets Spark search each page once.
    """
    anchors = F.filter(
        F.regexp_extract_all(html, F.lit(TAGS), F.lit(0)),
        lambda tag: tag.rlike(r"(?i)^<a[\s/]") & F.coalesce(attribute(tag, name).rlike(pattern), F.lit(False)),
    )
    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.explode(F.slice(anchors, 1, 1)).alias("_tag")).select(
        *others, attribute(F.col("_tag"), "href").alias(link)
    )
