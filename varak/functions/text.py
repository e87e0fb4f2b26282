"""Text functions, Column to Column, all built in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from varak import rules


def dehyphenate(c: Column) -> Column:
    """Joins words cut at a line's end."""
    return F.replace(c, F.lit("-\n"), F.lit(""))


def dashes(c: Column) -> Column:
    """A hyphen that begins a line becomes an em dash; only line feeds end lines."""
    return F.regexp_replace(c, r"(?md)^- ?", "— ")


def toc_marker(c: Column) -> Column:
    return F.regexp_replace(c, r'(?sU)<table\s+class="toc">.*?</table>', rules.TOC_MARK)


def cap_underscores(c: Column) -> Column:
    return F.regexp_replace(c, "_{11,}", "_" * 10)


def unescape(c: Column) -> Column:
    for a, b in (("\\\\", "\\"), ("\\_", "_"), ("\\<", "<")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def headers(c: Column) -> Column:
    """Headings of the second to sixth level, ``## title``."""
    found = F.regexp_extract_all(c, F.lit(r"(?md)^(#{2,6}[ \t]+[^\n]+)"), F.lit(1))
    return F.transform(found, lambda h: F.concat_ws(" ", F.regexp_extract(h, "^(#+)", 1), F.trim(F.regexp_extract(h, r"^#+[ \t]+(.+)$", 1))))


def footnotes(c: Column) -> Column:
    """Numbers of the footnotes defined in a text."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\[\^(\d{1,9})\]:"), F.lit(1)), lambda n: n.cast("int"))


def max_footnote(c: Column) -> Column:
    return F.coalesce(F.array_max(footnotes(c)), F.lit(0))


def trim_tail(c: Column) -> Column:
    """Drops one hyphen at the end, then one line feed."""
    return F.regexp_replace(F.regexp_replace(c, r"-\z", ""), r"\n\z", "")


def strip_images(c: Column) -> Column:
    c = dashes(F.regexp_replace(c, r"(?md)^!\[\]\(.*?\)\s*", ""))
    return F.regexp_replace(c, r"!\[.*?\]\(.*?\)", "")


def strip_img(c: Column) -> Column:
    return F.regexp_replace(c, r'(?U)<img\s+[^>]*src="[^"]+"[^>]*>', "")


def strip_word_export(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)dN=`?.*?</a>`?\{=html\}", "")


def strip_xml_declaration(c: Column) -> Column:
    return F.regexp_replace(c, r"(?md)^xml version='1\.0' encoding='utf-8'\?\s*", "")


def normalize(c: Column) -> Column:
    """The whole clean-up of an extracted text."""
    steps = (strip_xml_declaration, strip_word_export, dehyphenate, strip_images, strip_img, toc_marker, cap_underscores, unescape)
    return reduce(lambda x, f: f(x), steps, c)


def relative_url(c: Column) -> Column:
    """Whether a URL has neither scheme nor host."""
    return ~(c.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | c.startswith("//"))


def extension(path: Column, mime: Column, strict: bool = False) -> Column:
    """The path's extension, else the one of the content type; where neither is known null, or an error if ``strict``."""
    own = F.regexp_extract(path, r"(\.[^./]+)$", 1)
    known = F.create_map(*[F.lit(x) for kv in rules.EXTENSIONS.items() for x in kv])
    of_type = F.try_element_at(known, F.lower(F.trim(mime)))
    if strict:
        of_type = F.coalesce(of_type, F.raise_error(F.concat(F.lit("no extension for "), F.coalesce(mime, F.lit("null")))).cast("string"))
    return F.when(own != "", own).otherwise(of_type)


def new_block(c: Column) -> Column:
    """Whether a text begins with markup, a heading or a numbered section."""
    return c.rlike("|".join(f"(?:{p})" for p in rules.BLOCK_STARTS))


def glue(tail: Column, text: Column) -> Column:
    """What stands between a text and the tail of the one before it: nothing, a blank or an empty line.

    The tail's last sentence goes on when it has no closing mark and the text doesn't begin a block.
    """
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(glue_to(tail, new_block(text)))


def glue_to(tail: Column, block: Column) -> Column:
    """As ``glue`` for a text that isn't empty, of which only is known whether it begins a block."""
    closed = F.coalesce(tail, F.lit("")).rlike(r"(?:^|[.!?…][\"»”)]*)\s*$")
    return F.when(block | closed, "\n\n").when(tail.endswith("-"), "").otherwise(" ")


def markdown(c: Column) -> Column:
    """The least that a formatter does: line feeds only, no runs of empty lines, one line feed at the end."""
    lines = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), r"\n{3,}", "\n\n")
    return F.concat(F.regexp_replace(lines, r"\n+\z", ""), F.lit("\n"))
