"""Text functions that no built-in covers, in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_BREAK = re.compile(r"(?<=[.!?…])[\"»”)]*\s+(?=[\"«“(—]?\s*[^\W_a-zа-яёәөүҗңһғҡҙҫ])")
_MARKS = {"em": "*", "i": "*", "strong": "**", "b": "**", "code": "`"}
_BLOCKS = {"p", "div", "section", "ul", "ol", "table", "blockquote", "pre", "tr"}


def split_sentences(text: str) -> list[str]:
    """Sentences by closing marks before a capital, a digit or a quote; nothing of the text is lost but blanks."""
    return [s for part in text.split("\n\n") for s in (x.strip() for x in _BREAK.split(part)) if s]


def sentences(c: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(split_sentences, na_action="ignore")

    return F.pandas_udf(run, "array<string>")(c)


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.links: list[str | None] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in ("script", "style", "head"):
            self.skip += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in _BLOCKS:
            self.out.append("\n\n")
        elif tag == "li":
            self.out.append("\n* ")
        elif tag == "br":
            self.out.append("\n")
        elif tag in _MARKS:
            self.out.append(_MARKS[tag])
        elif tag == "img":
            self.out.append(f"![{a.get('alt') or ''}]({a.get('src') or ''})")
        elif tag == "a":
            url = a.get("href") or ""
            absolute = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:|//", url)
            self.links.append(url if absolute else None)
            self.out.append("[" if absolute else "")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "head"):
            self.skip = max(0, self.skip - 1)
        elif tag in _MARKS:
            self.out.append(_MARKS[tag])
        elif tag == "a" and self.links:
            url = self.links.pop()
            self.out.append(f"]({url})" if url else "")
        elif tag in _BLOCKS or re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(re.sub(r"\s+", " ", data))


def markdown_of(html: str) -> str:
    """HTML as Markdown: blocks, headings, lists, emphasis, images, absolute links; relative links lose their link."""
    p = _Markdown()
    p.feed(html)
    p.close()
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(p.out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def html_to_markdown(c: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(markdown_of, na_action="ignore")

    return F.pandas_udf(run, "string")(c)
