"""Paragraphs of web pages.

Parsing one page is a small helper in an Arrow-batched function; cleaning, length limits and
distinctness are column expressions on its result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions import text as tx
from opslake.functions.batches import parts

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class Selector:
    """Which paragraphs of a page are wanted. ``None`` accepts any class."""

    container: str = "div"
    container_class: str | None = r"(WordSection|Section)\d+"
    paragraph: str = "p"
    paragraph_classes: frozenset[str] | None = frozenset({"MsoNormal", "Mecelle", "21"})
    skip_tags: frozenset[str] = frozenset({"table", "script", "style"})
    skip_classes: frozenset[str] = frozenset()
    skip_style: str | None = "border-bottom:double gray"


ARTICLE = Selector(container="article", container_class=None, paragraph_classes=None,
                   skip_tags=frozenset({"nav", "script", "style", "table"}), skip_classes=frozenset({"ad"}),
                   skip_style=None)


@dataclass
class _Open:
    tag: str
    container: int = 0
    skip: int = 0
    mute: int = 0
    text: list[str] | None = None


class _Reader(HTMLParser):
    """Keeps the open elements and, as counters, how many of them contain, skip or mute what follows."""

    def __init__(self, selector: Selector):
        super().__init__(convert_charrefs=True)
        self.want = selector
        self.stack: list[_Open] = []
        self.inside = self.skipped = self.muted = 0
        self.title: list[str] = []
        self.open_paragraphs: list[list[str]] = []
        self.paragraphs: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            self.handle_data(" ")
            return
        want, given = self.want, dict(attrs)
        classes = (given.get("class") or "").split()
        if tag == want.paragraph and self.open_paragraphs:
            self.handle_endtag(tag)
        entry = _Open(tag, mute=int(tag in ("script", "style")))
        entry.skip = int(tag in want.skip_tags or not want.skip_classes.isdisjoint(classes) or bool(
            want.skip_style and tag == "div" and want.skip_style in (given.get("style") or "")))
        entry.container = int(tag == want.container and (
            want.container_class is None or bool(re.match(want.container_class, " ".join(classes)))))
        if tag == want.paragraph and self.inside and not self.skipped and not entry.skip and (
                want.paragraph_classes is None or not want.paragraph_classes.isdisjoint(classes)):
            entry.text = []
            self.paragraphs.append(entry.text)
            self.open_paragraphs.append(entry.text)
        self.stack.append(entry)
        self._count(entry, 1)

    def _count(self, entry: _Open, step: int) -> None:
        self.inside += step * entry.container
        self.skipped += step * entry.skip
        self.muted += step * entry.mute

    def handle_endtag(self, tag):
        if not any(entry.tag == tag for entry in self.stack):
            return
        while True:
            entry = self.stack.pop()
            self._count(entry, -1)
            if entry.text is not None:
                self.open_paragraphs.pop()
            if entry.tag == tag:
                return

    def handle_data(self, data):
        if self.muted:
            return
        if self.open_paragraphs:
            self.open_paragraphs[-1].append(data)
        elif self.stack and self.stack[-1].tag == "title" and not self.inside:
            self.title.append(data)


def read_page(html: str | None, selector: Selector) -> tuple[str, list[str]]:
    reader = _Reader(selector)
    reader.feed(html or "")
    reader.close()
    return "".join(reader.title).strip(), ["".join(p) for p in reader.paragraphs]


def extract_paragraphs(pages: DataFrame, selector: Selector = ARTICLE, min_chars: int = tx.MIN_PARAGRAPH) -> DataFrame:
    """(page_id, url, title, pos, text): cleaned paragraphs, long enough and distinct within their page."""
    @F.arrow_udf("title string, paragraphs array<string>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for html in parts(batch):
                found = [read_page(h, selector) for h in html.to_pylist()]
                yield pa.StructArray.from_arrays(
                    [pa.array([t for t, _ in found], pa.string()), pa.array([p for _, p in found], pa.list_(pa.string()))],
                    names=["title", "paragraphs"])

    read_once = pages.select("page_id", "url", read("html").alias("_page"))
    cleaned = F.transform("_page.paragraphs", lambda p: tx.clean_whitespace(p))
    kept = F.array_distinct(F.filter(cleaned, lambda p: F.length(p) >= min_chars))
    return read_once.select(
        "page_id", "url", tx.clean_whitespace(F.col("_page.title")).alias("title"),
        F.posexplode_outer(kept).alias("pos", "text")).where(F.col("pos").isNotNull())


def first_section(pages: DataFrame, containers: list[Selector]) -> DataFrame:
    """Lines of the first container that has any; the first line names the document, the second its type."""
    @F.arrow_udf("array<string>")
    def lines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def first(page: str | None) -> list[str]:
            for selector in containers:
                found = [p.strip() for p in read_page(page, selector)[1]]
                found = [p for p in found if p]
                if found:
                    return found
            return []

        for batch in batches:
            for html in parts(batch):
                yield pa.array([first(h) for h in html.to_pylist()], pa.list_(pa.string()))

    read_once = pages.select("page_id", "url", lines("html").alias("_l"))
    kept = F.array_distinct(F.transform("_l", lambda p: tx.clean_whitespace(p)))
    return read_once.select("page_id", "url", kept.alias("_l")).where(F.size("_l") > 0).select(
        "page_id", "url", F.get("_l", F.lit(0)).alias("document_name"), F.get("_l", F.lit(1)).alias("document_type"),
        F.posexplode("_l").alias("pos", "text"))
