"""Main-content extraction and links from crawled pages (HTM-1..10)."""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

_words = lambda s: frozenset(s.split())
#: Elements and containers taken out, phrases of boilerplate, limits.
NOISE_TAGS = _words("script style noscript iframe svg canvas nav footer header form aside menu button select option input textarea figure figcaption picture dialog template")
NOISE_NAMES = "cookie gdpr consent banner popup modal advertisement ad- promo sidebar widget breadcrumb pagination share social related subscribe newsletter comment".split()
BOILERPLATE = ("click here", "read more", "learn more", "sign up", "subscribe now", "cookie", "privacy policy", "terms of service", "all rights reserved", "javascript is disabled", "enable javascript", "skip to content", "back to top")
MIN_PARAGRAPH, MAX_PARAGRAPH, MAX_BYTES, MIN_TEXT = 40, 5000, 5 << 20, 80
SEPARATORS = "[|•·▸►▪‣⁃]+"

_void = _words("area base br col embed hr img input link meta source track wbr")
_ends_p = _words("address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul")
_depth = 200


class _Node:
    __slots__ = ("attrs", "kids", "tag", "up")

    def __init__(self, tag: str, attrs: dict, up: _Node | None):
        self.tag, self.attrs, self.up, self.kids = tag, attrs, up, []

    def walk(self):
        """The node and all elements below, in document order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [k for k in reversed(node.kids) if isinstance(k, _Node)]

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo += reversed(x.kids)
        return "".join(out)


class _Markup(HTMLParser):
    """Tags and text; declarations of any kind are comments, and what the page's end cuts short goes."""

    def _upto(self, end: int) -> int:
        return len(self.rawdata) if end < 0 else end

    def parse_starttag(self, i: int) -> int:
        return self._upto(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._upto(super().parse_endtag(i))

    def parse_comment(self, i: int, report: bool = True) -> int:
        return self._upto(super().parse_comment(i, report))

    def parse_pi(self, i: int) -> int:
        end = self.rawdata.find(">", i + 2)
        return self._upto(end + 1 if end >= 0 else -1)

    parse_html_declaration = parse_pi


class _Tree(_Markup):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.level = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ends_p:
            self._end("p", _words("td th table button"))
        if tag == "li":
            self._end("li", _words("ul ol menu"))
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in _void and self.level < _depth:
            self.at, self.level = node, self.level + 1

    def _end(self, tag: str, stop: frozenset = frozenset()) -> None:
        node, n = self.at, 0
        while node.up is not None:
            if node.tag == tag:
                self.at, self.level = node.up, self.level - n - 1
                return
            if node.tag in stop:
                return
            node, n = node.up, n + 1

    def handle_endtag(self, tag: str) -> None:
        self._end(tag)

    def handle_data(self, data: str) -> None:
        self.at.kids.append(data)


def clean_text(text: str) -> str:
    text = unicodedata.normalize("NFKC", text)
    text = re.sub("[ \t]+", " ", re.sub(SEPARATORS, " ", text))
    return re.sub("\n{3,}", "\n\n", text.replace("\r\n", "\n").replace("\r", "\n")).strip()


def _same(text: str) -> str:
    return re.sub(r"\s+", " ", text.lower().strip())


def _prune(root: _Node) -> None:
    """Takes out noise elements with the text that directly follows them, then noise containers alike."""

    def drop(bad) -> None:
        for node in list(root.walk()):
            if not any(isinstance(k, _Node) and bad(k) for k in node.kids):
                continue
            kept, skipping = [], False
            for k in node.kids:
                if isinstance(k, str):
                    if not skipping:
                        kept.append(k)
                    continue
                skipping = bad(k)
                if not skipping:
                    kept.append(k)
            node.kids = kept

    drop(lambda k: k.tag in NOISE_TAGS)
    drop(lambda k: any(n in f"{k.attrs.get('class', '')} {k.attrs.get('id', '')}".lower() for n in NOISE_NAMES))


def extract(html: str | None) -> tuple[str, str] | None:
    """(title, text) or None: title, headings h1 to h4, then paragraphs of 40 to 5,000 characters."""
    if not html or len(html.encode("utf-8", "surrogatepass")) > MAX_BYTES:
        return None
    tree = _Tree()
    tree.feed(html)
    tree.close()
    root = tree.root
    _prune(root)
    first: dict[str, str] = {}
    headings, paragraphs = [], []
    for node in root.walk():
        if node.tag in ("title", "h1") and node.tag not in first:
            first[node.tag] = clean_text(node.text())
        if node.tag in ("h1", "h2", "h3", "h4"):
            headings.append(clean_text(node.text()))
        elif node.tag == "p":
            raw = node.text().strip()
            if MIN_PARAGRAPH <= len(raw) <= MAX_PARAGRAPH and not any(b in raw.lower() for b in BOILERPLATE):
                paragraphs.append(clean_text(raw))
    title = first.get("title") or first.get("h1") or ""
    headings = [h for h in headings if h and _same(h) != _same(title)]
    paragraphs = [p for p in paragraphs if p]
    text = clean_text("\n\n".join(x for x in [title, *headings, *paragraphs] if x))
    if len(text) < MIN_TEXT or _same(text) == _same(title) or len(text) < len(title) + 60 or (not paragraphs and len(text) < 200):
        return None
    return title, text


class _Links(_Markup):
    def __init__(self):
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v][:1]


def links(html: str | None, most: int = 500_000) -> list[str]:
    """Targets of <a href> in order, repeats kept, in the first `most` characters."""
    parser = _Links()
    parser.feed((html or "")[:most])
    return parser.found


_EXTRACTED = StructType([StructField("title", StringType()), StructField("text", StringType()), StructField("failed", BooleanType())])


@pandas_udf(_EXTRACTED)
def extract_udf(html: pd.Series) -> pd.DataFrame:
    """title, text (null without main content), and whether the extractor raised: one page never fails its batch."""

    def one(x: str | None) -> tuple:
        try:
            return *(extract(x) or (None, None)), False
        except Exception:
            return None, None, True

    return pd.DataFrame([one(x) for x in html], columns=["title", "text", "failed"])


@pandas_udf(ArrayType(StringType()))
def links_udf(html: pd.Series) -> pd.Series:
    return html.map(links)


def try_extract(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """Adds `title`, `text` and `failed` to every row, without the html."""
    kept = [c for c in pages.columns if c not in (html_col, "title", "text", "failed")]
    return pages.withColumn("x", extract_udf.asNondeterministic()(F.col(html_col))).select(*kept, "x.title", "x.text", "x.failed")


def extract_pages(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """`title` and `text` of the rows with main content; the others are left out (dead letters: see streaming)."""
    return try_extract(pages, html_col=html_col).where("text is not null").drop("failed")


def page_links(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """url, pos, href of every link."""
    return pages.select(F.col(url_col).alias("url"), F.posexplode(links_udf(F.col(html_col))).alias("pos", "href"))
