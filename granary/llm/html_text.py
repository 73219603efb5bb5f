"""HTML extraction by deducing each host's template.

1. Every page is read as a tree. Each element is a token, told apart by its path of tags and by its class and id.
2. For each host, tokens are grouped by their occurrence vector, the number of times that they occur on each of the
   host's pages. Pages with the same text are one page. Vectors are never built: a token's vector is summed up as hashes
   of (page, count), so that a host's pages are added up before they are shuffled, however many there are.
3. A group is a valid class if it has tokens enough, on pages enough, and its tokens nest: those that lie in one
   another keep their order on all pages, which their paths give. The valid classes are the host's template.
4. What a template leaves open are slots. A slot is boilerplate if its words are mostly links, or if it holds the same
   words on every page of a host with several pages. Elements that say themselves what they are (navigation, footers,
   forms, adverts, comments, ...) need no deduction.
5. A page's text is what remains: if it has an article or main element, the blocks inside, and else all blocks, in both
   cases without boilerplate slots. The template never takes all text of a page, nor more than half of an article that
   says itself that it is one.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common

#: A template is deduced for hosts with so many pages; a class has so many tokens, on this part of the pages.
LEAST_PAGES, LEAST_TOKENS, LEAST_SUPPORT = 4, 3, 0.5
#: Templates are broadcast up to so many bytes, and joined beyond.
BROADCAST_BYTES = 16 << 20

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea xmp iframe noembed noframes title".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td template tfoot th "
    "thead title tr ul".split()
)
_DROP = frozenset(
    "aside audio button canvas datalist dialog embed footer form frame frameset head iframe input menu nav noembed "
    "noframes noscript object optgroup option script search select style template textarea title video xmp".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What closes an open element of that name, if it is the innermost of its kind.
_CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
        "menu nav ol p pre search section table ul".split()
    ),
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "option": frozenset({"option", "optgroup"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "head": frozenset({"body"}),
}
#: Names in a class or id that say that an element isn't part of the article, and those that say so outside of article elements only, where
#: they may as well be what the article is about.
_NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertisements adbox adslot adsense sponsor sponsored promo promos promotion banner banners cookie cookies cookiebar "
    "consent gdpr notice notices notification notifications popup popups modal newsletter subscribe subscription signup sidebar sidebars aside nav navs navbar "
    "navigation menu menus breadcrumb breadcrumbs pagination pager footer footers masthead topbar toolbar comment comments commentlist replies disqus "
    "share sharing social related recommended recommendations teaser teasers".split()
)
_NOT_PAGE = frozenset("alert alerts modals overlay login side foot reply respond widget widgets search toc copyright legal tag tags skip".split())
#: What such a name may be joined with by hyphens or underscores and still be one.
_BESIDE = frozenset(
    "area bar block bottom box btn button buttons col column container content form group head header heading icon icons inner inline item items label large left "
    "link links list main mast message middle mobile outer page panel post posts primary right row secondary section site skyscraper slot small sticky text title "
    "top unit wrap wrapper".split()
)


def _named(label: str, inside: bool) -> bool:
    """Whether one of the names in a class or id says that the element isn't part of the article; inside: it lies in an article element."""
    for name in label.lower().split():
        parts = [x for x in re.split(r"[-_]+", name) if x and not x.isdigit()]
        said = [x in _NOT_ARTICLE or not inside and x in _NOT_PAGE for x in parts]
        if any(said) and all(y or x in _BESIDE for x, y in zip(parts, said, strict=True)):
            return True
    return False


_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog toolbar".split())
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""\s*([^\s=>/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


@dataclass(slots=True)
class Element:
    name: str
    token: str
    dropped: bool  # it, or what it lies in, says that it isn't part of an article
    article: bool
    heading_only: bool
    link: bool


class Page:
    """The blocks of a page, in order: (text, token of the innermost block element, link letters, in article)."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, int, bool, bool]] = []
        self.tokens: dict[str, int] = {}
        self.has_article = False
        self._stack = [Element("", "", False, False, False, False)]
        self._text: list[str] = []
        self._links = 0
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                at = self._block()
                self.blocks.append((text, at.token, self._links, at.article, at.dropped))
            self._text, self._links = [], 0

    def _block(self) -> Element:
        for element in reversed(self._stack):
            if element.name in _BLOCK or element.article or len(element.name) == 0:
                return element
        return self._stack[0]

    def _say(self, text: str) -> None:
        at, text = self._stack[-1], html.unescape(text)
        if at.dropped or (at.heading_only and not any(e.name in _HEADINGS for e in self._stack)):
            # Boilerplate is read only for the template: it is a block of its own.
            if text.strip():
                self._flush()
                self.blocks.append((" ".join(text.split()), self._block().token, len(text) if at.link else 0, at.article, True))
            return
        self._text.append(text)
        if at.link:
            self._links += len(text)

    def _open(self, name: str, attributes: str, closed: bool) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            above = self._stack[i].name
            if name in _CLOSED_BY.get(above, ()):
                self._close_to(i)
                break
            if above in _BLOCK and above != "p":
                break
        if name in _BLOCK:
            self._flush()
        elif name == "br":
            self._text.append(" ")
        given = {}
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        parent = self._stack[-1]
        label = " ".join(filter(None, (given.get("class"), given.get("id"))))
        token = f"{parent.token}/{name}" + (f".{' '.join(sorted(given.get('class', '').split()))}" if given.get("class") else "") + (f"#{given['id']}" if given.get("id") else "")
        self.tokens[token] = self.tokens.get(token, 0) + 1
        if name in _VOID or closed:
            return
        role = given.get("role", "").lower()
        main = name in ("article", "main") or role in ("article", "main")
        dropped = parent.dropped or name in _DROP or role in _ROLES or (name not in ("html", "body", "article", "main") and _named(label, parent.article))
        dropped = dropped or (name == "article" and bool(re.search(r"(?i)comment|teaser|promo", label))) or "hidden" in given or given.get("aria-hidden") == "true"
        heading_only = parent.heading_only or (name == "header" and parent.article)
        dropped = dropped or (name == "header" and not parent.article)
        article = (parent.article or main) and not dropped
        self.has_article = self.has_article or (main and not dropped)
        self._stack.append(Element(name, token, dropped, article, heading_only, parent.link or name == "a"))

    def _close_to(self, i: int) -> None:
        if any(e.name in _BLOCK for e in self._stack[i:]):
            self._flush()
        del self._stack[i:]

    def _close(self, name: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].name == name:
                self._close_to(i)
                return
            if self._stack[i].name in ("article", "main", "body", "td", "table") and name not in ("html", "body", "article", "main", "table", "div", "section"):
                return

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            lt = source.find("<", at)
            if lt < 0:
                self._say(source[at:])
                return
            if lt > at:
                self._say(source[at:lt])
            after = source[lt + 1 : lt + 2]
            if source.startswith("<!--", lt):
                close = source.find("-->", lt + 4)
                at = end if close < 0 else close + 3
            elif after in ("!", "?"):
                close = source.find(">", lt)
                at = end if close < 0 else close + 1
            elif after == "/":
                close = source.find(">", lt)
                if close < 0:
                    return
                if name := _NAME.match(source, lt + 2):
                    self._close(name[0].lower())
                at = close + 1
            elif name := _NAME.match(source, lt + 1):
                close = self._tag_end(source, name.end())
                if close < 0:
                    return
                attributes = source[name.end() : close]
                closed = attributes.endswith("/")
                tag = name[0].lower()
                self._open(tag, attributes, closed)
                at = close + 1
                if tag in _RAW and not closed:
                    stop = re.compile(rf"</{tag}(?=[\s/>]|$)", re.IGNORECASE).search(source, at)
                    if stop is None:
                        return
                    at = stop.start()
            else:
                self._say("<")
                at = lt + 1

    @staticmethod
    def _tag_end(source: str, at: int) -> int:
        """The '>' that ends a tag, which quoted attribute values may hold."""
        while True:
            close = source.find(">", at)
            if close < 0:
                return -1
            between = source[at:close]
            if '"' not in between and "'" not in between:
                return close
            quote = min((q for q in (source.find('"', at), source.find("'", at)) if q >= 0))
            if quote > close or source[:quote].rstrip()[-1:] != "=" and "=" not in source[max(at, quote - 3) : quote]:
                return close
            other = source.find(source[quote], quote + 1)
            if other < 0:
                return close
            at = other + 1

    def text(self, slots: frozenset[str] = frozenset()) -> str:
        """The article. slots: tokens of the host's boilerplate slots."""
        own = [b for b in self.blocks if not b[4] and (b[3] or not self.has_article)]
        if slots:
            inside = {t: any(t == s or t.startswith(s + "/") for s in slots) for t in {b[1] for b in own}}
            left = [b for b in own if not inside[b[1]]]
            letters = sum(len(b[0]) for b in left)
            if 2 * letters >= sum(len(b[0]) for b in own) if self.has_article else letters:
                own = left
        return "\n".join(b[0] for b in own)

    def content(self) -> bytes:
        """A hash of the text as it is without a template."""
        return _digest(self.text())


def _digest(words: str) -> bytes:
    return hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each token of each page: how often it occurs, and the letters, link letters and hash of its own words."""
    for rows in batches:
        out = []
        for host, source in zip(rows["host"], rows["html"], strict=True):
            read = Page(source or "")
            content = read.content()
            own: dict[str, list] = {}
            for text, token, links, _, _ in read.blocks:
                seen = own.setdefault(token, [0, 0, []])
                seen[0] += len(text)
                seen[1] += links
                seen[2].append(text)
            for token, n in read.tokens.items():
                letters, links, words = own.get(token, (0, 0, []))
                out.append((host, token, content, n, letters, links, _digest("\n".join(words)) if words else None))
        yield pd.DataFrame(out, columns=["host", "token", "content", "n", "letters", "links", "words"])


def host_of(url: str) -> F.Column:
    return F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"://([^/?#]*)", 1)


def templates(pages: DataFrame) -> DataFrame:
    """(host, slots): the tokens of the boilerplate slots of each host that has some. pages: (host, html)."""
    common.small_batches(pages.sparkSession)
    seen = pages.mapInPandas(_observe, "host string, token string, content binary, n long, letters long, links long, words binary")
    # Pages with one text are one page: their rows are united before they are added up. Where such pages differ in
    # what isn't text, the smallest figures count.
    seen = seen.groupBy("host", "token", F.xxhash64("content").alias("page")).agg(F.min(F.struct("n", "letters", "links", F.xxhash64("words").alias("said"), F.col("words").isNotNull().alias("has"))).alias("x"))
    vector = F.xxhash64("page", "x.n")
    tokens = seen.select("host", "token", vector.alias("vector"), "x.letters", "x.links", "x.said", "x.has").groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.bit_xor("vector").alias("v1"), F.sum(F.shiftrightunsigned("vector", 32)).alias("v2"),
        F.sum("letters").alias("letters"), F.sum("links").alias("links"), F.min("said").alias("low"), F.max("said").alias("high"), F.count_if("has").alias("saying"),
    )
    tokens = common.cut(tokens)  # pages are read once, not for each of the two uses
    of_host = tokens.groupBy("host").agg(F.max("pages").alias("all_pages"))
    tokens = tokens.join(of_host, "host").where((F.col("all_pages") >= LEAST_PAGES) & (F.col("pages") >= F.col("all_pages") * LEAST_SUPPORT))
    same = (F.col("low") == F.col("high")) & (F.col("saying") == F.col("all_pages"))
    classes = tokens.groupBy("host", "v1", "v2", "pages").agg(
        F.count("*").alias("size"),
        F.collect_list(F.when((F.col("letters") > 0) & ((F.col("links") * 2 > F.col("letters")) | same), F.col("token"))).alias("slots"),
    )
    valid = classes.where(F.col("size") >= LEAST_TOKENS)
    return valid.groupBy("host").agg(F.flatten(F.collect_list("slots")).alias("slots")).where(F.size("slots") > 0)


def _extract(keep: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = rows[keep].copy()
            out["text"] = [Page(s or "").text(frozenset(t) if t is not None else frozenset()) for s, t in zip(rows["html"], rows["slots"], strict=True)]
            yield out

    return run


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html) and any other columns.

    text: the article's blocks in page order, joined by one line feed; character references are decoded and white
    space inside a block is one space. Null and empty html, and pages without an article: empty text, 0 letters. A
    null url is the empty host. Repeated rows each have a row, and are one page to the template. Pages and blocks may be
    of any length. Empty table: no rows. Other columns are not looked at.
    """
    spark = pages.sparkSession
    common.small_batches(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host_of("url"))
    slots = common.cut(templates(rows.select("host", "html")))
    size = slots.agg(F.sum(F.length("host") + F.length(F.array_join("slots", " "))).alias("n")).first()["n"] or 0
    # Far most pages say themselves what they are made of, so that this side is small; if it isn't, Spark joins as it sees fit.
    joined = rows.join(F.broadcast(slots) if size <= BROADCAST_BYTES else slots, "host", "left")
    out = joined.select("page_id", "url", "html", "slots").mapInPandas(_extract(["page_id", "url"]), "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
