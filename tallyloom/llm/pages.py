"""Main text of web pages: markup roles and differencing against the nearest URL."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.ranks import running_totals
from tallyloom.llm.storage import written

# Elements by what they mean for the text.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
OUTSIDE = frozenset(
    "head title script style noscript template iframe object svg canvas audio video nav aside form"
    " button select textarea dialog menu datalist".split()
)
# Outside the main text unless they are part of an article.
OUTSIDE_PAGE = frozenset(["header", "footer"])
MAIN = frozenset(["article", "main"])
# Words of class, id and role that mark what isn't main text.
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright discussion disqus footer form masthead menu menubar modal"
    " nav navbar navigation newsletter notice notices overlay pagination popup promo promoted related"
    " replies reply respond search share sharing sidebar sitemap skip social sponsor sponsored"
    " subscribe toolbar widget complementary contentinfo gdpr alert".split()
)
ABOUT_OTHERS = frozenset("has with without no is".split())
MAIN_WORDS = frozenset("article post entry story main maincontent".split())
# An element that opens closes these, if they are open right around it.
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}

MARKUP_OUT, MARKUP_IN, UNDECIDED = 0, 1, 2
# Elements whose content holds no tags and no text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())

_NAME = re.compile(r"[a-z0-9]+")
# What may begin a tag: a comment, a declaration, or a name, closing or not.
_BEGINS = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
# The rest of a tag in which quotes may hold a ">"; never gone back on.
_QUOTED_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])|display\s*:\s*none", re.IGNORECASE)


class _Lines:
    """The text lines of a page, one a block, each with what the markup says of it."""

    def __init__(self) -> None:
        self.open: list[tuple[str, bool, bool]] = []  # tag, outside, within main
        self.names: Counter[str] = Counter()  # of what is open
        self.outside = self.main = False
        self.parts: list[str] = []
        self.lines: list[tuple[str, int]] = []

    def shorten(self, at: int) -> None:
        self.names.subtract(tag for tag, *_ in self.open[at:])
        del self.open[at:]
        _, self.outside, self.main = self.open[-1] if self.open else ("", False, False)

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                role = MARKUP_OUT if self.outside else MARKUP_IN if self.main else UNDECIDED
                self.lines.append((text, role))

    def start(self, tag: str, attributes: str) -> None:
        inline = tag in INLINE
        if not inline:
            self.end_line()
        if tag in VOID:
            return
        closes = CLOSES.get(tag)
        while closes and self.open and self.open[-1][0] in closes:
            self.shorten(-1)
        if not inline and self.open and self.open[-1][0] == "p":
            self.shorten(-1)
        outside = self.outside or tag in OUTSIDE
        outside = outside or tag in OUTSIDE_PAGE and not (self.main and tag == "header")
        main = self.main or tag in MAIN
        if attributes and tag not in ("html", "body"):
            words = _marked(attributes)
            outside = outside or bool(words & OUTSIDE_WORDS) or bool(_HIDDEN.search(attributes))
            main = main or bool(words & MAIN_WORDS)
        if not inline or (outside, main) != (self.outside, self.main):
            self.end_line()
            self.open.append((tag, outside, main))
            self.names[tag] += 1
            self.outside, self.main = outside, main

    def end(self, tag: str) -> None:
        """Closes the nearest open element of this name and what stands open in it."""
        if tag == "br" or tag == "p":
            self.end_line()
        if not self.names[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.end_line()
                self.shorten(at)
                return


def _marked(attributes: str) -> set[str]:
    """The words of class, id and role; names such as has-sidebar speak of others."""
    words: set[str] = set()
    for value in _MARKS.findall(attributes):
        for name in value.lower().split():
            parts = _NAME.findall(name)
            if parts and parts[0] not in ABOUT_OTHERS:
                words.update(parts)
    return words


def _tags(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, slash, name and attributes of each tag; comments have no name.

    One pass at any size and however broken: what has been looked for in vain up to the
    end of the page isn't looked for again. A quote that is never closed ends a tag at the
    next ">", and from there on quotes don't count. A caller may send where to go on.
    """
    at, quotes = 0, True
    while found := _BEGINS.search(html, at):
        comment, declaration, slash, name = found.groups()
        stop, attributes = -1, ""
        if comment:
            stop = html.find("-->", found.end())
            stop = len(html) if stop < 0 else stop + 3
        else:
            whole = _QUOTED_REST.match(html, found.end()) if quotes and not declaration else None
            if whole:
                stop = whole.end()
            else:
                quotes = quotes and bool(declaration)
                stop = html.find(">", found.end()) + 1
                if not stop:  # no tag ends from here on, comments do
                    at = html.find("<!--", found.end())
                    if at < 0:
                        return
                    continue
            attributes = html[found.end() : stop - 1]
        jump = yield found.start(), stop, slash or "", "" if declaration else name or "", attributes
        at = stop if jump is None else jump
        if jump is not None:
            yield  # answers the send


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """(text, role) of each block in page order. White space within is one space."""
    html, page, at = html or "", _Lines(), 0
    tags = _tags(html)
    for start, stop, slash, tag, attributes in tags:
        if start > at:
            page.parts.append(_decoded(html[at:start]))
        at = stop
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            page.end(tag)
        elif tag in RAW:
            page.end_line()
            ends = re.compile(f"</{tag}", re.IGNORECASE).search(html, at)
            at = ends.start() if ends else len(html)
            tags.send(at)
        else:
            page.start(tag, attributes)
            if attributes.endswith("/") and tag not in VOID and tag in OUTSIDE:
                page.end(tag)
    page.parts.append(_decoded(html[at:]))
    page.end_line()
    return page.lines


def _decoded(text: str) -> str:
    return unescape(text) if "&" in text else text


def common(a: list[int], b: list[int]) -> np.ndarray:
    """Which entries of `a` lie in a longest common subsequence with `b`.

    Equal ends are set aside first. The rest goes by bit vectors: one whole number
    for each entry of `b`, from which the subsequence is read backwards.
    """
    found = np.zeros(len(a), dtype=bool)
    low, high_a, high_b = 0, len(a), len(b)
    while low < min(high_a, high_b) and a[low] == b[low]:
        low += 1
    while low < min(high_a, high_b) and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
    found[:low] = found[high_a:] = True
    a, b = a[low:high_a], b[low:high_b]
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows, row = [], full
    for x in b:  # a zero at i: the subsequence grows with entry i of a
        match = where.get(x, 0)
        row = ((row + (row & match)) | (row & ~match)) & full
        rows.append(row)
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        below = rows[j - 1] if j else full
        if not rows[j] >> i & 1:
            if not below >> i & 1:
                j -= 1
            else:
                found[low + i] = True
                i, j = i - 1, j - 1
        else:
            i -= 1
    return found


def _place(url: str | None) -> tuple[str, str]:
    """Host, and the path with its parts set apart so that they sort as a tree."""
    rest = (url or "").split("://", 1)[-1].split("#", 1)[0].split("?", 1)[0]
    host, _, path = rest.partition("/")
    return host.lower(), "\x01".join(path.strip("/").split("/"))


def _parsed(pages: DataFrame) -> DataFrame:
    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            places = [_place(url) for url in frame["url"]]
            signs = []
            for html in frame["html"]:
                lines = page_lines(html)
                signs.append([xxhash.xxh3_64_intdigest(text) - (1 << 63) for text, _ in lines])
            yield pd.DataFrame(
                {
                    "page_key": frame["page_key"],
                    "host": [host for host, _ in places],
                    "path": [path for _, path in places],
                    "signs": signs,
                }
            )

    return pages.select(_page_key().alias("page_key"), "url", "html").mapInPandas(
        parse,
        "page_key bigint, host string, path string, signs array<bigint>",
    )


def _page_key():
    return F.xxhash64(
        F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", F.col("html").isNull(), "html"
    )


def shared_lines(pages: DataFrame) -> DataFrame:
    """page_key and shared: for each line whether the page's nearest page has it as well.

    Pages of a host stand in the order of their paths; each is laid beside the next
    before and after it, whichever shares more of the path, the one before if
    both do. Their lines are aligned by longest common subsequence of 64-bit
    hashes. Pages that are equal throughout tell nothing about templates: a run of them
    counts as one page, laid beside the pages before and after the run, and all of them
    get what it shares. Only hashes move, and a host of any size is dealt out by path.
    Pages without a shared line have no row.
    """
    parsed = written(_parsed(pages), "page-lines")
    order = running_totals(
        parsed.drop("signs").distinct(), ["host"], ["path", "page_key"], F.lit(1), "at"
    ).join(parsed.select("page_key", "signs").dropDuplicates(["page_key"]), "page_key")
    order = written(order, "page-order")
    sides = [
        order.select(
            "host", (F.col("at") + step).alias("at"), F.struct("path", "signs").alias(name)
        )
        for name, step in (("before", 1), ("after", -1))
    ]
    beside = order.join(sides[0], ["host", "at"], "left").join(sides[1], ["host", "at"], "left")

    @F.pandas_udf("array<boolean>")
    def shared(
        first: pd.Series, last: pd.Series, signs: pd.Series, before: pd.DataFrame, after: pd.DataFrame
    ) -> pd.Series:
        found = []
        for i in range(len(first)):
            own = list(signs.iloc[i])
            sides = [
                (_common_parts(path.iloc[i], side["path"].iloc[i]), list(side["signs"].iloc[i]))
                for path, side in ((first, before), (last, after))
                if side["signs"].iloc[i] is not None
            ]
            sides = [(near, other) for near, other in sides if other != own]
            if not sides:
                found.append([])
                continue
            nearest = max(sides, key=lambda side: side[0])[1]
            lines = common(own, nearest)
            found.append(lines.tolist() if lines.any() else [])
        return pd.Series(found)

    # what is kept of a member of a run; at its ends also what stands beside it
    goes_on = [F.coalesce(F.col(f"{side}.signs") == F.col("signs"), F.lit(False)) for side in ("before", "after")]
    starts, ends = ~goes_on[0], ~goes_on[1]
    run = F.struct(
        "host", "at", "path", starts.alias("starts"), ends.alias("ends"),
        F.when(starts, F.col("signs")).alias("signs"),
        F.when(starts, F.col("before")).alias("before"), F.when(ends, F.col("after")).alias("after"),
    )
    found = written(
        beside.select(
            "page_key",
            shared("path", "path", "signs", "before", "after").alias("shared"),
            F.when(goes_on[0] | goes_on[1], run).alias("run"),
        ),
        "page-shared",
    )
    lines = found.where("run is null").select("page_key", "shared")
    runs = found.where("run is not null").select("page_key", "run.*")
    if not runs.isEmpty():
        first = F.col("starts").cast("int")
        places = runs.select("page_key", "host", "at", "starts")
        numbered = written(
            running_totals(places, ["host"], ["at"], first, "n").select(
                "page_key", "host", (F.col("n") + first).alias("n")
            ),
            "page-runs",
        )
        ends_of = runs.where("ends").select("page_key", F.col("path").alias("last"), "after")
        whole = (
            runs.where("starts").select("page_key", F.col("path").alias("first"), "signs", "before")
            .join(numbered, "page_key").drop("page_key")
            .join(ends_of.join(numbered, "page_key").drop("page_key"), ["host", "n"])
            .select("host", "n", shared("first", "last", "signs", "before", "after").alias("shared"))
        )
        lines = lines.unionByName(numbered.join(whole, ["host", "n"]).select("page_key", "shared"))
    return lines.where(F.size("shared") > 0)


def _common_parts(a: str, b: str) -> float:
    """Equal leading parts of two paths, and as a fraction equal leading characters."""
    x, y = a.split("\x01"), b.split("\x01")
    n = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    chars = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
    return n + chars / (1 + max(len(a), len(b)))


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    What the markup sets outside the article is left out, what it sets inside
    stays. A line of which it says neither stays unless the nearest page of the
    host has it too. A shared line inside an article is a quotation or an equal
    headline, not a template, and stays. If every line of a page without an
    article is shared, none is taken for a template.

    Null html: empty text. Null url: such pages are a host of their own. Repeated
    rows get a row each. Blocks are joined by one space in page order.
    """

    @F.pandas_udf("array<struct<n int, text string, main boolean>>")
    def lines(html: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"n": n, "text": text, "main": role == MARKUP_IN}
                    for n, (text, role) in enumerate(page_lines(page))
                    if role != MARKUP_OUT
                ]
                for page in html
            ]
        )

    kept = F.filter(
        "lines", lambda line: line["main"] | ~F.coalesce(F.get("shared", line["n"]), F.lit(False))
    )
    texts = F.transform(
        F.when(F.size(kept) > 0, kept).otherwise(F.col("lines")), lambda line: line["text"]
    )
    return (
        pages.select("page_id", "url", _page_key().alias("page_key"), lines("html").alias("lines"))
        .join(shared_lines(pages), "page_key", "left")
        .select("page_id", "url", F.array_join(texts, " ").alias("text"))
        .withColumn("n_chars", F.length("text").cast("bigint"))
    )
