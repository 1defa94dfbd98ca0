"""Main text of pages: structure first, then differencing with the page of the nearest url.

A page is read into text lines, one per block, in page order.  Elements that are
never article (navigation, forms, scripts, ...) and elements marked as such
(role, class or id words) are left out.  Every page is then compared with pages of
its host, nearest url paths first, that are not copies of it: a longest common
subsequence aligns two pages.  If the page names its article (an ``article`` or
``main`` element), the text is its lines without those that at least five of the
six nearest pages share (articles may have passages in common).  Otherwise
the lines shared with the nearest page are template and go.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, release
from .urls import split_url

START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?])")
QUOTE_OR_END = re.compile(r"""[>"']""")
MARK = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "img"}
NEVER = {"nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "noscript", "template",
         "svg", "canvas", "audio", "video", "object", "applet", "map", "fieldset", "datalist", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
         "menubar", "toolbar", "form", "tablist", "status"}
#: Words of a class or id that mark page furniture.
FURNITURE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adslot", "sponsor",
             "sponsored", "promo", "promotion", "banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb",
             "breadcrumbs", "footer", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay",
             "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments", "disqus", "reply",
             "replies", "respond", "discussion", "related", "recommended", "recommendations", "share", "sharing",
             "social", "widget", "widgets", "pagination", "pager", "masthead", "topbar", "toolbar", "copyright",
             "legal", "disclaimer", "skip", "search", "tags", "alert", "paywall"}
HEADER = {"header", "head", "hero"}
CONTENT = {"article", "articlebody", "main", "content", "post", "entry", "story", "body"}
BREAKS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3",
            "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
#: Share of the shorter page's characters in common lines from which two pages are copies.
COPY = 0.8
#: Number of host names up to which a list of them is broadcast.
BROADCAST_HOSTS = 100_000


def _marks(attributes: str) -> tuple[set[str], set[str]]:
    """Words of class and id, and the roles, of a start tag."""
    words: set[str] = set()
    roles: set[str] = set()
    for name, value in MARK.findall(attributes):
        value = value.strip("\"'")
        if name.lower() in ("role", "itemprop"):
            roles.update(value.lower().split())
        else:
            for token in value.split():  # "has-sidebar" tells of a layout, not of a sidebar
                found = [w.lower() for w in WORDS.findall(token)]
                if found and found[0] not in ("has", "with", "no", "without"):
                    words.update(found)
    return words, roles


def _furniture(name: str, attributes: str, in_main: bool) -> bool:
    if name in NEVER or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body", "main", "article") and "=" not in attributes:
        return False
    if HIDDEN.search(attributes):
        return True
    words, roles = _marks(attributes)
    if roles & ROLES:
        return True
    if name in ("html", "body") or "articlebody" in roles:
        return False
    if words & FURNITURE:
        return True
    return bool(words & HEADER) and not in_main and not words & CONTENT


class Tags:
    """Tags of a page from left to right, in time linear in the page however long an attribute is.

    A tag ends at the first ``>`` outside quotes.  If one of its quotes is never closed, it
    ends at its first ``>``; quotes from which that was found out are remembered.
    """

    def __init__(self, page: str):
        self.page, self.unclosed = page, set()

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes start at ``at`` (-1: none)."""
        page, p, met = self.page, at, []
        while q := QUOTE_OR_END.search(page, p):
            if q.group() == ">":
                return q.start()
            met.append(q.start())
            close = -1 if q.start() in self.unclosed else page.find(q.group(), q.end())
            if close < 0:
                break
            p = close + 1
        self.unclosed.update(met)
        return page.find(">", at)

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start and end of the next tag, whether it closes, its name ("" for comments and such) and attributes."""
        page = self.page
        while m := START.search(page, at):
            if m.group(1):
                end = page.find("-->", m.end())
                return m.start(), len(page) if end < 0 else end + 3, False, "", ""
            end = self._end(m.end()) if m.group(3) else page.find(">", m.end())
            if end >= 0:
                return m.start(), end + 1, bool(m.group(2)), (m.group(3) or "").lower(), page[m.end():end]
            rest = page.find("<!--", m.end())  # no tag ends from here on, but a comment may begin
            if rest < 0:
                return None
            at = rest
        return None


def lines(page: str | None) -> tuple[list[str], list[bool]]:
    """Text lines of a page outside furniture, and for each whether it is in the page's named article."""
    if not page:
        return [], []
    out: list[str] = []
    inside: list[bool] = []
    stack: list[tuple[str, bool, bool]] = []
    piece: list[str] = []
    skip = main = False

    def close() -> None:
        if piece:
            text = " ".join(entities.unescape("".join(piece)).split())
            piece.clear()
            if text:
                out.append(text)
                inside.append(main)

    at, n, tags = 0, len(page), Tags(page)
    while at < n:
        tag = tags.after(at)
        if tag is None:
            if not skip:
                piece.append(page[at:])
            break
        start, end, closes, name, attributes = tag
        if start > at and not skip:
            piece.append(page[at:start])
        at = end
        if not name:
            continue
        if closes:
            if any(s[0] == name for s in stack):
                close()
                while stack.pop()[0] != name:
                    pass
                skip, main = stack[-1][1:] if stack else (False, False)
            elif name not in INLINE and not skip:
                close()
            continue
        if name in RAW:
            if name not in INLINE:
                close()
            end = re.compile(f"</{name}[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in VOID:
            if name in ("br", "hr"):
                piece.append(" ") if name == "br" else close()
            continue
        if name == "body":  # ends a head that was left open
            close()
            stack.clear()
            skip = main = False
        if stack and (stack[-1][0] == "p" and name in BREAKS_P or stack[-1][0] in SAME_CLOSES.get(name, ())):
            close()
            stack.pop()
            skip, main = stack[-1][1:] if stack else (False, False)
        bad = skip or _furniture(name, attributes, main)
        if name in INLINE and not (bad and not skip):
            continue
        if attributes.rstrip().endswith("/") and name not in ("p", "div", "li", "td"):
            continue  # an empty element in the XML manner
        if name not in INLINE or bad:
            close()
        skip, main = bad, main or name in ("article", "main") or "main" in _marks(attributes)[1] \
            or "articlebody" in _marks(attributes)[1]
        stack.append((name, skip, main))
    close()
    return out, inside


def common_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b`` (bit-parallel)."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(bits == 0)))


def common_subsequence(a: list[int], b: list[int], base: int = 0) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (divide and conquer, linear memory)."""
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    found = list(range(base, base + front))
    a, b, base = a[front:], b[front:], base + front
    back = 0
    while back < min(len(a), len(b)) and a[-1 - back] == b[-1 - back]:
        back += 1
    tail = list(range(base + len(a) - back, base + len(a)))
    a, b = a[:len(a) - back], b[:len(b) - back]
    if len(a) == 1 and a[0] in b:
        found.append(base)
    elif len(a) > 1 and b:
        half = len(a) // 2
        left, right = common_lengths(a[:half], b), common_lengths(a[half:][::-1], b[::-1])
        cut = int(np.argmax(left + right[::-1]))
        found += common_subsequence(a[:half], b[:cut], base) + common_subsequence(a[half:], b[cut:], base + half)
    return found + tail


def shared_path(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def is_copy(own: list[int], own_sizes: list[int], other: list[int], other_sizes: list[int], share: float) -> bool:
    """Whether the pages have ``share`` of the shorter one's characters in common lines."""
    size = dict(zip(own, own_sizes, strict=True))
    both = Counter(own) & Counter(other)
    return sum(size[m] * n for m, n in both.items()) >= share * min(sum(own_sizes), sum(other_sizes))


def template_lines(own: tuple, path: str, others: list[tuple[str, tuple]], copy: float = COPY) -> list[int]:
    """Places of lines shared with the nearest page by path that shares some and is not a copy of this one.

    Pages are ``(line hashes, line lengths)``; a copy tells nothing about the
    template, nor does a page without a line in common.  ``others`` come nearest first; of equally near ones the first counts.
    """
    for _, (_, other) in sorted(enumerate(others), key=lambda x: (-shared_path(path, x[1][0]), x[0])):
        if other[0] and not is_copy(*own, *other, copy) and (shared := common_subsequence(own[0], other[0])):
            return shared
    return []


def voted_lines(own: tuple, others: list[tuple], support: int = 5, copy: float = COPY) -> list[int]:
    """Places of lines that at least ``support`` of the other pages share; copies of this page have no vote."""
    votes: Counter = Counter()
    seen = set(own[0])
    for other in others:
        if not seen.isdisjoint(other[0]) and not is_copy(*own, *other, copy):
            votes.update(common_subsequence(own[0], other[0]))
    return sorted(i for i, n in votes.items() if n >= support)


LIGHT = "page_id long, row long, host string, path string, open boolean, marks array<long>, sizes array<int>"


def line_marks(rows: DataFrame) -> DataFrame:
    """Light rows: each page's host, path, line hashes and lengths, and whether it names no article."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            read = [lines(h) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "row": b["row"], "host": b["host"],
                                "path": b["path"], "open": [not any(inside) for _, inside in read],
                                "marks": [[xxhash.xxh64_intdigest(t) - (1 << 63) for t in text] for text, _ in read],
                                "sizes": [[len(t) for t in text] for text, _ in read]})

    return rows.select("page_id", "row", "host", "path", "html").mapInPandas(run, LIGHT)


def neighbours(light: DataFrame, block: int = 128, reach: int = 3) -> DataFrame:
    """``page_id, row, template`` (places of template lines) of every page that has some.

    Pages of a host with the same lines are folded: the first by path stands for
    all.  What is left is put in the order (host, path, id) and cut into blocks; a
    block also holds the ``2 * reach`` pages before and after it, so no window spans
    a host and the result does not depend on how Spark cut its partitions.  An open
    page looks ``reach`` pages back and ahead, another asks the ``2 * reach``
    nearest.  Pages that find copies only search on (see ``farther``).
    """
    light = light.withColumn("key", F.struct(F.xxhash64("marks").alias("a"), F.xxhash64(F.lit(1), "marks").alias("b")))
    same, order = ["host", "open", "key"], ["host", "path", "page_id", "row"]
    folded = light.groupBy(*same).agg(F.min(F.struct("path", "page_id", "row")).alias("lead"), F.first("marks").alias("marks"),
                                      F.first("sizes").alias("sizes")).select("lead.*", "marks", "sizes", *same)
    placed = cut_lineage(folded.repartitionByRange(*order)
                         .sortWithinPartitions(*order).withColumn("m", F.monotonically_increasing_id()))
    part = F.shiftright("m", 33)
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    first, n = [], 0
    for p in sorted(sizes):  # one number a partition
        first.append((p, n))
        n += sizes[p]
    start = light.sparkSession.createDataFrame(first, "p long, start long")
    at = placed.withColumn("p", part.cast("long")).join(F.broadcast(start), "p").select(
        *same, "path", "marks", "sizes", (F.col("start") + F.col("m") - F.shiftleft("p", 33)).alias("at"))
    at = at.withColumn("home", F.floor(F.col("at") / block))
    blocks = F.array_distinct(F.array(F.floor((F.col("at") - 2 * reach) / block), F.col("home"),
                                      F.floor((F.col("at") + 2 * reach) / block)))
    spread = at.drop("key").withColumn("block", F.explode(blocks))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at").reset_index(drop=True)
        host, path = rows["host"].tolist(), rows["path"].tolist()
        marks = [(list(m), list(s)) for m, s in zip(rows["marks"], rows["sizes"], strict=True)]
        out = []
        for i in np.flatnonzero(rows["home"] == rows["block"]):
            near = [j for k in range(1, 2 * reach + 1) for j in (i - k, i + k)
                    if 0 <= j < len(rows) and host[j] == host[i]]
            if rows["open"][i]:
                gone = template_lines(marks[i], path[i], [(path[j], marks[j]) for j in near if abs(j - i) <= reach])
                alone = not gone
            else:
                asked = [marks[j] for j in near[:2 * reach]]
                gone, alone = voted_lines(marks[i], asked), any(is_copy(*marks[i], *m, COPY) for m in asked)
            whole = (host[i], path[i], *marks[i], rows["home"][i]) if alone and near else (None,) * 5
            out.append((rows["at"][i], gone, alone and bool(near), rows["open"][i], *whole))
        made = pd.DataFrame(out, columns=["at", "template", "alone", "open", "host", "path", "marks", "sizes", "home"])
        made["home"] = made["home"].astype("Int64")
        return made

    near = cut_lineage(spread.groupBy("block").applyInPandas(
        run, "at long, template array<int>, alone boolean, open boolean, host string, path string, marks array<long>, "
             "sizes array<int>, home long"))
    more = farther(at.drop("key"), near.where("alone").drop("template", "alone"), 2 * reach)
    found = near.select("at", "template").join(more, "at", "left").select(
        "at", F.coalesce("better", "template").alias("template")).where(F.size("template") > 0)
    return (light.select("page_id", "row", *same).join(at.join(found, "at").select(*same, "template"), same)
            .select("page_id", "row", "template").dropDuplicates(["page_id", "row"]))


def farther(at: DataFrame, seekers: DataFrame, voters: int, support: int = 5) -> DataFrame:
    """``at, better`` (places of template lines) of pages whose nearest pages are copies of them.

    Rounds meet blocks ever farther away, until an open page has a partner, any
    other has ``voters`` pages to ask, or the host ends.  A pair of blocks is one
    task's work.  Pages without a line that enough others of the host have stay out.
    """
    hosts = cut_lineage(seekers.select("host").distinct())
    if hosts.count() <= BROADCAST_HOSTS:  # proven small: the other hosts' pages need not be shuffled
        hosts = F.broadcast(hosts)
    at = at.join(hosts, "host", "left_semi")
    lines_of = at.select("host", F.explode(F.array_distinct("marks")).alias("mark"))
    known = lines_of.groupBy("host", "mark").agg(F.count("*").alias("n")).where("n > 1")
    able = (seekers.select("at", "open", "host", F.explode("marks").alias("mark")).join(known, ["host", "mark"])
            .where(F.col("open") | (F.col("n") > support)).select("at").distinct())
    left = cut_lineage(seekers.join(able, "at", "left_semi"))
    ends = at.groupBy("host").agg(F.min("home").alias("low"), F.max("home").alias("high"))

    def look(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        pages = [(a, p, list(m), list(s)) for a, p, m, s in
                 zip(others["at"], others["path"], others["marks"], others["sizes"], strict=True) if len(m)]
        out = []
        for a, path, open_, marks, sizes in zip(own["at"], own["path"], own["open"], own["marks"], own["sizes"], strict=True):
            marks, sizes, seen = list(marks), list(sizes), set(marks)
            near = [(-shared_path(path, q) if open_ else 0, abs(a - b), b, m, s) for b, q, m, s in pages
                    if b != a and not (open_ and seen.isdisjoint(m))]
            kept = 0
            for score, far, b, m, s in sorted(near, key=lambda x: x[:3]):
                if not is_copy(marks, sizes, m, s, COPY):
                    out.append((a, open_, -score, far, b, common_subsequence(marks, m)))
                    kept += 1
                    if kept == (1 if open_ else voters):
                        break
        return pd.DataFrame(out, columns=["at", "open", "score", "far", "other", "shared"])

    found, inner, outer = None, -1, 1
    while found is None or not left.isEmpty():
        ring = left.join(ends, "host").withColumn("block", F.explode(F.filter(
            F.sequence(F.greatest("low", F.col("home") - outer), F.least("high", F.col("home") + outer)),
            lambda b: F.abs(b - F.col("home")) > inner)))
        meets = ring.select("host", F.col("home").alias("seeker"), "block").distinct()
        others = at.withColumnRenamed("home", "block").join(meets, ["host", "block"])
        keys = ["host", "seeker", "block"]
        own = ring.withColumnRenamed("home", "seeker")
        own, others = own.toDF(*own.columns), others.toDF(*others.columns)  # else both sides have the same columns
        part = cut_lineage(own.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInPandas(
            look, "at long, open boolean, score int, far long, other long, shared array<int>"))
        found = part if found is None else found.unionByName(part)
        done = found.groupBy("at", "open").agg(F.count("*").alias("n")).where(F.col("open") | (F.col("n") >= voters))
        left = cut_lineage(left.join(ends, "host").where((F.col("home") - outer > F.col("low")) | (F.col("home") + outer < F.col("high")))
                           .drop("low", "high").join(done, "at", "left_anti"))
        inner, outer = outer, 4 * outer
    one = found.where("open").groupBy("at").agg(F.max_by("shared", F.struct("score", -F.col("far"), -F.col("other"))).alias("better"))
    w = Window.partitionBy("at").orderBy("far", "other")
    votes = (found.where("not open").withColumn("r", F.row_number().over(w)).where(F.col("r") <= voters)
             .select("at", F.explode("shared").alias("place")).groupBy("at", "place").agg(F.count("*").alias("n"))
             .where(F.col("n") >= support).groupBy("at").agg(F.sort_array(F.collect_list("place")).alias("better")))
    return one.unionByName(votes)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; a null or empty page has the text ''.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by one space.  Repeated rows get the
    same text each.  A page without neighbours on its host loses nothing.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("row", F.xxhash64("url", "html"))
    template = cut_lineage(neighbours(cut_lineage(line_marks(rows))))
    release(pages.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h in b["html"]:
                text, inside = lines(h)
                named = any(inside)  # places stay those of all lines; the join below skips nulls
                out.append([t if i or not named else None for t, i in zip(text, inside, strict=True)])
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "row": b["row"],
                                "lines": out})

    shown = rows.select("page_id", "url", "row", "html").mapInPandas(
        read, "page_id long, url string, row long, lines array<string>")
    gone = template.select(F.col("page_id").alias("t_page"), F.col("row").alias("t_row"), "template")
    joined = shown.join(gone, (F.col("row") == F.col("t_row")) & F.col("page_id").eqNullSafe(F.col("t_page")), "left")
    kept = F.when(F.col("template").isNull() | (F.size("template") == 0), F.col("lines")).otherwise(
        F.filter("lines", lambda _, i: ~F.array_contains("template", i)))
    text = F.array_join(kept, " ")
    return joined.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
