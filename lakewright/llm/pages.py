"""Main text of web pages: markup first, then a suffix array over the pages of a host.

Markup decides what is plainly no article: scripts, styles, menus, footers, forms,
sidebars, adverts, notices, comments, and all that lies outside the ``article`` and
``main`` elements of a page where these hold at least half of what is left. Forms and names
of boilerplate also wrap whole layouts: such a mark does not count on an element that holds
more article text than there is outside it, or most of the page's text while articles
outside it have less than ``BESIDE`` of that. The blocks left are token streams. Those of
one host are concatenated and their suffixes sorted; stretches of ``LONG`` tokens or
more, and whole blocks, that stand on much of the host's distinct pages are boilerplate
that the markup did not tell. They are cut out, and the runs between stay.

How much is much: within an article ``SHARE_INSIDE`` of the pages, as texts may quote
each other; on pages without such an element ``SHARE_OUTSIDE``; and ``LEAST_PAGES`` in
any case. Pages with equal text count once. The pages of a large host are dealt by hash
into parts, each with a suffix array of its own, so a host of any size is many tasks, and a
part that still has more than ``PART`` bytes is read in pieces. Shares are those of the whole
host: what a piece holds on much of its own pages is counted in all parts of the host.

A null page is empty; one without main text has the empty text. Rows with equal ids or
urls are treated one by one. Without a url, pages belong to the host without a name.
Other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.words import U64, Hasher, column, mix, text_bytes, windows
from lakewright.session import materialise

LONG = 8
#: Text in articles outside a marked element, as a share of its own, from which the mark counts whatever it holds.
BESIDE = 0.2
SHARE_INSIDE, SHARE_OUTSIDE, LEAST_PAGES = 0.6, 0.2, 5
#: Bytes of main text whose suffixes one task sorts at a time.
PART = 8 << 20
#: Hosts of more than one part (about 60 bytes each) up to which every executor gets their list.
BROADCAST_HOSTS = 500_000

#: What a part is told: pages that stand for their text, the host's texts, and stretches with their counts.
LEADER, TOTAL, WANTED = 0, 1, 2

# Elements of the HTML standard by what they mean here, and words that name boilerplate.
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
DROP = {"nav", "footer", "aside", "head", "noscript", "template", "svg", "math", "button", "select", "dialog", "object", "canvas", "audio", "video", "menu"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCK = HEADINGS | DROP | MAIN | {"form"} | {
    "address", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "header", "hgroup", "hr",
    "html", "legend", "li", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
CELLS = {"br", "td", "th", "caption", "option"}
INLINE = {"a", "abbr", "b", "cite", "code", "em", "font", "i", "label", "q", "s", "small", "span", "strong", "sub", "sup", "time", "u"}
BOILERPLATE = {
    "ad", "ads", "advert", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments", "consent", "cookie",
    "cookies", "copyright", "discussion", "disqus", "footer", "gdpr", "hidden", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
QUALIFIERS = {"has", "no", "with", "without", "is"}
TOPICS = QUALIFIERS | {"tag", "category"}
ROLES = {"alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")


def _unwanted(rest: str, article: bool = False) -> str:
    """Whether the attributes of an element hide it ("hidden"), name it boilerplate ("named") or neither (""). An article's tags and categories are its topics."""
    if "=" not in rest and "hidden" not in rest:
        return ""
    found = ""
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            for word in value.split():
                parts = _SPLIT.split(re.sub(r"([a-z])([0-9])", r"\1 \2", word))
                if parts[0] not in (TOPICS if article else QUALIFIERS) and not BOILERPLATE.isdisjoint(parts):
                    found = "named"
        elif name == "role" and value in ROLES:
            found = "named"
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return "hidden"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "hidden"
    return found


def _standing(blocks: list[tuple[str, int, int, int]], marks: list[tuple[int, int]]) -> list[tuple[str, int, int, int]]:
    """The blocks in no marked element whose mark counts. Inner marks are judged first; what they drop is no text of the outer ones."""
    sizes = [len(b[0]) for b in blocks]
    page = sum(sizes)
    articles = sum(n for n, b in zip(sizes, blocks, strict=True) if b[2])
    members: list[list[int]] = [[] for _ in marks]
    gone: set[int] = set()
    for k, b in enumerate(blocks):
        if b[3]:
            members[b[3] - 1].append(k)
    for mark in range(len(marks), 0, -1):
        outer, depth = marks[mark - 1]
        own = members[mark - 1]
        size = sum(sizes[k] for k in own)
        held = sum(sizes[k] for k in own if blocks[k][2] > depth)
        beside = articles - sum(sizes[k] for k in own if blocks[k][2])
        if held > beside or 2 * size > page and beside < BESIDE * size:
            if outer:
                members[outer - 1] += own
        else:
            gone.update(own)
    return [b for k, b in enumerate(blocks) if k not in gone]


def blocks_of(page: str) -> tuple[bool, list[str]]:
    """Whether article elements hold half of the text or more, and the blocks there, or else all that are not boilerplate."""
    blocks: list[tuple[str, int, int, int]] = []  # text; elements main and article around it, those without a mark, innermost mark
    marks: list[tuple[int, int]] = []  # the mark around; article elements without a mark around
    said: list[str] = []
    stack: list[tuple[str, int, int, int, int, int]] = []  # name; adds to dropped, main, header, articles; the mark before
    dropped = main = header = heading = articles = mark = 0
    simple = False  # once a quote is not closed, tags end at the next >
    at, end = 0, len(page)

    def flush() -> None:
        if said:
            text = " ".join(html.unescape("".join(said)).split())
            said.clear()
            if text:
                blocks.append((text, main, articles, mark))

    def close(upto: int) -> None:
        nonlocal dropped, main, header, articles, mark
        while len(stack) > upto:
            _, a, b, c, d, before = stack.pop()
            if before != mark:
                flush()
            dropped, main, header, articles, mark = dropped - a, main - b, header - c, articles - d, before

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at and not dropped and (not header or heading):
            said.append(page[at:lt])
        if lt == end:
            break
        if page.startswith("<!--", lt):
            at = page.find("-->", lt + 4)
            at = end if at < 0 else at + 3
            continue
        name = _NAME.match(page, lt)
        if not name:
            if page[lt + 1 : lt + 2] in ("!", "?", "/"):
                at = page.find(">", lt)
                at = end if at < 0 else at + 1
            else:  # a sign, not markup
                if not dropped and (not header or heading):
                    said.append("<")
                at = lt + 1
            continue
        rest = None if simple else _REST.match(page, name.end())
        if rest:
            at = rest.end()
        else:
            simple = True
            at = page.find(">", name.end()) + 1
            if not at:
                break  # the page ends within a tag
        tag, closing, rest_text = name[1].lower(), page[lt + 1] == "/", page[name.end() : at - 1]
        if tag in BLOCK:
            flush()
        elif tag in CELLS and not dropped:
            said.append(" ")
        if closing:
            if tag in HEADINGS:
                heading = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in RAW:
            over = re.compile(rf"</{tag}", re.I).search(page, at)
            at = over.start() if over else end
            continue
        if tag in VOID or rest_text.endswith("/") and tag not in BLOCK:
            continue
        if tag in BLOCK and stack and stack[-1][0] == "p":
            close(len(stack) - 1)  # a paragraph ends where another block begins
        if tag in HEADINGS:
            heading = 1
        if tag in ("html", "body"):
            stack.append((tag, 0, 0, 0, 0, mark))
            continue
        head, of_text = tag == "header", tag in MAIN
        unwanted = _unwanted(rest_text, of_text)
        bad = tag in DROP or (head and not main) or unwanted == "hidden" or (unwanted and tag in INLINE)
        marked = not bad and (tag == "form" or bool(unwanted))
        if bad or marked or head or of_text or tag in ("div", "section", "p", "li", "ul", "ol", "span", "a", "table", "figure", "blockquote"):
            if marked:
                flush()
            adds = int(bool(bad)), int(of_text), int(head and not bad), int(of_text and not marked)
            stack.append((tag, *adds, mark))
            if marked:
                marks.append((mark, articles))
                mark = len(marks)
            dropped, main, header, articles = dropped + adds[0], main + adds[1], header + adds[2], articles + adds[3]
    flush()
    left = _standing(blocks, marks)
    inside = [b[0] for b in left if b[1]]
    within = bool(inside) and 2 * sum(map(len, inside)) >= sum(len(b[0]) for b in left)
    return within, inside if within else [b[0] for b in left]


def suffix_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` tokens, by prefix doubling: equal where those are equal."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    known = 1
    while known < depth:
        step = min(known, depth - known)
        ahead = np.full(len(rank), -1, np.int64)
        ahead[: len(rank) - step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 2) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        known += step
    return rank


def _pages_with(key: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, the number of distinct pages that hold its key; and the first entry of each key."""
    _, one, where = np.unique(key, return_index=True, return_inverse=True)
    width = int(page.max()) + 1 if len(page) else 1
    pairs = np.unique(where.astype(np.int64) * width + page)
    return np.bincount(pairs // width, minlength=len(one))[where], one


class _Stretches:
    """The blocks of some pages and their stretches of ``long`` tokens, each with a number that other pages give it, too."""

    def __init__(self, hasher: Hasher, pages: list[list[str]], long: int = LONG) -> None:
        self.n, self.long = len(pages), long
        self.blocks = [b for p in pages for b in p]
        self.page_of_block = np.repeat(np.arange(self.n), [len(p) for p in pages])
        data, at = text_bytes(pa.array(self.blocks, pa.large_string()))
        start, end, self.first = hasher.spans(data, at)
        self.tokens = hasher.runs(data, start, end)
        self.block_of = np.repeat(np.arange(len(self.blocks)), np.diff(self.first))
        self.page_of = self.page_of_block[self.block_of]
        self.block_key = hasher.runs(data, at[:-1], at[1:]).view(np.int64)
        last = len(self.tokens) - long + 1
        self.where = np.flatnonzero(self.page_of[:last] == self.page_of[long - 1 :]) if last > 0 else np.empty(0, np.int64)
        self.key = mix(windows(self.tokens, long)[self.where] ^ U64(long)).view(np.int64)

    def common(self, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the blocks and stretches that stand on so many of these pages, by their suffixes' order, and on how many."""
        edge = np.flatnonzero(np.diff(self.page_of)) + 1
        # The stream of a page ends with a token of its own, so no stretch spans two pages.
        stream = np.insert(self.tokens, edge, mix(np.arange(len(edge)).astype(U64) + U64(7)))
        spot = self.where + np.searchsorted(edge, self.where, "right")
        rank = suffix_order(stream, self.long)[spot] if len(spot) else spot
        keys, counts = [], []
        for group, key, page in ((rank, self.key, self.page_of[self.where]), (self.block_key, self.block_key, self.page_of_block)):
            held, one = _pages_with(group, page)
            one = one[held[one] >= least]
            keys.append(key[one])
            counts.append(held[one])
        return np.concatenate(keys), np.concatenate(counts)

    def count(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the wanted numbers that stand on these pages, and on how many."""
        key = np.concatenate([self.key, self.block_key])
        page = np.concatenate([self.page_of[self.where], self.page_of_block])
        some = np.isin(key, wanted)
        held, one = _pages_with(key[some], page[some])
        return key[some][one], held[one]

    def cut(self, keys: np.ndarray, counts: np.ndarray, many: np.ndarray) -> list[list[str]]:
        """The blocks of each page without what ``many`` of the pages hold, by these numbers and counts."""
        by = np.argsort(keys)
        keys, counts = np.r_[keys[by], 0], np.r_[counts[by], 0]

        def held(key):
            at = np.searchsorted(keys[:-1], key)
            return np.where(keys[at] == key, counts[at], 0)

        covered = (held(self.block_key) >= many[self.page_of_block])[self.block_of]
        hit = self.where[held(self.key) >= many[self.page_of[self.where]]]
        size = len(self.tokens) + 1
        covered |= np.cumsum(np.bincount(hit, minlength=size)[:size] - np.bincount(hit + self.long, minlength=size)[:size])[:-1] > 0
        touched = np.r_[0, np.cumsum(covered)][self.first]
        out: list[list[str]] = [[] for _ in range(self.n)]
        for b, text in enumerate(self.blocks):
            low, high, gone = int(self.first[b]), int(self.first[b + 1]), int(touched[b + 1] - touched[b])
            if not gone:
                out[self.page_of_block[b]].append(text)
            elif gone < high - low:
                words = text.split(" ")
                left = [w for w, x in zip(words, covered[low:high], strict=True) if not x] if len(words) == high - low else words
                out[self.page_of_block[b]].append(" ".join(left))
        return out


def _many(total: int, within: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST_PAGES, np.where(within, SHARE_INSIDE, SHARE_OUTSIDE) * total)


def boilerplate(hasher: Hasher, pages: list[list[str]], within: np.ndarray, long: int = LONG) -> list[list[str]]:
    """The blocks of each page without what stands on too many of the pages; ``within``: has an article element."""
    distinct = [list(p) for p in dict.fromkeys(map(tuple, pages))]
    if len(distinct) < LEAST_PAGES:
        return pages
    keys, counts = _Stretches(hasher, distinct, long).common(max(LEAST_PAGES, SHARE_OUTSIDE * len(distinct)))
    return _Stretches(hasher, pages, long).cut(keys, counts, _many(len(distinct), within))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def main_texts(pages: DataFrame, part: int = PART) -> DataFrame:
    """One row per page: page_id, url, text (blocks in page order, joined by a line feed) and n_chars.

    ``part`` bounds what one task sorts; the texts do not depend on it.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()

    def parsed(batches):
        hasher = Hasher()
        for batch in batches:
            found = [blocks_of(p or "") for p in column(batch, "html").to_pylist()]
            texts = pa.array(["\n".join(f[1]) for f in found], pa.string())
            data, at = text_bytes(texts)
            said = hasher.runs(data, at[:-1], at[1:]).view(np.int64)
            yield pa.record_batch(
                [*(column(batch, c) for c in ("page_id", "url", "host", "spot")), pa.array([f[0] for f in found]), texts, pa.array(said)],
                ["page_id", "url", "host", "spot", "within", "text", "said"],
            )

    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("spot"))
    blocks = keyed.mapInArrow(parsed, f"page_id {id_type}, url string, host string, spot long, within boolean, text string, said long")
    sizes = pages.groupBy(host_of(F.col("url")).alias("host")).agg(F.greatest(F.lit(1), F.ceil(F.sum(F.octet_length("html")) / (2 * part))).alias("parts"))
    sizes = materialise(sizes, "hosts")
    large = sizes.where("parts > 1")
    large = F.broadcast(large) if large.count() <= BROADCAST_HOSTS else large
    dealt = blocks.join(large, "host", "left").withColumn("part", F.pmod("spot", F.coalesce("parts", F.lit(1)))).drop("parts")
    # Dealt anew by both: a join by host may have left a host's parts in one task. All steps below read this one
    # shuffle; each takes all its columns, so that it is the same for all.
    dealt = dealt.repartition("host", "part")
    by_part = dealt.groupBy("host", "part")
    asked = "host string, part long, key long, n long"

    def slim(batches):
        for batch in batches:
            yield batch.select(["host", "said", "spot", "part"])

    def kind(table: pa.Table, of: int) -> tuple[np.ndarray, np.ndarray]:
        table = table.filter(pa.array(column(table, "kind").to_numpy(zero_copy_only=False) == of))
        return tuple(column(table, c).to_numpy(zero_copy_only=False) for c in ("key", "n"))

    def cuts(texts: list[str]):
        """Ranges of texts of bounded size."""
        ends, total = [], 0
        for t in texts:
            total += len(t) + 1
            ends.append(total)
        a = 0
        while a < len(texts):
            b = max(a + 1, bisect_left(ends, (ends[a - 1] if a else 0) + 4 * part))
            yield a, b
            a = b

    def pieces(table: pa.Table, asked: pa.Table):
        """The stretches of the part's pages that stand for their text in the host, some at a time."""
        lead, spots = set(kind(asked, LEADER)[0].tolist()), column(table, "spot").to_pylist()
        first = dict(zip(reversed(spots), reversed(range(len(spots))), strict=True))
        texts = column(table, "text").take(pa.array(sorted(first[x] for x in lead & first.keys()), pa.int64())).to_pylist()
        hasher = Hasher()
        for a, b in cuts(texts):
            yield _Stretches(hasher, [t.split("\n") if t else [] for t in texts[a:b]])

    def told(table: pa.Table, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
        n = len(keys)
        host, at = (column(table, "host")[0].as_py(), column(table, "part")[0].as_py()) if n else ("", 0)
        return pa.table([pa.array([host] * n, pa.string()), pa.array([at] * n, pa.int64()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["host", "part", "key", "n"])

    def summed(table: pa.Table, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
        keys, where = np.unique(np.concatenate([np.empty(0, np.int64), *(f[0] for f in found)]), return_inverse=True)
        return told(table, keys, np.bincount(where, weights=np.concatenate([np.empty(0), *(f[1] for f in found)]), minlength=len(keys)).astype(np.int64))

    def candidates(table: pa.Table, asked: pa.Table) -> pa.Table:
        """What stands on much of a piece. What stands on much of a host does so on some piece of it, at the least."""
        total = int(kind(asked, TOTAL)[1].sum())
        if not table.num_rows or total < LEAST_PAGES:
            return summed(table, [])
        share = max(LEAST_PAGES, SHARE_OUTSIDE * total) / total
        found = [p.common(share * p.n - 1e-6) for p in pieces(table, asked)]
        if len(found) > 1:
            wanted = np.unique(np.concatenate([f[0] for f in found]))
            found = [p.count(wanted) for p in pieces(table, asked)]
        return summed(table, found)

    def counted(table: pa.Table, asked: pa.Table) -> pa.Table:
        """On how many pages of the part those stand that only other parts told."""
        wanted = kind(asked, WANTED)[0]
        return summed(table, [p.count(wanted) for p in pieces(table, asked)] if len(wanted) and table.num_rows else [])

    def cleaned(table: pa.Table, asked: pa.Table) -> pa.Table:
        table = table.sort_by([("spot", "ascending")])
        texts, within = column(table, "text").to_pylist(), column(table, "within").to_numpy(zero_copy_only=False)
        keys, counts = kind(asked, WANTED)
        hasher, out, total = Hasher(), texts, int(kind(asked, TOTAL)[1].sum())
        if len(keys):
            out = []
            for a, b in cuts(texts):
                found = _Stretches(hasher, [t.split("\n") if t else [] for t in texts[a:b]])
                out += ["\n".join(k) for k in found.cut(keys, counts, _many(total, within[a:b]))]
        return pa.table([column(table, "page_id"), column(table, "url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    def rows(table: DataFrame, of: int, key: str = "0", n: str = "0") -> DataFrame:
        return table.selectExpr("host", "part", f"{of} AS kind", f"CAST({key} AS long) AS key", f"CAST({n} AS long) AS n")

    # One page stands for all of a host with its text.
    leaders = dealt.mapInArrow(slim, "host string, said long, spot long, part long").groupBy("host", "said").agg(F.min(F.struct("spot", "part")).alias("of")).select("host", "of.spot", "of.part")
    totals = leaders.groupBy("host").agg(F.count("spot").alias("total"), F.max("part").alias("last")).where("last >= 0").drop("last").join(sizes, "host")
    parts = totals.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    known = rows(leaders, LEADER, "spot").unionByName(rows(parts, TOTAL, n="total"))
    found = by_part.cogroup(known.groupBy("host", "part")).applyInArrow(candidates, asked)
    found = found.groupBy("host", "key").agg(F.sum("n").alias("n"), F.collect_set("part").alias("told")).where("size(told) > 0 AND n > 0")
    open_ = found.join(sizes, "host").withColumn("part", F.explode(F.array_except(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), "told")))
    more = by_part.cogroup(rows(leaders, LEADER, "spot").unionByName(rows(open_, WANTED, "key")).groupBy("host", "part")).applyInArrow(counted, asked)
    often = found.select("host", "key", "n").unionByName(more.select("host", "key", "n")).groupBy("host", "key").agg(F.sum("n").alias("n"))
    often = often.join(totals, "host").where((F.col("n") >= LEAST_PAGES) & (F.col("n") >= F.col("total") * SHARE_OUTSIDE))
    often = often.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    last = rows(parts, TOTAL, n="total").unionByName(rows(often, WANTED, "key", "n"))
    return by_part.cogroup(last.groupBy("host", "part")).applyInArrow(cleaned, f"page_id {id_type}, url string, text string, n_chars long")
