"""HTML main text by host consensus: pages score their containers, hosts vote, winning paths are extracted.

A page is read into blocks of text and a tree of containers; a container's path has its tag and those above it, each
with its classes, digits generalised. Words of a class or id are evidence against an element, weighed by the text below
it. Every page scores its containers by the text they hold and gives one vote to the best path. Votes are added up per
host in Spark; the paths with a tenth of a host's votes win, so there are at most ten for a host. Each page is then read
again and the text below the winning path that holds most of it is taken, with the title and lead around it. Sums over
what lies below an element are made once, from the leaves up, so the time grows with the page, however deep it is.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, free_name
from lapstack.session import stage

# a tag whose quoted values hold no "<"; others are read quote by quote
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"'<]|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_OPENING = re.compile(r"</?[A-Za-z]")
_UNQUOTED = re.compile(r"[^>\"'<]*+")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++)))?+")
_SPACES = re.compile(r"\s+")
_DIGITS = re.compile(r"[0-9]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"

# Elements by their part in a page.
_RAW = frozenset("script style noscript template textarea iframe object svg math title select".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset(
    "html body main article section div aside nav header footer form ul ol dl table tbody thead tfoot tr td th"
    " blockquote figure fieldset details dialog center menu".split()
)
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre address figcaption caption summary legend".split())
_CONTROLS = frozenset("label button".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NOT_TEXT = frozenset("nav aside footer legend dialog menu".split())
_FORMS = frozenset("form fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar side widget"
    " widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar comments"
    " comment commentlist replies reply respond disqus share sharing social related recommended recommendations toc".split()
)
_COMMENTS = frozenset("comments comment commentlist replies reply respond disqus".split())
# words beside one of those that still name the comments themselves, not a page that has some
_COMMENT_PARTS = frozenset(
    "area author block body box container content count entry form group inner item list main meta outer panel section"
    " text thread title user wrap wrapper".split()
)


class _Path:
    """A container's generalised name below that of the container around it; equal paths are one object of a page."""

    __slots__ = ("up", "name", "depth", "below")

    def __init__(self, up: _Path | None, name: str) -> None:
        self.up, self.name, self.depth, self.below = up, name, up.depth + 1 if up else 0, {}

    def child(self, name: str) -> _Path:
        found = self.below.get(name)
        if found is None:
            found = self.below[name] = _Path(self, name)
        return found

    @property
    def tag(self) -> str:
        return re.split("[.#]", self.name, maxsplit=1)[0]

    def names(self) -> tuple[str, ...]:
        out, at = [], self
        while at.up is not None:
            out.append(at.name)
            at = at.up
        return tuple(reversed(out))


@dataclass(frozen=True)
class Block:
    text: str
    at: _Path = field(repr=False)
    link_chars: int
    doubt: bool = False  # below an element that a word of its class or id speaks against
    title: bool = False  # an h1

    @property
    def path(self) -> tuple[str, ...]:
        return self.at.names()


@dataclass(frozen=True)
class Page:
    """The blocks of a page in order, and those in menus, notices, adverts, forms, comments and the like."""

    blocks: list[Block]
    dropped: list[Block]
    root: _Path


class _Element:
    """An open container or leaf. ``kind`` is what speaks against it: ``tag``, ``form``, ``comment``, ``word`` or ``part``."""

    __slots__ = ("up", "tag", "kind", "path", "chars", "links", "keys", "main", "h1", "verdict", "comments", "titled", "article", "dropped", "doubt")

    def __init__(self, up: _Element | None, tag: str, kind: str | None, path: _Path) -> None:
        self.up, self.tag, self.kind, self.path = up, tag, kind, path
        self.chars = self.links = self.keys = 0  # below it, after the sums
        self.main = self.h1 = self.titled = self.dropped = self.doubt = False
        self.verdict = kind == "tag" or (up is not None and up.verdict)
        self.comments = self if kind == "comment" else up.comments if up else None  # the nearest such element
        self.article = up.article if up else None

    def judge(self, chars: int, keys: int, titled: bool) -> None:
        """Whether the element is dropped, and whether it is in doubt.

        Tags and roles are a verdict. So are comments, however long, unless they hold main, or the only h1 of the page.
        A form, or a class or id that is no other word than a listed one, drops the element too, but never one that
        holds the article, main, an h1 or most of the page's text; a listed word among others drops only what is mostly
        links. What is kept against a word remains in doubt unless it holds article, main or most text.
        """
        if self.kind == "tag":
            self.dropped = True
            return
        most = self.main or (chars > 0 and self.chars >= (0.8 if keys > self.keys else 0.5) * chars)
        if self.kind == "comment":
            self.dropped = not self.main and not (self.titled and not titled)
        elif not most and not self.h1:
            self.dropped = self.kind != "part" or self.links > self.chars
            self.doubt = True
        else:
            self.doubt = not most and self.kind != "part"


def _name(tag: str, attributes: dict[str, str]) -> str:
    """The generalised name: tag and sorted classes (else the id), digits as one mark."""
    classes = sorted({_DIGITS.sub("0", c.lower()) for c in attributes.get("class", "").split()})
    if classes:
        return tag + "".join("." + c for c in classes)
    own = attributes.get("id", "").strip().lower()
    return tag + "#" + _DIGITS.sub("0", own) if own else tag


def _against(tag: str, attributes: dict[str, str], in_article: bool) -> str | None:
    """What speaks against an element: its ``tag`` or role, a ``form``, a ``comment``, a ``word`` (a class or the id as a
    whole) or ``part`` of one."""
    if tag in _NOT_TEXT or attributes.get("role", "").lower() in _ROLES:
        return "tag"
    if tag == "header":
        return None if in_article else "tag"
    if tag in ("html", "body", "main") or tag in _HEADINGS:
        return None
    found = None
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        listed = [w for w in words if w in _BOILERPLATE]
        if not listed:
            continue
        if any(w in _COMMENTS for w in listed) and all(w in _BOILERPLATE or w in _COMMENT_PARTS for w in words):
            return "comment"
        found = "word" if len(listed) == len(words) else found or "part"
    if tag in _FORMS or attributes.get("role", "").lower() == "form":
        return found if found == "word" else "form"
    return found if tag != "article" or found == "word" else None


class _Tags:
    """Reads the tags of a page one after the other; what cannot be a tag is never scanned twice."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.open_ended: set[int] = set()  # places outside quotes from which no tag end is reached
        self.missing: set[str] = set()  # quotes and end tags that do not come any more

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def close(self, tag: str, at: int) -> int:
        """The place after the end tag of an element whose content is no markup; -1 where it is not closed."""
        if tag in self.missing:
            return -1
        found = re.compile(rf"</{tag}\s*+>", re.I).search(self.page, at)
        if found is None:
            self.missing.add(tag)
            return -1
        return found.end()

    def at(self, start: int) -> tuple[bool, str, str, int] | None:
        """(whether an end tag, name, attributes, place after it) of the tag at ``start``, or None."""
        m = _TAG.match(self.page, start)
        if m:
            return bool(m.group(1)), m.group(2), m.group(3), m.end()
        if start > self.last or not _OPENING.match(self.page, start):
            return None
        end = self._end(start)
        if end < 0:  # its quotes do not close: they are no quotes
            end = self.page.find(">", start)
        body = self.page[start + 1 : end]
        closing = body.startswith("/")
        name = re.match(r"[^\s/>]*+", body[closing:]).group()
        return closing, name, body[closing + len(name) :], end + 1

    def _end(self, start: int) -> int:
        page, at, passed = self.page, start + 1, [start]
        if start in self.open_ended:
            return -1
        while True:
            at = _UNQUOTED.match(page, at).end()
            if at >= len(page) or at in self.open_ended:
                break
            c = page[at]
            if c == ">":
                return at
            passed.append(at)
            if c == "<":
                at += 1
                continue
            close = self.find(c, at + 1)
            if close < 0:
                break
            at = close + 1
        self.open_ended.update(passed)
        return -1


def _read(page: str) -> Page:
    root = _Path(None, "")
    top = _Element(None, "", None, root)
    elements: list[_Element] = []
    stack: list[_Element] = [top]
    open_at: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
    containers = [0]  # places in the stack
    raw: list[tuple[str, _Element, int, bool]] = []
    articles: list[_Element] = []
    titled = False  # an h1 outside comments
    parts: list[str] = []
    links, in_link, controls = 0, False, 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = _SPACES.sub(" ", "".join(parts)).strip()
            parts.clear()
            if text:
                here = stack[-1]
                here.chars += max(0, len(text) - links)
                here.links += links
                raw.append((text, here, links, here.tag == "h1"))
        links = 0

    def shut(where: int) -> None:
        for e in stack[where:]:
            open_at[e.tag].pop()
        while containers[-1] >= where:
            containers.pop()
        del stack[where:]

    def add(text: str) -> None:
        nonlocal links
        if controls and stack[-1].tag not in _LEAVES:
            return  # a button or a label of its own is no text
        text = html.unescape(text) if "&" in text else text
        parts.append(text)
        if in_link:
            links += len(text)

    tags, at, size = _Tags(page), 0, len(page)
    while at < size:
        start = tags.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if start > at:
            add(page[at:start])
        found = tags.at(start)
        if found is None:
            if page.startswith("<!--", start):
                end = tags.find("-->", start + 4)
                at = end + 3 if end >= 0 else size
            elif page.startswith("<![CDATA[", start):
                end = tags.find("]]>", start + 9)
                at = end + 3 if end >= 0 else size
            elif page.startswith(("<!", "<?"), start):
                end = page.find(">", start) if start <= tags.last else -1
                at = end + 1 if end >= 0 else size
            else:
                add("<")
                at = start + 1
            continue
        closing, tag, rest, at = found
        tag = tag.lower()
        if closing:
            if tag == "a":
                in_link = False
            elif tag in _CONTROLS:
                controls = max(0, controls - 1)
            elif tag in _CONTAINERS or tag in _LEAVES:
                flush()
                where = open_at[tag][-1] if open_at[tag] else None
                # an end without a start, or of a leaf outside the innermost container, ends nothing
                if where is not None and (tag in _CONTAINERS or containers[-1] <= where):
                    shut(where)
                    controls = 0
            continue
        if tag in _RAW:
            if not rest.endswith("/"):
                end = tags.close(tag, at)
                at = end if end >= 0 else (size if tag in ("script", "style", "title", "textarea") else at)
            continue
        if tag in _VOID:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag == "a":
            in_link = True
        elif tag in _CONTROLS:
            if not rest.endswith("/"):
                controls += 1
        elif tag in _CONTAINERS or tag in _LEAVES:
            flush()
            controls = 0
            # a leaf ends the leaf it opens in; so does a container that starts inside a paragraph
            if tag in _LEAVES or stack[-1].tag == "p":
                for i in range(len(stack) - 1, containers[-1], -1):
                    if stack[i].tag == "p" or stack[i].tag == tag or tag in _HEADINGS:
                        shut(i)
                        break
            known = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest.strip() else {}
            up = stack[-1]
            kind = _against(tag, known, bool(open_at["article"] or open_at["main"]))
            here = _Element(up, tag, kind, up.path.child(_name(tag, known)) if tag in _CONTAINERS else up.path)
            if tag in ("article", "main", "h1") and not up.verdict and kind != "comment":
                up.keys += 1
                up.main |= tag == "main"
                up.h1 |= tag == "h1"
                if tag == "h1":
                    if here.comments is None:
                        titled = True
                    else:
                        here.comments.titled = True
                elif tag == "article" and here.article is None and here.comments is None and kind is None:
                    here.article = here
                    articles.append(here)
            open_at[tag].append(len(stack))
            if tag in _CONTAINERS:
                containers.append(len(stack))
            stack.append(here)
            elements.append(here)
    flush()
    return _judged(raw, elements, articles, titled, root)


def _judged(raw: list, elements: list[_Element], articles: list[_Element], titled: bool, root: _Path) -> Page:
    if all(e.kind is None for e in elements):
        return Page([Block(t, e.path, n, False, h1) for t, e, n, h1 in raw], [], root)
    for e in reversed(elements):  # what is below an element comes after it
        up = e.up
        up.chars += e.chars
        up.links += e.links
        up.keys += e.keys
        up.main |= e.main
        up.h1 |= e.h1
    if articles:
        e = max(articles, key=lambda a: a.chars).up
        while e is not None:
            e.main = True
            e = e.up
    keys = elements[0].up.keys if elements else 0
    for e in elements:
        if e.kind == "comment":
            e.judge(0, keys, titled)
        e.dropped |= e.up.dropped or e.verdict
    chars = sum(max(0, len(t) - n) for t, e, n, _ in raw if not e.dropped)
    for e in elements:
        if e.kind in ("form", "word", "part"):
            e.judge(chars, keys, titled)
        e.dropped |= e.up.dropped
        e.doubt |= e.up.doubt
    kept: list[Block] = []
    dropped: list[Block] = []
    for t, e, n, h1 in raw:
        (dropped if e.dropped else kept).append(Block(t, e.path, n, e.doubt, h1))
    return Page(kept, dropped, root)


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without those in menus, notices, adverts, forms, comments and the like."""
    return _read(page).blocks


def _is_text(b: Block) -> bool:
    return not b.doubt and 2 * b.link_chars <= len(b.text)


def _worth(b: Block) -> float:
    """The characters of a block less twice those of its links; next to nothing where it is in doubt."""
    return (0 if b.doubt else max(0, len(b.text) - 2 * b.link_chars)) + 1e-6 * len(b.text)


class _Sums:
    """What the containers of a page hold: blocks, blocks that are not mostly links, text, boilerplate, worth."""

    def __init__(self, blocks: list[Block], dropped: list[Block]) -> None:
        own: dict[_Path, list[float]] = {}

        def held(path: _Path) -> list[float]:
            if path not in own:
                own[path] = [0, 0, 0, 0, 0.0]
                while path.up is not None and path.up not in own:
                    path = path.up
                    own[path] = [0, 0, 0, 0, 0.0]
            return own[at]

        for b in blocks:
            at = b.at
            s, text = held(at), _is_text(b)
            s[0] += 1
            s[1] += 2 * b.link_chars <= len(b.text)
            s[2] += len(b.text) - b.link_chars if text else 0
            s[3] += b.link_chars if text else len(b.text)
            s[4] += _worth(b)
        for b in dropped:
            at = b.at
            held(at)[3] += len(b.text)
        self.order = sorted(own, key=lambda p: p.depth)
        for p in reversed(self.order):
            if p.up is not None:
                above = own[p.up]
                for i, x in enumerate(own[p]):
                    above[i] += x
        self.of = own

    def worth(self, path: _Path) -> float:
        return self.of[path][4] if path in self.of else 0.0

    def climbs(self, at: _Path, up: _Path) -> bool:
        """Whether the container above adds text, and no more boilerplate than text; an article need only add text."""
        more, texts, gain, cost, _ = (a - b for a, b in zip(self.of[up], self.of[at]))
        if not more:
            return False
        if up.tag == "article":
            return texts > 0
        return gain > 0 and gain >= cost


def _best(blocks: list[Block], sums: _Sums) -> _Path | None:
    scores: dict[_Path, float] = defaultdict(float)
    for b in blocks:
        worth, path = _worth(b), b.at
        for _ in range(5):
            if path.up is None:
                break
            scores[path] += worth * (1.5 if path.name.startswith(("article", "main")) else 1.0)
            worth, path = worth * 0.5, path.up
    if not scores:
        return None
    at = up = max(scores, key=lambda p: (scores[p], p.depth))  # the first in the page of equal ones
    while (up := up.up).up is not None and up.tag not in ("html", "body"):
        if sums.climbs(at, up):
            at = up
    return at


def best_path(blocks: list[Block], dropped: list[Block] | None = None) -> tuple[str, ...] | None:
    """The container of the article.

    The search starts where most text is: a block counts in full for its own container, half for the next one up, and
    so on. It climbs, below ``body``, while a container above adds text against the boilerplate it would add.
    """
    found = _best(blocks, _Sums(blocks, dropped or []))
    return found.names() if found else None


def _under(path: _Path, above: _Path) -> bool:
    while path.depth > above.depth:
        path = path.up
    return path is above


def _chosen(page: Page, sums: _Sums, winners: list[str]) -> list[_Path]:
    """Of the winning paths that hold text, the one that holds most on this page, and others with half as much.

    Of paths inside each other the inner one counts, unless the outer one has more votes or adds text against the
    boilerplate it would add. A page that has no winning path has its own best one.
    """
    rank: dict[_Path, int] = {}
    for i, w in enumerate(winners):
        at: _Path | None = page.root
        for name in w.split(">"):
            at = at.below.get(name) if at else None
        if at is not None and sums.worth(at) > 0:
            rank.setdefault(at, i)
    if not rank:
        return [_best(page.blocks, sums) or page.root]
    ends: list[_Path] = []
    for p in rank:
        if any(q.depth > p.depth and _under(q, p) for q in rank):
            continue
        at = p
        for up in sorted((q for q in rank if q.depth < p.depth and _under(p, q)), key=lambda q: -q.depth):
            if rank[up] < rank[at] or sums.climbs(at, up):
                at = up
        ends.append(at)
    most = max(map(sums.worth, ends))
    return [p for p in ends if 2 * sums.worth(p) >= most]


def extract(page: str, winners: list[str]) -> str:
    """The text below the winning paths that the page has most text under, else below its own best one.

    With it comes text that lies directly in the containers around it, and the page's only h1, wherever it is; a title
    that a word speaks against only from inside such a container, as one beside them is the site's.
    """
    read = _read(page)
    blocks = read.blocks
    if not blocks:
        return ""
    sums = _Sums(blocks, read.dropped)
    inside, around = set(_chosen(read, sums, winners)), set()
    for p in inside:
        while p is not None and p not in around:
            around.add(p)
            p = p.up
    for p in sums.order:  # from the root down
        if p.up in inside:
            inside.add(p)
    taken = [b.at in inside or (b.at in around and _is_text(b)) for b in blocks]
    titles = [i for i, b in enumerate(blocks) if b.title]
    if len(titles) == 1:
        b = blocks[titles[0]]
        deep = sum(name.split(".")[0].split("#")[0] not in ("html", "body") for name in b.path)
        taken[titles[0]] |= not b.doubt or deep > 1
    return "\n\n".join(b.text for b, t in zip(blocks, taken) if t)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def path_votes(pages: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``votes``: the pages of a host whose best container has that path."""

    def best(page: str) -> str | None:
        read = _read(page)
        found = best_path(read.blocks, read.dropped)
        return ">".join(found) if found else None

    @F.pandas_udf("string")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([best(p) for p in batch], dtype=object)

    voted = pages.select(host_of(F.col("url")).alias("host"), vote(F.coalesce("html", F.lit(""))).alias("path"))
    return voted.filter("path IS NOT NULL").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))


def winning_paths(votes: DataFrame, share: float = 0.1) -> DataFrame:
    """``host`` and ``winners``, its paths with at least ``share`` of the votes, most votes first (then by path)."""
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    won = votes.join(totals, "host").filter(F.col("votes") >= share * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    return won.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("winners"))


def main_text(pages: DataFrame, share: float = 0.1, broadcast_hosts: int = 20_000, salts: int = 64) -> DataFrame:
    """The pages with ``text``, their main text, and ``n_chars``, its code points.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by two line ends.
    Whole pages are read. A page without text, or NULL html, has the empty text; a page whose host never won falls back
    to its own best container; a NULL url is a host of its own. Columns named ``text`` or ``n_chars`` are replaced, all
    others kept. Winners are broadcast while the hosts are few; else the pages of a host are dealt over ``salts`` keys.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    pages = pages.drop("text", "n_chars")
    host, won, salt = (free_name(pages.columns, n) for n in ("host", "winners", "salt"))
    winners = stage(winning_paths(path_votes(pages), share), "winners")
    named = winners.select(F.col("host").alias(host), F.col("winners").alias(won))
    rows = pages.withColumn(host, host_of(F.col("url")))
    if winners.count() <= broadcast_hosts:
        joined = rows.join(F.broadcast(named), host, "left")
    else:
        spread = named.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = rows.withColumn(salt, F.pmod(F.xxhash64("html"), F.lit(salts)).cast("int"))
        joined = salted.join(spread, [host, salt], "left").drop(salt)

    @F.pandas_udf("string")
    def take(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, best in batches:
            yield pd.Series([extract(p, [] if w is None else list(w)) for p, w in zip(page, best)], dtype=object)

    done = joined.withColumn("text", take(F.coalesce("html", F.lit("")), F.col(won))).drop(won, host)
    return done.withColumn("n_chars", F.length("text").cast("bigint"))
