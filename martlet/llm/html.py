"""HTML extraction by consensus host paths.

Per page, text blocks are read with the chain of containers they stand in;
containers of menus, notices, adverts, forms, comments and the like are set aside.
A block that stands on ``REPEATED`` of a host's pages (three at least) is the host's
furniture.  Every container's generalised tag-class path is scored: kept text less
twice the navigational text and furniture that extraction from it would let through
(links inside an article element are its own).  The page votes for its best path, and
the votes of a host are summed in Spark.

Every page is read again with its host's winning path.  All kept text inside it is the
page's.  Around it the page's own best path is widened to its ancestors, up to an
article or main element, while that adds mostly kept text; of what it holds outside the
winning path the furniture (an unmarked sidebar or notice) goes and the rest, a title or
a lead of this page, stays.  A page without the winning path is extracted from its own
best path.

What is set aside: by element (nav, aside, footer, ...), role or hidden state; by a word
of a class or id name, where the word is the whole name, its first or its last word,
and the name is no taxonomy (``category-advertising``).  Words never set an article, main
or body aside, and a form, or a word that may name a wrapper (``popup-story``), no
container with most of the page's text where little else is left and no article
stands beside it.

Tags are found by scanning once; containers are numbered nodes and distinct paths are
numbered too, so time grows with the page, whatever it holds unclosed or nested.

Defined cases: null or empty html gives an empty text; a page without a host
votes for itself only; unclosed and stray tags are tolerated; rows that repeat
vote as often as they occur; very long pages are read whole; other columns stay (one
named ``main_text`` is replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Set
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized, store

_START = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section"
    " select summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video head".split())
#: Block tags that end an open element of the same family when they begin.
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_LIMITS = frozenset("ul ol dl table select body html div article section main".split())
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th tr pre blockquote figcaption summary caption".split())

ASIDE_TAGS = frozenset("nav aside footer form button select dialog menu".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id names that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertisements advertising sponsor sponsored promo promos"
    " promoted promotion sidebar sidenav widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs header"
    " masthead topbar footer comment comments commentlist disqus respond reply replies discussion cookie cookies"
    " consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login"
    " register share sharing social related recommended recommendations trending popular pagination pager paging"
    " search form copyright disclaimer toolbar dropdown hidden banner teaser teasers taboola outbrain feedback"
    " survey captcha skip".split())
_ASIDE_STARTS = ("comment", "cookie", "advert", "sidebar", "navig", "breadcrumb", "newsletter", "sponsor", "footer",
                 "masthead", "subscri", "promo", "popup")
#: First words of names that file a page under a topic, or name a state.
_TAXONOMY = frozenset("category cat tag tags topic type format status term has is with no without post js u visible hidden".split())
#: Words of asides that may also name a wrapper around the whole page.
_WRAPPERS = frozenset("popup modal overlay hidden share sharing social register login signup search header widget widgets teaser".split())
_MAIN_WORDS = frozenset("article post entry story main body text".split())
#: Share of a host's pages on which a block is furniture.
REPEATED = 0.3
_HINTS = frozenset("article post entry story main content text body".split())


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


KEPT, WRAPPER, WORD, HARD = range(4)


def _set_aside(tag: str, attrs: dict[str, str], in_main: bool) -> int:
    """How firmly an element is set aside: not, by a word that may name a wrapper, by
    another word, by what it is."""
    if tag in ("body", "html", "main"):
        return KEPT
    if tag in ASIDE_TAGS and tag != "form" or tag == "header" and not in_main:
        return HARD
    if attrs.get("role", "").lower() in ASIDE_ROLES or attrs.get("aria-hidden", "").lower() == "true" or "hidden" in attrs:
        return HARD
    if attrs and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return HARD
    found = WRAPPER if tag == "form" else KEPT
    if tag == "article":
        return found
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if not words or len(words) > 1 and words[0] in _TAXONOMY and words[-1] not in ("comment", "comments"):
            continue
        for w in {words[0], words[-1]}:
            if w == "header" and (in_main or words[0] in _MAIN_WORDS):
                continue
            if w in ASIDE_WORDS or w.startswith(_ASIDE_STARTS):
                found = max(found, WRAPPER if w in _WRAPPERS or w.startswith("popup") else WORD)
    return found


def _name(tag: str, attrs: dict[str, str]) -> str:
    """Generalised: digits in a class (or, without one, an id) become #."""
    names = sorted(attrs.get("class", "").split()) or attrs.get("id", "").split()[:1]
    return ".".join([tag, *(re.sub(r"\d+", "#", n) for n in names)])


class _Tags:
    """Finds the tags of a page from left to right."""

    def __init__(self, html: str) -> None:
        self.html, self.missing, self.wasted = html, set(), 0

    def find(self, what: str, at: int) -> int:
        """``str.find`` that looks for a missing string once only."""
        if what in self.missing:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose name ends at ``at``: outside
        quotes if they close, else the first one; -1 without any."""
        first = self.find(">", at)
        if first < 0 or self.wasted > max(1 << 16, len(self.html)):
            return first  # quotes were followed in vain over the length of the page
        i = at
        while m := _STOP.search(self.html, i):
            if m[0] == ">":
                return m.start()
            close = self.find(m[0], m.end())
            if close < 0:
                break
            i = close + 1
        self.wasted += len(self.html) - at
        return first

    def raw_end(self, tag: str, at: int) -> int:
        """Behind the closing tag of an element whose content is no text."""
        key = f"</{tag}"
        if key in self.missing:
            return at if tag == "head" else len(self.html)
        pattern = rf"</{tag}\s*>" if tag != "head" else r"</head\s*>|(?=<body[\s>])"
        m = re.compile(pattern, re.I).search(self.html, at)
        if m:
            return m.end()
        self.missing.add(key)
        return at if tag == "head" else len(self.html)


class Page:
    """Text blocks in page order, each with the number of its container path.  Path 0
    is the page; ``parent`` and ``name`` hold the others, a parent before its children."""

    def __init__(self, html: str) -> None:
        self.parent, self.name, self.depth, self._paths = [-1], [""], [0], {}
        self.blocks: list[tuple[str, int, int, int]] = []  # text, path, container, characters in links
        self.up, self.firm = [-1], [KEPT]                   # containers: parent, how firmly set aside
        self._read(html)
        self.main = [False] * len(self.parent)              # paths in an article or main element
        for i in range(1, len(self.parent)):
            self.main[i] = self.main[self.parent[i]] or self.name[i].split(".")[0] in ("article", "main")
        self.aside = self._asides()

    def path_of(self, parent: int, name: str) -> int:
        made = self._paths.get((parent, name))
        if made is None:
            made = self._paths[parent, name] = len(self.parent)
            self.parent.append(parent)
            self.name.append(name)
            self.depth.append(self.depth[parent] + 1)
        return made

    def find_path(self, names: list[str]) -> int | None:
        at = 0
        for name in names:
            at = self._paths.get((at, name))
            if at is None:
                return None
        return at

    def names(self, path: int) -> list[str]:
        out = []
        while path:
            out.append(self.name[path])
            path = self.parent[path]
        return out[::-1]

    def _read(self, html: str) -> None:
        tags = _Tags(html)
        # open blocks: tag, path, container, inside article or main
        stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        open_: dict[str, int] = {}
        held: list[str] = []
        links, in_link, at, plain = 0, False, 0, 0

        def flush() -> None:
            nonlocal links
            if held:
                text = " ".join("".join(held).split())
                if text:
                    self.blocks.append((text, stack[-1][1], stack[-1][2], links))
                held.clear()
            links = 0

        def take(raw: str) -> None:
            nonlocal links
            if raw:
                text = unescape(raw)
                held.append(text)
                if in_link:
                    links += len(text)

        def cut(i: int) -> None:
            for tag, *_ in stack[i:]:
                open_[tag] -= 1
            del stack[i:]

        while True:
            less = tags.find("<", at)
            if less < 0:
                break
            at = less + 1
            if html.startswith("<!--", less):
                take(html[plain:less])
                end = tags.find("-->", less + 4)
                at = plain = len(html) if end < 0 else end + 3
                continue
            if html.startswith("<![CDATA[", less):
                take(html[plain:less])
                end = tags.find("]]>", less + 9)
                take(html[less + 9:len(html) if end < 0 else end].replace("&", "&amp;"))
                at = plain = len(html) if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), less):
                end = tags.find(">", less)
                if end >= 0:
                    take(html[plain:less])
                    at = plain = end + 1
                continue
            m = _START.match(html, less)
            end = tags.end(m.end()) if m else -1
            if end < 0:
                continue
            take(html[plain:less])
            at = plain = end + 1
            closing, tag, raw = bool(m[1]), m[2].lower(), html[m.end():end]
            if tag in RAW:
                if not closing and not raw.rstrip().endswith("/"):
                    at = plain = tags.raw_end(tag, at)
                continue
            if tag == "a":
                in_link = not closing
                continue
            if tag == "br":
                held.append(" ")
                continue
            if tag not in BLOCKS:
                continue
            flush()
            in_link = False
            if closing:
                if open_.get(tag):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == tag:
                            cut(i)
                            break
                        if tag in _LEAVES and stack[i][0] in _LIMITS:
                            break
                continue
            if tag in ("hr", "html", "body"):
                continue
            while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6") and tag in _LEAVES):
                cut(len(stack) - 1)
            if any(open_.get(t) for t in _CLOSES.get(tag, ())):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in _CLOSES[tag]:
                        cut(i)
                        break
                    if stack[i][0] in _LIMITS:
                        break
            _, path, box, in_main = stack[-1]
            attrs = _attributes(raw) if raw else {}
            firm = _set_aside(tag, attrs, in_main)
            if tag not in _LEAVES:
                path = self.path_of(path, _name(tag, attrs))
            if firm or tag not in _LEAVES:
                self.up.append(box)
                self.firm.append(firm)
                box = len(self.up) - 1
            if raw.rstrip().endswith("/") and tag not in _LEAVES:
                continue
            stack.append((tag, path, box, in_main or tag in ("article", "main")))
            open_[tag] = open_.get(tag, 0) + 1
        take(html[plain:])
        flush()

    def _asides(self) -> list[bool]:
        """Per container, whether its text is set aside.  A wrapper with most of the
        page's text is kept where little else is left and no article stands beside it."""
        n = len(self.up)

        def made(keep: list[bool]) -> list[bool]:
            out = [False] * n
            for i in range(1, n):
                out[i] = out[self.up[i]] or self.firm[i] != KEPT and not keep[i]
            return out

        def chars(aside: list[bool]) -> int:
            return sum(len(text) for text, _, box, _ in self.blocks if not aside[box])

        strict, wrapper = made([False] * n), [f == WRAPPER for f in self.firm]
        if not any(wrapper):
            return strict
        loose = made(wrapper)
        inside = [0] * n
        for text, _, box, _ in self.blocks:
            if not loose[box]:
                inside[box] += len(text)
        for i in range(n - 1, 0, -1):
            inside[self.up[i]] += inside[i]
        if 5 * chars(strict) >= inside[0] or any(self.main[path] for _, path, box, _ in self.blocks if not strict[box]):
            return strict
        return made([w and 2 * x > inside[0] for w, x in zip(wrapper, inside)])

    def kept(self) -> Iterator[tuple[str, int, int]]:
        return ((text, path, links) for text, path, box, links in self.blocks if not self.aside[box])

    def below(self, path: int) -> list[bool]:
        """Per path, whether it is ``path`` or lies below it."""
        out = [False] * len(self.parent)
        out[path] = True
        for i in range(path + 1, len(out)):
            out[i] = out[self.parent[i]] or i == path
        return out


#: Per path: score, kept characters, navigational characters.
Scores = dict[int, tuple[float, int, int]]


def score_paths(page: Page, furniture: Set[int] = frozenset()) -> Scores:
    good, bad, own = [0] * len(page.parent), [0] * len(page.parent), [0] * len(page.parent)
    for text, path, links in page.kept():
        if furniture and block_hash(text) in furniture:
            own[path] += len(text)
        else:
            (bad if 2 * links > len(text) else good)[path] += len(text)
    for i in range(len(page.parent) - 1, 0, -1):
        good[page.parent[i]] += good[i]
        bad[page.parent[i]] += bad[i]
        own[page.parent[i]] += own[i]
    out = {}
    for path, n in enumerate(good):
        if n:
            name = page.name[path]
            tag = name.split(".")[0]
            boost = 1.5 if tag in ("article", "main") else 1.25 if _HINTS & set(_WORDS.findall(name.replace(".", " "))) else 1.0
            through = own[path] + (0 if tag == "article" else bad[path])
            out[path] = ((n - 2 * through) * boost, n, bad[path] + own[path])
    return out


def best_path(page: Page, scores: Scores) -> int | None:
    """The path of the best score: the deepest, then the first, of equal ones."""
    return max(scores, key=lambda p: (scores[p][0], page.depth[p], -p), default=None)


def widened(page: Page, scores: Scores, best: int) -> int:
    """``best`` or an ancestor, while that adds more kept than navigational text; an
    article or main element is not left."""
    chain, at = [], best
    while at:
        chain.append(at)
        at = page.parent[at]
    top = next((p for p in reversed(chain) if page.name[p].split(".")[0] in ("article", "main")), 0)
    at = best
    while at != top and at:
        at = page.parent[at]
        good, bad = (scores[at][i] - scores[best][i] for i in (1, 2))
        if good > bad:
            best = at
        elif bad:
            break
    return best


def block_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _outside(page: Page, own: int, voted: int) -> tuple[list[bool], list[bool]]:
    """Per path: inside the voted path; inside the smallest path over both."""
    a, b = own, voted
    while a != b:
        if page.depth[a] >= page.depth[b]:
            a = page.parent[a]
        else:
            b = page.parent[b]
    return page.below(voted), page.below(a)


def _split(path: str) -> list[str]:
    return path.split(">") if path else []


def extract_page(html: str | None, voted: str | None = None, furniture: Set[int] = frozenset()) -> str:
    """The main text of one page: its host's path if the page has kept text there, and
    what the page's own best path holds beside it that is no furniture."""
    page = Page(html or "")
    scores = score_paths(page, furniture) or score_paths(page)  # a page of furniture only is read as if alone
    own = best_path(page, scores)
    if own is None:
        return ""
    own = widened(page, scores, own)
    path = None if voted is None else page.find_path(_split(voted))
    if path is None or path not in scores:
        reach = page.below(own)
        return "\n".join(text for text, p, _ in page.kept() if reach[p])
    inside, reach = _outside(page, own, path)
    return "\n".join(text for text, p, _ in page.kept() if inside[p] or reach[p] and block_hash(text) not in furniture)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _furniture_of(value: list[int] | None) -> frozenset[int]:
    return frozenset(value or ())


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, html, furniture in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "furniture"))):
            page = Page(html or "")
            scores = score_paths(page, _furniture_of(furniture))
            path = best_path(page, scores)
            if path is not None:
                rows.append((host, ">".join(page.names(path)), scores[path][1]))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                          pa.array(columns[2], pa.int64())], names=["host", "path", "chars"])


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(host, h) for host, html in zip(*(batch.column(c).to_pylist() for c in ("host", "html")))
                for h in {block_hash(text) for text, _, _ in Page(html or "").kept()}]
        columns = list(zip(*rows)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], names=["host", "block"])


def host_furniture(pages: DataFrame) -> DataFrame:
    """``(host, furniture)``, one row per host that has any: hashes of the blocks that
    stand on ``REPEATED`` of its pages, three at least.  A host has at most
    1 / ``REPEATED`` times as many as its pages have blocks on average."""
    hosted = pages.select(host_of(F.col("url")).alias("host"), "html").where("host is not null")
    sizes = hosted.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = (hosted.mapInArrow(_block_rows, "host string, block long").groupBy("host", "block").agg(F.count(F.lit(1)).alias("n"))
            .where("n >= 3"))
    return (seen.join(sizes, "host").where(F.col("n") >= REPEATED * F.col("pages"))
            .groupBy("host").agg(F.collect_list("block").alias("furniture")))


def host_paths(pages: DataFrame, furniture: DataFrame | None = None) -> DataFrame:
    """``(host, path, votes)``: the path that most pages of a host vote for;
    ties go to the one with more text, then to the greater name."""
    hosted = pages.select(host_of(F.col("url")).alias("host"), "html").where("host is not null")
    if furniture is None:
        hosted = hosted.withColumn("furniture", F.lit(None).cast("array<long>"))
    else:
        hosted = hosted.join(sized(furniture), "host", "left")
    votes = (hosted.mapInArrow(_vote, "host string, path string, chars long")
             .groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("chars").alias("chars")))
    return (votes.groupBy("host").agg(F.max(F.struct("votes", "chars", "path")).alias("w"))
            .select("host", F.col("w.path").alias("path"), F.col("w.votes").alias("votes")))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` plus ``main_text``."""
    @F.pandas_udf("string")
    def again(html, path, furniture):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([extract_page(h, p, frozenset(() if f is None else f.tolist())) for h, p, f in zip(html, path, furniture)],
                         dtype=object)

    furniture = store(host_furniture(pages), "html-furniture")
    winners = store(host_paths(pages, furniture), "html-paths")
    known = store(winners.select("host", "path").join(furniture, "host", "full_outer"), "html-hosts")
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != "main_text"])
    keyed = pages.select(row.alias("row"), host_of(F.col("url")).alias("host"))
    joined = keyed.join(sized(known), "host", "left")
    return joined.select("row.*", again(F.col("row.html"), F.col("path"), F.col("furniture")).alias("main_text"))
