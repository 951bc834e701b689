"""Main text of web pages by consensus host paths.

1. A page is read as a stream of tags. Its containers (elements that hold blocks of text) are scored: prose counts
   for them, text that is mostly links counts against them. From the deepest container that has nearly the best score
   (the core) the page's own choice is the nearest one above that holds all of the page's prose. It votes for its
   generalised path: the tags and classes from the root, digits and hash-like classes left out. A path travels as a
   128-bit hash of its labels, so votes and winners are of one small size however deep a page is nested.
2. Spark counts the votes for each host and path; the paths that get SHARE of their host's pages win.
3. Pages are read again: the text is that of the containers on a winning path (the path with most prose here if there
   are several) if they hold all of the page's prose; any other page keeps its own choice.

In a container what stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments is left out, by tag, role, and words of class and id. Inside an article a name alone is not enough, except
classes of adverts and of a page's tools (sharing, newsletters, menus): any other named block goes if most of it is links, if
it holds form fields and no sentence, if it is a list of comments, if its id is a tool's and it holds no sentence, or if a
class of it is such a name and it stands first or last, before or behind all of the article's own prose. Inside `main`, or
where only a name tells that this is an article, any name of a tool is enough. A block with an h1 stays, and ids of headings
and paragraphs never count. A form stays if it holds sentences, and half of the page's prose at least, as pages that are one
form do. Names that papers give to their parts (related-work, discussion) need evidence everywhere. Left out too is, outside
the core, text that is mostly links and stands neither in a heading nor right beside more prose.

Edge cases: null, empty or textless html gives the empty text; html without a container gives all its text blocks;
unclosed tags are closed by the blocks that follow; a null or odd url counts as the empty host; repeated rows vote
twice and get equal texts; an empty table gives an empty result; columns other than page_id, url and html are left
out, whatever their names; pages of any length and depth are read whole, in time and memory that grow with their length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import cut

#: Share of a host's pages that a path needs; share of the best score that the core needs; text of which this share is links isn't prose.
SHARE, NEARLY, LINKS = 0.1, 0.7, 0.5
#: Share of all pages from which a host is hot; tasks that the pages of any other host are dealt to.
HOT, SALTS = 0.001, 16

#: HTML's elements without content, elements whose content isn't markup, elements that end a block of
#: text, elements whose start ends an open paragraph, and elements that never hold an article's text.
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes noembed iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body caption head html legend option tbody td tfoot th thead tr dd dt li".split())
CONTAINER = frozenset("article main section div body td center blockquote".split())
DROPPED = frozenset("head script style noscript template nav aside button select textarea iframe object svg canvas audio video dialog menu title".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
HOLDS_P = CONTAINER | {"li", "th"}
OUTSIDE_CELLS = frozenset("tr table tbody thead tfoot body html".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words of class and id that mark what isn't the article.
BOILERPLATE = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner|sidebar|side-?bar|aside|nav|navbar|navigation|menu|breadcrumbs?|footer|foot|"
    r"header|masthead|topbar|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|"
    r"comments?|commentlist|disqus|replies|respond|discussion|related|recommend\w*|widget|toolbar|pagination|pager|skip|search|copyright|legal|tagcloud)(?:$|[^a-z])"
)
#: Of these the classes of adverts, the names of a page's tools rather than of topics, and comments.
ADVERT = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|adslot)(?:$|[^a-z])")
TOOL = re.compile(
    r"(?:^|[^a-z])(?:sidebar|side-?bar|nav|navbar|navigation|menu|breadcrumbs?|footer|foot|masthead|topbar|cookies?|consent|gdpr|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|login|share|sharing|social|toolbar|pagination|pager|skip|tagcloud)(?:$|[^a-z])"
)
COMMENT_LIST = re.compile(r"(?:^|[^a-z])(?:comments|commentlist|disqus|replies)(?:$|[^a-z])")
COMMENT = re.compile(r"(?:^|[^a-z])(?:comment|reply)(?:$|[^a-z])")
FIELDS = frozenset("form input select textarea button".split())
#: Names that topics have too, and the words that a class of a block beside the article is made of.
TOPIC = re.compile(r"(?:^|\s)(?:related[-_]?works?|discussions?)(?=\s|$)")
BESIDE = frozenset("alert aside banner comment comments copyright disqus legal notice notices promo recommended related replies reply respond search sponsor sponsored widget".split())
FILLS = frozenset("article articles bar block bottom box container content inner item items links list message panel post posts section site text top wrap wrapper".split())
#: Words of a sentence.
SENTENCE = 8
ARTICLE = re.compile(r"(?:^|[^a-z])(?:article\w*|content|main|post|entry|story|body-?text|text|prose)(?:$|[^a-z])")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
HASHED = re.compile(r"\d|^.{25,}$")
SCHEMA_VOTE = "host string, path string, score double"


@dataclass
class Element:
    tag: str
    path: bytes  # hash of the labels from the root
    dropped: bool
    container: int  # index of the nearest container
    in_article: int = 0  # 1 inside a container whose name is an article's, 2 inside an article element
    suspect: int = -1  # index of the nearest suspect


@dataclass
class Suspect:
    """A block inside an article whose name is one of boilerplate, and what speaks for that."""

    parent: int
    path: bytes
    classes: str
    named: str
    text: int = 0
    links: int = 0
    fields: int = 0
    comments: int = 0
    sentences: int = 0
    title: bool = False
    form: bool = False
    beside: bool = False  # a class of it is a name of what stands beside an article

    def boilerplate(self, prose: int, edge: bool) -> bool:
        """With the page's prose, and whether it stands before or behind all of the article's own prose."""
        if self.form:
            return not self.sentences or 2 * (self.text - self.links) < prose
        if self.title:
            return False
        fields = self.fields > 0 and not self.sentences
        tool = any(TOOL.fullmatch(c) for c in self.classes.split()) or (bool(TOOL.search(self.named)) and not self.sentences)
        return bool(ADVERT.search(self.classes)) or (0 < self.text <= self.links / LINKS) or fields or tool or self.comments > 0 or (self.beside and edge)


@dataclass
class Page:
    paths: list[str] = field(default_factory=list)  # of containers, as hexadecimal hashes
    depths: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    bonus: list[bool] = field(default_factory=list)
    blocks: list[tuple[int, str, int, bool]] = field(default_factory=list)  # (container, text, characters in links, heading)


def generalised(tag: str, classes: str) -> str:
    names = sorted(c for c in classes.lower().split() if not HASHED.search(c))
    return ".".join([tag, *names])


def named_beside(classes: str) -> bool:
    """True if one of the classes is made of names of what stands beside an article, and of words that say nothing."""
    parts = [set(re.split(r"[^a-z]+", c)) - {""} for c in classes.split()]
    return any(p & BESIDE and p <= BESIDE | FILLS for p in parts)


def path_of(labels: list[str]) -> str:
    """The hash that stands for a path of generalised labels."""
    path = b""
    for label in labels:
        path = step(path, label)
    return path.hex()


def step(path: bytes, label: str) -> bytes:
    return xxhash.xxh3_128_digest(path + label.encode("utf-8", "replace"))


def parse(source: str) -> Page:
    page = Page()
    stack: list[Element] = []
    parts: list[str] = []
    in_links = 0
    links = 0  # open a elements
    suspects: list[Suspect] = []
    of_block: list[int] = []  # the nearest suspect of each block
    places: dict[str, list[int]] = {}  # of each tag, where it is open on the stack

    def last(tags: Iterable[str]) -> int:
        """The innermost place where one of the tags is open, or -1."""
        return max((own[-1] for t in tags if (own := places.get(t))), default=-1)

    def end_block() -> None:
        nonlocal parts, in_links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                heading = bool(stack) and stack[-1].tag in HEADING
                page.blocks.append((stack[-1].container if stack else -1, text, in_links, heading))
                at = stack[-1].suspect if stack else -1
                of_block.append(at)
                if at >= 0:
                    e = suspects[at]
                    e.title = e.title or stack[-1].tag == "h1"
                    if not heading:
                        e.text += len(text)
                        e.links += in_links
                        e.sentences += text.count(" ") + 1 >= SENTENCE and in_links < LINKS * len(text)
        parts, in_links = [], 0

    def said(text: str) -> None:
        nonlocal in_links
        if text and not (stack and stack[-1].dropped):
            parts.append(text)
            if links:
                in_links += len(text)

    def close(at: int) -> None:
        nonlocal links
        while len(stack) > at:
            e = stack[-1]
            if e.tag in BLOCK:
                end_block()
            links -= e.tag == "a" and links > 0
            places[e.tag].pop()
            stack.pop()

    at, n = 0, len(source)
    tags_end = source.rfind(">")  # behind it nothing is a tag but a comment
    while at < n:
        m = TOKEN.search(source, at) if at <= tags_end or "<!" in source[at:] else None
        if not m:
            said(source[at:])
            break
        said(source[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            if m[0].startswith("<![CDATA["):
                said(html.escape(m[0][9:-3]))
            continue
        tag = tag.lower()
        if closing:
            i = last((tag,))
            # What is open outside a cell can't be closed from inside it.
            if i >= 0 and (tag in OUTSIDE_CELLS or i >= last(("td", "th"))):
                close(i)
            continue
        if tag in ENDS_P:
            i = last(("p",))
            if i > last(HOLDS_P):
                close(i)
        if tag in ENDED_BY:
            i = last(ENDED_BY[tag])
            if i > last(("ul", "ol", "dl", "table", "select")):
                close(i)
        if tag in BLOCK:
            end_block()
        elif tag == "br":
            said("\n")
        elif tag == "img" or tag == "wbr":
            continue
        if tag in FIELDS and stack:
            i = stack[-1].suspect
            if i >= 0:
                suspects[i].fields += 1
        if tag in VOID:
            continue
        classes = role = ""
        named = ""
        hidden = False
        if attributes and "=" in attributes or "hidden" in attributes:
            for a in ATTRIBUTE.finditer(attributes):
                name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if name == "class":
                    classes = html.unescape(value)
                    named += " " + classes.lower()
                elif name == "id":
                    named += " " + value.lower()
                elif name == "role":
                    role = value.lower()
                elif name == "style" and re.search(r"display\s*:\s*none", value):
                    hidden = True
                elif name == "aria-hidden" and value == "true":
                    hidden = True
        above = stack[-1] if stack else None
        inside = above.in_article if above else 0
        marked = tag == "main" or role == "main" or (tag in CONTAINER and tag != "body" and bool(named and ARTICLE.search(named)))
        in_article = 2 if tag == "article" or role == "article" else max(inside, int(marked))
        dropped = bool(above and above.dropped) or hidden or tag in DROPPED or role in DROPPED_ROLES
        if not dropped and (tag in ("header", "footer")):
            dropped = tag == "footer" or in_article < 2
        path = step(above.path if above else b"", generalised(tag, classes))
        suspect = above.suspect if above else -1
        if not dropped and suspect >= 0 and (COMMENT.search(classes.lower()) or (tag in ("li", "article") and COMMENT_LIST.search(suspects[suspect].classes))):
            suspects[suspect].comments += bool(COMMENT_LIST.search(suspects[suspect].named))
        if not dropped and named and tag not in ("body", "html", "article", "main"):
            judged = classes.lower() if tag in HEADING or tag == "p" else named
            if BOILERPLATE.search(judged):
                by_name = not inside and BOILERPLATE.search(TOPIC.sub(" ", judged))
                if by_name or (inside < 2 and TOOL.search(judged)) or (tag not in BLOCK and ADVERT.search(classes.lower())):
                    dropped = True
                elif tag in BLOCK and tag not in HEADING:
                    suspects.append(Suspect(suspect, path, classes.lower(), judged, beside=tag != "p" and named_beside(classes.lower())))
                    suspect = len(suspects) - 1
        if not dropped and (tag == "form" or role == "form"):
            suspects.append(Suspect(suspect, path, "", "", form=True))
            suspect = len(suspects) - 1
        container = above.container if above else -1
        if tag in CONTAINER and not dropped:
            page.paths.append(path.hex())
            page.depths.append(len(stack))
            page.parents.append(container)
            page.bonus.append(tag in ("article", "main") or role in ("main", "article") or bool(named and ARTICLE.search(named)))
            container = len(page.paths) - 1
        places.setdefault(tag, []).append(len(stack))
        stack.append(Element(tag, path, dropped, container, in_article, suspect))
        links += tag == "a"
        if tag in RAW:
            end = RAW_END[tag].search(source, at)
            at = end.start() if end else n
    close(0)
    end_block()
    if suspects:
        for e in reversed(suspects):  # what a suspect holds, its parents hold
            if e.parent >= 0:
                above = suspects[e.parent]
                above.title = above.title or e.title
                above.text, above.links, above.fields, above.sentences = above.text + e.text, above.links + e.links, above.fields + e.fields, above.sentences + e.sentences
        comments = Counter(e.path for e in suspects if COMMENT.search(e.classes))
        text_of = [len(b[1]) if b[2] < LINKS * len(b[1]) and not b[3] else 0 for b in page.blocks]
        spans = [[len(text_of), -1] for _ in suspects]  # first and last block of each suspect
        for k, at in enumerate(of_block):
            if at >= 0:
                spans[at] = [min(spans[at][0], k), k]
        for e, (first, last_) in zip(reversed(suspects), reversed(spans), strict=True):
            if e.parent >= 0:
                spans[e.parent] = [min(spans[e.parent][0], first), max(spans[e.parent][1], last_)]
        # The article's own prose: what stands in no suspect but forms and blocks with its title.
        free = [at < 0 or (suspects[at].parent < 0 and (suspects[at].form or suspects[at].title)) for at in of_block]
        own = [k for k, n in enumerate(text_of) if n and free[k]]
        gone: list[bool] = []
        for e, (first, last_) in zip(suspects, spans, strict=True):  # children come after their parents
            edge = bool(own) and (last_ < own[0] or first > own[-1])
            gone.append((e.parent >= 0 and gone[e.parent]) or e.boilerplate(sum(text_of), edge) or (comments[e.path] > 1 and bool(COMMENT.search(e.classes))))
        page.blocks = [b for b, at in zip(page.blocks, of_block, strict=True) if at < 0 or not gone[at]]
    return page


def scores(page: Page) -> list[float]:
    """Of each container, with all that it holds."""
    own = [0.0] * len(page.paths)
    for container, text, in_links, _ in page.blocks:
        if container >= 0:
            own[container] += len(text) if in_links < LINKS * len(text) else -len(text)
    for i in range(len(own) - 1, -1, -1):  # children come after their parents
        if page.parents[i] >= 0:
            own[page.parents[i]] += own[i]
    return own


def core(page: Page) -> int:
    """The deepest container with nearly the best score; one that says it is the article needs half of that share."""
    own = scores(page)
    best = max(own, default=0.0)
    if best <= 0:
        return -1
    marked = [i for i, s in enumerate(own) if page.bonus[i] and s >= NEARLY / 2 * best]
    near = [i for i, s in enumerate(own) if s >= NEARLY * best]
    # Of those that say it the outermost, so that no part of an article is lost; else the innermost.
    return max(marked, key=lambda i: (own[i], -page.depths[i], -i)) if marked else max(near, key=lambda i: (page.depths[i], own[i], -i))


def prose(page: Page) -> tuple[list[int], int]:
    """Characters of text that isn't mostly links: of each container, with all that it holds, and of the page."""
    own, total = [0] * len(page.paths), 0
    for container, text, in_links, _ in page.blocks:
        if in_links < LINKS * len(text):
            total += len(text)
            if container >= 0:
                own[container] += len(text)
    for i in range(len(own) - 1, -1, -1):
        if page.parents[i] >= 0:
            own[page.parents[i]] += own[i]
    return own, total


def choice(page: Page) -> tuple[int, float]:
    """The container nearest above the core that holds all prose, and how much; -1 if none does, or nothing is prose."""
    own, total = prose(page)
    pick = core(page)
    while pick >= 0 and own[pick] < total:
        pick = page.parents[pick]
    return pick, float(own[pick]) if pick >= 0 else 0.0


def under(page: Page, inside: list[bool]) -> list[bool]:
    """The containers, and all that they hold."""
    for i, parent in enumerate(page.parents):
        inside[i] = inside[i] or (parent >= 0 and inside[parent])
    return inside


def extract(page: Page, winners: list[str]) -> str:
    """Blocks under the containers of the winning path with most prose if that is all of the page's, else under the page's own choice."""
    first = core(page)
    if first < 0:
        return "\n\n".join(b[1] for b in page.blocks)
    own, total = prose(page)
    by_path: dict[str, int] = {}
    for p, n in zip(page.paths, own, strict=True):
        by_path[p] = by_path.get(p, 0) + n
    known = [p for p in winners if p in by_path and by_path[p] >= total]
    pick = choice(page)[0]
    if known:
        path = max(known, key=lambda p: (by_path[p], p))
        inside = under(page, [p == path for p in page.paths])
    else:
        inside = under(page, [i == pick or pick < 0 for i in range(len(page.paths))])
    everywhere = pick < 0 and not known
    central = under(page, [i == first for i in range(len(page.paths))])
    beside = [0] * len(page.paths)  # prose less links, of what stands right in a container
    for c, t, in_links, _ in page.blocks:
        if c >= 0:
            beside[c] += len(t) if in_links < LINKS * len(t) else -len(t)
    out = []
    for c, t, in_links, heading in page.blocks:
        if (c >= 0 and inside[c]) or everywhere:
            if in_links < LINKS * len(t) or heading or (c >= 0 and (central[c] or beside[c] > 0)):
                out.append(t)
    return "\n\n".join(out)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score): a row for each page, of nulls where it has no choice."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for host, source in zip(b["host"], b["html"], strict=True):
                page = parse(source)
                i, score = choice(page)
                out.append((host, page.paths[i] if i >= 0 else None, score))
            yield pd.DataFrame(out, columns=["host", "path", "score"])

    return rows.mapInPandas(run, SCHEMA_VOTE)


def consensus(cast: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, n, winners array<string>): pages of each host, and at most 1 / share paths."""
    by_path = cut(cast.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("path").alias("m")))  # pages are parsed once for it
    total = by_path.groupBy("host").agg(F.sum("n").alias("n"), F.sum("m").alias("voted"))
    won = by_path.select("host", "path", "m").join(total, "host").withColumn("won", F.when((F.col("m") > 0) & (F.col("m") >= share * F.col("voted")), F.col("path")))
    return won.groupBy("host").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("won")).alias("winners"))


def extract_pages(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of each page.

    Hosts with HOT of all pages, so 1 / HOT of them at most, are looked up in a broadcast table; only pages of the
    others are dealt by host, those of each host to SALTS tasks.
    """
    rows = pages.select(F.col("page_id").cast("long").cast("string").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    hosts = cut(consensus(votes(pages), share))
    every = hosts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(hosts.where(F.col("n") >= HOT * every).select("host", "winners"))
    cold = hosts.where(F.col("n") < HOT * every).select("host", "winners", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    names = ["page_id", "url", "html", "winners"]
    others = rows.join(hot, "host", "left_anti").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    ready = rows.join(hot, "host").select(names).unionByName(others.join(cold, ["host", "salt"], "left").select(names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [extract(parse(s), list(w) if w is not None else []) for s, w in zip(b["html"], b["winners"], strict=True)]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    out = ready.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast("long"))
