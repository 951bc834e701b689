"""Tables of web pages as typed rows. Only the reading of tags is Python; everything after it is DataFrame work."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.functions.text import BLANKS

#: A cell with the first of the rows and columns that it takes, and how many.
CELL = "struct<row: int, col: int, rows: int, cols: int, text: string, is_header: boolean, link: string, image: string>"
#: HTML's bounds of spans.
SPANS = {"colspan": 1000, "rowspan": 65534}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: The parts of a table with those that their start ends in the same table, and where rows are put right in.
CELLS, GROUPS = ("td", "th"), ("tbody", "thead", "tfoot")
PARTS = {"td": CELLS, "th": CELLS, "tr": ("tr", *CELLS, "caption")} | {g: (*GROUPS, "tr", *CELLS, "caption") for g in GROUPS}


class Tree(HTMLParser):
    """A small tree of (tag, attributes, children).

    Cells, rows and list items end where the next one starts; a row right in a table gets a tbody, a cell without a row
    a row. The places of open elements are kept by tag, so a page is read in time linear in its length.
    """

    ENDS = {"li": "li", "p": "p"}

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.root = ("", {}, [])
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}
        self.feed(source)
        self.close()

    def last(self, tag: str) -> int:
        """Where the innermost open element of a tag is, or -1."""
        own = self.places.get(tag)
        return own[-1] if own else -1

    def put(self, tag, attributes) -> None:
        node = (tag, attributes, [])
        self.open[-1][2].append(node)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(node)

    def end(self, at: int) -> None:
        while len(self.open) > at:
            self.places[self.open.pop()[0]].pop()

    def handle_starttag(self, tag, attrs):
        attributes = {k: v or "" for k, v in attrs}
        table = self.last("table")
        if tag in PARTS:
            at = min((i for t in PARTS[tag] if (i := self.last(t)) > table), default=-1)
            if at > 0:
                self.end(at)
            if tag in (*CELLS, "tr") and self.open[-1][0] == "table":
                self.put("tbody", {})
            if tag in CELLS and self.open[-1][0] in GROUPS:
                self.put("tr", {})
        elif self.open[-1][0] == self.ENDS.get(tag):
            self.end(len(self.open) - 1)
        if tag in VOID or (tag == "form" and self.open[-1][0] in ("table", "tr", *GROUPS)):
            self.open[-1][2].append((tag, attributes, []))
        else:
            self.put(tag, attributes)

    def handle_startendtag(self, tag, attrs):
        self.open[-1][2].append((tag, {k: v or "" for k, v in attrs}, []))

    def handle_endtag(self, tag):
        at = self.last(tag)
        if at > 0 and (tag == "table" or at > self.last("table")):
            self.end(at)

    def handle_data(self, data):
        self.open[-1][2].append(data)


def text_of(node) -> str:
    """The text under a node, in order; nodes wait on a list, so that depth is no limit."""
    parts, waiting = [], [node]
    while waiting:
        x = waiting.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            waiting.extend(reversed(x[2]))
    return "".join(parts)


def tidy(text: str) -> str:
    return " ".join(text.split())


def walk(node, tag: str | None = None) -> Iterator[tuple]:
    """The nodes under a node, of one tag if named, in the order of the page."""
    waiting = [x for x in reversed(node[2]) if not isinstance(x, str)]
    while waiting:
        x = waiting.pop()
        if tag is None or x[0] == tag:
            yield x
        waiting.extend(y for y in reversed(x[2]) if not isinstance(y, str))


def classes(node) -> list[str]:
    return node[1].get("class", "").split()


def span(node, name: str) -> int:
    """A span as HTML bounds it."""
    value = node[1].get(name, "")
    return min(int(value[:9]), SPANS[name]) if value.isascii() and value.isdigit() and int(value[:9]) > 0 else 1


def own_rows(table) -> list[tuple]:
    """The rows right under a table or its bodies, not those of tables inside its cells."""
    out = []
    for x in table[2]:
        if not isinstance(x, str):
            out += [x] if x[0] == "tr" else [y for y in x[2] if not isinstance(y, str) and y[0] == "tr"] if x[0] == "tbody" else []
    return out


def cells_of(table) -> tuple[int, list[dict]]:
    """The number of rows, and each cell once with the places it takes; where two take one place, it is the later one's.

    A cell starts in the first free place of its row. What earlier rows take in a row is kept as intervals of columns with
    the row they end before, neighbours of one end as one. Spans end with the table.
    """
    out, taken = [], []
    trs = own_rows(table)
    for r, tr in enumerate(trs):
        taken = [t for t in taken if t[2] > r]
        c = k = 0
        down = []
        for td in (x for x in tr[2] if not isinstance(x, str) and x[0] in CELLS):
            while k < len(taken) and taken[k][0] <= c:
                c, k = max(c, taken[k][1]), k + 1
            link = next((a[1].get("href") for a in walk(td, "a") if "image" in classes(a)), None)
            image = next((i[1].get("src") for i in walk(td, "img")), None)
            rows, cols = min(span(td, "rowspan"), len(trs) - r), span(td, "colspan")
            out.append({"row": r, "col": c, "rows": rows, "cols": cols, "text": tidy(text_of(td)), "is_header": td[0] == "th", "link": link, "image": image})
            if rows > 1:
                down.append((c, c + cols, r + rows))
            c += cols
        merged: list[tuple[int, int, int]] = []
        for start, stop, until in sorted([*taken, *down]):
            if merged and merged[-1][2] == until and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], stop), until)
            else:
                merged.append((start, stop, until))
        taken = merged
    return len(trs), out


def page_nodes(source: str) -> Iterator[tuple[str, bool, int | None, list | None]]:
    """(heading, is a wikitable, rows, cells) of the headings and tables right under the content of a page, in order."""
    root = Tree(source).root
    content = next((x for x in walk(root) if "mw-parser-output" in classes(x)), None) or next(walk(root, "body"), root)
    for x in content[2]:
        if isinstance(x, str):
            continue
        if x[0] in ("h2", "h3"):
            line = next((s for s in walk(x, "span") if "mw-headline" in classes(s)), x)
            yield tidy(text_of(line)), False, None, None
        elif x[0] == "table":
            yield "", "wikitable" in classes(x), *cells_of(x)


def inside(node, path: list[Callable[[tuple], bool]]) -> Iterator[tuple]:
    """The nodes under a node that pass the last test of the path and have ancestors that pass the others, in order; each once, in the order of the page."""
    waiting = [(x, 0) for x in reversed(node[2]) if not isinstance(x, str)]
    while waiting:
        x, passed = waiting.pop()
        if passed == len(path) - 1 and path[-1](x):
            yield x
        below = passed + (passed < len(path) - 1 and path[passed](x))
        waiting.extend((y, below) for y in reversed(x[2]) if not isinstance(y, str))


def _mapped(pages: DataFrame, of_page, schema: str, names: list[str], keep: tuple[str, ...]) -> DataFrame:
    rows = pages.select(*keep, F.coalesce("html", F.lit("")).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False, name=None):
                out += [(*row[:-1], *x) for x in of_page(row[-1])]
            yield pd.DataFrame(out, columns=[*keep, *names])

    kept = ", ".join(f"{k} {pages.schema[k].dataType.simpleString()}" for k in keep)
    return rows.mapInPandas(run, f"{kept}, {schema}")


def parse_tables(pages: DataFrame) -> DataFrame:
    """pages (path, html): (path, node_pos, heading, is_wikitable, n_rows, cells array<CELL>; the last two null for headings)."""
    of_page = lambda s: [(i, *x) for i, x in enumerate(page_nodes(s))]
    rows = _mapped(pages, of_page, f"node_pos int, heading string, is_wikitable boolean, n_rows double, cells array<{CELL}>", ["node_pos", "heading", "is_wikitable", "n_rows", "cells"], ("path",))
    return rows.withColumn("n_rows", F.col("n_rows").cast("int"))


def tagged(tag: str, name: str | None = None) -> Callable[[tuple], bool]:
    """A test for a tag, and a class if named."""
    return lambda x: x[0] == tag and (name is None or name in classes(x))


def catalogue_rows(pages: DataFrame, keep: tuple[str, ...] = ("source_code", "channel_url", "air_date")) -> DataFrame:
    """keep, row_pos, cells array<string> and the first link of every row in the body of a table, those of nested tables among them.

    A row's cells are all cells under it, trimmed, with the blanks inside them as they are.
    """

    def of_page(s: str) -> list[tuple]:
        out = []
        for tr in inside(Tree(s).root, [tagged("table"), tagged("tbody"), tagged("tr")]):
            cells = [text_of(td).strip(BLANKS) for td in walk(tr, "td")]
            out.append((len(out), cells, next((a[1].get("href") for a in walk(tr, "a")), None)))
        return out

    return _mapped(pages, of_page, "row_pos int, cells array<string>, href string", ["row_pos", "cells", "href"], keep)


def facet_labels(pages: DataFrame, keep: tuple[str, ...] = ("year",), mark: str = "filterQueryByFacet('ch'") -> DataFrame:
    """keep and label of the links in each cell of facet tables that mentions the channel facet, in an attribute or in its text."""

    def of_page(s: str) -> list[tuple]:
        out = []
        for td in inside(Tree(s).root, [tagged("table", "table_facettes"), tagged("td")]):
            if any(mark in v for x in walk(td) for v in x[1].values()) or mark in text_of(td):
                out += [(text_of(a).strip(BLANKS),) for a in walk(td, "a")]
        return out

    return _mapped(pages, of_page, "label string", ["label"], keep)


def page_links(pages: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """keep, pos and href of the links of a page, in order."""
    of_page = lambda s: [(i, a[1]["href"]) for i, a in enumerate(x for x in walk(Tree(s).root, "a") if "href" in x[1])]
    return _mapped(pages, of_page, "pos int, href string", ["pos", "href"], keep)
