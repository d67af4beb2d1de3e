"""Tables, links, lists and label/value pairs out of HTML bodies.

Spark has no HTML parser, so this is one of the two places where Python sees rows: a small reader
per document inside ``mapInArrow``. Spark splits the documents over tasks; each document comes out
as many short rows, and everything after that is native SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from html import unescape
from itertools import compress, repeat

import pyarrow as pa
from pyspark.sql import DataFrame

from quotemill.shipping import ship_by_value

_FLUSH_ROWS = 5000

# Most of a long table is rows, or cells in a row, that hold nothing but text: a run of such rows is one token (group 1), a
# run of such cells another (group 2), of such header cells a third (group 3). So is a run of rows with a link in the first cell
# (group 4): with a key or none, a description under the link or none, and nothing but text in the other cells. Comments,
# declarations and the contents of scripts and styles have no last group of their own; a tag fills the groups up to 8 (slash,
# name, attributes), a text fills group 9.
_LINKED_ROW = (
    r'<tr(?: data-rowkey="{0}[^"]*+{1}")?+><td><a href="{0}[^"]*+{1}">{0}[^<]*+{1}</a>(?:<sup>{0}[^<]*+{1}</sup>)?+</td>{0}(?:<td>[^<]*+</td>)++{1}</tr>'
)
_TOKEN = re.compile(
    r"((?-i:<tr>(?:<td>[^<]*+</td>)++</tr>)++)"
    r"|((?-i:<td>[^<]*+</td>)++)"
    r"|((?-i:<th>[^<]*+</th>)++)"
    rf"|((?-i:{_LINKED_ROW.format('', '')})++)"
    r"|<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>"
    r"|<(script|style)\b[^>]*>.*?(?:</\5\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|([^<]++|<)",
    re.S | re.I,
)
_ROWS, _CELLS, _TITLES, _LINKED, _SLASH, _NAME, _TAG, _TEXT = 1, 2, 3, 4, 6, 7, 8, 9
_ONE_TAG = re.compile(r"<(/?)(t[rdh]|a|sup)((?: (?:data-rowkey|href)=\"[^\"]*+\")?+)>|([^<]++)")  # what the runs are made of
_ONE_LINKED_ROW = re.compile(_LINKED_ROW.format("(", ")"))
_ROW_GROUPS = frozenset(("thead", "tbody", "tfoot"))
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HEADINGS = frozenset(("h1", "h2", "h3"))
_READ_ATTRIBUTES = frozenset(("a", "td", "th", "tr", "table", "div", "section"))
_INLINE = frozenset(("a", "b", "i", "em", "strong"))
_PAIR_PARENTS = frozenset(("li", "tr", "div", "dl", "p", "section"))
# Containers whose joined text nobody asks for.
_NO_TEXT = frozenset("html head body main article nav table thead tbody tfoot tr ul ol".split())
# What a start tag ends when the page left the end tag out, and where the search for it stops.
_ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",), "p": ("p",)}
_STOPS = frozenset("table ul ol div section body html".split())


class _Node:
    __slots__ = ("tag", "text", "href", "first_href", "children", "span", "id")

    def __init__(self, tag: str):
        self.tag = tag
        self.id = None
        self.text: list[str] = []
        self.href = self.first_href = None
        self.children: list[str] = []
        self.span = 1


class _Run:
    """Rows that follow each other and have equally many cells, by columns."""

    __slots__ = ("keys", "links", "columns")

    def __init__(self, keys: list[str | None], links: list[str], columns: list[list[str]]):
        self.keys, self.links, self.columns = keys, links, columns


class _Page:
    """What the jobs need from one document. With ``runs`` it is for those who read tables only: the rows of a run stand in
    the table as one :class:`_Run`, but for the last one, which cells behind it would belong to."""

    def __init__(self, body: str | None, runs: bool = False):
        self._runs = runs
        self.tables: list[dict] = []
        self.items: list[tuple[int, int, str, str | None]] = []
        self.links: list[tuple[str, str]] = []
        self.pairs: list[tuple[str, str]] = []
        self.title = None
        self._heading = None
        self._open_tables: list[dict] = []
        self._stack: list[_Node] = []
        self._lists = -1
        self._list_stack: list[list[int]] = []
        for token in _TOKEN.finditer(body or ""):
            kind = token.lastindex
            if kind == _TEXT:
                self._text(token[_TEXT])
            elif kind == _TAG:
                if token[_SLASH]:
                    self._end(token[_NAME].lower())
                else:
                    self._start(token[_NAME].lower(), token[_TAG])
            elif kind == _LINKED:
                if self._in_table(len(self._stack)):
                    self._linked_rows(token[_LINKED])
                else:
                    self._one_by_one(token[_LINKED])
            elif kind == _ROWS:
                if self._in_table(len(self._stack)):
                    self._plain_rows(token[_ROWS])
                else:
                    self._one_by_one(token[_ROWS])
            elif kind == _CELLS or kind == _TITLES:
                if self._stack and self._stack[-1].tag == "tr" and self._in_table(len(self._stack) - 1):
                    self._plain_cells(token[kind], kind == _TITLES)
                else:
                    self._one_by_one(token[kind])
        while self._stack:
            self._finish(self._stack.pop())

    def _text(self, text: str) -> None:
        if self._stack:
            self._stack[-1].text.append(unescape(text) if "&" in text else text)

    def _in_table(self, depth: int) -> bool:
        """Whether the innermost of the first ``depth`` open elements is a table, or a row group right in one: then a row
        ends nothing that is open."""
        stack = self._stack
        if depth > 1 and stack[depth - 1].tag in _ROW_GROUPS:
            depth -= 1
        return depth > 0 and stack[depth - 1].tag == "table"

    def _one_by_one(self, run: str) -> None:
        """The tags and texts of a run, where it stands at an odd place."""
        for end, tag, attributes, text in _ONE_TAG.findall(run):
            if text:
                self._text(text)
            elif end:
                self._end(tag)
            else:
                self._start(tag, attributes)

    def _plain_rows(self, run: str) -> None:
        rows = self._open_tables[-1]["rows"]
        for row in run[8:-10].split("</td></tr><tr><td>"):
            cells = _plain_texts(row)
            rows.append({"cells": cells, "hrefs": [None] * len(cells), "head": False, "key": None, "titles": [], "plain": cells[:]})
            if len(cells) >= 2:
                self.pairs.append((cells[0], cells[1]))

    def _linked_rows(self, run: str) -> None:
        rows, links, pairs = self._open_tables[-1]["rows"], self.links, self.pairs
        escaped, first = "&" in run, len(links)
        found = self._linked_run(run, rows) if self._runs else (match.groups() for match in _ONE_LINKED_ROW.finditer(run))
        for key, href, name, description, others in found:
            if escaped:
                key, href, name, description = (part and unescape(part) for part in (key, href, name, description))
            texts = _plain_texts(others[4:-5])
            text = name.strip() if description is None else f"{name}\n{description}".strip()
            cells = [text, *texts]
            rows.append({"cells": cells, "hrefs": [href] + [None] * len(texts), "head": False, "key": key, "titles": [], "plain": cells[:]})
            links.append((href, name.strip()))
            if description is None:
                pairs.append((text, texts[0]))
            elif len(texts) >= 2:  # a cell with a description is no child of its row
                pairs.append((texts[0], texts[1]))
        self._first_link(links[first][0])

    def _first_link(self, href: str) -> None:
        for outer in self._stack:
            if outer.first_href is None:
                outer.first_href = href

    def _linked_run(self, run: str, rows: list) -> list[tuple]:
        """Puts the rows of a run into the table by columns and gives the parts of those left: the last row, or all if their
        sizes differ."""
        parts = _ONE_LINKED_ROW.split(run)
        parts = [parts[group::6] for group in range(1, 6)]
        last = [tuple(part.pop() for part in parts)]
        keys, links, names, descriptions, others = parts
        sizes = {cells.count("<td>") for cells in others}
        if len(sizes) != 1:
            return [*zip(*parts), *last]
        texts, size = _plain_texts("".join(others)[4:-5]), sizes.pop()
        if "&" in run:
            keys = [key and unescape(key) for key in keys]
            links, names = list(map(unescape, links)), list(map(unescape, names))
            descriptions = [text and unescape(text) for text in descriptions]
        first = [name.strip() if text is None else f"{name}\n{text}".strip() for name, text in zip(names, descriptions)]
        rows.append(_Run(keys, links, [first, *(texts[place::size] for place in range(size))]))
        self._first_link(links[0])
        return last

    def _plain_cells(self, run: str, titles: bool) -> None:
        row = self._open_tables[-1]["rows"][-1]
        cells = _plain_texts(run[4:-5], "</th><th>" if titles else "</td><td>")
        row["cells"] += cells
        row["hrefs"] += [None] * len(cells)
        row["head"] = row["head"] and titles
        row["titles" if titles else "plain"] += cells
        self._stack[-1].children += cells

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("br", "sup") and self._stack:  # a description under a name is a line of its own
            self._stack[-1].text.append("\n")
        if tag in _VOID:
            return
        if tag in _ENDS:
            self._end_implied(_ENDS[tag])
        node = _Node(tag)
        key = None
        if "=" in attributes and tag in _READ_ATTRIBUTES:
            for match in _ATTRIBUTE.finditer(attributes):
                name = match[1].lower()
                value = unescape(match[2] or match[3] or match[4] or "")
                if name == "href":
                    node.href = value
                elif name == "colspan":
                    node.span = _whole(value)
                elif name == "data-rowkey":
                    key = value
                elif name == "id":
                    node.id = value
        if tag == "table":
            inside = frozenset(outer.id for outer in (*self._stack, node) if outer.id is not None)
            table = {"rows": [], "heading": self._heading, "order": len(self.tables), "inside": inside}
            self.tables.append(table)
            self._open_tables.append(table)
        elif tag == "tr" and self._open_tables:
            self._open_tables[-1]["rows"].append({"cells": [], "hrefs": [], "head": True, "key": key, "titles": [], "plain": []})
        elif tag in ("ul", "ol"):
            self._lists += 1
            self._list_stack.append([self._lists, 0])
        self._stack.append(node)

    def _end_implied(self, tags: tuple[str, ...]) -> None:
        for depth in range(len(self._stack) - 1, -1, -1):
            tag = self._stack[depth].tag
            if tag in tags:
                while len(self._stack) > depth:
                    self._finish(self._stack.pop())
                return
            if tag in _STOPS:
                return

    def _end(self, tag: str) -> None:
        stack = self._stack
        if stack and stack[-1].tag == tag:
            self._finish(stack.pop())
        elif any(node.tag == tag for node in stack):
            while stack:
                node = stack.pop()
                self._finish(node)
                if node.tag == tag:
                    break

    def _finish(self, node: _Node) -> None:
        tag, text = node.tag, "".join(node.text)
        flat = text.strip()
        if tag == "td" or tag == "th":
            if self._open_tables and self._open_tables[-1]["rows"]:
                row = self._open_tables[-1]["rows"][-1]
                row["cells"] += [flat] * node.span
                row["hrefs"] += [node.first_href] * node.span
                row["head"] = row["head"] and tag == "th"
                row["titles" if tag == "th" else "plain"].append(flat)
        elif tag == "a":
            if node.href is not None:
                self.links.append((node.href, flat))
                self._first_link(node.href)
        elif tag == "table":
            if self._open_tables:
                self._open_tables.pop()
        elif tag == "ul" or tag == "ol":
            if self._list_stack:
                self._list_stack.pop()
        elif tag == "li":
            if self._list_stack:
                place = self._list_stack[-1]
                self.items.append((place[0], place[1], flat, node.first_href))
                place[1] += 1
        elif tag == "title":
            if self.title is None:
                self.title = flat
        elif tag in _HEADINGS:
            self._heading = flat
        if len(node.children) >= 2 and tag in _PAIR_PARENTS:
            self.pairs.append((node.children[0], node.children[1]))
        if self._stack:
            outer = self._stack[-1]
            if not node.children and tag not in _INLINE:
                outer.children.append(flat)
            if outer.tag not in _NO_TEXT and tag != "table" and tag != "title":
                outer.text.append(text)


def _plain_texts(cells: str, between: str = "</td><td>") -> list[str]:
    """The texts of cells that follow each other."""
    texts = cells.split(between)
    return list(map(str.strip, map(unescape, texts) if "&" in cells else texts))


def _whole(value: str) -> int:
    """A colspan as a count; what is not a whole number counts as 1."""
    try:
        return max(1, int(value))
    except ValueError:
        return 1


_ARROW = {"int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<string>": pa.list_(pa.string())}


def _mapped(raw: DataFrame, ids: Sequence[str], body: str, fields: dict[str, str], emit, runs: bool = False) -> DataFrame:
    """Run ``emit(page)`` per document; ``fields`` names what each emitted tuple holds. ``runs`` is for :class:`_Page`."""
    kinds = dict(raw.select(*ids).dtypes)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in {**{i: kinds[i] for i in ids}, **fields}.items())
    names = [*ids, *fields]
    types = list(fields.values())
    width = len(ids)

    def assemble(batch, rows, places):
        ids_out = [batch.column(i).take(pa.array(places, pa.int64())) for i in range(width)]
        columns = list(zip(*rows)) if rows else [()] * len(types)
        values = [pa.array(column, _ARROW[kind]) for column, kind in zip(columns, types)]
        return pa.RecordBatch.from_arrays([*ids_out, *values], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = [], []
            # One document is a text at a time, and few rows wait: what a batch takes does not grow with it.
            for place, text in enumerate(batch.column(width)):
                for row in emit(_Page(text.as_py(), runs)):
                    rows.append(row)
                    places.append(place)
                    if len(rows) >= _FLUSH_ROWS:
                        yield assemble(batch, rows, places)
                        rows, places = [], []
            yield assemble(batch, rows, places)

    return raw.select(*ids, body).mapInArrow(run, schema)


def table_rows(
    raw: DataFrame, ids: Sequence[str], body: str = "body", header: bool = False, only: int | None = None, least: int = 0
) -> DataFrame:
    """One row per table row: table and row number, header flag, cell texts, first link of each cell,
    the row's key attribute and the heading above the table; with ``header`` also the cells of the
    table's first row, for those who find cells by name. ``only`` picks one table by its number and
    ``least`` leaves out documents with fewer tables; neither then costs a row."""
    fields = {
        "table_no": "int", "row_no": "int", "n_rows": "int", "is_head": "boolean", "cells": "array<string>",
        "hrefs": "array<string>", "row_key": "string", "heading": "string", "n_tables": "int",
    }
    if header:
        fields["header"] = "array<string>"

    def emit(page):
        if len(page.tables) < least:
            return
        for table in page.tables if only is None else page.tables[only:only + 1]:
            rows = [row for row in table["rows"] if row["cells"]]
            same = (table["heading"], len(page.tables), *([rows[0]["cells"]] if header and rows else []))
            for number, row in enumerate(rows):
                yield (table["order"], number, len(rows), row["head"], row["cells"], row["hrefs"], row["key"], *same)

    return _mapped(raw, ids, body, fields, emit)


def named_cells(
    raw: DataFrame, ids: Sequence[str], names: dict[str, str], clean: Callable[[str], str], body: str = "body", only: int | None = None, least: int = 0
) -> DataFrame:
    """:func:`table_rows` with texts in place of cells: ``names`` are output columns by the names in the table's first row,
    which ``clean`` makes comparable. They are looked up once a table. The first of equal names counts; a row without the
    cell, or a table without the name, gives null."""
    fields = {"table_no": "int", "row_no": "int", "n_rows": "int", "is_head": "boolean", **dict.fromkeys(names.values(), "string")}

    def emit(page):
        if len(page.tables) < least:
            return
        for table in page.tables if only is None else page.tables[only:only + 1]:
            rows = [row for row in table["rows"] if row["cells"]]
            found = [clean(name) for name in rows[0]["cells"]] if rows else []
            places = [found.index(name) if name in found else None for name in names]
            longest = max((place for place in places if place is not None), default=-1)
            for number, row in enumerate(rows):
                cells = row["cells"]
                if len(cells) > longest:
                    texts = [None if place is None else cells[place] for place in places]
                else:
                    texts = [None if place is None or place >= len(cells) else cells[place] for place in places]
                yield (table["order"], number, len(rows), row["head"], *texts)

    return _mapped(raw, ids, body, fields, emit)


def keyed_cells(raw: DataFrame, ids: Sequence[str], names: dict[str, str], clean: Callable[[str], str], body: str = "body") -> DataFrame:
    """The texts of :func:`named_cells` for the rows that are no headers and have a text in any cell, named or not, with the
    row's key attribute and the link of its first cell."""

    def emit(page):
        for table in page.tables:
            places = None
            for row in table["rows"]:
                run = isinstance(row, _Run)
                cells = row.columns if run else row["cells"]
                if not cells:
                    continue
                size = len(cells)
                if places is None:  # the first row
                    found = [clean(cell[0] if run else cell) for cell in cells]
                    places = [found.index(name) if name in found else None for name in names]
                if run:
                    texts = [repeat(None) if place is None or place >= size else cells[place] for place in places]
                    found = zip(row.keys, row.links, *texts)
                    yield from found if all(cells[0]) else compress(found, map(any, zip(*cells)))
                elif not row["head"] and any(cells):
                    yield (row["key"], row["hrefs"][0], *[None if place is None or place >= size else cells[place] for place in places])

    return _mapped(raw, ids, body, {"row_key": "string", "link": "string", **dict.fromkeys(names.values(), "string")}, emit, runs=True)


def table_counts(raw: DataFrame, ids: Sequence[str], body: str = "body") -> DataFrame:
    """One row per document: how many tables it has."""
    return _mapped(raw, ids, body, {"n_tables": "int"}, lambda page: [(len(page.tables),)])


def list_items(raw: DataFrame, ids: Sequence[str], body: str = "body") -> DataFrame:
    """One row per list entry, with its first link."""
    fields = {"list_no": "int", "item_no": "int", "text": "string", "href": "string"}
    return _mapped(raw, ids, body, fields, lambda page: page.items)


def links(raw: DataFrame, ids: Sequence[str], body: str = "body") -> DataFrame:
    """One row per link, in document order."""
    fields = {"link_no": "int", "href": "string", "text": "string"}
    return _mapped(raw, ids, body, fields, lambda page: [(n, *link) for n, link in enumerate(page.links)])


def label_values(raw: DataFrame, ids: Sequence[str], body: str = "body", labels: Sequence[str] | None = None) -> DataFrame:
    """One row per element whose first two children are a label and a value; ``labels`` keeps those only."""
    fields = {"pos": "int", "label": "string", "value": "string"}
    wanted = None if labels is None else frozenset(labels)

    def emit(page):
        return [(n, *pair) for n, pair in enumerate(page.pairs) if wanted is None or pair[0] in wanted]

    return _mapped(raw, ids, body, fields, emit)


def titles(raw: DataFrame, ids: Sequence[str], body: str = "body") -> DataFrame:
    """The title and the first link of each document."""
    fields = {"title": "string", "first_href": "string", "first_text": "string"}
    return _mapped(raw, ids, body, fields, lambda page: [(page.title, *(page.links[0] if page.links else (None, None)))])


def titled_rows(raw: DataFrame, ids: Sequence[str], inside: str, skip: int, least: int, body: str = "body") -> DataFrame:
    """The plain cells of a table's rows, each with the title at its place.

    The table is the first one inside the element with the id ``inside``. Titles are its header cells in order without the
    first ``skip``; rows are those of ``least`` plain cells or more; both as far as the shorter list goes. A document without
    such a table gives one row whose number is null, so that it can be told from a table without rows.
    """

    def emit(page):
        table = next((t for t in page.tables if inside in t["inside"]), None)
        if table is None:
            return [(None, None, None)]
        titles = [title for row in table["rows"] for title in row["titles"]][skip:]
        plain = [row["plain"] for row in table["rows"] if len(row["plain"]) >= least]
        return [(number, *pair) for number, pair in enumerate(zip(titles, plain))]

    return _mapped(raw, ids, body, {"row_no": "int", "title": "string", "cells": "array<string>"}, emit)


def register_html_table(spark) -> None:
    """Table functions for SQL.

    ``html_tables(TABLE(SELECT id, html ...))`` gives the rows of all tables of all documents: Arrow batches go to Python, the
    rows stay on the tasks they are on, and every document is parsed once. ``html_table(html, n)`` gives the n-th table (from 0)
    of one document, for lateral joins.
    """
    from pyspark.sql.functions import arrow_udtf, udtf

    @arrow_udtf(returnType="id string, table_no int, row_no int, is_head boolean, cells array<string>, hrefs array<string>")
    class HtmlTables:
        def eval(self, batch: pa.RecordBatch):
            names = ("id", "table_no", "row_no", "is_head", "cells", "hrefs")
            kinds = ("string", "int", "int", "boolean", "array<string>", "array<string>")

            def table(rows):
                columns = zip(*rows) if rows else ((),) * len(names)
                return pa.table([pa.array(column, _ARROW[kind]) for column, kind in zip(columns, kinds)], names=list(names))

            rows = []
            for key, html in zip(batch.column(0).cast(pa.string()), batch.column(1)):
                key = key.as_py()
                for found in _Page(html.as_py()).tables:
                    kept = (row for row in found["rows"] if row["cells"])
                    for n, row in enumerate(kept):
                        rows.append((key, found["order"], n, row["head"], row["cells"], row["hrefs"]))
                        if len(rows) >= _FLUSH_ROWS:
                            yield table(rows)
                            rows = []
            yield table(rows)

    @udtf(returnType="row_no int, cells array<string>, hrefs array<string>")
    class HtmlTable:
        def eval(self, html: str, n: int):
            tables = _Page(html).tables
            if n is not None and 0 <= n < len(tables):
                rows = [row for row in tables[n]["rows"] if row["cells"]]
                for number, row in enumerate(rows):
                    yield number, row["cells"], row["hrefs"]

    spark.udtf.register("html_tables", HtmlTables)
    spark.udtf.register("html_table", HtmlTable)


ship_by_value(__name__)
