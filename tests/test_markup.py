"""The HTML reader on pages as they come: unclosed, odd, empty."""

from __future__ import annotations

from quotemill.operators.columns import clean_key_text
from quotemill.sources import markup
from quotemill.sources.markup import _Page


def test_unclosed_cells_and_bad_spans():
    page = _Page('<table><tr><th>A<th>B<tr data-rowkey="k"><td colspan="x"><a href="/u">L</a><td colspan=2>1<br>2</table>')
    rows = page.tables[0]["rows"]
    assert [r["cells"] for r in rows] == [["A", "B"], ["L", "1\n2", "1\n2"]]
    assert [r["head"] for r in rows] == [True, False]
    assert rows[1]["hrefs"] == ["/u", None, None] and rows[1]["key"] == "k"


def test_scripts_comments_and_quotes_are_no_text():
    page = _Page('<title>T &amp; x</title><script>var t="<table><tr><td>no</td></tr></table>";</script><!-- <a href="/no">no</a> --><a title="a > b" href=\'/yes\'>1 &lt; 2</a>')
    assert page.title == "T & x" and page.tables == [] and page.links == [("/yes", "1 < 2")]


def test_nested_tables_and_headings():
    page = _Page("<h3>One</h3><table><tr><td><table><tr><td>in</td></tr></table></td><td>out</td></tr></table>")
    assert [(t["order"], t["heading"]) for t in page.tables] == [(0, "One"), (1, "One")]
    assert page.tables[0]["rows"][0]["cells"] == ["", "out"] and page.tables[1]["rows"][0]["cells"] == ["in"]


def test_pairs_and_items():
    page = _Page(
        "<ul><li><span>Cap</span><span>1.2B</span></li><li><a href='/z'>q</a></ul><div><div>Listed:</div><div class=r>5,0</div></div>"
        "<table><tr><th>Rating</th><td>A</td></tr></table><p>one<p>two"
    )
    assert ("Cap", "1.2B") in page.pairs and ("Listed:", "5,0") in page.pairs and ("Rating", "A") in page.pairs
    assert page.items[1] == (0, 1, "q", "/z")


def test_odd_bodies_do_not_fail():
    for body in (None, "", "<", "a < b", "</td></table>", "<table><td>x", "<!-- open", "<script>open", '<a href="x', "<td>1</td>"):
        _Page(body)


def test_rows_through_spark(spark):
    raw = spark.createDataFrame(
        [(1, "<table><tr><td>a</td></tr><tr></tr><tr><td>b</td></tr></table>"), (2, None), (3, "no table")], "id int, body string"
    )
    found = markup.table_rows(raw, ["id"], header=True).orderBy("id", "row_no").collect()
    assert [(r.id, r.row_no, r.n_rows, r.cells, r.header) for r in found] == [(1, 0, 2, ["a"], ["a"]), (1, 1, 2, ["b"], ["a"])]


def test_many_rows_of_one_document_are_kept(spark):
    raw = spark.range(3).selectExpr("id", "concat('<table>', repeat('<tr><td>x</td></tr>', 30000), '</table>') AS body")
    assert markup.table_rows(raw, ["id"]).count() == 90000


def test_one_table_of_pages_with_enough(spark):
    raw = spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table><table><tr><td>b</td></tr></table>"), (2, "<table><tr><td>c</td></tr></table>")], "id int, body string")
    pick = lambda **how: [(r.id, r.cells) for r in markup.table_rows(raw, ["id"], **how).orderBy("id", "table_no").collect()]
    assert pick(only=1) == [(1, ["b"])] and pick(only=0, least=2) == [(1, ["a"])] and pick(least=2) == [(1, ["a"]), (1, ["b"])]


def test_wanted_labels_only(spark):
    raw = spark.createDataFrame([(1, "<li><i>Cap</i><i>1</i></li><li><span>A</span><span>1</span></li><li><span>B</span><span>2</span></li>")], "id int, body string")
    assert [(r.label, r.value) for r in markup.label_values(raw, ["id"], labels=["B"]).collect()] == [("B", "2")]


def test_titles_stand_at_their_rows(spark):
    page = (
        "<div id='a'><table><tr><th>x</th></tr></table></div><div id=\"tab\"><p><table><tr><th>H<th>D<th>S<tr><th>One<td>d1<td>s1<td>more"
        "<tr><td>a note<tr><th>Two<td>d2<td>s2<tr><td>d3<td>s3</table></div>"
    )
    df = spark.createDataFrame([("p", page), ("none", "<p>x</p>"), ("null", None), ("bare", "<table id=tab></table>")], "u string, body string")
    found = {}
    for u, n, title, cells in markup.titled_rows(df, ["u"], "tab", 3, 2).collect():
        found.setdefault(u, []).append((n, title, cells))
    assert found == {
        "p": [(0, "One", ["d1", "s1", "more"]), (1, "Two", ["d2", "s2"])],
        "none": [(None, None, None)],
        "null": [(None, None, None)],
    }


def test_sql_tables_of_many_documents(spark):
    markup.register_html_table(spark)
    pages = [("1", "<table><tr><td>a</td></tr></table><table><tr><td><a href='/l'>b</a></td><td></td></tr></table>"), ("2", None), ("3", "<td>no")]
    spark.createDataFrame(pages, "k string, h string").repartition(3).createOrReplaceTempView("qm_test_pages")
    rows = spark.sql("SELECT * FROM html_tables(TABLE(SELECT k, h FROM qm_test_pages))").collect()
    assert sorted(tuple(r) for r in rows) == [("1", 0, 0, False, ["a"], [None]), ("1", 1, 0, False, ["b", ""], ["/l", None])]
    none = spark.sql("SELECT * FROM html_tables(TABLE(SELECT k, h FROM qm_test_pages WHERE k = '9'))")
    assert none.collect() == []


class _Landed:
    """Stands for a frame: keeps the function that Spark would run on its batches."""

    dtypes = [("id", "bigint")]

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_waiting_rows_do_not_grow_with_the_document():
    import pyarrow as pa

    body = "<table>" + "<tr><td>x</td><td>y</td></tr>" * 20000 + "</table>"
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([body, body])], names=["id", "body"])
    run = markup.table_rows(_Landed(), ["id"], header=True)
    sizes = [out.num_rows for out in run(iter([batch]))]
    assert sum(sizes) == 40000 and max(sizes) <= 5000


def test_rows_of_plain_cells_are_read_in_runs(monkeypatch):
    opened = []
    start = _Page._start
    monkeypatch.setattr(_Page, "_start", lambda self, tag, attributes: (opened.append(tag), start(self, tag, attributes)) and None)
    page = _Page('<table><tbody>' + "<tr><td> a </td><td>1 &lt; 2</td></tr>" * 1000 + "<tr data-rowkey='k'><td>c</td><td>d</td></tr></table>")
    assert opened == ["table", "tbody", "tr"]
    rows = page.tables[0]["rows"]
    assert len(rows) == 1001 and rows[999] == {"cells": ["a", "1 < 2"], "hrefs": [None, None], "head": False, "key": None, "titles": [], "plain": ["a", "1 < 2"]}
    assert rows[1000]["cells"] == ["c", "d"] and rows[1000]["key"] == "k" and page.pairs[-1] == ("c", "d") and len(page.pairs) == 1001


def test_runs_at_odd_places_are_read_as_before():
    run = "<tr><td>a</td><td>b</td></tr>"
    assert _Page(run).tables == [] and _Page(run).pairs == [("a", "b")]
    nested = _Page(f"<table><tr><td>o{run}p</td></tr></table>")  # the rows end the cell and the row around them
    assert [row["cells"] for row in nested.tables[0]["rows"]] == [["o"], ["a", "b"]]
    stray = _Page("<table><tr><td>a</td></tr><td>b</td><td>c</td></table>")  # cells behind a row belong to it
    assert [row["cells"] for row in stray.tables[0]["rows"]] == [["a", "b", "c"]]
    assert [r["cells"] for r in _Page(f"<table><tr><th>h</th>{run}</table>").tables[0]["rows"]] == [["h"], ["a", "b"]]
    item = _Page("<table><tr><td><li><td>x</td></li></td></tr></table>")
    assert [row["cells"] for row in item.tables[0]["rows"]] == [["", "x"]]


LINKED = '<tr data-rowkey="E:1&amp;2"><td><a href="/u?a&amp;b"> T </a><sup>N &lt; m</sup></td><td> 1 </td><td>2 &gt; 1</td></tr>'


def test_rows_with_a_linked_first_cell_are_read_in_runs(monkeypatch):
    opened = []
    start = _Page._start
    monkeypatch.setattr(_Page, "_start", lambda self, tag, attributes: (opened.append(tag), start(self, tag, attributes)) and None)
    page = _Page("<div><table><tr><th> A </th><th>B &amp; C</th></tr>" + LINKED * 1000 + '<tr><td><a href="">x</a></td><td>y</td></tr></table></div>')
    assert opened == ["div", "table", "tr"]
    rows = page.tables[0]["rows"]
    assert rows[0] == {"cells": ["A", "B & C"], "hrefs": [None, None], "head": True, "key": None, "titles": ["A", "B & C"], "plain": []}
    cells = ["T \nN < m", "1", "2 > 1"]
    assert len(rows) == 1002 and rows[1000] == {"cells": cells, "hrefs": ["/u?a&b", None, None], "head": False, "key": "E:1&2", "titles": [], "plain": cells}
    assert rows[1001] == {"cells": ["x", "y"], "hrefs": ["", None], "head": False, "key": None, "titles": [], "plain": ["x", "y"]}
    assert page.links[:2] == [("/u?a&b", "T")] * 2 and page.links[-1] == ("", "x") and len(page.links) == 1001
    assert page.pairs[:2] == [("A", "B & C"), ("1", "2 > 1")] and page.pairs[-1] == ("x", "y") and len(page.pairs) == 1002


def test_linked_rows_at_odd_places_are_read_as_before():
    assert _Page(LINKED).tables == [] and _Page(LINKED).links == [("/u?a&b", "T")] and _Page(LINKED).pairs == [("1", "2 > 1")]
    nested = _Page(f"<table><tr><td>o{LINKED}p</td></tr></table>")  # the rows end the cell and the row around them
    assert [row["cells"] for row in nested.tables[0]["rows"]] == [["o"], ["T \nN < m", "1", "2 > 1"]] and nested.tables[0]["rows"][1]["key"] == "E:1&2"
    item = _Page(f"<ul><li><table>{LINKED}</table></li></ul>")  # the first link of the table is that of the entry
    assert [place[3] for place in item.items] == ["/u?a&b"]
    stray = _Page(f"<table>{LINKED}<th>b</th></table>")  # header cells behind a row belong to it
    assert stray.tables[0]["rows"][0]["cells"][3:] == ["b"] and not stray.tables[0]["rows"][0]["head"]
    odd = _Page("<table><tr><td data-rowkey=\"x\">1<th>a</th><th>b</th></tr></table>")
    assert odd.tables[0]["rows"][0]["cells"] == ["1", "a", "b"] and odd.tables[0]["rows"][0]["titles"] == ["a", "b"]


def test_keyed_cells(spark):
    head = "<tr><th>Symbol</th><th>Div*  %</th><th>Div</th></tr>"
    body = f"<table>{head}{LINKED}<tr data-rowkey='k'><td></td><td> </td><td></td></tr><tr><td>s</td></tr></table><table><tr><td>symbol</td></tr></table>"
    raw = spark.createDataFrame([(1, body), (2, None)], "id int, body string")
    clean = lambda name: clean_key_text(name, "")
    found = markup.keyed_cells(raw, ["id"], {"symbol": "_symbol", "div": "_div", "none": "_none"}, clean).collect()
    assert [tuple(r) for r in found] == [
        (1, "E:1&2", "/u?a&b", "T \nN < m", "1", None), (1, None, None, "s", None, None), (1, None, None, "symbol", None, None),
    ]


def test_keyed_cells_of_runs():
    import pyarrow as pa

    row = '<tr data-rowkey="<tr{0}"><td><a href="/{0}">T{0}</a></td><td> {0} &amp; </td>{1}</tr>'
    even = "".join(row.format(i, "<td></td>") for i in range(12000))
    uneven = "".join(row.format(i, "<td>x</td>" * (i % 2)) for i in range(5))
    blank = '<tr><td><a href="/b"> </a></td><td> </td><td></td></tr>'
    # A run in a run's cell, whose first link is the outer cell's; the last row of a run takes the cell behind it.
    inner = f"<tr><td>i<table>{uneven}</table></td><td>o</td></tr>"
    body = f"<table><tr><th>A</th><th>B</th><th>C</th></tr>{even}{blank * 3}</table><table>{uneven}<td>y</td></table><table>{inner}</table>"
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([body])], names=["id", "body"])
    names = {"a": "a", "b": "b", "c": "c", "t0": "t"}
    out = list(markup.keyed_cells(_Landed(), ["id"], names, str.lower)(iter([batch])))
    assert max(part.num_rows for part in out) <= 5000
    found = [tuple(r.values())[1:] for part in out for r in part.to_pylist()]
    assert found[:12000] == [(f"<tr{i}", f"/{i}", f"T{i}", f"{i} &", "", None) for i in range(12000)]  # three blank rows are left out
    assert found[12000:12005] == [(f"<tr{i}", f"/{i}", None, None, None, f"T{i}") for i in range(5)]
    assert found[12005] == (None, "/0", None, None, None, None) and found[12006:] == found[12000:12005]


def test_cells_by_name(spark):
    body = "<table><tr><td> B </td><td>A</td><td>B</td></tr><tr><td>1</td><td>2</td><td>3</td></tr><tr><td>4</td></tr></table>"
    raw = spark.createDataFrame([(1, body), (2, None), (3, "<table><tr><th>X</th></tr></table>")], "id int, body string")
    found = markup.named_cells(raw, ["id"], {"b": "one", "a": "two", "c": "none"}, str.lower).orderBy("id", "row_no").collect()
    assert [(r.id, r.row_no, r.n_rows, r.is_head, r.one, r.two, r.none) for r in found] == [
        (1, 0, 3, False, "B", "A", None), (1, 1, 3, False, "1", "2", None), (1, 2, 3, False, "4", None, None), (3, 0, 1, True, None, None, None),
    ]
