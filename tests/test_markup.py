import time

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.functions import markup as m
from leafmill.functions.sql import register_page_blocks


def split(body, keep=("id", "href"), base="http://h/a/b", links=False):
    nodes = m.PageNodes(frozenset(keep), links)
    nodes.page(body, base)
    return nodes.array().to_pylist()[0]


def shape(body, **kw):
    """Nested lists of what a page splits into."""
    nodes = split(body, **kw)

    def build(i):
        n = nodes[i]
        if n["tag"] == m.TEXT:
            return n["text"]
        inner = [build(j) for j in range(i + 1, i + 1 + n["size"]) if nodes[j]["parent"] == i]
        return [n["tag"], *inner]

    return [build(i) for i, n in enumerate(nodes) if n["parent"] == -1]


def test_nesting_and_text_runs():
    assert shape("<div>a<b>c</b>d</div>") == [["div", "a", ["b", "c"], "d"]]


def test_comment_splits_text():
    assert shape("<p>a<!-- <i>x</i> -->b</p>") == [["p", "a", "b"]]


def test_void_and_self_closed_elements():
    assert shape('<p>a<br>b<meta x="1" /   >c<img src=x></p>') == [["p", "a", ["br"], "b", ["meta"], "c", ["img"]]]


def test_unclosed_paragraphs_and_items():
    assert shape("<div><p>a<p>b<ul><li>1<li>2</ul></div>c") == [
        ["div", ["p", "a"], ["p", "b"], ["ul", ["li", "1"], ["li", "2"]]],
        "c",
    ]


def test_table_cells_close_each_other():
    assert shape("<table><tr><td>1<td>2<tr><td>3</table>") == [
        ["table", ["tr", ["td", "1"], ["td", "2"]], ["tr", ["td", "3"]]]
    ]


def test_inline_end_tag_does_not_close_blocks():
    assert shape("<span><div>a</span>b</div>") == [["span", ["div", "a", "b"]]]


def test_stray_end_tag_is_ignored():
    assert shape("<div>a</i>b</div>") == [["div", "a", "b"]]


def test_block_end_closes_inline():
    assert shape("<div><b>x</div>y") == [["div", ["b", "x"]], "y"]


def test_script_and_style_are_text():
    assert shape('<script>var t="</p><b>";</script><style>p{}</style>') == [
        ["script", 'var t="</p><b>";'],
        ["style", "p{}"],
    ]


def test_unfinished_pieces():
    assert shape("<div>a < b <i>c") == [["div", "a < b ", ["i", "c"]]]
    assert shape("<script>x") == [["script", "x"]]
    assert shape("a<!-- open") == ["a"]
    assert shape("") == []


def test_attributes():
    node = split("""<A HREF='x?a=1&amp;b=2' id=q7 class="  one\n two " title="a>b" id=other data-x>t</a>""")[0]
    assert node["tag"] == "a"
    assert node["class"] == " one two "
    assert dict(node["attrs"]) == {"href": "x?a=1&b=2", "id": "q7"}


def test_entities():
    assert shape("<p>a&nbsp;&laquo;b&raquo; &#8470;&amp;lt;</p>") == [["p", "a\xa0«b» №&lt;"]]


def test_links():
    body = (
        '<base href="/root/x/"><a href="y">1</a><a href="/für?q=ü&amp;z=%41">2</a><a href="//o.org/p">3</a>'
        '<a href="mailto:x@y">4</a><a href="javascript:void(0)">5</a><area href=" ../u "><link href="/s.css"><a>6</a>'
    )
    assert [n["link"] for n in split(body, links=True) if n["tag"] in ("a", "area", "link")] == [
        "http://h/root/x/y",
        "http://h/f%C3%BCr?q=%C3%BC&z=%41",
        "http://o.org/p",
        None,
        None,
        "http://h/root/u",
        None,
        None,
    ]


def test_deep_pages_do_not_recurse():
    nodes = split("<div>" * 5000 + "x")
    assert nodes[0]["size"] == 5000 and nodes[-1]["text"] == "x"


@pytest.mark.parametrize(
    "body", ["<!" * 60000, "<a " * 60000, '<a x="' * 30000, "<a x='", "<" * 60000, "<!--" * 30000, "</a" * 50000, "<script " * 20000]
)
def test_broken_markup_is_split_in_linear_time(body):
    start = time.perf_counter()
    split(body)
    split("<p>" + body)
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("wall", ["", "<b><table>"])
def test_stray_end_tags_cost_no_search(wall):
    spent = []
    for n in (4000, 32000):
        start = time.perf_counter()
        nodes = split(wall + "<i>" * n + "</b>" * n)
        spent.append(time.perf_counter() - start)
        assert len(nodes) == n + 2 * bool(wall)
    assert spent[1] < 40 * max(spent[0], 0.01)


def test_many_ancestors_cost_one_pass(spark):
    spent = []
    for n in (200, 3200):
        body = "".join(f"<div class='x'><div class='x'><small>{i}</small></div></div>" for i in range(n))
        page = spark.createDataFrame([("u", body)], "url string, body string").select(m.page_nodes(F.col("body"), F.col("url")).alias("n"))
        found = page.select(F.size(m.pick(F.col("n"), m.element("div", ["x"]), m.element("small"))).alias("k"))
        found.first()
        start = time.perf_counter()
        assert found.first()["k"] == n
        spent.append(time.perf_counter() - start)
    assert spent[1] < 10 * max(spent[0], 0.2)


def test_the_first_readable_base_counts():
    links = [n["link"] for n in split('<base href="http://[bad"><a href="x"></a><base href="http://o.org/"><a href="y"></a>', base="http://h/d/", links=True) if n["tag"] == "a"]
    assert links == ["http://h/d/x", "http://h/d/y"]


PIECES = st.sampled_from(
    ["<p>", "</p>", "<div class='a b'>", "</div>", "<li>", "<ul>", "</ul>", "<b>", "</b>", "<br>", "<!-- x -->", "<td>", "<tr>",
     "<table>", "</table>", "<script>", "</script>", "<a href=x>", "</a>", "&amp;", "text ", "<", ">", '"', "<!", "\xa0"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=30))
def test_any_soup_gives_a_tree_in_document_order(pieces):
    nodes = split("".join(pieces))
    for i, n in enumerate(nodes):
        assert n["idx"] == i and n["parent"] < i and i + n["size"] < len(nodes) + (n["size"] == 0)
        up = n["parent"]
        if up >= 0:
            assert i + n["size"] <= up + nodes[up]["size"]
        inner = [j for j in range(len(nodes)) if nodes[j]["parent"] == i]
        assert n["size"] == sum(nodes[j]["size"] + 1 for j in inner)


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(blacklist_characters="<>&", blacklist_categories=["Cs"]), min_size=1))
def test_plain_text_is_one_run(text):
    assert [n["text"] for n in split(text)] == [text]


def test_column_helpers(spark):
    body = '<div class="k"><p>a<b>b</b></p></div><p>c</p><div class="k">d<!-- -->e</div>'
    page = spark.createDataFrame([("u", body)], "url string, body string")
    n = F.col("n")
    blocks = m.pick(n, m.element("div", ["k"]))
    row = page.select(m.page_nodes(F.col("body"), F.col("url")).alias("n")).select(
        m.own_texts(n, m.pick(n, m.element("div", ["k"]), m.element("p"))).alias("below"),
        m.deep_texts(n, blocks).alias("deep"),
        m.own_texts(n, blocks).alias("own"),
        m.joined(m.texts(n)).alias("all"),
        F.transform(blocks, lambda b: F.size(m.subtree(n, b))).alias("sizes"),
        m.let(F.size(n), lambda s: s + s).alias("twice"),
    )
    got = row.first().asDict()
    assert got == {
        "below": ["a"],
        "deep": ["a", "b", "d", "e"],
        "own": ["d", "e"],
        "all": "a b c d e",
        "sizes": [5, 3],
        "twice": 20,
    }


def test_blocks_of_a_page_in_sql(spark):
    register_page_blocks(spark, "test_blocks", ["id"], links=True)
    pages = [(1, "<div class='a b' id=x>one<div class=a>two</div></div><a class=a href=/y>l</a>"), (2, "<p>none"), (3, None)]
    spark.createDataFrame(pages, "n int, body string").createOrReplaceTempView("test_block_pages")
    sql = "SELECT n, pos, nodes[0].attrs['id'] AS id, nodes[0].link AS link, size(nodes) AS size FROM test_block_pages, LATERAL posexplode(test_blocks(body, 'http://h/', {tag}, 'a')) AS b(pos, nodes)"
    rows = lambda tag: sorted((tuple(r) for r in spark.sql(sql.format(tag=tag)).collect()), key=lambda r: r[:2])
    assert rows("'div'") == [(1, 0, "x", None, 4), (1, 1, None, None, 2)]
    assert rows("NULL") == [(1, 0, "x", None, 4), (1, 1, None, None, 2), (1, 2, None, "http://h/y", 2)]
    assert rows("'table'") == []
    plan = spark.sql(sql.format(tag="'div'"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Join" not in plan


def test_pages_are_split_in_slices(spark, monkeypatch):
    """However large the Arrow batches are, a slice holds few pages and bytes; nodes stay beside their pages."""
    bodies = ["<p>a</p>", None, "<p>" + "b" * 30 + "</p>", "", "<i>c</i>", "<i>d</i>"]
    batch = (pa.array(bodies, pa.string()), pa.array([f"u{i}" for i in range(6)]))
    monkeypatch.setattr(m, "SLICE_BYTES", 20)
    monkeypatch.setattr(m, "SLICE_PAGES", 2)
    cut = [tuple(column.to_pylist() for column in part) for part in m.slices([batch, tuple(c.slice(0, 0) for c in batch)])]
    assert [len(urls) for _, urls in cut] == [2, 1, 2, 1, 0]
    assert [b for part, _ in cut for b in part] == bodies and [u for _, urls in cut for u in urls] == batch[1].to_pylist()
    monkeypatch.undo()
    pages = spark.range(0, 2500, 1, 1).select(F.concat(F.lit("u"), "id").alias("url"), F.concat(F.lit("<p>"), "id", F.lit("</p>")).alias("body"))
    seen = pages.select("url", m.page_nodes(F.col("body"), F.col("url")).alias("n")).select("url", F.get(m.texts(F.col("n")), F.lit(0)).alias("t"))
    assert seen.count() == 2500 and seen.filter(F.col("url") != F.concat(F.lit("u"), "t")).count() == 0


PIECES = """< </ <div> </div> <p> </p> <b> </b> text < > = " ' / <script> </script> <SCRIPT <style> </style x> <!-- --> <!doctype <?x> <br/> <li>
<li/x> </li> <ul> </ul> <td> <table> </table> <a\thref="/u/v"> <a\thref=x/> <a\thref='/w'id=3> <p\tid="a>b"> <p\tid="1"class=x> <p\tid=> <p\tid\t=\t2> <p="2">
<base\thref="/r/"> <area\thref=/k> <x"y> <a:b\tc> </p\tid="> <p\tclass='u\tv'\t/> &amp; é""".split(" ") + [" ", "\n", "\x1c", "\xa0"]


@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_tags_read_from_their_spelling_split_like_any_other(body):
    whole = split(body, ("id", "href", "class"), links=True)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(m.PageNodes, "plain", lambda self, written: None)
        assert split(body, ("id", "href", "class"), links=True) == whole


def test_a_tag_is_read_once():
    nodes = m.PageNodes(frozenset(["id"]), False)
    for _ in range(3):
        nodes.page('<p id=1>a</p><p id=1>b</p><p id="2">c</p>', "")
    assert nodes.tags == [m.TEXT, "p", "p"]
    assert [[dict(n["attrs"]) for n in page if n["tag"] == "p"] for page in nodes.array().to_pylist()] == [[{"id": "1"}] * 2 + [{"id": "2"}]] * 3


def test_only_some_elements_and_the_links_are_left():
    nodes = m.PageNodes(frozenset(), True)
    for _ in range(2):
        nodes.page('<i>t</i><div class="x y"><b><a href="/u">1</a></b><div class=xy><a href="/v">2</a><a>3</a></div></div><a href="/w">', "http://h/")
    nodes.page("", "http://h/")
    page = [("div", 0, -1, 2, None), ("a", 1, -1, 0, "http://h/u"), ("a", 2, -1, 0, "http://h/v"), ("a", 3, -1, 0, "http://h/w")]
    left = nodes.array([("div", "x")]).to_pylist()
    assert [[(n["tag"], n["idx"], n["parent"], n["size"], n["link"]) for n in p] for p in left] == [page, page, []]
    inside = nodes.array([("div", "")]).to_pylist()[0]
    assert [(n["tag"], n["parent"], n["size"]) for n in inside] == [("div", -1, 3), ("a", -1, 0), ("div", 0, 1), ("a", 2, 0), ("a", -1, 0)]
    assert [len(p) for p in nodes.array([]).to_pylist()] == [3, 3, 0]


@pytest.mark.parametrize("base", ["http://h/a/b", "https://h.org?x", "", "file:///a", "http://[::1/x", "HTTP://h/x"])
def test_links_taken_as_they_stand_are_what_joining_gives(base, monkeypatch):
    hrefs = ["/a/b/", "/a/../b", "/a//b", "//o/p", "/.x/y", "/a/x.y", "http://o.org", "https://o.org/a/../b", "http://o.org/#", "/a?b", "/", "x", "HTTP://o/x"]
    found = [m.absolute_link(base, h) for h in hrefs]
    monkeypatch.setattr(m, "_ORIGIN", m.re.compile(r"(?!)"))
    assert [m.absolute_link(base, h) for h in hrefs] == found


def test_marks_say_what_elements_meet():
    marks = (
        m.Mark("div", ("a",)), m.Mark(classes=("a", "b")), m.Mark("meta", attr="property", value="x&y"), m.Mark(attr="data-n"), m.Mark("p"),
        m.Mark("a", ("k",), "href", "/q"),
    )
    body = (
        '<div class=" b\ta "><DIV class=ab>t</DIV><p Class="a b">u</p></div><meta property="x&amp;y" property=z><link property="x&amp;y">'
        "<i data-m=2></i><i data-n='1'>v</i><a class='j k' href=/q></a><a class=k href=/r></a><a href=/q></a>"
    )
    marked, plain = m.PageNodes(frozenset(["href"]), False, marks), m.PageNodes(frozenset(["href", "property", "data-n"]), False)
    for nodes in (marked, plain):
        nodes.page(body, "http://h/")
    found, all_said = marked.array().to_pylist()[0], plain.array().to_pylist()[0]

    def meets(mark, n):
        said = dict(n["attrs"])
        fits = n["tag"] != m.TEXT and mark.tag in (None, n["tag"]) and all(f" {c} " in (n["class"] or "") for c in mark.classes)
        return fits and (mark.attr is None or mark.attr in said and mark.value in (None, said[mark.attr]))

    assert [n["marks"] for n in found] == [sum(meets(mark, n) << i for i, mark in enumerate(marks)) for n in all_said]
    assert [n["marks"] for n in found if n["text"] is None] == [3, 0, 18, 4, 0, 0, 8, 32, 0, 0]
    same = ("idx", "parent", "size", "text")
    assert [[n[k] for k in same] for n in found] == [[n[k] for k in same] for n in all_said]
    # Neither tags and classes nor attributes that only marks ask for leave the worker.
    assert set(found[0]) == {*same, "marks", "attrs"} and {k for n in found for k, _ in n["attrs"]} == {"href"}
