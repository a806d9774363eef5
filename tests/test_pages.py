"""Charset detection, the page tree and selectors."""

import pytest

from quantloom.functions.pages import CONTAINERS, Selector, charset, decode, main_text, page_text, tree

LONG = "Ein langer Absatz über Bäume. " * 6


@pytest.mark.parametrize(
    "data,name",
    [
        ("é".encode(), "utf-8"),
        (b"", "utf-8"),
        ("é".encode("utf-8-sig"), "utf-8"),
        ("é".encode("utf-16"), "utf-16"),
        ("é".encode("utf-32"), "utf-32"),
        (b'<meta charset=ISO-8859-1>\xe9', "iso8859-1"),
        (b"<META http-equiv='Content-Type' content='text/html; charset=windows-1252'>\x80", "cp1252"),
        (b'<meta charset="utf-8">\xd6\xd0\xb9\xfa', "gb18030"),  # does not keep to what it declares
        (b'<meta charset="no-such">\xc3\xa9', "utf-8"),
        ("中国".encode("gb18030"), "gb18030"),
        (b"caf\xe9 \xff\xff", "latin-1"),
        (b" " * 2000 + b"<meta charset=iso-8859-1>\xc3\xa9", "utf-8"),  # declared too late
    ],
)
def test_charset(data, name):
    assert charset(data) == name


def test_marks_go():
    assert decode("é".encode("utf-8-sig"))[0] == "é" and decode("é".encode("utf-16"))[0] == "é"


HTML = """<html><head><title>T</title></head><body class="a b"><div id=content class='x main-text'><ul><li>one<li>two<b>bold</ul>
<p>p1<p>p2 <br/>tail &amp; &eacute;<table><tr><td class=story>cell<td>next</table></div><div role="main"><span data-x=it's>in</span></div></body></html>"""


@pytest.mark.parametrize(
    "selector,text",
    [
        ("li", "one"),
        ("#content b", "bold"),
        (".x.main-text p", "p1"),
        ("body div table td.story", "cell"),
        ("[role=main]", "in"),
        ("div[role='main'] span[data-x]", "in"),
        ("p li", None),
        ("ul", "one\ntwo\nbold"),
        (".main", None),
        ("DIV#content.x LI", "one"),
    ],
)
def test_selectors(selector, text):
    found = Selector(selector).first(tree(HTML))
    assert (found and found.text()) == text


def test_bad_selectors_are_errors():
    for bad in ("", "a > b", "p:first", "a,b"):
        with pytest.raises(ValueError):
            Selector(bad)


def test_ladder_takes_the_first_with_enough_text():
    ladder = [Selector(s) for s in CONTAINERS]
    page = f"<body><nav>menu</nav><article>short</article><main>{LONG}<script>no</script></main><div class=content>{LONG}</div></body>"
    assert main_text(page, ladder) == (LONG.strip(), "main")
    assert main_text("<body><nav>menu</nav><article>short</article> rest<footer>f</footer></body>", ladder) == ("short\nrest", None)
    assert main_text("no tags at all", ladder) == ("no tags at all", None)
    deep = "<div>" * 50_000 + LONG
    assert main_text(deep, ladder)[0] == LONG.strip()


def test_column_over_bytes(spark):
    page = f"<meta charset=iso-8859-1><article>{LONG}</article>"
    rows = [(1, page.encode("latin-1")), (2, None), (3, b""), (4, page.encode("utf-16"))]
    got = {r.i: r.x for r in spark.createDataFrame(rows, "i int, b binary").select("i", page_text("b").alias("x")).collect()}
    assert (got[1].text, got[1].selector, got[1].charset) == (LONG.strip(), "article", "iso8859-1")
    assert got[2].text is None and got[3].text == "" and got[4].text == LONG.strip()


def test_open_references():
    html = "<body><p>a &amp b &amp; &copy &#65 &#65; &ltx \ue000</p><xmp>&lt</xmp></body>"
    assert main_text(html, [], 0)[0].split("\n")[0] == "a & b & © A A <x \ue000"
    assert main_text(html, [], 0, open_references=False)[0] == "a &amp b & &copy &#65 A &ltx \ue000\n&lt"


def test_selected_text_of_cut_references(spark, tmp_path):
    """Headings cut within a reference, as some pages have them, against the twin."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from quantloom import plans

    heads = ["x&amp", "y&am", "z&lt", "&amp;amp", "&quot", "&", "a &amp; b", "&#39"]
    pages = [(i, f"<html><body><h1>{h}</h1><article><h2>{h}</h2><p>{"A long paragraph. " * 8}</p></article></body></html>") for i, h in enumerate(heads)]
    pq.write_table(pa.table({"page_id": [p[0] for p in pages], "html": [p[1] for p in pages]}), f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    want = sorted(con.sql(plans.oracles()["t18_selected_text"]).fetchall())
    assert sorted(tuple(r) for r in plans.queries()["t18_selected_text"](spark, str(tmp_path)).collect()) == want
