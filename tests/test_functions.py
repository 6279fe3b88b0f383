"""Column functions on hand-written inputs."""

import html

import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as X


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("body", ["a & b < c > \"d\" 'e'", "x\t\n\xa0 ", "", "&amp;", "tail  \x85", "line\r\n\r\n"])
def test_wrapped_page_equals_its_definition(spark, body):
    row = spark.createDataFrame([("T & <t>", body, "<p>n</p>\n")], "t string, b string, f string")
    got = row.select(X.wrap_page(F.col("t"), F.col("b"), F.col("f")).alias("r")).first()["r"]
    t = html.escape("T & <t>")
    assert got == f'<!DOCTYPE html>\n<html>\n<head>\n<meta charset="utf-8">\n<title>Text rendering of {t}</title>\n</head>\n<body>\n<p>n</p>\n<h1>{t}</h1>\n<pre>\n{html.escape(body).rstrip()}\n</pre>\n</body>\n</html>\n'


def test_nulls_wrap_as_empty(spark):
    row = spark.createDataFrame([(None, None, None)], "t string, b string, f string")
    assert "<h1></h1>\n<pre>\n\n</pre>" in row.select(X.wrap_page(F.col("t"), F.col("b"), F.col("f")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("1.0 and later", ("1.0", None, True, "parsed")),
        ("Version 2.0 and later", ("2.0", None, True, "parsed")),
        ("Release 2.10 or newer", ("2.10", None, True, "parsed")),
        ("3.1+", ("3.1", None, True, "parsed")),
        ("1.0 and 1.01", ("1.0", "1.01", False, "parsed")),
        ("1.0 only", ("1.0", "1.0", False, "parsed")),
        ("only 4.2", ("4.2", "4.2", False, "parsed")),
        ("1.0 to 2.0", ("1.0", "2.0", False, "parsed")),
        ("Kanji build 1.0 or newer", ("1.0", None, True, "partial")),
        ("222.0 or newer", ("222.0", None, True, "partial")),
        ("all but 5.0?", (None, None, False, "unparsed")),
        ("see the pack notes", (None, None, False, "unparsed")),
        ("", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_versions(spark, raw, want):
    assert tuple(one(spark, raw, X.parse_version)) == want


@pytest.mark.parametrize(("raw", "want"), [("0xFFFFFFFFFFFFFFFF", 2**64 - 1), ("-1", -1), ("(43549)", 43549), ("0x9088L", 0x9088), ("A | B", None), ("", None), (None, None), ("12u", 12), ("0xG", None)])
def test_numbers(spark, raw, want):
    got = one(spark, raw, X.numeric_literal)
    assert (None if got is None else int(got)) == want


def test_html(spark):
    page = '<HTML><TITLE>A\n b</title><script>var s = "</p>";</script><body>x<h1>H</h1><TABLE><tr><td><b>Header file:</b></td><td>a.h</td></tr><tr><td>Platforms</td><td></td></tr></table><a class=k HREF="x.htm">l</a> &lt;&amp;lt;</body>'
    assert one(spark, page, X.title_of) == "A b"
    assert one(spark, page, X.article_of).startswith("<h1>H</h1>")
    assert one(spark, "none", X.article_of) == ""
    assert [tuple(r) for r in one(spark, page, X.requirement_rows)] == [("header file", "a.h"), ("platforms", "")]
    assert one(spark, page, X.link_targets) == ["x.htm"]
    assert one(spark, page, X.strip_tags).endswith("l <&lt;")
    assert "var s" not in one(spark, page, X.strip_tags)
    assert one(spark, '<PARAM NAME="Item2" VALUE="a.chm.3a3a.b.htm">', X.keyword_links) == ["a.chm::b.htm"]


def test_small_parsers(spark):
    assert tuple(one(spark, "**PairW** (Unicode) and **Pair\\_A** (ANSI)", X.unicode_ansi_pair)) == ("PairW", "Pair_A")
    assert one(spark, "nothing", X.unicode_ansi_pair) is None
    assert one(spark, "NAME, *PNAME,", X.alias_names) == ["NAME", "PNAME"]
    assert tuple(one(spark, "UID: nf:lib.Open.x", X.uid_parts)) == ("NF", "lib", "Open.x")
    assert tuple(one(spark, "Main.h (include Whole.h)", X.header_parts)) == ("main.h", "whole.h")
    assert one(spark, "A.dll (version 4.71 or later); b.lib", X.library_names) == ["a.dll", "b.lib"]
    assert one(spark, "37,941,879", X.grouped_int) == 37941879
    assert one(spark, "Header File : ", X.normal_label) == "header file"
    assert tuple(one(spark, "public const uint X_Y = 0x10; // c", X.constant_line)) == ("X_Y", "0x10")
    assert one(spark, "int f();", X.constant_line) is None
    assert tuple(one(spark, '[DllImport("Core.dll", EntryPoint="Open")]', X.import_line)) == ("core.dll", "Open")
    assert tuple(one(spark, "#define A_B (1 << 2) /* c */", X.define_line)) == ("A_B", "(1 << 2)")
    assert one(spark, "  Open @12 ; note", X.export_line) == "Open"
    assert one(spark, "EXPORTS", X.export_line) is None
    assert [tuple(r) for r in one(spark, "| **Header** | a\\_b.h |\n|---|---|\n| **DLL** | |", X.markdown_rows)] == [("header", "a_b.h"), ("dll", "")]
    assert one(spark, "20021105023640", X.compact_time).year == 2002
    assert one(spark, "2002", X.compact_time) is None


def test_front_matter(spark):
    text = "---\r\nUID: NF:a.B\r\ntitle: 'B: x'\r\nempty:\r\nreq.lib: [a.lib, b.lib]\r\nnames:\r\n - One\r\n - Two, three\r\n---\r\n# Body\r\n"
    got = one(spark, text, X.front_matter)
    assert got["front"] == {"UID": "NF:a.B", "title": "B: x", "empty": ""}
    assert got["lists"] == {"req.lib": ["a.lib", "b.lib"], "names": ["One", "Two, three"]}
    assert got["body"] == "# Body\n"
    plain = one(spark, "no block", X.front_matter)
    assert (plain["front"], plain["lists"], plain["body"]) == ({}, {}, "no block")


def test_zip_header(spark):
    assert one(spark, '[["urlkey","digest"],["k","d"]]', X.zip_header) == [{"urlkey": "k", "digest": "d"}]
    assert one(spark, "[]", X.zip_header) == []


def test_version_rank(spark):
    order = ["1.0", "1.01", "2.0", "2.1", "2.10", "2.11"]
    assert [one(spark, v, lambda c: X.version_rank(c, order)) for v in ("2.1", " 2.10", "9.9", None)] == [3, 4, None, None]


def test_mentions(spark):
    df = spark.createDataFrame([("A Pocket Kit", None), ("other", "POCKET kit"), (None, "x")], "title string, product string")
    got = df.select(X.mentions([F.col("title"), F.col("product")], ["pocket kit"]).alias("r")).collect()
    assert [r["r"] for r in got] == [True, True, False]
    assert not df.select(X.mentions([F.col("title")], []).alias("r")).first()["r"]


def test_western_bytes(spark):
    data = bytes(b for b in range(256) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    assert one(spark, bytearray(data), X.decode_western, "binary") == data.decode("cp1252")
