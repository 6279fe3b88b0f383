"""Readers and sinks over hand-written files."""

import pytest
from pyspark.sql import functions as F

from leafmill.sources import readers, sinks


def put(folder, files):
    for name, data in files.items():
        p = folder / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def test_pages_and_rejects(spark, tmp_path):
    d = put(tmp_path, {"set/A.HTM": "<title>A</TITLE><h1>A</h1>", "set/sub/b.htm": "<title>Topic Not Found</title>x", "c.html": " \n", "none.html": "", "x.gif": "no", "notopic1.htm": "<title>n</title>", "w.htm": "<title>w</title>has not been archived"})
    pages = readers.html_pages(spark, d)
    assert pages.count() == 5
    kept, refused = readers.good_pages(pages, "path", "page_title", "value", ("has not been archived",))
    assert [r["file_name"] for r in kept.collect()] == ["a.htm"]
    assert {r["file_name"]: r["reason"] for r in refused.collect()} == {"b.htm": "placeholder", "c.html": "empty", "notopic1.htm": "placeholder", "w.htm": "interstitial"}


def test_markdown_articles_receipts(spark, tmp_path):
    d = put(tmp_path / "m", {"a.md": "---\nUID: NF:x.Y\n---\nbody"})
    assert readers.markdown_pages(spark, d).first()["front"] == {"UID": "NF:x.Y"}
    d = put(tmp_path / "t", {"Q1.TXT": "Title caf\xe9\r\nmore <x>\r\n".encode("cp1252")})
    row = readers.articles(spark, d).first()
    assert (row["file_name"], row["title"], row["html"]) == ("q1.txt", "Title café", '<pre class="kb">Title café\nmore &lt;x&gt;\n</pre>')
    d = put(tmp_path / "r", {"INDEX.md": "# p\n\n- url: http://x/\n- status: 200\n- bytes: 1,234\n\n## links\n\n- /a\n- /a\n"})
    row = readers.receipts(spark, d).first()
    assert row["fields"] == {"url": "http://x/", "status": "200", "bytes": "1,234"}
    assert row["links"] == ["/a", "/a"]


def test_indexes_lists_lines(spark, tmp_path):
    d = put(tmp_path / "c", {"cdx": '[["urlkey","digest"],["k","A"],["k","B"]]', "none": "[]"})
    assert [r["capture"]["digest"] for r in readers.capture_index(spark, d + "/cdx").collect()] == ["A", "B"]
    assert readers.capture_index(spark, d + "/none").count() == 0
    d = put(tmp_path / "v", {"a": '{"url":"u","archived_snapshots":{}}'})
    assert readers.availability(spark, d).first()["archived_snapshots"] == {}
    d = put(tmp_path / "s", {"x/a.cs": "l1\nconst uint A = 1;\n"})
    assert [(r["line_no"], r["line"]) for r in readers.source_lines(spark, d).orderBy("line_no").collect()] == [(1, "l1"), (2, "const uint A = 1;"), (3, "")]
    d = put(tmp_path / "q", {"u.txt": "# c\nhttp://a\n\nhttp://b\n", "rev.tsv": "s\tk\th\tv\te\tr\nname\tA\ta.h\tapprove\tp\t\n# note\n"})
    assert sorted(r["url"] for r in readers.url_list(spark, d + "/u.txt").collect()) == ["http://a", "http://b"]
    assert readers.review_table(spark, d + "/rev.tsv").first()["header_file"] == "a.h"
    d = put(tmp_path / "j", {"a.jsonl": '{"name":"A","line":3}\n'})
    assert tuple(readers.json_lines(spark, d, "name string, line int").first()) == ("A", 3)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1234)], "k string, n long")
    base = str(tmp_path / "kb")
    sinks.write_table(df, base, "t")
    sinks.write_table(df, base, "t")
    readers.knowledge_base(spark, base, ["t"])
    assert spark.sql("SELECT sum(n) AS s FROM t").first()["s"] == 1236
    for form in ("csv", "tsv", "json", "parquet"):
        sinks.export(df, str(tmp_path / form), form)
    sinks.report(df, str(tmp_path / "rep"), ["k"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "rep").glob("part*")))
    assert [x for x in text.split("\n") if x and x != "k\tn"] == ["a\t1234", "b\t2"]
    assert [r["line"] for r in sinks.summary_lines(df.agg(F.sum("n").alias("all_rows"))).collect()] == ["- all rows: 1,236"]
    sinks.append_log(df, str(tmp_path / "log"), "k")
    sinks.append_log(df, str(tmp_path / "log"), "k")
    assert spark.read.text(str(tmp_path / "log")).count() == 4
    pages = spark.createDataFrame([("out/a.html", "<p>"), ("b.html", "<q>")], "p string, h string")
    sinks.write_pages(pages, str(tmp_path / "pages"), "p", "h")
    assert len(list((tmp_path / "pages").rglob("part*.txt"))) == 2
    names = spark.createDataFrame([("a.h", "Z", "ce"), ("a.h", "B", None), ("a.h", "N", "OSS ")], "h string, n string, l string")
    sinks.name_lists(names, str(tmp_path / "inc"), "h", "n", "l", "oss")
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "inc")).collect()) == ["a.h\tB", "a.h\tZ"]


def test_manifest(spark, tmp_path):
    d = put(tmp_path / "in", {"a": "1", "b": "2"})
    old = sinks.manifest(spark, d)
    old.write.parquet(str(tmp_path / "old"))
    put(tmp_path / "in", {"b": "3", "c": "4"})
    got = sinks.stale(spark.read.parquet(str(tmp_path / "old")), sinks.manifest(spark, d)).collect()
    assert sorted((r["path"][-1], r["change"]) for r in got) == [("b", "changed"), ("c", "added")]


def test_streams(spark, tmp_path):
    from leafmill.streaming import ingest

    d = put(tmp_path / "w", {"a.htm": "<title>A</title><h1>x</h1>"})
    q = ingest.page_stream(spark, d).writeStream.format("memory").queryName("pages_seen").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("pages_seen").first()["title"] == "A"


def test_pages_with_odd_names_stay_apart(spark, tmp_path):
    df = spark.createDataFrame([("a b.html", "one"), ("a_b.html", "two"), ("x/ü&=%.html", "three")], "p string, h string")
    sinks.write_pages(df, str(tmp_path / "w"), "p", "h")
    back = spark.read.text(str(tmp_path / "w")).select(F.url_decode("page").alias("p"), "value")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}


def test_many_pages_are_written_and_read_in_time(spark, tmp_path):
    import time

    df = spark.range(3000).select(F.concat(F.lit("set/"), F.col("id").cast("string"), F.lit(".html")).alias("p"), F.col("id").cast("string").alias("h"))
    began = time.time()
    sinks.write_pages(df, str(tmp_path / "w"), "p", "h")
    assert {tuple(r) for r in readers.written_pages(spark, str(tmp_path / "w")).collect()} == {tuple(r) for r in df.collect()}
    assert time.time() - began < 15
    assert len(list((tmp_path / "w").rglob("page=*/part*.txt"))) == 3000


@pytest.mark.parametrize("folders", [True, False])
def test_written_pages_come_back_as_they_were(spark, tmp_path, folders):
    rows = [("007", "numbers stay texts"), ("7", "x"), ("", "no name"), ("a*b~ +.html", "é – \u2028"), ("twice", "one"), ("twice", "two"), ("null", None)]
    df = spark.createDataFrame(rows, "p string, h string")
    for _ in range(2):  # the second time in place of the first
        sinks.write_pages(df, str(tmp_path / "w"), "p", "h", folders)
    assert sorted(tuple(r) for r in readers.written_pages(spark, str(tmp_path / "w")).collect()) == sorted((p, h or "") for p, h in rows)
    assert len(list((tmp_path / "w").rglob("*.txt"))) == 6 and not list((tmp_path / "w").rglob(".part*"))
    assert len(list((tmp_path / "w").glob("at=*/*/"))) == (6 if folders else 0)
    sinks.write_pages(df.where("false"), str(tmp_path / "w"), "p", "h")
    assert readers.written_pages(spark, str(tmp_path / "w")).count() == 0


def test_build_from_pages(spark, tmp_path, capsys, monkeypatch):
    from leafmill import __main__ as M

    page = """<html><title>OpenThing</TITLE><a href='toc.htm'>up</a><h1>OpenThing</h1><pre><b>HANDLE</b>
      OpenThing(void);</pre><table><tr><td>Versions:</td><td>2.0 and later<tr><td>Defined in:<td>Thing.h (include Base.h)<tr><td>Link to:<td>a.lib; B.lib (version 2)
      <tr><td>Platform<td></table>"""
    d = put(tmp_path / "in", {"set/open.htm": page, "set/gone.HTM": "<title>Topic Not Found</title>x", "set/a.gif": "no"})
    monkeypatch.setattr(M, "local_session", lambda: spark)
    base = str(tmp_path / "kb")
    assert M.main(["build", d, base, "--layer", "ce"]) == 0
    rows = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{base}/{t}").select(*c).collect()]
    assert rows("page", "doc_set", "file_name", "symbol", "layer") == [("set", "open.htm", "OpenThing", "ce")]
    assert rows("declaration", "signature") == [("HANDLE OpenThing(void);",)]
    assert rows("version", "version_min", "open_ended", "parse_status") == [("2.0", True, "parsed")]
    assert rows("header", "header", "include_header") == [("thing.h", "base.h")]
    assert sorted(rows("library", "library")) == [("a.lib",), ("b.lib",)]
    assert ("platform", "") in rows("requirement", "label", "value") and rows("link", "target") == [("toc.htm",)] and rows("reject", "reason") == [("placeholder",)]
    capsys.readouterr()
    assert M.main(["query", base, "SELECT symbol, 'a' || chr(9) || 'b' AS t FROM page CROSS JOIN range(1500)"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert out[0] == "symbol\tt" and len(out) == 1501 and out[1] == "OpenThing\ta\\tb"
    assert M.main(["check", d, base]) == 0
    put(tmp_path / "in", {"set/new.htm": "x"})
    assert M.main(["check", d, base]) == 1


def test_archive_members(spark, tmp_path):
    import io
    import tarfile
    import zipfile

    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        for name, data in (("src/A.cs", "const uint A = 1;\n"), ("src/é.H", "#define B 2"), ("x.png", "no")):
            info = tarfile.TarInfo(name)
            info.size = len(data.encode())
            t.addfile(info, io.BytesIO(data.encode()))
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("lib/c.def", "EXPORTS\n One @1\n")
        z.writestr("big.cs", "x" * 9_000_000)
        z.writestr("after.cs", "y")
    (tmp_path / "c.txt").write_text("no")
    got = {r["path"]: r["value"] for r in readers.archive_members(spark, str(tmp_path)).collect()}
    assert {k: len(v) for k, v in got.items()} == {"src/A.cs": 18, "src/é.H": 11, "lib/c.def": 16, "big.cs": 9_000_000, "after.cs": 1}
    lines = readers.split_lines(readers.archive_members(spark, str(tmp_path / "a.tar.gz")))
    assert sorted((r["path"], r["line_no"]) for r in lines.collect()) == [("src/A.cs", 1), ("src/A.cs", 2), ("src/é.H", 1)]
    assert readers.archive_members(spark, str(tmp_path), wanted=r"\.none$").count() == 0
