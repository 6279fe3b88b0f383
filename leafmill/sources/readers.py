"""Readers of the raw inputs: pages, articles, receipts, indexes, lists and source lines."""

from __future__ import annotations

import io
import os
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.session import local_path, ship_package
from leafmill.sources.sinks import NO_PATH, PAGE_FOLDERS

REVIEW_NAMES = "review_scope string, review_key string, header_file string, verdict string, evidence_page string, remark string"
REVIEW_VALUES = "const_name string, resolved_value string, category string, verdict string"


def whole_files(spark: SparkSession, folder: str, glob: str = "*.{htm,HTM,html,HTML}") -> DataFrame:
    """(path, value): one row a file, whatever its depth; the glob keeps media and sources out. UTF-8. Spark's scans leave files of no bytes out."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return raw.select("path", F.col("content").cast("string").alias("value"))


def html_pages(spark: SparkSession, folder: str) -> DataFrame:
    """HTML pages with doc set and file name from the path; declared charsets are ignored, the files are UTF-8."""
    return parsed_html(whole_files(spark, folder))


def parsed_html(pages: DataFrame) -> DataFrame:
    """Title, article, folder, doc set and file name of pages (path, value)."""
    return pages.withColumns({"page_title": X.title_of(F.col("value")), "article": X.article_of(F.col("value")), **path_columns(F.col("path"))})


def stored_files(spark: SparkSession, folder: str, pattern: str = r"(\d+)-(\d+)?[^/]*$", glob: str = "*.txt") -> DataFrame:
    """A folder of very many small files as records: (file_id, store_path, page_id, piece_no, written_at, file_size, payload).

    Page and piece are the groups of ``pattern`` in the path; where the second is missing the number is null. Ids are hashes of the path. A file of no bytes
    is no record. Many files go into one task: Spark packs them by ``spark.sql.files.openCostInBytes``, so set that low (64 KB) for files of some KB.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    part = lambda k: F.nullif(F.regexp_extract("path", pattern, k), F.lit(""))
    return raw.select(
        F.xxhash64("path").alias("file_id"), F.col("path").alias("store_path"), part(1).cast("long").alias("page_id"), part(2).cast("int").alias("piece_no"),
        F.col("modificationTime").alias("written_at"), F.col("length").alias("file_size"), F.col("content").cast("string").alias("payload"),
    )


def written_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(path, value): the lines of the pages that :func:`sinks.write_pages` has written, with the path of each; every file is read.

    On local and mounted file systems a task lists and reads folders ``at=`` by itself, so that the driver never holds a list of all files.
    """
    root = local_path(spark, folder)
    if root is None:
        lines = spark.read.schema("value string, at int, page string").text(folder)
        return lines.select(F.coalesce(F.url_decode("page"), F.lit("")).alias("path"), "value")
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(pages, pa.string()), pa.array(values, pa.string())], ["page", "value"])
        pages, values, size = [], [], 0
        for b in batches:
            for at in b.column(0).to_pylist():
                for own in os.scandir(f"{root}/at={at}") if os.path.isdir(f"{root}/at={at}") else ():
                    if own.name.startswith("page="):
                        page = own.name.removeprefix("page=").replace("%2A", "*").replace("%25", "%")
                        files = [f"{own.path}/{name}" for name in os.listdir(own.path) if not name.startswith((".", "_"))]
                    else:
                        page = own.name.removeprefix("page-").removesuffix(".txt")
                        files = [own.path] if own.name.startswith("page-") else []
                    for path in files:
                        with open(path, encoding="utf-8") as file:
                            for line in file:
                                pages.append("" if page == NO_PATH else page)
                                values.append(line.rstrip("\n"))
                                size += len(line) + len(page)
                                if size > 8_000_000:
                                    yield batch()
                                    pages, values, size = [], [], 0
        yield batch()

    folders = spark.range(0, PAGE_FOLDERS, 1, min(PAGE_FOLDERS, 4 * spark.sparkContext.defaultParallelism)).select(F.col("id").alias("at"))
    return folders.mapInArrow(run, "page string, value string").select(F.url_decode("page").alias("path"), "value")


def markdown_pages(spark: SparkSession, folder: str) -> DataFrame:
    return parsed_markdown(whole_files(spark, folder, "*.md"))


def parsed_markdown(pages: DataFrame) -> DataFrame:
    """(path, front, lists, body) of pages (path, value)."""
    parts = X.front_matter(F.col("value"))
    return pages.select("path", parts["front"].alias("front"), parts["lists"].alias("lists"), parts["body"].alias("body"))


def articles(spark: SparkSession, folder: str, glob: str = "*.{txt,TXT}") -> DataFrame:
    """Plain-text articles in Windows-1252: decoded, line ends made one, lower-case names, first line as title, wrapped in a pre element."""
    return parsed_articles(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder))


def parsed_articles(raw: DataFrame) -> DataFrame:
    """(path, file_name, title, body, html) of files (path, content)."""
    body = F.regexp_replace(X.decode_western(F.col("content")), r"\r\n?", "\n")
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    title = F.trim(F.regexp_extract(body, r"\A\s*([^\n]*)", 1))
    return raw.select("path", name.alias("file_name"), title.alias("title"), body.alias("body"), F.concat(F.lit('<pre class="kb">'), X.escape_html(body), F.lit("</pre>")).alias("html"))


def path_columns(path: Column) -> dict[str, Column]:
    """Folder, doc set and lower-case file name of a path; a bare name has an empty folder."""
    return {
        "folder": F.regexp_extract(path, r"^(.*)/[^/]*$", 1),
        "doc_set": F.regexp_extract(path, r"([^/]+)/[^/]*$", 1),
        "file_name": F.lower(F.regexp_extract(path, r"([^/]*)$", 1)),
    }


def good_pages(pages: DataFrame, path: str, title: str, value: str, refused: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with a reason): empty pages, placeholders by path or title (never by body) and interstitials by their text."""
    reason = F.when(X.strip_end(F.coalesce(value, F.lit(""))) == "", "empty").when(F.col(path).rlike(r"(?i)/notopic[^/]*$") | (F.coalesce(title, F.lit("")) == "Topic Not Found"), "placeholder")
    for text in refused:
        reason = reason.when(F.contains(value, F.lit(text)), "interstitial")
    marked = pages.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def receipts(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """Probe receipts: the ``- key: value`` list as a map and the links of the list after the second heading."""
    return parsed_receipts(whole_files(spark, folder, glob))


def parsed_receipts(files: DataFrame) -> DataFrame:
    """(path, fields, links) of receipts (path, value)."""
    pattern = r"(?m)^- ([\w -]+): (.*)$"
    entries = F.arrays_zip(F.regexp_extract_all("value", F.lit(pattern), 1).alias("k"), F.regexp_extract_all("value", F.lit(pattern), 2).alias("v"))
    fields = F.aggregate(entries, F.expr("cast(map() as map<string,string>)"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["k"]), F.create_map(e["k"], F.trim(e["v"]))))
    links = F.regexp_extract_all(F.regexp_extract("value", r"(?s)\n## .*?\n(.*)$", 1), F.lit(r"(?m)^- (\S+)$"), 1)
    return files.select("path", fields.alias("fields"), links.alias("links"))


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """One row a capture from JSON arrays whose first row is the header; an empty index gives no rows."""
    return parsed_captures(spark.read.text(path, wholetext=True))


def parsed_captures(raw: DataFrame) -> DataFrame:
    """(capture), a map, of JSON arrays (value)."""
    return raw.select(F.explode(X.zip_header(F.col("value"))).alias("capture"))


def availability(spark: SparkSession, path: str) -> DataFrame:
    """(url, archived_snapshots) of availability answers; an empty object is an empty map."""
    return parsed_availability(spark.read.text(path, wholetext=True))


def parsed_availability(raw: DataFrame) -> DataFrame:
    """(url, archived_snapshots) of answers (value)."""
    shape = "url string, archived_snapshots map<string, struct<status: string, available: boolean, url: string, timestamp: string>>"
    return raw.select(F.from_json("value", shape).alias("a")).select("a.*")


def source_lines(spark: SparkSession, folder: str, glob: str = "*.{cs,h,def}") -> DataFrame:
    """(path, line_no, line) of all lines of source members, counted from 1."""
    return split_lines(whole_files(spark, folder, glob))


def split_lines(files: DataFrame) -> DataFrame:
    """(path, line_no, line) of texts (path, value)."""
    return files.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")).select("path", (F.col("n") + 1).alias("line_no"), "line")


def archive_members(spark: SparkSession, folder: str, glob: str = "*.{tar.gz,tgz,tar,zip}", wanted: str = r"\.(cs|h|def)$") -> DataFrame:
    """(archive, path, value) of the members of archives whose names match, read as UTF-8; directories and other members aside.

    An archive is unpacked by one task, member by member, and leaves in batches of bounded size; archives are read side by side.
    """
    ship_package(spark)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path", "content")
    keep = re.compile(wanted, re.IGNORECASE).search

    def members(name: str, data: bytes) -> Iterator[tuple[str, bytes]]:
        if name.lower().endswith(".zip"):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                yield from ((m.filename, z.read(m)) for m in z.infolist() if not m.is_dir() and keep(m.filename))
        else:
            with tarfile.open(fileobj=io.BytesIO(data)) as t:
                yield from ((m.name, t.extractfile(m).read()) for m in t if m.isfile() and keep(m.name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["archive", "path", "value"])
        for b in batches:
            for name, data in zip(*(c.to_pylist() for c in b.columns)):
                rows, size = [], 0
                for path, value in members(name, data):
                    rows.append((name, path, value.decode("utf-8", "replace")))
                    size += len(value)
                    if size > 8_000_000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return raw.mapInArrow(run, "archive string, path string, value string")


def mirrored(pages: DataFrame, wanted: DataFrame, snippet: str) -> DataFrame:
    """Of parsed pages those of the wanted sets (doc_set), without the mirror's own snippet and without placeholders and empty pages."""
    some = pages.join(wanted.select("doc_set").distinct(), "doc_set", "left_semi")
    kept, _ = good_pages(some.withColumn("value", X.strip_snippet(F.col("value"), snippet)), "path", "page_title", "value")
    return kept


def review_table(spark: SparkSession, path: str, schema: str = REVIEW_NAMES) -> DataFrame:
    """A review list: tab-separated, with a header line, ``#`` comments."""
    return spark.read.csv(path, sep="\t", header=True, comment="#", schema=schema)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a list, one a line; blank lines and comments aside."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> '' and not startswith(url, '#')")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def table_names(spark: SparkSession, folder: str) -> list[str]:
    """The tables of a knowledge base: its folders, on whatever file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory())


def knowledge_base(spark: SparkSession, folder: str, names: list[str] | None = None) -> None:
    """Each named table (all, if none are) of a knowledge base as a temporary view, open to ``spark.sql``."""
    for name in names or table_names(spark, folder):
        spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(name)
