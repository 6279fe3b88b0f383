"""Writers: tables, reports, pages, manifests, logs."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.session import drop_path, local_path, ship_package

#: Folders among which those of the pages are spread, and the name for a page without a path, which is Spark's.
PAGE_FOLDERS = 1024
NO_PATH = "__HIVE_DEFAULT_PARTITION__"


def write_table(df: DataFrame, folder: str, name: str, by: list[str] | None = None) -> None:
    """A table of the knowledge base, replaced as a whole; ``by`` gives partition folders for pruning."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{folder}/{name}")


def export(df: DataFrame, path: str, form: str) -> None:
    """``csv``, ``tsv``, ``json`` or ``parquet``."""
    if form == "tsv":
        df.write.mode("overwrite").csv(path, sep="\t", header=True)
    elif form in ("csv", "json", "parquet"):
        df.write.mode("overwrite").format(form).options(**({"header": "true"} if form == "csv" else {})).save(path)
    else:
        raise ValueError(f"unknown format {form}")


def report(df: DataFrame, path: str, order: list[str]) -> None:
    """A generated report in a fixed order: a global sort by ranges, whose files follow one another."""
    df.orderBy(*order).write.mode("overwrite").csv(path, sep="\t", header=True)


def summary_lines(counts: DataFrame) -> DataFrame:
    """``- name: 1,234`` lines from one row of counts."""
    lines = F.array(*(F.format_string(f"- {c.replace('_', ' ')}: %,d", F.col(f"`{c}`").cast("long")) for c in counts.columns))
    return counts.select(F.posexplode(lines).alias("line_no", "line"))


def write_pages(df: DataFrame, folder: str, out_path: str, html: str, folders: bool = True) -> None:
    """Each page as a text in a folder ``page=`` of its own path, encoded so that no two paths have one name (``url_decode`` gives it back).

    The folders lie in PAGE_FOLDERS folders ``at=`` by the hash of the path; a task writes whole ones of these, page by page. A row is a line. On local and mounted
    file systems the tasks write the files themselves, each under a hidden name until it is whole, so that a task done again gives the same files; with Spark's
    own writer and reader of partitions a page took 12 ms there. Without ``folders`` the pages lie there as files ``page-`` of their paths, which takes half the disk.
    :func:`readers.written_pages` reads the pages of either kind.
    """
    page = F.coalesce(F.nullif(F.url_encode(out_path), F.lit("")), F.lit(NO_PATH))
    pages = df.select(F.pmod(F.xxhash64(page), F.lit(PAGE_FOLDERS)).cast("int").alias("at"), page.alias("page"), F.col(html).alias("value")).repartition("at").sortWithinPartitions("at", "page")
    root = local_path(df.sparkSession, folder)
    if root is None:
        pages.write.mode("overwrite").partitionBy("at", "page").text(folder)
        return
    ship_package(df.sparkSession)
    drop_path(df.sparkSession, folder)
    os.makedirs(root)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hidden = f".part-{TaskContext.get().taskAttemptId()}"
        file, last, path, n = None, None, "", 0

        def done() -> None:
            file.close()
            os.replace(file.name, path)

        for batch in batches:
            for at, page, value in zip(*(c.to_pylist() for c in batch.columns)):
                if page != last:
                    if file:
                        done()
                    own = f"{root}/at={at}"
                    path = f"{own}/page-{page}.txt"
                    if folders:
                        # Escaped once more, as Spark's own writer does with names of folders and its readers undo.
                        own += f"/page={page.replace('%', '%25').replace('*', '%2A')}"
                        path = f"{own}/part-0.txt"
                    os.makedirs(own, exist_ok=True)
                    file, last = open(os.path.join(own, hidden), "wb", 1 << 16), page
                file.write((value or "").encode() + b"\n")
                n += 1
        if file:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    pages.mapInArrow(put, "n long").agg(F.sum("n")).collect()


def append_log(df: DataFrame, path: str, line: str) -> None:
    df.select(F.col(line).alias("value")).write.mode("append").text(path)


def name_lists(df: DataFrame, path: str, header: str, name: str, layer: str, left_out: str) -> None:
    """Header and name, a line each, sorted by both over all files; a layer is left out."""
    kept = df.where(F.col(layer).isNull() | (F.lower(F.trim(layer)) != left_out)).select(header, name).distinct()
    kept.orderBy(header, name).select(F.concat_ws("\t", header, name).alias("value")).write.mode("overwrite").text(path)


def define_files(df: DataFrame, folder: str, header: str, name: str, value: str, layer: str, left_out: str) -> None:
    """An include file a header, in a folder ``header=``: a guard, a ``#define`` a name in order of names, an end; a layer is left out.

    Lines are sorted on their way to the files and never gathered.
    """
    kept = df.where(F.col(layer).isNull() | (F.lower(F.trim(layer)) != left_out)).select(F.col(header).alias("header"), F.col(name).alias("name"), F.col(value).alias("v")).distinct()
    body = kept.select("header", F.lit(1).alias("part"), "name", F.concat(F.lit("#define "), "name", F.lit(" "), "v").alias("value"))
    ends = kept.select("header").distinct().select("header", F.explode(F.array(F.struct(F.lit(0).alias("part"), F.lit("#pragma once").alias("value")), F.struct(F.lit(2).alias("part"), F.lit("// end").alias("value")))).alias("e"))
    lines = body.unionByName(ends.select("header", "e.part", F.lit("").alias("name"), "e.value"))
    lines.repartitionByRange("header").sortWithinPartitions("header", "part", "name", "value").select("header", "value").write.mode("overwrite").partitionBy("header").text(folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, n_bytes, sha256_hex) of all files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256_hex"))


def stale(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, change): files added, removed or changed between two manifests."""
    both = old.select("path", F.col("sha256_hex").alias("was")).join(new.select("path", F.col("sha256_hex").alias("now")), "path", "full")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    return both.select("path", change.alias("change")).where("change is not null")
