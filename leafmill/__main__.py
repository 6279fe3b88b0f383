"""``python -m leafmill build|check|query|export|wrap``: the knowledge base from the command line."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from leafmill import plans
from leafmill.functions import text as X
from leafmill.operators.observe import observations
from leafmill.session import local_session, table
from leafmill.sources import readers, sinks

TABLES = ("wrap_oss_page", "version_statement", "aux_constant", "api_symbol", "header_review", "value_review", "probe_receipt", "cdx_capture")


def build_pages(spark, folder: str, base: str, layer: str) -> None:
    """The observation tables of a folder of pages, as Parquet, and a manifest of the pages."""
    for name, rows in observations(readers.whole_files(spark, folder), layer).items():
        sinks.write_table(rows, base, name)
    sinks.write_table(sinks.manifest(spark, folder), base, "manifest")


def build(spark, source: str, base: str) -> None:
    """All tables and all answers as Parquet, and a manifest of the inputs."""
    for name in TABLES:
        sinks.write_table(table(spark, source, name), base, name)
    for name, query in plans.all_queries().items():
        if name.startswith("k_"):
            sinks.write_table(query(spark, source), base, name)
    sinks.write_table(sinks.manifest(spark, source), base, "manifest")


def check(spark, source: str, base: str) -> int:
    """How many inputs differ from those the knowledge base was built of; each is printed."""
    changed = sinks.stale(spark.read.parquet(f"{base}/manifest"), sinks.manifest(spark, source))
    n = 0
    for row in changed.orderBy("path").toLocalIterator():
        print(row["change"], row["path"], sep="\t")
        n += 1
    return n


def show(answer) -> None:
    """Every row of an answer, tab-separated, a partition at a time; the driver never holds it whole."""
    print(*answer.columns, sep="\t")
    for row in answer.toLocalIterator():
        print(*("" if v is None else str(v).replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n") for v in row), sep="\t")


def wrap(spark, title: str, body: str, front: str, out: str) -> None:
    """One wrapped page from two files."""
    row = spark.createDataFrame([(title, Path(body).read_text(encoding="utf-8"), Path(front).read_text(encoding="utf-8"))], "title string, body string, front string")
    html = row.select(X.wrap_page(row["title"], row["body"], row["front"]).alias("h")).first()["h"]
    Path(out).parent.mkdir(parents=True, exist_ok=True)
    Path(out).write_text(html, encoding="utf-8")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="leafmill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("build", "check"):
        c = commands.add_parser(name)
        c.add_argument("source")
        c.add_argument("base")
        if name == "build":
            c.add_argument("--layer", help="the source is a folder of HTML pages of this layer, not of tables")
    c = commands.add_parser("query")
    c.add_argument("base")
    c.add_argument("sql")
    c = commands.add_parser("export")
    c.add_argument("base")
    c.add_argument("table")
    c.add_argument("path")
    c.add_argument("--format", default="tsv", choices=("csv", "tsv", "json", "parquet"))
    c = commands.add_parser("wrap")
    for name in ("title", "body", "front", "out"):
        c.add_argument(name)
    a = parser.parse_args(argv)
    spark = local_session()
    if a.command == "build":
        if a.layer:
            build_pages(spark, a.source, a.base, a.layer)
        else:
            build(spark, a.source, a.base)
    elif a.command == "check":
        return int(check(spark, a.source, a.base) > 0)
    elif a.command == "query":
        readers.knowledge_base(spark, a.base)
        show(spark.sql(a.sql))
    elif a.command == "export":
        sinks.export(spark.read.parquet(f"{a.base}/{a.table}"), a.path, a.format)
    else:
        wrap(spark, a.title, a.body, a.front, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
