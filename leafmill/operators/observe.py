"""From pages to the observation tables of a knowledge base: what each page prints, one row a statement, nothing chosen yet.

All tables come from one scan by narrow projections; no page's rows are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.sources.readers import good_pages, parsed_html

VERSION_LABELS = ("version", "versions", "supported versions", "since")
HEADER_LABELS = ("defined in", "declared in", "header")
LIBRARY_LABELS = ("link to", "link library", "library")


def observations(pages: DataFrame, layer: str, refused: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The tables page, declaration, requirement, version, header, library, link and reject of pages (path, value).

    A page's title is its symbol. Empty pages, placeholders and pages with one of the ``refused`` texts go to reject, all others to page.
    Blank cells are kept as printed, but name no header, library or version. Equal pages stay apart by their paths.
    """
    kept, rejected = good_pages(parsed_html(pages), "path", "page_title", "value", refused)
    fields = X.page_fields(F.col("value"))
    own = kept.select("path", "doc_set", "file_name", F.col("page_title").alias("symbol"), F.lit(layer).alias("layer"), fields["signature"].alias("signature"), X.requirement_rows(F.col("value")).alias("rows"), X.link_targets(F.col("value")).alias("links"))
    requirement = own.select("path", "symbol", "layer", F.posexplode("rows").alias("pos", "r")).select("path", "symbol", "layer", "pos", "r.label", "r.value").where("label <> ''")
    printed = lambda labels: requirement.where(F.col("label").isin(*labels) & (F.col("value") != ""))
    version = printed(VERSION_LABELS).withColumn("v", X.parse_version(F.col("value")))
    header = printed(HEADER_LABELS).withColumn("h", X.header_parts(F.col("value")))
    return {
        "page": own.select("path", "doc_set", "file_name", "symbol", "layer"),
        "declaration": own.where("signature <> ''").select("path", "symbol", "layer", "signature"),
        "requirement": requirement,
        "version": version.select("path", "symbol", "layer", F.col("value").alias("raw_text"), F.col("v.min").alias("version_min"), F.col("v.max").alias("version_max"), F.col("v.open_ended").alias("open_ended"), F.col("v.status").alias("parse_status")),
        "header": header.select("path", "symbol", "layer", F.col("h.header").alias("header"), F.col("h.include_header").alias("include_header")),
        "library": printed(LIBRARY_LABELS).select("path", "symbol", "layer", F.explode(X.library_names(F.col("value"))).alias("library")),
        "link": own.select("path", F.posexplode("links").alias("pos", "target")),
        "reject": rejected.select("path", "reason"),
    }
