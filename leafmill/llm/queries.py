"""The queries of this subpackage, by name, and the SQL that some can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import bpe, charset, lookalike, neardup, packing, pieces, scan
from leafmill.session import table


def limit_of(spark: SparkSession, sf_dir: str, name: str) -> tuple[int, int]:
    """(size, overlap) of one of the few rows of size_limits."""
    row = table(spark, sf_dir, "size_limits").where(f"limit_name = '{name}'").first()
    return int(row["max_size"]), int(row["overlap_size"] or 0)


def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    return charset.restored_fields(table(spark, d, "wrap_oss_page"), "page_id", ["title", "body"]).withColumnRenamed("id", "page_id")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_restored(spark, d).select("page_id", "field_name")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    members, links = neardup.near_duplicates(table(spark, d, "wrap_oss_page"), "page_id", "body", 0.6, 3)
    return neardup.pairs_of(members, links, ("page_id_a", "page_id_b"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    members, links = neardup.near_duplicates(table(spark, d, "wrap_oss_page"), "page_id", "body", 0.6, 3)
    return neardup.groups_of(members, links).withColumnRenamed("id", "page_id")


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scan.scan_noise(table(spark, d, "wrap_oss_page"), "page_id", "body", "title")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_repaired(spark, d).select("page_id")


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    limit, overlap = limit_of(spark, d, "page_piece")
    return pieces.pieces(table(spark, d, "wrap_oss_page"), "page_id", "body", limit, overlap)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_pieces(spark, d).where("piece_no = 1").select("page_id")


def p5_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of each body put together again without what they repeat, and whether they keep to the limits."""
    limit, overlap = limit_of(spark, d, "page_piece")
    own = p5_pieces(spark, d).select("page_id", "piece_no", F.expr("substring(piece, n_repeated + 1)").alias("own"), ((F.length("piece") <= limit) & (F.col("n_repeated") <= overlap)).alias("fits"))
    parts = own.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "own"))).alias("parts"), F.bool_and("fits").alias("fits"))  # the pieces of one text
    return parts.select("page_id", F.sha2(F.array_join(F.transform("parts", lambda p: p["own"]), ""), 256).alias("sha256_hex"), "fits")


def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The text that each document's ids give back."""
    return bpe.decode_column(p6_ids(spark, d), "doc_id").select("doc_id", F.sha2("text", 256).alias("sha256_hex"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_column(table(spark, d, "documents"), "doc_id", "text")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), "doc_id", "text", limit_of(spark, d, "token_container")[0])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_containers(spark, d).where("piece_no = 1").select("doc_id")


def p7_checked(spark: SparkSession, d: str) -> DataFrame:
    """Whether each document is placed whole, all its tokens once, in containers that aren't too full."""
    capacity = limit_of(spark, d, "token_container")[0]
    placed = p7_containers(spark, d)
    full = placed.groupBy("container_no").agg((F.sum("piece_tokens") > capacity).alias("too_full")).where("too_full")
    rows = placed.join(full, "container_no", "left")
    own = rows.groupBy("doc_id").agg(F.sum("piece_tokens").alias("n"), F.max("n_tokens").alias("n_tokens"), F.count("*").alias("pieces"), F.count("too_full").alias("n_full"))
    return own.select("doc_id", ((F.col("n") == F.col("n_tokens")) & (F.col("n_full") == 0) & (F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity)))).alias("placed"))


def p8_settled(spark: SparkSession, d: str) -> DataFrame:
    """Whether the form of each text's form is that form itself."""
    first = p8_forms(spark, d).select("doc_id", "form")
    again = lookalike.forms(first.select(F.struct("doc_id", F.sha2("form", 256).alias("h")).alias("key"), "form"), "key", "form")
    return again.select("key.doc_id", F.equal_null(F.sha2("form", 256), F.col("key.h")).alias("settled"))


def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.forms(table(spark, d, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_pairs(table(spark, d, "documents"), "doc_id", "text").toDF("doc_id_a", "doc_id_b")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_groups, p4_found, p4_repaired, p5_found, p5_pieces, p5_rejoined, p6_ids, p6_decoded, p7_found, p7_containers, p7_checked, p8_found, p8_forms, p8_settled)
}

SQL: dict[str, str] = {
    "p2_found": r"""
        WITH words AS (
            SELECT page_id, list_filter(regexp_split_to_array(body, '[ \t\r\n\f]+'), lambda x: x <> '') AS w
            FROM wrap_oss_page WHERE body IS NOT NULL
        ), runs AS (
            SELECT DISTINCT page_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS r
            FROM (SELECT page_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
        ), sizes AS (SELECT page_id, count(*) AS n FROM runs GROUP BY page_id
        ), common AS (
            SELECT a.page_id AS page_id_a, b.page_id AS page_id_b, count(*) AS c
            FROM runs a JOIN runs b ON a.r = b.r AND a.page_id < b.page_id GROUP BY 1, 2
        )
        SELECT page_id_a, page_id_b FROM common
        JOIN sizes x ON x.page_id = page_id_a JOIN sizes y ON y.page_id = page_id_b
        WHERE c / (x.n + y.n - c)::DOUBLE >= 0.6""",
    "p5_found": "SELECT page_id FROM wrap_oss_page WHERE length(body) > (SELECT max_size FROM size_limits WHERE limit_name = 'page_piece')",
    "p5_rejoined": "SELECT page_id, sha256(body) AS sha256_hex, true AS fits FROM wrap_oss_page WHERE body IS NOT NULL",
    "p6_decoded": "SELECT doc_id, sha256(coalesce(text, '')) AS sha256_hex FROM documents",
    "p7_checked": "SELECT doc_id, true AS placed FROM documents",
    "p8_settled": "SELECT doc_id, true AS settled FROM documents",
}

SQL["p2_groups"] = """
        WITH RECURSIVE found AS (""" + SQL["p2_found"] + """), runs AS (
            SELECT DISTINCT page_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS r FROM (SELECT page_id, w, unnest(range(1, len(w) - 1)) AS i FROM
            (SELECT page_id, list_filter(regexp_split_to_array(body, '[ \\t\\r\\n\\f]+'), lambda x: x <> '') AS w FROM wrap_oss_page WHERE body IS NOT NULL) WHERE len(w) >= 3)
        ), sizes AS (SELECT page_id, list(r ORDER BY r) AS own FROM runs GROUP BY page_id
        ), alike AS (SELECT page_id_a, page_id_b, a.own = b.own AS same FROM found JOIN sizes a ON a.page_id = page_id_a JOIN sizes b ON b.page_id = page_id_b
        ), class AS (
            SELECT s.page_id, least(s.page_id, min(page_id_a)) AS class_id FROM sizes s LEFT JOIN alike ON page_id_b = s.page_id AND same GROUP BY s.page_id
        ), links AS (
            SELECT DISTINCT a.class_id AS a, b.class_id AS b FROM alike JOIN class a ON a.page_id = page_id_a JOIN class b ON b.page_id = page_id_b WHERE NOT same
        ), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach AS (SELECT DISTINCT class_id AS a, class_id AS r FROM class UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.r
        )
        SELECT page_id, class_id, (SELECT min(r) FROM reach WHERE a = class_id) AS group_id, (SELECT count(*) FROM edges WHERE a = class_id) AS n_links FROM class"""
