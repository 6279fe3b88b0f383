"""Queries of the small-file compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.operators import compact
from leafmill.session import scratch_path, table

KEYS = {"keys": ["page_id", "piece_no"], "content": "payload", "id_col": "file_id", "group": "page_id", "number": "piece_no"}


def target(spark: SparkSession, d: str) -> int:
    return int(table(spark, d, "size_limits").where("limit_name = 'store_file'").first()["max_size"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = compact.same_records(table(spark, d, "page_files"), target_bytes=target(spark, d), **KEYS)
    return pairs.toDF("file_id_a", "file_id_b")


def p3_compacted(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "page-files")
    compact.compact(table(spark, d, "page_files"), path, target_bytes=target(spark, d), at="written_at", **KEYS)
    return spark.read.parquet(path).select("file_id", "page_id", "piece_no", "payload")


QUERIES = {f.__name__: f for f in (p3_found, p3_compacted)}
SQL = {
    "p3_found": """
        SELECT a.file_id AS file_id_a, b.file_id AS file_id_b FROM page_files a JOIN page_files b
        ON a.page_id = b.page_id AND a.file_id < b.file_id
        AND (a.piece_no = b.piece_no OR (a.piece_no IS NULL OR b.piece_no IS NULL) AND a.payload = b.payload)""",
    "p3_compacted": """
        WITH f AS (SELECT *, row_number() OVER (ORDER BY written_at NULLS LAST, file_id) AS r FROM page_files)
        SELECT file_id, page_id, piece_no, payload FROM f
        WHERE page_id IS NULL OR piece_no IS NULL AND payload IS NULL
        OR piece_no IS NOT NULL AND r = (SELECT min(r) FROM f g WHERE g.page_id = f.page_id AND g.piece_no = f.piece_no)
        OR piece_no IS NULL AND NOT EXISTS (SELECT 1 FROM f g WHERE g.page_id = f.page_id AND g.payload = f.payload
            AND (g.piece_no IS NOT NULL OR g.r < f.r))""",
}
