"""From many observations to one answer a key, and what speaks against it.

All operators aggregate before they gather, so a key with very many rows costs a partition no more than its
different values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions.text import numeric_literal
from leafmill.session import free_name, materialise


def rank_of(value: str | Column, order: list[str]) -> Column:
    """The place of a value in an explicit order of trust; unknown and null ones come last."""
    c = F.lower(F.trim(F.col(value) if isinstance(value, str) else value))
    places = F.create_map(*(F.lit(x) for pair in ((name, i) for i, name in enumerate(order)) for x in pair))
    return F.coalesce(F.try_element_at(places, c), F.lit(len(order)))


def choose(df: DataFrame, keys: list[str], order: list[Column], carried: list[str]) -> DataFrame:
    """One row a key: the least by ``order`` (nulls first in no case), with the carried columns.

    An aggregate, not a window: partial minima are taken before the shuffle, so a hot key doesn't gather its rows.
    """
    ranks = [F.struct(o.isNull().alias("n"), o.alias("v")).alias(f"o{i}") for i, o in enumerate(order)]
    best = F.min(F.struct(*ranks, *(F.col(c).alias(f"c{i}") for i, c in enumerate(carried)))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"best.c{i}").alias(c) for i, c in enumerate(carried)))


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n_values): each value of the keys printed with more than one; nulls are no value.

    One row a value, so that no key's values are gathered, however many there are.
    """
    each = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, value).distinct()
    many = each.groupBy(key).agg(F.count("*").alias("n_values")).where("n_values > 1")
    return each.join(many, key).select(key, value, "n_values")


def adopt(own: DataFrame, other: DataFrame, key: str, layer: str) -> DataFrame:
    """``own`` and, for keys on which it is silent, the rows of ``other`` marked with a layer."""
    silent = other.join(own.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")
    return own.unionByName(silent.withColumn("layer", F.lit(layer)), allowMissingColumns=True)


def agreement(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(n_agree, n_differ) over keys that both sides give a value."""
    both = a.select(key, F.col(value).alias("x")).join(b.select(key, F.col(value).alias("y")), key)
    return both.agg(F.count_if(F.col("x") == F.col("y")).alias("n_agree"), F.count_if(F.col("x") != F.col("y")).alias("n_differ"))


def prefix_matches(df: DataFrame, key: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """(key, prefix): every pair in which the key starts with the prefix, by equality joins.

    Keys are cut to the few lengths that prefixes have, so that no pair but a match is ever formed.
    """
    lengths = prefixes.select(F.length(prefix).alias("n")).where("n > 0").distinct()
    lengths = sorted(r["n"] for r in lengths.collect())  # lengths of short strings: a handful, whatever the number of prefixes
    if not lengths:
        return df.select(key).where("false").withColumn(prefix, F.lit(None).cast("string"))
    cut = F.explode(F.array(*(F.when(F.length(key) >= n, F.substring(key, 1, n)) for n in lengths)))
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.withColumn(prefix, cut).where(F.col(prefix).isNotNull()).join(prefixes.select(prefix).distinct(), prefix).select(key, prefix)


def reviewed_headers(names: DataFrame, name: str, value: str, reviews: DataFrame, base_width: int = 0x1000) -> DataFrame:
    """(name, header_file, scope, verdict): for each name the review that holds.

    A review of the name beats one of a prefix, of which the longest wins, and that beats one of the value's base (the
    multiple of ``base_width`` at or below it). A ``reject`` holds as well and is returned as such: it says that the header is not the name's, and hides what wider
    scopes say; ask for ``verdict <> 'reject'`` to get headers only. Among equals ``prefer`` beats ``approve`` beats ``reject``, then the header's name.
    """
    own = names.select(F.col(name).alias("name"), F.col(value).alias("value")).distinct()
    r = reviews.select("review_scope", "review_key", "header_file", "verdict")
    of = lambda scope: r.where(F.col("review_scope") == scope)
    by_name = own.select("name").distinct().join(of("name"), F.col("name") == F.col("review_key")).select("name", F.lit(0).alias("place"), "review_scope", "header_file", "verdict")
    hits = prefix_matches(own, "name", of("prefix").select(F.col("review_key").alias("prefix")), "prefix")
    by_prefix = hits.join(of("prefix"), F.col("prefix") == F.col("review_key")).select("name", (F.lit(1000) - F.length("prefix")).alias("place"), "review_scope", "header_file", "verdict")
    base = (F.floor(F.col("value") / base_width) * base_width).cast("decimal(20,0)")
    bases = of("value-base").withColumn("base", numeric_literal(F.col("review_key")))
    by_base = own.where("value >= 0").withColumn("base", base).join(bases, "base").select("name", F.lit(2000).alias("place"), "review_scope", "header_file", "verdict")
    found = by_name.unionByName(by_prefix).unionByName(by_base)
    return choose(found, ["name"], [F.col("place"), rank_of("verdict", ["prefer", "approve", "reject"]), F.col("header_file")], ["header_file", "review_scope", "verdict"])


def unprinted(reviews: DataFrame, printed: DataFrame, keys: list[str]) -> DataFrame:
    """Reviews that choose what no page prints; a valid review list gives none."""
    return reviews.join(printed.select(*keys).distinct(), keys, "left_anti")


def not_allowed(pages: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    """Pages that no entry of an allowlist covers; the policy check holds if there are none. Null keys are not covered."""
    return pages.join(allowed.select(*keys).distinct(), keys, "left_anti")


def without_evidence(reviews: DataFrame, page: str) -> DataFrame:
    """Reviews that name no page as evidence."""
    return reviews.where(F.trim(F.coalesce(page, F.lit(""))) == "")


def suffix_pairs(symbols: DataFrame, name: str) -> DataFrame:
    """(base, wide, narrow): names that differ only in a W or A at the end, both of them given."""
    wide = symbols.where(F.col(name).rlike("[a-z0-9]W$")).select(F.expr(f"substring({name}, 1, length({name}) - 1)").alias("base"), F.col(name).alias("wide"))
    narrow = symbols.where(F.col(name).rlike("[a-z0-9]A$")).select(F.expr(f"substring({name}, 1, length({name}) - 1)").alias("base"), F.col(name).alias("narrow"))
    return wide.distinct().join(narrow.distinct(), "base")


def collapse_runs(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Of each run of equal values within a group, in order, the first row (not a global distinct).

    The rows are range-partitioned by group and order, so that a group that holds a large part of all rows is spread over many
    partitions, and collapsed there, before anything is written. What ends one partition is carried into the next by a table of one
    row a partition. Nulls are a value of their own; values are compared by 64 bits of their hash.
    """
    part, edge, last, own, what, g, v = (free_name(df.columns, x) for x in ("part_no", "is_edge", "is_last", "group_hash", "value_hash", "group_before", "value_before"))
    keys = [F.col(group), *map(F.col, order)]
    rows = df.withColumns({own: F.xxhash64(group), what: F.xxhash64(value)}).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(part, F.spark_partition_id())
    names = [*df.columns, own, what, part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, tail = None, None
        flagged = lambda b, e, x: pa.RecordBatch.from_arrays([*b.columns, pa.array(e), pa.array(x)], [*names, edge, last])
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g, v = batch.column(own).to_numpy(), batch.column(what).to_numpy()
            starts = np.ones(n, bool)
            starts[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
            starts[0] = before != (g[0], v[0])
            edges = np.zeros(n, bool)
            edges[0] = before is None
            before, tail = (g[-1], v[-1]), batch.slice(n - 1, 1)
            yield flagged(batch.filter(pa.array(starts)), edges[starts], np.zeros(starts.sum(), bool))
        if tail is not None:
            yield flagged(tail, [False], [True])

    schema = T.StructType([*rows.schema.fields, T.StructField(edge, T.BooleanType()), T.StructField(last, T.BooleanType())])
    runs = materialise(rows.mapInArrow(run, schema), "runs")
    ends = runs.where(F.col(last)).select(part, F.lag(F.struct(own, what)).over(Window.orderBy(part)).alias("end"))  # rows by partitions
    ends = ends.select(F.col(part), F.col(f"end.{own}").alias(g), F.col(f"end.{what}").alias(v)).where(F.col(g).isNotNull())
    kept = runs.where(~F.col(last)).join(ends, part, "left")
    goes_on = F.col(edge) & F.coalesce((F.col(g) == F.col(own)) & (F.col(v) == F.col(what)), F.lit(False))
    return kept.where(~goes_on).select(*(F.col(f"`{c}`") for c in df.columns))


def compare_captures(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, change): added, removed, changed or same, between two captures."""
    both = a.select(key, F.col(value).alias("x"), F.lit(True).alias("in_a")).join(b.select(key, F.col(value).alias("y"), F.lit(True).alias("in_b")), key, "full")
    return both.select(key, F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(F.equal_null(F.col("x"), F.col("y")), "same").otherwise("changed").alias("change"))


def stack(parts: list[DataFrame]) -> DataFrame:
    """The union of observation tables of different layers; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def gap_list(wanted: DataFrame, found: DataFrame, key: str, hint: DataFrame, value: str) -> DataFrame:
    """Keys without an answer, with what an auxiliary source says of them."""
    return wanted.select(key).distinct().join(found.select(key).distinct(), key, "left_anti").join(hint.select(key, value), key, "left")


def verify_stored(receipts: DataFrame, files: DataFrame) -> DataFrame:
    """(stored_path, verdict): receipts (stored_path, n_bytes, sha256_hex) held against a manifest (path, n_bytes, sha256_hex).

    missing, other size, other content or same; a receipt without size or digest is only asked for the other.
    """
    f = files.select(F.col("path").alias("stored_path"), F.col("n_bytes").alias("size"), F.col("sha256_hex").alias("digest"))
    both = receipts.where("stored_path is not null").join(f, "stored_path", "left")
    verdict = F.when(F.col("digest").isNull(), "missing").when(F.col("n_bytes") != F.col("size"), "other size").when(F.lower("sha256_hex") != F.col("digest"), "other content").otherwise("same")
    return both.select("stored_path", verdict.alias("verdict"))
