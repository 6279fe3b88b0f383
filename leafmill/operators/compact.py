"""Bringing the records of very many small files into few files of about a target size, each record once.

The rows are read twice. The first time a narrow table is made of them (keys, sizes, digests), on which everything is planned:
which rows are stored copies, how many files come out, and, from a sample tied to that number and weighted by the records'
bytes, the boundaries of one range of the clustering keys a file. The second time the rows are shuffled once to their ranges,
sorted and written. The copies to leave out travel with them as markers that lie beside their rows after the sort, so that no
join touches whole rows. Counts and checksums of what was read and what was written must agree before the new folder takes the
place of the old one.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.session import drop_path, free_name, materialise, scratch_path, ship_package

#: Keys a range of the sample that gives the boundaries: its ranges' sizes then spread by about a tenth.
SAMPLE_A_RANGE = 100


@dataclass
class Report:
    """What a compaction did."""

    path: str
    rows_read: int
    rows_written: int
    copies_dropped: int
    bytes_read: int
    ranges: int


def sortable(values: tuple) -> tuple:
    """A key that compares with nulls last, whatever the columns' types."""
    return tuple((v is None or v is pd.NaT, 0 if v is None or v is pd.NaT else v) for v in values)


def boundaries(narrow: DataFrame, keys: list[str], size: str, ranges: int, rows: int) -> list[tuple]:
    """Upper keys of all ranges but the last, so that each holds about as many bytes, from SAMPLE_A_RANGE keys a range."""
    if ranges < 2 or not rows:
        return []
    part, wanted = narrow.select(*keys, size), SAMPLE_A_RANGE * ranges
    sample = (part.sample(min(1.0, wanted / rows), seed=17) if rows > wanted else part).toArrow()  # bounded by the number of files to write
    sample = sorted((sortable(k), int(w or 0) + 1) for *k, w in zip(*(sample.column(i).to_pylist() for i in range(sample.num_columns))))
    total, sofar, out = sum(w for _, w in sample), 0, []
    for key, w in sample:
        if sofar + w > total * (len(out) + 1) / ranges and (not out or key > out[-1]):
            out.append(key)
        sofar += w
        if len(out) == ranges - 1:
            break
    return out


def ranged(df: DataFrame, keys: list[str], bounds: list[tuple], then: list[Column]) -> DataFrame:
    """``df`` shuffled once into ``len(bounds) + 1`` ranges of the keys and sorted within them, by ``then`` where keys are equal."""
    n = len(bounds) + 1
    if n > 1:
        ship_package(df.sparkSession)
        held = df.sparkSession.sparkContext.broadcast(bounds)  # one key a file to write
        name = free_name(df.columns, "range_no")

        @F.pandas_udf(T.IntegerType())
        def place(cols: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for c in cols:
                lists = [s.astype(object).where(s.notna(), None).tolist() for s in c]
                yield pd.Series([bisect.bisect_left(held.value, sortable(k)) for k in zip(*lists)], dtype="int32")

        df = df.withColumn(name, place(*keys)).repartitionById(n, name).drop(name)
    else:
        df = df.coalesce(1)
    return df.sortWithinPartitions(*(F.col(k).asc_nulls_last() for k in keys), *then)


def checksum(df: DataFrame) -> list[Column]:
    """Aggregates n and h: the rows, and a sum over the rows' hashes that doesn't depend on their order."""
    return [F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).cast("decimal(20,0)")), F.lit(0)).alias("h")]


def described(df: DataFrame, id_col: str, keys: list[str], content: str, at: str | None = None) -> DataFrame:
    """A narrow table, written once, of all rows: the keys, ``n_bytes`` and ``digest`` of the content, ``row_hash``, ``key_hash``, ``at``.

    Sizes are UTF-8 bytes, counted, since stored sizes may be missing.
    """
    own = {k: F.col(k).alias(f"k{i}") for i, k in enumerate([*keys, id_col])}
    narrow = df.select(
        *own.values(),
        F.coalesce(F.octet_length(content), F.lit(0)).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).alias("row_hash"),
        F.xxhash64(*own).alias("key_hash"),
        (F.col(at) if at else F.lit(None).cast("timestamp")).alias("at"),
    )
    return materialise(narrow, "described")


def stored_copies(narrow: DataFrame, group: str, number: str, id_: str) -> DataFrame:
    """The rows of a narrow table that store again what an earlier row does (by ``at``, then by id), since later ones are retries.

    Rows of equal group and number are one record. A row without number is a copy if a row of its group
    with equal content has a number or was written before. Rows without a group, or without number and content, or without an id
    are records of their own.
    """
    named = narrow.where(F.col(id_).isNotNull() & F.col(group).isNotNull())
    first_id = F.min(F.struct(F.col("at").isNull(), F.col("at"), F.col(id_)))[id_].alias(id_)
    numbered, loose = named.where(F.col(number).isNotNull()), named.where(F.col(number).isNull() & F.col("digest").isNotNull())
    kept = numbered.groupBy(group, number).agg(first_id).select(id_)
    first = loose.groupBy(group, "digest").agg(first_id).join(numbered.select(group, "digest").distinct(), [group, "digest"], "left_anti").select(id_)
    alone = narrow.where(F.col(group).isNull() | F.col(number).isNull() & F.col("digest").isNull()).select(id_)
    kept = kept.unionByName(first).unionByName(alone).where(F.col(id_).isNotNull())
    return narrow.where(F.col(id_).isNotNull()).join(kept, id_, "left_anti")


def without_marked(hash_: str, mark: str, extra: dict[str, str]):
    """For mapInArrow over sorted rows: leaves out the markers and every row that stands behind a marker of its own key hash.

    ``extra`` may name a column and a hash: the column then says whether a neighbour has the hash too; it is also true for the first and
    the last of a batch, whose neighbours are not at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: int | None = None  # the key hash of the marker read last
        for batch in batches:
            if not batch.num_rows:
                continue
            h, m = batch.column(hash_).to_numpy(), batch.column(mark).to_numpy(zero_copy_only=False)
            at = np.maximum.accumulate(np.where(m, np.arange(len(h)), -1))
            of = h[np.maximum(at, 0)]
            dead = np.where(at >= 0, of == h, False if last is None else h == last)
            last = int(of[-1]) if at[-1] >= 0 else last
            out = batch.filter(pa.array(~(m | dead)))
            cols = [out.column(c) for c in out.schema.names if c not in (hash_, mark, *extra.values())]
            for source in extra.values():
                x = out.column(source).to_numpy()
                near = np.ones(len(x), bool)
                if len(x):
                    same = x[1:] == x[:-1]
                    near = np.concatenate([[True], same]) | np.concatenate([same, [True]])
                    near |= (x == x[0]) | (x == x[-1])
                cols.append(pa.array(near))
            yield pa.RecordBatch.from_arrays(cols, [c for c in out.schema.names if c not in (hash_, mark, *extra.values())] + list(extra))

    return run


def cluster(df: DataFrame, narrow: DataFrame, keys: list[str], id_col: str, target_bytes: int, path: str, copies: DataFrame | None = None, near: str | None = None) -> tuple[DataFrame, int, int]:
    """Write ``df`` to ``path`` in ranges of the keys, each about ``target_bytes``; gives it read back, its rows and the number of ranges.

    ``narrow`` describes it. Rows that ``copies`` (some rows of ``narrow``) holds are left out. ``near`` names a column to add: whether a neighbour in the sorted files
    has the keys too. Raises, and removes what it wrote, unless the written rows are exactly those that had to be.
    """
    spark = df.sparkSession
    sums = lambda x: x.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("row_hash").cast("decimal(20,0)")), F.lit(0)).alias("h"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    a, c = sums(narrow), sums(copies) if copies is not None else {"n": 0, "h": 0, "b": 0}
    n, h, b = (a[k] - c[k] for k in "nhb")
    ranges = max(1, math.ceil(b / target_bytes))
    names = [f"k{i}" for i in range(len(keys) + 1)]
    bounds = boundaries(narrow, names, "n_bytes", ranges, a["n"])
    all_keys = [*keys, id_col]
    hash_, mark = free_name(df.columns, "key_hash"), free_name(df.columns, "is_marker")
    rows = df.withColumn(hash_, F.xxhash64(*all_keys)).withColumn(mark, F.lit(False))
    if copies is not None:
        # Given the schema of the rows, so that one shuffle takes both.
        markers = copies.select(*(F.col(k).alias(x) for k, x in zip(names, all_keys)), F.col("key_hash").alias(hash_), F.lit(True).alias(mark))
        rows = rows.unionByName(markers, allowMissingColumns=True)
    extra = {}
    schema = T.StructType(list(df.schema.fields))
    if near:
        beside = free_name(rows.columns, "beside_hash")
        rows, extra = rows.withColumn(beside, F.xxhash64(*keys)), {near: beside}
        schema = T.StructType([*schema.fields, T.StructField(near, T.BooleanType())])
    rows = ranged(rows, all_keys, bounds, [F.col(hash_).asc(), F.col(mark).desc()])
    ship_package(spark)
    rows.mapInArrow(without_marked(hash_, mark, extra), schema).write.parquet(path)
    written = spark.read.schema(schema).parquet(path)
    after = written.select(*(F.col(f"`{x}`") for x in df.columns))
    after = after.agg(*checksum(after)).first()
    if (after["n"], after["h"]) != (n, h):
        drop_path(spark, path)
        raise RuntimeError("the rows written are not the rows read; nothing was changed")
    return written, n, len(bounds) + 1


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that was interrupted: nothing is lost, whenever it was.

    A new folder whose check is marked takes its place; one without the mark is dropped; the folder put aside comes back if there is no
    other, and is dropped else. On object stores a rename is a copy, so there the mark also tells a whole folder from a part of one.
    """
    new, old, now = (_path(spark, f"{path.rstrip('/')}{x}") for x in (".new", ".old", ""))
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(new):
        if fs.exists(_path(spark, f"{path.rstrip('/')}.new/{CHECKED}")):
            swap(spark, path)
            return
        fs.delete(new, True)
    if fs.exists(old):
        if fs.exists(now):
            fs.delete(old, True)
        else:
            fs.rename(old, now)


CHECKED = "_CHECKED"


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def swap(spark: SparkSession, path: str) -> None:
    """Put the checked folder ``path.new`` in the place of ``path``: rename the old one aside, the new one in, then delete."""
    new, old, now = (_path(spark, f"{path.rstrip('/')}{x}") for x in (".new", ".old", ""))
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(now):
        if fs.exists(old):
            fs.delete(old, True)
        if not fs.rename(now, old):
            raise RuntimeError(f"{path} could not be renamed")
    if not fs.rename(new, now):
        raise RuntimeError(f"{path}.new could not take its place; recover() tries again")
    if fs.exists(old):
        fs.delete(old, True)


def compact(df: DataFrame, path: str, keys: list[str], content: str, target_bytes: int, id_col: str, group: str, number: str, at: str) -> Report:
    """Compact the records of ``df`` into ``path``, each record once, in files of about ``target_bytes``.

    Sizes are UTF-8 bytes of the content, counted, since stored sizes may be missing. An empty table gives an
    empty folder. ``path`` may be the folder that ``df`` is read from: it is replaced only after the check. ``group`` and ``number`` are among
    the keys. What an interrupted run left behind is finished or removed first (see :func:`recover`).
    """
    spark = df.sparkSession
    recover(spark, path)
    narrow = described(df, id_col, keys, content, at)
    names = {k: f"k{i}" for i, k in enumerate([*keys, id_col])}
    copies = materialise(stored_copies(narrow, names[group], names[number], names[id_col]), "copies")
    total = narrow.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()
    new = f"{path.rstrip('/')}.new"
    _, n, ranges = cluster(df, narrow, keys, id_col, target_bytes, new, copies)
    _path(spark, f"{new}/{CHECKED}").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(_path(spark, f"{new}/{CHECKED}")).close()
    swap(spark, path)
    return Report(path, total["n"], n, total["n"] - n, total["b"], ranges)


def same_records(df: DataFrame, keys: list[str], content: str, target_bytes: int, id_col: str, group: str, number: str) -> DataFrame:
    """(id_a, id_b), the smaller first: pairs of rows of ``df`` that store the same record.

    The rows are first clustered as :func:`compact` does, all copies included, so that copies with a number lie beside each other in the
    sorted files: only rows with such a neighbour are paired. Copies without a number are looked for by group and content. Equal group and number, or, where a number is
    missing in one or both, equal group and content. Rows with a null group, or null content where it counts, are
    in no pair. A row that is given twice is not a pair of its own. The keys are group and number.
    """
    digest, near = free_name(df.columns, "content_hash"), free_name(df.columns, "has_neighbour")
    path = scratch_path(df.sparkSession, "clustered")
    df = df.withColumn(digest, F.unhex(F.sha2(content, 256)))
    rows, *_ = cluster(df, described(df, id_col, keys, content), keys, id_col, target_bytes, path, near=near)
    own = rows.where(F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(number).alias("k"), F.col(digest).alias("h"), F.col(id_col).alias("id"), F.col(near).alias("near"))
    a, b = (own.where("near and k is not null").select("g", "k", F.col("id").alias(f"id_{x}")) for x in "ab")
    equal = a.join(b, ["g", "k"]).where("id_a < id_b").select("id_a", "id_b")
    a, b = own.where("k is null").select("g", "h", F.col("id").alias("id_a")), own.select("g", "h", F.col("k").alias("k_b"), F.col("id").alias("id_b"))
    loose = a.join(b, ["g", "h"]).where("k_b is not null and id_a <> id_b or k_b is null and id_a < id_b")
    loose = loose.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return equal.unionByName(loose).distinct()
