"""Filling containers of fixed capacity with documents sized in tokens.

The plan is made on the histogram of sizes, which has at most one entry for each size up to the capacity
however many documents there are. Sizes above a third of the capacity are matched first, at most two to a
container, the largest with the largest partner that fits; the rest go by decreasing size into the
tightest gap (best fit), or open new containers. The plan says which ranks within each size go into which
run of containers, so the documents are placed by a rank that needs no global sort: a partition counts
its own rows, and a sum over partitions gives the offset.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.llm.bpe import encoder, ship_vocabulary
from leafmill.session import materialise, tokenizer_folder


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the items of each size go: (size, first rank, first container, containers, items in each) and the number of containers."""
    left = {s: n for s, n in counts.items() if s > 0 and n > 0}
    if any(s > capacity for s in left):
        raise ValueError("an item is larger than the capacity")
    used: dict[int, int] = {}
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    bins = 0

    def put(size: int, first: int, many: int, each: int) -> None:
        out.append((size, used.get(size, 0), first, many, each))
        used[size] = used.get(size, 0) + many * each
        left[size] -= many * each

    def gap(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(order, room)
            gaps[room].append((first, many))

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left[s] > 0:
            p = next((x for x in large if x <= capacity - s and left[x] > (x == s)), None)
            many = left[s] if p is None else left[s] // 2 if p == s else min(left[s], left[p])
            first, bins = bins, bins + many
            put(s, first, many, 1)
            if p is not None:
                put(p, first, many, 1)
            gap(capacity - s - (p or 0), first, many)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s] > 0:
            i = bisect.bisect_left(order, s)
            if i == len(order):
                room, (first, many) = capacity, (bins, -(-left[s] // (capacity // s)))
                bins += many
            else:
                room = order[i]
                first, many = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], order[i]
            each = min(room // s, left[s])
            full = min(many, left[s] // each)
            put(s, first, full, each)
            gap(room - each * s, first, full)
            if full < many:
                rest = left[s]
                if rest:
                    put(s, first + full, 1, rest)
                    gap(room - rest * s, first + full, 1)
                gap(room, first + full + (rest > 0), many - full - (rest > 0))
    return out, bins


def items(df: DataFrame, id_col: str, text_col: str, capacity: int, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """One or two rows a document: the pieces that fill a container alone, and the remainder or whole document.

    (id, first_piece, n_pieces, item_size, part, local_rank, n_tokens); local_rank counts the items of that
    size before it in its own partition.
    """
    folder = folder or tokenizer_folder()
    ship_vocabulary(df.sparkSession, name, folder)
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.LongType()) for c in ("first_piece", "n_pieces", "item_size", "part", "local_rank", "n_tokens"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = encoder(name, folder), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                n = own.count(text)
                full, rest = divmod(n, capacity)
                if full:
                    at.append(i)
                    rows.append((0, full, capacity, part, seen[capacity], n))
                    seen[capacity] += full
                if rest or not full:
                    at.append(i)
                    rows.append((full, 1, rest, part, seen[rest], n))
                    seen[rest] += 1
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)], schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def pack(df: DataFrame, id_col: str, text_col: str, capacity: int, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(id, piece_no, piece_tokens, container_no, n_tokens): where each document, or each piece of an oversized one, lies.

    A document above the capacity is cut into full pieces and a remainder; every other one stays whole.
    Null and empty texts have no tokens and take no room: they are spread over the containers (container 0
    if there is none). Repeated rows are documents of their own; an empty table gives no rows.
    """
    spark = df.sparkSession
    own = materialise(items(df, id_col, text_col, capacity, name, folder), "items")
    by_part = own.groupBy("part", "item_size").agg(F.sum("n_pieces").alias("n"))
    by_part = materialise(by_part, "item-counts")
    histogram = {r["item_size"]: r["n"] for r in by_part.groupBy("item_size").agg(F.sum("n").alias("n")).collect()}  # at most capacity + 1 rows
    runs, bins = plan(histogram, capacity)
    w = Window.partitionBy("item_size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "item_size", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))  # rows by partitions, not by documents
    runs.sort()
    keys = np.array([(s << 44) + r for s, r, *_ in runs], dtype=np.int64)
    table = spark.sparkContext.broadcast((keys, np.array(runs, dtype=np.int64).reshape(-1, 5)))  # its size depends on the capacity alone

    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.LongType()) for c in ("piece_no", "piece_tokens", "container_no", "n_tokens"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, runs = table.value
        for batch in batches:
            first_piece, n_pieces, size, local, before, tokens = (np.asarray(batch.column(c)).astype(np.int64) for c in ("first_piece", "n_pieces", "item_size", "local_rank", "before", "n_tokens"))
            row = np.repeat(np.arange(len(size)), n_pieces)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            rank, s = (local + before)[row] + step, size[row]
            container = rank % max(1, bins)
            if len(keys):
                a = runs[np.clip(np.searchsorted(keys, (s << 44) + rank, side="right") - 1, 0, None)]
                container = np.where(s > 0, a[:, 2] + (rank - a[:, 1]) // np.maximum(1, a[:, 4]), container)
            yield pa.RecordBatch.from_arrays([batch.column(id_col).take(pa.array(row)), pa.array(first_piece[row] + step), pa.array(s), pa.array(container), pa.array(tokens[row])], schema.names)

    # Rows by partitions times sizes: not to be sent to all executors, however many partitions there are.
    return own.join(before.hint("merge"), ["part", "item_size"]).select(id_col, "first_piece", "n_pieces", "item_size", "local_rank", "before", "n_tokens").mapInArrow(run, schema)
