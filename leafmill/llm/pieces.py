"""Cutting oversized texts into overlapping pieces by recursive bisection at natural boundaries."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.session import ship_package

#: Boundaries from the strongest to the weakest; a cut lies at the end of a match.
BOUNDARIES = tuple(
    re.compile(p)
    for p in (
        r"\n[ \t\r\f\xa0]*\n\s*",  # a blank line
        r"\r\n|[\n\r\f  ]",  # a line's end
        r"[.!?…][\"'”’»)\]]*\s+|[。！？](?:[」』”）])?",  # a sentence's end
        r"[;:,、；：，]\s*(?<=[\s、；：，])|\s[–—-]\s",  # a clause's end
        r"\s+",  # between words
    )
)
JOINERS = frozenset("‌‍︎️")


def attached(text: str, at: int) -> bool:
    """Whether a cut at ``at`` would tear what belongs together: CR LF, a letter and its marks, joined emoji."""
    if not 0 < at < len(text):
        return False
    a, b = text[at - 1], text[at]
    return a == "\r" and b == "\n" or b in JOINERS or a == "‍" or unicodedata.category(b)[0] == "M" or "\U0001f3fb" <= b <= "\U0001f3ff"


def cut_at(text: str, start: int, end: int, slack: float = 0.25) -> int:
    """The strongest boundary within ``slack`` of the length around the midpoint; of equals the nearest to it.

    Where there is none, the midpoint, moved off marks that belong to the letter before.
    """
    middle, reach = (start + end) // 2, max(1, int((end - start) * slack))
    low, high = max(start + 1, middle - reach), min(end - 1, middle + reach)
    for boundary in BOUNDARIES:
        best = None
        for m in boundary.finditer(text, max(start, low - 2), min(end, high + 2)):
            at = m.end()
            if low <= at <= high and not attached(text, at) and (best is None or abs(at - middle) < abs(best - middle)):
                best = at
            if best is not None and at - middle > abs(best - middle):
                break
        if best is not None:
            return best
    at = middle
    while at < high and attached(text, at):
        at += 1
    if at >= high:
        at = middle
        while at > low and attached(text, at):
            at -= 1
    return at if low <= at <= high and not attached(text, at) else middle


def cuts(text: str, limit: int, overlap: int) -> list[int]:
    """The inner cut positions: spans above limit - overlap are bisected until none is left."""
    room, out, todo = limit - overlap, [], [(0, len(text))]
    if len(text) <= limit:
        return out
    while todo:
        start, end = todo.pop()
        if end - start > room:
            at = cut_at(text, start, end)
            out.append(at)
            todo += [(start, at), (at, end)]
    return sorted(out)


def overlap_start(text: str, cut: int, overlap: int, floor: int) -> int:
    """Where the piece after ``cut`` begins: ``overlap`` characters before it, or a little later at a word's start."""
    at = max(floor, cut - overlap)
    if at == 0 or overlap == 0:
        return at
    if not text[at - 1].isspace() or text[at].isspace():
        m = BOUNDARIES[-1].search(text, at, min(cut, at + overlap // 4))
        if m and m.end() < cut and not attached(text, m.end()):
            return m.end()
    while at < cut and attached(text, at):
        at += 1
    return at


def split(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, cut, end) of each piece: text[start:end], of which text[start:cut] repeats the piece before.

    The pieces without their repeats are the text. No piece is longer than ``limit``.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    inner = cuts(text, limit, overlap)
    edges, before, out = [0, *inner, len(text)], 0, []
    for a, b in zip(edges, edges[1:]):
        start = overlap_start(text, a, overlap, before) if a else 0
        out.append((start, a, b))
        before = start
    return out


def pieces(df: DataFrame, id_col: str, text_col: str, limit: int, overlap: int) -> DataFrame:
    """(id, piece_no, start_at, n_repeated, piece) of every text; positions count code points from 0.

    A text within the limit, also an empty one, is one piece; a null text gives no row. Repeated rows are cut
    each on its own; an empty table gives no rows. A narrow operation without a shuffle.
    """
    ship_package(df.sparkSession)
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("piece_no", T.IntegerType()), T.StructField("start_at", T.LongType()), T.StructField("n_repeated", T.IntegerType()), T.StructField("piece", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number, starts, repeated, texts = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for k, (start, cut, end) in enumerate(split(text, limit, overlap)):
                    at.append(i)
                    number.append(k)
                    starts.append(start)
                    repeated.append(cut - start)
                    texts.append(text[start:end])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()), pa.array(repeated, pa.int32()), pa.array(texts, pa.string())], schema.names)

    return df.where(F.col(text_col).isNotNull()).select(id_col, text_col).mapInArrow(run, schema)
