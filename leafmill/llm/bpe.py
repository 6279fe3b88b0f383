"""Encoding with a public byte-level BPE vocabulary by a lazily determinised transducer.

The merges are compiled into a finite-state transducer over bytes. A state is what later output can
still depend on: the last token that can no longer change, and the bytes after it. States and
transitions come into being when an input first needs them. Since every pair of adjacent tokens of a
BPE encoding must itself be a stable encoding, each prefix of a word has exactly one last token; a
token is emitted as soon as every way the word may go on shares it, which is at most one longest
vocabulary entry later (the bounded lookahead).
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from leafmill.session import ship_package, tokenizer_folder

# The pre-tokenizing pattern that belongs to the byte_bpe_50k vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern where every character is ASCII; the stdlib engine runs it several times faster.
#: (There, \s of both engines also holds FS, GS, RS and US only in one of them: those go the other way.)
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

#: Encoded words and states kept in one worker; beyond it the oldest half is forgotten, never an answer.
KEPT = 400_000


class Transducer:
    """Byte-level BPE as a transducer whose states and arcs are made on demand."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.prefixes = {b[:n] for b in ranks for n in range(1, len(b))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.arcs: dict[tuple[int, bytes, int], tuple[int, bytes, tuple[int, ...]]] = {}
        self.ends: dict[tuple[int, bytes], tuple[int, ...]] = {}

    def merged(self, text: bytes) -> list[int]:
        """The encoding by its definition: merge the adjacent pair of lowest rank until none is left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stable(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding (-1: the start of the word)."""
        if left < 0:
            return True
        key = (left, right)
        if (known := self.pairs.get(key)) is None:
            known = self.pairs[key] = self.merged(self.of[left] + self.of[right]) == [left, right]
        return known

    def _lattice(self, last: int, pending: bytes) -> list[tuple[int, int]]:
        """For each prefix of ``pending``: its last token and where that token starts."""
        found: list[tuple[int, int]] = [(last, -1)]
        for end in range(1, len(pending) + 1):
            for start in range(max(0, end - self.longest), end):
                token = self.ranks.get(pending[start:end])
                if token is None or found[start] is None:
                    continue
                if self.stable(found[start][0], token) and self._whole(token):
                    found.append((token, start))
                    break
            else:  # a part that no encoding of a longer text can end with
                found.append(None)
        return found

    @lru_cache(maxsize=None)  # noqa: B019 - one transducer lives as long as its worker
    def _whole(self, token: int) -> bool:
        """Whether the merges build this token at all when its bytes stand alone."""
        return self.merged(self.of[token]) == [token]

    @staticmethod
    def _path(found: list[tuple[int, int]], end: int) -> list[tuple[int, int]]:
        """(token, end) of the tokens that lead to ``end``."""
        path = []
        while end > 0:
            token, start = found[end]
            path.append((token, end))
            end = start
        return path[::-1]

    def step(self, last: int, pending: bytes, byte: int) -> tuple[int, bytes, tuple[int, ...]]:
        """The arc for one byte: the next state and the tokens that it emits."""
        now = pending + bytes((byte,))
        found = self._lattice(last, now)
        # A later token can start only where what follows is the beginning of a vocabulary entry.
        live = [i for i in range(max(0, len(now) - self.longest), len(now)) if found[i] and now[i:] in self.prefixes]
        if found[len(now)]:
            live.append(len(now))
        common: list[tuple[int, int]] | None = None
        for end in live:
            path = self._path(found, end)
            if common is None:
                common = path
            else:
                n = 0
                while n < len(common) and n < len(path) and common[n] == path[n]:
                    n += 1
                common = common[:n]
            if not common:
                break
        if not common:
            return last, now, ()
        return common[-1][0], now[common[-1][1] :], tuple(t for t, _ in common)

    def finish(self, last: int, pending: bytes) -> tuple[int, ...]:
        """What is emitted when the word ends in this state."""
        found = self._lattice(last, pending)
        return tuple(t for t, _ in self._path(found, len(pending))) if found[-1] else tuple(self.merged(pending))

    def word(self, text: bytes) -> tuple[int, ...]:
        """Run the transducer over one pre-token."""
        if (whole := self.ranks.get(text)) is not None and self._whole(whole):
            return (whole,)
        last, pending, out = -1, b"", []
        arcs = self.arcs
        for byte in text:
            key = (last, pending, byte)
            arc = arcs.get(key)
            if arc is None:
                if len(arcs) > KEPT:
                    arcs.clear()
                    self.pairs.clear()
                arc = arcs[key] = self.step(last, pending, byte)
            last, pending, emitted = arc
            out.extend(emitted)
        if pending:
            key = (last, pending)
            tail = self.ends.get(key)
            if tail is None:
                if len(self.ends) > KEPT:
                    self.ends.clear()
                tail = self.ends[key] = self.finish(last, pending)
            out.extend(tail)
        return tuple(out)


class _Words(dict):
    """Pre-token -> ids; a missing one is run through the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > KEPT:
            for k in list(self)[: KEPT // 2]:
                del self[k]
        ids = self.transducer.word(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    """Whole texts to ids and back."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.transducer = Transducer(ranks)
        self.words = _Words(self.transducer)
        self._ascii = re.compile(ASCII_PATTERN).findall
        self._any = regex.compile(PATTERN).findall
        self._odd = re.compile("[\x1c-\x1f]").search

    def parts(self, text: str) -> list[str]:
        return (self._ascii if text.isascii() and not self._odd(text) else self._any)(text)

    def encode(self, text: str | None) -> list[int]:
        """The ids; an empty list for an empty or a null text."""
        if not text:
            return []
        words = self.words
        return list(chain.from_iterable([words[p] for p in self.parts(text)]))

    def count(self, text: str | None) -> int:
        """How many ids :meth:`encode` gives."""
        if not text:
            return 0
        words = self.words
        return sum([len(words[p]) for p in self.parts(text)])

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(decode_stream(self.transducer.of[i] for i in ids))


def decode_stream(pieces: Iterable[bytes]) -> Iterator[str]:
    """Turn a stream of token bytes into text by an incremental UTF-8 state machine.

    The state is the code point so far, the continuation bytes still due and the range that the next one
    must be in; characters leave as soon as they are complete, and what cannot become one is U+FFFD.
    """
    code, due, low, high = 0, 0, 0x80, 0xBF
    for piece in pieces:
        out = []
        for b in piece:
            if due:
                if low <= b <= high:
                    code, due, low, high = code << 6 | b & 0x3F, due - 1, 0x80, 0xBF
                    if not due:
                        out.append(chr(code))
                    continue
                out.append("�")
                due, low, high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                code, due = b & 0x1F, 1
            elif 0xE0 <= b <= 0xEF:
                code, due = b & 0x0F, 2
                low, high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                code, due = b & 0x07, 3
                low, high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        if out:
            yield "".join(out)
    if due:
        yield "�"


@lru_cache(maxsize=4)
def encoder(name: str = "byte_bpe_50k", folder: str | None = None) -> Encoder:
    """One encoder for each vocabulary in each worker; the file is the one that was shipped, if the folder isn't there."""
    path = f"{folder or tokenizer_folder()}/{name}.tiktoken"
    return Encoder(path if os.path.exists(path) else SparkFiles.get(f"{name}.tiktoken"))


def ship_vocabulary(spark: SparkSession, name: str, folder: str) -> None:
    """Send the vocabulary's file to all executors, once a Spark context, so that only the driver needs the folder; and this package."""
    ship_package(spark)
    path = f"{folder}/{name}.tiktoken"
    if path not in (sent := spark.sparkContext.__dict__.setdefault("_leafmill_sent", set())):
        spark.sparkContext.addFile(path)
        sent.add(path)


def encode_column(df: DataFrame, id_col: str, text_col: str, out: str = "ids", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(id, ids) for every row of ``df``; other columns are not read.

    Nulls and empty texts give an empty list, repeated rows stay repeated, an empty table gives no rows.
    Special tokens' strings are ordinary text. A narrow operation: no shuffle, batches through Arrow.
    """
    folder = folder or tokenizer_folder()
    ship_vocabulary(df.sparkSession, name, folder)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(name, folder)
        words, parts, flat = own.words, own.parts, chain.from_iterable
        for batch in batches:
            offsets, ids = [0], []
            for text in batch.column(1).to_pylist():
                if text:
                    ids.extend(flat([words[p] for p in parts(text)]))
                offsets.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [id_col, out])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode_column(df: DataFrame, id_col: str, ids_col: str = "ids", out: str = "text", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(id, text) of lists of ids: the way back from :func:`encode_column`. An empty list gives an empty text, null gives null; an id that isn't in the vocabulary is an error."""
    folder = folder or tokenizer_folder()
    ship_vocabulary(df.sparkSession, name, folder)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(name, folder)
        for batch in batches:
            texts = [None if ids is None else own.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, out])

    return df.select(id_col, ids_col).mapInArrow(run, schema)


def count_column(df: DataFrame, id_col: str, text_col: str, out: str = "n_tokens", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(id, number of tokens) for every row; 0 for null and empty texts."""
    folder = folder or tokenizer_folder()
    ship_vocabulary(df.sparkSession, name, folder)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(name, folder)
        for batch in batches:
            n = [own.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], [id_col, out])

    return df.select(id_col, text_col).mapInArrow(run, schema)
