"""Near-duplicate texts by a self-join of binary tries over minhash fingerprints.

Each distinct set of word runs (a class of copies) gets a fingerprint of ``BITS`` bits, one for each of as many
minhash values, so the expected share of differing bits of two sets is (1 - J) / 2. The fingerprints are
the leaves of a binary trie. The self-join walks pairs of nodes from the root down, adds up the bits in
which the two sides differ, and gives a pair up as soon as that exceeds the error budget; the budget lies
``SIGMAS`` standard deviations above what the threshold gives. The forest of tries is spread over the
cluster by locality-sensitive keys (its upper levels): two classes meet if they agree in one of ``BANDS`` pairs
of minhash values. At similarities far below one those keys do most of the work: within a key, of few members, the budget is used up
only below the level at which the nodes are leaves. Pairs that are left are compared by 16 bits of each word run, which
can only add to what two sets share, and those that this doesn't settle by their texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.session import drop_table, materialise, sent_if_small, ship_package

BITS = 128
ROWS = 2
SIGMAS = 4.5
#: Members of a key that one task takes; those of larger groups go to the tasks of all pairs of such parts, once to each.
PART = 8192
#: Members walked as one trie, so that the walk's frontier stays small; a task walks all pairs of such pieces of its block.
PIECE = 1024
#: Share of the rows by which hot keys are looked for; this only spreads the work, no result depends on it.
HOT_SAMPLE = 1 / 16
#: The chance of a wrong verdict on a pair that is accepted without its texts.
DOUBT = 1e-9
#: Pairs of members, counted as group sizes squared, that are walked at once.
FRONTIER = 1 << 20
_OTHER_SPACES = re.compile("[\x0b\x1c-\x1f]")
_WORDS = re.compile("[^ \t\r\n\f]+").findall


def bands_for(threshold: float, miss: float = 1e-4) -> int:
    """How many keys of ``ROWS`` minhash values a pair at the threshold needs to miss all with probability ``miss``."""
    return min(BITS // ROWS, math.ceil(math.log(miss) / math.log(1 - threshold**ROWS)))


def budget_for(threshold: float) -> int:
    """The most differing bits of a pair at the threshold, but for ``SIGMAS`` standard deviations."""
    p = (1 - threshold) / 2
    return min(BITS, math.floor(BITS * p + SIGMAS * math.sqrt(BITS * p * (1 - p))))


def words_of(text: str) -> list[str]:
    """The longest runs of characters other than space, tab, CR, LF and FF."""
    if text.isascii() and not _OTHER_SPACES.search(text):
        return text.split()
    return _WORDS(text)


_rng = np.random.default_rng(20_240_607)
_XOR = _rng.integers(0, 2**32, BITS, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_BAND = _rng.integers(0, 2**63, BITS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _WordIds(dict):
    """Word -> 64-bit hash; bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) < 64:
            self[word] = h
        return h


def run_hashes(texts: list[str], width: int, ids: _WordIds) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the distinct word runs of each text, one after the other, and how many each text has."""
    all_ids: list[int] = []
    lengths = []
    for t in texts:
        words = words_of(t)
        lengths.append(len(words))
        all_ids += [ids[w] for w in words]
    n = np.array(lengths, dtype=np.int64)
    h = np.array(all_ids, dtype=np.uint64)
    if len(h) < width:
        return np.empty(0, np.uint64), np.zeros(len(n), np.int64)
    run = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        run += h[k : len(h) - width + 1 + k] * _MIX[k]
    run = _mix(run)
    ends = np.cumsum(n)
    keep = np.zeros(len(h) + 1, np.int32)
    starts, stops = ends - n, np.maximum(ends - n, ends - width + 1)
    np.add.at(keep, starts, 1)
    np.add.at(keep, stops, -1)
    mask = np.cumsum(keep)[: len(run)] > 0
    owner = np.repeat(np.arange(len(n)), n)[: len(run)][mask]
    run = run[mask]
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    first = np.ones(len(run), bool)
    first[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    return run[first], np.bincount(owner[first], minlength=len(n)).astype(np.int64)


def sketches(df: DataFrame, id_col: str, text_col: str, width: int, bands: int) -> DataFrame:
    """(id, set_a, set_b, n, f0, f1, keys, runs): the set's identity, its size, the fingerprint, the keys of the bands and 16 bits of each run.

    Texts with no run of words (null, empty, fewer than ``width`` words) give no row.
    """
    ship_package(df.sparkSession)
    kind = df.schema[id_col].dataType
    longs = ("set_a", "set_b", "n", "f0", "f1")
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in longs), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("runs", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        for whole in batches:
            for offset in range(0, whole.num_rows, 512):
                batch = whole.slice(offset, 512)
                hashes, n = run_hashes([t or "" for t in batch.column(1).to_pylist()], width, ids)
                at = np.flatnonzero(n)
                if not len(at):
                    continue
                n = n[at]
                starts = np.cumsum(n) - n
                small = (hashes >> np.uint64(32)).astype(np.uint32)
                mins = np.empty((BITS, len(at)), np.uint32)
                for k in range(BITS):
                    mins[k] = np.minimum.reduceat((small ^ _XOR[k]) * _MUL[k], starts)
                set_a = np.add.reduceat(hashes, starts)
                set_b = np.add.reduceat(_mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
                bits = (np.bitwise_count(mins) & 1).astype(np.uint64)
                weights = np.uint64(1) << np.arange(64, dtype=np.uint64)[::-1]
                f0, f1 = ((bits[h : h + 64].T * weights).sum(axis=1, dtype=np.uint64) for h in (0, 64))
                keys = np.stack([_mix((mins[2 * b].astype(np.uint64) << np.uint64(32) | mins[2 * b + 1]) ^ _BAND[b]) for b in range(bands)], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
                cols = [pa.array(c.view(np.int64)) for c in (set_a, set_b, n, f0, f1)]
                short = (hashes >> np.uint64(48)).astype("<u2")  # the runs of a text are sorted, so these are too
                bits16 = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(starts, len(hashes)).astype(np.int32) * 2), pa.py_buffer(short)])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *cols, lists, bits16], schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def trie_self_join(groups: np.ndarray, prints: np.ndarray, sides: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the groups whose fingerprints differ in at most ``budget`` bits.

    ``groups`` is sorted. Where a group has members of side 1, only pairs of side 0 with side 1 count. The tries
    of all groups are walked together, level by level: a node is a range of the sorted fingerprints, so that no
    tree is built. A pair of nodes of which neither branches any more is settled by the bits that are left.
    """
    order = np.lexsort((prints[:, 1], prints[:, 0], sides, groups))
    g, p, s = groups[order], prints[order], sides[order]
    n = len(g)
    new = np.ones(n, bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], n)
    two = np.flatnonzero((g[lo][1:] == g[lo][:-1])) if len(lo) > 1 else np.empty(0, np.int64)
    alone = np.ones(len(lo), bool)
    alone[two] = alone[two + 1] = False
    a_lo = np.concatenate([lo[alone], lo[two]])
    a_hi = np.concatenate([hi[alone], hi[two]])
    b_lo = np.concatenate([lo[alone], lo[two + 1]])
    b_hi = np.concatenate([hi[alone], hi[two + 1]])
    diff = np.zeros(len(a_lo), np.int16)
    equal = (p[1:] == p[:-1]).all(axis=1) & ~new[1:] if n > 1 else np.empty(0, bool)
    run_id = np.concatenate([[0], np.cumsum(~equal)]) if n else np.empty(0, np.int64)
    out_a, out_b = [], []
    for bit in range(BITS + 1):
        if not len(a_lo):
            break
        flat = (run_id[a_lo] == run_id[a_hi - 1]) & (run_id[b_lo] == run_id[b_hi - 1])
        if flat.any():  # neither branches: both are leaves
            x, y = p[a_lo[flat]], p[b_lo[flat]]
            near = np.bitwise_count(x ^ y).sum(axis=1) <= budget
            i0, i1, j0, j1 = (v[flat][near] for v in (a_lo, a_hi, b_lo, b_hi))
            wide = (i1 - i0) * (j1 - j0)
            which = np.repeat(np.arange(len(i0)), wide)
            k = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
            i, j = i0[which] + k // (j1 - j0)[which], j0[which] + k % (j1 - j0)[which]
            keep = (i0[which] != j0[which]) | (i < j)
            out_a.append(order[i[keep]])
            out_b.append(order[j[keep]])
            a_lo, a_hi, b_lo, b_hi, diff = (v[~flat] for v in (a_lo, a_hi, b_lo, b_hi, diff))
        if bit == BITS or not len(a_lo):
            break
        word, shift = p[:, bit // 64], np.uint64(63 - bit % 64)
        ones = np.concatenate([[0], np.cumsum((word >> shift) & np.uint64(1))]).astype(np.int64)
        # Within a node the fingerprints are sorted and share all earlier bits: its ones are at its end.
        a_mid, b_mid = a_hi - (ones[a_hi] - ones[a_lo]), b_hi - (ones[b_hi] - ones[b_lo])
        itself = a_lo == b_lo
        parts = []
        for (al, ah), (bl, bh), cost, ok in (
            ((a_lo, a_mid), (b_lo, b_mid), 0, None),
            ((a_mid, a_hi), (b_mid, b_hi), 0, None),
            ((a_lo, a_mid), (b_mid, b_hi), 1, None),
            ((a_mid, a_hi), (b_lo, b_mid), 1, ~itself),
        ):
            keep = (al < ah) & (bl < bh) & (diff + cost <= budget)
            keep &= (al != bl) | (ah - al > 1)
            if ok is not None:
                keep &= ok
            parts.append((al[keep], ah[keep], bl[keep], bh[keep], (diff + np.int16(cost))[keep]))
        a_lo, a_hi, b_lo, b_hi, diff = (np.concatenate(c) for c in zip(*parts))
    none = np.empty(0, np.int64)
    return (np.concatenate(out_a) if out_a else none), (np.concatenate(out_b) if out_b else none)


def candidates(reps: DataFrame, budget: int, threshold: float) -> DataFrame:
    """(a, b), a < b: pairs of classes that a trie join finds, each once. ``reps``: (id, n, f0, f1, keys)."""
    kind = reps.schema["id"].dataType
    rows = reps.select("id", "n", "f0", "f1", F.explode("keys").alias("key"))
    sizes = reps.sample(HOT_SAMPLE, seed=5).select(F.explode("keys").alias("key")).groupBy("key").agg((F.count("*") / HOT_SAMPLE).alias("members"))
    hot = sizes.where(F.col("members") > PART).select("key", F.ceil(F.col("members") / PART).cast("int").alias("parts"))
    hot = materialise(hot, "hot-keys")
    if hot.limit(1).count():
        rows = rows.join(hot, "key", "left")
        own = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        rows = rows.withColumn("own", own).withColumn("other", other)
        rows = rows.select("id", "n", "f0", "f1", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    else:
        rows = rows.select("id", "n", "f0", "f1", "key", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side"))
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def joined(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, low, high, side, n, ids = (t.column(c).to_numpy() for c in ("key", "low", "high", "side", "n", "id"))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        group = np.cumsum(new)
        size = np.bincount(group)[group]
        at = np.flatnonzero(size > 1)
        if not len(at):
            return
        prints = np.stack([t.column(c).to_numpy()[at].view(np.uint64) for c in ("f0", "f1")], axis=1)
        # As many tries at once as have a bounded number of pairs together, so that the walk's frontier stays small; large groups by themselves.
        work = np.cumsum(size[at].astype(np.int64)) // FRONTIER
        work += np.cumsum(np.where(new[at] & ((size[at] > 2 * PIECE) | np.append(False, size[at][:-1] > 2 * PIECE)), FRONTIER, 0))
        work = np.maximum.accumulate(np.where(new[at], work, 0))
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(work)) + 1):
            own = at[part]
            for i, j in pieces(group[own], prints[part], side[own] + 2 * (low[own] == high[own]), own):
                yield from found(i, j, n, ids)

    def pieces(group: np.ndarray, prints: np.ndarray, sides: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The walks of whole groups, or, of one that is too large, of all pairs of its pieces."""
        if len(own) <= 2 * PIECE or group[0] != group[-1]:
            i, j = trie_self_join(group, prints, sides, budget)
            yield own[i], own[j]
            return
        cut = lambda x: np.array_split(x, -(-len(x) // PIECE))
        a, b = (np.flatnonzero(sides == k) for k in (0, 1))
        if len(a) and len(b):
            pairs = [(x, y) for x in cut(a) for y in cut(b)]
        else:
            c = cut(np.arange(len(own)))
            pairs = [(x, None if k == m else c[m]) for k, x in enumerate(c) for m in range(k, len(c))]
        for x, y in pairs:
            both = x if y is None else np.concatenate([x, y])
            which = np.full(len(x), 2) if y is None else np.repeat([0, 1], [len(x), len(y)])
            i, j = trie_self_join(np.zeros(len(both), np.int64), prints[both], which, budget)
            yield own[both[i]], own[both[j]]

    def found(i: np.ndarray, j: np.ndarray, n: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        keep = (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])) & (ids[i] != ids[j])
        x, y = ids[i[keep]], ids[j[keep]]
        if len(x):
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # the last block of a batch may go on in the next one
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
            last = np.ones(batch.num_rows, bool)
            for c in cols:
                last &= c == c[-1]
            cut = batch.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield from joined(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("key", "low", "high")):
                yield from joined(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from joined(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema).distinct()


def shared(a: bytes, b: bytes) -> int:
    """How many members two sorted lists of 16-bit numbers have in common, repeats counted."""
    x, y = np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2")
    both = np.sort(np.concatenate([x.astype(np.uint32) << 1, (y.astype(np.uint32) << 1) | 1]), kind="stable")
    value, side = both >> 1, both & 1
    starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    ones = np.add.reduceat(side, starts)
    return int(np.minimum(ones, np.diff(np.append(starts, len(both))) - ones).sum())


def chance_matches(na: int, nb: int, common: int) -> int:
    """How many of the members in common may be so by chance, but for a probability of DOUBT."""
    mean = max(0, na - common) * max(0, nb - common) / 65_536
    term = total = math.exp(-mean)
    k = 0
    while 1 - total > DOUBT and k < common:
        k += 1
        term *= mean / k
        total += term
    return k


def compared(pairs: DataFrame, prints: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sure) of the pairs that can be as similar as the threshold: whether the 16 bits of each run settle it. ``prints``: (id, n, runs)."""
    kind = pairs.schema["a"].dataType
    both = pairs.join(prints.toDF("a", "n_a", "runs_a"), "a").join(prints.toDF("b", "n_b", "runs_b"), "b").select("a", "b", "n_a", "n_b", "runs_a", "runs_b")
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("sure", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sure = [], []
            for i, (na, nb, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)))):
                common = shared(x, y)
                if common >= threshold * (na + nb - common):
                    at.append(i)
                    least = common - chance_matches(na, nb, common)
                    sure.append(least >= threshold * (na + nb - least))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(sure, pa.bool_())], schema.names)

    return both.mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, id_col: str, text_col: str, width: int, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose sets of word runs are as similar as the threshold, by the texts themselves."""
    kind = pairs.schema["a"].dataType
    own = texts.select(F.col(id_col).alias("a"), F.col(text_col).alias("text_a"))
    both = pairs.join(own, "a").join(own.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def runs(text: str) -> set[tuple[str, ...]]:
        words = words_of(text)
        return set(zip(*(words[k:] for k in range(width))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                p, q = runs(x), runs(y)
                common = len(p & q)
                if common >= threshold * (len(p) + len(q) - common):
                    at.append(i)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], schema.names)

    return both.mapInArrow(run, schema)


def near_duplicates(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.6, width: int = 3) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the texts with a similarity of ``threshold`` or more.

    members (id, class_id): every text with at least ``width`` words and the least id of the texts with the same set
    of word runs. links (a, b): pairs of class ids, a < b. Null, empty and shorter texts, and rows without an id, are in neither.
    Ids must be integers; an id that comes twice with one text counts once.
    """
    bands, budget = bands_for(threshold), budget_for(threshold)
    df = df.where(F.col(id_col).isNotNull())
    rows = materialise(sketches(df, id_col, text_col, width, bands), "sketches")
    classes = rows.groupBy("set_a", "set_b").agg(F.min("id").alias("class_id"))
    members = materialise(rows.select("id", "set_a", "set_b").join(classes, ["set_a", "set_b"]).select("id", "class_id").distinct(), "members")
    once = (lambda x: x) if rows.count() == members.count() else (lambda x: x.dropDuplicates(["id"]))  # rows given twice
    copies = materialise(members.where("id <> class_id").select("id"), "copies")
    reps = once(rows.join(sent_if_small(copies), "id", "left_anti").select("id", "n", "f0", "f1", "keys"))
    reps = materialise(reps, "reps")
    pairs = materialise(candidates(reps, budget, threshold), "candidates")
    named = lambda p: p.select(F.col("a").alias("id")).union(p.select(F.col("b").alias("id"))).distinct()
    prints = once(rows.select("id", "n", "runs").join(sent_if_small(materialise(named(pairs), "named")), "id", "left_semi"))
    near = materialise(compared(pairs, prints, threshold), "compared")
    unsure = near.where("not sure").select("a", "b")
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sent_if_small(materialise(named(unsure), "unsure")), "id", "left_semi")
    links = materialise(near.where("sure").select("a", "b").unionByName(verified(unsure, texts, "id", "text", width, threshold)).distinct(), "links")
    return members, links


def pairs_of(members: DataFrame, links: DataFrame, names: tuple[str, str]) -> DataFrame:
    """All pairs of ids, the smaller first, within a class or of linked classes."""
    a, b = (members.toDF(f"id_{x}", f"class_{x}") for x in "ab")
    inside = a.join(b, F.col("class_a") == F.col("class_b")).where("id_a < id_b").select("id_a", "id_b")
    across = links.join(a, links["a"] == F.col("class_a")).join(b, links["b"] == F.col("class_b"))
    across = across.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return inside.unionByName(across).toDF(*names)


def groups_of(members: DataFrame, links: DataFrame, rounds: int = 50) -> DataFrame:
    """(id, class_id, group_id, n_links): the class, connected group and number of links of each text.

    Groups by distributed label propagation with pointer jumping; each round is written to the shared folder.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    degree = both.groupBy("a").agg(F.count("*").alias("n_links"))
    labels = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    both = materialise(both, "edges")
    last = None
    for _ in range(rounds):
        near = both.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
        jump = labels.toDF("label", "further")
        step = labels.join(near, "a").join(jump, "label", "left")
        before, new = labels, materialise(step.select("a", F.least("label", "near", "further").alias("label"), F.col("label").alias("old")), "labels")
        moved = new.where("label <> old").limit(1).count()
        if hasattr(before, "_leafmill_path"):
            drop_table(before)
        elif last is not None:
            drop_table(last)
        labels, last = new.select("a", "label"), new
        if not moved:
            break
    else:
        raise RuntimeError("the groups did not settle")
    out = members.join(labels.toDF("class_id", "label"), "class_id", "left").join(degree.withColumnRenamed("a", "class_id"), "class_id", "left")
    return out.select("id", "class_id", F.coalesce("label", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
