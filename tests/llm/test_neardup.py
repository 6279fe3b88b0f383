"""Near-duplicates against brute force; the trie walk against all pairs."""

import random

import numpy as np
import pytest

from leafmill.llm import neardup as N


@pytest.mark.parametrize("seed", range(6))
def test_trie_walk_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = 160
    prints = rng.integers(0, 2**63, (n, 2), dtype=np.uint64)
    for i in range(0, n, 2):  # some near ones, some equal
        prints[i] = prints[i // 2]
        for b in rng.integers(0, 128, rng.integers(0, 60)):
            prints[i, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    groups = np.sort(rng.integers(0, 6, n))
    sides = np.where(groups < 3, rng.integers(0, 2, n), 2)
    i, j = N.trie_self_join(groups, prints, sides, 40)
    got = {frozenset(p) for p in zip(i.tolist(), j.tolist())}
    assert len(got) == len(i)
    want = {
        frozenset((a, b)) for a in range(n) for b in range(a)
        if groups[a] == groups[b] and int(np.bitwise_count(prints[a] ^ prints[b]).sum()) <= 40
        and (groups[a] >= 3 or sides[a] != sides[b] or len(set(sides[groups == groups[a]].tolist())) == 1)
    }
    assert got == want


def brute(rows, t=0.6):
    runs = {}
    for i, x in rows:
        w = N._WORDS(x or "")
        if s := set(zip(w, w[1:], w[2:])):
            runs[i] = s
    return {(a, b) for a in runs for b in runs if a < b and len(runs[a] & runs[b]) >= t * len(runs[a] | runs[b])}


def texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 150))] for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 12))):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i * 3, rng.choice([" ", "\r\n", "\t", "  "]).join(w)))
    return rows


@pytest.mark.parametrize(("seed", "part", "doubt"), [(1, N.PART, N.DOUBT), (2, 6, N.DOUBT), (3, 16, 0.0)])
def test_pairs_equal_brute_force(spark, monkeypatch, seed, part, doubt):
    monkeypatch.setattr(N, "PART", part)  # the second case walks hot keys in blocks
    monkeypatch.setattr(N, "PIECE", 4 if part < N.PART else N.PIECE)  # and large blocks in pieces
    monkeypatch.setattr(N, "HOT_SAMPLE", 0.9)
    monkeypatch.setattr(N, "DOUBT", doubt)  # the third asks the texts of all pairs
    rows = texts(seed) + [(1000, None), (1001, ""), (1002, "a b"), (1003, "a b c"), (1004, "a  b\nc"), (1005, "a\x0bb c d"), (1006, "a b c d")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, body string, class_id int")
    members, links = N.near_duplicates(df, "page_id", "body")
    got = [tuple(r) for r in N.pairs_of(members, links, ("a", "b")).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)
    groups = {r["id"]: r["group_id"] for r in N.groups_of(members, links).collect()}
    for a, b in got:
        assert groups[a] == groups[b]
    assert groups[1003] == groups[1004] == 1003


def test_sixteen_bits_of_each_run():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.sort(rng.integers(0, 40, rng.integers(0, 60))).astype("<u2") for _ in range(2))
        want = sum(min(int((a == v).sum()), int((b == v).sum())) for v in range(40))
        assert N.shared(a.tobytes(), b.tobytes()) == want if len(a) + len(b) else True
    assert N.chance_matches(100, 100, 100) == 0  # nothing is left that could match by chance
    assert 2 <= N.chance_matches(150, 150, 100) <= 6 < N.chance_matches(4000, 4000, 3000)


def test_empty_tables_and_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, "a b c d")], "page_id long, body string")
    members, links = N.near_duplicates(df, "page_id", "body")
    assert sorted(map(tuple, N.pairs_of(members, links, ("a", "b")).collect())) == [(5, 6)]
    members, links = N.near_duplicates(df.where("false"), "page_id", "body")
    assert N.pairs_of(members, links, ("a", "b")).count() == 0 and N.groups_of(members, links).count() == 0
