"""Container plans and placements: nothing lost, nothing over, little unused."""

import os
import random

import pytest

from leafmill.llm import bpe, packing
from leafmill.session import tokenizer_folder


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 30, 100, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, 300) for _ in range(rng.randint(0, 50))}
    runs, bins = packing.plan(dict(counts), capacity)
    load, done = [0] * bins, {}
    for size, first, container, many, each in runs:
        assert first == done.get(size, 0)
        done[size] = first + many * each
        for b in range(container, container + many):
            load[b] += size * each
    assert done == counts
    assert max(load, default=0) <= capacity and min(load, default=1) > 0


def test_plan_is_tight():
    rng = random.Random(1)
    counts: dict[int, int] = {}
    for _ in range(50_000):
        s = min(2048, max(1, int(rng.lognormvariate(5.5, 1.0))))
        counts[s] = counts.get(s, 0) + 1
    _, bins = packing.plan(dict(counts), 2048)
    assert bins <= 1.002 * sum(s * n for s, n in counts.items()) / 2048 + 1


def test_too_large_items_are_refused():
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


@pytest.mark.skipif(not os.path.isdir(tokenizer_folder()), reason="no vocabularies")
def test_pack(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["word"] * rng.randint(1, 45)), "x") for i in range(300)] + [(i, "word", "x") for i in range(300, 500)]
    rows += [(500, None, "x"), (501, "", "x"), (502, " ".join(["a"] * 95), "x"), (503, " ".join(["a"] * 40), "x"), (0, rows[0][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(7)
    got = packing.pack(df, "doc_id", "text", 20).collect()
    size, pieces = {}, {}
    for r in got:
        size[r["container_no"]] = size.get(r["container_no"], 0) + r["piece_tokens"]
        pieces.setdefault(r["doc_id"], []).append((r["piece_no"], r["piece_tokens"]))
    assert max(size.values()) <= 20
    assert {d for _, d, *_ in []} | set(pieces) == {r[0] for r in rows}
    assert [t for _, t in sorted(pieces[502])] == [20, 20, 20, 20, 15]
    assert [t for _, t in sorted(pieces[503])] == [20, 20]
    for i, text, _ in rows[1:]:
        n = bpe.encoder().count(text)
        assert sum(t for _, t in pieces[i]) == n * (2 if i == 0 else 1)
        assert len(pieces[i]) == max(1, -(-n // 20)) or i == 0
    assert len([1 for r in got if r["doc_id"] == 0]) == 2 * max(1, -(-bpe.encoder().count(rows[0][1]) // 20))
    assert packing.pack(df.where("false"), "doc_id", "text", 20).count() == 0
    assert [r["container_no"] for r in packing.pack(df.where("doc_id in (500, 501)"), "doc_id", "text", 20).collect()] == [0, 0]
