"""Choice, conflicts, reviews, captures and compaction on small cases."""

import os
import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import compact as C
from leafmill.operators import resolve as R

FILES = "file_id long, page_id long, piece_no int, payload string, range_no int, content_bytes string"
AT = {"at": "range_no"}
ARGS = {"keys": ["page_id", "piece_no"], "content": "payload", "id_col": "file_id", "group": "page_id", "number": "piece_no"}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_choose_and_conflicts(spark):
    df = spark.createDataFrame([("s", "net", "b"), ("s", " CE", "a"), ("s", None, "c"), ("t", None, None), (None, "ce", "z")], "k string, layer string, v string")
    got = R.choose(df, ["k"], [R.rank_of("layer", ["ce", "net"]), F.col("v")], ["v"])
    assert rows_of(got) == sorted([("s", "a"), ("t", None), (None, "z")], key=repr)
    assert rows_of(R.conflicts(df, "k", "v")) == [("s", "a", 3), ("s", "b", 3), ("s", "c", 3)]


def test_reviews(spark):
    names = spark.createDataFrame([("AB_X", 0x1005), ("AB_Y", 0x1010), ("Q", 0x1FFF), ("R", None)], "n string, v long")
    rev = spark.createDataFrame([("name", "AB_X", "x.h", "reject"), ("prefix", "A", "a.h", "approve"), ("prefix", "AB_", "ab.h", "approve"), ("prefix", "", "no.h", "prefer"), ("value-base", "0x1000", "v.h", "approve")], "review_scope string, review_key string, header_file string, verdict string")
    got = {r["name"]: (r["header_file"], r["review_scope"]) for r in R.reviewed_headers(names, "n", "v", rev).collect()}
    assert got == {"AB_X": ("x.h", "name"), "AB_Y": ("ab.h", "prefix"), "Q": ("v.h", "value-base")}
    assert R.reviewed_headers(names, "n", "v", rev.where("false")).count() == 0


def test_adopt_agree_gaps(spark):
    own = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    ext = spark.createDataFrame([("b", "3"), ("c", "4")], "k string, v string")
    assert rows_of(R.adopt(own, ext, "k", "ext")) == sorted([("a", "1", None), ("b", "2", None), ("c", "4", "ext")], key=repr)
    assert tuple(R.agreement(own, ext, "k", "v").first()) == (0, 1)
    assert rows_of(R.gap_list(ext, own, "k", ext, "v")) == [("c", "4")]
    assert rows_of(R.compare_captures(own, ext, "k", "v")) == [("a", "removed"), ("b", "changed"), ("c", "added")]
    assert rows_of(R.unprinted(own, ext, ["k", "v"])) == [("a", "1"), ("b", "2")]


def test_suffix_pairs(spark):
    df = spark.createDataFrame([("OpenW",), ("OpenA",), ("DATA",), ("RAW",), ("LoneW",)], "s string")
    assert rows_of(R.suffix_pairs(df, "s")) == [("Open", "OpenW", "OpenA")]


@pytest.mark.parametrize("seed", range(2))
def test_collapsed_runs_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("ab" if i % 3 else "a"), i, rng.choice(["x", "y", None])) for i in range(400)]
    rng.shuffle(data)
    got = R.collapse_runs(spark.createDataFrame(data, "g string, t long, v string"), "g", ["t"], "v")
    want, last = [], {}
    for g, t, v in sorted(data):
        if g not in last or last[g] != v:
            want.append((g, t, v))
        last[g] = v
    assert rows_of(got) == sorted(want, key=repr)
    assert R.collapse_runs(spark.createDataFrame([], "g string, t long, v string"), "g", ["t"], "v").count() == 0


def stored(spark):
    return spark.createDataFrame(
        [
            (1, 10, 0, "ab", None, "u"), (2, 10, 0, "ab ", None, "u"), (3, 10, 1, "cd", 4, "u"), (4, 10, None, "cd", None, None), (5, 10, None, "zz", None, "u"),
            (6, 10, None, "zz", None, "u"), (7, None, 0, "ab", None, "u"), (8, None, None, None, None, "u"), (9, 11, None, None, None, "u"), (10, 11, None, None, None, "u"), (11, 11, 3, "", None, "u"),
        ],
        FILES,
    )


def test_same_records(spark):
    got = C.same_records(stored(spark), target_bytes=4, **ARGS)
    assert rows_of(got) == [(1, 2), (3, 4), (5, 6)]
    assert C.same_records(stored(spark).where("false"), target_bytes=4, **ARGS).count() == 0


def test_compact(spark, tmp_path):
    src, rng = str(tmp_path / "small"), random.Random(1)
    rows = [(i, i // 40 if i % 3 else -7, i % 40 if i % 3 else i, "x" * rng.randint(0, 300), None, None) for i in range(1500)]
    spark.createDataFrame(rows, FILES).repartition(60).write.parquet(src)
    got = C.compact(spark.read.parquet(src), src, target_bytes=40_000, **ARGS, **AT)
    assert (got.rows_read, got.rows_written, got.copies_dropped) == (1500, 1500, 0)
    files = [f for f in os.listdir(src) if f.startswith("part")]
    assert len(files) == got.ranges == -(-got.bytes_read // 40_000)
    back = spark.read.parquet(src).withColumn("f", F.col("_metadata.file_name"))
    assert sorted(r["file_id"] for r in back.collect()) == list(range(1500))
    sizes = [r["b"] for r in back.groupBy("f").agg(F.sum(F.length("payload")).alias("b")).collect()]
    assert max(sizes) < 2 * 40_000  # though one page holds a third of all rows
    assert not [f for f in os.listdir(tmp_path) if ".old-" in f or ".new-" in f]


def test_compact_keeps_each_record_once(spark, tmp_path):
    out = str(tmp_path / "out")
    got = C.compact(stored(spark), out, target_bytes=4, **ARGS, **AT)
    assert (got.rows_read, got.rows_written) == (11, 8)
    assert sorted(r["file_id"] for r in spark.read.parquet(out).collect()) == [1, 3, 5, 7, 8, 9, 10, 11]
    got = C.compact(stored(spark).where("false"), out, target_bytes=4, **ARGS, **AT)
    assert got.rows_written == 0 and spark.read.schema(FILES).parquet(out).count() == 0
    later = stored(spark).withColumn("range_no", F.when(F.col("file_id") == 1, 9).otherwise(F.col("file_id").cast("int")))
    assert C.compact(later, out, target_bytes=4, **ARGS, **AT).rows_written == 8
    assert sorted(r["file_id"] for r in spark.read.parquet(out).collect()) == [2, 3, 5, 7, 8, 9, 10, 11]
    nameless = stored(spark).withColumn("file_id", F.lit(None).cast("long"))
    assert C.compact(nameless, out, target_bytes=4, **ARGS, **AT).rows_written == 11


def test_compact_thousands_of_real_files(spark, tmp_path):
    from leafmill.sources.readers import stored_files

    src, rng = tmp_path / "store", random.Random(4)
    want = {}
    for page in range(120):
        folder = src / f"{page % 7}" / "deep"
        folder.mkdir(parents=True, exist_ok=True)
        for piece in range(25):
            text = f"größe {page} {piece} " + "x" * rng.randint(0, 60)
            want[page, piece] = text
            (folder / f"{page}-{piece}.txt").write_text(text, encoding="utf-8")
            if piece % 9 == 0:
                (folder / f"{page}-{piece}-again.txt").write_text(text, encoding="utf-8")
        (folder / f"{page}-.txt").write_text(want[page, 3], encoding="utf-8")  # a retry that lost its number
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    got = C.compact(stored_files(spark, str(src)), out, target_bytes=30_000, **ARGS, at="written_at")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (got.rows_read, got.rows_written) == (120 * 29, 120 * 25)
    assert len([f for f in os.listdir(out) if f.startswith("part")]) == got.ranges < 10
    assert {(r["page_id"], r["piece_no"]): r["payload"] for r in spark.read.parquet(out).collect()} == want


@pytest.mark.parametrize("state", ["new is checked", "old aside, new is checked", "new is checked, old stays", "new is a part", "old aside alone", "old beside"])
def test_interrupted_swaps(spark, tmp_path, state):
    path = str(tmp_path / "t")
    write = lambda name, v, done=False: (spark.range(v, v + 1).write.parquet(name), done and open(f"{name}/{C.CHECKED}", "w").close())
    if "checked" in state or "part" in state:
        write(f"{path}.new", 2, "checked" in state)
    if not state.startswith("old aside"):
        write(path, 1)
    if state.startswith("old aside") or "old stays" in state or "beside" in state:
        write(f"{path}.old", 0 if "old a" not in state else 1)
    C.recover(spark, path)
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [2 if "checked" in state else 1]
    assert os.listdir(tmp_path) == ["t"]


def test_rows_are_read_twice(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(3000).selectExpr("id as file_id", "id % 50 as page_id", "cast(id as int) as piece_no", "cast(id as string) as payload", "0 as range_no", "'' as content_bytes")
    df = df.mapInArrow(count, df.schema)
    C.compact(df, str(tmp_path / "out"), target_bytes=2000, **ARGS, **AT)
    assert seen.value <= 2 * 3000


def test_verify_stored(spark):
    receipts = spark.createDataFrame([("a", 1, "AA"), ("b", 2, "bb"), ("c", None, None), ("d", 4, "dd"), (None, 1, "x")], "stored_path string, n_bytes long, sha256_hex string")
    files = spark.createDataFrame([("a", 1, "aa"), ("b", 3, "bb"), ("c", 9, "cc")], "path string, n_bytes long, sha256_hex string")
    assert rows_of(R.verify_stored(receipts, files)) == [("a", "same"), ("b", "other size"), ("c", "same"), ("d", "missing")]
