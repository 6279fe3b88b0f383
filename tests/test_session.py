"""Intermediate tables: where they lie, and that they go."""

import os

import pytest

from leafmill import session as S


def test_intermediates_are_removed(spark):
    with S.intermediates(spark):
        df = S.materialise(spark.range(10), "ten")
        path = df._leafmill_path.removeprefix("file://")
        assert os.path.isdir(path) and df.count() == 10
    assert not os.path.isdir(path)
    df = S.materialise(spark.range(3), "three")
    S.drop_table(df)
    assert not os.path.isdir(df._leafmill_path.removeprefix("file://"))
    S.drop_table(df)  # once more does nothing


def test_named_folder_is_used(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "shared_folder", lambda s: f"file://{tmp_path}")
    S.materialise(spark.range(3), "three")
    assert [x.startswith("three-") for x in os.listdir(tmp_path)] == [True]
    S.drop_intermediates(spark)
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize(("master", "named", "ok"), [("local[8]", None, True), ("local", None, True), ("local-cluster[3,2,3000]", None, False), ("yarn", None, False), ("yarn", "file:///shared/", True)])
def test_no_local_folder_on_a_cluster(master, named, ok):
    class Context:
        pass

    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return named or default

        sparkContext = Context()

    Session.sparkContext.master = master
    if ok:
        assert S.shared_folder(Session).startswith("file://") and (named is None or S.shared_folder(Session) == "file:///shared")
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            S.shared_folder(Session)


def test_lists_of_ids_are_sent_only_up_to_a_count(spark, monkeypatch):
    ids, rows = spark.range(50), spark.range(100)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(rows.join(S.sent_if_small(ids), "id", "left_semi")).lower()
    monkeypatch.setattr(S, "SENT_ROWS", 49)
    assert "broadcast" not in plan(rows.join(S.sent_if_small(ids), "id", "left_semi")).lower()


def test_free_names():
    assert S.free_name(["a", "N", "n_"], "n") == "n__"
