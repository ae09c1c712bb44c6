"""Intermediate data: where it lies, what it keeps, and that it goes."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseload import session


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    held = session._made.pop(spark.sparkContext.applicationId, [])
    yield tmp_path
    session._made[spark.sparkContext.applicationId] = held


def test_settled_frames_prune_and_push(spark, folder):
    kept = session.settle(spark.range(100).select("id", (F.col("id") % 3).alias("a"), F.lit("x").alias("b")))
    plan = planned(kept.filter("a = 1").select("id"))
    assert "EqualTo(a,1)" in plan and "struct<id:bigint,a:bigint>" in plan
    assert kept.count() == 100


def test_release_empties_the_folder(spark, folder):
    session.settle(spark.range(5))
    spark.range(5).write.parquet(session.fresh_path(spark, "more"))
    assert len(list(Path(folder).iterdir())) == 2
    assert session.release(spark) == 2
    assert list(Path(folder).iterdir()) == []
    assert session.release(spark) == 0


def test_a_cluster_needs_the_setting():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            applicationId, master = "app-none", ""

    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077"):
        Session.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(Session)
    Session.sparkContext.master = "local[2]"
    own = session.shared_folder(Session)
    assert Path(own).is_dir() and session.shared_folder(Session) == own
