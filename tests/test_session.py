"""Intermediate tables of an application: one folder, and a way to drop it."""

from crowding import session
from crowding.sources import lake


def test_one_folder_holds_what_is_stored_by_the_way(spark, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda s: f"{session.shared_dir(s)}/crowding-test")
    paths = [session.scratch_path(spark, "a") for _ in range(2)]
    assert len(set(paths)) == 2
    for p in paths:
        spark.range(3).write.parquet(p)
    session.drop_scratch(spark)
    assert not any(lake.exists(spark, p) for p in paths) and lake.exists(spark, session.shared_dir(spark))
    session.drop_scratch(spark)  # nothing there is fine


def test_scratch_is_the_applications_own(spark):
    assert spark.sparkContext.applicationId in session.scratch_path(spark, "a")
