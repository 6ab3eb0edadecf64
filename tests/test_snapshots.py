"""Versioned tables, the feedback job, replays, failures and conflicts."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesloom.plans import feedback
from salesloom.sources import tables
from salesloom.sources.snapshots import Conflict, Snapshots

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture()
def db(spark):
    name = f"snap{random.randrange(10 ** 9)}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def failing(spark):
    return spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")).alias("id"))


def test_versions_follow_each_other(spark, tmp_path):
    kept = Snapshots(spark, str(tmp_path / "t"))
    assert kept.current() is None
    with pytest.raises(LookupError):
        kept.read()
    assert kept.write(spark.range(3)) == 1 and kept.read().count() == 3
    assert kept.write(kept.read().where("id > 0")) == 2  # from the current one
    assert kept.read().count() == 2 and kept.read(1).count() == 3
    with pytest.raises(PySparkException):
        kept.write(failing(spark))
    assert kept.current() == 2 and kept.read().count() == 2
    with pytest.raises(Conflict):
        kept.write(spark.range(9), after=1)
    (tmp_path / "t/commits/00000003").touch()  # a writer that died at its commit
    assert kept.current() == 2 and kept.write(spark.range(5)) == 4
    kept.vacuum(1)
    assert list(kept.versions()) == [4] and kept.read().count() == 5
    assert len(list((tmp_path / "t/data").iterdir())) == 1


def test_two_writers_of_one_version(spark, tmp_path):
    kept = Snapshots(spark, str(tmp_path / "t"))
    kept.write(spark.range(1))
    (tmp_path / "t/commits/00000002").write_text("another")
    with pytest.raises(Conflict):
        Snapshots(spark, str(tmp_path / "t")).write(spark.range(2), after=1)


def test_a_failed_replacement_leaves_the_table(spark, db):
    name = f"{db}.t"
    tables.replace_table(spark.range(10), name)
    tables.replace_table(spark.table(name).where("id < 4"), name)
    assert spark.table(name).count() == 4
    with pytest.raises(PySparkException):
        tables.replace_table(failing(spark), name)
    assert spark.table(name).count() == 4
    tables.replace_table(spark.table(name).withColumn("more", F.lit("x")), name)
    assert spark.table(name).where("more = 'x'").count() == 4
    with pytest.raises(ValueError):
        tables.replace_table(spark.range(3).select(F.col("id").cast("string").alias("id")), name)


CALLS = "customer_id string, seller string, status string, comment string, recorded_at string, reference string"


def calls(spark, *rows):
    return spark.createDataFrame(rows, CALLS).withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))


def state(log):
    return {r["customer_id"]: (r["seller"], r["status"], r["recorded_by"]) for r in log.latest().collect()}


def test_feedback_job(spark, tmp_path, db):
    log = feedback.FeedbackLog(spark, str(tmp_path / "calls"), f"{db}.call_feedback")
    first = calls(spark, ("1", "ann", "vai_pensar", None, "2024-06-01 10:00:00", "2024-06-01"),
                  ("1", "ann", "vendeu", None, "2024-06-01 11:00:00", "2024-06-01"),
                  ("2", "bob", "nonsense", None, "2024-06-01 11:00:00", None),
                  (" 3 ", "bob", "nao_atendeu", "x", "2024-06-01 12:00:00", None))
    assert log.record(first, AS_OF).count() == 1
    assert state(log) == {1: ("ann", "vendeu", "ann"), 3: ("bob", "nao_atendeu", "bob")}
    second = calls(spark, ("1", "cid", "sem_interesse", None, "2024-06-02 09:00:00", "2024-06-02"),
                   ("3", "cid", "vendeu", None, "2024-05-01 09:00:00", "2024-06-02"))
    log.record(second, AS_OF)
    want = {1: ("ann", "sem_interesse", "cid"), 3: ("bob", "nao_atendeu", "bob")}
    assert state(log) == want and log.history().count() == 5
    for again in (first, second, first):  # replays change nothing
        log.record(again, AS_OF)
        assert state(log) == want and log.history().count() == 5
    assert spark.table(f"{db}.call_feedback").count() == 2
    assert {p.name for p in (tmp_path / "calls/history").iterdir() if p.is_dir()} == {
        "reference=2024-06-01", "reference=2024-06-02", "reference=2024-06-30"}


def test_feedback_job_that_died_before_filing(spark, tmp_path, monkeypatch):
    log = feedback.FeedbackLog(spark, str(tmp_path / "calls"))
    batch = calls(spark, ("1", "ann", "vendeu", None, "2024-06-01 10:00:00", "2024-06-01"))
    path = log.history_path
    monkeypatch.setattr(log, "history_path", "/proc/nowhere")
    with pytest.raises(Exception):
        log.record(batch, AS_OF)
    monkeypatch.setattr(log, "history_path", path)
    log.record(batch, AS_OF)
    assert state(log) == {1: ("ann", "vendeu", "ann")} and log.history().count() == 1
