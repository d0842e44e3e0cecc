import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from oreflow.operators import runlog
from oreflow.operators.checks import ValidationFailed
from oreflow.schemas import RUN_EVENTS

T = datetime.datetime(2024, 1, 1)


def events(spark, *given):
    names = RUN_EVENTS.names
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in given], RUN_EVENTS)


def event(run, layer, step, minute, **known):
    return {"run_id": run, "layer": layer, "step": step, "event_time": T + datetime.timedelta(minutes=minute), **known}


def start(run, layer, step, minute):
    return event(run, layer, step, minute, started_at=T + datetime.timedelta(minutes=minute), status="STARTED")


def test_state_is_the_latest_known_value(spark):
    log = events(
        spark,
        start("r", "bronze", "a", 0),
        event("r", "bronze", "a", 1, status="SUCCESS", ended_at=T + datetime.timedelta(seconds=90), rows_written=5),
        event("r", "bronze", "a", 2, validation_status="FAILED", rows_written=6),
        start("r", "bronze", "b", 3),
    )
    got = {r["step"]: r for r in runlog.current_state(log).collect()}
    a = got["a"]
    assert (a["status"], a["validation_status"], a["rows_written"], a["run_time_ms"]) == ("SUCCESS", "FAILED", 6, 90000)
    assert (got["b"]["status"], got["b"]["run_time_ms"]) == ("STARTED", None)
    assert [r["step"] for r in runlog.unfinished(runlog.current_state(log)).collect()] == ["b"]


def test_latest_run_is_the_newest_over_all_layers(spark):
    log = events(
        spark,
        *[start("r1", layer, "s", i) for i, layer in enumerate(["bronze", "silver", "gold"])],
        start("r2", "bronze", "t", 11), start("r2", "bronze", "s", 10),
    )
    state = runlog.current_state(log)
    assert [(r["run_id"], r["step"]) for r in runlog.latest_run(state, "bronze").collect()] == [("r2", "s"), ("r2", "t")]
    assert runlog.latest_run(state, "silver").isEmpty() and runlog.latest_run(state, "gold").isEmpty()


def test_error_classes(rows):
    cases = [(17, 4800, "INFRASTRUCTURE"), (16, 4800, "INGESTION"), (16, 4899, "INGESTION"), (16, 4900, "OTHER"),
             (16, 2627, "DATA QUALITY"), (16, 208, "CODE"), (10, 1, "OTHER"), (None, None, "OTHER")]
    df = rows([(s, n, c) for s, n, c in cases], "s int, n int, c string")
    assert df.where(runlog.error_class(F.col("s"), F.col("n")) != F.col("c")).isEmpty()


def failure(job):
    with pytest.raises(Exception) as caught:
        job()
    return runlog.exception_class(caught.value)


def test_exception_classes(spark, tmp_path):
    assert failure(lambda: spark.read.parquet(str(tmp_path / "none"))) == "INGESTION"
    assert failure(lambda: spark.sql("SELECT nothing_here")) == "CODE"
    assert failure(lambda: spark.sql("SELEC 1")) == "CODE"
    assert failure(lambda: spark.sql("SELECT cast('x' AS int)").collect()) == "DATA QUALITY"
    assert runlog.exception_class(ValidationFailed("l", [])) == "DATA QUALITY"
    assert runlog.exception_class(MemoryError()) == "INFRASTRUCTURE"
    assert runlog.exception_class(KeyError("x")) == "OTHER"


def test_append_adds_without_touching_what_is_there(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append(spark, path, [{"run_id": "r", "layer": "bronze", "step": "s", "status": "STARTED"}])
    runlog.append(spark, path, [{"run_id": "r", "layer": "bronze", "step": "s", "status": "FAILED"}])
    assert runlog.read(spark, path).count() == 2
    assert runlog.current_state(runlog.read(spark, path)).first()["status"] == "FAILED"


def known(step, status="STARTED"):
    return {"run_id": "r", "layer": "bronze", "step": step, "status": status}


def steps_of(spark, path):
    return sorted(r["step"] for r in runlog.current_state(runlog.read(spark, path)).collect())


def test_compaction_keeps_every_event_and_few_files(spark, tmp_path):
    path = str(tmp_path / "lo g%")
    for n in range(6):
        runlog.append(spark, path, [known(f"s{n}"), known("both", "SUCCESS" if n == 5 else "STARTED")])
    before = sorted(map(str, runlog.read(spark, path).collect()))
    assert runlog.compact(spark, path) == 6
    assert sorted(map(str, runlog.read(spark, path).collect())) == before
    assert len(runlog.read(spark, path).inputFiles()) == 1 and len(list((tmp_path / "lo g%").iterdir())) == 1
    assert runlog.compact(spark, path) == 0


def test_appends_during_a_compaction_are_kept(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(3):
        runlog.append(spark, path, [known(f"early{n}")])
    with ThreadPoolExecutor(4) as pool:
        late = [pool.submit(runlog.append, spark, path, [known(f"late{n}")]) for n in range(9)]
        while not all(f.done() for f in late):
            runlog.compact(spark, path)
        [f.result() for f in late]
    runlog.compact(spark, path)
    assert steps_of(spark, path) == [f"early{n}" for n in range(3)] + [f"late{n}" for n in range(9)]
    assert runlog.read(spark, path).count() == 12


def test_a_compaction_that_died_changes_no_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for n in range(3):
        runlog.append(spark, path, [known(f"s{n}")])

    def die(*_):
        raise OSError("no")

    with monkeypatch.context() as patched:
        patched.setattr(runlog, "delete_folder", die)
        with pytest.raises(OSError):
            runlog.compact(spark, path)
    assert runlog.read(spark, path).count() == 6 and steps_of(spark, path) == ["s0", "s1", "s2"]
    runlog.compact(spark, path)
    assert runlog.read(spark, path).count() == 3 and steps_of(spark, path) == ["s0", "s1", "s2"]
