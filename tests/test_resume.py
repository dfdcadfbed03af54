"""Cutting period by period against one cut, and the counts of a run."""

import pytest
from helpers import SCHEMA, code_frame, log_row, random_log, single_log
from test_sources import job_files

from logstats import scratch
from logstats.operators import exams, resume
from logstats.plans import job, run_report
from logstats.settings import Settings

SETTINGS = Settings(service_gap_s=6, max_exam_s=30)


def _segments(rows):
    return sorted(map(tuple, resume.segments_of(rows).collect()))


def _kept(rows):
    return sorted((r["event_key"], r["exam_id"]) for r in rows.filter("kept").collect())


@pytest.mark.parametrize("max_rows", [1000, 9])
def test_periods_give_what_one_cut_gives(spark, tmp_path, max_rows):
    settings = Settings(service_gap_s=6, max_exam_s=30, max_group_rows=max_rows)
    log = spark.createDataFrame(random_log(5, 6, 250, 100, hot=60), SCHEMA).checkpoint()
    codes = code_frame(spark)
    whole = exams.cut_exams(log, codes, settings, True).checkpoint()
    state, rows = None, None
    # The first and the third period are empty; the second and the last are not.
    for n, (low, high) in enumerate([(-9, 0), (0, 70), (70, 70), (70, 140), (140, 999)]):
        part = log.filter((log.tick >= low) & (log.tick < high))
        period = resume.cut_next(part, codes, state, settings)
        resume.write_state(period.state, str(tmp_path / f"state{n}"))
        state = resume.read_state(spark, str(tmp_path / f"state{n}"))
        rows = period.rows if rows is None else rows.unionByName(period.rows)
        assert not (set(r[0] for r in rows.filter("is_start").select("exam_id").collect())
                    & set(r[0] for r in state.pending.select("exam_id").collect()))
    rows = rows.unionByName(state.pending.drop("in_limit")).checkpoint()
    assert _segments(rows) == _segments(whole)
    assert _kept(rows) == _kept(whole)


def test_a_service_after_an_open_start_does_not_make_it_a_service_start(spark):
    codes = code_frame(spark)
    first = single_log(spark, ("START", 0), ("MON", 1), ("SVC", 2))
    state = resume.cut_next(first, codes, None, SETTINGS).state
    assert [r["outcome"] for r in state.pending.filter("is_start").collect()] == ["open_at_end"]
    second = spark.createDataFrame([log_row("1", "STOP", 3, 10)], SCHEMA)
    period = resume.cut_next(second, codes, state, SETTINGS)
    assert [s[-1] for s in _segments(period.rows)] == ["stopped"]
    assert period.state.pending.isEmpty()
    # The machine's last service is still known to the period after.
    third = spark.createDataFrame([log_row("1", "START", 7, 11)], SCHEMA)
    later = resume.cut_next(third, codes, period.state, SETTINGS)
    assert [s[-1] for s in _segments(later.rows)] == ["service"]


def test_rows_that_come_late_are_left_out_and_told(spark):
    codes = code_frame(spark)
    state = resume.cut_next(single_log(spark, ("START", 10), ("MON", 12)), codes, None, SETTINGS).state
    rows = [log_row("1", "STOP", 11, 5), log_row("1", "MON", 12, 1), log_row("1", "MON", 13, 6), log_row("2", "MON", 1, 7)]
    again = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["tick"] for r in resume.late_rows(again, codes, state).collect()) == [11.0, 12.0]
    period = resume.cut_next(again, codes, state, SETTINGS)
    assert period.rows.isEmpty()
    assert sorted(r["tick"] for r in period.state.pending.collect()) == [10.0, 12.0, 13.0]


def test_diagnostics_need_no_checkpoint(spark, tmp_path, monkeypatch):
    calls = []
    for module in (exams, job):
        monkeypatch.setattr(module, "checkpointed", lambda rows: calls.append(1) or scratch.checkpointed(rows), raising=False)
    monkeypatch.setattr("logstats.operators.groups.checkpointed", lambda rows: calls.append(1) or scratch.checkpointed(rows))
    files = job_files(tmp_path)
    run_report(spark, report_path=str(tmp_path / "a"), metrics_path=str(tmp_path / "m"), **files)
    assert not calls
    plain = run_report(spark, report_path=str(tmp_path / "b"), **files)
    assert sorted((tmp_path / "a.csv").glob("part*"))[0].read_text() == sorted((tmp_path / "b.csv").glob("part*"))[0].read_text()
    assert plain.first().num_sys == 1


def test_diagnostics_of_an_empty_log(spark, tmp_path):
    files = job_files(tmp_path)
    run_report(
        spark, report_path=str(tmp_path / "a"), metrics_path=str(tmp_path / "m"), start_date="2999-01-01", **files
    )
    found = spark.read.schema("stage string, n long").csv(str(tmp_path / "m.csv"), header=True).collect()
    assert len(found) == 13 and {r["n"] for r in found} == {0}
