from logstats import schemas, sources
from logstats.operators import catalog, cleaning
from logstats.plans import read_log, run_report
from logstats.settings import Settings

WIDTH = len(schemas.MACHINE_LOG.names)


def line(**values):
    return ",".join(values.get(name, "x") for name in schemas.MACHINE_LOG.names)


def test_log_quotes_and_empties(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(
        "\n".join(
            [
                line(msg_text="~a, \"b\" c~", time_seq="1.5"),
                line(tag="", msg_text="~~"),
                ",".join(["y"] * (WIDTH - 2)),
            ]
        )
    )
    first, second, third = sources.read_machine_log(spark, str(path)).collect()
    assert first.msg_text == 'a, "b" c' and first.time_seq == "1.5"
    assert second.tag is None and second.msg_text is None
    assert third.msg_date is None and third.dl_load_date is None and third.host_name == "y"


def test_tables_with_and_without_header(spark, tmp_path):
    (tmp_path / "systems.csv").write_text("s1\ns2\n")
    (tmp_path / "weights.csv").write_text("level,wt\nL1,0.5\nL2,\n")
    (tmp_path / "codes.csv").write_text(
        "error_code,description,action,level\n1, Service Exam a,Start,L1\n2,Non Service Exam,Stop,L2\n"
    )
    systems = sources.read_system_list(spark, str(tmp_path / "systems.csv"))
    assert [r.sysid for r in systems.collect()] == ["s1", "s2"]
    weights = sources.read_level_weights(spark, str(tmp_path / "weights.csv"))
    assert [tuple(r) for r in weights.collect()] == [("L1", "0.5"), ("L2", None)]
    codes = sources.read_code_actions(spark, str(tmp_path / "codes.csv"))
    found = {tuple(r) for r in catalog.code_categories(codes).collect()}
    assert ("1", "ServiceExam") in found and ("2", "ServiceExam") not in found
    assert ("2", "NonServiceExam") in found


def test_report_file(spark, tmp_path):
    data = [("1", 1.5, None, 2, 3, 4, 10.25, 5.0), ("2", 0.0, 1.0, 0, 0, 1, 7.0, 6.0)]
    report = spark.createDataFrame(data, schemas.MACHINE_REPORT).repartition(4)
    written = sources.write_report(report, str(tmp_path / "out"), "_s")
    assert written.endswith("out_s.csv")
    parts = list((tmp_path / "out_s.csv").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text().startswith(("1,", "2,"))
    back = sources.read_report(spark, written)
    assert sorted(map(tuple, back.collect())) == data


LOG = [
    ("s1", "START", "0", "1"),
    ("s1", "200002352", "100", "2"),
    ("s1", "200002364", "200", "3"),
    ("s1", "STOP", "300", "4"),
    ("s1", "2218714", "400", "5"),
    ("s1", "STOP", "700", "6"),
    ("s2", "START", "0", "1"),
    ("s2", "STOP", "bad", "2"),
    ("s2", "STOP", "179", "3"),
]
CODES = """error_code,description,action,level
START,begin,Start,L1
2218714,begin,Start,L1
STOP,end,Stop,L1
200002352,shutdown,Monitor,L3
200002364,crash,Monitor,L4
"""


def job_files(tmp_path):
    rows = [
        line(tar_systemid=s, msg_code=c, time_seq=t, seq_num=n, msg_date="2016-01-01")
        for s, c, t, n in LOG
    ]
    copies = [row.replace("x", "y", 1) for row in rows[:3]]  # other text in ``dummy`` only
    old = line(tar_systemid="s1", msg_code="START", time_seq="1", msg_date="2015-12-31")
    other = line(tar_systemid="s3", msg_code="START", time_seq="1", msg_date="2016-01-01")
    files = {
        "log_path": "\n".join([*rows, *copies, rows[0], old, other]),
        "code_actions_path": CODES,
        "level_weights_path": "level,wt\nL1,0\nL3,0.5\nL4,1\n",
        "system_list_path": "s1\ns1\ns2\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return {name: str(tmp_path / f"{name}.csv") for name in files}


def test_job(spark, tmp_path):
    files = job_files(tmp_path)
    days = {"start_date": "2016-01-01", "end_date": "2016-01-01"}
    totals = run_report(spark, report_path=str(tmp_path / "r"), **files, **days).collect()
    assert [tuple(row) for row in totals] == [(1, 1, 1, 1000.0)]
    report = sources.read_report(spark, str(tmp_path / "r.csv")).collect()
    assert [tuple(row) for row in report] == [("s1", 1000.0, 1000.0, 1, 0, 1, 700.0, 0.0)]


def test_job_counting_exams(spark, tmp_path):
    settings = Settings(num_exams_by="segment")
    files = job_files(tmp_path)
    totals = run_report(spark, report_path=str(tmp_path / "r"), settings=settings, **files)
    assert totals.first().cum_exams == 2


def test_literal_job(spark, tmp_path):
    """Filters are ignored, rows are summed, and every machine has one exam."""
    files = job_files(tmp_path)
    days = {"start_date": "2016-01-01", "end_date": "2016-01-01"}
    run_report(spark, report_path=str(tmp_path / "r"), mode="literal", **files, **days)
    report = sources.read_report(spark, str(tmp_path / "r.csv")).collect()
    # The START of 2015 supersedes the other one, so the exam at 1 s has the rows START,
    # shutdown, crash and STOP with 2 + 1 + 2 + 2 after the rule; its first weight is 0.
    assert [tuple(row) for row in report] == [("s1", 0.0, 7000.0, 7, 1, 1, 1.0, 1.0)]


def test_clean_log_is_the_stepwise_result(spark, tmp_path):
    log = sources.read_machine_log(spark, job_files(tmp_path)["log_path"])
    step = cleaning.drop_incomplete(cleaning.dedup_rows(log))
    step = cleaning.dedup_rows(cleaning.drop_columns(step, "dummy"))
    once = cleaning.clean_log(log)
    assert once.exceptAll(step).isEmpty() and step.exceptAll(once).isEmpty()
    assert once.count() == len(LOG) + 2


def test_loaded_log_is_typed(spark, tmp_path):
    log = cleaning.prepare_log(read_log(spark, job_files(tmp_path)["log_path"]))
    ticks = {r.tick for r in log.filter("system_id = 's2'").collect()}
    assert ticks == {0.0, 179.0, None}
    assert log.select("config", "sw_rev").distinct().collect() == [
        ("MR750W", "DV25.0_R02_1549.b")
    ]
