from dataclasses import replace

import pytest
from helpers import code_frame, log_frame, log_row, random_log, sequential_exams, single_log
from pyspark.sql import functions as F

from logstats.operators import exams
from logstats.settings import Settings

RULES = Settings(service_gap_s=5.0, max_exam_s=10800.0)


def outcomes(log, codes, settings=RULES):
    rows = exams.exam_segments(log, codes, settings).collect()
    return {row["start_event"]: row["outcome"] for row in rows}


def kept(log, codes, settings=RULES):
    rows = exams.exam_events(log, codes, settings).select("event_key").collect()
    return sorted(row["event_key"] for row in rows)


# Events, outcome per start event, kept events.
CASES = {
    "stop is kept and closes": (
        [("START", 0), ("MON", 1), ("STOP", 2), ("MON", 3)], {0: "stopped"}, [0, 1, 2]
    ),
    "disable stops too": ([("START", 0), ("OFF", 2), ("OFF", 3)], {0: "stopped"}, [0, 1]),
    "next start supersedes": (
        [("START", 0), ("MON", 1), ("START", 2)], {0: "superseded", 2: "open_at_end"}, [0, 1]
    ),
    "open at end is dropped": ([("START", 0), ("MON", 1)], {0: "open_at_end"}, []),
    "row at three hours is kept": (
        [("START", 0), ("MON", 10800), ("MON", 10801)], {0: "timed_out"}, [0, 1]
    ),
    "late stop only times out": ([("START", 0), ("STOP", 10801)], {0: "timed_out"}, [0]),
    "late row without role is nothing": (
        [("START", 0), ("NOISE", 10801)], {0: "open_at_end"}, []
    ),
    "start within five seconds of service": (
        [("SVC", 0), ("START", 4.5), ("MON", 5), ("STOP", 6)], {1: "service"}, []
    ),
    "start at five seconds is real": (
        [("SVC", 0), ("START", 5), ("STOP", 6)], {1: "stopped"}, [1, 2]
    ),
    "service start throws the open exam away": (
        [("START", 0), ("MON", 1), ("SVC", 2), ("START", 3), ("STOP", 4)],
        {0: "discarded_by_service", 3: "service"},
        [],
    ),
    "service code on the start row": ([("SVCSTART", 0), ("STOP", 1)], {0: "service"}, []),
    "monitored service row is kept": (
        [("START", 0), ("SVCMON", 1), ("STOP", 2)], {0: "stopped"}, [0, 1, 2]
    ),
    "service row stays last service across an exam": (
        [("SVC", 0), ("START", 3), ("START", 4), ("START", 9), ("STOP", 10)],
        {1: "service", 2: "service", 3: "stopped"},
        [3, 4],
    ),
    "stop on the start row": (
        [("STARTSTOP", 0), ("MON", 1)], {0: "stopped"}, [0]
    ),
    "rows before any start": ([("MON", 0), ("STOP", 1), ("START", 2)], {2: "open_at_end"}, []),
    "unknown codes do not matter": (
        [("START", 0), ("UNKNOWN", 1), ("STOP", 2)], {0: "stopped"}, [0, 2]
    ),
    "equal ticks go by sequence": (
        [("START", 7), ("MON", 7), ("STOP", 7), ("MON", 7)], {0: "stopped"}, [0, 1, 2]
    ),
}


@pytest.fixture(scope="module", params=[1_000_000, 1], ids=["whole", "chunks"])
def found(spark, request):
    """Outcomes and kept events per case, with one machine per case."""
    log = log_frame(
        spark,
        [
            log_row(name, code, tick, n)
            for name, (events, _, _) in CASES.items()
            for n, (code, tick) in enumerate(events)
        ],
    )
    codes, settings = code_frame(spark), replace(RULES, max_group_rows=request.param)
    outcomes, kept = {name: {} for name in CASES}, {name: [] for name in CASES}
    for row in exams.exam_segments(log, codes, settings).collect():
        outcomes[row["system_id"]][row["start_event"]] = row["outcome"]
    for row in exams.exam_events(log, codes, settings).collect():
        kept[row["system_id"]].append(row["event_key"])
    return outcomes, kept


@pytest.mark.parametrize("name", CASES)
def test_rule(found, name):
    _, expected_outcomes, expected_kept = CASES[name]
    outcomes, kept = found
    assert outcomes[name] == expected_outcomes
    assert sorted(kept[name]) == expected_kept


def test_rows_without_tick_or_machine_are_skipped(spark):
    log = single_log(spark, ("START", 0), ("STOP", 1), ("MON", 2), ("STOP", 3))
    log = log.withColumns(
        {
            "tick": F.when(F.col("seq") != 1, F.col("tick")),
            "system_id": F.when(F.col("seq") != 2, F.col("system_id")),
        }
    )
    assert kept(log, code_frame(spark)) == [0, 3]


@pytest.mark.parametrize(
    ("seed", "systems", "rows", "span", "hot", "max_rows"),
    [
        (1, 40, 3000, 200, 0, 1_000_000),
        (2, 3, 3000, 2000, 0, 1_000_000),
        (3, 40, 2000, 300, 1500, 100),
        (4, 4, 2000, 500, 1000, 7),
        (5, 2, 300, 1, 0, 20),
    ],
)
def test_equals_sequential_statement(spark, seed, systems, rows, span, hot, max_rows):
    """Also cut into chunks, with up to a third of the rows on one machine or one tick."""
    data = random_log(seed, systems, rows, span, hot)
    settings = Settings(service_gap_s=3.0, max_exam_s=20.0, max_group_rows=max_rows)
    expected_outcomes, expected_kept = sequential_exams(data, 3.0, 20.0)
    log, codes = log_frame(spark, data), code_frame(spark)
    assert outcomes(log, codes, settings) == expected_outcomes
    events = exams.exam_events(log, codes, settings)
    starts = exams.exam_segments(log, codes, settings).select("exam_id", "start_event")
    pairs = events.join(starts, "exam_id").select("event_key", "start_event").collect()
    assert dict(map(tuple, pairs)) == expected_kept
    assert len(pairs) == len(expected_kept)


def test_row_order_does_not_matter(spark):
    data = random_log(6, 5, 500, 50)
    first = exams.exam_events(log_frame(spark, data), code_frame(spark), RULES)
    second = exams.exam_events(log_frame(spark, data[::-1]), code_frame(spark), RULES)
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_empty_log(spark):
    events = exams.exam_events(log_frame(spark, []), code_frame(spark), RULES)
    assert events.collect() == []
