"""Small logs, and the exam rules stated row by row to compare the windows with."""

import random

SCHEMA = "system_id string, sw_rev string, config string, code string, time_seq string, " \
    "tick double, seq bigint, event_key bigint"
CODES = [
    ("START", "Non Service Exam", "Start", "L1"),
    ("STOP", "end", "Stop", "L1"),
    ("OFF", "off", "Disable", "L2"),
    ("MON", "some row", "Monitor", "L2"),
    ("SVC", " Service Exam begin", "Ignore", "L1"),
    ("SVCMON", " Service Exam row", "Monitor", "L3"),
    ("SVCSTART", " Service Exam start", "Start", "L4"),
    ("STARTSTOP", "both", "Start", "L1"),
    ("STARTSTOP", "both", "Stop", "L1"),
    ("NOISE", "noise", "Ignore", "L1"),
]
CODE_SCHEMA = "error_code string, description string, action string, level string"


def code_frame(spark):
    return spark.createDataFrame(CODES, CODE_SCHEMA)


def log_row(system, code, tick, seq, sw_rev="R", config="C"):
    return (system, sw_rev, config, code, str(tick), float(tick), seq, seq)


def log_frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def single_log(spark, *events):
    """A log of one machine from (code, tick) pairs in order."""
    return log_frame(spark, [log_row("1", code, t, n) for n, (code, t) in enumerate(events)])


def random_log(seed, systems, rows, span, hot=0):
    """Rows with many equal ticks; system '0' gets ``hot`` more of them."""
    dice = random.Random(seed)
    names = [code for code, *_ in CODES] + ["UNKNOWN", "MON", "MON", "SVC"]
    out = []
    for n in range(rows + hot):
        system = str(dice.randrange(systems)) if n < rows else "0"
        out.append(
            log_row(system, dice.choice(names), dice.randrange(span) * 2, n, f"R{n % 2}")
        )
    dice.shuffle(out)
    return out


def sequential_exams(rows, gap, limit):
    """Outcome per start key, and exam start key per kept row key."""
    action = {}
    for code, description, act, _ in CODES:
        roles = action.setdefault(code, set())
        roles.add(act)
        if description.startswith(" Service Exam"):
            roles.add("service")
    outcomes, kept = {}, {}
    machines = {}
    for row in rows:
        machines.setdefault(row[:3], []).append(row)
    for log in machines.values():
        last_service = exam = None
        pending = []
        for _, _, _, code, _, tick, _, key in sorted(log, key=lambda r: (r[5], r[6], r[7])):
            roles = action.get(code, set())

            def close(how):
                outcomes[exam[0]] = how
                if how in ("stopped", "timed_out", "superseded"):
                    kept.update({k: exam[0] for k in pending})

            if "service" in roles:
                last_service = tick
            if "Start" in roles:
                real = last_service is None or tick - last_service >= gap
                if exam:
                    close("superseded" if real else "discarded_by_service")
                pending = []
                if not real:
                    outcomes[key] = "service"
                    exam = None
                    continue
                exam = (key, tick)
            if exam is None or not roles & {"Start", "Monitor", "Stop", "Enable", "Disable"}:
                continue
            if tick > exam[1] + limit:
                close("timed_out")
                exam = None
                continue
            pending.append(key)
            if roles & {"Stop", "Disable"}:
                close("stopped")
                exam = None
        if exam:
            outcomes[exam[0]] = "open_at_end"
    return outcomes, kept
