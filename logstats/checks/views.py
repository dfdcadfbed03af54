"""Sample tables seen as a machine log and as code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats import schemas
from logstats.settings import Settings

SETTINGS = Settings(
    service_gap_s=3600.0,
    max_exam_s=259200.0,
    min_exam_s=180.0,
    exam_code="START",
    reset_code="MON",
    shutdown_codes=("SHUT",),
    crash_codes=("CRASH",),
)

CODE_ROWS = """
    ('START', 'Non Service Exam begin', 'Start', 'L1'),
    ('STOP', 'exam end', 'Stop', 'L1'),
    ('MON', 'TPS Reset Started', 'Monitor', 'L2'),
    ('SHUT', 'Sytem shutdown by user', 'Monitor', 'L3'),
    ('CRASH', 'TPS Reset failed', 'Monitor', 'L4'),
    ('SVC', ' Service Exam begin', 'Ignore', 'L1')
"""
WEIGHT_ROWS = "('L1', '0.0'), ('L2', '0.1'), ('L3', '0.5'), ('L4', '1.0')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_actions(spark: SparkSession) -> DataFrame:
    names = "error_code, description, action, level"
    return spark.sql(f"SELECT * FROM VALUES {CODE_ROWS} AS codes({names})")


def level_weights(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {WEIGHT_ROWS} AS weights(level, wt)")


def epoch_micros(spark: SparkSession, stamp: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
        return F.unix_micros(stamp.cast("timestamp"))
    days = F.datediff(stamp.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(stamp)) * 60 + F.minute(stamp)
    seconds = F.date_part(F.lit("SECOND"), stamp)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def event_code() -> Column:
    kind, value = F.col("event_type"), F.col("value")
    return (
        F.when(kind == "signup", "START")
        .when(kind == "purchase", "STOP")
        .when(kind == "view", "MON")
        .when(kind == "click", "SVC")
        .when((kind == "error") & (value >= 50), "SHUT")
        .otherwise("CRASH")
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = epoch_micros(spark, F.col("ts"))
    return table(spark, sf_dir, "events").select("*", micros.alias("_micros"))


def _epoch_text() -> Column:
    """Epoch seconds as text with six decimals."""
    whole = F.expr("_micros div 1000000").cast("string")
    rest = F.lpad((F.col("_micros") % 1_000_000).cast("string"), 6, "0")
    return F.concat(whole, F.lit("."), rest)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a prepared log."""
    user = F.col("user_id")
    return _events(spark, sf_dir).select(
        user.cast("string").alias("system_id"),
        F.concat(F.lit("R"), (user % 3).cast("string")).alias("sw_rev"),
        F.concat(F.lit("C"), (user % 2).cast("string")).alias("config"),
        event_code().alias("code"),
        _epoch_text().alias("time_seq"),
        (F.col("_micros") / F.lit(1e6)).alias("tick"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("event_key"),
        F.concat(F.lit("tar"), (F.col("event_id") % 5).cast("string")).alias("file_name"),
        F.substring(F.col("ts").cast("string"), 12, 8).alias("log_local_ts"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("log_message_ts"),
        F.col("props").alias("msg_text"),
        F.col("event_type").alias("source"),
        F.col("ts").cast("date").cast("string").alias("msg_date"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the 27 columns of a log file.

    Every tenth row is there twice, every ninth has no text in ``tag``, every eleventh no
    code, and every seventeenth no number as its tick.
    """
    events = _events(spark, sf_dir)
    key = F.col("event_id")
    values = {
        "tarfilename": F.concat(F.lit("tar"), (key % 5).cast("string")),
        "inputfilename": F.lit("sysfile"),
        "tar_systemid": F.col("user_id").cast("string"),
        "msg_text": F.col("props"),
        "msg_code": F.when(key % 11 != 0, event_code()),
        "msg_source": F.col("event_type"),
        "tag": F.when(key % 9 != 0, F.lit("t")),
        "time_seq": F.when(key % 17 == 0, F.lit("bad")).otherwise(_epoch_text()),
        "seq_num": key.cast("string"),
        "msg_date": F.col("ts").cast("date").cast("string"),
    }
    names = schemas.MACHINE_LOG.names
    log = events.select(*(values.get(name, F.lit("x")).alias(name) for name in names))
    return log.unionByName(log.filter(F.col("seq_num").cast("bigint") % 10 == 0))


# Texts that a tick may look like, by the event's number; the rest are proper ticks.
TICK_TEXTS = (
    "0x1p3", "1.5d\t", "1.5d\n", "2.5f", "1e3", "+5", ".5", "5.", "  7 ", " 8\t", "", "  ", "nan",
    "inf", "-Infinity", "1e999", "-1e999", "1_0", "--1", "1e", ".", "1e-3", "12abc",
)


def tick_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's ticks, of which some are replaced by ``TICK_TEXTS``."""
    texts = F.array(*(F.lit(text) for text in TICK_TEXTS))
    at = (F.col("seq_num").cast("bigint") % 29).cast("int")
    text = F.coalesce(F.get(texts, at), F.col("time_seq"))
    return raw_log(spark, sf_dir).select("seq_num", text.alias("time_seq"))


def part_code_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as a dictionary of codes that grows with the data."""
    key = F.col("p_partkey")
    texts = F.array(
        *(
            F.lit(text)
            for text in (
                "Start: TPS Reset Started ",
                "TPS Reset successful ",
                "TPS Reset failed ",
                "Sytem shutdown ",
                "System shutdown ",
                " Service Exam ",
                "Non Service Exam ",
                "Service Exam ",
                "",
            )
        )
    )
    actions = F.array(
        *(
            F.lit(text)
            for text in ("Start", "Stop", "Monitor", "Enable", "Disable", "Ignore", "start")
        )
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("E"), key.cast("string")).alias("error_code"),
        F.concat(F.get(texts, (key % 9).cast("int")), F.col("p_name")).alias("description"),
        F.get(actions, (key % 7).cast("int")).alias("action"),
        F.concat(F.lit("L"), F.col("p_size").cast("string")).alias("level"),
    )


def part_level_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return (
        table(spark, sf_dir, "part")
        .select(
            F.concat(F.lit("L"), size.cast("string")).alias("level"),
            F.concat((size % 10).cast("string"), F.lit(".5")).alias("wt"),
        )
        .distinct()
    )


def all_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select(F.col("c_custkey").cast("string").alias("sysid"))


def customer_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even customer keys as an allow-list, each listed twice."""
    even = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == 0)
    listed = even.select(F.col("c_custkey").cast("string").alias("sysid"))
    return listed.unionByName(listed)
