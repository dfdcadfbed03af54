"""Schemas of the inputs and of the report."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column names of the input files, in file order.
MACHINE_LOG = _text(
    "dummy",
    "tarfilename",
    "inputfilename",
    "tar_systemid",
    "tar_date",
    "tar_datetime",
    "log_systemid",
    "log_mln",
    "log_usn",
    "log_datetime",
    "log_datetime_ts",
    "log_timezone",
    "msg_text",
    "msg_code",
    "msg_source",
    "msg_time",
    "msg_datetime",
    "log_type",
    "tag",
    "time_seq",
    "seq_num",
    "format",
    "view_level",
    "suit_name",
    "host_name",
    "msg_date",
    "dl_load_date",
)
SYSTEM_LIST = _text("sysid")
LEVEL_WEIGHTS = _text("level", "wt")
CODE_ACTIONS = _text("error_code", "description", "action", "level")

# Columns of an exam record, in order.
EXAM_RECORD = (
    "system_id",
    "sw_rev",
    "file_name",
    "log_local_ts",
    "log_message_ts",
    "code",
    "exam_id",
    "mebef_level",
    "mebef_wt",
    "time_seq",
    "source",
    "psd",
    "coil",
    "scan",
    "config",
    "msg_text",
)

# Columns of the report, in order.
MACHINE_REPORT = T.StructType(
    [
        T.StructField("system_id", T.StringType()),
        T.StructField("ipte_weighted", T.DoubleType()),
        T.StructField("ipte_severity", T.DoubleType()),
        T.StructField("num_shutdowns", T.LongType()),
        T.StructField("num_tps_resets", T.LongType()),
        T.StructField("num_exams", T.LongType()),
        T.StructField("time_seq_max", T.DoubleType()),
        T.StructField("time_seq_min", T.DoubleType()),
    ]
)
