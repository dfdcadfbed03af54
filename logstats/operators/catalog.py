"""Code catalog: categories of error codes, their levels and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstats.operators.groups import running_total

# Actions and description texts that put a code into a category.
STOP_ACTIONS = ("Stop", "Disable")
START_ACTIONS = ("Start",)
MONITOR_ACTIONS = ("Start", "Monitor", "Stop", "Enable", "Disable")
IGNORE_ACTIONS = ("Ignore",)
RESET_STARTED_TEXT = "TPS Reset Started"
RESET_SUCCESSFUL_TEXT = "TPS Reset successful"
RESET_FAILED_TEXT = "TPS Reset failed"
SHUTDOWN_TEXT = "Sytem shutdown"
SERVICE_PREFIX = " Service Exam"
NON_SERVICE_TEXT = "Non Service Exam"


def category_rules(shutdown_text: str = SHUTDOWN_TEXT) -> dict[str, Column]:
    """Category name to condition on a code-action row; categories overlap."""
    action, description = F.col("action"), F.col("description")
    return {
        "Stop": action.isin(*STOP_ACTIONS),
        "Start": action.isin(*START_ACTIONS),
        "Monitor": action.isin(*MONITOR_ACTIONS),
        "Ignore": action.isin(*IGNORE_ACTIONS),
        "TPSResetStarted": description.contains(RESET_STARTED_TEXT),
        "TPSResetSuccessful": description.contains(RESET_SUCCESSFUL_TEXT),
        "TPSResetFailed": description.contains(RESET_FAILED_TEXT),
        "Shutdown": description.contains(shutdown_text),
        "ServiceExam": description.startswith(SERVICE_PREFIX),
        "NonServiceExam": description.contains(NON_SERVICE_TEXT),
    }


def code_categories(code_actions: DataFrame, shutdown_text: str = SHUTDOWN_TEXT) -> DataFrame:
    """One row per code and category it falls into."""
    rules = category_rules(shutdown_text)
    names = F.array_compact(F.array(*(F.when(rule, name) for name, rule in rules.items())))
    return code_actions.select("error_code", F.explode(names).alias("category")).distinct()


def code_catalog(code_actions: DataFrame, shutdown_text: str = SHUTDOWN_TEXT) -> DataFrame:
    """One row per category with the sorted array of its codes.

    The small form, for a dictionary whose categories fit into a row each; one that may not
    has ``code_catalog_blocks``.
    """
    return (
        code_categories(code_actions, shutdown_text)
        .groupBy("category")
        .agg(F.sort_array(F.collect_list("error_code")).alias("error_codes"))
    )


def code_catalog_blocks(
    code_actions: DataFrame, block_codes: int, shutdown_text: str = SHUTDOWN_TEXT
) -> DataFrame:
    """Per category blocks, numbered from 0, of ``block_codes`` codes in sorted order.

    The codes are distinct, so a row number in their order cuts them. A category is numbered
    by chunks where it has more than ``MAX_GROUP_ROWS`` codes.
    """
    codes = code_categories(code_actions, shutdown_text).withColumn("_one", F.lit(1))
    numbered = running_total(codes, ["category"], ["error_code"], "_one", "_nth")
    block = F.floor((F.col("_nth") - 1) / F.lit(block_codes)).cast("int").alias("block")
    return numbered.groupBy("category", block).agg(
        F.sort_array(F.collect_list("error_code")).alias("error_codes")
    )


def code_roles(code_actions: DataFrame) -> DataFrame:
    """One row per code that matters to exam cutting, with its four role flags."""
    rules = category_rules()
    roles = {
        "is_start": rules["Start"],
        "is_stop": rules["Stop"],
        "is_monitored": rules["Monitor"],
        "is_service": rules["ServiceExam"],
    }
    flags = [F.bool_or(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in roles.items()]
    return (
        code_actions.groupBy(F.col("error_code").alias("code"))
        .agg(*flags)
        .filter("is_start or is_monitored or is_service")
    )


def add_roles(log: DataFrame, code_actions: DataFrame) -> DataFrame:
    """Log rows whose code has a role, with the role flags.

    Being an inner join this also drops, before any shuffle of the log, the rows that
    can neither be kept nor change an exam.
    """
    return log.join(code_roles(code_actions), "code")


def keep_known_codes(log: DataFrame, code_actions: DataFrame) -> DataFrame:
    """Raw log rows whose code has a role."""
    known = code_roles(code_actions).select(F.col("code").alias("msg_code"))
    return log.join(known, "msg_code", "left_semi").select(*log.columns)


def attach_level(events: DataFrame, code_actions: DataFrame) -> DataFrame:
    """``mebef_level`` by code; ``'-1'`` where the code is unknown."""
    levels = code_actions.groupBy(F.col("error_code").alias("code")).agg(
        F.min("level").alias("_level")
    )
    level = F.coalesce("_level", F.lit("-1"))
    return events.join(levels, "code", "left").withColumn("mebef_level", level).drop("_level")


def attach_weight(events: DataFrame, level_weights: DataFrame) -> DataFrame:
    """``mebef_wt`` by level; ``-1.0`` where the level has no weight."""
    weights = level_weights.groupBy(F.col("level").alias("mebef_level")).agg(
        F.min(F.col("wt").try_cast("double")).alias("_wt")
    )
    weight = F.coalesce("_wt", F.lit(-1.0))
    return events.join(weights, "mebef_level", "left").withColumn("mebef_wt", weight).drop("_wt")
