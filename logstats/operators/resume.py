"""Cutting exams period by period: what one period leaves open, the next one goes on with.

A period's rows follow those of the periods before, per machine, in the order of the log. A
machine's past is to the rest of its log what a chunk of a large machine is to the chunks after
it: one summary row with its last service, its last start, and whether that has
stopped. So the past goes before the period's chunks as chunk -1, and the same scan over
summaries gives what each chunk inherits, and how the exam that was open has ended.

Rows of an exam that is still open are pending: they wait, with the state, for the period that
decides them. All other rows are decided once. Cutting period by period gives the rows and
outcomes of one cut over all of them; exams that are pending after the last one are those
that are open at its end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstats.operators import exams
from logstats.operators.catalog import add_roles
from logstats.operators.cleaning import usable_rows
from logstats.operators.groups import CHUNK, Bounded, GroupSizes, group_sizes, split_groups
from logstats.scratch import checkpointed
from logstats.settings import DEFAULTS, EXAM, ORDER, UNIT, Settings

PAST = -1


@dataclass(frozen=True)
class CarriedState:
    """``machines``: a row for each machine seen, with the place of its last row and its past as
    a summary. ``pending``: rows of open exams, as ``cut_exams`` has them."""

    machines: DataFrame
    pending: DataFrame


@dataclass(frozen=True)
class Period:
    """Rows that are decided now, as ``cut_exams`` has them, and the state after."""

    rows: DataFrame
    state: CarriedState


def write_state(state: CarriedState, path: str) -> None:
    """Two Parquet tables; a new path for each period, so that a period can be run again."""
    state.machines.write.parquet(f"{path}/machines")
    state.pending.write.parquet(f"{path}/pending")


def read_state(spark: SparkSession, path: str) -> CarriedState:
    return CarriedState(*(spark.read.parquet(f"{path}/{name}") for name in ("machines", "pending")))


def _place() -> Column:
    return F.struct(*ORDER)


def _with_last(rows: DataFrame, state: CarriedState) -> DataFrame:
    last = state.machines.select(*UNIT, F.col("last").alias("_last"))
    return rows.join(last, list(UNIT), "left")


def late_rows(log: DataFrame, code_actions: DataFrame, state: CarriedState) -> DataFrame:
    """Usable rows that ``cut_next`` leaves out: not after the last row of their machine."""
    rows = _with_last(usable_rows(add_roles(log, code_actions)), state)
    return rows.filter(_place() <= F.col("_last")).drop("_last")


def _on_time(rows: DataFrame, state: CarriedState | None) -> DataFrame:
    if state is None:
        return rows
    after = F.col("_last").isNull() | (_place() > F.col("_last"))
    return _with_last(rows, state).filter(after).drop("_last")


def _past_and_chunks(summaries: DataFrame, state: CarriedState | None) -> DataFrame:
    """Chunk summaries with the past before them; ``last`` is the place of the last row."""
    if state is None:
        return summaries
    past = state.machines.withColumn(CHUNK, F.lit(PAST))
    return summaries.unionByName(past, allowMissingColumns=True)


def _machines_after(chunks: DataFrame) -> DataFrame:
    """The summary of each machine's log up to the end of its last chunk."""
    later = Window.partitionBy(*UNIT).orderBy(CHUNK)
    last_start = F.col("last_start")
    stopped = exams._no(F.col("stopped_start") == last_start["_row"])
    # A stop in a chunk without a start stops what was open before it.
    after = F.struct(CHUNK, "last_start", stopped.alias("stopped"))
    folded = (
        chunks.withColumn("_open", F.last(F.when(last_start.isNotNull(), after), ignorenulls=True).over(later))
        .groupBy(*UNIT)
        .agg(
            F.max("last").alias("last"),
            F.max("service").alias("service"),
            F.max("_open").alias("_open"),
            F.max(F.when(F.col("first_stop").isNotNull(), F.col(CHUNK))).alias("_stop_chunk"),
        )
    )
    opened = F.col("_open")
    over = opened["stopped"] | exams._no(F.col("_stop_chunk") > opened[CHUNK])
    return folded.select(
        *UNIT,
        "last",
        "service",
        opened["last_start"].alias("last_start"),
        F.when(over, opened["last_start"]["_row"]).alias("stopped_start"),
    )


def cut_next(
    log: DataFrame,
    code_actions: DataFrame,
    state: CarriedState | None = None,
    settings: Settings = DEFAULTS,
    bounded: Bounded = None,
) -> Period:
    """Cut the rows of the next period; ``log`` has the columns of ``prepare_log``.

    Without a ``state`` it is the first one. Rows that are not after the last row of their
    machine came too late: they are left out, and ``late_rows`` gives them. The columns of
    the log must be the same in every period. The summaries, a row for each machine and
    chunk, and the cut rows are checkpointed, since both the decided rows and the next state
    follow from them.
    """
    rows = exams._with_start_id(usable_rows(_on_time(add_roles(log, code_actions), state)))
    if not isinstance(bounded, GroupSizes):
        bounded = GroupSizes((), None) if bounded else group_sizes(rows, UNIT, settings.max_group_rows)
    if not bounded:
        # Range bounds, chunks, and the machines that are whole all take the rows again.
        rows = checkpointed(rows)
    split = split_groups(rows, UNIT, ORDER, settings.max_group_rows, bounded)
    whole = split.rows.repartition(*exams.TASK_KEYS).withColumn(CHUNK, F.lit(0))
    parts = [(whole, [*UNIT])]
    if split.hot is not None:
        parts.append((split.hot, [*UNIT, CHUNK]))
    summaries = None
    for part, _ in parts:
        summary = exams._chunk_summaries(part, F.max(_place()).alias("last"))
        summaries = summary if summaries is None else summaries.unionByName(summary)
    chunks = checkpointed(_past_and_chunks(summaries, state))
    carries = checkpointed(exams._carries_of(chunks, settings))

    now = None
    for part, keys in parts:
        inherited = part.join(carries, [*UNIT, CHUNK])
        cut = exams._scan(inherited, keys, True, settings, keep_limit=True)
        now = cut if now is None else now.unionByName(cut)
    now = checkpointed(now)
    waits = (F.col("outcome") == exams.OPEN) & (F.col("is_start") | F.col("in_limit"))
    pending = now.filter(waits)
    decided = now.filter(F.col("outcome") != exams.OPEN)
    if state is not None:
        endings = carries.filter(F.col(CHUNK) == PAST).select(*UNIT, F.col("carry_ending").alias("_ending"))
        waited = state.pending.join(endings, list(UNIT), "left")
        pending = pending.unionByName(waited.filter("_ending IS NULL").drop("_ending"))
        ended = waited.filter("_ending IS NOT NULL").withColumn("outcome", F.col("_ending")).drop("_ending")
        kept = F.col("in_limit") & F.col("outcome").isin(*exams.CLOSED)
        decided = decided.unionByName(ended.withColumn("kept", kept))
    return Period(decided.drop("in_limit"), CarriedState(_machines_after(chunks), pending))


def segments_of(rows: DataFrame) -> DataFrame:
    """One row per start of decided or pending rows, as ``exam_segments`` has them."""
    return rows.filter("is_start").select(
        *EXAM, F.col("event_key").alias("start_event"), "exam_start", "outcome"
    )
