"""Joins, defaults and verdicts between records that jobs write by themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a judge's answer becomes a verdict.
VERDICTS = {"yes": "pass", "partial": "marginal", "no": "fail"}


def resumed(todo: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What has no output yet."""
    return todo.join(done, key, "left_anti")


def present(df: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose input exists."""
    return df.join(existing, key, "left_semi")


def falsy(*values: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def last_wins(df: DataFrame, key: str, place: str, *values: str) -> DataFrame:
    """Of rows with one key the last by place, as a dict built in order has it."""
    return df.groupBy(key).agg(*(F.max_by(v, place).alias(v) for v in values))


def first_wins(df: DataFrame, key: str, place: str, *values: str) -> DataFrame:
    return df.groupBy(key).agg(*(F.min_by(v, place).alias(v) for v in values))


def laid_over(left: str, right: str, mine: list[str], theirs: list[str]) -> Column:
    """A record with another laid over it: fields that the other has and that aren't null are its own."""
    names = [*mine, *(n for n in theirs if n not in mine)]
    value = lambda n: F.coalesce(*(F.col(f"{s}.{n}") for s, own in ((right, theirs), (left, mine)) if n in own))
    return F.struct(*(value(n).alias(n) for n in names))


def verdict(match: Column, geometry_passes: Column, earlier: Column | None = None) -> Column:
    """The judge's answer as a verdict; a failed geometry check overrides it; an earlier verdict fills in for no answer."""
    answer = F.coalesce(*(F.when(match == k, F.lit(v)) for k, v in VERDICTS.items()))
    pending = F.coalesce(answer, earlier if earlier is not None else F.lit(None), F.lit("pending"))
    return F.when(F.coalesce(~geometry_passes, F.lit(False)), F.lit("fail")).otherwise(pending)


def note(*parts: Column) -> Column:
    """The parts that are there, joined."""
    return F.concat_ws(" | ", *parts)


def gate_note(geometry_passes: Column, observed: Column, most: int = 140) -> Column:
    """What the gate and the judge said of a pair, as far as they said anything."""
    gate = F.when(geometry_passes, F.lit("geo:ok")).when(~geometry_passes, F.lit("geo:FAIL"))
    judge = F.concat(F.lit("blind-judge observed: "), F.left(observed, F.lit(most)))
    return F.concat(F.lit("auto-gate | "), note(gate, judge))


def pivoted(df: DataFrame, by: str, column: str, values: list[str]) -> DataFrame:
    """A count for each value, 0 where there is none."""
    return df.groupBy(by).agg(*(F.count_if(F.col(column) == v).alias(v) for v in values))
