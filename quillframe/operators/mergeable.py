"""Own aggregates made of parts, so that no task sees a whole group.

Rows become states where they are read, states are merged a few at a time in rounds, and the
last state of a group becomes its result. Raw rows are never shuffled, and how often a group is
merged grows with the logarithm of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.groups import as_list, largest_group, not_null
from ..plans.lineage import cut_lineage

# States of one group that are merged at once.
FAN_IN = 64

State = dict[str, Any]


@dataclass(frozen=True)
class Mergeable:
    """An aggregate function in three steps.

    ``update`` makes a state of some of a group's known values (there may be none), ``merge``
    one state of a table of states, whichever they are, and ``finish`` the result, a number, of
    the last one. A state is a dict with the fields that ``state``, a DDL string, names.
    """

    update: Callable[[pd.Series], State]
    merge: Callable[[pd.DataFrame], State]
    finish: Callable[[State], float | None]
    state: str


def group_merged(df: DataFrame, by, wanted: dict[str, tuple[Mergeable, str]]) -> DataFrame:
    """Own aggregates of groups of any size: new name -> (:class:`Mergeable`, column).

    Null keys form no group and null values are left out; without keys the whole table is one
    group, of which an empty table has none. ``update`` runs once per group and batch of a
    partition sorted by the keys, so its work is that of one pass. States are written, and
    counted, before each round; results are doubles."""
    by = as_list(by)
    df = not_null(df, by)
    functions = [m for m, _ in wanted.values()]
    fields = [[f.name for f in T.StructType.fromDDL(m.state)] for m in functions]
    keys = T.StructType([df.schema[b] for b in by])
    states = T.StructType(list(keys))
    for k, m in enumerate(functions):
        for f in T.StructType.fromDDL(m.state):
            states.add(f"_s{k}_{f.name}", f.dataType)
    results = T.StructType(list(keys))
    for name in wanted:
        results.add(name, T.DoubleType())

    def as_row(key: tuple, made: list[State]) -> State:
        row = dict(zip(by, key))
        for k, state in enumerate(made):
            row.update({f"_s{k}_{f}": state[f] for f in fields[k]})
        return row

    def table(rows: list[State], schema: T.StructType) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=schema.names)

    def merged(part: pd.DataFrame) -> list[State]:
        own = lambda k: part[[f"_s{k}_{f}" for f in fields[k]]].set_axis(fields[k], axis=1)
        return [m.merge(own(k)) for k, m in enumerate(functions)]

    def updated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            groups = pdf.groupby(by, sort=False) if by else [((), pdf)] if len(pdf) else []
            made = lambda part: [m.update(part[f"_v{k}"].dropna()) for k, m in enumerate(functions)]
            yield table([as_row(key, made(part)) for key, part in groups], states)

    def one_state(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return table([as_row(key, merged(part))], states)

    def finished(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ends = [m.finish(state) for m, state in zip(functions, merged(part))]
        return table([dict(zip(results.names, [*key, *ends]))], results)

    values = [F.col(c).alias(f"_v{k}") for k, (_, c) in enumerate(wanted.values())]
    rows = df.select(*by, *values)
    if by:
        rows = rows.sortWithinPartitions(*by)
    left = cut_lineage(rows.mapInPandas(updated, states))
    largest = largest_group(left, by)
    while largest > FAN_IN:
        # A written table gives a row the same number whenever it is read.
        salt = _salt(-(-largest // FAN_IN))
        salted = left.withColumn("_salt", salt).groupBy(*by, "_salt")
        left = cut_lineage(salted.applyInPandas(lambda key, part: one_state(key[: len(by)], part), states))
        largest = largest_group(left, by)
    return left.groupBy(*by).applyInPandas(finished, results)


def _salt(parts: int) -> Column:
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts))
