"""Split one wide table into dimensions with surrogate keys and a fact."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from martkit.operators.load import resolve_keys
from martkit.operators.ordinals import assign_ids
from martkit.session import scratch_path
from martkit.sources.files import refresh_table


@dataclass(frozen=True)
class DimSpec:
    """A dimension: its natural key and, through ``parents``, dimensions it points to."""

    name: str
    natural_key: Sequence[str]
    sk: str
    parents: Sequence[str] = field(default_factory=tuple)


@dataclass(frozen=True)
class FactSpec:
    measures: Sequence[str]
    dims: Sequence[str]


def decompose(
    wide: DataFrame, dims: Sequence[DimSpec], fact: FactSpec
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(dimension tables by name, fact). Joins use full natural keys, never parts.

    List parents before children; a child row holds its parents' keys instead
    of the columns they carry. Numbered rows are stored: every use reads them
    again, and Spark knows their size, so that a small dimension is broadcast
    and the wide rows are shuffled for the large ones only.
    """
    by_name = {d.name: d for d in dims}
    built: dict[str, DataFrame] = {}
    full: dict[str, DataFrame] = {}
    for dim in dims:
        rows = assign_ids(wide.select(*dim.natural_key).distinct(), None, dim.sk, dim.natural_key)
        rows = refresh_table(rows, scratch_path(wide.sparkSession, dim.name))
        full[dim.name] = rows
        out = resolve_keys(
            rows,
            [
                (full[p], {c: c for c in by_name[p].natural_key}, by_name[p].sk)
                for p in dim.parents
            ],
            "left",
        )
        carried = {c for p in dim.parents for c in by_name[p].natural_key}
        built[dim.name] = out.drop(*carried)
    keyed = resolve_keys(
        wide,
        [(full[n], {c: c for c in by_name[n].natural_key}, by_name[n].sk) for n in fact.dims],
        "left",
    )
    return built, keyed.select(*[by_name[n].sk for n in fact.dims], *fact.measures)
