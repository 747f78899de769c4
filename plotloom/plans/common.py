"""What every load job returns, and its last steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plotloom.operators.keys import complete_rows, only_new
from plotloom.operators.numbering import assign_ids
from plotloom.session import cut_lineage
from plotloom.sources.tables import append, load_report


@dataclass(frozen=True)
class LoadResult:
    """Rows to append, and rows that lack a part of their natural key.

    Both are lazy, and each reads the inputs when used; ``evaluated`` reads them once for both.
    """

    target: str
    new_rows: DataFrame
    rejects: DataFrame
    candidates: DataFrame | None = None
    existing: DataFrame | None = None
    keys: tuple[str, ...] = ()

    def evaluated(self) -> LoadResult:
        """The same result from one evaluation of the candidates, kept in the shared folder."""
        if self.candidates is None or self.existing is None:
            return self
        return finish_load(self.target, cut_lineage(self.candidates), self.existing, self.keys)

    def report(self) -> DataFrame:
        return load_report({self.target: self.new_rows})

    def write(self, path: str) -> None:
        append(self.new_rows, path)


def finish_load(target: str, candidates: DataFrame, existing: DataFrame, keys: Sequence[str]) -> LoadResult:
    """Reject incomplete rows, keep the new ones, number them if the table has ids."""
    complete, rejects = complete_rows(candidates, keys)
    new_rows = only_new(complete, existing, keys)
    if "id" in existing.columns:
        new_rows = assign_ids(new_rows, existing)
    return LoadResult(target, new_rows, rejects, candidates, existing, tuple(keys))
