"""A named, reusable chain of frame-to-frame steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame

from millrace.operators import columns as ops
from millrace.operators.dedup import drop_duplicates

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Recipe:
    """Steps applied in the order they were added.

    A recipe never changes: every method returns a longer one, so a common prefix
    can be shared and one recipe applied to many frames.
    """

    name: str
    steps: tuple[Step, ...] = ()

    def then(self, step: Callable[..., DataFrame], *args: Any, **kwargs: Any) -> Recipe:
        """Append any function that takes a frame first and returns a frame."""
        def bound(df: DataFrame) -> DataFrame:
            return step(df, *args, **kwargs)

        return Recipe(self.name, (*self.steps, bound))

    def rename(self, mapping: Mapping[str, str]) -> Recipe:
        return self.then(ops.rename_columns, mapping)

    def cast(self, mapping: Mapping[str, Any], strict: bool = False) -> Recipe:
        return self.then(ops.cast_columns, mapping, strict)

    def fill(self, mapping: Mapping[str, Any]) -> Recipe:
        return self.then(ops.fill_nulls, mapping)

    def drop(self, columns: Iterable[str]) -> Recipe:
        return self.then(ops.drop_columns, tuple(columns))

    def filter(self, condition: str | Column) -> Recipe:
        return self.then(ops.filter_rows, condition)

    def dedup(
        self, subset: Sequence[str] | None = None, order_by: Sequence[str | Column] | None = None
    ) -> Recipe:
        return self.then(drop_duplicates, subset, order_by)

    def audit(
        self, batch_id: str | None = None, source: str | None = None, loaded_at: datetime | None = None
    ) -> Recipe:
        return self.then(ops.add_audit_columns, batch_id, source, loaded_at)

    def flatten(
        self, column: str, prefix: str | None = None, keys: Sequence[str] | None = None
    ) -> Recipe:
        return self.then(ops.flatten_column, column, prefix, keys)

    def apply(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = df.transform(step)
        return df
