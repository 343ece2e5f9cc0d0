"""Checks that run within the job whose rows they check, by observed metrics: nothing is read twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Checked:
    """frame: the rows, to be written or counted; report(): what was seen while that was done, which waits for it."""

    def __init__(self, frame: DataFrame, seen: Observation, names: list[str]) -> None:
        self.frame, self._seen, self._names = frame, seen, names

    def report(self) -> list[tuple[str, int, int, str | None, str | None]]:
        """(check, rows, violations, the first and the last group with one) of each check; rows is 0 for an empty table."""
        m = self._seen.get
        return [(n, m["rows"], m[f"v{i}"] or 0, m[f"lo{i}"], m[f"hi{i}"]) for i, n in enumerate(self._names)]


def checked(df: DataFrame, checks: dict[str, Column], group: Column | None = None) -> Checked:
    """df with checks: by name, conditions that every row has to meet. A row where one is NULL violates it.

    group: what a violation is reported by, as text; a fixed number of values goes to the driver.
    """
    seen = Observation()
    key = (F.lit("") if group is None else group).cast("string")
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, ok in enumerate(checks.values()):
        bad = ~F.coalesce(ok, F.lit(False))
        metrics += [F.sum(F.when(bad, 1).otherwise(0)).alias(f"v{i}"), F.min(F.when(bad, key)).alias(f"lo{i}"), F.max(F.when(bad, key)).alias(f"hi{i}")]
    return Checked(df.observe(seen, *metrics), seen, list(checks))
