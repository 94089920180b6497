"""What a written table must satisfy to be published, checked by the write itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


class ExpectationFailed(RuntimeError):
    """A table does not satisfy what is expected of it; the run is not published."""


@dataclass(frozen=True)
class Expectation:
    """A condition (SQL text) on rows, and how much of the table may fail it. NULL fails. A table of no rows meets it unless `least_rows` says otherwise."""

    name: str
    condition: str = "true"
    share: float = 0.0
    least_rows: int = 0


def measures(expected: Sequence[Expectation]) -> list[Column]:
    """The failing rows of each expectation, as aggregates."""
    return [F.count_if(~F.coalesce(F.expr(e.condition), F.lit(False))).alias(metric(e)) for e in expected]


def metric(expected: Expectation) -> str:
    return f"fails_{expected.name}"


def broken(audit: Mapping[str, int], expected: Sequence[Expectation]) -> list[str]:
    """What the audit of a write says against the expectations."""
    found = []
    for e in expected:
        if audit["rows"] < e.least_rows:
            found.append(f"{e.name}: {audit['rows']} rows, at least {e.least_rows} are expected")
        if audit[metric(e)] > e.share * audit["rows"]:
            found.append(f"{e.name}: {audit[metric(e)]} of {audit['rows']} rows fail {e.condition}")
    return found
