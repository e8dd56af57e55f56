"""Search conditions. A condition is added only when its argument is set."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.functions.columns import published_year


def _upper_list(values: str | Iterable[str]) -> list[str]:
    parts = values.split(",") if isinstance(values, str) else values
    return [part.strip().upper() for part in parts]


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def contains(column: str | Column, text: str) -> Column:
    """Literal, case-insensitive substring; null never matches."""
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(column).contains(text.lower())


def severity_in(levels: str | Iterable[str]) -> Column:
    return F.col("severity").isin(_upper_list(levels))


def cwe_in(cwes: str | Iterable[str], exact: bool = True) -> Column:
    """Listed CWE ids; ``exact=False`` also accepts ids that contain a listed one."""
    wanted = _upper_list(cwes)
    if exact:
        return F.col("cwe").isin(wanted)
    return any_of(F.upper("cwe").contains(cwe) for cwe in wanted)


def advisory_filters(
    cves: DataFrame,
    severity: str | Iterable[str] | None = None,
    cwe: str | Iterable[str] | None = None,
    since: int | None = None,
    min_cvss: float | None = None,
    exact_cwe: bool = True,
) -> DataFrame:
    if severity:
        cves = cves.filter(severity_in(severity))
    if cwe:
        cves = cves.filter(cwe_in(cwe, exact_cwe))
    if since:
        # The stored year prunes partitions; the string is all there is otherwise.
        cves = cves.filter(
            F.col("year") >= since if "year" in cves.columns else published_year(F.col("published")) >= str(since)
        )
    if min_cvss:
        cves = cves.filter(F.col("cvss") >= float(min_cvss))
    return cves
