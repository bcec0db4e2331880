"""Pieces of oracle SQL used by several queries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

IS_NUMBER = r"coalesce(regexp_matches({0}, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'), false)"
TO_NUMBER = "CASE WHEN " + IS_NUMBER + " THEN try_cast({0} AS DOUBLE) END"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values: Iterable) -> str:
    return "(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def case_members(column: str, labels: Mapping[str, Iterable[str]]) -> str:
    arms = "\n".join(f"WHEN {column} IN {in_list(members)} THEN {text(name)}" for name, members in labels.items())
    return f"CASE {arms} END"


def case_values(column: str, mapping: Mapping[str, str]) -> str:
    arms = "\n".join(f"WHEN {text(old)} THEN {text(new)}" for old, new in mapping.items())
    return f"CASE {column} {arms} ELSE {column} END"


def _head(scope: str, tag: str) -> str:
    return f"'{scope}' AS {tag}, " if tag else ""


def numeric_profile(table: str, columns: Iterable[str], scopes: Mapping[str, str], tag: str = "") -> str:
    """One grouped query per scope and column, as a reader would write it by hand."""
    return "\nUNION ALL\n".join(
        f"""SELECT {_head(scope, tag)}'{name}' AS variable, CAST(count("{name}") AS BIGINT) AS n,
        round(min("{name}"), 3) AS min, round(max("{name}"), 3) AS max, round(avg("{name}"), 3) AS mean,
        round(stddev_samp("{name}"), 3) AS sd FROM {table} WHERE {member} HAVING count("{name}") > 0"""
        for scope, member in scopes.items()
        for name in columns
    )


def frequencies(table: str, columns: Iterable[str], scopes: Mapping[str, str], tag: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT {_head(scope, tag)}'{name}' AS variable, "{name}" AS value, CAST(count(*) AS BIGINT) AS count
        FROM {table} WHERE {member} GROUP BY "{name}" """
        for scope, member in scopes.items()
        for name in columns
    )
