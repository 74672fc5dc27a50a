"""Composition of self-contained DuckDB queries from named common table expressions."""

from __future__ import annotations

import re

from verification.fixture import duckdb_ctes

CTES: dict[str, str] = duckdb_ctes()


def rnd(expr: str, digits: int = 2) -> str:
    """Half-up rounding by decimal value, as Spark rounds a double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0)", digits)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def with_ctes(body: str) -> str:
    """Prefixes ``body`` with every named expression it uses, directly or not."""
    ordered: list[str] = []

    def visit(sql: str, me: str | None) -> None:
        for name in sorted(set(re.findall(r"[a-z_0-9]+", sql))):
            if name in CTES and name != me and name not in ordered:
                visit(CTES[name], name)
                ordered.append(name)

    visit(body, None)
    if not ordered:
        return body
    defined = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in ordered)
    return f"WITH {defined}\n{body}"
