"""Putting check queries together from named table expressions (DuckDB SQL)."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def define(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _needs(sql: str) -> list[str]:
    found = dict.fromkeys(re.findall(r"\b[rt]_\w+\b", sql))
    return [n for n in found if n in CTES]


def query(sql: str) -> str:
    """The statement with the table expressions it uses, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in _needs(CTES[name]):
                visit(need)
            order.append(name)

    for name in _needs(sql):
        visit(name)
    if not order:
        return sql
    body = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {body},\n{sql.lstrip()[5:]}"
    return f"WITH {body}\n{sql}"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def items(values) -> str:
    return ", ".join(text(v) for v in values)


def pick(values, index: str) -> str:
    return f"([{items(values)}])[({index}) + 1]"


def isum(expr: str) -> str:
    return f"sum({expr})::BIGINT"


def count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def div(num: str, den: str) -> str:
    """Double ratio, NULL when the denominator is 0 or NULL."""
    return f"(({num})::DOUBLE / nullif(({den})::DOUBLE, 0))"


def div_pos(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN ({num})::DOUBLE / ({den})::DOUBLE END)"


def half_up(expr: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"(floor(({expr}) * {scale} + 0.5::DOUBLE) / {scale})"


def pct(num: str, den: str) -> str:
    return half_up(div(f"({num}) * 100.0::DOUBLE", den), 1)
