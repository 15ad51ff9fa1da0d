"""Puts the common table expressions a query mentions in front of it."""

from __future__ import annotations

import re


def compose(query: str, tables: dict[str, str]) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in tables and word not in needed:
                visit(tables[word])
                if word not in needed:
                    needed.append(word)

    visit(query)
    if not needed:
        return query
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({tables[n]})" for n in needed)
    return f"WITH {ctes}\n{query}"


STATUS = ["CLEAN", "RECONSTRUCTED", "FLAGGED_AMBIGUOUS", "FLAGGED_ANOMALY", "EXCLUDED_WITH_REASON"]
CERTAINTY = ["CONFIRMED", "INFERRED", "ESTIMATED", "UNRELIABLE"]

CLEAN = (
    "false AS anomaly_flag, NULL::VARCHAR AS anomaly_reason_code, "
    "'CLEAN' AS data_quality_status, 'CONFIRMED' AS metric_certainty_level"
)
Q = "anomaly_flag, anomaly_reason_code, data_quality_status, metric_certainty_level"
A = "resolution_applied, resolution_method, b_classification"


def quality(*hits: tuple[str, str, str, str]) -> str:
    """The four quality columns for rows hit by (predicate, code, status, certainty) rules."""
    flag = " OR ".join(p for p, *_ in hits)
    codes = ", ".join(f"CASE WHEN {p} THEN '{c}' END" for p, c, *_ in hits)

    def worst(labels: list[str], i: int) -> str:
        ranks = ", ".join(f"CASE WHEN {h[0]} THEN {labels.index(h[i])} ELSE 0 END" for h in hits)
        names = ", ".join(f"'{x}'" for x in labels)
        return f"([{names}])[1 + greatest(0, {ranks})]"

    return (
        f"coalesce({flag}, false) AS anomaly_flag, "
        f"nullif(concat_ws(',', {codes}), '') AS anomaly_reason_code, "
        f"{worst(STATUS, 2)} AS data_quality_status, "
        f"{worst(CERTAINTY, 3)} AS metric_certainty_level"
    )


def audit(*hits: tuple[str, str], cls: str = "NULL::VARCHAR") -> str:
    """The audit columns for (predicate, method) pairs."""
    flag = " OR ".join(p for p, _ in hits)
    seen: dict[str, str] = {}
    for p, m in hits:
        seen[m] = f"{seen[m]} OR {p}" if m in seen else p
    methods = ", ".join(f"CASE WHEN {p} THEN '{m}' END" for m, p in seen.items())
    return (
        f"coalesce({flag}, false) AS resolution_applied, "
        f"nullif(concat_ws(',', {methods}), '') AS resolution_method, {cls} AS b_classification"
    )


def sk(*parts: str) -> str:
    inner = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '~NULL~')" for p in parts)
    return f"sha256(concat_ws('|', {inner}))"


def okey(part: str) -> str:
    return f"CASE WHEN {part} IS NOT NULL THEN {sk(part)} END"


def dkey(day: str) -> str:
    return f"CASE WHEN {day} IS NOT NULL THEN sha256(strftime({day}, '%Y-%m-%d')) END"
