"""Flagging and resolving rows under the audit contract.

A flagged row keeps its place: it gains a reason code, and its status and certainty can only get
worse. A resolved row keeps flag and code and gains the method that corrected it. Rules come as a
list, and a table is rewritten by one projection however many rules it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline import vocab
from plumbline.functions.dates import parse_failed
from plumbline.functions.exprs import has_code, holds
from plumbline.functions.text import email_norm, phone_e164
from plumbline.sources.written import one_by_one

QUALITY = ["anomaly_flag", "anomaly_reason_code", "data_quality_status", "metric_certainty_level"]
AUDIT = ["resolution_applied", "resolution_method", "b_classification"]


@dataclass(frozen=True)
class Rule:
    """Rows where `when` holds carry `code`; status and certainty default to the registry."""

    code: str
    when: Column
    status: str | None = None
    certainty: str | None = None

    def ranks(self) -> tuple[int, int]:
        known = vocab.registered(self.code)
        return (
            vocab.status_rank(self.status or known.status),
            vocab.certainty_rank(self.certainty or known.certainty),
        )


@dataclass(frozen=True)
class Correction:
    """One catalogued anomaly: who is hit, what is written, which method is recorded.

    `sets` maps a column to the expression written on hit rows; `always` to one written on every
    row from the hit flag (for new marker columns). A decision that is no anomaly has no code.
    """

    code: str | None
    when: Column
    method: str | Callable[[], Column]
    sets: dict[str, Column] = field(default_factory=dict)
    always: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    classification: str | Column | None = None
    status: str | None = None
    certainty: str | None = None
    only_unresolved: bool = False

    def methods(self) -> list[tuple[Column, str]]:
        """(condition within the hit rows, method) pairs; most rules have one."""
        pairs = self.method() if callable(self.method) else [(F.lit(True), self.method)]
        return [(c, vocab.registered_method(m)) for c, m in pairs]


# ---- columns -----------------------------------------------------------------------------------
def add_anomaly_columns(
    df: DataFrame, status: str = "CLEAN", certainty: str = "CONFIRMED"
) -> DataFrame:
    vocab.status_rank(status), vocab.certainty_rank(certainty)
    return df.selectExpr(
        "*",
        "false AS anomaly_flag",
        "cast(null AS string) AS anomaly_reason_code",
        f"'{status}' AS data_quality_status",
        f"'{certainty}' AS metric_certainty_level",
    )


def add_resolution_columns(df: DataFrame) -> DataFrame:
    """Audit columns for rows not yet resolved; a table that has them is left as it is."""
    fresh = {
        "resolution_applied": "false",
        "resolution_method": "cast(null AS string)",
        "b_classification": "cast(null AS string)",
    }
    missing = [f"{e} AS {c}" for c, e in fresh.items() if c not in df.columns]
    return df.selectExpr("*", *missing) if missing else df


def _labels(labels: list[str]) -> str:
    return "array(" + ", ".join(f"'{x}'" for x in labels) + ")"


def _rank(label: str, labels: list[str]) -> str:
    """SQL for the position of a label in its severity order; the lowest for a null."""
    return f"coalesce(array_position({_labels(labels)}, {label}), 1) - 1"


def _label(rank: str, labels: list[str]) -> str:
    return f"element_at({_labels(labels)}, cast({rank} AS int) + 1)"


def more_severe(a: str, b: str, labels: list[str]) -> Column:
    """The worse of two labels, given as SQL expressions."""
    return F.expr(_label(f"greatest({_rank(a, labels)}, {_rank(b, labels)})", labels))


def _append(existing: str, hits: list[tuple[str, str]]) -> Column:
    """Comma list with the labels of the hit rules added once each, null when empty."""
    new = ", ".join(f"CASE WHEN {h} THEN '{v}' END" for h, v in hits)
    old = f"coalesce(split({existing}, ','), cast(array() AS array<string>))"
    merged = f"array_distinct(concat({old}, array_compact(array({new}))))"
    return F.expr(f"nullif(array_join({merged}, ','), '')")


def _quality_after(hits: list[tuple[str, Rule]]) -> dict[str, Column]:
    """The four quality columns after every rule in the list, whose hits are boolean columns."""

    def worst(column: str, labels: list[str], i: int) -> Column:
        ranks = [f"CASE WHEN {h} THEN {r.ranks()[i]} ELSE 0 END" for h, r in hits]
        return F.expr(_label(f"greatest({', '.join([_rank(column, labels), *ranks])})", labels))

    return {
        "anomaly_flag": F.expr(
            " OR ".join(["coalesce(anomaly_flag, false)", *[h for h, _ in hits]])
        ),
        "anomaly_reason_code": _append("anomaly_reason_code", [(h, r.code) for h, r in hits]),
        "data_quality_status": worst("data_quality_status", vocab.STATUSES, 0),
        "metric_certainty_level": worst("metric_certainty_level", vocab.CERTAINTIES, 1),
    }


def flag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Apply a list of rules at once, however many there are."""
    if not rules:
        return df
    # one run of helper columns, so a condition is computed once however often it is read
    names = [f"__rule_{i}" for i in range(len(rules))]
    df = df.withColumns({n: holds(r.when) for n, r in zip(names, rules)})
    return df.withColumns(_quality_after(list(zip(names, rules)))).drop(*names)


def _hit_before(c: Correction) -> Column:
    own = reduce(Column.__or__, [has_code("resolution_method", m) for _, m in c.methods()])
    return has_code("anomaly_reason_code", c.code) & own


def resolve(df: DataFrame, corrections: list[Correction]) -> DataFrame:
    """Flag, stamp and correct. Every condition sees the row as it was read.

    A row this correction hit before stays hit, told by its code together with its own method: the
    correction may have erased the very value that gave it away, and a second run must find the same
    rows. The code alone says nothing, since a detection rule may have written it.
    """
    df = add_resolution_columns(df)
    names = [f"__hit_{i}" for i in range(len(corrections))]
    hit = [holds(c.when) | _hit_before(c) if c.code else holds(c.when) for c in corrections]
    part = {
        f"{n}_{j}": holds(extra)
        for n, c in zip(names, corrections)
        for j, (extra, _) in enumerate(c.methods())
        if len(c.methods()) > 1
    }
    df = df.withColumns({**dict(zip(names, hit)), **part})

    hits = [
        (n, Rule(c.code, F.lit(True), c.status, c.certainty))
        for n, c in zip(names, corrections)
        if c.code
    ]
    out = _quality_after(hits) if hits else {}

    stamped, applied = [], ["coalesce(resolution_applied, false)"]
    label = F.col("b_classification")
    before = ["resolution_method IS NOT NULL"]
    for n, c in zip(names, corrections):
        here = n
        if c.only_unresolved:
            own = ", ".join(f"'{m}'" for _, m in c.methods())
            mine = f"coalesce(arrays_overlap(split(resolution_method, ','), array({own})), false)"
            here = f"({n} AND (NOT ({' OR '.join(before)}) OR {mine}))"
        for j, (_, method) in enumerate(c.methods()):
            stamped.append((f"{here} AND {n}_{j}" if f"{n}_{j}" in part else here, method))
        applied.append(here)
        if c.classification is not None:
            cls = F.lit(c.classification) if isinstance(c.classification, str) else c.classification
            label = F.when(F.expr(here), cls).otherwise(label)
        before.append(here)
    out["resolution_applied"] = F.expr(" OR ".join(applied))
    out["resolution_method"] = _append("resolution_method", stamped)
    out["b_classification"] = label

    written: dict[str, Column] = {}
    for n, c in zip(names, corrections):
        for col, value in c.sets.items():
            written[col] = F.when(F.col(n), value).otherwise(written.get(col, F.col(col)))
        for col, make in c.always.items():
            written[col] = make(F.col(n))
    return df.withColumns({**out, **written}).drop(*names, *part)


# ---- ready-made rules --------------------------------------------------------------------------
def date_parse_rule(raw: str, parsed: str) -> Rule:
    return Rule("DATE_PARSE_FAIL", parse_failed(raw, parsed))


def orphan_rule(marker: str) -> Rule:
    """After a left join: rows whose target was not there."""
    return Rule("ORPHAN_FK", F.col(marker).isNull())


def universal_rules(
    dates: list[str] = (),
    window: tuple[str, str] | None = None,
    quantities: list[str] = (),
    amounts: list[str] = (),
    required: list[str] = (),
    email: str | None = None,
    phone: str | None = None,
    channel: str | None = None,
    known_channels: list[str] = (),
    oversold: Column | None = None,
) -> list[Rule]:
    """The checks any table may ask for, from the columns it names."""
    rules = []
    for d in dates:
        if window:
            first, last = (F.lit(w).cast("date") for w in window)
            rules += [
                Rule("DATE_FUTURE", F.col(d).cast("date") > last),
                Rule("DATE_BEFORE_RANGE", F.col(d).cast("date") < first),
            ]
    rules += [Rule("NEGATIVE_QTY", F.col(c) < 0) for c in quantities]
    rules += [Rule("NEGATIVE_AMOUNT", F.col(c) < 0) for c in amounts]
    rules += [
        Rule(
            "MISSING_REQUIRED_FIELD",
            F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""),
        )
        for c in required
    ]
    if email:
        rules.append(
            Rule("EMAIL_MALFORMED", F.col(email).isNotNull() & email_norm(email).isNull())
        )
    if phone:
        rules.append(
            Rule("PHONE_NORMALISATION_FAIL", F.col(phone).isNotNull() & phone_e164(phone).isNull())
        )
    if channel:
        rules.append(
            Rule(
                "MANUAL_CHANNEL_ATTRIBUTION",
                F.col(channel).isNotNull() & ~F.col(channel).isin(list(known_channels)),
            )
        )
    if oversold is not None:
        rules.append(Rule("OVERSELL", oversold))
    return rules


# ---- profiles and assertions -------------------------------------------------------------------
def code_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, status and reason code. A clean row counts under a null code."""
    codes = F.explode_outer(F.split("anomaly_reason_code", ","))
    return one_by_one((
        df.select("data_quality_status", codes.alias("reason_code"))
        .groupBy("data_quality_status", "reason_code")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ), "code_profile")


def resolved_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Resolved rows per table and reason code: what an acceptance check compares with."""
    return one_by_one((
        df.filter("resolution_applied")
        .select(F.explode(F.split("anomaly_reason_code", ",")).alias("reason_code"))
        .groupBy("reason_code")
        .agg(F.count("*").alias("resolved_rows"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ), "resolved_counts")


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: changed_rows, rows of `after` that `before` lacks, and lost_rows, the reverse. Equal rows cancel out.

    A row stands as two 64-bit digests of its text with the names of its columns, so no row moves whole.
    """
    row = F.struct(*before.columns)
    sides = before.select(F.to_json(row).alias("row"), F.lit(1).alias("n")).unionByName(
        after.select(F.to_json(row).alias("row"), F.lit(-1).alias("n")))
    left = sides.select(F.xxhash64("row").alias("a"), F.xxhash64(F.lit(1), "row").alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return left.agg(
        F.coalesce(F.sum(F.greatest(-F.col("n"), F.lit(0))), F.lit(0)).alias("changed_rows"),
        F.coalesce(F.sum(F.greatest(F.col("n"), F.lit(0))), F.lit(0)).alias("lost_rows"),
    )


def assert_resolved_count(
    tables: dict[str, DataFrame], expected: dict[tuple[str, str], int]
) -> None:
    """Stop unless every (table, code) has the expected number of resolved rows."""
    spark = next(iter(tables.values())).sparkSession
    want = spark.createDataFrame(
        [(t, c, n) for (t, c), n in expected.items()],
        "table_name string, reason_code string, expected_rows bigint",
    )
    got = resolved_counts(tables)
    # one row per registered code at most, so the answer is small however large the tables are
    wrong = (
        want.join(got, ["table_name", "reason_code"], "left")
        .withColumn("resolved_rows", F.coalesce("resolved_rows", F.lit(0)))
        .filter("resolved_rows <> expected_rows")
    )
    if n := wrong.count():
        raise AssertionError(f"resolved rows of {n} codes differ, among them: {wrong.take(100)}")


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_schema() -> list[T.StructField]:
    return [
        T.StructField("anomaly_flag", T.BooleanType(), False),
        T.StructField("anomaly_reason_code", T.StringType(), True),
        T.StructField("data_quality_status", T.StringType(), False),
        T.StructField("metric_certainty_level", T.StringType(), False),
    ]
