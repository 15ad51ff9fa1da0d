import pytest
from pyspark.sql import functions as F

from plumbline import vocab
from plumbline.operators import quality as q
from plumbline.operators.quality import Correction, Rule


def rows(df, *cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.fixture(scope="module")
def base(spark):
    df = spark.createDataFrame(
        [(1, True, True), (2, None, False), (3, False, True), (4, True, None)],
        "id int, c1 boolean, c2 boolean",
    )
    return q.add_anomaly_columns(df)


def test_flags_are_never_null_and_codes_keep_order(base):
    df = q.flag(base, [Rule("NEGATIVE_QTY", F.col("c1")), Rule("MOVEMENT_NULL_REF", F.col("c2"))])
    assert rows(df, *q.QUALITY) == {
        1: (True, "NEGATIVE_QTY,MOVEMENT_NULL_REF", "FLAGGED_ANOMALY", "UNRELIABLE"),
        2: (False, None, "CLEAN", "CONFIRMED"),
        3: (True, "MOVEMENT_NULL_REF", "FLAGGED_AMBIGUOUS", "INFERRED"),
        4: (True, "NEGATIVE_QTY", "FLAGGED_ANOMALY", "UNRELIABLE"),
    }


def test_a_code_is_recorded_once_and_severity_never_falls(base):
    worse = q.flag(base, [Rule("NEGATIVE_QTY", F.col("c1"))])
    again = q.flag(worse, [Rule("NEGATIVE_QTY", F.col("c1"), "RECONSTRUCTED", "INFERRED")])
    assert rows(again, *q.QUALITY) == rows(worse, *q.QUALITY)


def test_unregistered_labels_are_refused(base):
    with pytest.raises(ValueError):
        q.flag(base, [Rule("MADE_UP", F.lit(True))])
    with pytest.raises(ValueError):
        q.flag(base, [Rule("NEGATIVE_QTY", F.lit(True), "BAD")])
    with pytest.raises(ValueError):
        q.resolve(base, [Correction("NEGATIVE_QTY", F.lit(True), "MADE_UP")])
    with pytest.raises(ValueError):
        q.add_anomaly_columns(base, "BAD")


def test_registry_size_and_labels():
    assert len(vocab.REASON_CODES) == 41
    assert len(vocab.RESOLUTION_METHODS) == 17
    assert abs(sum(vocab.TRUST_WEIGHTS.values()) - 1.0) < 1e-12
    for code in vocab.REASON_CODES.values():
        vocab.status_rank(code.status), vocab.certainty_rank(code.certainty)


def fix_qty():
    return Correction(
        "NEGATIVE_QTY", F.col("qty") < 0, "CORRECTED_ATP_TO_ZERO", sets={"qty": F.lit(0)},
        always={"oversell": lambda hit: hit},
    )


def test_second_run_finds_the_same_rows_after_the_fix(spark):
    df = q.add_anomaly_columns(spark.createDataFrame([(1, -5), (2, 0), (3, None)], "id int, qty int"))
    once = q.resolve(df, [fix_qty()])
    twice = q.resolve(once, [fix_qty()])
    assert rows(once, "qty", "oversell", "resolution_applied", "resolution_method") == {
        1: (0, True, True, "CORRECTED_ATP_TO_ZERO"),
        2: (0, False, False, None),
        3: (None, False, False, None),
    }
    assert sorted(once.collect()) == sorted(twice.select(once.columns).collect())


def test_methods_add_up_and_first_resolution_wins_where_asked(spark):
    df = q.add_anomaly_columns(spark.createDataFrame([(1, "A"), (2, "B")], "id int, kind string"))
    first = Correction("NL_SELLER_SOLD_AS_REVENUE", F.col("kind") == "A", "RELABELLED_ESTIMATED_GMV")
    both = Correction("ESTIMATED_NL_GMV", F.lit(True), "B_DECISION_APPLIED", only_unresolved=True)
    also = Correction("ESTIMATED_NL_GMV", F.lit(True), "B_DECISION_APPLIED", classification="X")
    assert rows(q.resolve(df, [first, both]), "resolution_method") == {
        1: ("RELABELLED_ESTIMATED_GMV",), 2: ("B_DECISION_APPLIED",)}
    assert rows(q.resolve(df, [first, also]), "resolution_method", "b_classification") == {
        1: ("RELABELLED_ESTIMATED_GMV,B_DECISION_APPLIED", "X"), 2: ("B_DECISION_APPLIED", "X")}


def test_profile_and_resolved_counts(spark):
    df = q.add_anomaly_columns(spark.createDataFrame([(1, -5), (2, 0)], "id int, qty int"))
    fixed = q.resolve(df, [fix_qty()])
    q.assert_resolved_count({"t": fixed}, {("t", "NEGATIVE_QTY"): 1})
    with pytest.raises(AssertionError):
        q.assert_resolved_count({"t": fixed}, {("t", "NEGATIVE_QTY"): 2})
    prof = {(r.data_quality_status, r.reason_code): r.row_count for r in q.code_profile({"t": fixed}).collect()}
    assert prof == {("FLAGGED_ANOMALY", "NEGATIVE_QTY"): 1, ("CLEAN", None): 1}


def test_universal_rules(spark):
    df = q.add_anomaly_columns(spark.sql("""
        SELECT * FROM VALUES
          (1, date'2024-09-15', -1, 'a@b.co', '+91 98765 43210', 'EC'),
          (2, date'2024-02-29', 1, 'no at sign', '12', 'pigeon'),
          (3, cast(null as date), 1, null, null, null) AS t(id, d, n, mail, phone, channel)"""))
    rules = q.universal_rules(
        dates=["d"], window=("2024-03-01", "2024-09-14"), quantities=["n"], required=["d"],
        email="mail", phone="phone", channel="channel", known_channels=["EC"])
    assert rows(q.flag(df, rules), "anomaly_reason_code") == {
        1: ("DATE_FUTURE,NEGATIVE_QTY",),
        2: ("DATE_BEFORE_RANGE,EMAIL_MALFORMED,PHONE_NORMALISATION_FAIL,MANUAL_CHANNEL_ATTRIBUTION",),
        3: ("MISSING_REQUIRED_FIELD",),
    }
