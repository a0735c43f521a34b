import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlane.functions import masking, numeric, semistructured, temporal, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_rounding_is_half_away_from_zero(spark):
    cases = {"0.285": "0.29", "1.005": "1.01", "-2.345": "-2.35", "2.344": "2.34"}
    for value, want in cases.items():
        assert one(spark, numeric.round_to(F.lit(value).cast("decimal(10,3)"), 2)) == Decimal(want)


def test_percent_guards_zero_and_null(spark):
    assert one(spark, numeric.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.percent(F.lit(None).cast("int"), F.lit(4))) is None
    assert one(spark, numeric.percent(F.lit(1), F.lit(3))) == Decimal("33.33")
    assert one(spark, numeric.mean_of(F.lit(10), F.lit(0))) is None


def test_haversine(spark):
    quarter = one(spark, numeric.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert quarter == pytest.approx(6371 * 3.141592653589793 / 2)
    assert one(spark, numeric.haversine_km(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0))) == 0


def test_dates(spark):
    early, late = F.lit("2024-01-31").cast("date"), F.lit("2024-03-01").cast("date")
    assert one(spark, temporal.days_between(early, late)) == 30
    assert one(spark, temporal.days_between(late, early)) == -30
    start, end = F.lit("2024-01-01 00:00:00.9").cast("timestamp"), F.lit("2024-01-01 00:00:02").cast("timestamp")
    assert one(spark, temporal.elapsed("second", start, end)) == 1
    assert one(spark, temporal.shift("HOUR", -1, end)) == dt.datetime(2023, 12, 31, 23, 0, 2)
    with pytest.raises(ValueError):
        temporal.shift("fortnight", 1, end)
    assert one(spark, temporal.month_name(late)) == "Mar"
    assert one(spark, temporal.day_name(late)) == "Fri"


def test_text(spark):
    assert one(spark, text.joined("a", F.lit(None).cast("string"))) is None
    assert one(spark, text.joined("a", text.NEWLINE, "b")) == "a\nb"
    assert one(spark, text.last_chars(F.lit("12345"), 4)) == "2345"
    assert one(spark, text.label(F.lit("x"), {"y": "z"})) == "x"
    assert one(spark, text.label(F.lit("y"), {"y": "z"})) == "z"


def test_variant_paths(spark):
    v = semistructured.parse(F.lit('{"a": {"b": 3}, "list": [{"c": "x"}], "empty": []}'))
    assert one(spark, semistructured.at(v, "$.a.b", "int")) == 3
    assert one(spark, semistructured.at(v, "$.list[0].c", "string")) == "x"
    assert one(spark, semistructured.at(v, "$.empty[0].c", "string")) is None
    assert one(spark, semistructured.try_at(v, "$.list[0].c", "int")) is None


CONTACTS = [
    ("C001", "taro@example.com", "090-1234-5678", "PUBLIC"),
    ("C002", "a@b@example.org", "080-2345-6789", "PRIVATE"),
    ("C003", None, None, None),
]


@pytest.fixture(scope="module")
def contacts(spark):
    return spark.createDataFrame(CONTACTS, "customer_id string, email string, phone string, visibility string")


def masked(contacts, policies, role="ANALYST"):
    return {r["customer_id"]: r for r in masking.apply(contacts, policies, role).collect()}


def test_masks_for_unprivileged_role(contacts):
    assert [masked(contacts, {"email": masking.full})[c]["email"] for c in ("C001", "C003")] == ["********"] * 2
    emails = masked(contacts, {"email": masking.email})
    assert [emails[c]["email"] for c in ("C001", "C002", "C003")] == ["*****@example.com", "*****@example.org", None]
    phones = masked(contacts, {"phone": masking.phone})
    assert [phones[c]["phone"] for c in ("C001", "C003")] == ["***-****-5678", None]
    some = masked(contacts, {"email": (masking.conditional, "visibility")})
    assert [some[c]["email"] for c in ("C001", "C002")] == ["taro@example.com", "*****@example.org"]
    assert masked(contacts, {"email": masking.null})["C001"]["email"] is None
    assert len(masked(contacts, {"email": masking.hashed})["C001"]["email"]) == 64


@pytest.mark.parametrize("rule", [masking.full, masking.email, masking.phone, masking.null, masking.hashed])
def test_privileged_role_sees_clear_text(contacts, rule):
    for role in masking.PRIVILEGED_ROLES:
        assert masked(contacts, {"email": rule}, role)["C001"]["email"] == "taro@example.com"


def test_mask_keeps_type_and_reads_other_columns_before_masking(contacts):
    both = masking.apply(contacts, {"email": (masking.conditional, "visibility"), "visibility": masking.full}, "ANALYST")
    assert both.dtypes == contacts.dtypes
    assert {r["customer_id"]: r["email"] for r in both.collect()}["C001"] == "taro@example.com"
