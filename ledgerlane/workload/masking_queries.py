"""Masks over contact data made from the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import masking
from .registry import query
from .roles import CONTACTS, Roles

ROLE = "ANALYST"


def _sql(expression: str) -> str:
    return f"WITH {CONTACTS} SELECT customer_id, {expression} AS v FROM contacts"


@query("mask_full", _sql("'********'"))
def mask_full(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", masking.full("email", ROLE).alias("v"))


@query("mask_email", _sql("regexp_replace(email, '.+@', '*****@')"))
def mask_email(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", masking.email("email", ROLE).alias("v"))


@query("mask_phone", _sql("'***-****-' || right(phone, 4)"))
def mask_phone(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", masking.phone("phone", ROLE).alias("v"))


@query("mask_conditional", _sql("CASE WHEN visibility = 'PUBLIC' THEN email ELSE regexp_replace(email, '.+@', '*****@') END"))
def mask_conditional(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", masking.conditional("email", "visibility", ROLE).alias("v"))


@query("mask_null", _sql("CAST(NULL AS VARCHAR)"))
def mask_null(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", masking.null("email", ROLE).alias("v"))


@query("mask_hash", f"WITH {CONTACTS} SELECT sha256(risk_tolerance) AS v, count(*) AS n FROM contacts GROUP BY 1")
def mask_hash(r: Roles) -> DataFrame:
    """Hashed values still group."""
    return r.contacts.groupBy(masking.hashed("risk_tolerance", ROLE).alias("v")).agg(F.count(F.lit(1)).alias("n"))


@query("mask_apply", f"""WITH {CONTACTS}
SELECT customer_id, customer_name, CASE WHEN visibility = 'PUBLIC' THEN email ELSE regexp_replace(email, '.+@', '*****@') END AS email,
  '***-****-' || right(phone, 4) AS phone, '********' AS risk_tolerance, visibility FROM contacts""")
def mask_apply(r: Roles) -> DataFrame:
    policies = {"email": (masking.conditional, "visibility"), "phone": masking.phone, "risk_tolerance": masking.full}
    return masking.apply(r.contacts, policies, ROLE)
