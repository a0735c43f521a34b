"""Role-dependent masks as pure column functions. Values are masked at query time only."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from .numeric import as_column

# The roles that see clear text, the mask texts and the open visibility mark.
PRIVILEGED_ROLES = ("ACCOUNTADMIN", "SYSADMIN")
FULL_MASK = "********"
EMAIL_LOCAL_PART = "(?m)^.+@"  # anchored: one try per line, linear also on long texts without @
EMAIL_MASK = "*****@"
PHONE_MASK = "***-****-"
PHONE_VISIBLE_DIGITS = 4
OPEN_VISIBILITY = "PUBLIC"


def _for_role(clear: Column, masked: Column, role: str, privileged: Iterable[str]) -> Column:
    # The role is known when the plan is built, so only one branch enters the plan.
    return clear if role in tuple(privileged) else masked


def full(value, role: str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """Constant text, also for NULL."""
    return _for_role(as_column(value), F.lit(FULL_MASK), role, privileged)


def email(value, role: str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """Keep the domain (everything after the last @)."""
    col = as_column(value)
    return _for_role(col, F.regexp_replace(col, EMAIL_LOCAL_PART, EMAIL_MASK), role, privileged)


def phone(value, role: str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """Keep the last four characters."""
    col = as_column(value)
    masked = F.concat(F.lit(PHONE_MASK), F.right(col, F.lit(PHONE_VISIBLE_DIGITS)))
    return _for_role(col, masked, role, privileged)


def conditional(value, visibility, role: str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """Clear where the other column says so, else masked like an e-mail address."""
    col = as_column(value)
    hidden = email(col, role, privileged)
    return _for_role(col, F.when(as_column(visibility) == OPEN_VISIBILITY, col).otherwise(hidden), role, privileged)


def null(value, role: str, data_type: str = "string", privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    return _for_role(as_column(value), F.lit(None).cast(data_type), role, privileged)


def hashed(value, role: str, privileged: Iterable[str] = PRIVILEGED_ROLES) -> Column:
    """SHA-256, so equal values can still be grouped."""
    col = as_column(value)
    return _for_role(col, F.sha2(col, 256), role, privileged)


Policy = tuple[Callable[..., Column], ...] | Callable[..., Column]


def apply(df: DataFrame, policies: dict[str, Policy], role: str) -> DataFrame:
    """Mask several columns at once.

    ``policies`` maps a column to a rule, or to ``(rule, extra column, ...)`` for rules that
    look at other columns. Extra columns are read before any mask; column types are kept.
    """
    types = dict(df.dtypes)
    masked = {}
    for name, policy in policies.items():
        rule, *extra = policy if isinstance(policy, tuple) else (policy,)
        masked[name] = rule(F.col(name), *[F.col(e) for e in extra], role).cast(types[name])
    return df.withColumns(masked)
