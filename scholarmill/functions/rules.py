"""Row validation with the rules given as data: an ordered list of (label, failing condition).

A condition that is NULL counts as failing: a value that cannot be judged does not pass. A rule that
lets missing values pass says so itself with ``coalesce(condition, false)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarmill.constants import MIN_PASSWORD_LENGTH
from scholarmill.functions.labs import present

Rules = list[tuple[str, Column]]


def _fails(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(True))


def first_failure(rules: Rules, passed: str = "ok") -> Column:
    """Label of the first failing rule."""
    outcome = F.lit(passed)
    for label, fails in reversed(rules):
        outcome = F.when(_fails(fails), label).otherwise(outcome)
    return outcome


def failures(rules: Rules) -> Column:
    """Labels of all failing rules, in rule order."""
    return F.array_compact(F.array(*[F.when(_fails(fails), label) for label, fails in rules]))


def registration_rules() -> Rules:
    """Rules of the sign-up form."""
    required = ["email", "password", "confirm_password", "display_name"]
    missing = F.lit(False)
    for name in required:
        missing = missing | ~present(F.col(name))
    return [
        ("missing_field", missing),
        ("password_mismatch", F.col("password") != F.col("confirm_password")),
        ("password_too_short", F.length("password") < MIN_PASSWORD_LENGTH),
    ]
