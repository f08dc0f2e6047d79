"""Contact-completeness ranks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules as R
from .text import col, contains_any, null_to_empty


def has(c) -> Column:
    """Neither null nor ""."""
    return null_to_empty(c) != ""


def priority_school(email, phone, director, org_id) -> Column:
    """1 address, phone and a director or id; 2 address and phone; 3 address; 4 the rest."""
    return (F.when(~has(email), 4).when(~has(phone), 3)
            .when(has(director) | has(org_id), 1).otherwise(2))


def priority_hei(email, phone, profile, targets=R.PROFILE_TARGETS) -> Column:
    """1 address, phone and a target profile; 2 address and phone; 3 address; 4 the rest."""
    return (F.when(~has(email), 4).when(~has(phone), 3)
            .when(contains_any(F.lower(null_to_empty(profile)), targets), 1).otherwise(2))


def priority_partner(email, phone, website) -> Column:
    """1 address and phone; 2 one of them; 3 a website; 4 nothing."""
    return (F.when(has(email), F.when(has(phone), 1).otherwise(2)).when(has(phone), 2)
            .when(has(website), 3).otherwise(4))


def priority_score(label) -> Column:
    label = null_to_empty(col(label))
    return F.when(label.contains("P1"), 1).when(label.contains("P2"), 2).otherwise(3)
