"""One parameterised e-mail validator and its verdict columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .. import rules as R
from .text import col, null_to_empty, strip


def normalise(c) -> Column:
    return F.lower(strip(null_to_empty(c)))


def domain_of(c) -> Column:
    """The part after the last "@" of an already normalised address."""
    return F.substring_index(col(c), "@", -1)


def ends_with_any(c, suffixes) -> Column:
    test = F.lit(False)
    for suffix in suffixes:
        test = test | c.endswith(suffix)
    return test


def rule_pattern(rule: R.EmailRule) -> str:
    """A whole rule as one expression over the normalised address.

    Length and blocklists become look-aheads, so the address is normalised and scanned once. No
    blocked suffix holds "@": the end of the address is the end of its domain.
    """
    guards = ""
    if rule.length:
        guards += "(?=.{%d,%d}$)" % rule.length
    if rule.blocked_domains:
        guards += f"(?!.*@(?:{_any_of(rule.blocked_domains)})$)"
    if rule.blocked_suffixes:
        guards += f"(?!.*(?:{_any_of(rule.blocked_suffixes)})$)"
    flags = "(?sU)" if r"\s" in rule.pattern else "(?s)"
    return f"{flags}^{guards}{rule.pattern.removeprefix('^')}" if rule.pattern.startswith("^") else f"{flags}{rule.pattern}"


def _any_of(words) -> str:
    return "|".join(re.escape(w) for w in words)


def email_ok(c, rule: R.EmailRule = R.EMAIL_STRICT) -> Column:
    return normalise(c).rlike(rule_pattern(rule))


def valid_or_empty(c, rule: R.EmailRule = R.EMAIL_STRICT) -> Column:
    return F.when(email_ok(c, rule), normalise(c)).otherwise("")


def email_present(c) -> Column:
    address = normalise(c)
    return address.contains("@") & (address != "nan")


def syntax_reason(c) -> Column:
    """``empty``, ``bad_syntax`` or ``ok`` before any look at the domain."""
    address = normalise(c)
    good = address.rlike(f"^{R.EMAIL_BASE}$") & ~address.rlike(f"(?iu){R.EMAIL_JUNK}")
    return F.when(address == "", "empty").when(~good, "bad_syntax").otherwise("ok")


def verification_status(c, active: Column, domains=R.BLOCKED_13, suffixes=R.SUFFIXES_4) -> Column:
    """Verification state of an address, given whether its domain answers."""
    address = normalise(c)
    domain = domain_of(address)
    blocked = domain.isin(*domains) | ends_with_any(domain, suffixes)
    return (
        F.when(col(c).isNull(), R.STATUS_UNKNOWN)
        .when(~address.contains("@"), R.STATUS_SYNTAX)
        .when(blocked, R.STATUS_BLOCKED)
        .when(F.coalesce(active, F.lit(False)), R.STATUS_ACTIVE)
        .otherwise(R.STATUS_NO_HOST)
    )
