"""Keyword classifications and contact kinds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules as R
from .text import col, contains_all, contains_any, first_match, matches, null_to_empty, strip


def product_category(title, desc, groups=R.PRODUCT_GROUPS, default: str = R.PRODUCT_DEFAULT) -> Column:
    text = F.lower(F.concat(null_to_empty(title), F.lit(" "), null_to_empty(desc)))
    labels = F.concat_ws(" | ", *[F.when(contains_any(text, words), label) for words, label in groups])
    return F.when(labels != "", labels).otherwise(default)


def profile_class(name, desc, rules=R.PROFILE_RULES, default: str = R.PROFILE_DEFAULT) -> Column:
    text = F.lower(F.concat(null_to_empty(name), F.lit(" "), null_to_empty(desc)))
    result = F
    for words, every, label in rules:
        result = result.when(contains_all(text, words) if every else contains_any(text, words), label)
    return result.otherwise(default)


def contact_kind(kind, value) -> Column:
    """Independent flags: a value may be both a phone and an e-mail when its kind says phone."""
    k, v = F.lower(null_to_empty(kind)), strip(null_to_empty(value))
    is_email = contains_any(k, R.KIND_EMAIL) | v.contains("@")
    digits = F.regexp_replace(v, r"(?U)[+\-\s()]", "").rlike("^[0-9]+$") & (F.length(v) >= 7)
    is_phone = contains_any(k, R.KIND_PHONE) | (digits & ~is_email)
    is_address = contains_any(k, R.KIND_ADDRESS) & ~is_email & ~is_phone
    return F.struct(
        is_phone.alias("is_phone"), is_email.alias("is_email"), is_address.alias("is_address"))


def contact_kind_rowwise(kind, value) -> Column:
    """Exclusive kinds, phone first; null for blank or unrecognised values."""
    k, v = F.lower(null_to_empty(kind)), strip(null_to_empty(value))
    digits = F.translate(v, "+-", "").rlike("^[0-9]+$")
    return (
        F.when(v == "", None)
        .when(contains_any(k, R.KIND_PHONE) | digits, "phone")
        .when(contains_any(k, R.KIND_EMAIL) | v.contains("@"), "email")
        .when(contains_any(k, R.KIND_ADDRESS), "address")
    )


def order_class(group, item_group, ops, rules: R.OrderRules = R.OrderRules()) -> Column:
    custom = contains_any(F.lower(null_to_empty(item_group)), rules.custom_words) | contains_any(
        F.lower(null_to_empty(group)), rules.custom_words)
    regular = F.coalesce(col(ops), F.lit(0)) >= rules.regular_min_ops

    def pick(i):
        return (F.when(custom, R.ORDER_CUSTOM[i]).when(regular, R.ORDER_REGULAR[i])
                .otherwise(R.ORDER_SINGLE[i]))

    return F.struct(
        pick(0).alias("category"), pick(1).alias("order_type"), pick(2).alias("offer"))


def _cut(word: Column, length: int | None) -> Column:
    return word if length is None else F.substring(word, 1, length)


def partner_class(code, text, rules: R.PartnerRules = R.PartnerRules(), word_length: int | None = R.MATCHED_WORD_LENGTH) -> Column:
    """Status and reason from the activity code, then from the product text.

    The reason shows ``word_length`` characters of the word that matched (None: all of it).
    """
    text = null_to_empty(text)
    safe = F.coalesce(col(code).isin(*rules.safe_codes), F.lit(False))
    blank = (strip(text) == "") | (text == "nan")
    out, inside = matches(text, rules.exclude), matches(text, rules.include)
    word = F.concat(
        F.lit(R.PARTNER_REASON_EXCLUDE),
        _cut(first_match(text, rules.exclude), word_length), F.lit("…"))
    status = (
        F.when(safe, R.PARTNER_OK).when(blank, R.PARTNER_CHECK).when(inside, R.PARTNER_OK)
        .when(out, R.PARTNER_REJECT).otherwise(R.PARTNER_CHECK)
    )
    reason = (
        F.when(safe, R.PARTNER_REASON_SAFE).when(blank, R.PARTNER_REASON_BLANK)
        .when(out & inside, R.PARTNER_REASON_BOTH).when(out, word)
        .when(inside, R.PARTNER_REASON_INCLUDE).otherwise(R.PARTNER_REASON_UNCLEAR)
    )
    return F.struct(status.alias("status"), reason.alias("reason"))


def partner_reclass(text, rules: R.PartnerRules = R.PartnerRules(), word_length: int | None = R.MATCHED_WORD_LENGTH) -> Column:
    """Second look at a web page's text; null where it changes nothing. ``word_length`` as above."""
    inside, out = first_match(text, rules.include), first_match(text, rules.exclude)
    prefix = F.lit(R.PARTNER_SITE_PREFIX)
    return F.when(
        inside != "",
        F.struct(F.lit(R.PARTNER_OK).alias("status"), F.concat(prefix, inside).alias("reason")),
    ).when(
        out != "",
        F.struct(
            F.lit(R.PARTNER_REJECT).alias("status"),
            F.concat(prefix, _cut(out, word_length)).alias("reason")),
    )
