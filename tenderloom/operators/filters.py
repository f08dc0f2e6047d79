"""Row filters over leads, tenders and contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules as R
from ..functions import email as E, text as T
from ..functions.priority import has
from .joins import domain_status


def email_reason(df: DataFrame, email: str, statuses: DataFrame | None = None) -> DataFrame:
    """Adds ``ok`` and ``verdict``; without a status table only the syntax is judged."""
    reason = E.syntax_reason(email)
    if statuses is not None:
        df = domain_status(df, email, statuses, R.EmailRule(f"^{R.EMAIL_BASE}$"), "_active")
        reason = F.when((reason == "ok") & ~F.col("_active"), "no_mx").otherwise(reason)
    return df.withColumn("verdict", reason).withColumn("ok", F.col("verdict") == "ok").drop("_active")


def email_status(df: DataFrame, email: str, statuses: DataFrame, domains=R.BLOCKED_13,
                 suffixes=R.SUFFIXES_4) -> DataFrame:
    """Adds ``email_status`` and ``deliverable``; the address is normalised on both sides."""
    joined = domain_status(df, email, statuses, R.EmailRule("@"), "_active")
    return (
        joined.withColumn("email_status", E.verification_status(email, F.col("_active"), domains, suffixes))
        .withColumn("deliverable", F.col("email_status") == R.STATUS_ACTIVE)
        .drop("_active")
    )


def contract_keep(df: DataFrame, min_amount: float = R.MIN_AMOUNT, deny: str = R.BUYER_DENY_CONTRACT,
                  buyer: str = "buyer_name", supplier: str = "supplier_name") -> DataFrame:
    denied = T.matches(buyer, deny) | T.matches(supplier, deny)
    return df.filter((F.coalesce("amount", F.lit(0)) >= min_amount) & ~denied)


def _items() -> Column:
    return F.coalesce(F.col("items"), F.array().cast(
        "array<struct<description:string,unit:struct<code:string>,classification:struct<id:string>>>"))


def _goods_text() -> Column:
    """Title and every item description, joined with spaces."""
    parts = F.transform(_items(), lambda i: T.null_to_empty(i["description"]))
    return F.array_join(F.concat(F.array(T.null_to_empty("title")), parts), " ")


def target_ok(keywords=R.FEED_KEYWORDS, prefixes=R.FEED_CODE_PREFIXES) -> Column:
    """Whether a tender document has a keyword in title, description or an item, or an item with one of the code prefixes."""
    text = F.lower(F.concat(T.null_to_empty("title"), F.lit(" "), T.null_to_empty("description")))

    def item_hit(i):
        code = T.null_to_empty(i["classification"]["id"])
        return T.contains_any(F.lower(T.null_to_empty(i["description"])), keywords) | code.rlike(
            f"^({'|'.join(prefixes)})")

    return T.contains_any(text, keywords) | F.exists(_items(), item_hit)


def tender_target(tenders: DataFrame, keywords=R.FEED_KEYWORDS, prefixes=R.FEED_CODE_PREFIXES) -> DataFrame:
    return tenders.filter(target_ok(keywords, prefixes))


def profile_ok(rules: R.TenderRules) -> Column:
    """Whether a tender document passes: goods, buyer, units and amount."""
    bad_unit = F.exists(
        _items(), lambda i: F.upper(T.null_to_empty(i["unit"]["code"])).isin(*rules.unit_deny))
    raw = F.col("value.amount").cast("string")
    amount = F.when(T.empty_to_null(raw).isNull(), 0.0).otherwise(raw.try_cast("double"))
    too_small = F.coalesce(amount < rules.min_amount, F.lit(False))
    return ~(
        T.matches(_goods_text(), rules.goods_deny)
        | T.matches("procuringEntity.name", rules.buyer_deny) | bad_unit | too_small
    )


def tender_profile(tenders: DataFrame, rules: R.TenderRules = R.TENDER_SEARCH) -> DataFrame:
    """Drops denied goods, denied buyers, bulk units and amounts under the minimum."""
    return tenders.filter(profile_ok(rules))


def tender_profile_coded(tenders: DataFrame, code_col: str, rules: R.TenderRules = R.TENDER_CODED) -> DataFrame:
    """As :func:`tender_profile`; a secondary class code also needs an allowed word."""
    secondary = F.coalesce(F.col(code_col).isin(*rules.secondary_codes), F.lit(False))
    return tenders.filter(profile_ok(rules) & (~secondary | T.matches(_goods_text(), rules.goods_allow)))


def strict_profile(df: DataFrame, title: str, buyer: str, rules: R.StrictProfile = R.StrictProfile()) -> DataFrame:
    """After folding look-alike letters: no denied buyer or title word, one accepted title word."""
    t, b = T.homoglyph_fold(title), T.homoglyph_fold(buyer)
    return df.filter(
        ~T.matches(b, T.alternation(rules.buyer_deny))
        & ~T.matches(t, T.alternation(rules.title_deny))
        & T.matches(t, T.alternation(rules.title_accept))
    )


def base_member(df: DataFrame, column: str, token: str, exact: bool = False) -> DataFrame:
    if exact:
        return df.filter(F.col(column) == token)
    return df.filter(F.lower(T.null_to_empty(column)).contains(token.lower()))


def nonblank_candidates(df: DataFrame, status: str, column: str, status_col: str = "status") -> DataFrame:
    return df.filter((F.col(status_col) == status) & T.blank_to_null(column).isNotNull())


def missing_key_candidates(df: DataFrame, email: str = "email", org_id: str = "org_id", min_len: int = 6) -> DataFrame:
    """Distinct zero-stripped ids of rows that have an id but no address."""
    bare = T.strip_zeros(org_id)
    keep = ~has(email) & F.col(org_id).isNotNull() & (F.length(bare) >= min_len)
    return df.filter(keep).select(bare.alias("org_id")).distinct()


def split_by_priority(df: DataFrame, column: str = "priority") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(column).isin(1, 2, 3)), df.filter(F.col(column) == 4)


def sheet_slices(df: DataFrame, slices: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Sheet name -> rows whose column contains the text; slices maps name to (column, text)."""
    return {name: df.filter(T.null_to_empty(c).contains(word)) for name, (c, word) in slices.items()}


def keyword_rows(df: DataFrame, text: str, keywords=R.CLASSIFIER_KEYWORDS) -> DataFrame:
    """Distinct texts holding a keyword, with every class code found in them."""
    hits = df.filter(T.contains_any(F.lower(T.null_to_empty(text)), keywords)).select(text).distinct()
    return hits.withColumn("codes", T.class_codes(text))


def email_present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(E.email_present(column))
