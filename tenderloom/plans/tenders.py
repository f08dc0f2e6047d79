"""Tender and contract jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules as R
from ..functions import text as T
from ..operators import dedup as D, flatten as X
from ..operators.aggregates import coverage, distinct_parties
from ..operators.filters import contract_keep, profile_ok, strict_profile, tender_profile_coded
from ..operators.joins import domain_status, tenders_semi
from ..operators.sets import sort_amount_desc


def tender_parties(tenders: DataFrame, order, rule: R.EmailRule = R.EMAIL_STRICT) -> dict[str, DataFrame]:
    return {
        "buyers": X.tender_buyers(tenders, order, rule),
        "winners": X.tender_winners(tenders, order, rule),
        "bidders": X.tender_bidders(tenders, order, rule),
    }


def tender_parties_strict(tables: dict[str, DataFrame], rules: R.StrictProfile = R.StrictProfile(), store=None) -> dict[str, DataFrame]:
    """Buyers that pass the strict profile, and the winners and bidders of their tenders.

    ``store`` (such as ``session.stored``) keeps the accepted buyers, which all three results need.
    """
    buyers = strict_profile(tables["buyers"], "subject", "buyer_name", rules)
    buyers = store(buyers) if store else buyers
    return {
        "buyers": buyers,
        "winners": tenders_semi(tables["winners"], buyers, "tender_id"),
        "bidders": tenders_semi(tables["bidders"], buyers, "tender_id"),
    }


def strict_parties(tenders: DataFrame, order, rule: R.EmailRule = R.EMAIL_STRICT, rules: R.StrictProfile = R.StrictProfile(),
                   store=None) -> dict[str, DataFrame]:
    """The same from the documents: winners and bidders of other tenders go before any of them is deduplicated."""
    buyers = strict_profile(X.tender_buyers(tenders, order, rule), "subject", "buyer_name", rules)
    buyers = store(buyers) if store else buyers
    return {
        "buyers": buyers,
        "winners": X.tender_winners(tenders, order, rule, buyers),
        "bidders": X.tender_bidders(tenders, order, rule, buyers),
    }


def _with_domain_label(df: DataFrame, statuses: DataFrame, rule: R.EmailRule) -> DataFrame:
    checked = domain_status(df, "email", statuses, rule)
    return checked.withColumn("domain_label", F.when(F.col("active"), R.DOMAIN_ACTIVE_LABEL).otherwise("")).drop("active")


#: Columns that say which of several finds of a document comes first.
FOUND = ("query_rank", "pos")


def _unique(flat: DataFrame, key: str) -> DataFrame:
    """One flat row per document found by several queries; nested documents never reach this shuffle."""
    return D.dedup_by_id_across_queries(flat, key, *FOUND).drop(key, *FOUND)


def target_tenders(found: DataFrame, statuses: DataFrame, rules: R.TenderRules = R.TENDER_SEARCH, ordered: bool = True) -> DataFrame:
    """Tenders found by text queries (with query_rank, pos): one per id, profile, domain flag.

    The first find of a tender decides, so the profile is a flag until one find per tender is left.
    ``ordered``: sorted by amount; leave it out where rows are only read on.
    """
    tid = F.coalesce(T.empty_to_null("tenderID"), T.empty_to_null("id"))
    keyed = found.withColumns({"_tid": tid, "_ok": profile_ok(rules)})
    rows = _unique(X.tender_row(keyed, drop_empty=True, keep=("_tid", "_ok", *FOUND)), "_tid").filter("_ok").drop("_ok")
    rows = _with_domain_label(rows, statuses, R.EMAIL_FULL)
    return sort_amount_desc(rows, "amount", "tender_id") if ordered else rows


def coded_tenders(found: DataFrame, statuses: DataFrame, code_col: str, rules: R.TenderRules = R.TENDER_CODED,
                  ordered: bool = True) -> DataFrame:
    """Tenders found by class code; a secondary code also needs an allowed word.

    A tender found under several codes is kept when any of them lets it pass. ``ordered``: sorted by amount.
    """
    passed = tender_profile_coded(found, code_col, rules).withColumn("_id", F.col("id"))
    rows = _unique(X.tender_row(passed, drop_empty=False, keep=("_id", *FOUND)), "_id")
    rows = _with_domain_label(rows, statuses, R.EMAIL_PREFIX)
    return sort_amount_desc(rows, "amount", "tender_id") if ordered else rows


def contracts(found: DataFrame, statuses: DataFrame, store=None, ordered: bool = True) -> dict[str, DataFrame]:
    """Signed contracts with buyer and winner, and the number of distinct parties.

    ``ordered``: contracts are sorted by amount; leave it out where rows are only read on.
    """
    cid = F.coalesce(T.empty_to_null("contractID"), T.empty_to_null("id"))
    unique = _unique(X.contract_row(found.withColumn("_cid", cid), keep=("_cid", *FOUND)), "_cid")
    rows = _with_domain_label(contract_keep(unique), statuses, R.EMAIL_FULL)
    rows = store(rows) if store else rows
    return {
        "contracts": sort_amount_desc(rows, "amount", "contract_id") if ordered else rows,
        "parties": distinct_parties(rows, {"supplier_name": "winners", "buyer_name": "buyers"}),
    }


def supplier_contacts(found: DataFrame, statuses: DataFrame, store=None) -> dict[str, DataFrame]:
    """Most complete contact row of each supplier over the distinct contracts found.

    Of a contract's suppliers the first counts, as in :func:`contracts`; the others are not read.
    """
    flat = X.supplier_contact_row(found.withColumn("_id", F.col("id")), keep=("_id", *FOUND), named=False)
    best = D.dedup_most_complete(
        _unique(flat, "_id").filter("supplier_name <> ''"), "supplier_name", ["email", "phone"], ["contract_id"])
    rows = _with_domain_label(best, statuses, R.EMAIL_FULL)
    rows = store(rows) if store else rows
    return {"suppliers": rows, "coverage": coverage(rows, email="email", phone="phone")}
