"""School, university and partner leads, and the outreach table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules as R
from ..functions import classify as C, email as E, priority as P, text as T
from ..operators import dedup as D, joins as J
from ..operators.aggregates import status_breakdown, winner_totals
from ..operators.filters import email_present, email_reason, email_status, sheet_slices, split_by_priority
from ..operators.flatten import lead_projection
from ..operators.sets import sort_leads, union_sources

#: Columns every raw record carries along for ordering: source rank and position.
ORDER = ("src_rank", "pos")


def _lead_spec(labels: dict[str, str], portal: bool, hei: bool) -> dict[str, object]:
    """Raw record to lead columns; portals have fixed labels, registries bring their own."""
    name = F.coalesce(T.empty_to_null("name"), T.empty_to_null("short_name"), F.lit("")) if portal and not hei \
        else T.null_to_empty("name")
    fixed = {k: F.lit(v) for k, v in labels.items()}
    spec = {
        "src_rank": F.col("src_rank"), "pos": F.col("pos"),
        "source": ("source", labels["source"]) if portal else fixed["source"],
        "activity_code": fixed["activity_code"] if portal else ("activity_code", labels["activity_code"]),
        "activity_label": fixed["activity_label"] if portal else ("activity_label", labels["activity_label"]),
        "org_id": "org_id", "name": name, "short_name": "short_name", "director": "director", "city": "city",
        "address": "address", "phone": "phone", "email": "email",
        "website": F.lit("") if portal and not hei else "website", "url": "url",
    }
    if hei:
        spec["profile_text"] = "target_profile" if portal else "activity_label"
    return spec


def _deduped(portal: DataFrame, registry: DataFrame, labels, rule: R.EmailRule, hei: bool) -> DataFrame:
    both = union_sources([
        lead_projection(portal, _lead_spec(labels[0], True, hei)),
        lead_projection(registry, _lead_spec(labels[1], False, hei)),
    ]).withColumn("email", E.valid_or_empty("email", rule))
    return D.lead_dedup(both, ORDER)


def school_leads(portal: DataFrame, registry: DataFrame, rule: R.EmailRule = R.EMAIL_STRICT, store=None,
                 ordered: bool = True):
    """(leads with an address, leads without), portal records before registry ones.

    ``store`` (such as ``session.stored``) keeps the shared rows when both results are written;
    ``ordered``: both are sorted, which is wasted where rows are only read on.
    """
    rows = _deduped(portal, registry, (R.SCHOOL_PORTAL, R.SCHOOL_REGISTRY), rule, False).withColumn(
        "priority", P.priority_school("email", "phone", "director", "org_id"))
    main, rest = split_by_priority(store(rows) if store else rows)
    if not ordered:
        return main, rest
    return sort_leads(main, ["priority", "name"], "pos"), sort_leads(rest, ["name"], "pos")


def hei_leads(portal: DataFrame, registry: DataFrame, rule: R.EmailRule = R.EMAIL_STRICT, store=None):
    """As :func:`school_leads`, with the institution's profile and the offer made to it."""
    rows = _deduped(portal, registry, (R.HEI_PORTAL, R.HEI_REGISTRY), rule, True)
    rows = rows.withColumn("profile", C.profile_class("name", "profile_text")).drop("profile_text")
    rows = rows.withColumn("offer", F.lit(R.HEI_OFFER)).withColumn(
        "priority", P.priority_hei("email", "phone", "profile"))
    main, rest = split_by_priority(store(rows) if store else rows)
    return sort_leads(main, ["priority", "name"], "pos"), sort_leads(rest, ["name"], "pos")


def partner_leads(raw: DataFrame, labels=R.PARTNER_CODES, order=("activity_code", "pos")) -> DataFrame:
    """First record per id over the code files, with city and rank."""
    labelled = J.label_dim(D.dedup_if_key(raw, "org_id", order), labels, "activity_code", "activity_label")
    return labelled.select(
        "row_id", "activity_code", "activity_label", T.null_to_empty("org_id").alias("org_id"),
        T.null_to_empty("name").alias("name"), T.city_from_address("address").alias("city"),
        T.null_to_empty("address").alias("address"), T.null_to_empty("phone").alias("phone"),
        T.null_to_empty("email").alias("email"), T.null_to_empty("website").alias("website"),
        T.null_to_empty("products").alias("products"), P.priority_partner("email", "phone", "website").alias("priority"))


def partner_rated(leads: DataFrame, rules: R.PartnerRules = R.PartnerRules()) -> DataFrame:
    """Adds ``status`` and ``reason`` of the product-text check."""
    return leads.withColumn("_c", C.partner_class("activity_code", "products", rules)).select(
        *leads.columns, F.col("_c.status").alias("status"), F.col("_c.reason").alias("reason"))


def partner_filtered(leads: DataFrame, rules: R.PartnerRules = R.PartnerRules(), store=None):
    """(kept rows, excluded rows, breakdown) of the product-text check."""
    rated = partner_rated(leads, rules)
    rated = store(rated) if store else rated
    kept = rated.filter(F.col("status").isin(R.PARTNER_OK, R.PARTNER_CHECK))
    return kept, rated.filter(F.col("status") == R.PARTNER_REJECT), status_breakdown(rated)


def partner_site_pass(rated: DataFrame, site_texts: DataFrame, rules: R.PartnerRules = R.PartnerRules()) -> DataFrame:
    """Second look at undecided rows through their site's whole summary text (website, summary).

    The verdict depends only on the row and its site, so it is laid over the row where it stands
    instead of being collected and joined back.
    """
    undecided = (F.col("status") == R.PARTNER_CHECK) & T.blank_to_null("website").isNotNull()
    texts = site_texts.groupBy("website").agg(F.min("summary").alias("summary"))
    seen = J.lookup_join(rated, texts, F.when(undecided, F.col("website")), "website", {"summary": "_summary"})
    fresh = C.partner_reclass("_summary", rules)
    return seen.withColumn("_o", fresh).withColumns({
        "status": F.coalesce("_o.status", "status"), "reason": F.coalesce("_o.reason", "reason")}).drop("_o", "_summary")


def partner_email_pass(rated: DataFrame, statuses: DataFrame | None) -> DataFrame:
    """Adds ``verdict`` (null for rows that are not candidates or whose address is good)."""
    candidate = (F.col("status") == R.PARTNER_OK) & T.blank_to_null("email").isNotNull()
    judged = email_reason(rated, "email", statuses)
    return judged.withColumn("verdict", F.when(candidate & ~F.col("ok"), F.col("verdict"))).drop("ok")


def partners(raw: DataFrame, site_texts: DataFrame, statuses: DataFrame, labels=R.PARTNER_CODES,
             rules: R.PartnerRules = R.PartnerRules(), store=None) -> dict[str, DataFrame]:
    """All passes in one flow of rows: consolidate, check the text, check the site, validate addresses."""
    rated = partner_rated(partner_leads(raw, labels), rules)
    done = partner_email_pass(partner_site_pass(rated, site_texts, rules), statuses)
    done = store(done) if store else done
    kept, failed = F.col("status").isin(R.PARTNER_OK, R.PARTNER_CHECK), F.col("verdict").isNotNull()
    return {
        "partners": done.filter(kept).withColumns({
            "email": F.when(failed, "").otherwise(F.col("email")),
            "reason": F.coalesce("verdict", "reason")}).drop("verdict"),
        "excluded": done.filter(~kept).drop("verdict"),
        "invalid_emails": done.filter(kept & failed).select("name", "email", F.col("verdict").alias("reason")),
    }


def email_verification(leads: DataFrame, statuses: DataFrame, email: str = "email") -> DataFrame:
    return email_status(leads, email, statuses)


def _outreach(df: DataFrame, email: str, role: str, category: str, label: Column, fields: dict[str, str],
              source: Column, rank: int, row_id: str) -> DataFrame:
    picked = {n: T.nan_clean(F.col(c).cast("string")) if c else F.lit("") for n, c in fields.items()}
    return email_present(df, email).select(
        E.normalise(email).alias("email"), *[c.alias(n) for n, c in picked.items()], F.lit(role).alias("role"),
        F.lit(category).alias("category"), label.alias("priority_label"), source.alias("source"),
        F.lit(rank).alias("src_rank"), F.col(row_id).cast("string").alias("row_id"))


def master_outreach(tenders: DataFrame, contracts: DataFrame, schools: DataFrame, store=None) -> dict[str, DataFrame]:
    """One row per address over tender buyers, contract buyers and schools, plus winner totals."""
    buyer = {"name": "buyer_name", "org_id": "buyer_id", "phone": "phone", "city": "city", "region": "region"}
    school = {"name": "name", "org_id": "org_id", "phone": "phone", "city": "city", "region": None}
    label = F.concat(F.lit("P"), F.col("priority").cast("string"), F.lit(R.PRIORITY_SCHOOL_SUFFIX))
    rows = union_sources([
        _outreach(tenders, "email", R.ROLE_BUYER, R.CATEGORY_TENDER, F.lit(R.PRIORITY_TENDER), buyer,
                  F.lit("tenders"), 1, "tender_id"),
        _outreach(contracts, "email", R.ROLE_BUYER, R.CATEGORY_CONTRACT, F.lit(R.PRIORITY_CONTRACT), buyer,
                  F.lit("contracts"), 2, "contract_id"),
        _outreach(schools, "email", R.ROLE_SCHOOL, R.CATEGORY_SCHOOL, label, school, F.col("source"), 3, "pos"),
    ])
    master = D.master_dedup(rows, "email", "priority_label", ["src_rank", "row_id"]).drop("src_rank", "row_id")
    master = store(master) if store else master
    slices = sheet_slices(master, {
        "tender_buyers": ("category", R.SLICE_CATEGORY), "top_priority": ("priority_label", R.SLICE_PRIORITY)})
    winners = winner_totals(contracts, "supplier_name").withColumn("role", F.lit(R.ROLE_WINNER)).withColumn(
        "category", F.lit(R.CATEGORY_WINNER))
    return {"master": master, "winners": winners, **slices}
