"""ERP contact and sales jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules as R
from ..functions import classify as C, text as T
from ..operators import joins as J
from ..operators.aggregates import (
    consolidate_contacts, consolidate_contacts_rowwise, counterparty_summary, enrichment_summary, top_items,
)
from ..operators.filters import base_member, missing_key_candidates
from ..operators.sets import sort_amount_desc, union_superset


def erp_contacts(counterparties: DataFrame, register: DataFrame, preset: str = "a") -> DataFrame:
    """One contact row per counterparty; those without any contact line stay, with empty lists."""
    joined = J.counterparty_contacts(counterparties, register, "owner")
    return (consolidate_contacts if preset == "a" else consolidate_contacts_rowwise)(joined)


def erp_split(clients: DataFrame, sales: DataFrame, base: str) -> dict[str, DataFrame]:
    """Clients of one base with their sales summary, and the base's items by revenue."""
    own_sales = base_member(sales, "base", base, exact=True)
    own_clients = base_member(clients, "bases", base)
    merged = J.client_sales_left(own_clients, counterparty_summary(own_sales))
    return {
        "clients": sort_amount_desc(merged, "amount", "counterparty"),
        "items": top_items(own_sales),
    }


def contact_lookups(sources: DataFrame, order=("src_rank", "row_id")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First-wins lookups by id, company name and phone."""
    return tuple(
        J.build_lookup_first_wins(sources, key, order, min_len=n)
        for key, n in ((T.clean_id("org_id"), 5), (T.clean_company("name"), 4), (T.phone_last9("phone"), 9)))


def erp_enrich(df: DataFrame, sources: DataFrame, order=("src_rank", "row_id"), store=None) -> dict[str, DataFrame]:
    """First-wins enrichment: existing address, then id, name and phone lookups."""
    rows = J.tiered_contact_match(df, *contact_lookups(sources, order))
    rows = store(rows) if store else rows
    return {"contacts": rows, "summary": enrichment_summary(rows)}


def erp_enrich_last_wins(df: DataFrame, sources: DataFrame, statuses: DataFrame, row_id: str,
                         order=("src_rank", "row_id")) -> DataFrame:
    """Last-wins enrichment by id, then by the first known number of a phone list, with domain state."""
    from ..functions import email as E

    by_id = J.build_lookup_last_wins(sources, T.strip_zeros("org_id"), order)
    by_phone = J.build_lookup_last_wins(sources, T.phone_last9("phone"), order, min_len=9)
    valid = E.email_ok("email", R.EMAIL_LOOSE_8)
    id_key = F.when(~valid, F.nullif(T.strip_zeros("org_id"), F.lit("")))
    rows = J.lookup_join(df, by_id, F.when(id_key != "nan", id_key), "key", {"email": "_id_email"})
    rows = J.match_multi_phone(rows, row_id, "phone", by_phone, "_phone_email")
    found = F.when(valid, T.strip("email")).otherwise(F.coalesce("_id_email", "_phone_email", F.lit("")))
    source = (
        F.when(valid, R.FOUND_EXISTING).when(F.col("_id_email").isNotNull(), R.FOUND_ID)
        .when(F.col("_phone_email").isNotNull(), R.FOUND_PHONE).otherwise("")
    )
    rows = rows.select(*df.columns, found.alias("found_email"), source.alias("email_source"))
    return _with_mx_label(rows, "found_email", statuses)


def _with_mx_label(df: DataFrame, email: str, statuses: DataFrame) -> DataFrame:
    checked = J.domain_status(df, email, statuses, R.EMAIL_LOOSE_8, "_mx")
    label = F.when(F.col("_mx"), R.MX_ACTIVE_LABEL).when(T.blank_to_null(email).isNotNull(), R.MX_INVALID_LABEL).otherwise("")
    return checked.withColumn("mx_status", label).drop("_mx")


def erp_registry_fill(df: DataFrame, registry: DataFrame, statuses: DataFrame) -> DataFrame:
    """Fills rows without an address from registry answers for their ids."""
    wanted = missing_key_candidates(df)
    answers = J.first_valid_from_registry(registry, R.EMAIL_LOOSE_8).join(wanted, "org_id", "left_semi")
    with_cols = df
    for c in ("email_source", "mx_status"):
        if c not in df.columns:
            with_cols = with_cols.withColumn(c, F.lit(""))
    return _with_mx_label(J.fill_from_registry(with_cols, answers), "email", statuses)


def erp_segment(bases: dict[str, tuple[DataFrame, DataFrame]], columns, order,
                rules: R.OrderRules = R.OrderRules(), store=None) -> dict[str, DataFrame]:
    """Per base: verified contacts by name, order class; then all bases in one table.

    Bases that share a table of verified contacts share its lookup, which ``store`` keeps.
    """
    done, lookups = {}, {}
    for label, (base, verified) in bases.items():
        if id(verified) not in lookups:
            lookup = J.verified_lookup(verified, "counterparty", columns, order)
            lookups[id(verified)] = store(lookup) if store else lookup
        merged = J.attach_lookup(base, lookups[id(verified)], "counterparty")
        done[label] = merged.withColumn("_c", C.order_class("client_group", "main_group", "ops", rules)).select(
            *merged.columns, "_c.*")
    return {**done, "master": union_superset(done)}
