"""Flattening of nested documents, projections, and the tender and contract jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..functions import text as T
from ..operators import flatten as L, joins as J, sets as S
from ..plans import tenders as P
from ..session import stored
from ..sources import bindings as B
from .filter_queries import CODED_SQL, CONTRACT_KEEP, CONTRACT_OUT, CONTRACT_ROWS, profile_sql, strict_sql
from .registry import (
    BIDDERS_SQL, BUYER_OUT, BUYERS_SQL, PARTY_OUT, WINNERS_SQL, ctes, lit, money, query, s_domain, s_email_ok, s_first, s_has,
    s_norm, s_strip, s_text, view,
)

TB = ctes("tender_base")


@query("tender_buyers", f"{TB}, {BUYERS_SQL} SELECT {BUYER_OUT} FROM buyers")
def _(spark, sf):
    return L.tender_buyers(B.tenders(spark, sf), ["doc"])


@query("tender_winners", f"{TB}, {WINNERS_SQL} SELECT {PARTY_OUT} FROM winners")
def _(spark, sf):
    return L.tender_winners(B.tenders(spark, sf), ["doc"])


@query("tender_bidders", f"{TB}, {BIDDERS_SQL} SELECT {PARTY_OUT} FROM bidders")
def _(spark, sf):
    return L.tender_bidders(B.tenders(spark, sf), ["doc"])


_items = range(1, 5)
_d = [f"coalesce(i{n}_desc, '')" for n in (1, 2, 3)]
_codes = "[" + ", ".join(f"coalesce(i{n}_code, '')" for n in _items) + "]"
_TENDER_NO = "coalesce(nullif(tender_no, ''), id)"


def tender_row_sql(drop_empty: bool, source: str) -> str:
    if drop_empty:
        text = f"array_to_string(list_filter([{', '.join(_d)}], lambda d: d <> ''), '; ')"
        codes = f"list_filter({_codes}, lambda c: c <> '')"
        tid, buyer, rule = _TENDER_NO, "coalesce(nullif(buyer_name, ''), nullif(buyer_legal, ''), '')", R.EMAIL_FULL
    else:
        text = f"array_to_string([{', '.join(_d)}], '; ')"
        codes, tid, buyer, rule = _codes, "id", s_text("buyer_name"), R.EMAIL_PREFIX
    email = s_strip(s_text("buyer_email"))
    return (f"SELECT {tid} AS tender_id, coalesce(nullif({text}, ''), nullif(title, ''), '') AS subject, "
            f"array_to_string(list_sort(list_distinct({codes})), ', ') AS class_codes, coalesce(amount, 0.0) AS amount, "
            f"{s_text('status')} AS status, {buyer} AS buyer_name, {s_text('buyer_id')} AS buyer_id, "
            f"CASE WHEN {s_email_ok('buyer_email', rule)} THEN {email} ELSE '' END AS email, {s_strip(s_text('buyer_phone'))} AS phone, "
            f"{s_text('buyer_city')} AS city, {s_text('buyer_region')} AS region, {lit(R.TENDER_URL)} || {tid} AS url FROM {source}")


@query("tender_row", f"""{TB} SELECT 'search' AS form, * FROM ({tender_row_sql(True, 'tender_base')})
UNION ALL SELECT 'coded', * FROM ({tender_row_sql(False, 'tender_base')})""")
def _(spark, sf):
    docs = B.tenders(spark, sf)
    return S.union_superset({"search": L.tender_row(docs, True), "coded": L.tender_row(docs, False)}, "form")


@query("contract_row", f"{TB}, {CONTRACT_ROWS} SELECT {CONTRACT_OUT} FROM rows_c")
def _(spark, sf):
    return L.contract_row(B.contracts(spark, sf))


def _pick(field: str) -> str:
    return f"CASE WHEN doc % 2 = 0 THEN s00_{field} ELSE s10_{field} END"


SUPPLIER_ROWS = f"""supplier_base AS (
SELECT doc, id, query_rank, coalesce(nullif({_pick('name')}, ''), nullif({_pick('legal')}, ''), '') AS supplier_name, {s_text(_pick('id'))} AS supplier_id,
       coalesce(nullif(signer_name, ''), nullif({_pick('contact')}, ''), '') AS signer,
       {s_norm(f"coalesce(nullif(signer_email, ''), nullif({_pick('email')}, ''), '')")} AS raw_email,
       {s_strip(f"coalesce(nullif(signer_phone, ''), nullif({_pick('phone')}, ''), '')")} AS phone, {s_text(_pick('city'))} AS city,
       coalesce(party_region, '') AS region,
       trim({s_text('street')} || ', ' || {s_text(_pick('city'))} || ', ' || coalesce(party_region, ''), ', ') AS address,
       coalesce(nullif(contract_no, ''), id) AS contract_id, coalesce(amount, 0.0) AS amount, date_signed[1:10] AS signed
FROM tender_base WHERE doc % 17 <> 0),
supplier_rows AS (SELECT *, CASE WHEN {s_email_ok('raw_email', R.EMAIL_FULL)} THEN raw_email ELSE '' END AS email FROM supplier_base WHERE supplier_name <> '')"""
SUPPLIER_OUT = "supplier_name, supplier_id, signer, email, phone, city, region, address, contract_id, amount, signed"


@query("supplier_contact_row", f"{TB}, {SUPPLIER_ROWS} SELECT {SUPPLIER_OUT} FROM supplier_rows")
def _(spark, sf):
    return L.supplier_contact_row(B.contracts(spark, sf))


# ------------------------------------------------------------------------------- projections
_full = s_strip("coalesce(firstname, '') || ' ' || coalesce(lastname, '')")


@query("customer_profile", f"""{ctes('customers_shop')} SELECT customer_id, {_full} AS full_name, email, telephone AS phone,
coalesce(CASE newsletter WHEN 1 THEN {lit(R.SUBSCRIBED)} WHEN 0 THEN {lit(R.NOT_SUBSCRIBED)} END, '') AS newsletter,
orders_completed, cast(orders_total AS double) AS orders_total, last_order_date, date_added FROM customers_shop""")
def _(spark, sf):
    rows = L.customer_profile(view(spark, sf, "customers_shop"))
    return money(rows.withColumn("newsletter", T.null_to_empty("newsletter")), "orders_total")


@query("client_rename_sorted", f"""{ctes('clients')} SELECT counterparty, cast(amount AS double) AS total_revenue, coalesce(ops, 0) AS operations, code AS erp_code,
{s_text('client_group')} AS counterparty_group, {s_text('bases')} AS source_bases FROM clients""")
def _(spark, sf):
    rows = L.client_rename_sorted(view(spark, sf, "clients"))
    return money(rows, "total_revenue").withColumns({
        "operations": F.coalesce("operations", F.lit(0)), "counterparty_group": T.null_to_empty("counterparty_group"),
        "source_bases": T.null_to_empty("source_bases")})


@query("lead_projection", f"""{ctes('leads')} SELECT lead_id, {lit(R.SCHOOL_PORTAL['activity_code'])} AS activity_code, source,
coalesce(activity_code, {lit(R.SCHOOL_REGISTRY['activity_code'])}) AS registry_code, coalesce(nullif(name, ''), nullif(short_name, ''), '') AS name,
coalesce(products, 'Освіта') AS products, {s_text('director')} AS director, {s_text('website')} AS website FROM leads""")
def _(spark, sf):
    return L.lead_projection(view(spark, sf, "leads"), {
        "lead_id": F.col("lead_id"), "activity_code": F.lit(R.SCHOOL_PORTAL["activity_code"]), "source": "source",
        "registry_code": ("activity_code", R.SCHOOL_REGISTRY["activity_code"]),
        "name": F.coalesce(T.empty_to_null("name"), T.empty_to_null("short_name"), F.lit("")),
        "products": ("products", "Освіта"), "director": "director", "website": "website"})


# ------------------------------------------------------------------------------- jobs
@query("tender_parties", f"""{TB}, {BUYERS_SQL}, {WINNERS_SQL}, {BIDDERS_SQL}
SELECT 'buyers' AS sheet, tender_id, buyer_id AS party_id, buyer_name AS party_name, email, amount FROM buyers
UNION ALL SELECT 'winners', tender_id, party_id, party_name, email, party_amount FROM winners
UNION ALL SELECT 'bidders', tender_id, party_id, party_name, email, party_amount FROM bidders""")
def _(spark, sf):
    return _party_sheets(P.tender_parties(B.tenders(spark, sf), ["doc"]))


def _party_sheets(tables):
    def pick(name, df):
        if name == "buyers":
            return df.select("tender_id", F.col("buyer_id").alias("party_id"), F.col("buyer_name").alias("party_name"), "email", "amount")
        return df.select("tender_id", "party_id", "party_name", "email", F.col("party_amount").alias("amount"))

    return S.sheets({n: pick(n, df) for n, df in tables.items()})


STRICT = f"accepted AS (SELECT * FROM buyers WHERE {strict_sql('subject', 'buyer_name')})"


@query("tender_parties_strict", f"""{TB}, {BUYERS_SQL}, {WINNERS_SQL}, {BIDDERS_SQL}, {STRICT}
SELECT 'buyers' AS sheet, tender_id, buyer_id AS party_id, buyer_name AS party_name, email, amount FROM accepted
UNION ALL SELECT 'winners', tender_id, party_id, party_name, email, party_amount FROM winners WHERE tender_id IN (SELECT tender_id FROM accepted)
UNION ALL SELECT 'bidders', tender_id, party_id, party_name, email, party_amount FROM bidders WHERE tender_id IN (SELECT tender_id FROM accepted)""")
def _(spark, sf):
    return _party_sheets(P.strict_parties(B.tenders(spark, sf), ["doc"], store=stored))


@query("tenders_semi", f"""{TB}, {WINNERS_SQL}, {BUYERS_SQL}, {STRICT}
SELECT tender_id, party_id, party_name FROM winners WHERE tender_id IN (SELECT tender_id FROM accepted)""")
def _(spark, sf):
    tables = P.tender_parties_strict(P.tender_parties(B.tenders(spark, sf), ["doc"]), store=stored)
    return tables["winners"].select("tender_id", "party_id", "party_name")


KNOWN = "known AS (SELECT domain, max(active) AS active FROM domain_status GROUP BY domain)"


def label_sql(rule: R.EmailRule) -> tuple[str, str]:
    """Joins the domain state of a valid address and gives its label."""
    return (f"LEFT JOIN known ON {s_email_ok('email', rule)} AND domain = {s_domain(s_norm('email'))}",
            f"CASE WHEN coalesce(active, false) THEN {lit(R.DOMAIN_ACTIVE_LABEL)} ELSE '' END AS domain_label")


_join_full, _label = label_sql(R.EMAIL_FULL)
_join_prefix, _ = label_sql(R.EMAIL_PREFIX)
TENDER_OUT = "tender_id, subject, class_codes, amount, status, buyer_name, buyer_id, email, phone, city, region, url"
TARGET_ROWS = f"""uniq AS (SELECT * FROM tender_base {s_first(_TENDER_NO, 'query_rank, doc')}),
target_rows AS ({tender_row_sql(True, f"(SELECT * FROM uniq WHERE {profile_sql(R.TENDER_SEARCH)})")})"""


@query("target_tenders", f"{ctes('tender_base', 'domain_status')}, {KNOWN}, {TARGET_ROWS} SELECT {TENDER_OUT}, {_label} FROM target_rows {_join_full}")
def _(spark, sf):
    return P.target_tenders(B.tenders(spark, sf), view(spark, sf, "domain_status"))


@query("coded_tenders", f"""{ctes('tender_base', 'domain_status')}, {KNOWN}, uniq AS (SELECT * FROM tender_base WHERE {CODED_SQL} {s_first('id', 'query_rank, doc')}),
coded_rows AS ({tender_row_sql(False, 'uniq')}) SELECT {TENDER_OUT}, {_label} FROM coded_rows {_join_prefix}""")
def _(spark, sf):
    return P.coded_tenders(B.tenders(spark, sf), view(spark, sf, "domain_status"), "found_code")


CONTRACT_JOB = f"""uniq_c AS (SELECT * FROM rows_c {s_first('contract_id', 'query_rank, doc')}), kept_c AS (SELECT * FROM uniq_c WHERE {CONTRACT_KEEP})"""


@query("contracts", f"""{ctes('tender_base', 'domain_status')}, {KNOWN}, {CONTRACT_ROWS}, {CONTRACT_JOB}
SELECT 'contracts' AS sheet, contract_id, amount, supplier_name, buyer_name, email, {_label}, 0 AS winners, 0 AS buyers FROM kept_c {_join_full}
UNION ALL SELECT 'parties', '', 0.0, '', '', '', '', count(DISTINCT supplier_name), count(DISTINCT buyer_name) FROM kept_c""")
def _(spark, sf):
    out = P.contracts(B.contracts(spark, sf), view(spark, sf, "domain_status"), store=stored)
    rows = out["contracts"].select("contract_id", "amount", "supplier_name", "buyer_name", "email", "domain_label",
                                   F.lit(0).alias("winners"), F.lit(0).alias("buyers"))
    empty = [F.lit("").alias(c) for c in ("supplier_name", "buyer_name", "email", "domain_label")]
    parties = out["parties"].select(F.lit("").alias("contract_id"), F.lit(0.0).alias("amount"), *empty, "winners", "buyers")
    return S.sheets({"contracts": rows, "parties": parties})


SUPPLIER_JOB = f"""{SUPPLIER_ROWS}, best_s AS (SELECT * FROM (SELECT * FROM supplier_rows {s_first('id', 'query_rank, doc')})
{s_first('supplier_name', 'email DESC, phone DESC, contract_id')})"""


@query("supplier_contacts", f"""{ctes('tender_base', 'domain_status')}, {KNOWN}, {SUPPLIER_JOB}
SELECT 'suppliers' AS sheet, supplier_name, supplier_id, signer, email, phone, address, contract_id, {_label}, 0 AS total, 0 AS with_email, 0 AS with_phone
FROM best_s {_join_full}
UNION ALL SELECT 'coverage', '', '', '', '', '', '', '', '', count(*), count(*) FILTER (contains(email, '@')), count(*) FILTER (length(phone) > 5) FROM best_s""")
def _(spark, sf):
    out = P.supplier_contacts(B.contracts(spark, sf), view(spark, sf, "domain_status"), store=stored)
    names = ["supplier_name", "supplier_id", "signer", "email", "phone", "address", "contract_id", "domain_label"]
    counts = ["total", "with_email", "with_phone"]
    return S.sheets({
        "suppliers": out["suppliers"].select(*names, *[F.lit(0).alias(c) for c in counts]),
        "coverage": out["coverage"].select(*[F.lit("").alias(c) for c in names], *counts)})
