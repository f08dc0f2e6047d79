"""Row filters, deduplication, sorts and unions over the bound views."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..functions import classify as C, email as E, priority as P, text as T
from ..operators import dedup as D, filters as X, flatten as L, sets as S
from ..sources import bindings as B
from .registry import (
    ctes, inlist, lit, money, query, s_any, s_email_ok, s_fold, s_has, s_lead_key, s_match, s_norm, s_org_name,
    s_p_school, s_partner, s_first, s_reason, s_stamp, s_status, s_strip, s_text, s_valid, s_zeros, s_domain, stamp, table, view,
)

# ------------------------------------------------------------------------------- e-mail verdicts
_known = "known AS (SELECT domain, max(active) AS active FROM domain_status GROUP BY domain)"
_full_ok = f"regexp_matches({s_norm('email')}, {lit('^' + R.EMAIL_BASE + '$')})"


@query("email_reason", f"""{ctes('leads', 'domain_status')}, {_known}, v AS (
SELECT lead_id, {s_reason('email')} AS syntax, coalesce(active, false) AS active FROM leads
LEFT JOIN known ON {_full_ok} AND domain = {s_domain(s_norm('email'))})
SELECT lead_id, syntax = 'ok' AND active AS ok, CASE WHEN syntax = 'ok' AND NOT active THEN 'no_mx' ELSE syntax END AS verdict, syntax FROM v""")
def _(spark, sf):
    leads = view(spark, sf, "leads").select("lead_id", "email")
    return X.email_reason(leads, "email", view(spark, sf, "domain_status")).select(
        "lead_id", "ok", "verdict", E.syntax_reason("email").alias("syntax"))


@query("email_status", f"""{ctes('leads', 'domain_status')}, {_known}
SELECT lead_id, {s_status('email', 'active')} AS email_status, {s_status('email', 'active')} = 'VALID_HOST_ACTIVE' AS deliverable
FROM leads LEFT JOIN known ON contains({s_norm('email')}, '@') AND domain = {s_domain(s_norm('email'))}""")
def _(spark, sf):
    leads = view(spark, sf, "leads").select("lead_id", "email")
    return X.email_status(leads, "email", view(spark, sf, "domain_status")).select("lead_id", "email_status", "deliverable")


@query("email_present", f"{ctes('leads')} SELECT lead_id, {s_norm('email')} AS email FROM leads WHERE contains({s_norm('email')}, '@') AND {s_norm('email')} <> 'nan'")
def _(spark, sf):
    return X.email_present(view(spark, sf, "leads"), "email").select("lead_id", E.normalise("email").alias("email"))


# ------------------------------------------------------------------------------- tenders and contracts
CONTRACT_ROWS = f"""rows_c AS (
SELECT doc, coalesce(nullif(contract_no, ''), id) AS contract_id, date_signed[1:10] AS signed, coalesce(amount, 0.0) AS amount,
       CASE WHEN doc % 17 = 0 THEN '' WHEN doc % 2 = 0 THEN {s_text('s00_name')} ELSE {s_text('s10_name')} END AS supplier_name,
       CASE WHEN doc % 17 = 0 THEN '' WHEN doc % 2 = 0 THEN {s_text('s00_id')} ELSE {s_text('s10_id')} END AS supplier_id,
       coalesce(nullif(buyer_name, ''), nullif(buyer_legal, ''), '') AS buyer_name, {s_text('buyer_id')} AS buyer_id,
       CASE WHEN {s_email_ok('buyer_email', R.EMAIL_FULL)} THEN {s_strip('buyer_email')} ELSE '' END AS email,
       {s_strip(s_text('buyer_phone'))} AS phone, {s_text('buyer_city')} AS city, {s_text('buyer_region')} AS region,
       {s_text('status')} AS status, {lit(R.CONTRACT_URL)} || coalesce(nullif(contract_no, ''), id) AS url, id, query_rank
FROM tender_base)"""
CONTRACT_OUT = ("contract_id, signed, amount, supplier_name, supplier_id, buyer_name, buyer_id, email, phone, city, region, status, url")
CONTRACT_KEEP = f"amount >= {R.MIN_AMOUNT} AND NOT {s_match('buyer_name', R.BUYER_DENY_CONTRACT)} AND NOT {s_match('supplier_name', R.BUYER_DENY_CONTRACT)}"


@query("contract_keep", f"{ctes('tender_base')}, {CONTRACT_ROWS} SELECT contract_id, amount, supplier_name, buyer_name FROM rows_c WHERE {CONTRACT_KEEP}")
def _(spark, sf):
    rows = L.contract_row(B.contracts(spark, sf))
    return X.contract_keep(rows).select("contract_id", "amount", "supplier_name", "buyer_name")


_items = range(1, 5)
_goods = "coalesce(title, '')" + "".join(f" || ' ' || coalesce(i{n}_desc, '')" for n in _items)
TARGET_SQL = "(" + " OR ".join(
    [s_any("lower(coalesce(title, '') || ' ' || coalesce(description, ''))", R.FEED_KEYWORDS)]
    + [s_any(f"lower(coalesce(i{n}_desc, ''))", R.FEED_KEYWORDS) for n in _items]
    + [f"regexp_matches(coalesce(i{n}_code, ''), {lit('^(' + '|'.join(R.FEED_CODE_PREFIXES) + ')')})" for n in _items]) + ")"


def profile_sql(rules: R.TenderRules) -> str:
    units = " OR ".join(f"coalesce(upper(i{n}_unit), '') IN {inlist(rules.unit_deny)}" for n in _items)
    return (f"NOT ({s_match(_goods, rules.goods_deny)} OR {s_match('buyer_name', rules.buyer_deny)} OR {units} "
            f"OR coalesce(amount, 0) < {rules.min_amount})")


CODED_SQL = (f"{profile_sql(R.TENDER_CODED)} AND (found_code NOT IN {inlist(R.SECONDARY_CODES)} OR {s_match(_goods, R.GOODS_ALLOW_CODED)})")


@query("tender_target", f"{ctes('tender_base')} SELECT doc, id FROM tender_base WHERE {TARGET_SQL}")
def _(spark, sf):
    return X.tender_target(B.tenders(spark, sf)).select("doc", "id")


@query("tender_profile", f"{ctes('tender_base')} SELECT doc, id FROM tender_base WHERE {profile_sql(R.TENDER_SEARCH)}")
def _(spark, sf):
    return X.tender_profile(B.tenders(spark, sf)).select("doc", "id")


@query("tender_profile_coded", f"{ctes('tender_base')} SELECT doc, id, found_code FROM tender_base WHERE {CODED_SQL}")
def _(spark, sf):
    return X.tender_profile_coded(B.tenders(spark, sf), "found_code").select("doc", "id", "found_code")


def strict_sql(title: str, buyer: str) -> str:
    return (f"NOT {s_match(s_fold(buyer), '|'.join(R.STRICT_BUYER_DENY))} AND NOT {s_match(s_fold(title), '|'.join(R.STRICT_TITLE_DENY))} "
            f"AND {s_match(s_fold(title), '|'.join(R.STRICT_TITLE_ACCEPT))}")


@query("strict_profile", f"{ctes('tender_base')} SELECT doc, title, buyer_name FROM tender_base WHERE {strict_sql('title', 'buyer_name')}")
def _(spark, sf):
    return X.strict_profile(view(spark, sf, "tender_base"), "title", "buyer_name").select("doc", "title", "buyer_name")


# ------------------------------------------------------------------------------- leads and clients
@query("base_member", f"""{ctes('clients', 'sales')} SELECT 'clients' AS part, counterparty, cast(amount AS double) AS amount FROM clients
WHERE contains(lower(coalesce(bases, '')), 'f') UNION ALL SELECT 'sales', counterparty, cast(amount AS double) FROM sales WHERE base = 'F'""")
def _(spark, sf):
    clients = X.base_member(view(spark, sf, "clients"), "bases", "F").select(F.lit("clients").alias("part"), "counterparty", "amount")
    sales = X.base_member(view(spark, sf, "sales"), "base", "F", exact=True).select(F.lit("sales").alias("part"), "counterparty", "amount")
    return money(clients.union(sales), "amount")


_status = s_partner("activity_code", "products")[0]


@query("nonblank_candidates", f"{ctes('leads')} SELECT lead_id, email FROM leads WHERE {_status} = {lit(R.PARTNER_OK)} AND {s_strip(s_text('email'))} <> ''")
def _(spark, sf):
    leads = view(spark, sf, "leads").withColumn("status", C.partner_class("activity_code", "products")["status"])
    return X.nonblank_candidates(leads, R.PARTNER_OK, "email").select("lead_id", "email")


@query("missing_key_candidates", f"""{ctes('erp_rows')} SELECT DISTINCT {s_zeros('org_id')} AS org_id FROM erp_rows
WHERE NOT {s_has('email')} AND org_id IS NOT NULL AND length({s_zeros('org_id')}) >= 6""")
def _(spark, sf):
    return X.missing_key_candidates(view(spark, sf, "erp_rows"))


_rank = s_p_school(s_valid("email", R.EMAIL_STRICT), "phone", "director", "org_id")


def _ranked(spark, sf):
    return view(spark, sf, "leads").withColumn("email", E.valid_or_empty("email")).withColumn(
        "priority", P.priority_school("email", "phone", "director", "org_id"))


@query("split_by_priority", f"""{ctes('leads')} SELECT lead_id, {_rank} AS priority, CASE WHEN {_rank} < 4 THEN 'P1-P3' ELSE 'P4' END AS sheet FROM leads""")
def _(spark, sf):
    main, rest = X.split_by_priority(_ranked(spark, sf).select("lead_id", "priority"))
    return S.sheets({"P1-P3": main, "P4": rest})


@query("sheet_slices", f"""{ctes('leads')}, l AS (SELECT lead_id, source, 'P' || ({_rank}) AS label FROM leads)
SELECT 'portal' AS sheet, lead_id FROM l WHERE contains(source, 'port') UNION ALL SELECT 'top', lead_id FROM l WHERE contains(label, 'P1')""")
def _(spark, sf):
    rows = _ranked(spark, sf).withColumn("label", F.concat(F.lit("P"), F.col("priority").cast("string"))).select("lead_id", "source", "label")
    slices = X.sheet_slices(rows, {"portal": ("source", "port"), "top": ("label", R.SLICE_PRIORITY)})
    return S.sheets({n: df.select("lead_id") for n, df in slices.items()})


@query("keyword_rows", rf"""{ctes('classifier')} SELECT DISTINCT text, array_to_string(regexp_extract_all(text, '\d{{8}}-\d'), ', ') AS codes
FROM classifier WHERE {s_any('lower(text)', R.CLASSIFIER_KEYWORDS)}""")
def _(spark, sf):
    return X.keyword_rows(view(spark, sf, "classifier"), "text").select("text", F.array_join("codes", ", ").alias("codes"))


# ------------------------------------------------------------------------------- deduplication
@query("first_wins", f"{ctes('leads')} SELECT org_id, lead_id, name FROM leads {s_first('org_id', 'src_rank, pos')}")
def _(spark, sf):
    return D.first_wins(view(spark, sf, "leads"), ["org_id"], ["src_rank", "pos"]).select("org_id", "lead_id", "name")


_clean = f"clean AS (SELECT * REPLACE ({s_valid('email', R.EMAIL_STRICT)} AS email) FROM leads)"


@query("lead_dedup", f"""{ctes('leads')}, {_clean}, d AS (SELECT * FROM clean {s_first(s_lead_key(), 'src_rank, pos')})
SELECT lead_id, {s_org_name('name')} AS org_name, email, {s_p_school('email', 'phone', 'director', 'org_id')} AS priority, {s_text('city')} AS city FROM d""")
def _(spark, sf):
    rows = D.lead_dedup(view(spark, sf, "leads").withColumn("email", E.valid_or_empty("email")), ["src_rank", "pos"])
    ranked = rows.select(
        "lead_id", T.norm_org_name("name").alias("org_name"), "email",
        P.priority_school("email", "phone", "director", "org_id").alias("priority"), T.null_to_empty("city").alias("city"))
    return S.sort_leads(ranked, ["priority", "city", "org_name"], "lead_id")


@query("dedup_if_key", f"""{ctes('leads')} SELECT lead_id, {s_text('org_id')} AS org_id FROM leads WHERE NOT {s_has('org_id')}
UNION ALL SELECT lead_id, org_id FROM (SELECT * FROM leads WHERE {s_has('org_id')} {s_first('org_id', 'pos')})""")
def _(spark, sf):
    return D.dedup_if_key(view(spark, sf, "leads"), "org_id", ["pos"]).select("lead_id", T.null_to_empty("org_id").alias("org_id"))


@query("dedup_by_id_across_queries", f"""{ctes('tender_base')} SELECT tender_no, doc, query_rank FROM tender_base WHERE {s_has('tender_no')}
{s_first('tender_no', 'query_rank, doc')}""")
def _(spark, sf):
    return D.dedup_by_id_across_queries(view(spark, sf, "tender_base"), "tender_no", "query_rank", "doc").select("tender_no", "doc", "query_rank")


@query("dedup_most_complete", f"""{ctes('leads')}, n AS (SELECT lead_id, {s_org_name('name')} AS org_name, {s_valid('email', R.EMAIL_STRICT)} AS email, phone FROM leads)
SELECT * FROM n {s_first('org_name', 'email DESC, phone DESC, lead_id')}""")
def _(spark, sf):
    rows = view(spark, sf, "leads").select("lead_id", T.norm_org_name("name").alias("org_name"), E.valid_or_empty("email").alias("email"), "phone")
    return D.dedup_most_complete(rows, "org_name", ["email", "phone"], ["lead_id"])


@query("master_dedup", f"""{ctes('leads')}, l AS (SELECT lead_id, {s_norm('email')} AS email, src_rank, 'P' || ({_rank}) AS label FROM leads WHERE contains({s_norm('email')}, '@'))
SELECT email, lead_id, label FROM l {s_first('email', "CASE WHEN contains(label, 'P1') THEN 1 WHEN contains(label, 'P2') THEN 2 ELSE 3 END, src_rank, lead_id")}""")
def _(spark, sf):
    rank = P.priority_school(E.valid_or_empty("email"), "phone", "director", "org_id").cast("string")
    rows = X.email_present(view(spark, sf, "leads"), "email").select(
        "lead_id", E.normalise("email").alias("email"), "src_rank", F.concat(F.lit("P"), rank).alias("label"))
    return D.master_dedup(rows, "email", "label", ["src_rank", "lead_id"]).select("email", "lead_id", "label")


@query("dedup_exact", "SELECT DISTINCT text FROM documents")
def _(spark, sf):
    return D.dedup_exact(table(spark, sf, "documents"), "text")


# ------------------------------------------------------------------------------- sorts, limits, unions
@query("sort_leads", f"{ctes('leads')} SELECT lead_id, {_rank} AS priority, city, name FROM leads ORDER BY 2, city NULLS FIRST, name, lead_id")
def _(spark, sf):
    return S.sort_leads(_ranked(spark, sf).select("lead_id", "priority", "city", "name"), ["priority", "city", "name"], "lead_id")


@query("sort_amount_desc", f"{ctes('clients')} SELECT counterparty, cast(amount AS double) AS amount FROM clients ORDER BY amount DESC NULLS LAST, counterparty")
def _(spark, sf):
    return money(S.sort_amount_desc(view(spark, sf, "clients").select("counterparty", "amount"), "amount", "counterparty"), "amount")


@query("pending_topk", f"""{ctes('jobs')} SELECT id, activity_code, {s_stamp('created_at')} AS created_at, attempts FROM
(SELECT * FROM jobs WHERE status = 'pending' ORDER BY created_at, id LIMIT 10)""")
def _(spark, sf):
    return S.pending_topk(view(spark, sf, "jobs"), 10).select("id", "activity_code", stamp("created_at").alias("created_at"), "attempts")


@query("union_sources", f"""{ctes('leads', 'lookup_source', 'erp_rows')} SELECT 'leads' AS origin, {s_text('name')} AS name, {s_norm('email')} AS email FROM leads
UNION ALL SELECT 'lookup', {s_text('name')}, {s_norm('email')} FROM lookup_source UNION ALL SELECT 'erp', {s_text('name')}, {s_norm('email')} FROM erp_rows""")
def _(spark, sf):
    return S.union_sources([
        view(spark, sf, v).select(F.lit(o).alias("origin"), T.null_to_empty("name").alias("name"), E.normalise("email").alias("email"))
        for v, o in (("leads", "leads"), ("lookup_source", "lookup"), ("erp_rows", "erp"))])


@query("union_superset", f"""{ctes('clients', 'counterparties')} SELECT counterparty, bases, NULL AS legal_name, 'clients' AS source_base FROM clients
UNION ALL SELECT name, NULL, legal_name, 'counterparties' FROM counterparties""")
def _(spark, sf):
    return S.union_superset({
        "clients": view(spark, sf, "clients").select("counterparty", "bases"),
        "counterparties": view(spark, sf, "counterparties").select(F.col("name").alias("counterparty"), "legal_name")})


_rej = f"{_status} = {lit(R.PARTNER_REJECT)}"


@query("union_excluded", f"""{ctes('leads')} SELECT lead_id, name FROM leads WHERE {_rej} UNION ALL SELECT lead_id, name FROM leads WHERE {_rej} AND activity_code = '46.49'""")
def _(spark, sf):
    rows = view(spark, sf, "leads").filter(C.partner_class("activity_code", "products")["status"] == R.PARTNER_REJECT)
    return S.union_excluded(rows.select("lead_id", "name"), rows.filter("activity_code = '46.49'").select("lead_id", "name"))


@query("union_ids", f"""{ctes('tender_base')} SELECT tender_no FROM tender_base WHERE query_rank = 0 AND {s_has('tender_no')}
UNION SELECT tender_no FROM tender_base WHERE query_rank = 1 AND {s_has('tender_no')} UNION SELECT tender_no FROM tender_base WHERE query_rank = 2 AND {s_has('tender_no')}""")
def _(spark, sf):
    base = view(spark, sf, "tender_base")
    return S.union_ids([base.filter(F.col("query_rank") == r) for r in (0, 1, 2)], "tender_no")


@query("column_superset", f"""{ctes('clients', 'counterparties')} SELECT counterparty, bases, NULL AS legal_name FROM clients
UNION ALL SELECT name, NULL, legal_name FROM counterparties""")
def _(spark, sf):
    a, b = L.column_superset(
        view(spark, sf, "clients").select("counterparty", "bases"),
        view(spark, sf, "counterparties").select(F.col("name").alias("counterparty"), "legal_name"))
    return a.union(b)


