"""Lookup joins and the lead and ERP jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..functions import classify as C, email as E, text as T
from ..operators import aggregates as A, filters as X, joins as J, pages as G, sets as S
from ..plans import erp as P, leads as Q, tenders as TP
from ..session import stored
from ..sources import bindings as B
from .aggregate_queries import CONSOLIDATED, CONS_OUT, REGISTER, SUMMARY_SQL, consolidated
from .filter_queries import CONTRACT_ROWS
from .registry import (
    ctes, inlist, lit, money, query, s_any, s_city, s_clean_id, s_company, s_domain, s_email_ok, s_first, s_has, s_label, s_last9,
    s_lead_key, s_norm, s_norm_name, s_order_class, s_p_hei, s_p_partner, s_p_school, s_partner, s_profile, s_reason, s_reclass,
    s_status, s_strip, s_text, s_valid, s_zeros, table, view,
)
from .tender_queries import CONTRACT_JOB, KNOWN, TARGET_ROWS
from .text_queries import s_lookup_key


@query("counterparty_contacts", f"""{ctes('counterparties', 'contact_register')}, {REGISTER}
SELECT code, name, coalesce(pos, -1) AS pos, {s_text('kind')} AS kind, {s_text('value')} AS value FROM reg""")
def _(spark, sf):
    rows = J.counterparty_contacts(view(spark, sf, "counterparties"), view(spark, sf, "contact_register"), "owner")
    return rows.select("code", "name", F.coalesce("pos", F.lit(-1)).alias("pos"), T.null_to_empty("kind").alias("kind"), T.null_to_empty("value").alias("value"))


BASE_SQL = "base AS (SELECT *, CASE WHEN ops IS NULL THEN '' ELSE counterparty END AS party FROM clients)"
VERIFIED_SQL = f"""ver AS (SELECT *, {s_norm_name("CASE WHEN city IS NULL THEN '   ' ELSE name END")} AS k FROM leads
QUALIFY row_number() OVER (PARTITION BY k ORDER BY src_rank, pos) = 1)"""


def _base(spark, sf):
    return view(spark, sf, "clients").withColumn("party", F.when(F.col("ops").isNull(), "").otherwise(F.col("counterparty")))


def _verified(spark, sf):
    return view(spark, sf, "leads").withColumn("party", F.when(F.col("city").isNull(), "   ").otherwise(F.col("name")))


@query("attach_verified", f"""{ctes('clients', 'leads')}, {BASE_SQL}, {VERIFIED_SQL}
SELECT base.code, base.party, {s_text('ver.email')} AS email, {s_text('ver.org_id')} AS org_id, {s_text('ver.phone')} AS phone
FROM base LEFT JOIN ver ON {s_norm_name('base.party')} = ver.k""")
def _(spark, sf):
    rows = J.attach_verified(_base(spark, sf), _verified(spark, sf), "party", ["org_id", "phone", "email", "absent"], ["src_rank", "pos"])
    return rows.select("code", "party", *[T.null_to_empty(c).alias(c) for c in ("email", "org_id", "phone")])


@query("client_sales_left", f"""{ctes('clients', 'sales')}, base_sales AS (SELECT * FROM sales), {SUMMARY_SQL}
SELECT c.counterparty, cast(c.amount AS double) AS amount, coalesce(sales_amount, cast(c.amount AS double)) AS revenue, coalesce(main_group, '') AS main_group,
coalesce(operations, 0) AS operations FROM clients c LEFT JOIN summed s ON c.counterparty = s.counterparty""")
def _(spark, sf):
    rows = J.client_sales_left(view(spark, sf, "clients"), A.counterparty_summary(view(spark, sf, "sales")))
    return money(rows.select("counterparty", "amount", "revenue", T.null_to_empty("main_group").alias("main_group"),
                             F.coalesce("operations", F.lit(0)).alias("operations")), "amount", "revenue")


@query("new_only", f"""{ctes('tender_base')} SELECT doc, tender_no FROM tender_base WHERE {s_has('tender_no')}
AND tender_no NOT IN (SELECT tender_no FROM tender_base WHERE query_rank = 0 AND tender_no IS NOT NULL)""")
def _(spark, sf):
    base = view(spark, sf, "tender_base").select("doc", "tender_no", "query_rank")
    return J.new_only(base, base.filter("query_rank = 0 AND tender_no IS NOT NULL"), "tender_no").select("doc", "tender_no")


@query("label_dim", f"""{ctes('leads')} SELECT lead_id, {s_label('activity_code', R.PARTNER_CODES)} AS label, coalesce(r_name, city, '') AS region_label
FROM leads LEFT JOIN nation ON n_name = city LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(spark, sf):
    dim = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    rows = J.label_dim(view(spark, sf, "leads").select("lead_id", "activity_code", "city"), R.PARTNER_CODES, "activity_code")
    return J.label_dim(rows, dim, "city", "region_label").select("lead_id", "label", T.null_to_empty("region_label").alias("region_label"))


# ------------------------------------------------------------------------------- lookups
def lookup_sql(name: str, key: str, min_len: int, last: bool = False) -> str:
    order = "src_rank DESC, row_id DESC" if last else "src_rank, row_id"
    return (f"{name} AS (SELECT k AS key, {s_norm('email')} AS email, source FROM (SELECT *, {key} AS k FROM lookup_source) "
            f"WHERE length(k) >= {min_len} AND {s_email_ok('email', R.EMAIL_LOOSE_8)} {s_first('k', order)})")


FIRST_SQL = ", ".join([
    lookup_sql("by_id", s_clean_id("org_id"), 5), lookup_sql("by_name", s_company("name"), 4), lookup_sql("by_phone", s_last9("phone"), 9)])
LAST_SQL = ", ".join([lookup_sql("last_id", s_zeros("org_id"), 1, True), lookup_sql("last_phone", s_last9("phone"), 9, True)])


@query("build_lookup_first_wins", f"""{ctes('lookup_source')}, {FIRST_SQL} SELECT 'id' AS tier, * FROM by_id UNION ALL SELECT 'name', * FROM by_name
UNION ALL SELECT 'phone', * FROM by_phone""")
def _(spark, sf):
    return S.union_superset(dict(zip(("id", "name", "phone"), P.contact_lookups(view(spark, sf, "lookup_source")))), "tier")


@query("build_lookup_last_wins", f"{ctes('lookup_source')}, {LAST_SQL} SELECT 'id' AS tier, * FROM last_id UNION ALL SELECT 'phone', * FROM last_phone")
def _(spark, sf):
    src, order = view(spark, sf, "lookup_source"), ("src_rank", "row_id")
    return S.union_superset({
        "id": J.build_lookup_last_wins(src, T.strip_zeros("org_id"), order),
        "phone": J.build_lookup_last_wins(src, T.phone_last9("phone"), order, min_len=9)}, "tier")


_valid = s_email_ok("l.email", R.EMAIL_LOOSE_8)
TIERED_SQL = f"""{FIRST_SQL}, tiered AS (
SELECT l.lead_id, CASE WHEN {_valid} THEN {s_strip('l.email')} ELSE coalesce(i.email, n.email, p.email, '') END AS found_email,
CASE WHEN {_valid} THEN {lit(R.MATCH_EXISTING[0])} WHEN coalesce(i.source, n.source, p.source) IS NOT NULL
     THEN {lit(R.MATCH_PREFIX)} || coalesce(i.source, n.source, p.source) ELSE '' END AS email_source,
CASE WHEN {_valid} THEN {lit(R.MATCH_EXISTING[1])} WHEN i.email IS NOT NULL THEN {lit(R.MATCH_ID)} WHEN n.email IS NOT NULL THEN {lit(R.MATCH_NAME)}
     WHEN p.email IS NOT NULL THEN {lit(R.MATCH_PHONE)} ELSE '' END AS match_type
FROM leads l LEFT JOIN by_id i ON {s_clean_id('l.org_id')} = i.key LEFT JOIN by_name n ON {s_company('l.name')} = n.key
LEFT JOIN by_phone p ON {s_last9('l.phone')} = p.key)"""


def _tiered(spark, sf):
    return J.tiered_contact_match(view(spark, sf, "leads"), *P.contact_lookups(view(spark, sf, "lookup_source")))


@query("tiered_contact_match", f"{ctes('leads', 'lookup_source')}, {TIERED_SQL} SELECT * FROM tiered")
def _(spark, sf):
    return _tiered(spark, sf).select("lead_id", "found_email", "email_source", "match_type")


SUMMARY_OUT = f"""count(*) AS total, count(*) FILTER (match_type = {lit(R.MATCH_EXISTING[1])}) AS already_valid,
count(*) FILTER (found_email <> '' AND match_type <> {lit(R.MATCH_EXISTING[1])}) AS newly_enriched, count(*) FILTER (match_type = {lit(R.MATCH_ID)}) AS by_id,
count(*) FILTER (match_type = {lit(R.MATCH_NAME)}) AS by_name, count(*) FILTER (match_type = {lit(R.MATCH_PHONE)}) AS by_phone,
count(*) FILTER (found_email <> '') AS with_email"""


@query("enrichment_summary", f"{ctes('leads', 'lookup_source')}, {TIERED_SQL} SELECT {SUMMARY_OUT} FROM tiered")
def _(spark, sf):
    return A.enrichment_summary(_tiered(spark, sf))


PHONES_SQL = f"""chunks AS (SELECT lead_id, i, {s_last9('l[i]')} AS k FROM (SELECT lead_id, l, unnest(range(1, len(l) + 1)) AS i
FROM (SELECT lead_id, string_split_regex({s_text('phones')}, '[;,/]') AS l FROM leads))),
phone_hits AS (SELECT lead_id, arg_min(email, i) AS phone_email FROM chunks JOIN last_phone ON k = key GROUP BY lead_id)"""


@query("match_multi_phone", f"""{ctes('leads', 'lookup_source')}, {LAST_SQL}, {PHONES_SQL}
SELECT l.lead_id, phones, coalesce(phone_email, '') AS phone_email FROM leads l LEFT JOIN phone_hits h ON l.lead_id = h.lead_id""")
def _(spark, sf):
    lookup = J.build_lookup_last_wins(view(spark, sf, "lookup_source"), T.phone_last9("phone"), ("src_rank", "row_id"), min_len=9)
    rows = J.match_multi_phone(view(spark, sf, "leads").select("lead_id", "phones"), "lead_id", "phones", lookup)
    return rows.withColumn("phone_email", T.null_to_empty("phone_email"))


@query("domain_status", f"""{ctes('leads', 'domain_status')}, {KNOWN} SELECT lead_id, {s_text('email')} AS email, coalesce(active, false) AS active
FROM leads LEFT JOIN known ON {s_email_ok('email', R.EMAIL_LOOSE_8)} AND domain = {s_domain(s_norm('email'))}""")
def _(spark, sf):
    return J.domain_status(view(spark, sf, "leads").select("lead_id", T.null_to_empty("email").alias("email")), "email", view(spark, sf, "domain_status"))


# ------------------------------------------------------------------------------- registry answers
def registry_sql(rule: R.EmailRule) -> str:
    return (f"answers AS (SELECT bare AS org_id, {s_strip('email')} AS email, registry FROM (SELECT * REPLACE ({s_zeros('org_id')} AS org_id), {s_zeros('org_id')} AS bare "
            f"FROM registry_response) WHERE length(bare) >= 6 AND {s_email_ok('email', rule)} {s_first('bare', 'registry_rank, pos')})")


@query("first_valid_from_registry", f"{ctes('registry_response')}, {registry_sql(R.EMAIL_SUFFIX_ONLY)} SELECT * FROM answers")
def _(spark, sf):
    return J.first_valid_from_registry(view(spark, sf, "registry_response"))


FILL_SQL = f"""filled AS (SELECT e.row_id, coalesce(a.email, e.email, '') AS email, coalesce(a.registry, '') AS email_source,
CASE WHEN a.email IS NOT NULL THEN {lit(R.MX_ACTIVE_LABEL)} ELSE '' END AS mx_status
FROM erp_rows e LEFT JOIN answers a ON NOT {s_has('e.email')} AND {s_zeros('e.org_id')} = a.org_id)"""


@query("fill_from_registry", f"{ctes('erp_rows', 'registry_response')}, {registry_sql(R.EMAIL_SUFFIX_ONLY)}, {FILL_SQL} SELECT * FROM filled")
def _(spark, sf):
    rows = view(spark, sf, "erp_rows").withColumns({"email_source": F.lit(""), "mx_status": F.lit("")})
    answers = J.first_valid_from_registry(view(spark, sf, "registry_response"))
    return J.fill_from_registry(rows, answers).select("row_id", "email", "email_source", "mx_status")


@query("erp_registry_fill", f"""{ctes('erp_rows', 'registry_response', 'domain_status')}, {KNOWN}, {registry_sql(R.EMAIL_LOOSE_8)}, {FILL_SQL}
SELECT row_id, email, email_source, CASE WHEN coalesce(active, false) THEN {lit(R.MX_ACTIVE_LABEL)} WHEN {s_strip('email')} <> '' THEN {lit(R.MX_INVALID_LABEL)} ELSE '' END AS mx_status
FROM filled LEFT JOIN known ON {s_email_ok('email', R.EMAIL_LOOSE_8)} AND domain = {s_domain(s_norm('email'))}""")
def _(spark, sf):
    rows = P.erp_registry_fill(view(spark, sf, "erp_rows"), view(spark, sf, "registry_response"), view(spark, sf, "domain_status"))
    return rows.select("row_id", "email", "email_source", "mx_status")


_ce, _cp = s_strip(s_text("l.email")), s_strip(s_text("l.phone"))
_phones2 = "array_to_string(list_sort(list_distinct([phone2, phone1, '+380' || digits3]))[1:2], ', ')"


def fill_sql(preset: str) -> str:
    he, hp = f"{_ce} NOT IN ('', 'nan')", f"{_cp} NOT IN ('', 'nan')"
    if preset == "first":
        he, hp = f"({he} AND contains({_ce}, '@'))", f"({hp} AND length({_cp}) > 5)"
    mail = "lower(mail2)" if preset == "first" else "lower(mail1)"
    return (f"SELECT '{preset}' AS preset, l.lead_id, {s_text(f'CASE WHEN {he} OR d.key IS NULL THEN l.email ELSE {mail} END')} AS email, "
            f"{s_text(f'CASE WHEN {hp} OR d.key IS NULL THEN l.phone ELSE {_phones2} END')} AS phone "
            f"FROM leads l LEFT JOIN directory_pages d ON {s_lookup_key('l.org_id', 'l.name', 8)} = d.key")


@query("fill_missing_only", f"{ctes('leads', 'directory_pages')} {fill_sql('first')} UNION ALL {fill_sql('sorted')}")
def _(spark, sf):
    leads, pages = view(spark, sf, "leads"), view(spark, sf, "directory_pages").select("key", "html")
    return S.union_superset({
        p: J.fill_missing_only(leads, pages, p).select("lead_id", T.null_to_empty("email").alias("email"), T.null_to_empty("phone").alias("phone"))
        for p in ("first", "sorted")}, "preset")


# ------------------------------------------------------------------------------- partner passes
_status, _reason = s_partner("activity_code", "products")
PARTNER_SQL = f"""pl AS (SELECT lead_id, {s_text('name')} AS name, {s_text('email')} AS email, {s_text('phone')} AS phone, {s_text('website')} AS website, activity_code,
{s_label('activity_code', R.PARTNER_CODES)} AS activity_label, {s_text('products')} AS products, {s_city('address', chr(92) + 's+')} AS city, {s_text('org_id')} AS org_id,
{s_p_partner('email', 'phone', 'website')} AS priority FROM leads
QUALIFY row_number() OVER (PARTITION BY {s_text('org_id')}, CASE WHEN {s_has('org_id')} THEN NULL ELSE pos END ORDER BY activity_code, pos) = 1)"""
RATED_SQL = f"rated AS (SELECT *, {_status} AS status, {_reason} AS reason FROM pl)"
_rs, _rr = s_reclass("summary")
SITE_SQL = f"""overlay AS (SELECT lead_id, {_rs} AS new_status, {_rr} AS new_reason FROM rated JOIN site_pages ON website = url
WHERE status = {lit(R.PARTNER_CHECK)} AND {s_strip('website')} <> ''),
laid AS (SELECT rated.* REPLACE (coalesce(new_status, status) AS status, coalesce(new_reason, reason) AS reason) FROM rated LEFT JOIN overlay ON rated.lead_id = overlay.lead_id),
kept AS (SELECT * FROM laid WHERE status <> {lit(R.PARTNER_REJECT)}), gone AS (SELECT * FROM laid WHERE status = {lit(R.PARTNER_REJECT)})"""
VERDICT_SQL = f"""verdicts AS (SELECT lead_id, CASE WHEN {s_reason('email')} = 'ok' AND NOT coalesce(active, false) THEN 'no_mx' ELSE {s_reason('email')} END AS verdict
FROM kept LEFT JOIN known ON {s_email_ok('email', R.EmailRule('^' + R.EMAIL_BASE + '$'))} AND domain = {s_domain(s_norm('email'))}
WHERE status = {lit(R.PARTNER_OK)} AND {s_strip('email')} <> ''),
failed AS (SELECT * FROM verdicts WHERE verdict <> 'ok')"""


def _partner_raw(spark, sf):
    return view(spark, sf, "leads").withColumn("row_id", F.col("lead_id"))


def _site_texts(spark, sf):
    return G.page_summary_text(view(spark, sf, "site_pages").select("url", "html"), max_chars=None).select(F.col("url").alias("website"), "summary")


@query("partner_leads", f"""{ctes('leads')}, {PARTNER_SQL} SELECT lead_id AS row_id, activity_code, activity_label, org_id, name, city, priority FROM pl""")
def _(spark, sf):
    return Q.partner_leads(_partner_raw(spark, sf)).select("row_id", "activity_code", "activity_label", "org_id", "name", "city", "priority")


@query("partner_filtered", f"""{ctes('leads')}, {PARTNER_SQL}, {RATED_SQL} SELECT CASE WHEN status = {lit(R.PARTNER_REJECT)} THEN 'excluded' ELSE 'kept' END AS sheet,
lead_id AS row_id, status, reason FROM rated""")
def _(spark, sf):
    kept, gone, _ = Q.partner_filtered(Q.partner_leads(_partner_raw(spark, sf)), store=stored)
    return S.sheets({"kept": kept.select("row_id", "status", "reason"), "excluded": gone.select("row_id", "status", "reason")})


@query("apply_reclass", f"""{ctes('leads', 'site_pages')}, {PARTNER_SQL}, {RATED_SQL}, {SITE_SQL}
SELECT 'kept' AS sheet, lead_id AS row_id, status, reason FROM kept UNION ALL SELECT 'excluded', lead_id, status, reason FROM gone""")
def _(spark, sf):
    kept, gone, _ = Q.partner_filtered(Q.partner_leads(_partner_raw(spark, sf)), store=stored)
    candidates = X.nonblank_candidates(kept, R.PARTNER_CHECK, "website").select("row_id", "website")
    seen = J.lookup_join(candidates, _site_texts(spark, sf), F.col("website"), "website", {"summary": "summary"})
    overlay = seen.select("row_id", C.partner_reclass("summary").alias("o")).filter("o is not null").select("row_id", "o.status", "o.reason")
    kept, gone = J.apply_reclass(kept, gone, overlay)
    return S.sheets({"kept": kept.select("row_id", "status", "reason"), "excluded": gone.select("row_id", "status", "reason")})


@query("apply_invalid", f"""{ctes('leads', 'domain_status')}, {KNOWN}, {PARTNER_SQL}, {RATED_SQL}, kept AS (SELECT * FROM rated WHERE status <> {lit(R.PARTNER_REJECT)}), {VERDICT_SQL}
SELECT 'cleaned' AS sheet, name, CASE WHEN verdict IS NULL THEN email ELSE '' END AS email, coalesce(verdict, reason) AS reason FROM kept LEFT JOIN failed USING (lead_id)
UNION ALL SELECT 'rejects', name, email, verdict FROM kept JOIN failed USING (lead_id)""")
def _(spark, sf):
    kept, _, _ = Q.partner_filtered(Q.partner_leads(_partner_raw(spark, sf)), store=stored)
    candidates = X.nonblank_candidates(kept, R.PARTNER_OK, "email").select("row_id", "email")
    verdicts = X.email_reason(candidates, "email", view(spark, sf, "domain_status"))
    cleaned, rejects = J.apply_invalid(kept, verdicts)
    return S.sheets({"cleaned": cleaned.select("name", "email", "reason"), "rejects": rejects})


@query("partners", f"""{ctes('leads', 'site_pages', 'domain_status')}, {KNOWN}, {PARTNER_SQL}, {RATED_SQL}, {SITE_SQL}, {VERDICT_SQL}
SELECT 'partners' AS sheet, name, CASE WHEN verdict IS NULL THEN email ELSE '' END AS email, coalesce(verdict, reason) AS reason FROM kept LEFT JOIN failed USING (lead_id)
UNION ALL SELECT 'excluded', name, email, reason FROM gone UNION ALL SELECT 'invalid_emails', name, email, verdict FROM kept JOIN failed USING (lead_id)""")
def _(spark, sf):
    out = Q.partners(_partner_raw(spark, sf), _site_texts(spark, sf), view(spark, sf, "domain_status"), store=stored)
    return S.sheets({n: df.select("name", "email", "reason") for n, df in out.items()})


# ------------------------------------------------------------------------------- lead jobs
def _portal_registry(spark, sf):
    rows = view(spark, sf, "leads").withColumns({
        "url": F.concat(F.lit("u"), F.col("lead_id").cast("string")), "activity_label": F.col("products"), "target_profile": F.col("profile_text")})
    return rows.filter("source = 'portal'"), rows.filter("source = 'registry'")


_portal = "source = 'portal'"
_name_school = f"CASE WHEN {_portal} THEN coalesce(nullif(name, ''), nullif(short_name, ''), '') ELSE {s_text('name')} END"


def lead_job_sql(hei: bool) -> str:
    p, r = (R.HEI_PORTAL, R.HEI_REGISTRY) if hei else (R.SCHOOL_PORTAL, R.SCHOOL_REGISTRY)
    name = s_text("name") if hei else _name_school
    label = f"CASE WHEN {_portal} THEN {lit(p['activity_label'])} ELSE coalesce(products, {lit(r['activity_label'])}) END"
    ptext = f"CASE WHEN {_portal} THEN {s_text('profile_text')} ELSE {s_text('products')} END"
    website = s_text("website") if hei else f"CASE WHEN {_portal} THEN '' ELSE {s_text('website')} END"
    base = (f"j0 AS (SELECT lead_id, src_rank, pos, CASE WHEN {_portal} THEN source ELSE {lit(r['source'])} END AS source, "
            f"CASE WHEN {_portal} THEN {lit(p['activity_code'])} ELSE coalesce(activity_code, {lit(r['activity_code'])}) END AS activity_code, "
            f"{label} AS activity_label, {s_text('org_id')} AS org_id, {name} AS name, {s_text('director')} AS director, {s_text('city')} AS city, "
            f"{s_text('phone')} AS phone, {s_valid('email', R.EMAIL_STRICT)} AS email, {website} AS website, {ptext} AS ptext FROM leads), "
            f"j1 AS (SELECT * FROM j0 {s_first(s_lead_key(), 'src_rank, pos')})")
    profile = s_profile("name", "ptext") if hei else "''"
    rank = s_p_hei("email", "phone", "profile") if hei else s_p_school("email", "phone", "director", "org_id")
    return f"{base}, j2 AS (SELECT *, {profile} AS profile FROM j1), job AS (SELECT *, {rank} AS priority FROM j2)"


LEAD_OUT = "source, activity_code, activity_label, org_id, name, director, city, phone, email, website, priority"


def _lead_sheets(pair, extra=()):
    cols = [c.strip() for c in LEAD_OUT.split(",")] + list(extra)
    return S.sheets({"P1-P3": pair[0].select(*cols), "P4": pair[1].select(*cols)})


_sheet = "CASE WHEN priority < 4 THEN 'P1-P3' ELSE 'P4' END AS sheet"


@query("school_leads", f"{ctes('leads')}, {lead_job_sql(False)} SELECT {_sheet}, {LEAD_OUT} FROM job")
def _(spark, sf):
    return _lead_sheets(Q.school_leads(*_portal_registry(spark, sf), store=stored))


@query("hei_leads", f"{ctes('leads')}, {lead_job_sql(True)} SELECT {_sheet}, {LEAD_OUT}, profile, {lit(R.HEI_OFFER)} AS offer FROM job")
def _(spark, sf):
    return _lead_sheets(Q.hei_leads(*_portal_registry(spark, sf), store=stored), ("profile", "offer"))


@query("email_verification", f"""{ctes('leads', 'domain_status')}, {KNOWN} SELECT lead_id, {s_text('name')} AS name, {s_status('email', 'active')} AS email_status,
{s_status('email', 'active')} = 'VALID_HOST_ACTIVE' AS deliverable FROM leads LEFT JOIN known ON contains({s_norm('email')}, '@') AND domain = {s_domain(s_norm('email'))}""")
def _(spark, sf):
    rows = Q.email_verification(view(spark, sf, "leads").select("lead_id", T.null_to_empty("name").alias("name"), "email"), view(spark, sf, "domain_status"))
    return rows.select("lead_id", "name", "email_status", "deliverable")


_nc = lambda x: f"CASE WHEN {x} IS NULL OR {x} IN ('nan', 'None') THEN '' ELSE {x} END"
MASTER_SQL = f"""all_rows AS (
SELECT {s_norm('email')} AS email, {_nc('buyer_name')} AS name, {_nc('buyer_id')} AS org_id, {lit(R.CATEGORY_TENDER)} AS category, {lit(R.PRIORITY_TENDER)} AS priority_label, 1 AS rk, tender_id AS rid FROM target_rows
UNION ALL SELECT {s_norm('email')}, {_nc('buyer_name')}, {_nc('buyer_id')}, {lit(R.CATEGORY_CONTRACT)}, {lit(R.PRIORITY_CONTRACT)}, 2, contract_id FROM kept_c
UNION ALL SELECT {s_norm('email')}, {_nc('name')}, {_nc('org_id')}, {lit(R.CATEGORY_SCHOOL)}, 'P' || priority || {lit(R.PRIORITY_SCHOOL_SUFFIX)}, 3, cast(pos AS string) FROM job WHERE priority < 4),
master AS (SELECT * FROM all_rows WHERE contains(email, '@') AND email <> 'nan'
{s_first('email', "CASE WHEN contains(priority_label, 'P1') THEN 1 WHEN contains(priority_label, 'P2') THEN 2 ELSE 3 END, rk, rid")})"""


@query("master_outreach", f"""{ctes('tender_base', 'leads')}, {TARGET_ROWS}, {CONTRACT_ROWS}, {CONTRACT_JOB}, {lead_job_sql(False)}, {MASTER_SQL}
SELECT 'master' AS sheet, email, name, category, priority_label, 0 AS contracts, 0.0 AS total FROM master
UNION ALL SELECT 'tender_buyers', email, name, category, priority_label, 0, 0.0 FROM master WHERE contains(category, 'Prozorro')
UNION ALL SELECT 'top_priority', email, name, category, priority_label, 0, 0.0 FROM master WHERE contains(priority_label, 'P1')
UNION ALL SELECT 'winners', '', {s_strip('supplier_name')}, {lit(R.CATEGORY_WINNER)}, '', count(contract_id), cast(sum(cast(amount AS decimal(18,2))) AS double)
FROM kept_c WHERE {s_strip('supplier_name')} NOT IN ('', 'nan') GROUP BY {s_strip('supplier_name')}""")
def _(spark, sf):
    statuses = view(spark, sf, "domain_status")
    tenders = TP.target_tenders(B.tenders(spark, sf), statuses, ordered=False)
    contracts = TP.contracts(B.contracts(spark, sf), statuses, store=stored, ordered=False)["contracts"].withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    schools = Q.school_leads(*_portal_registry(spark, sf), ordered=False)[0]
    out = Q.master_outreach(tenders, contracts, schools, store=stored)
    parts = {
        n: df.select("email", "name", "category", "priority_label", F.lit(0).cast("bigint").alias("contracts"), F.lit(0.0).alias("total"))
        for n, df in out.items() if n != "winners"}
    parts["winners"] = out["winners"].select(
        F.lit("").alias("email"), F.col("supplier_name").alias("name"), "category", F.lit("").alias("priority_label"), "contracts",
        F.col("total").cast("double").alias("total"))
    return S.sheets(parts)


# ------------------------------------------------------------------------------- ERP jobs
@query("erp_contacts", f"{ctes('counterparties', 'contact_register')}, {REGISTER}, {CONSOLIDATED} SELECT * FROM cons")
def _(spark, sf):
    return consolidated(P.erp_contacts(view(spark, sf, "counterparties"), view(spark, sf, "contact_register")).select(*CONS_OUT))


@query("erp_split", f"""{ctes('clients', 'sales')}, base_sales AS (SELECT * FROM sales WHERE base = 'F'), {SUMMARY_SQL}
SELECT 'clients' AS sheet, c.counterparty AS name, coalesce(main_group, '') AS item_group, coalesce(sales_amount, cast(c.amount AS double)) AS revenue, coalesce(operations, 0) AS n
FROM clients c LEFT JOIN summed s ON c.counterparty = s.counterparty WHERE contains(lower({s_text('bases')}), 'f')
UNION ALL SELECT 'items', item, item_group, cast(sum(amount) AS double), count(counterparty) FROM base_sales WHERE item IS NOT NULL AND item_group IS NOT NULL GROUP BY item, item_group""")
def _(spark, sf):
    out = P.erp_split(view(spark, sf, "clients"), view(spark, sf, "sales"), "F")
    return money(S.sheets({
        "clients": out["clients"].select(
            F.col("counterparty").alias("name"), T.null_to_empty("main_group").alias("item_group"), "revenue", F.coalesce("operations", F.lit(0)).alias("n")),
        "items": out["items"].select(F.col("item").alias("name"), "item_group", "revenue", F.col("deals").alias("n"))}), "revenue")


@query("erp_enrich", f"""{ctes('leads', 'lookup_source')}, {TIERED_SQL} SELECT 'contacts' AS sheet, lead_id, found_email, match_type, 0 AS total, 0 AS with_email FROM tiered
UNION ALL SELECT 'summary', -1, '', '', count(*), count(*) FILTER (found_email <> '') FROM tiered""")
def _(spark, sf):
    out = P.erp_enrich(view(spark, sf, "leads"), view(spark, sf, "lookup_source"), store=stored)
    return S.sheets({
        "contacts": out["contacts"].select("lead_id", "found_email", "match_type", F.lit(0).alias("total"), F.lit(0).alias("with_email")),
        "summary": out["summary"].select(F.lit(-1).alias("lead_id"), F.lit("").alias("found_email"), F.lit("").alias("match_type"), "total", "with_email")})


LAST_JOB = f"""found AS (SELECT l.lead_id, CASE WHEN {_valid} THEN {s_strip('l.email')} ELSE coalesce(i.email, h.phone_email, '') END AS email,
CASE WHEN {_valid} THEN {lit(R.FOUND_EXISTING)} WHEN i.email IS NOT NULL THEN {lit(R.FOUND_ID)} WHEN h.phone_email IS NOT NULL THEN {lit(R.FOUND_PHONE)} ELSE '' END AS email_source
FROM leads l LEFT JOIN last_id i ON NOT {_valid} AND {s_zeros('l.org_id')} = i.key AND i.key <> 'nan' LEFT JOIN phone_hits h ON l.lead_id = h.lead_id)"""


@query("erp_enrich_last_wins", f"""{ctes('leads', 'lookup_source', 'domain_status')}, {KNOWN}, {LAST_SQL}, {PHONES_SQL}, {LAST_JOB}
SELECT lead_id, email AS found_email, email_source, CASE WHEN coalesce(active, false) THEN {lit(R.MX_ACTIVE_LABEL)} WHEN {s_strip('email')} <> '' THEN {lit(R.MX_INVALID_LABEL)} ELSE '' END AS mx_status
FROM found LEFT JOIN known ON {s_email_ok('email', R.EMAIL_LOOSE_8)} AND domain = {s_domain(s_norm('email'))}""")
def _(spark, sf):
    leads = view(spark, sf, "leads").drop("phone").withColumnRenamed("phones", "phone")
    rows = P.erp_enrich_last_wins(leads, view(spark, sf, "lookup_source"), view(spark, sf, "domain_status"), "lead_id")
    return rows.select("lead_id", "found_email", "email_source", "mx_status")


_oc = s_order_class("client_group", "main_group", "ops")


@query("erp_segment", f"""{ctes('clients', 'sales', 'leads')}, base_sales AS (SELECT * FROM sales), {SUMMARY_SQL}, ver AS (SELECT *, {s_norm_name('name')} AS k FROM leads
QUALIFY row_number() OVER (PARTITION BY k ORDER BY src_rank, pos) = 1),
seg AS (SELECT c.*, main_group, ver.email, ver.phone FROM clients c LEFT JOIN summed s ON c.counterparty = s.counterparty LEFT JOIN ver ON {s_norm_name('c.counterparty')} = ver.k),
done AS (SELECT counterparty, {s_text('email')} AS email, {s_text('phone')} AS phone, {_oc['category']} AS category, {_oc['offer']} AS offer,
CASE WHEN contains(lower({s_text('bases')}), 'f') THEN 1 ELSE 0 END AS in_f, CASE WHEN contains(lower({s_text('bases')}), 'o') THEN 1 ELSE 0 END AS in_o FROM seg)
SELECT 'base F' AS source_base, counterparty, email, phone, category, offer FROM done WHERE in_f = 1
UNION ALL SELECT 'base O', counterparty, email, phone, category, offer FROM done WHERE in_o = 1""")
def _(spark, sf):
    clients = stored(J.client_sales_left(view(spark, sf, "clients"), A.counterparty_summary(view(spark, sf, "sales"))), "clients")
    verified = view(spark, sf, "leads").withColumn("counterparty", F.col("name")).select("counterparty", "email", "phone", "src_rank", "pos")
    bases = {f"base {b}": (X.base_member(clients, "bases", b), verified) for b in ("F", "O")}
    master = P.erp_segment(bases, ["email", "phone"], ["src_rank", "pos"], store=stored)["master"]
    return master.select("source_base", "counterparty", T.null_to_empty("email").alias("email"), T.null_to_empty("phone").alias("phone"), "category", "offer")
