"""Grouped summaries over the bound views."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..functions import classify as C, email as E, text as T
from ..operators import aggregates as A, filters as X, flatten as L
from ..operators.joins import counterparty_contacts, tiered_contact_match
from ..plans.erp import contact_lookups
from ..plans.leads import email_verification
from ..sources import bindings as B
from .filter_queries import CONTRACT_ROWS
from .registry import (
    ctes, lit, money, query, s_domain, s_email_ok, s_has, s_kind_flags, s_kind_row, s_norm, s_partner, s_stamp, s_status, s_strip,
    s_text, stamp, table, view,
)


@query("winner_totals", f"""{ctes('tender_base')}, {CONTRACT_ROWS}
SELECT {s_strip('supplier_name')} AS supplier_name, count(contract_id) AS contracts, cast(sum(cast(amount AS decimal(18,2))) AS double) AS total
FROM rows_c WHERE {s_strip('supplier_name')} NOT IN ('', 'nan') GROUP BY ALL""")
def _(spark, sf):
    rows = L.contract_row(B.contracts(spark, sf)).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return money(A.winner_totals(rows, "supplier_name"), "total")


SUMMARY_SQL = """summary AS (
SELECT counterparty, coalesce(sum(amount), 0) AS sales_amount, coalesce(sum(qty), 0) AS units, count(item) AS operations FROM base_sales GROUP BY counterparty),
modes AS (SELECT counterparty, item_group FROM (SELECT counterparty, item_group, count(*) AS n FROM base_sales WHERE item_group IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY counterparty ORDER BY n DESC, item_group) = 1),
summed AS (SELECT s.counterparty, cast(sales_amount AS double) AS sales_amount, cast(units AS double) AS units, operations, coalesce(item_group, '') AS main_group
FROM summary s LEFT JOIN modes m ON s.counterparty = m.counterparty)"""


@query("counterparty_summary", f"{ctes('sales')}, base_sales AS (SELECT * FROM sales), {SUMMARY_SQL} SELECT * FROM summed")
def _(spark, sf):
    return money(A.counterparty_summary(view(spark, sf, "sales")), "sales_amount", "units")


@query("top_items", f"""{ctes('sales')} SELECT item, item_group, cast(sum(amount) AS double) AS revenue, cast(sum(qty) AS double) AS units, count(counterparty) AS deals
FROM sales WHERE item IS NOT NULL AND item_group IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return money(A.top_items(view(spark, sf, "sales")), "revenue", "units")


REGISTER = "reg AS (SELECT c.*, r.pos, r.person, r.kind, r.value FROM counterparties c LEFT JOIN contact_register r ON c.owner = r.owner)"


def _joined(flag: str) -> str:
    v = s_strip(s_text("value"))
    return f"coalesce(array_to_string(list_sort(list(DISTINCT {v}) FILTER ({flag} AND {v} <> '')), '; '), '')"


_f = s_kind_flags("kind", "value")
_k = s_kind_row("kind", "value")
CONSOLIDATED = (
    f"cons AS (SELECT code, name, min(legal_name) AS legal_name, coalesce(min(org_id), '') AS org_id, coalesce(min(tax_id), '') AS tax_id, "
    f"coalesce(arg_min(person, pos) FILTER (person IS NOT NULL), '') AS person, {_joined(_f['is_phone'])} AS phones, "
    f"{_joined(_f['is_email'])} AS emails, {_joined(_f['is_address'])} AS addresses FROM reg GROUP BY code, name)")
CONSOLIDATED_ROWWISE = (
    f"consb AS (SELECT code, name, min(legal_name) AS legal_name, coalesce(min(org_id), '') AS org_id, coalesce(min(tax_id), '') AS tax_id, "
    f"coalesce(list(person ORDER BY pos)[1], '') AS person, {_joined(_k + chr(32) + '= ' + lit('phone'))} AS phones, "
    f"{_joined(_k + chr(32) + '= ' + lit('email'))} AS emails, {_joined(_k + chr(32) + '= ' + lit('address'))} AS addresses FROM reg GROUP BY code, name)")
CONS_OUT = ["code", "name", "legal_name", "org_id", "tax_id", "person", "phones", "emails", "addresses"]


def consolidated(df):
    return df.select("code", "name", *[T.null_to_empty(c).alias(c) for c in CONS_OUT[2:]])


def _reg(spark, sf):
    return counterparty_contacts(view(spark, sf, "counterparties"), view(spark, sf, "contact_register"), "owner")


@query("consolidate_contacts", f"{ctes('counterparties', 'contact_register')}, {REGISTER}, {CONSOLIDATED} SELECT * FROM cons")
def _(spark, sf):
    return consolidated(A.consolidate_contacts(_reg(spark, sf)))


@query("consolidate_contacts_rowwise", f"{ctes('counterparties', 'contact_register')}, {REGISTER}, {CONSOLIDATED_ROWWISE} SELECT * FROM consb")
def _(spark, sf):
    return consolidated(A.consolidate_contacts_rowwise(_reg(spark, sf)))


@query("distinct_parties", f"{ctes('tender_base')}, {CONTRACT_ROWS} SELECT count(DISTINCT supplier_name) AS winners, count(DISTINCT buyer_name) AS buyers FROM rows_c")
def _(spark, sf):
    return A.distinct_parties(L.contract_row(B.contracts(spark, sf)), {"supplier_name": "winners", "buyer_name": "buyers"})


_st = s_partner("activity_code", "products")[0]


@query("status_breakdown", f"""{ctes('leads')}, c AS (SELECT activity_code, {_st} AS status FROM leads)
SELECT 'status' AS part, status AS value, count(*) AS n FROM c GROUP BY ALL
UNION ALL SELECT 'rejected_by_code', activity_code, count(*) FROM c WHERE status = {lit(R.PARTNER_REJECT)} GROUP BY ALL""")
def _(spark, sf):
    rows = view(spark, sf, "leads").select("activity_code", C.partner_class("activity_code", "products")["status"].alias("status"))
    return A.status_breakdown(rows)


_e, _p, _w = s_has("email"), s_has("phone"), s_has("website")


@query("priority_breakdown", f"""{ctes('leads')} SELECT count(*) FILTER ({_e} AND {_p}) AS p1_both, count(*) FILTER ({_e} <> {_p}) AS p2_one,
count(*) FILTER (NOT {_e} AND NOT {_p} AND {_w}) AS p3_web, count(*) FILTER (NOT {_e} AND NOT {_p} AND NOT {_w}) AS p4_none FROM leads""")
def _(spark, sf):
    return A.priority_breakdown(view(spark, sf, "leads"))


@query("coverage", f"""{ctes('leads', 'domain_status')}, known AS (SELECT domain, max(active) AS active FROM domain_status GROUP BY domain),
v AS (SELECT *, {s_status('email', 'active')} = 'VALID_HOST_ACTIVE' AS ok FROM leads LEFT JOIN known ON contains({s_norm('email')}, '@') AND domain = {s_domain(s_norm('email'))})
SELECT count(*) AS total, count(*) FILTER (contains(coalesce(email, ''), '@')) AS with_email, count(*) FILTER (length(coalesce(phone, '')) > 5) AS with_phone,
count(*) FILTER (ok) AS active_domain, count(*) FILTER (ok) AS deliverable_rows, count(*) FILTER (NOT ok) AS undeliverable_rows FROM v""")
def _(spark, sf):
    checked = email_verification(view(spark, sf, "leads"), view(spark, sf, "domain_status"))
    return A.coverage(checked, email="email", phone="phone", active="deliverable", deliverable="deliverable")


@query("count_by_code", f"{ctes('leads')} SELECT activity_code, count(*) AS n FROM leads GROUP BY ALL UNION ALL SELECT activity_code || ' only', count(*) FROM leads WHERE activity_code = '46.49' GROUP BY ALL")
def _(spark, sf):
    leads = view(spark, sf, "leads")
    one = A.count_by_code(leads, code="46.49").withColumn("activity_code", F.concat("activity_code", F.lit(" only")))
    return A.count_by_code(leads).union(one)


# ------------------------------------------------------------------------------- job log
def _last(c: str) -> str:
    return f"arg_max({c}, row(ts, event_id)) FILTER ({c} IS NOT NULL)"


ROLLUP = f"""roll AS (SELECT job, arg_max(status, row(ts, event_id)) AS status, count(*) AS attempts, min(ts) FILTER (status = 'IN_PROGRESS') AS started_at,
max(ts) FILTER (status IN ('COMPLETED', 'FAILED', 'SKIPPED')) AS completed_at, {_last('page')} AS last_page, {_last('processed')} AS last_processed,
{_last('total')} AS last_total, {_last('error')} AS last_error FROM job_events GROUP BY job)"""


@query("job_status_rollup", f"""{ctes('job_events')}, {ROLLUP} SELECT job, status, attempts, coalesce({s_stamp('started_at')}, '') AS started_at,
coalesce({s_stamp('completed_at')}, '') AS completed_at, coalesce(last_page, -1) AS last_page, coalesce(last_processed, -1) AS last_processed,
coalesce(last_total, -1) AS last_total, coalesce(last_error, '') AS last_error FROM roll""")
def _(spark, sf):
    r = A.job_status_rollup(view(spark, sf, "job_events"))
    return r.select(
        "job", "status", "attempts", *[T.null_to_empty(stamp(c)).alias(c) for c in ("started_at", "completed_at")],
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("last_page", "last_processed", "last_total")], T.null_to_empty("last_error").alias("last_error"))


@query("progress", f"""{ctes('job_events')}, {ROLLUP}, p AS (SELECT job, coalesce(last_processed, 0) AS d, coalesce(last_total, 0) AS t,
(epoch_us(TIMESTAMP '2024-03-01 00:00:00') - epoch_us(started_at)) / 1e6 AS elapsed FROM roll)
SELECT job, round(CASE WHEN t > 0 THEN d / t * 100 ELSE 0.0 END, 6) AS percent,
round(coalesce(CASE WHEN d > 0 AND t > 0 THEN elapsed / d * (t - d) END, -1.0), 3) AS eta_seconds FROM p""")
def _(spark, sf):
    r = A.progress(A.job_status_rollup(view(spark, sf, "job_events")), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    return r.select("job", F.round("percent", 6).alias("percent"), F.round(F.coalesce("eta_seconds", F.lit(-1.0)), 3).alias("eta_seconds"))


@query("resume_point", f"""{ctes('job_events')}, {ROLLUP}, pages_done AS (SELECT DISTINCT job, page FROM job_events WHERE page >= 1),
m AS (SELECT job, max(page) AS top, count(*) AS n FROM pages_done GROUP BY job)
SELECT r.job, coalesce(top, 0) + 1 AS next_page, coalesce(top, 0) - coalesce(n, 0) AS missing_pages, status = 'COMPLETED' AND coalesce(top, 0) > 0 AS done
FROM roll r LEFT JOIN m ON r.job = m.job""")
def _(spark, sf):
    events = view(spark, sf, "job_events")
    return A.resume_point(events, "job", "page", A.job_status_rollup(events))


@query("missing_pages", f"""{ctes('job_events')}, m AS (SELECT job, max(page) AS top FROM job_events WHERE page >= 1 GROUP BY job),
wanted AS (SELECT job, unnest(range(1, cast(top + 1 AS bigint))) AS page FROM m)
SELECT job, page FROM wanted EXCEPT SELECT job, page FROM job_events""")
def _(spark, sf):
    return A.missing_pages(view(spark, sf, "job_events"), "job")
