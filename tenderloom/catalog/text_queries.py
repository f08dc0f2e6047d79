"""Column builders over the bound views."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..functions import classify as C, email as E, priority as P, text as T
from .registry import (
    ctes, inlist, lit, query, s_any, s_city, s_clean_id, s_collapse, s_company, s_email_ok, s_emails, s_fold, s_kind_flags,
    s_kind_row, s_last9, s_norm_name, s_order_class, s_org_name, s_p_hei, s_p_partner, s_p_school, s_partner, s_product,
    s_profile, s_reclass, s_strip, s_text, s_zeros, table, view,
)


def _lead(name, build, sql_expr, out="value"):
    query(name, f"{ctes('leads')} SELECT lead_id, {sql_expr} AS {out} FROM leads")(
        lambda spark, sf: view(spark, sf, "leads").select("lead_id", build().alias(out)))


_lead("norm_name", lambda: T.norm_name("name"), s_norm_name("name"))
_lead("norm_org_name", lambda: T.norm_org_name("name"), s_org_name("name"))
_lead("clean_company", lambda: T.clean_company("name"), s_company("name"))
_lead("clean_id", lambda: T.clean_id("org_id"), s_clean_id("org_id"))
_lead("strip_zeros", lambda: T.strip_zeros("org_id"), s_zeros("org_id"))
_lead("phone_last9", lambda: T.phone_last9("phone"), s_last9("phone"))
_lead("clean_text", lambda: T.clean_text("name"), f"trim({s_collapse(s_text('name'))}, ' \"')")
_lead("nan_clean", lambda: T.nan_clean("products"), "CASE WHEN products IS NULL OR products IN ('nan', 'None') THEN '' ELSE products END")
_lead("profile_class", lambda: C.profile_class("name", "profile_text"), s_profile("name", "profile_text"))
_lead("priority_school", lambda: P.priority_school("email", "phone", "director", "org_id"), s_p_school("email", "phone", "director", "org_id"))
_lead("priority_hei", lambda: P.priority_hei("email", "phone", C.profile_class("name", "profile_text")),
      s_p_hei("email", "phone", s_profile("name", "profile_text")))
_lead("priority_partner", lambda: P.priority_partner("email", "phone", "website"), s_p_partner("email", "phone", "website"))
_lead("email_strict", lambda: E.email_ok("email", R.EMAIL_STRICT), s_email_ok("email", R.EMAIL_STRICT), "ok")
_lead("email_loose", lambda: E.email_ok("email", R.EMAIL_LOOSE_8), s_email_ok("email", R.EMAIL_LOOSE_8), "ok")
_lead("email_full", lambda: E.email_ok("email", R.EMAIL_FULL), s_email_ok("email", R.EMAIL_FULL), "ok")
_lead("email_suffix_only", lambda: E.email_ok("email", R.EMAIL_SUFFIX_ONLY), s_email_ok("email", R.EMAIL_SUFFIX_ONLY), "ok")


@query("email_prefix", f"""{ctes('leads')} SELECT lead_id, {s_email_ok('email', R.EMAIL_PREFIX)} AS ok,
{s_email_ok('email', R.EMAIL_PREFIX_8)} AS ok_wide FROM leads""")
def _(spark, sf):
    return view(spark, sf, "leads").select(
        "lead_id", E.email_ok("email", R.EMAIL_PREFIX).alias("ok"), E.email_ok("email", R.EMAIL_PREFIX_8).alias("ok_wide"))


@query("priority_score", f"""{ctes('leads')}, p AS (SELECT lead_id, 'P' || ({s_p_school('email', 'phone', 'director', 'org_id')}) || ' - x' AS l FROM leads)
SELECT lead_id, CASE WHEN contains(l, 'P1') THEN 1 WHEN contains(l, 'P2') THEN 2 ELSE 3 END AS score FROM p""")
def _(spark, sf):
    rank = P.priority_school("email", "phone", "director", "org_id").cast("string")
    return view(spark, sf, "leads").select(
        "lead_id", P.priority_score(F.concat(F.lit("P"), rank, F.lit(" - x"))).alias("score"))


@query("city_from_address", f"""{ctes('leads')} SELECT lead_id, {s_city('address', chr(92) + 's+')} AS city_strict,
{s_city('address', chr(92) + 's*')} AS city_loose FROM leads""")
def _(spark, sf):
    return view(spark, sf, "leads").select(
        "lead_id", T.city_from_address("address").alias("city_strict"), T.city_from_address("address", False).alias("city_loose"))


@query("homoglyph_fold", f"{ctes('tender_base')} SELECT doc, {s_fold('title')} AS folded FROM tender_base")
def _(spark, sf):
    return view(spark, sf, "tender_base").select("doc", T.homoglyph_fold("title").alias("folded"))


@query("product_category", f"{ctes('tender_base')} SELECT doc, {s_product('title', 'description')} AS category FROM tender_base")
def _(spark, sf):
    return view(spark, sf, "tender_base").select("doc", C.product_category("title", "description").alias("category"))


_flags = s_kind_flags("kind", "value")


@query("contact_kind", f"{ctes('contact_register')} SELECT pos, " + ", ".join(f"{e} AS {n}" for n, e in _flags.items()) + " FROM contact_register")
def _(spark, sf):
    return view(spark, sf, "contact_register").select("pos", C.contact_kind("kind", "value").alias("k")).select("pos", "k.*")


@query("contact_kind_rowwise", f"{ctes('contact_register')} SELECT pos, coalesce({s_kind_row('kind', 'value')}, '') AS kind FROM contact_register")
def _(spark, sf):
    return view(spark, sf, "contact_register").select("pos", T.null_to_empty(C.contact_kind_rowwise("kind", "value")).alias("kind"))


@query("extract_emails", f"""SELECT doc_id, array_to_string({s_emails('text', R.IGNORE_TOKENS)}, ' ') AS emails,
array_to_string({s_emails('text', R.IGNORE_TOKENS_DOMAIN, 'domain')}, ' ') AS emails_by_domain,
array_to_string({s_emails('text', R.IGNORE_TOKENS_SEARCH)}, ' ') AS emails_search FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(T.extract_emails("text"), " ").alias("emails"),
        F.array_join(T.extract_emails("text", R.IGNORE_TOKENS_DOMAIN, "domain"), " ").alias("emails_by_domain"),
        F.array_join(T.extract_emails("text", R.IGNORE_TOKENS_SEARCH), " ").alias("emails_search"))


@query("extract_phones", f"""SELECT doc_id, array_to_string(regexp_extract_all(text, {lit(R.PHONE_UA)}), ' ') AS phones FROM documents
UNION ALL SELECT -page_id - 1, array_to_string(regexp_extract_all(html, {lit(R.PHONE_UA)}), ' ') FROM pages""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.array_join(T.extract_phones("text"), " ").alias("phones"))
    pages = table(spark, sf, "pages").select((-F.col("page_id") - 1).alias("doc_id"), F.array_join(T.extract_phones("html"), " ").alias("phones"))
    return docs.union(pages)


@query("text_cap", f"""SELECT doc_id, length(substring(text, 1, {R.TEXT_CAP})) AS n_chars, md5(substring(text, 1, {R.TEXT_CAP})) AS digest FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.text_cap("text").alias("t")).select(
        "doc_id", F.length("t").alias("n_chars"), F.md5(F.col("t").cast("binary")).alias("digest"))


_oc = s_order_class("client_group", "bases", "ops")


@query("order_class", f"{ctes('clients')} SELECT counterparty, " + ", ".join(f"{e} AS {n}" for n, e in _oc.items()) + " FROM clients")
def _(spark, sf):
    return view(spark, sf, "clients").select("counterparty", C.order_class("client_group", "bases", "ops").alias("c")).select("counterparty", "c.*")


_pc = s_partner("activity_code", "products")


@query("partner_class", f"{ctes('leads')} SELECT lead_id, {_pc[0]} AS status, {_pc[1]} AS reason FROM leads")
def _(spark, sf):
    return view(spark, sf, "leads").select("lead_id", C.partner_class("activity_code", "products").alias("c")).select("lead_id", "c.*")


_rc = s_reclass("products")


@query("partner_reclass", f"{ctes('leads')} SELECT lead_id, coalesce({_rc[0]}, '') AS status, coalesce({_rc[1]}, '') AS reason FROM leads")
def _(spark, sf):
    return view(spark, sf, "leads").select("lead_id", C.partner_reclass("products").alias("c")).select(
        "lead_id", T.null_to_empty("c.status").alias("status"), T.null_to_empty("c.reason").alias("reason"))


@query("percent_decode_email", f"{ctes('school_pages')} SELECT url, lower(email) AS email FROM school_pages")
def _(spark, sf):
    return view(spark, sf, "school_pages").select("url", T.percent_decode_email("script").alias("email"))


@query("page_key", """SELECT page_id, sha256(url) AS plain_key, sha256(url || '_{"page": ' || page_id || '}') AS params_key FROM pages""")
def _(spark, sf):
    params = F.concat(F.lit('{"page": '), F.col("page_id").cast("string"), F.lit("}"))
    return table(spark, sf, "pages").select("page_id", T.page_key("url").alias("plain_key"), T.page_key("url", params).alias("params_key"))


@query("class_codes", rf"{ctes('classifier')} SELECT n, array_to_string(regexp_extract_all(text, '\d{{8}}-\d'), ', ') AS codes FROM classifier")
def _(spark, sf):
    return view(spark, sf, "classifier").select("n", F.array_join(T.class_codes("text"), ", ").alias("codes"))


def s_lookup_key(i, n, k):
    return (f"nullif(nullif(CASE WHEN {s_strip(s_text(i))} <> 'nan' AND length({s_strip(s_text(i))}) >= {k} "
            f"THEN {s_strip(s_text(i))} ELSE {s_strip(s_text(n))} END, ''), 'nan')")


@query("lookup_key", f"""{ctes('leads')} SELECT lead_id, {s_lookup_key('org_id', 'name', 8)} AS key8, {s_lookup_key('org_id', 'name', 6)} AS key6 FROM leads""")
def _(spark, sf):
    return view(spark, sf, "leads").select(
        "lead_id", T.lookup_key("org_id", "name").alias("key8"), T.lookup_key("org_id", "name", 6).alias("key6"))
