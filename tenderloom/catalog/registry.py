"""Registered queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import rules as R
from ..sources.bindings import ctes, table, view  # noqa: F401  (re-exported)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Amounts as doubles, so both engines print them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def stamp(c):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ------------------------------------------------------------------------------- SQL snippets
def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def inlist(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


BLANKS = "(' ' || chr(9) || chr(10) || chr(13) || chr(160))"


def s_stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def s_strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def s_text(x: str) -> str:
    return f"coalesce({x}, '')"


def s_norm(x: str) -> str:
    return f"lower({s_strip(s_text(x))})"


def s_domain(x: str) -> str:
    return f"split_part({x}, '@', -1)"


def s_suffix(x: str, suffixes) -> str:
    return "(" + " OR ".join(f"ends_with({x}, {lit(s)})" for s in suffixes) + ")"


def s_email_ok(x: str, rule: R.EmailRule) -> str:
    a = s_norm(x)
    parts = [f"regexp_matches({a}, {lit(rule.pattern)})"]
    if rule.length:
        parts.append(f"length({a}) BETWEEN {rule.length[0]} AND {rule.length[1]}")
    if rule.blocked_domains:
        parts.append(f"{s_domain(a)} NOT IN {inlist(rule.blocked_domains)}")
    if rule.blocked_suffixes:
        parts.append(f"NOT {s_suffix(s_domain(a) if rule.suffix_on == 'domain' else a, rule.blocked_suffixes)}")
    return "(" + " AND ".join(parts) + ")"


def s_valid(x: str, rule: R.EmailRule) -> str:
    return f"CASE WHEN {s_email_ok(x, rule)} THEN {s_norm(x)} ELSE '' END"


def s_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def s_all(x: str, words) -> str:
    return "(" + " AND ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def s_match(x: str, pattern: str) -> str:
    edge = r"(?:^|$|[^\p{L}\p{N}_])"
    return f"regexp_matches({s_text(x)}, {lit('(?i)' + pattern.replace(chr(92) + 'b', edge))})"


def s_first_match(x: str, pattern: str) -> str:
    return f"regexp_extract({s_text(x)}, {lit('(?i)(' + pattern + ')')}, 1)"


def s_has(x: str) -> str:
    return f"({s_text(x)} <> '')"


def s_collapse(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def s_norm_name(x: str) -> str:
    return s_collapse(s_norm(x))


def s_org_name(x: str) -> str:
    bare = f"translate({s_text(x)}, {lit(R.NAME_QUOTES)}, '')"
    return f"lower({s_strip(s_collapse(bare))})"


def s_company(x: str) -> str:
    spaced = f"translate(lower({s_text(x)}), {lit(R.COMPANY_QUOTES)}, {lit(' ' * len(R.COMPANY_QUOTES))})"
    return (rf"array_to_string(list_filter(string_split_regex({spaced}, '\s+'), "
            rf"lambda w: w <> '' AND w NOT IN {inlist(R.LEGAL_FORMS)}), ' ')")


def s_clean_id(x: str) -> str:
    z = f"ltrim(split_part({s_strip(s_text(x))}, '.', 1), '0')"
    return f"CASE WHEN regexp_matches({z}, '^[0-9]{{5,}}$') THEN {z} ELSE '' END"


def s_zeros(x: str) -> str:
    return f"ltrim({s_strip(s_text(x))}, '0')"


def s_last9(x: str) -> str:
    d = f"regexp_replace({s_text(x)}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) >= 9 THEN right({d}, 9) ELSE '' END"


def s_city(x: str, gap: str) -> str:
    pattern = rf"(?:^|[^\p{{L}}\p{{N}}_]){R.CITY_MARKERS}{gap}{R.CITY_WORD}"
    found = f"regexp_extract({s_text(x)}, {lit(pattern)}, 1)"
    return f"CASE WHEN {found} <> '' THEN {found} ELSE {s_strip(f'split_part({s_text(x)}, {lit(chr(44))}, 1)')} END"


def s_fold(x: str) -> str:
    return s_strip(f"lower(translate({s_text(x)}, {lit(R.HOMOGLYPHS_FROM)}, {lit(R.HOMOGLYPHS_TO)}))")


def s_product(title: str, desc: str) -> str:
    t = f"lower({s_text(title)} || ' ' || {s_text(desc)})"
    cases = ", ".join(f"CASE WHEN {s_any(t, words)} THEN {lit(label)} END" for words, label in R.PRODUCT_GROUPS)
    return f"coalesce(nullif(concat_ws(' | ', {cases}), ''), {lit(R.PRODUCT_DEFAULT)})"


def s_profile(name: str, desc: str) -> str:
    t = f"lower({s_text(name)} || ' ' || {s_text(desc)})"
    cases = " ".join(
        f"WHEN {s_all(t, words) if every else s_any(t, words)} THEN {lit(label)}" for words, every, label in R.PROFILE_RULES)
    return f"CASE {cases} ELSE {lit(R.PROFILE_DEFAULT)} END"


def s_p_school(e: str, p: str, d: str, i: str) -> str:
    return (f"CASE WHEN {s_has(e)} AND {s_has(p)} AND ({s_has(d)} OR {s_has(i)}) THEN 1 "
            f"WHEN {s_has(e)} AND {s_has(p)} THEN 2 WHEN {s_has(e)} THEN 3 ELSE 4 END")


def s_p_hei(e: str, p: str, profile: str) -> str:
    return (f"CASE WHEN {s_has(e)} AND {s_has(p)} AND {s_any(f'lower({s_text(profile)})', R.PROFILE_TARGETS)} THEN 1 "
            f"WHEN {s_has(e)} AND {s_has(p)} THEN 2 WHEN {s_has(e)} THEN 3 ELSE 4 END")


def s_p_partner(e: str, p: str, w: str) -> str:
    return (f"CASE WHEN {s_has(e)} AND {s_has(p)} THEN 1 WHEN {s_has(e)} OR {s_has(p)} THEN 2 "
            f"WHEN {s_has(w)} THEN 3 ELSE 4 END")


def s_lead_key(e: str = "email", i: str = "org_id", n: str = "name", c: str = "city") -> str:
    name = s_org_name(n)
    return (f"CASE WHEN {s_has(e)} THEN {e} || '_' || {name} WHEN {s_has(i)} THEN {i} || '_' || {name} "
            f"ELSE {name} || '_' || lower({s_text(c)}) END")


def s_first(keys: str, order: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def s_kind_flags(kind: str, value: str) -> dict[str, str]:
    k, v = f"lower({s_text(kind)})", s_strip(s_text(value))
    e = f"({s_any(k, R.KIND_EMAIL)} OR contains({v}, '@'))"
    digits = rf"(regexp_matches(regexp_replace({v}, '[+\-\s()]', '', 'g'), '^[0-9]+$') AND length({v}) >= 7)"
    p = f"({s_any(k, R.KIND_PHONE)} OR ({digits} AND NOT {e}))"
    return {"is_phone": p, "is_email": e, "is_address": f"({s_any(k, R.KIND_ADDRESS)} AND NOT {e} AND NOT {p})"}


def s_kind_row(kind: str, value: str) -> str:
    k, v = f"lower({s_text(kind)})", s_strip(s_text(value))
    return (f"CASE WHEN {v} = '' THEN NULL WHEN {s_any(k, R.KIND_PHONE)} OR regexp_matches(translate({v}, '+-', ''), '^[0-9]+$') "
            f"THEN 'phone' WHEN {s_any(k, R.KIND_EMAIL)} OR contains({v}, '@') THEN 'email' "
            f"WHEN {s_any(k, R.KIND_ADDRESS)} THEN 'address' END")


def s_order_class(group: str, item_group: str, ops: str) -> dict[str, str]:
    custom = f"({s_any(f'lower({s_text(item_group)})', R.CUSTOM_ORDER_WORDS)} OR {s_any(f'lower({s_text(group)})', R.CUSTOM_ORDER_WORDS)})"
    return {
        n: f"CASE WHEN {custom} THEN {lit(R.ORDER_CUSTOM[i])} WHEN coalesce({ops}, 0) >= {R.REGULAR_ORDER_MIN_OPS} "
           f"THEN {lit(R.ORDER_REGULAR[i])} ELSE {lit(R.ORDER_SINGLE[i])} END"
        for i, n in enumerate(("category", "order_type", "offer"))}


def s_partner(code: str, text: str) -> tuple[str, str]:
    t = s_text(text)
    safe, blank = f"coalesce({code} IN {inlist(R.PARTNER_SAFE_CODES)}, false)", f"({s_strip(t)} = '' OR {t} = 'nan')"
    out, inside = s_match(text, R.PARTNER_EXCLUDE), s_match(text, R.PARTNER_INCLUDE)
    word = f"{lit(R.PARTNER_REASON_EXCLUDE)} || substring({s_first_match(text, R.PARTNER_EXCLUDE)}, 1, 30) || '…'"
    status = (f"CASE WHEN {safe} THEN {lit(R.PARTNER_OK)} WHEN {blank} THEN {lit(R.PARTNER_CHECK)} WHEN {inside} THEN "
              f"{lit(R.PARTNER_OK)} WHEN {out} THEN {lit(R.PARTNER_REJECT)} ELSE {lit(R.PARTNER_CHECK)} END")
    reason = (f"CASE WHEN {safe} THEN {lit(R.PARTNER_REASON_SAFE)} WHEN {blank} THEN {lit(R.PARTNER_REASON_BLANK)} "
              f"WHEN {out} AND {inside} THEN {lit(R.PARTNER_REASON_BOTH)} WHEN {out} THEN {word} WHEN {inside} THEN "
              f"{lit(R.PARTNER_REASON_INCLUDE)} ELSE {lit(R.PARTNER_REASON_UNCLEAR)} END")
    return status, reason


def s_reclass(text: str) -> tuple[str, str]:
    inside, out = s_first_match(text, R.PARTNER_INCLUDE), s_first_match(text, R.PARTNER_EXCLUDE)
    status = f"CASE WHEN {inside} <> '' THEN {lit(R.PARTNER_OK)} WHEN {out} <> '' THEN {lit(R.PARTNER_REJECT)} END"
    reason = (f"CASE WHEN {inside} <> '' THEN {lit(R.PARTNER_SITE_PREFIX)} || {inside} "
              f"WHEN {out} <> '' THEN {lit(R.PARTNER_SITE_PREFIX)} || substring({out}, 1, 30) END")
    return status, reason


def s_label(code: str, labels: dict[str, str]) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in labels.items()) + f" ELSE {code} END"


def s_reason(email: str) -> str:
    a = s_norm(email)
    return (f"CASE WHEN {a} = '' THEN 'empty' WHEN NOT regexp_matches({a}, {lit('^' + R.EMAIL_BASE + '$')}) OR "
            f"regexp_matches({a}, {lit('(?i)' + R.EMAIL_JUNK)}) THEN 'bad_syntax' ELSE 'ok' END")


def s_status(email: str, active: str) -> str:
    a = s_norm(email)
    return (f"CASE WHEN {email} IS NULL THEN 'UNKNOWN' WHEN NOT contains({a}, '@') THEN 'SYNTAX_ERROR' "
            f"WHEN {s_domain(a)} IN {inlist(R.BLOCKED_13)} OR {s_suffix(s_domain(a), R.SUFFIXES_4)} THEN 'BLOCKED_HOSTILE_DOMAIN' "
            f"WHEN coalesce({active}, false) THEN 'VALID_HOST_ACTIVE' ELSE 'INVALID_NO_HOST' END")


def s_emails(x: str, ignore, scope: str = "address") -> str:
    part = s_domain("e") if scope == "domain" else "e"
    return (f"list_filter(list_transform(regexp_extract_all({s_text(x)}, {lit(R.EMAIL_BASE)}), lambda e: lower(e)), "
            f"lambda e: NOT {s_any(part, ignore)})")


# flat parties of the nested tender documents
def party_columns(p: str) -> str:
    return (f"coalesce(nullif({p}_name, ''), nullif({p}_legal, ''), '') AS party_name, {s_text(p + '_id')} AS party_id, "
            f"{s_strip(s_text(p + '_contact'))} AS contact, {s_valid(p + '_email', R.EMAIL_STRICT)} AS email, "
            f"{s_strip(s_text(p + '_phone'))} AS phone, {s_text(p + '_city')} AS city")


TENDER_HEAD = (
    "doc, coalesce(nullif(tender_no, ''), id) AS tender_id, coalesce(title, '') AS subject, "
    "coalesce(nullif(buyer_name, ''), nullif(buyer_legal, ''), '') AS buyer_name, "
    f"{lit(R.TENDER_URL)} || coalesce(nullif(tender_no, ''), id) AS url"
)

BUYERS_SQL = f"""buyers AS (
SELECT {TENDER_HEAD}, {s_product('title', 'description')} AS category, coalesce(nullif(amount, 0.0), 0.0) AS amount,
       coalesce(nullif(status, ''), 'active') AS status, {s_text('buyer_id')} AS buyer_id, {s_strip(s_text('buyer_contact'))} AS contact,
       {s_valid('buyer_email', R.EMAIL_STRICT)} AS email, {s_strip(s_text('buyer_phone'))} AS phone, {s_text('buyer_city')} AS city,
       {s_text('buyer_region')} AS region
FROM tender_base {s_first("coalesce(nullif(tender_no, ''), id), coalesce(buyer_id, '')", 'doc')})"""


def _party_union(rows: list[tuple[int, int, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {TENDER_HEAD}, {a} AS apos, {s} AS spos, '{status}' AS status, {amount} AS party_amount, {party_columns(p)} FROM tender_base"
        for a, s, status, amount, p in rows)


_AWARD = "coalesce(nullif(aw0_amount, 0.0), nullif(amount, 0.0), 0.0)"
_TOTAL = "coalesce(nullif(amount, 0.0), 0.0)"
WINNERS_SQL = (
    f"winner_lines AS ({_party_union([(0, 0, 'active', _AWARD, 's00'), (0, 1, 'active', _AWARD, 's01'), (1, 0, 'unsuccessful', _TOTAL, 's10')])}), "
    f"winners AS (SELECT * FROM winner_lines {s_first('tender_id, party_id, party_name', 'doc, apos, spos')})")
_BID = "coalesce(nullif(cast(bid0_amount AS double), 0.0), 0.0)"
BIDDERS_SQL = (
    f"bidder_lines AS ({_party_union([(0, 0, 'active', _BID, 's00'), (1, 0, 'invalid', '0.0', 's10'), (1, 1, 'invalid', '0.0', 's01')])}), "
    f"bidders AS (SELECT * FROM bidder_lines {s_first('tender_id, party_id, party_name', 'doc, apos, spos')})")
PARTY_OUT = "tender_id, status, party_name, party_id, party_amount, contact, email, phone, city, subject, buyer_name, url"
BUYER_OUT = "tender_id, category, subject, amount, status, buyer_name, buyer_id, contact, email, phone, city, region, url"
