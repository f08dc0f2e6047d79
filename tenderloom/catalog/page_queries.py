"""Page extraction over the stored pages and over directory pages derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..operators import pages as G
from .registry import ctes, lit, query, s_any, s_strip, s_text, table, view

_text = r"regexp_replace(regexp_replace(html, '<!--|-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
_words = "|".join(R.CHALLENGE_WORDS)
_cased = "|".join(R.CHALLENGE_WORDS_CASED)
_src = rf"""(?is)<(?:img|iframe|script)\b[^>]*\bsrc\s*=\s*["'][^"']*(?:{R.CHALLENGE_SOURCES})"""
_hidden = rf"""\bstyle\s*=\s*["'][^"']*(?:{R.HIDDEN_STYLE})"""
_input = r"""(?is)<input\b[^>]*>"""
_name = rf"""(?i)\bname\s*=\s*["'][^"']*({'|'.join(R.TRAP_INPUT_WORDS)})"""
USABLE_SQL = f"""length(html) >= {R.MIN_PAGE_LENGTH} AND NOT (regexp_matches({_text}, {lit('(?i)' + _words)}) OR regexp_matches({_text}, {lit(_cased)})
OR len(list_filter(regexp_extract_all(html, {lit(_input)}), lambda i: regexp_matches(i, '(?i)\\btype\\s*=\\s*["'']?hidden') AND regexp_matches(i, {lit(_name)}))) > 0
OR len(regexp_extract_all(html, {lit(_hidden)})) > {R.MAX_HIDDEN_ELEMENTS} OR regexp_matches(html, {lit(_src)}))"""


@query("page_usable", f"SELECT page_id, url FROM pages WHERE {USABLE_SQL} UNION ALL SELECT doc_id, source FROM (SELECT doc_id, source, text AS html FROM documents) WHERE {USABLE_SQL}")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("html"))
    return G.page_usable(table(spark, sf, "pages")).select("page_id", "url").union(G.page_usable(docs).select("doc_id", "source"))


@query("one_page_per_key", """WITH p AS (SELECT page_id, split_part(url, '/', 3) AS host, '{"page": ' || (page_id % 2) || '}' AS params FROM pages)
SELECT page_id, sha256(host || '_' || params) AS page_key FROM p QUALIFY row_number() OVER (PARTITION BY host, params ORDER BY page_id) = 1""")
def _(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("url"),
        F.concat(F.lit('{"page": '), (F.col("page_id") % 2).cast("string"), F.lit("}")).alias("params"))
    return G.one_page_per_key(pages, ["page_id"], "params").select("page_id", "page_key")


@query("listing_cards", f"""{ctes('card_pages')} SELECT url, 1 AS card_pos, name1 AS name, address1 AS address, phone1 || ', ' || phone2 AS phone, email1 AS email FROM card_pages
UNION ALL SELECT url, 2, name2, '', '', '' FROM card_pages""")
def _(spark, sf):
    return G.listing_cards(view(spark, sf, "card_pages"))


_info = "CASE WHEN n % 3 = 0 THEN cast(n AS bigint) END"
_pager = "CASE n % 4 WHEN 0 THEN greatest(2, cast(n AS bigint)) WHEN 1 THEN 7::bigint END"


@query("listing_totals", f"""{ctes('card_pages')}, t AS (SELECT url, {_info} AS i, {_pager} AS p FROM card_pages)
SELECT url, coalesce(i, p * 20, 20000) AS total_companies, coalesce(p, cast(floor((i + 19) / 20.0) AS bigint), 1000) AS total_pages FROM t""")
def _(spark, sf):
    return G.listing_totals(view(spark, sf, "card_pages"))


@query("school_card", f"""{ctes('school_pages')} SELECT url, 'znayshov.com' AS source, CASE WHEN n % 3 = 0 THEN short_name ELSE full_name END AS name, short_name, email, phone,
': ' || director AS director, 'Ворзель' AS city, 'смт.Ворзель, вул. ' || ck AS address FROM school_pages""")
def _(spark, sf):
    return G.school_card(view(spark, sf, "school_pages").select("url", F.col("card_html").alias("html")))


@query("school_page_obfuscated", f"""{ctes('school_pages')} SELECT url, 'osvita.ua' AS source, full_name AS name, full_name AS short_name, email, phone, '' AS director, 'Львів' AS city,
'м. Львів, вул. ' || ck AS address FROM school_pages WHERE n % 7 <> 0""")
def _(spark, sf):
    return G.school_page_obfuscated(view(spark, sf, "school_pages").select("url", F.col("script_html").alias("html")))


def s_unescape(x: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, {lit(name)}, {lit(char)})"
    return x


_visible = s_unescape(r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>', '', 'g')")
_h1 = r"coalesce(nullif(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), ''), regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1))"
_plain = "regexp_replace(" + _h1 + ", '<[^>]*>', '', 'g')"
_title = s_strip(f"regexp_replace({s_strip(s_unescape(_plain))}, {lit(R.HEI_TITLE_TAIL)}, '')")
_site = f"regexp_extract(html, {lit(R.HEI_WEBSITE)})"
HEI_SQL = f"""SELECT url, {_title} AS name, regexp_extract(html, {lit(R.EMAIL_BASE)}) AS email, {s_strip(f'regexp_extract(t, {lit(R.PHONE_PAGE)})')} AS phone,
CASE WHEN contains({_site}, {lit(R.HEI_OWN_HOST)}) THEN '' ELSE {_site} END AS website, {s_strip(f'regexp_extract(t, {lit(R.HEI_ADDRESS)})')} AS address,
CASE WHEN {s_any('lower(t)', R.HEI_KEYWORDS)} THEN {lit(R.HEI_TARGET)} ELSE {lit(R.HEI_GENERAL)} END AS target_profile FROM (SELECT url, html, {_visible} AS t FROM pages)"""


@query("hei_page", HEI_SQL)
def _(spark, sf):
    return G.hei_page(table(spark, sf, "pages"))


def s_joined(x: str) -> str:
    return (f"array_to_string(list_filter(list_transform(string_split_regex({x}, '<[^>]*>'), lambda p: {s_strip(s_unescape('p'))}), lambda p: p <> ''), ' ')")


_t = s_joined(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")
_hs = f"list_transform(regexp_extract_all(html, '(?is)<h[12]\\b[^>]*>(.*?)</h[12]\\s*>', 1), lambda h: {s_joined('h')})"


@query("page_summary_text", f"""{ctes('site_pages')} SELECT url, substring(array_to_string(list_concat([{_t}], {_hs}), ' | '), 1, {R.SUMMARY_LENGTH}) AS summary FROM pages
UNION ALL SELECT url, summary FROM site_pages""")
def _(spark, sf):
    return G.page_summary_text(table(spark, sf, "pages")).union(G.page_summary_text(view(spark, sf, "site_pages").select("url", "html")))


_LINK = r"^/[A-Za-z]+$"
_hrefs = r"""list_filter(list_transform(regexp_extract_all(html, '(?is)<a\b[^>]*\bhref\s*=\s*["'']([^"'']*)["'']', 1), lambda h: replace(h, '&amp;', '&')), lambda h: regexp_matches(h, '""" + _LINK + "'))"


@query("detail_links", f"SELECT url, unnest(list_distinct(list_transform({_hrefs}, lambda h: 'https://pages.test' || h))) AS link FROM pages")
def _(spark, sf):
    return G.detail_links(table(spark, sf, "pages"), _LINK, "https://pages.test")
