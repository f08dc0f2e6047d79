"""Contact extraction from stored pages.

Pages are regular directory templates, so each field is found with an expression that stays in the
JVM; no page is ever shipped to a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules as R
from ..functions import html as H, text as T
from .dedup import first_wins

def _class_section(html, cls: str, marker: str) -> Column:
    """Text of the first card of class ``cls`` that mentions ``marker``, up to the card's own end or the next card."""
    blocks = F.split(T.null_to_empty(html), r"""<div\b[^>]*\bclass=["'](?:[^"'>]*\s)?znv-card-""")
    cards = F.transform(
        F.filter(blocks, lambda b: b.rlike(rf"""^{cls}[\s"']""") & b.contains(marker)),
        lambda b: H.own_content(F.regexp_replace(b, r"(?s)^[^>]*>|</body>.*$", ""), "div"))
    return H.unescape(F.regexp_replace(
        T.null_to_empty(F.get(F.filter(cards, lambda c: c.contains(marker)), F.lit(0))), r"<[^>]*>", ""))


# ------------------------------------------------------------------------------- page quality
def _usable(html, min_len: int, m: R.PageMarkers) -> Column:
    text = F.regexp_replace(F.regexp_replace(T.null_to_empty(html), "<!--|-->", " "), r"<[^>]*>", " ")
    words = T.alternation(w.replace(".", r"\.") for w in m.words + m.extra)
    cased = T.alternation(m.words_cased)
    inputs = F.regexp_extract_all(T.null_to_empty(html), F.lit(r"(?is)<input\b[^>]*>"), F.lit(0))
    trap = F.exists(inputs, lambda i: i.rlike(r"""(?i)\btype\s*=\s*["']?hidden""") & i.rlike(
        rf"""(?i)\bname\s*=\s*["'][^"']*({'|'.join(m.trap_inputs)})"""))
    hidden = F.regexp_count(T.col(html), F.lit(rf"""\bstyle\s*=\s*["'][^"']*(?:{m.hidden_style})"""))
    source = T.col(html).rlike(rf"""(?is)<(?:img|iframe|script)\b[^>]*\bsrc\s*=\s*["'][^"']*(?:{m.sources})""")
    blocked = F.lower(text).rlike(words) | text.rlike(cased) | trap | (hidden > m.max_hidden) | source
    return (F.length(T.null_to_empty(html)) >= min_len) & ~blocked


def page_usable(pages: DataFrame, min_len: int = R.MIN_PAGE_LENGTH, markers: R.PageMarkers = R.PageMarkers()) -> DataFrame:
    """Drops pages shorter than ``min_len`` (0: none) and challenge pages instead of content; their rows are lost."""
    return pages.filter(_usable("html", min_len, markers))


def one_page_per_key(pages: DataFrame, order, params: str | None = None) -> DataFrame:
    """First stored page per (url, params) key."""
    keyed = pages.withColumn("page_key", T.page_key("url", params))
    return first_wins(keyed, ["page_key"], order)


# ------------------------------------------------------------------------------- listings
def _card(card: Column) -> Column:
    """Name, address, phone and email of one company card."""
    title, listed = ("div", "cart-company-lg__title"), ("ul", "cart-company-lg__list")
    kinds = ("pin", "phone", "email")

    def line(li):
        # an icon counts for its first matching kind
        def with_icon(icon):
            kind = F.coalesce(*(F.when(icon.contains(k), F.lit(k)) for k in kinds))
            return F.struct(kind.alias("kind"), F.when(
                kind.isNotNull(), H.element(li, "span", "cart-company-lg__list-link")).alias("span"))
        return H.let(F.regexp_extract(li, r"""<use\b[^>]*\bxlink:href=["']([^"']*)["']""", 1), with_icon)

    def anchors(c):
        return F.transform(H.elements(c, ("a", None)), lambda a: H.inner_text(H.content_of(a)))

    def fields(found):
        lines = F.transform(H.elements(H.field(found, card, *listed), ("li", None)), line)

        def of(lines):
            # later lines of a kind replace earlier ones
            def last_of(kind):
                return F.try_element_at(F.filter(lines, lambda x: (x["kind"] == kind) & (x["span"] != "")), F.lit(-1))["span"]

            pin, phone, email = map(last_of, kinds)
            return F.struct(
                H.inner_text(H.element(H.field(found, card, *title), "a")).alias("name"), H.inner_text(pin).alias("address"),
                F.array_join(anchors(phone), ", ").alias("phone"), T.null_to_empty(F.get(anchors(email), F.lit(0))).alias("email"))
        return H.let(lines, of)

    return H.let(H.elements(card, title, listed), fields)


def listing_cards(pages: DataFrame, keep=("url",)) -> DataFrame:
    """One row per company card of a listing page; nameless cards dropped.

    Cards are read before they become rows, so the filter on the name repeats no work.
    """
    cards = F.split("html", r"""<div\b[^>]*\bclass=["']row p-3 p-md-4["'][^>]*>""")
    read = F.transform(cards, lambda card, at: F.when(at > 0, _card(card)))
    return pages.select(*keep, F.posexplode(read).alias("card_pos", "card")).filter("card.name <> ''").select(
        *keep, "card_pos", "card.name", "card.address", "card.phone", "card.email")


def listing_totals(pages: DataFrame, estimate_from_pages: bool = True, keep=("url",)) -> DataFrame:
    """Number of companies and of pages a listing announces, with the usual fallbacks."""
    kinds = ("div", "search-result__info"), ("div", "pagination")
    info = F.regexp_extract(H.inner_text(H.field(F.col("_found"), "html", *kinds[0])), r"(\d+)", 1).try_cast("bigint")
    links = H.elements(H.field(F.col("_found"), "html", *kinds[1]), ("a", None))

    def number(link):
        last = F.regexp_extract(link, r"""^[^>]*href=["'][^"'>]*start_page=(\d+)""", 1)
        return H.let(H.inner_text(H.content_of(link)), lambda text: F.when(
            text.rlike(r"^\d+$"), text.try_cast("bigint")).when(F.lower(text).contains("остання"), last.try_cast("bigint")))

    info_of, pager_of = info, F.array_max(F.transform(links, number))
    info, pager = F.col("_info"), F.col("_pager")
    per_page = R.CARDS_PER_PAGE
    guess = pager * per_page if estimate_from_pages else F.lit(None).cast("bigint")
    derived = F.floor((info + per_page - 1) / per_page).cast("bigint")
    found = pages.withColumn("_found", H.elements("html", *kinds)).withColumns({"_info": info_of, "_pager": pager_of})
    return found.select(
        *keep, F.coalesce(info, guess, F.lit(R.DEFAULT_TOTAL).cast("bigint")).alias("total_companies"),
        F.coalesce(pager, derived, F.lit(R.DEFAULT_PAGES).cast("bigint")).alias("total_pages"))


def detail_links(pages: DataFrame, pattern: str, base: str, keep=("url",)) -> DataFrame:
    """Distinct links of each page that match ``pattern``, made absolute with ``base``."""
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    wanted = F.filter(F.transform(hrefs, lambda h: F.replace(h, F.lit("&amp;"), F.lit("&"))), lambda h: h.rlike(pattern))
    absolute = F.transform(wanted, lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(base), h)))
    return pages.select(*keep, F.explode(F.array_distinct(absolute)).alias("link"))


# ------------------------------------------------------------------------------- detail pages
def school_card(pages: DataFrame, source: str = "znayshov.com", keep=("url",)) -> DataFrame:
    """School page with contact cards; pages without a name give no row."""
    kinds = ("h2", "text-center"), ("h3", "text-center")
    short, full = (T.clean_text(H.inner_text(H.field(F.col("_found"), "html", *kind))) for kind in kinds)
    contacts = _class_section("html", "blue", "Контакти")
    place = _class_section("html", "gray", "Адреса")
    director = F.when(F.col("_card").contains("Директор"), F.substring_index("_card", "Директор", -1)).otherwise("")
    for stop in R.CARD_STOP_WORDS:
        director = F.substring_index(director, stop, 1)
    address = T.clean_text(F.substring_index(F.replace("_place", F.lit("Адреса"), F.lit("")), "Гугл Карта", 1))
    return (
        pages.withColumn("_found", H.elements("html", *kinds)).select(*keep, short.alias("short_name"), full.alias("_full"), contacts.alias("_card"), place.alias("_place"))
        .withColumn("name", F.coalesce(T.empty_to_null("_full"), "short_name")).filter("name <> ''")
        .withColumn("address", address)
        .select(
            F.lit(source).alias("source"), *keep, "name", "short_name",
            F.lower(F.regexp_extract("_card", R.EMAIL_BASE, 0)).alias("email"),
            F.regexp_extract("_card", f"(?U){R.PHONE_CARD}", 0).alias("phone"),
            T.clean_text(director).alias("director"),
            T.city_from_address("address", strict_space=False).alias("city"), "address")
    )


def school_page_obfuscated(pages: DataFrame, source: str = "osvita.ua", index_title: str = "Школи України", keep=("url",)) -> DataFrame:
    """School page whose address is hidden in URL-encoded script text."""
    kinds = ("h1", "text-header-title"), ("div", "block-frame-2167")
    name = T.clean_text(H.inner_text(H.field(F.col("_found"), "html", *kinds[0])))
    scripts = F.regexp_extract_all("html", F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), F.lit(1))
    encoded = F.transform(F.filter(scripts, lambda s: s.contains("%")), T.percent_decode_email)
    emails = F.filter(encoded, lambda e: e != "")
    phones = H.elements(H.field(F.col("_found"), "html", *kinds[1]), ("span", "telefon"))
    spans = F.col("_spans")
    address = T.null_to_empty(F.get(spans, F.lit(0)))
    found = pages.withColumn("_found", H.elements("html", *kinds)).withColumns({
        "_name": name, "_emails": emails, "_spans": F.transform(phones, lambda s: T.clean_text(H.inner_text(H.content_of(s))))})
    return found.select(
        F.lit(source).alias("source"), *keep, F.col("_name").alias("name"), F.col("_name").alias("short_name"),
        T.null_to_empty(F.get("_emails", F.lit(0))).alias("email"),
        T.null_to_empty(F.get(spans, F.lit(1))).alias("phone"), F.lit("").alias("director"),
        T.city_from_address(address, strict_space=False).alias("city"), address.alias("address"),
    ).filter((F.col("name") != "") & ~F.col("name").contains(index_title))


def hei_page(pages: DataFrame, own_host: str = R.HEI_OWN_HOST, keywords=R.HEI_KEYWORDS, keep=("url",)) -> DataFrame:
    """University page: title, address decoded from scripts else first in the page, phone, site."""
    heading = F.coalesce(
        T.empty_to_null(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1)),
        F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))
    title = T.strip(F.regexp_replace(H.inner_text(heading), f"(?U){R.HEI_TITLE_TAIL}", ""))
    hidden = F.transform(
        F.regexp_extract_all("html", F.lit(r"""unescape\(['"]([^'"]+)['"]\)"""), F.lit(1)), T.percent_decode_email)
    plain = F.when(F.col("html").contains("@"), F.regexp_extract("html", f"(?<![a-zA-Z0-9._%+-]){R.EMAIL_BASE}", 0)).otherwise("")
    email = F.coalesce(F.get(F.filter(hidden, lambda e: e != ""), F.lit(0)), plain)
    site = F.regexp_extract("html", R.HEI_WEBSITE, 0)
    text = F.col("_text")
    return pages.select(*keep, "html", H.page_text("html").alias("_text")).select(
        *keep, title.alias("name"), email.alias("email"),
        T.strip(F.regexp_extract(text, f"(?U){R.PHONE_PAGE}", 0)).alias("phone"),
        F.when(site.contains(own_host), "").otherwise(site).alias("website"),
        T.strip(F.regexp_extract(text, f"(?U){R.HEI_ADDRESS}", 0)).alias("address"),
        F.when(T.contains_any(F.lower(text), keywords), R.HEI_TARGET).otherwise(R.HEI_GENERAL).alias("target_profile"))


def page_summary_text(pages: DataFrame, max_chars: int | None = R.SUMMARY_LENGTH, keep=("url",)) -> DataFrame:
    """Title, meta description and first- and second-level headings, joined with " | ".

    ``max_chars`` cuts the column for display; classifiers take it whole (None).
    """
    has_title = F.col("html").rlike(r"(?is)<title\b[^>]*>.*?</title")
    title = H.joined_text(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))
    meta_tags = F.filter(
        F.regexp_extract_all("html", F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)),
        lambda m: m.rlike(r"""\bname\s*=\s*["']description["']"""))
    meta = F.regexp_extract(T.null_to_empty(F.get(meta_tags, F.lit(0))), r"""(?is)\bcontent\s*=\s*(["'])(.*?)\1""", 2)
    heads = F.transform(
        F.regexp_extract_all("html", F.lit(r"(?is)<h[12]\b[^>]*>(.*?)</h[12]\s*>"), F.lit(1)), H.joined_text)
    parts = F.concat(
        F.when(has_title, F.array(title)).otherwise(F.array().cast("array<string>")),
        F.when(meta != "", F.array(H.unescape(meta))).otherwise(F.array().cast("array<string>")), heads)
    whole = F.array_join(parts, " | ")
    return pages.select(*keep, (whole if max_chars is None else F.substring(whole, 1, max_chars)).alias("summary"))
