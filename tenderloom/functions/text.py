"""Text builders: every function takes and returns Columns and stays in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules as R


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Null for null, "" and whitespace-only text; the value itself otherwise."""
    c = col(c)
    return F.when(F.length(strip(c)) > 0, c)


def empty_to_null(c) -> Column:
    """Null for null and "" only (what ``a or b`` skips)."""
    return F.nullif(col(c), F.lit(""))


def null_to_empty(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def strip(c) -> Column:
    """Both ends trimmed of every whitespace character, not only spaces."""
    return F.btrim(col(c), F.lit(R.STRIP_CHARS))


def collapse(c) -> Column:
    return F.regexp_replace(col(c), r"(?U)\s+", " ")


def norm_name(c) -> Column:
    return collapse(F.lower(strip(null_to_empty(c))))


def norm_org_name(c) -> Column:
    return F.lower(strip(collapse(F.translate(null_to_empty(c), R.NAME_QUOTES, ""))))


def clean_company(c, legal_forms=R.LEGAL_FORMS) -> Column:
    spaced = F.translate(F.lower(null_to_empty(c)), R.COMPANY_QUOTES, " " * len(R.COMPANY_QUOTES))
    without = F.regexp_replace(spaced, rf"(?U)\b({'|'.join(legal_forms)})\b", " ")
    return strip(collapse(without))


def clean_id(c, min_len: int = 5) -> Column:
    """Digits of an id without leading zeros, "" when it is not a plausible id."""
    head = F.substring_index(strip(null_to_empty(col(c).cast("string"))), ".", 1)
    bare = strip(F.ltrim(head, F.lit("0")))
    return F.when(bare.rlike(rf"^[0-9]{{{min_len},}}$"), bare).otherwise("")


def strip_zeros(c) -> Column:
    return F.ltrim(strip(null_to_empty(col(c).cast("string"))), F.lit("0"))


def phone_last9(c) -> Column:
    digits = F.regexp_replace(null_to_empty(c), "[^0-9]", "")
    return F.when(F.length(digits) >= 9, F.right(digits, F.lit(9))).otherwise("")


def city_from_address(c, strict_space: bool = True) -> Column:
    """The word after a settlement marker, else the first comma-separated part."""
    text = null_to_empty(c)
    gap = r"\s+" if strict_space else r"\s*"
    found = F.regexp_extract(text, rf"(?U)\b{R.CITY_MARKERS}{gap}{R.CITY_WORD}", 1)
    return F.when(found != "", found).otherwise(strip(F.substring_index(text, ",", 1)))


def homoglyph_fold(c, source: str = R.HOMOGLYPHS_FROM, target: str = R.HOMOGLYPHS_TO) -> Column:
    return strip(F.lower(F.translate(null_to_empty(c), source, target)))


def clean_text(c) -> Column:
    return F.btrim(collapse(null_to_empty(c)), F.lit(' "\t\r\n'))


def nan_clean(c) -> Column:
    c = col(c)
    return F.when(c.isNull() | c.isin("nan", "None"), "").otherwise(c)


def text_cap(c, n: int = R.TEXT_CAP) -> Column:
    """The first ``n`` characters; the rest of the text is lost. No other operator uses it."""
    return F.substring(col(c), 1, n)


def page_key(url, params=None) -> Column:
    """SHA-256 of the url, with "_" and the params JSON appended where there are any."""
    key = col(url)
    if params is not None:
        params = empty_to_null(params)
        key = F.when(params.isNull(), key).otherwise(F.concat(key, F.lit("_"), params))
    return F.sha2(key, 256)


def class_codes(c) -> Column:
    return F.regexp_extract_all(null_to_empty(c), F.lit(R.CLASS_CODE), F.lit(0))


def lookup_key(org_id, name, min_len: int = 8) -> Column:
    """The id where it is long enough, else the name; null when neither can be looked up."""
    org_id, name = strip(null_to_empty(org_id)), strip(null_to_empty(name))
    key = F.when((org_id != "nan") & (F.length(org_id) >= min_len), org_id).otherwise(name)
    return F.when(~key.isin("", "nan"), key)


def contains_any(c, words) -> Column:
    """True when the text holds any of the words (plain substrings)."""
    test = F.lit(False)
    for word in words:
        test = test | col(c).contains(word)
    return F.coalesce(test, F.lit(False))


def contains_all(c, words) -> Column:
    test = F.lit(True)
    for word in words:
        test = test & col(c).contains(word)
    return F.coalesce(test, F.lit(False))


def matches(c, pattern: str) -> Column:
    """Case-insensitive search; null counts as "".

    Text and pattern are both lower-cased, which is much cheaper than a Unicode-aware
    case-insensitive match. The pattern must hold no class whose meaning depends on its case.
    """
    flags = "(?U)" if "\\b" in pattern else ""
    return F.lower(null_to_empty(c)).rlike(flags + pattern.lower())


def first_match(c, pattern: str) -> Column:
    return F.regexp_extract(null_to_empty(c), f"(?iu)({pattern})", 1)


def alternation(patterns) -> str:
    return "|".join(patterns)


def extract_emails(c, ignore=R.IGNORE_TOKENS, scope: str = "address") -> Column:
    """All addresses, lower-cased, in text order, without those holding an ignored token.

    Texts without "@" skip the scan: most texts have none.
    """
    text = null_to_empty(c)
    found = F.transform(
        F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(R.EMAIL_BASE), F.lit(0)))
        .otherwise(F.array().cast("array<string>")), F.lower)

    def keep(e):
        part = F.substring_index(e, "@", -1) if scope == "domain" else e
        return ~contains_any(part, ignore)

    return F.filter(found, keep)


def extract_phones(c, pattern: str = R.PHONE_UA) -> Column:
    return F.regexp_extract_all(null_to_empty(c), F.lit(f"(?U){pattern}"), F.lit(0))


def percent_decode_email(script) -> Column:
    """First address in a script after URL-decoding.

    Only runs of address characters and well-formed escapes are decoded, so that a stray "%" in
    the script cannot spoil the whole text; "+" keeps its meaning. Stray signs are blanked first, so a
    run is one character class and the pattern never recurses, however long the run; what holds no
    "@" after decoding is not searched.
    """
    whole = F.regexp_replace(null_to_empty(script), "%(?![0-9A-Fa-f]{2})", " ")
    runs = F.regexp_extract_all(whole, F.lit(r"[A-Za-z0-9_.@+%-]++"), F.lit(0))
    decoded = F.transform(runs, lambda r: F.coalesce(F.try_url_decode(F.replace(r, F.lit("+"), F.lit("%2B"))), r))
    return F.lower(F.regexp_extract(F.array_join(F.filter(decoded, lambda r: r.contains("@")), " "), R.EMAIL_BASE, 0))
