import hashlib
import random
import re

import pytest

from tenderloom import rules as R
from tenderloom.functions import classify as C, email as E, priority as P, text as T


def test_strip_takes_every_kind_of_whitespace(column):
    assert column(T.strip, ["  a b\t\n", " x　", "", None]) == ["a b", "x", "", None]


def test_names(column):
    assert column(T.norm_name, ["  ТОВ\t Ромашка  ", None, ""]) == ["тов ромашка", "", ""]
    assert column(T.norm_org_name, ['"Ліцей  №1"', "«О’Генрі»", None]) == ["ліцей №1", "огенрі", ""]
    assert column(T.clean_text, ['  "Школа\n №2" ', None]) == ["Школа №2", ""]
    assert column(T.nan_clean, ["nan", "None", None, "nano"]) == ["", "", "", "nano"]


def test_company_drops_legal_forms_as_words_only(column):
    assert column(T.clean_company, ["ТОВ «Товариство Тов-ар» (фірма)", "ПРАТ Атоваль", "ФОП", None]) == ["-ар", "атоваль", "", ""]


def test_ids_and_phones(column):
    assert column(T.clean_id, ["0012345.0", "1234", "00001234", "12a456", None]) == ["12345", "", "", "", ""]
    assert column(T.strip_zeros, ["00120", " 0", None]) == ["120", "", ""]
    assert column(T.phone_last9, ["+38 (050) 123-45-67", "12345678", None]) == ["501234567", "", ""]


def test_city(column):
    rows = ["м. Київ, вул. 1", "Одеська обл., с. Ново-Петрівка", "смт.Ворзель, 5", " Львів , пл. 1", "", None, "Сум. обл, Ромни"]
    assert column(T.city_from_address, rows) == ["Київ", "Ново-Петрівка", "смт.Ворзель", "Львів", "", "", "Сум. обл"]
    assert column(lambda c: T.city_from_address(c, False), ["смт.Ворзель, 5", "м.Суми"]) == ["Ворзель", "Суми"]


def test_homoglyphs(column):
    assert column(T.homoglyph_fold, [" Aтлac ", "KAPTA", None]) == ["атлас", "карта", ""]


def test_lookup_key(columns):
    rows = [("12345678", "n"), ("1234567", " n "), ("nan", ""), (None, None), ("nan", "nan")]
    assert columns(lambda: T.lookup_key("a", "b"), rows, ["a string", "b string"]) == ["12345678", "n", None, None, None]


def test_page_key(columns):
    rows = [("http://a", '{"p": 1}'), ("http://a", ""), ("http://a", None)]
    want = [hashlib.sha256(x.encode()).hexdigest() for x in ('http://a_{"p": 1}', "http://a", "http://a")]
    assert columns(lambda: T.page_key("u", "p"), rows, ["u string", "p string"]) == want


def test_extraction(column):
    text = "Info@UA-Region.com.ua, Boss@Firm.UA; z@x.org"
    assert column(T.extract_emails, [text, "no address", None]) == [["boss@firm.ua", "z@x.org"], [], []]
    assert column(lambda c: T.extract_emails(c, ("firm",), "domain"), ["firm@x.org a@firm.org"]) == [["firm@x.org"]]
    assert column(T.extract_phones, ["+380501234567 0671234567 тел0671234567 00671234567"]) == [["+380501234567", "0671234567"]]
    assert column(T.class_codes, ["22114200-4 і 123456789-1"]) == [["22114200-4", "23456789-1"]]
    assert column(lambda c: T.text_cap(c, 3), ["їжак", None]) == ["їжа", None]


def test_percent_decoding_survives_stray_signs(column):
    rows = ['w="100%"; unescape("%3Ca%20href%3D%22mailto%3Aa%2Bb%40c%2Eua%22")', "x%zz", "plain@x.org", None]
    assert column(T.percent_decode_email, rows) == ["a+b@c.ua", "", "plain@x.org", ""]


# ---------------------------------------------------------------- e-mail
ADDRESSES = [
    None, "", " A@B.org ", "a@b", "a@b.c", "x@mail.ru", "x@sub.mail.ru", "x@yandex.ua", "x@yandex.com", "x@mail.ua", "x@b.su",
    "x@b.xn--p1ai", "x@example.com", "a@@b.org", "a b@c.org", "a@b.org;c", "ф@b.org", "x@B.RU", "a@b.org.", "q@q.by",
    "a" * 95 + "@b.org", "a" * 94 + "@b.org", "a@b.cd", "@b.org", "nan", "x@ok.ru@good.org",
]


def plain_ok(address, rule):
    """The rule read step by step, as the reference of the one-pattern form."""
    a = (address or "").strip().lower()
    domain = a.split("@")[-1]
    if "@" not in a or domain in rule.blocked_domains:
        return False
    if (domain if rule.suffix_on == "domain" else a).endswith(tuple(rule.blocked_suffixes) or ("\0",)):
        return False
    if rule.length and not rule.length[0] <= len(a) <= rule.length[1]:
        return False
    return re.match(rule.pattern, a) is not None


@pytest.mark.parametrize("rule", [
    R.EMAIL_STRICT, R.EMAIL_LOOSE_8, R.EMAIL_FULL, R.EMAIL_PREFIX, R.EMAIL_PREFIX_8, R.EMAIL_SUFFIX_ONLY])
def test_email_rules(column, rule):
    rnd = random.Random(7)
    noise = ["".join(rnd.choice("ab@.ru su-") for _ in range(rnd.randint(3, 14))) for _ in range(400)]
    rows = ADDRESSES + noise
    assert column(lambda c: E.email_ok(c, rule), rows) == [plain_ok(a, rule) for a in rows]


def test_email_reason_and_presence(column):
    rows = ["", "bad", "noreply@x.org", "NoReply@x.org", "a@example.org", "x@a.invalid", "ok@x.org", None]
    assert column(E.syntax_reason, rows) == ["empty", "bad_syntax", "bad_syntax", "bad_syntax", "bad_syntax", "bad_syntax", "ok", "empty"]
    assert column(E.email_present, [None, "nan", "a@b", "x"]) == [False, False, True, False]


# ---------------------------------------------------------------- classes and ranks
def test_product_and_profile(columns):
    cols = ["a string", "b string"]
    assert columns(lambda: C.product_category("a", "b"), [("АТЛАСИ та глобус", None), ("x", ""), (None, "Карта")], cols) == [
        "Шкільні Атласи | Глобуси", R.PRODUCT_DEFAULT, "Географічні / Історичні Карти"]
    assert columns(lambda: C.profile_class("a", "b"), [
        ("Педагогічний коледж", ""), ("Національний", "університет"), ("Національний", ""), ("Інститут геодезії", None), (None, None)], cols) == [
        R.PROFILE_RULES[0][2], R.PROFILE_RULES[3][2], R.PROFILE_DEFAULT, R.PROFILE_RULES[1][2], R.PROFILE_DEFAULT]


def test_contact_kind_can_be_both(columns):
    cols = ["k string", "v string"]
    rows = [("Телефон", "a@b.org"), ("", "+38 (050) 1"), ("", "12345678"), ("Юр. адрес", "м. Київ"), ("факт", "a@b"), (None, None)]
    got = [(r.is_phone, r.is_email, r.is_address) for r in columns(lambda: C.contact_kind("k", "v"), rows, cols)]
    assert got == [(True, True, False), (True, False, False), (True, False, False), (False, False, True), (False, True, False), (False, False, False)]
    assert columns(lambda: C.contact_kind_rowwise("k", "v"), [
        ("Телефон", "a@b.org"), ("", "+38-050"), ("", "12"), ("пошта", "a@b"), ("Юр. адрес", "x"), ("", "x"), ("моб", " ")], cols) == [
        "phone", "phone", "phone", "email", "address", None, None]


def test_order_class(columns):
    got = columns(lambda: C.order_class("g", "i", "o"), [("Послуги", "", 9), ("", "", 5), ("", None, 4), (None, "", None)], ["g string", "i string", "o int"])
    assert [g.category for g in got] == [R.ORDER_CUSTOM[0], R.ORDER_REGULAR[0], R.ORDER_SINGLE[0], R.ORDER_SINGLE[0]]


def test_partner_class(columns):
    rows = [("47.61", "кабель"), ("46.49", "nan"), ("46.49", "КАБЕЛЬ та книги"), ("99.99", "Кабельна продукція"), ("46.49", "Зошити"), ("46.49", "послуги"), (None, None)]
    got = columns(lambda: C.partner_class("c", "t"), rows, ["c string", "t string"])
    assert [(g.status, g.reason) for g in got] == [
        (R.PARTNER_OK, R.PARTNER_REASON_SAFE), (R.PARTNER_CHECK, R.PARTNER_REASON_BLANK), (R.PARTNER_OK, R.PARTNER_REASON_BOTH),
        (R.PARTNER_REJECT, "Нерелевантна продукція: Кабель…"), (R.PARTNER_OK, R.PARTNER_REASON_INCLUDE),
        (R.PARTNER_CHECK, R.PARTNER_REASON_UNCLEAR), (R.PARTNER_CHECK, R.PARTNER_REASON_BLANK)]


def test_partner_reclass(column):
    got = column(C.partner_reclass, ["меблі і Книги", "Меблі", "інше", None])
    assert [g and (g.status, g.reason) for g in got] == [(R.PARTNER_OK, "Сайт: Книг"), (R.PARTNER_REJECT, "Сайт: Меблі"), None, None]


def test_priorities(columns):
    cols = ["e string", "p string", "d string", "i string"]
    rows = [("e", "p", "d", ""), ("e", "p", None, "i"), ("e", "p", "", None), ("e", "", "d", "i"), ("", "p", "d", "i"), (None, None, None, None)]
    assert columns(lambda: P.priority_school("e", "p", "d", "i"), rows, cols) == [1, 1, 2, 3, 4, 4]
    assert columns(lambda: P.priority_partner("e", "p", "d"), rows, cols) == [1, 1, 1, 2, 2, 4]
    assert columns(lambda: P.priority_hei("e", "p", "d"), [("e", "p", "Географічний"), ("e", "p", "x"), ("e", "", "x"), ("", "p", "x")], cols[:3]) == [1, 2, 3, 4]


def test_priority_score(column):
    assert column(P.priority_score, ["P1 - x", "P2", "P3", None]) == [1, 2, 3, 3]


def test_percent_decoding_of_a_very_long_run(spark):
    from tenderloom.functions.text import percent_decode_email

    rows = spark.createDataFrame([("x" * 100_000 + " %61b%40c.ua",), ("A%zz" * 30_000,), ("k" * 100_000 + "%40q.ua 50%",)], "s string").repartition(2)
    got = sorted(len(r[0]) for r in rows.select(percent_decode_email("s")).collect())
    assert got[0] == 0 and got[1] == len("ab@c.ua")
