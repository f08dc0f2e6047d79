"""Rule lists and presets.

Everything in this module is a fixed value: word lists, patterns, labels and thresholds whose exact
content decides the results. Operators take them as parameters, so another set can be passed in.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------- whitespace
# The characters removed by a plain strip().
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --------------------------------------------------------------------------- e-mail
# Address patterns.
EMAIL_BASE = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL_LOOSE = r"[^@\s]+@[^@\s]+\.[^@\s]+"
EMAIL_JUNK = r"(noreply|no-reply|donotreply|admin@admin|test@test|example\.|@localhost|\.invalid$)"

# Domain and suffix lists.
DISCARD_DOMAINS = ("example.com", "domain.com", "test.com", "email.com")
BLOCKED_13 = (
    "mail.ru", "yandex.ru", "yandex.ua", "yandex.com", "rambler.ru", "bk.ru", "inbox.ru",
    "list.ru", "mail.ua", "ok.ru", "vk.com", "lenta.ru", "ya.ru",
)
BLOCKED_8 = (
    "mail.ru", "yandex.ru", "yandex.ua", "rambler.ru", "bk.ru", "inbox.ru", "list.ru", "mail.ua",
)
BLOCKED_5 = ("mail.ru", "yandex.ru", "yandex.ua", "rambler.ru", "bk.ru")
SUFFIXES_4 = (".ru", ".su", ".by", ".xn--p1ai")
SUFFIXES_3 = (".ru", ".su", ".by")


@dataclass(frozen=True)
class EmailRule:
    """One validator: pattern (anchored as written), blocked domains, blocked suffixes, length."""

    pattern: str
    blocked_domains: tuple[str, ...] = ()
    blocked_suffixes: tuple[str, ...] = ()
    suffix_on: str = "domain"  # "domain" or "address"
    length: tuple[int, int] | None = None


EMAIL_STRICT = EmailRule(f"^{EMAIL_BASE}$", DISCARD_DOMAINS + BLOCKED_13, SUFFIXES_4, "domain", (6, 100))
EMAIL_LOOSE_8 = EmailRule(f"^{EMAIL_LOOSE}$", BLOCKED_8, SUFFIXES_4, "address")
EMAIL_FULL = EmailRule(f"^{EMAIL_BASE}$", BLOCKED_5, SUFFIXES_3, "domain")
EMAIL_PREFIX = EmailRule(f"^{EMAIL_BASE}", BLOCKED_5, SUFFIXES_3, "domain")
EMAIL_PREFIX_8 = EmailRule(f"^{EMAIL_BASE}", BLOCKED_8, SUFFIXES_4, "address")
EMAIL_SUFFIX_ONLY = EmailRule(f"^{EMAIL_LOOSE}$", (), SUFFIXES_4, "address")

# Tokens that mark an address found on a directory page as not the company's own.
IGNORE_TOKENS = ("ua-region", "youcontrol", "opendatabot", "clarity", "w3.org", "schema", "example", "domain")
IGNORE_TOKENS_DOMAIN = IGNORE_TOKENS + ("ukr.net_ignore",)
IGNORE_TOKENS_SEARCH = IGNORE_TOKENS + ("sentry",)

# Phone patterns.
PHONE_UA = r"\+?380\d{9}|\b0\d{9}\b"
PHONE_CARD = r"\(?\d{3,5}\)?\s*[\d\-]{5,9}"
PHONE_PAGE = r"\(0\d{2,4}\)\s*[\d\s\-]{5,10}"

# Verification states.
STATUS_SYNTAX = "SYNTAX_ERROR"
STATUS_BLOCKED = "BLOCKED_HOSTILE_DOMAIN"
STATUS_NO_HOST = "INVALID_NO_HOST"
STATUS_ACTIVE = "VALID_HOST_ACTIVE"
STATUS_UNKNOWN = "UNKNOWN"
DOMAIN_ACTIVE_LABEL = "✅ Active"
MX_ACTIVE_LABEL = "Провалідовано (MX Active)"
MX_INVALID_LABEL = "Недійсний"

# --------------------------------------------------------------------------- names and places
# Quote characters, legal forms, settlement markers, look-alike letters.
NAME_QUOTES = "\"«»'”’"
COMPANY_QUOTES = "\"'«»`’()[]"
LEGAL_FORMS = (
    "тов", "пп", "фоп", "дп", "тзов", "ао", "пао", "прат", "приватне", "товариство",
    "підприємство", "фірма", "компанія", "тдв", "кооператив",
)
CITY_MARKERS = r"(?:м\.|місто|с\.|смт\.?|селище)"
CITY_WORD = r"([А-ЯІЇЄҐа-яіїєґ'\-]+)"
HOMOGLYPHS_FROM = "AaBEeHIiKMOoPpCcTXxYy"
HOMOGLYPHS_TO = "АаВЕеНІіКМОоРрСсТХхУу"

# --------------------------------------------------------------------------- leads
# Labels of the two lead tables.
SCHOOL_PORTAL = {"source": "Портал шкіл", "activity_code": "85.31", "activity_label": "Загальна середня освіта"}
SCHOOL_REGISTRY = {"source": "ua-region.com.ua", "activity_code": "85.31", "activity_label": "Освіта"}
HEI_PORTAL = {
    "source": "osvita.ua/vnz", "activity_code": "85.42",
    "activity_label": "Вища освіта (Університети, Академії, Інститути)",
}
HEI_REGISTRY = {
    "source": "ua-region.com.ua", "activity_code": "85.42",
    "activity_label": "Вища та фахова передвища освіта",
}
HEI_OFFER = "Навчальні плакати (Географія, Історія) & Карти"

# Ordered profile rules; each needs any (or, with all=True, every) word.
PROFILE_RULES = (
    (("педагогіч", "педуніверситет"), False, "Педагогічний ЗВО (Підготовка вчителів історії/географії)"),
    (("географ", "картограф", "геодез"), False, "Географічний / Природничий ЗВО"),
    (("істор", "археолог", "гуманітарн"), False, "Історичний / Гуманітарний ЗВО"),
    (("національний", "університет"), True, "Класичний Національний Університет"),
    (("коледж", "технікум"), False, "Фаховий Коледж / Технікум"),
    (("академія", "інститут"), False, "Академія / Науково-навчальний Інститут"),
)
PROFILE_DEFAULT = "Загальний ЗВО / ВНЗ"
PROFILE_TARGETS = ("педагогіч", "географіч", "історич", "класичний")

# Activity codes and labels.
PARTNER_CODES = {
    "47.61": "Роздрібна торгівля книгами",
    "47.62": "Роздрібна торгівля газетами та канцтоварами",
    "46.18": "Агенти: папір, книги, канцтовари",
    "46.49": "Оптова торгівля іншими товарами домашнього вжитку",
    "47.91": "Інтернет-магазини (Yakaboo, BookClub тощо)",
    "58.11": "Видання книг (видавці з власними мережами)",
}
SCHOOL_CODES = {
    "85.31": "Загальна середня освіта (Школи, ліцеї, гімназії)",
    "85.20": "Початкова освіта",
    "85.10": "Дошкільна освіта",
    "85.32": "Професійно-технічна освіта",
    "85.41": "Фахова передвища освіта",
    "85.59": "Інші види освіти (позашкільні заклади, центри)",
    "85.60": "Допоміжна діяльність у сфері освіти (ІРЦ, меткабінети)",
}
REGIONS = {
    "10874": "М.КИЇВ", "24517": "КИЇВСЬКА ОБЛАСТЬ", "14865": "ЛЬВІВСЬКА ОБЛАСТЬ",
    "5300": "ОДЕСЬКА ОБЛАСТЬ", "2266": "ХАРКІВСЬКА ОБЛАСТЬ", "36358": "ДНІПРОПЕТРОВСЬКА ОБЛАСТЬ",
    "7922": "ВІННИЦЬКА ОБЛАСТЬ", "11956": "ЧЕРКАСЬКА ОБЛАСТЬ", "17081": "ІВАНО-ФРАНКІВСЬКА ОБЛАСТЬ",
    "19612": "ЖИТОМИРСЬКА ОБЛАСТЬ", "20519": "ЧЕРНІВЕЦЬКА ОБЛАСТЬ", "21643": "ВОЛИНСЬКА ОБЛАСТЬ",
    "23026": "ПОЛТАВСЬКА ОБЛАСТЬ", "28158": "ХМЕЛЬНИЦЬКА ОБЛАСТЬ", "32404": "ЧЕРНІГІВСЬКА ОБЛАСТЬ",
    "33349": "ТЕРНОПІЛЬСЬКА ОБЛАСТЬ", "35147": "ЗАКАРПАТСЬКА ОБЛАСТЬ", "37839": "МИКОЛАЇВСЬКА ОБЛАСТЬ",
    "39095": "КІРОВОГРАДСЬКА ОБЛАСТЬ", "40151": "РІВНЕНСЬКА ОБЛАСТЬ", "41708": "ЗАПОРІЗЬКА ОБЛАСТЬ",
    "16168": "СУМСЬКА ОБЛАСТЬ", "19000": "ХЕРСОНСЬКА ОБЛАСТЬ", "3431": "ДОНЕЦЬКА ОБЛАСТЬ",
    "6259": "ЛУГАНСЬКА ОБЛАСТЬ",
}

# --------------------------------------------------------------------------- partners
# Activity codes accepted without a text check, and the two word patterns.
PARTNER_SAFE_CODES = ("47.61", "47.62", "58.11", "46.18")
PARTNER_EXCLUDE = (
    r"електр|вимикач|кабель|дріт|провід|LED|ліхтар|освітлен|трансформ|генератор|лічильник"
    r"|сантехнік|труб|батарея|радіатор|клапан|фітинг"
    r"|вікн[аи]|двер[іи]|цемент|бетон|будівельн|плит[кі]|ламін|паркет|шпалер|штукатур|гіпсокартон"
    r"|меблі|матрац|диван|шафа|крісло|стелаж"
    r"|хліб|випічк|борошн|продукт|харчов|молоко|м.ясо|рибн|кавов|алкогол|напо[ї]"
    r"|одяг|взуття|текстиль|тканин|швейн|пряж"
    r"|авто|шини|мастил|моторн|автозапчаст|мото"
    r"|медичн|фармацевт|ліки|таблетк|хірург|стоматол"
    r"|метал|арматур|профіл|балк[аи]|листов|прокат"
    r"|упаковк|скотч|поліетилен|полімер|пластмас|стретч"
    r"|сільськ|агро|фермерств|добрив|насін|пестицид"
    r"|деревин|лісов|пиломатер|паркетн"
    r"|хімія|миючий|мийн|побутов.хімія|розчинник"
    r"|косметик|парфум|шампун|крем для"
    r"|нерухомість|оренда приміщень|ріелтор"
    r"|охорон|сигналізація|відеонагляд"
    r"|техніка для|обладнання для|устаткування для"
    r"|станки|верстат|зварювальн|токарн|фрезерн"
)
PARTNER_INCLUDE = (
    r"книг|книжк|атлас|карт[аи]|карти|канцтовар|канцелярі"
    r"|папір|паперов|бланк|блокнот|щоденник|зошит|зошитів"
    r"|підручник|навчальн|освітн|шкільн|навчальна"
    r"|видавн|поліграф|друкарн|видання"
    r"|ручк[аи]|олівець|маркер|лінійк|ластик"
    r"|конверт|наклейк|стікер"
    r"|офісн|письмов|для офісу"
    r"|глобус|географ|топограф"
)
PARTNER_OK = "✅ релевантний"
PARTNER_CHECK = "⚠️ перевірити"
PARTNER_REJECT = "❌ відсіяти"
PARTNER_REASON_SAFE = "КВЕД профільний"
PARTNER_REASON_BLANK = "Немає опису продукції"
PARTNER_REASON_BOTH = "Профільна + інші товари"
PARTNER_REASON_INCLUDE = "Профільна продукція"
PARTNER_REASON_UNCLEAR = "Опис не дає однозначної відповіді"
PARTNER_REASON_EXCLUDE = "Нерелевантна продукція: "
PARTNER_SITE_PREFIX = "Сайт: "
MATCHED_WORD_LENGTH = 30


@dataclass(frozen=True)
class PartnerRules:
    safe_codes: tuple[str, ...] = PARTNER_SAFE_CODES
    exclude: str = PARTNER_EXCLUDE
    include: str = PARTNER_INCLUDE


# --------------------------------------------------------------------------- tenders
# Public portal addresses used to build links.
TENDER_URL = "https://prozorro.gov.ua/tender/"
CONTRACT_URL = "https://prozorro.gov.ua/contract/"

# Product groups (words in title or description -> label) and the default label.
PRODUCT_GROUPS = (
    (("атлас", "атласи"), "Шкільні Атласи"),
    (("карта", "карти", "картограф"), "Географічні / Історичні Карти"),
    (("глобус", "глобуси"), "Глобуси"),
    (("кабінет географії", "кабінет історії", "дидактич"), "Обладнання Кабінетів Географії та Історії"),
)
PRODUCT_DEFAULT = "Навчальне Обладнання & Карти"

# Feed selection words and class-code prefixes.
FEED_KEYWORDS = (
    "атлас", "атласи", "карта", "карти", "глобус", "глобуси", "географ", "істор", "настінна",
    "дидактич", "посібник", "плакат", "геодезія", "картографія", "топографія", "кабінет географії",
    "кабінет історії",
)
FEED_CODE_PREFIXES = ("22114", "22110", "22140", "22112", "37524", "39162")

# Reject patterns for goods and buyers, unit codes, smallest amount.
GOODS_DENY_SEARCH = (
    r"медичн|амбулатор|електрокардіо|ЕКГ|ecg|"
    r"пам.яті|microsd|sd.карт|"
    r"паливо|паливн|нафт|оливи|мастил|"
    r"ванн|сантех|санітарн|плитк|"
    r"картридж|тонер|принтер|"
    r"харчуванн|їдальн|ноутбук|комп.ютер"
)
GOODS_DENY_CODED = (
    r"медичн|амбулатор|електрокардіо|ЕКГ|ecg|"
    r"пам.яті|microsd|sd.карт|"
    r"паливо|паливн|нафт|оливи|мастил|"
    r"ванн|сантех|санітарн|"
    r"картридж|тонер|принтер|"
    r"харчуванн|їдальн|меблі|"
    r"ноутбук|комп.ютер|планшет"
)
GOODS_ALLOW_CODED = (
    r"атлас|контурн|глобус|стінн.*карт|настінн.*карт|"
    r"карт.*геогр|карт.*істор|карт.*украін|карт.*світ|"
    r"геогр.*карт|карт.*навч|навч.*карт|учбов.*карт|"
    r"картограф|географічн.*карт|карт.*фізич|для ЗЗСО|для шкіл"
)
BUYER_DENY_SEARCH = (
    r"лікарн|поліклінік|амбулатор|диспансер|госпіталь|"
    r"укрнафт|водоканал|теплопостач|"
    r"поліці|прокуратур|суд|митн"
)
BUYER_DENY_CONTRACT = BUYER_DENY_SEARCH + r"|ДСНС|dsns|пожежн"
UNIT_DENY = ("LTR", "MLT", "KGM", "GRM", "MTQ", "CMQ")
MIN_AMOUNT = 1000

# Secondary class codes.
SECONDARY_CODES = (
    "22111000-1", "22112000-8", "39162100-6", "39162200-7", "39162000-5", "22830000-7", "22458000-5",
)


@dataclass(frozen=True)
class TenderRules:
    goods_deny: str = GOODS_DENY_SEARCH
    buyer_deny: str = BUYER_DENY_SEARCH
    unit_deny: tuple[str, ...] = UNIT_DENY
    min_amount: float = MIN_AMOUNT
    goods_allow: str = GOODS_ALLOW_CODED
    secondary_codes: tuple[str, ...] = SECONDARY_CODES


TENDER_SEARCH = TenderRules()
TENDER_CODED = TenderRules(goods_deny=GOODS_DENY_CODED)

# Strict profile patterns (buyer reject, title reject, title accept).
STRICT_BUYER_DENY = (
    r"лікарн", r"медичн", r"госпітал", r"поліклінік", r"амбулатор", r"диспансер", r"здоровпункт",
    r"водоканал", r"укрнафт", r"поліці", r"морський.*порт", r"військов.*частин", r"суд", r"прокуратур",
    r"некомерційне підприємство", r"\bкнп\b", r"підприємство.*охорони.*здоров", r"теплокоммуненерго",
    r"автодор", r"центр.*громадського.*здоров",
)
STRICT_TITLE_DENY = (
    r"медичн", r"амбулаторн", r"пам['\"’]?яті", r"памяти", r"мікросхем", r"кардіограф", r"паливо",
    r"бензин", r"дизель", r"шолом", r"сушарка", r"талон", r"прапор", r"вишива", r"варистор", r"кабель",
    r"відеокарт", r"дослідницьк", r"складськог", r"амбулатор", r"аналіз", r"кров", r"чищення",
    r"страхов", r"стрічка", r"дерев['\"’]?ян", r"огороджен", r"квіт", r"конденсатор", r"дистиляц",
    r"апарати", r"сушарок", r"наколінник", r"налокітник", r"плитоноск", r"автотранспорт", r"догляду",
    r"хворого", r"картою", r"обліку", r"довідка", r"бланки", r"карточка", r"форма", r"технічн",
    r"ремонт", r"автомобіль", r"імітатор", r"реанімаційн", r"манекен", r"вироби.*для.*ванної", r"ванно",
)
STRICT_TITLE_ACCEPT = (
    r"атлас", r"контурн.*картин?", r"контурн.*карт", r"глобус", r"географ", r"істор", r"стінн.*карт",
    r"карт.*україн", r"карт.*світ", r"карт.*європ", r"кабінет.*географії", r"кабінет.*історії",
    r"навчальн.*плакат", r"навчальн.*карт", r"стінн.*плакат", r"дидактичн.*карт",
    r"посібник.*географії", r"посібник.*історії", r"обладнання.*географії", r"обладнання.*історії",
)


@dataclass(frozen=True)
class StrictProfile:
    buyer_deny: tuple[str, ...] = STRICT_BUYER_DENY
    title_deny: tuple[str, ...] = STRICT_TITLE_DENY
    title_accept: tuple[str, ...] = STRICT_TITLE_ACCEPT


# Words that keep a row of the class-code list.
CLASSIFIER_KEYWORDS = (
    "карт", "атлас", "глобус", "географ", "картограф", "навчальн", "освіт", "шкільн", "підручник",
    "посібник", "плакат", "стінн", "навчаль", "контурн", "зошит", "видання", "друков", "книг",
)
CLASS_CODE = r"\d{8}-\d"

# --------------------------------------------------------------------------- ERP
# Order classes.
CUSTOM_ORDER_WORDS = (
    "ламінація", "планки", "заказ", "послуги", "роздруковка", "спец", "друк", "індивід", "монтаж",
    "оформлення",
)
REGULAR_ORDER_MIN_OPS = 5
ORDER_CUSTOM = (
    "🎨 Карти під замовлення (Спецзамовлення/Ламінація)",
    "Спецзамовлення / Послуга",
    "Каталог великоформатних стінних карт, ламінації та планок під спецзамовлення",
)
ORDER_REGULAR = (
    "🔄 Регулярні замовлення",
    "Гурт / Серійні покупки",
    "Каталог нових атласів/карт + гуртові знижки на новий навчальний рік",
)
ORDER_SINGLE = (
    "⚡ Разові замовлення",
    "Разовий Покупець",
    "Реактивація: безкоштовна доставка та спецціна на мінімальну партію",
)


@dataclass(frozen=True)
class OrderRules:
    custom_words: tuple[str, ...] = CUSTOM_ORDER_WORDS
    regular_min_ops: int = REGULAR_ORDER_MIN_OPS


# Words that tell the kind of a contact line.
KIND_EMAIL = ("почта", "e-mail", "email")
KIND_PHONE = ("телефон", "моб", "факс")
KIND_ADDRESS = ("адрес", "юр", "факт")

# Match labels of the two lookup jobs.
MATCH_EXISTING = ("1С Базовий", "Існуючий в 1С")
MATCH_PREFIX = "Збагачено з "
MATCH_ID = "За ЄДРПОУ"
MATCH_NAME = "За Назвою"
MATCH_PHONE = "За телефоном"
FOUND_EXISTING = "1С Запис"
FOUND_ID = "Збагачено через ЄДРПОУ"
FOUND_PHONE = "Збагачено через Телефон"

# E-commerce subscription labels.
SUBSCRIBED = "Підписаний"
NOT_SUBSCRIBED = "Ні"

# Role, category and priority labels of the outreach table.
ROLE_BUYER = "🏛️ Замовник (Покупець)"
ROLE_SCHOOL = "🏛️ Навчальний заклад"
ROLE_WINNER = "🏆 Переможець (Конкурент/Постачальник)"
CATEGORY_TENDER = "Prozorro Замовник"
CATEGORY_CONTRACT = "Prozorro Договори"
CATEGORY_WINNER = "Prozorro Переможець"
CATEGORY_SCHOOL = "Школа K-12"
PRIORITY_TENDER = "P1 - Високий (Покупець тендеру)"
PRIORITY_CONTRACT = "P1 - Високий (Підписаний договір)"
PRIORITY_SCHOOL_SUFFIX = " - Шкільний лід"
SLICE_CATEGORY = "Prozorro"
SLICE_PRIORITY = "P1"

# --------------------------------------------------------------------------- pages
# Page markers and listing defaults.
MIN_PAGE_LENGTH = 500
CHALLENGE_WORDS = (
    "captcha", "recaptcha", "g-recaptcha", "hcaptcha", "перевірка", "я не робот", "підтвердити",
    "verification", "verify",
)
CHALLENGE_WORDS_CASED = ("cloudflare", "challenge", "captcha", "robot", "human verification")
CHALLENGE_SOURCES = r"captcha|verification|security"
HIDDEN_STYLE = r"display:\s*none|visibility:\s*hidden|opacity:\s*0"
MAX_HIDDEN_ELEMENTS = 5
TRAP_INPUT_WORDS = ("bot", "spam", "honey")
CARDS_PER_PAGE = 20
DEFAULT_TOTAL = 20000
DEFAULT_PAGES = 1000
SUMMARY_LENGTH = 1000
TEXT_CAP = 100_000
CARD_STOP_WORDS = ("Ел.почта", "Телефон", "Індекс", "КОАТУУ")
HEI_KEYWORDS = (
    "географ", "істор", "природнич", "педагогіч", "гуманітарн", "краєзнав", "картограф", "геодез",
    "туризм", "еколог",
)
HEI_TARGET = "Географія / Історія / Картографія"
HEI_GENERAL = "Загальний ЗВО"
HEI_OWN_HOST = "osvita.ua"
HEI_WEBSITE = r"https?://[a-zA-Z0-9.-]+\.(?:edu\.ua|org\.ua|com\.ua|net\.ua|ua)"
HEI_ADDRESS = (
    r"м\.\s*[А-ЯІЇЄҐa-zA-Z0-9\s.,\-]+,\s*(?:вул\.|просп\.|пл\.|пров\.)[А-ЯІЇЄҐa-zA-Z0-9\s.,\-]+"
)
HEI_TITLE_TAIL = r"\s*-\s*вузи України.*$"

# Job states.
JOB_STARTED = "IN_PROGRESS"
JOB_FINISHED = ("COMPLETED", "FAILED", "SKIPPED")
JOB_DONE = "COMPLETED"


@dataclass(frozen=True)
class PageMarkers:
    words: tuple[str, ...] = CHALLENGE_WORDS
    words_cased: tuple[str, ...] = CHALLENGE_WORDS_CASED
    sources: str = CHALLENGE_SOURCES
    hidden_style: str = HIDDEN_STYLE
    max_hidden: int = MAX_HIDDEN_ELEMENTS
    trap_inputs: tuple[str, ...] = TRAP_INPUT_WORDS
    extra: tuple[str, ...] = field(default=())
