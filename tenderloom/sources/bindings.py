"""Input views over the test tables.

Each view is SQL that reads the same in Spark and in the checking database, so a query and its check
start from equal rows. Table names stand in braces. Every view is row-local or one join; duplicate
groups are a fixed small number of neighbouring keys, so their number grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import exists, scratch_dir, small_methods

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {}

VIEWS["leads"] = """
SELECT c_custkey AS lead_id, c_custkey AS pos,
       CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS src_rank,
       CASE WHEN c_custkey % 2 = 0 THEN 'portal' ELSE 'registry' END AS source,
       CASE c_custkey % 4 WHEN 0 THEN concat('"', c_name, '"')
            WHEN 1 THEN concat('  ', upper(c_name), '  ')
            WHEN 2 THEN concat('ТОВ «Організація ', g, '»') ELSE concat('Ліцей   ', g) END AS name,
       concat('ліц. ', g) AS short_name,
       CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN ''
            WHEN 2 THEN concat('  Org', g, '@Ukr.Net ') WHEN 3 THEN concat('o', g, '@yandex.ua')
            WHEN 4 THEN 'not-an-address' WHEN 5 THEN 'noreply@school.org'
            WHEN 6 THEN concat('k', g, '@host.su') WHEN 9 THEN concat('u', g, '@mail.ua')
            WHEN 10 THEN concat('p', g, '@d1.org;x')
            ELSE concat('a', g, '@d', cast(gn % 997 AS string), '.org') END AS email,
       CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat(h, '.0') ELSE lpad(h, 12, '0') END AS org_id,
       CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('+38 (0', cast(50 + c_custkey % 40 AS string), ') ',
            lpad(cast(c_custkey AS string), 7, '1')) END AS phone,
       CASE WHEN c_custkey % 3 = 0 THEN concat('00', g, '; 0', cast(50 + c_custkey % 40 AS string),
            lpad(cast(c_custkey AS string), 7, '1')) ELSE '12/34' END AS phones,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('Director ', h) END AS director,
       CASE n_nationkey % 5 WHEN 0 THEN concat('м. Київ, вул. ', g) WHEN 1 THEN concat('Одеська обл., с. Ново-Петрівка, ', g)
            WHEN 2 THEN concat(' ', n_name, ' , street ', g) WHEN 3 THEN 'смт.Ворзель, вул. Лісова' ELSE '' END AS address,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name END AS city,
       CASE c_custkey % 5 WHEN 1 THEN '' WHEN 2 THEN NULL ELSE concat('https://w', g, '.ua') END AS website,
       CASE c_custkey % 6 WHEN 0 THEN '47.61' WHEN 1 THEN '46.49' WHEN 2 THEN '47.91' WHEN 3 THEN '99.99'
            WHEN 4 THEN '46.49' ELSE '58.11' END AS activity_code,
       CASE c_custkey % 8 WHEN 0 THEN 'Книги та АТЛАСИ' WHEN 1 THEN 'кабель, електротовари' WHEN 2 THEN 'меблі та канцтовари'
            WHEN 3 THEN '' WHEN 4 THEN 'nan' WHEN 5 THEN 'консультації' WHEN 6 THEN NULL
            ELSE 'led ліхтарі' END AS products,
       CASE c_custkey % 9 WHEN 0 THEN 'Педагогічний' WHEN 1 THEN 'геодезія' WHEN 2 THEN 'Археологія, Історія'
            WHEN 3 THEN 'Національний Університет' WHEN 4 THEN 'Коледж' WHEN 5 THEN 'АКАДЕМІЯ' WHEN 6 THEN 'інститут'
            WHEN 7 THEN '' ELSE NULL END AS profile_text,
       cast(c_acctbal AS decimal(18,2)) AS amount
FROM (SELECT *, cast(floor(c_custkey / 88.0) AS bigint) AS gn,
             cast(cast(floor(c_custkey / 88.0) AS bigint) AS string) AS g,
             cast(cast(floor(c_custkey / 3.0) AS bigint) + 10000 AS string) AS h FROM {customer}) AS c
JOIN {nation} ON c_nationkey = n_nationkey
"""

VIEWS["lookup_source"] = """
SELECT s_suppkey AS row_id, cast(s_suppkey % 5 AS int) AS src_rank, concat('src', cast(s_suppkey % 5 AS string)) AS source,
       lpad(cast(cast(floor(s_suppkey / 2.0) AS bigint) + 10000 AS string), 12, '0') AS org_id,
       concat('ТОВ «Організація ', cast(cast(floor(s_suppkey / 3.0) AS bigint) AS string), '»') AS name,
       concat('0', cast(50 + s_suppkey % 40 AS string), lpad(cast(s_suppkey AS string), 7, '1')) AS phone,
       CASE WHEN s_suppkey % 6 = 0 THEN 'broken@' ELSE concat(' S', cast(s_suppkey AS string), '@sup.org') END AS email
FROM {supplier}
"""

VIEWS["domain_status"] = """
SELECT domain, active FROM (
  SELECT concat('d', cast(cast(floor(c_custkey / 88.0) AS bigint) % 997 AS string), '.org') AS domain,
         (cast(floor(c_custkey / 88.0) AS bigint) % 997) % 3 <> 0 AS active FROM {customer}
  UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'ukr.net' ELSE 'sup.org' END, true FROM {supplier}
) AS u GROUP BY domain, active
"""

VIEWS["registry_response"] = """
SELECT s_suppkey AS pos, cast(1 + s_suppkey % 2 AS int) AS registry_rank,
       CASE WHEN s_suppkey % 2 = 0 THEN 'first registry' ELSE 'second registry' END AS registry,
       lpad(cast(cast(floor(s_suppkey / 4.0) AS bigint) + 100000 AS string), 12, '0') AS org_id,
       CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat('r', cast(s_suppkey AS string), '@reg.ru')
            ELSE concat(' r', cast(s_suppkey AS string), '@sup.org ') END AS email
FROM {supplier}
"""

VIEWS["erp_rows"] = """
SELECT c_custkey AS row_id, c_name AS name,
       CASE WHEN c_custkey % 3 = 0 THEN 'have@sup.org' WHEN c_custkey % 3 = 1 THEN '' ELSE NULL END AS email,
       CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN '00012'
            ELSE lpad(cast(cast(floor(c_custkey / 8.0) AS bigint) + 100000 AS string), 12, '0') END AS org_id
FROM {customer}
"""

VIEWS["sales"] = """
SELECT o_orderstatus AS base, c_name AS counterparty, p_name AS item, p_type AS item_group,
       cast(l_extendedprice AS decimal(18,2)) AS amount, cast(l_quantity AS decimal(18,3)) AS qty
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
JOIN {part} ON l_partkey = p_partkey
"""

VIEWS["clients"] = """
SELECT c_name AS counterparty, cast(c_acctbal AS decimal(18,2)) AS amount,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE cast(c_custkey % 9 AS int) END AS ops,
       cast(c_custkey AS string) AS code,
       CASE c_custkey % 6 WHEN 0 THEN 'Послуги ДРУКУ' WHEN 1 THEN 'Школи' WHEN 2 THEN NULL WHEN 3 THEN 'Оптові' ELSE '' END AS client_group,
       CASE c_custkey % 4 WHEN 0 THEN 'F; O' WHEN 1 THEN 'o' WHEN 2 THEN NULL ELSE 'f, P' END AS bases
FROM {customer}
"""

VIEWS["counterparties"] = """
SELECT c_custkey AS owner, cast(c_custkey AS string) AS code, c_name AS name, concat('Legal ', c_name) AS legal_name,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lpad(cast(c_custkey AS string), 8, '0') END AS org_id,
       '' AS tax_id
FROM {customer}
"""

VIEWS["contact_register"] = """
SELECT o_custkey AS owner, o_orderkey AS pos,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('Person ', cast(o_orderkey % 3 AS string)) END AS person,
       CASE o_orderkey % 7 WHEN 0 THEN 'Телефон' WHEN 1 THEN 'Электронная почта' WHEN 2 THEN 'Юр. адрес'
            WHEN 3 THEN NULL WHEN 4 THEN 'МОБ.' WHEN 5 THEN 'E-mail' ELSE 'Телефон' END AS kind,
       CASE o_orderkey % 7 WHEN 0 THEN concat(' +38050', lpad(cast(o_custkey AS string), 7, '0'))
            WHEN 1 THEN concat('c', cast(o_custkey AS string), '@x', cast(o_orderkey % 3 AS string), '.org')
            WHEN 2 THEN concat('м. Місто ', cast(o_orderkey % 5 AS string))
            WHEN 3 THEN lpad(cast(o_custkey AS string), 9, '4') WHEN 4 THEN ''
            WHEN 5 THEN NULL ELSE concat('tel', cast(o_custkey AS string), '@x.org') END AS value
FROM {orders}
"""

VIEWS["customers_shop"] = """
SELECT cast(c_custkey AS string) AS customer_id,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('First', cast(c_custkey AS string)) END AS firstname,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS lastname,
       concat('c', cast(c_custkey AS string), '@shop.org') AS email, '' AS telephone,
       CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE NULL END AS newsletter,
       cast(c_custkey % 17 AS int) AS orders_completed, cast(c_acctbal AS decimal(18,2)) AS orders_total,
       '2024-01-01' AS last_order_date, '2023-01-01' AS date_added
FROM {customer}
"""


def _party(p: str, name: str, legal: str, ident: str, email: str, phone: str) -> str:
    return (f"{name} AS {p}_name, {legal} AS {p}_legal, {ident} AS {p}_id, {email} AS {p}_email, "
            f"{phone} AS {p}_phone, concat(' Person ', c, ' ') AS {p}_contact, concat('City', cast(k % 20 AS string)) AS {p}_city")


VIEWS["tender_base"] = f"""
SELECT k AS doc, concat('t', ks) AS id,
       CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('UA-', b) END AS tender_no,
       CASE k % 7 WHEN 0 THEN NULL ELSE concat('C-', b) END AS contract_no,
       cast(k % 3 AS int) AS query_rank,
       CASE k % 12 WHEN 0 THEN concat('Атлас географії ', c) WHEN 1 THEN 'Паливо дизельне' WHEN 2 THEN 'Cтiнна кapта Укpаїни'
            WHEN 3 THEN 'Карта пам’яті microSD' WHEN 4 THEN NULL WHEN 5 THEN 'Глобус фізичний' WHEN 6 THEN 'Ремонт даху'
            WHEN 7 THEN 'КОНТУРНІ КАРТИ, історія' WHEN 8 THEN 'Папір офісний' WHEN 9 THEN 'Меблі для кабінету історії'
            WHEN 10 THEN '' ELSE 'Навчальні плакати' END AS title,
       CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Дидактичні матеріали' END AS description,
       CASE WHEN k % 4 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN k % 9 = 0 THEN NULL WHEN k % 10 = 0 THEN 0.0 WHEN k % 11 = 0 THEN 500.0 ELSE o_totalprice END AS amount,
       CASE bn % 6 WHEN 0 THEN concat('Ліцей №', b) WHEN 1 THEN concat('Міська ЛІКАРНЯ №', b) WHEN 2 THEN concat('Гімназія №', b)
            WHEN 3 THEN NULL WHEN 4 THEN concat('КНП Центр ', b) ELSE '' END AS buyer_name,
       concat('Юрособа ', b) AS buyer_legal,
       CASE WHEN bn % 7 = 0 THEN NULL ELSE lpad(b, 8, '0') END AS buyer_id,
       CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN concat(' Buy', b, '@D', cast(bn % 997 AS string), '.Org ') WHEN 2 THEN 'x@mail.ru'
            WHEN 3 THEN concat('b', b, '@d', cast(bn % 997 AS string), '.org;') WHEN 4 THEN 'bad' ELSE concat('b', b, '@ukr.net') END AS buyer_email,
       concat(' +380', lpad(b, 9, '5'), ' ') AS buyer_phone, concat(' Contact ', b) AS buyer_contact,
       CASE WHEN k % 6 = 0 THEN NULL ELSE concat('Town', cast(bn % 50 AS string)) END AS buyer_city,
       concat('Region', cast(bn % 24 AS string)) AS buyer_region,
       CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'атлас шкільний' WHEN 2 THEN concat('виріб ', c) ELSE NULL END AS i1_desc,
       CASE WHEN k % 13 = 0 THEN 'kgm' ELSE 'H87' END AS i1_unit,
       CASE k % 5 WHEN 0 THEN '22114200-4' WHEN 1 THEN '39162100-6' WHEN 2 THEN '' ELSE '30190000-7' END AS i1_code,
       CASE WHEN k % 2 = 0 THEN 'друга позиція' ELSE '' END AS i2_desc, NULL AS i2_unit, CASE WHEN k % 4 = 3 THEN '22114200-4' ELSE '03000000-1' END AS i2_code,
       concat('поз. ', c) AS i3_desc, 'H87' AS i3_unit, CASE WHEN k % 3 = 0 THEN NULL ELSE '09130000-9' END AS i3_code,
       'четверта' AS i4_desc, 'H87' AS i4_unit, '03000000-1' AS i4_code,
       CASE k % 6 WHEN 0 THEN '22111000-1' WHEN 1 THEN '22114200-4' ELSE '39162100-6' END AS found_code,
       CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE o_totalprice / 2 END AS aw0_amount,
       CASE WHEN k % 4 = 0 THEN NULL ELSE 100.5 END AS bid0_amount,
       {_party('s00', "concat('Постачальник ', c)", "concat('Повна ', c)", "lpad(c, 8, '0')",
               "CASE k % 3 WHEN 0 THEN NULL ELSE concat('S', c, '@Sup.org') END", "concat('044', lpad(c, 7, '0'))")},
       {_party('s01', "NULL", "concat('ФОП ', b)", "''", "concat('f', b, '@bk.ru')", "''")},
       {_party('s10', "CASE WHEN k % 2 = 0 THEN concat('Постачальник ', c) ELSE '' END", "concat('ФОП ', c)", "lpad(c, 8, '0')",
               "concat('t', c, '@ukr.net')", "NULL")},
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('signer', c, '@d1.org') END AS signer_email,
       CASE WHEN k % 3 = 0 THEN NULL ELSE concat('Signer ', c) END AS signer_name,
       CASE WHEN k % 5 = 0 THEN NULL ELSE concat('+38044', lpad(c, 7, '0')) END AS signer_phone,
       CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('вул. ', c) END AS street,
       CASE WHEN k % 2 = 0 THEN '' ELSE 'Київська' END AS party_region,
       concat(substring(cast(cast(o_orderdate AS date) AS string), 1, 10), 'T10:00:00') AS date_signed
FROM (SELECT o_orderkey AS k, cast(o_orderkey AS string) AS ks, cast(floor(o_orderkey / 2.0) AS bigint) AS bn,
             cast(cast(floor(o_orderkey / 2.0) AS bigint) AS string) AS b, cast(o_custkey AS string) AS c,
             o_orderstatus, o_totalprice, o_orderdate FROM {{orders}}) AS o
"""

VIEWS["job_events"] = """
SELECT concat('k', cast(user_id AS string)) AS job, event_id, ts,
       CASE event_type WHEN 'signup' THEN 'IN_PROGRESS' WHEN 'view' THEN 'PENDING' WHEN 'purchase' THEN 'COMPLETED'
            WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'IN_PROGRESS' ELSE 'SKIPPED' END AS status,
       CASE WHEN event_type = 'view' THEN NULL ELSE cast(floor(value) AS int) END AS page,
       CASE WHEN event_type = 'click' THEN cast(floor(value * 3) AS int) END AS processed,
       CASE WHEN event_type = 'signup' THEN cast(floor(value * 9) AS int) END AS total,
       CASE WHEN event_type = 'error' THEN props END AS error
FROM {events}
"""

VIEWS["listing_rows"] = """
SELECT event_id AS seq, concat('Company ', cast(user_id AS string)) AS name,
       CASE WHEN event_type = 'view' THEN '85.31' ELSE '47.61' END AS activity_code,
       concat('addr ', cast(event_id AS string)) AS address, concat('0', cast(event_id AS string)) AS phone,
       CASE WHEN event_type = 'error' THEN '' ELSE concat('e', cast(event_id AS string), '@x.org') END AS email,
       ts AS ingested_at, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 2 END AS batch
FROM {events}
"""

VIEWS["jobs"] = """
SELECT o_orderkey AS id, concat('k', cast(o_custkey AS string)) AS activity_code,
       CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'completed' ELSE 'failed' END AS status,
       o_orderdate AS created_at, cast(o_orderkey % 4 AS int) AS attempts
FROM {orders}
"""

VIEWS["site_pages"] = """
SELECT concat('https://w', g, '.ua') AS url,
       concat('<html><head><title> Сайт ', g, '</title><meta name="description" content="',
              CASE gn % 4 WHEN 0 THEN 'Меблі для дому' WHEN 1 THEN 'Глобуси та карти' WHEN 2 THEN 'Послуги' ELSE 'Верстати' END,
              '"></head><body><h1>Про <b>нас</b></h1><h2>Контакти &amp; адреса</h2></body></html>') AS html,
       concat('Сайт ', g, ' | ', CASE gn % 4 WHEN 0 THEN 'Меблі для дому' WHEN 1 THEN 'Глобуси та карти' WHEN 2 THEN 'Послуги' ELSE 'Верстати' END,
              ' | Про нас | Контакти & адреса') AS summary
FROM (SELECT DISTINCT cast(floor(c_custkey / 88.0) AS bigint) AS gn,
             cast(cast(floor(c_custkey / 88.0) AS bigint) AS string) AS g FROM {customer}) AS x
"""

VIEWS["directory_pages"] = """
SELECT key, concat('<html><p>Пошта: info@UA-Region.com.ua, ', mail2, ' ; ', mail1, '</p><p>тел. ', phone2, ', ', phone1,
                   ' x+380', lpad(sk, 9, '3'), '</p></html>') AS html, mail1, mail2, phone1, phone2, lpad(sk, 9, '3') AS digits3
FROM (SELECT lpad(cast(cast(s_suppkey AS bigint) + 10000 AS string), 12, '0') AS key, cast(s_suppkey AS string) AS sk,
             concat('a', cast(s_suppkey AS string), '@firm.ua') AS mail1, concat('Z', cast(s_suppkey AS string), '@Firm.ua') AS mail2,
             concat('0', lpad(cast(s_suppkey AS string), 9, '6')) AS phone1,
             concat('+380', lpad(cast(s_suppkey AS string), 9, '7')) AS phone2 FROM {supplier}) AS s
"""

VIEWS["card_pages"] = """
SELECT concat('https://list.test/', ck) AS url, c_name AS name1, addr AS address1, p1 AS phone1, p2 AS phone2, mail AS email1,
       concat('Фірма &quot;', ck, '&quot;') AS raw2, concat('Фірма "', ck, '"') AS name2, c_custkey AS n,
       concat('<html><body><div class="search-result__info">',
              CASE c_custkey % 3 WHEN 0 THEN concat('Знайдено <b>', ck, '</b> компаній із 999') WHEN 1 THEN 'Знайдено компанії' ELSE '' END,
              '</div><div class="row p-3 p-md-4"><div class="cart-company-lg__title"><a href="/c/', ck, '"> ', c_name,
              ' </a></div><ul class="cart-company-lg__list"><li><svg><use xlink:href="#pin"></use></svg><span class="cart-company-lg__list-link"> ', addr,
              ' </span></li><li><svg><use xlink:href="#phone"></use></svg><span class="cart-company-lg__list-link"><a>', p1, '</a><a> ', p2,
              '</a></span></li><li><span class="cart-company-lg__list-link">no icon</span></li><li><svg><use xlink:href="#email"></use></svg><span class="cart-company-lg__list-link"><a>', mail,
              '</a></span></li></ul></div><div class="row p-3 p-md-4"><div class="cart-company-lg__title big"><a>Фірма &quot;', ck,
              '&quot;</a></div></div><div class="row p-3 p-md-4"><div class="cart-company-lg__title"></div></div><div class="pagination">',
              CASE c_custkey % 4 WHEN 0 THEN concat('<a href="?start_page=2">2</a><a href="?start_page=', ck, '">Остання</a>')
                   WHEN 1 THEN '<a>1</a><a>7</a><a>далі</a>' WHEN 2 THEN '' ELSE '<a>далі</a>' END,
              '</div></body></html>') AS html
FROM (SELECT *, cast(c_custkey AS string) AS ck, concat('м. Київ, вул. ', cast(c_custkey AS string)) AS addr,
             concat('050', lpad(cast(c_custkey AS string), 7, '0')) AS p1, concat('067', lpad(cast(c_custkey AS string), 7, '0')) AS p2,
             concat('m', cast(c_custkey AS string), '@firm.ua') AS mail FROM {customer}) AS c
"""

VIEWS["school_pages"] = """
SELECT concat('https://school.test/', ck) AS url, short AS short_name, fullname AS full_name, mail AS email, tel AS phone, boss AS director,
       concat('<html><body><h2 class="text-center">', short, '</h2>',
              CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('<h3 class="text-center x"> "', fullname, '" </h3>') END,
              '<div class="znv-card-blue"><h4>Інше</h4></div><div class="znv-card-blue">Контакти <p>Директор: ', boss, '</p><p>Ел.почта ', mail,
              '</p><p>Телефон ', tel, '</p></div><div class="znv-card-gray"><b>Адреса</b> смт.Ворзель, вул. ', ck,
              ' Гугл Карта</div></body></html>') AS card_html,
       concat('<html><body><h1 class="text-header-title">', CASE WHEN c_custkey % 7 = 0 THEN 'Школи України' ELSE fullname END, '</h1>',
              '<script>var w = "100%";</script><script>document.write(unescape("%3Ca%20href%3D%22mailto%3A',
              replace(replace(mail, '@', '%40'), '.', '%2E'), '%22%3E"))</script><div class="block-frame-2167"><span class="telefon"> м. Львів, вул. ', ck,
              ' </span><span class="telefon">', tel, '</span></div></body></html>') AS script_html,
       concat('document.write(unescape("%3Ca%20href%3D%22mailto%3A', replace(replace(mail, '@', '%40'), '.', '%2E'), '%22%3E 50%"))') AS script,
       c_custkey AS n, ck
FROM (SELECT c_custkey, cast(c_custkey AS string) AS ck, concat('Школа №', cast(c_custkey AS string)) AS short,
             concat('Загальноосвітня школа №', cast(c_custkey AS string)) AS fullname,
             concat('s', cast(c_custkey AS string), '@school.ua') AS mail,
             concat('(044) ', lpad(cast(c_custkey AS string), 7, '5')) AS tel, concat('Прізвище ', c_mktsegment) AS boss FROM {customer}) AS c
"""

VIEWS["classifier"] = """
SELECT p_partkey AS n, concat(CASE p_partkey % 4 WHEN 0 THEN 'АТЛАСИ ' WHEN 1 THEN 'Сталь ' WHEN 2 THEN 'Зошити ' ELSE 'Цемент ' END,
       lpad(cast(cast(floor(p_partkey / 8.0) AS bigint) AS string), 8, '2'), '-', cast(p_partkey % 2 AS string), ' / 12345678-9') AS text
FROM {part}
"""


# ------------------------------------------------------------------------------- Spark side
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Views that turn every narrow row of a table into a document or page of some kilobytes, and that table.
WIDE = {"tender_base": "orders", "card_pages": "customer", "school_pages": "customer"}
#: Rows that one task turns into documents or pages.
SPREAD_ROWS = 20_000


def spread(df: DataFrame) -> DataFrame:
    """The rows over tasks of about ``SPREAD_ROWS``: a row group is read by one task, and of narrow rows it may hold a million."""
    return df.repartition(max(1, -(-df.count() // SPREAD_ROWS)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; only the tables it names are opened."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    if name in WIDE:
        used[WIDE[name]] = spread(used[WIDE[name]])
    return spark.sql(text, **used)


def _party_struct(p: str, buyer: bool = False, signer: bool = False) -> Column:
    def c(field, path=p):
        return F.col(f"{path}_{field}")

    null = F.lit(None).cast("string")
    return F.struct(
        c("name").cast("string").alias("name"),
        F.struct(c("id").alias("id"), c("legal").alias("legalName")).alias("identifier"),
        F.struct(c("contact").alias("name"), c("email").alias("email"), c("phone").cast("string").alias("telephone")).alias("contactPoint"),
        F.struct((F.col("street") if signer else null).alias("streetAddress"), c("city").alias("locality"),
                 (F.col("buyer_region") if buyer else F.col("party_region")).alias("region")).alias("address"),
        F.struct(*[(F.col(f"signer_{x}") if signer else null).alias(n)
                   for x, n in (("name", "name"), ("email", "email"), ("phone", "telephone"))]).alias("signerInfo"))


def _amount(c) -> Column:
    return F.struct(F.col(c).cast("double").alias("amount"))


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A document table, written once per application to the shared scratch folder.

    Documents are stored data in real use: the jobs that read them then open only the nested fields
    they need, instead of carrying the building expressions of whole documents.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not exists(spark, _STORED[key]):
        path = scratch_dir(spark, name)
        with small_methods(spark):
            # row groups small enough to be read by several tasks, however few files there are; dictionaries of mostly
            # distinct values double the time of writing and save little
            build(spark, sf_dir).write.options(**{"parquet.block.size": 16 << 20, "parquet.enable.dictionary": "false"}).parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested tender documents derived from ``tender_base``."""
    return _stored(spark, sf_dir, "tenders", _build_tenders)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested contract documents derived from ``tender_base``."""
    return _stored(spark, sf_dir, "contracts", _build_contracts)


def _build_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = view(spark, sf_dir, "tender_base")
    items = [F.struct(
        F.col(f"i{n}_desc").alias("description"), F.struct(F.col(f"i{n}_unit").cast("string").alias("code")).alias("unit"),
        F.struct(F.col(f"i{n}_code").alias("id")).alias("classification")) for n in (1, 2, 3, 4)]
    s00, s01, s10 = (_party_struct(p) for p in ("s00", "s01", "s10"))

    def entry(status, amount, parties, name):
        return F.struct(F.lit(status).alias("status"), amount.alias("value"), F.array(*parties).alias(name))

    none = F.struct(F.lit(None).cast("double").alias("amount"))
    return b.select(
        "doc", F.col("doc").alias("pos"), "query_rank", "found_code", "id", F.col("tender_no").alias("tenderID"),
        "title", "description", "status", _amount("amount").alias("value"),
        _party_struct("buyer", buyer=True).alias("procuringEntity"), F.array(*items).alias("items"),
        F.array(entry("active", _amount("aw0_amount"), [s00, s01], "suppliers"),
                entry("unsuccessful", none, [s10], "suppliers")).alias("awards"),
        F.array(entry("active", _amount("bid0_amount"), [s00], "tenderers"),
                entry("invalid", none, [s10, s01], "tenderers")).alias("bids"))


def _build_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = view(spark, sf_dir, "tender_base")
    suppliers = F.when(F.col("doc") % 17 == 0, F.array().cast(
        b.select(F.array(_party_struct("s00", signer=True)).alias("x")).schema["x"].dataType)).when(
        F.col("doc") % 2 == 0, F.array(_party_struct("s00", signer=True), _party_struct("s01", signer=True))).otherwise(
        F.array(_party_struct("s10", signer=True)))
    return b.select(
        "doc", F.col("doc").alias("pos"), "query_rank", "id", F.col("contract_no").alias("contractID"), "status",
        F.col("date_signed").alias("dateSigned"), _amount("amount").alias("value"),
        _party_struct("buyer", buyer=True).alias("buyer"), suppliers.alias("suppliers"))


# ------------------------------------------------------------------------------- check side
def ctes(*names: str) -> str:
    """WITH clause that defines the named views over plain table names."""
    plain = {t: t for t in TABLES}
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**plain).strip()})" for n in names)
