from tenderloom import rules as R
from tenderloom.operators import pages as G


def pages(spark, *htmls):
    return spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(htmls)], "url string, html string")


def card(name, *lines):
    items = "".join(f'<li><svg class="i"><use xlink:href="/s.svg#{icon}"></use></svg><span class="cart-company-lg__list-link x">{body}</span></li>' for icon, body in lines)
    title = f'<div class="cart-company-lg__title"><a href="#">{name}</a></div>' if name else ""
    return f'<div class="row p-3 p-md-4">{title}<ul class="cart-company-lg__list">{items}</ul></div>'


def test_listing_cards(spark):
    html = "<div class='top'><a>menu</a></div>" + card(
        " ТОВ &quot;А&amp;Б&quot; ", ("icon-pin", " м. Київ "), ("phone", "<a> 1 </a><a>2</a>"), ("email", "<a>a@b.org</a><a>z@b.org</a>")
    ) + card("", ("pin", "lost")) + card("Друга <b>фірма</b>", ("pin", "old"), ("pin", "new"), ("email", "no link"))
    got = [(r.name, r.address, r.phone, r.email) for r in G.listing_cards(pages(spark, html, "<p>none</p>")).orderBy("card_pos").collect()]
    assert got == [('ТОВ "А&Б"', "м. Київ", "1, 2", "a@b.org"), ("Друга фірма", "new", "", "")]


def test_listing_totals(spark):
    info = '<div class="search-result__info">Знайдено <b>41</b> з 99</div>'
    pager = '<div class="pagination"><a href="?start_page=2">2</a><a href="?x=1&start_page=30">Остання</a><a>далі</a></div>'
    df = pages(spark, info + pager, info, pager, "")
    got = {r.url: (r.total_companies, r.total_pages) for r in G.listing_totals(df).collect()}
    assert got == {"u0": (41, 30), "u1": (41, 3), "u2": (600, 30), "u3": (20000, 1000)}
    assert {r.url: r.total_companies for r in G.listing_totals(df, estimate_from_pages=False).collect()}["u2"] == 20000


def test_listing_totals_beyond_32_bits(spark):
    got = G.listing_totals(pages(spark, '<div class="search-result__info">3000000000 компаній</div>')).first()
    assert (got.total_companies, got.total_pages) == (3_000_000_000, 150_000_000)


def test_school_card(spark):
    html = ('<h2 class="text-center"> "Ліцей" </h2><div class="a znv-card-blue b">Інше a@wrong.org</div><div class="znv-card-blue"><h4>Контакти</h4>'
            '<p>Директор Ім’я По-батькові</p><p>Ел.почта Boss@School.UA</p><p>Телефон (0432) 12-34-56</p></div>'
            '<div class="znv-card-gray">Адреса м.Вінниця, вул. 1 <a>Гугл Карта</a></div><footer>b@late.org</footer>')
    r = G.school_card(pages(spark, html, "<h2>no class</h2>")).collect()
    assert len(r) == 1
    assert (r[0].name, r[0].email, r[0].phone, r[0].director, r[0].city, r[0].address) == (
        "Ліцей", "boss@school.ua", "(0432) 12-34-56", "Ім’я По-батькові", "Вінниця", "м.Вінниця, вул. 1")


def test_obfuscated_page(spark):
    html = ('<h1 class="text-header-title">Школа №1</h1><script>x("50%")</script><script>unescape("%3Ca href=%22mailto:%61%40b%2Eua")</script>'
            '<span class="telefon">outside</span><div class="block-frame-2167"><span class="telefon">м. Львів, 1</span><b><span class="telefon">555</span></b></div>')
    r = G.school_page_obfuscated(pages(spark, html, '<h1 class="text-header-title">Школи України</h1>', "")).collect()
    assert [(x.name, x.email, x.address, x.phone, x.city) for x in r] == [("Школа №1", "a@b.ua", "м. Львів, 1", "555", "Львів")]


def test_hei_page(spark):
    html = ("<title>t</title><h1>Університет - вузи України, Київ</h1><style>географ</style><script>eval(unescape('%72@uni%2Eedu%2Eua'))</script>"
            "<p>Тел. (044) 123-45-67</p><p>Історичний факультет</p><p>м. КИЇВ, вул. ДОВГА 5</p><a href='https://uni.edu.ua/x'>s</a> plain@y.org")
    r = G.hei_page(pages(spark, html, "<title>Лише заголовок</title>https://osvita.ua/1 c@d.org")).orderBy("url").collect()
    assert (r[0].name, r[0].email, r[0].phone, r[0].website, r[0].target_profile) == ("Університет", "r@uni.edu.ua", "(044) 123-45-67", "https://uni.edu.ua", R.HEI_TARGET)
    assert r[0].address.startswith("м. КИЇВ, вул. ДОВГА 5")
    assert (r[1].name, r[1].email, r[1].website, r[1].target_profile) == ("Лише заголовок", "c@d.org", "", R.HEI_GENERAL)


def test_summary(spark):
    html = '<title> A&amp;B </title><meta content="опис" name="description"><h1>x <b> y </b></h1><h3>no</h3><h2></h2><h2>z &#1111;</h2>'
    got = [r.summary for r in G.page_summary_text(pages(spark, html, "<p>none</p>")).orderBy("url").collect()]
    assert got == ["A&B | опис | x y |  | z ї", ""]
    assert G.page_summary_text(pages(spark, html), 3).first().summary == "A&B"


def test_links(spark):
    html = '<a href="/d/1">x</a><a class="q" href=\'/d/1\'>x</a><a href="https://h/d/2">y</a><a href="/other">z</a>'
    assert [r.link for r in G.detail_links(pages(spark, html), r"/d/\d+$", "https://h").collect()] == ["https://h/d/1", "https://h/d/2"]


def test_usable(spark):
    ok = "<p>" + "текст " * 100 + "</p>"
    rows = [ok, "short", ok + "<p>Confirm you are not a Robot: CAPTCHA</p>", ok + "<p>робота</p>", ok + '<img src="/x/security.png">', ok + '<input name="honeypot" type="hidden">',
            ok + '<input name="honeypot" type="text">', ok + '<i style="display:none"></i>' * 6, ok + '<i style="display: none"></i>' * 5, ok + '<p title="captcha">x</p>']
    got = sorted(int(r.url[1:]) for r in G.page_usable(pages(spark, *rows)).collect())
    assert got == [0, 3, 6, 8, 9]


def test_one_page_per_key(spark):
    df = spark.createDataFrame([("a", "p", 2), ("a", "p", 1), ("a", None, 3), ("a", "", 4)], "url string, params string, pos int")
    assert sorted(r.pos for r in G.one_page_per_key(df, ["pos"], "params").collect()) == [1, 3]


def test_fragments_end_at_their_own_closing_tag(spark):
    html = ('<div class="search-result__info"><div>x</div>Found 55</div><div class=\'pagination\'><div><a>1</a></div>'
            '<a>9</a></div><a>77</a>')
    open_end = '<div class="search-result__info">12 <div>x</div>'
    got = {r.url: (r.total_companies, r.total_pages) for r in G.listing_totals(pages(spark, html, open_end)).collect()}
    assert got["u0"] == (55, 9) and got["u1"][0] == 12
    badge = card("Фірма", ("pin", "місто")).replace('__title"><a', '__title"><div>badge</div><a')
    assert [r.name for r in G.listing_cards(pages(spark, badge)).collect()] == ["Фірма"]


def test_school_card_text_ends_with_the_card(spark):
    html = ("<h2 class='text-center'>Ліцей &#x41;&#66;</h2><div class='znv-card-blue'><div>Контакти</div><p>a@school.ua</p></div>"
            '<div class="side">Телефон (0432) 12-34-56</div><div class="znv-card-gray"><div>Адреса</div> м.Вінниця, вул. 1</div><div>вул. 2</div>')
    r = G.school_card(pages(spark, html)).collect()[0]
    assert (r.name, r.email, r.phone, r.address) == ("Ліцей AB", "a@school.ua", "", "м.Вінниця, вул. 1")


def test_character_references_are_those_of_html(spark):
    import html
    from tenderloom.functions import html as H
    rows = [f"a &{name} b" for name in ("hellip;", "Ouml;", "copy", "NotEqualTilde;", "nosuch;", "amp;lt;", "zwnj;", "acE;")] + [
        "&#0; &#x110000; &#55296; &#150; &#x41;&#66 & &; && x", "", "без посилань"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", H.unescape("t").alias("u")).collect()
    assert [r.u for r in got] == [html.unescape(r.t) for r in got]


def test_elements_of_any_depth_and_unclosed_ones(spark):
    from tenderloom.functions import html as H
    deep = "<div>" * 30 + "x" + "</div>" * 30
    rows = {f"<p><div class='q a'>{deep}y</div>z": deep + "y", "<div class=\"a\"><div>x": "<div>x", '<div class="b">n</div>': "",
            '<DIV><div class="a b">1<DIV >2</DIV>3</Div>4': "1<DIV >2</DIV>3", "": "", "<div class='a'></div><div class='a'>late</div>": "",
            "<div class='a'>" + "<div>i</div>" * 5000 + "</div>out": "<div>i</div>" * 5000, "<div class='a'>" * 3000: "<div class='a'>" * 2999}
    df = spark.createDataFrame([(r,) for r in rows], "t string").withColumn("found", H.elements("t", ("div", "a"), ("p", None)))
    for r in df.select("t", H.element("t", "div", "a").alias("one"), H.field(df["found"], "t", "div", "a").alias("streamed")).collect():
        assert (r.one, r.streamed) == (rows[r.t], rows[r.t])
    nested = spark.createDataFrame([("<p>a<span class='t'>1<span class=\"t\">2</span></span>",)], "t string")
    assert nested.select(H.elements("t", ("span", "t"), ("p", None)).alias("e")).first().e == [
        "p>a<span class='t'>1<span class=\"t\">2</span></span>", "span class='t'>1<span class=\"t\">2</span>", 'span class="t">2']
