"""Operators on pages and personal data, and the pipeline."""

import random
import re
import time

import pytest

import corpus_pipeline
from tidemark.llm import exact_dedup, html_text, pii, urlrules
from tidemark.llm.common import settle

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.example.org", "/es/x", "allow"), ("org", "/", "block"), (None, "/x", "block"), ("NET", None, "block")]
URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1?q#f", "https://www.example.org/en/12", "https://www.example.org/en/2", "http://a.example.org/es/x/y", "http://badexample.org/es/", "http://x.com/de/1", "http://x.com/fr#a", "http://x.com/fr/", "x://y.net", "x://net?z://q.com/de/",
    "http://com/de/", "http://example.org", "http://example.org.evil.com/es/", "ftp://example.org:8080/es/", "http://.org/x", "http://a..org/",
]


def by_hand(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in RULES:
        if not h:
            continue
        h, p = h.lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), v == "block")
            if best is None or rank > best[0]:
                best = rank, h + p, v
    return (host, path, best and best[1], best[2] if best else "allow")


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_url_rules(spark, ranges):
    urls = URLS + ["http://www.example.org/es/1"] * 50
    pages = spark.createDataFrame([(k, u, "x", "mine") for k, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge_urls(pages, rules, ranges=ranges).collect()}
    assert got == {k: by_hand(u) for k, u in enumerate(urls)}
    assert urlrules.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urlrules.judge_urls(pages, rules.limit(0), "block").collect()} == {"block"}


def test_nested_rules_at_random(spark):
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice("ab") for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "".join(rng.choice("x/") for _ in range(rng.randrange(0, 4)))
    rules = list({(h, p): (h, p, rng.choice(("allow", "block"))) for h, p in ((host(), path()) for _ in range(40))}.values())
    pages = [(k, f"s://{host()}{path()}") for k in range(300)]
    got = urlrules.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"), "none", ranges=7)
    for r in got.collect():
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert (r.rule, r.verdict) == (max(fits)[2:] if fits else (None, "none"))


CASES = [
    (None, ""), ("", ""), ("plain &lt;b&gt; &eacute;", "plain <b> é"), ("<p>one<p>two<br>three", "one\ntwo three"), ("<article><p>a<!-- b --></p></article><footer>c</footer>", "a"),
    ("<nav>n</nav><main><h1> T  t </h1><aside>x</aside><ul><li>1<li>2</ul></main>", "T t\n1\n2"), ("<script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p>", "yes"),
    ("<div class='cookie-notice'>c</div><div id=sidebar>s</div><div>keep</div>", "keep"), ("<article><header><h1>T</h1></header><form>f</form><section class='comments'><p>r</p></section><p>b</p></article>", "T\nb"),
    ("<p title='a>b'>x</p>", "x"), ("<p>broken <b", "broken"), ("<div hidden>h</div><p>v</p>", "v"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>a&nbsp; b\n\tc</p>", "a b c"), ("<i>in</i><b>line</b>", "inline"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>x" * 2000, "\n".join(["x"] * 2000)),
    ('<div style="overflow:hidden">a</div><p title="The hidden truth">b</p><a href="/hidden/valley">c</a>', "a\nb\nc"), ("<p title='class=ad id=menu'>a</p><a href=/x/hidden>b</a><p data-hidden=1>c</p>", "a\nb\nc"),
    ("<div HIDDEN=''>a</div><div data-x=1 class = 'ad'>b</div><div aria-hidden=true>c</div><p>d</p>", "d"), ("<p>a<svg/>b<math />c<svg width=\"1\"/>d<svg focusable/>e", "abcde"), ("a<svg href=/x/>no</svg>b<svg><path/></svg>c", "abc"),
]


def test_main_text_cases():
    for html, text in CASES:
        assert html_text.main_text(html or "") == text


MARKED = [
    ("<article><h2 id='social-ads'>a</h2><section class='related-work'>b</section><p class='notice-period'>c</p><p id='comments'>d</p><h3 id='Navigation'>e</h3></article>", "a\nb\nc\nd\ne"),
    ("<div class='site-footer x'>a</div><div id='mainMenu'>b</div><div class='adverse events'>c</div><ul class='share-buttons'><li>d</ul><div class='comment-list'>e</div>", "c"),
    ("<table><tr><td>a<tr><td>b</table><ul><li>a<ul><li>b<li>c</ul><li>d</ul><dl><dt>a<dd>b<dt>c</dl>", "a\nb\na\nb\nc\nd\na\nb\nc"),
]


def test_class_words_alone_decide_nothing():
    for html, text in MARKED:
        assert html_text.main_text(html) == text


@pytest.mark.parametrize("html", ["</b></i>" * 60_000, "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 60_000 + "</i>" * 60_000, "<li><ul>" + "<div>" * 50_000 + "<li></li>" * 50_000, "<div>" * 60_000 + "</p>" * 60_000, "<p>" * 150_000, "<td>" * 120_000])
def test_broken_markup_costs_no_more(html):
    began = time.process_time()
    html_text.parse(html)
    assert time.process_time() - began < 4


def test_menus_without_telling_names_go_by_recurrence(spark):
    """Pages whose parts have no names at all: what the site repeats goes, what the page holds stays."""
    menu = "<div class='x1'><ul><li>Home<li>News<li>Mail</ul></div>"
    pages = [(k, f"http://h{k % 2}.org/{k}", f"<body><div>{menu}<div>Host {k % 2} says hello</div><div><h1>T {k}</h1><p>text {k} of the page</p></div></div></body>") for k in range(24)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract_text(df).collect()} == {k: f"T {k}\ntext {k} of the page" for k in range(24)}


def test_templates_go(spark):
    bar = "<div><span>Our site</span> <div>since 1999</div></div>"
    pages = [(k, f"http://{h}/{k}", f"<body>{bar if h == 'a.com' else '<div>other ' + str(k) + '</div>'}<p>Same line</p><p>text {k}</p></body>") for k, h in enumerate(["a.com"] * 10 + ["b.com"] * 10)]
    pages += [(50, None, None), (51, "http://a.com/x", "<article><div>Our site</div><p>q</p></article>"), (51, "http://a.com/x", "<article><div>Our site</div><p>q</p></article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS subtree")
    got = {r.page_id: r for r in html_text.extract_text(df).collect()}
    assert got[3].text == "Same line\ntext 3" and got[13].text == "other 13\nSame line\ntext 13"
    assert got[50].text == "" and got[51].text == "Our site\nq" and got[3].n_chars == len(got[3].text)
    assert html_text.extract_text(df.limit(0)).count() == 0 and html_text.extract_text(df).count() == len(pages)


def test_articles_published_twice_stay(spark):
    df = spark.createDataFrame([(k, "http://a.com/", "<article><h1>T</h1><p>the same</p></article>") for k in range(20)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract_text(df).collect()} == {"T\nthe same"}


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_recurring_blocks_go_wherever_they_stand(spark, bound):
    """Text blocks in the article, an article that is all boilerplate, and copies that must stay whole."""
    one = [(k, "http://a.com/", f"<div>Our site</div><article><h1>T {k}</h1><p>text {k}<p>All rights reserved.<ul><li>Print<li>item {k}</ul><table><tr><td>yes<td>{k}</table><h2>See also</h2></article>") for k in range(10)]
    two = [(100 + k, "http://b.com/", f"<article><p>About us</article><article><p>more {k % 7}</article><main><div>m {k}</div></main>") for k in range(10)]
    two += [(120 + k, "http://b.com/", f"<article><p>About us</article><main><div>m {k}</div></main>") for k in range(2)]
    copies = [(200 + k, "http://c.com/", f"<div class=sidebar>{k}</div><section><article><h1>T</h1><div>d</div><p>the same</article></section><aside>{k}</aside>") for k in range(20)]
    df = spark.createDataFrame(one + two + copies, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(df, broadcast_rows=bound).collect()}
    assert got == {k: f"T {k}\ntext {k}\nitem {k}\nyes\n{k}" for k in range(10)} | {100 + k: f"more {k % 7}" for k in range(10)} | {120 + k: f"m {k}" for k in range(2)} | {200 + k: "T\nd\nthe same" for k in range(20)}


def luhn(digits):
    return sum(d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(map(int, reversed(digits)))) % 10


TEXTS = [
    "Contact Mrs. Anna Schmidt-Lee at anna.Schmidt@Mail9.example.com or +1 (988) 555-2485. Later Anna met Mr Bob O'Neil; SCHMIDT-LEE agreed. anna the cat.",
    "card 4041894974608795, 4041 8949 7460 8795 ip 42.144.35.254, again ANNA.SCHMIDT@mail9.example.com and +1-988-555-2485. iban DE89 3704 0044 0532 0130 00 ssn 123-45-6789",
    "госпожа Анна Иванова и г-н Пётр Иванов.", "", None, "nothing here 12 34 3.14 1.2.3", "+1 (988) 555-2485", "x 4041894974608795", "a" * 100_000,
]


def test_surrogates(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(6, TEXTS[6]), (None, TEXTS[7])], "doc_id long, text string").selectExpr("*", "1 AS _key", "2 AS kind")
    got = {r.doc_id: r for r in pii.replace_pii(df).collect()}
    one, two = got[0].text, got[1].text
    for real in ("Anna ", "Schmidt", "SCHMIDT", "Neil", "988", "anna.", "Mail9"):
        assert real not in one, real
    # one entity, one surrogate, in each mention's format; the unmarked word stays
    name = re.search(r"Mrs\. (\w+) (\w+) at", one)
    assert f"Later {name[1]} met Mr" in one and f"; {name[2].upper()} agreed. anna the cat." in one and name[1].endswith("a")
    mail = re.search(r"at (\S+@\S+) or", one)[1]
    assert mail.lower() == re.search(r"again (\S+@\S+) and", two)[1].lower() and re.fullmatch(r"[a-z]{4}\.[A-Z][a-z]{6}@[A-Z][a-z]{3}\d\.[a-z]{7}\.com", mail)
    phone = re.search(r"or (\+1 \(\d{3}\) \d{3}-\d{4})\.", one)[1]
    assert phone == got[6].text and re.sub(r"\D", "", phone) == re.sub(r"\D", "", re.search(r"and (\+1-\d{3}-\d{3}-\d{4})\.", two)[1])
    cards = re.search(r"card (\d{16}), ((?:\d{4} ){3}\d{4}) ip", two)
    assert cards[1] == cards[2].replace(" ", "") == got[7].text[2:] and cards[1][0] == "4" and cards[1] != "4041894974608795"
    assert luhn(cards[1]) == luhn("4041894974608795")
    assert re.search(r"iban DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d ssn \d{3}-\d\d-\d{4}$", two) and "123-45-6789" not in two
    assert re.fullmatch(r"госпожа [А-Я][а-я]+а [А-Я][а-я]+о? и г-н [А-Я][а-я]+ий [А-Я][а-я]+\.|госпожа [А-Я][а-я]+ [А-Я][а-я]+ и г-н [А-Я][а-я]+ [А-Я][а-я]+\.", got[2].text)
    assert [got[k].text for k in (3, 4, 5, 8)] == [TEXTS[k] for k in (3, 4, 5, 8)] and got[5].n_entities == 0
    assert (got[1].n_card, got[1].n_ip, got[1].n_iban, got[1].n_ssn, got[1].n_phone, got[1].n_email) == (2, 1, 1, 1, 1, 1)
    assert pii.replace_pii(df.limit(0)).count() == 0


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_surrogates_keep_checks_and_identity(spark):
    texts = ["Mr Alex Brown met Ms Alex Green and Dr. Alex White.", "Ms Alex Green again", "contact Anna Schmidt lives in Berlin; contact Anna Schmidt.", "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, FR1420041010050500013M02606", "my name is Rosa Lopez. Rosa!"]
    got = [r.text for r in pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    m, f, n = re.fullmatch(r"Mr (\w+)o \w+ met Ms (\w+)a \w+ and Dr\. (\w+)e \w+\.", got[0]).groups()
    assert m == f == n and got[1].startswith(f"Ms {f}a ")
    assert "Anna" not in got[2] and "Schmidt" not in got[2] and "Berlin" in got[2] and len(set(re.findall(r"contact (\w+ \w+)", got[2]))) == 1
    for old, new in zip(re.findall(r"[A-Z]{2}\d\d[A-Z0-9 ]+\d", texts[3]), re.findall(r"[A-Z]{2}\d\d[A-Z0-9 ]+\d", got[3])):
        old, new = old.replace(" ", ""), new.replace(" ", "")
        assert mod97(old) == mod97(new) == 1 and old[:2] == new[:2] and old != new and len(old) == len(new)
    assert "Rosa" not in got[4] and "Lopez" not in got[4]
    other = [r.text for r in pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "another key").orderBy("doc_id").collect()]
    assert all(a != b for a, b in zip(got, other))


def test_surrogates_of_a_full_format(spark, monkeypatch):
    """Every address of the format is a real one: distinct all the same, and none is real."""
    monkeypatch.setattr(pii, "ROUNDS", 1)
    real = [f"{a}@{b}.de" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame([(k, f"to {m} now") for k, m in enumerate(real)], "doc_id long, text string")
    got = [re.fullmatch(r"to (\S+@\S+\.de) now", r.text)[1] for r in pii.replace_pii(df).collect()]
    assert len(set(got)) == len(real) and not set(got) & set(real)


def test_hmac(spark):
    import hashlib
    import hmac

    for key in ("k", "ключ" * 60):
        got = spark.range(1).selectExpr(f"{pii.hmac_sql(key, "'Anna ж'")} AS h").first().h
        assert got == hmac.new(key.encode(), "Anna ж".encode(), hashlib.sha512).hexdigest()


def test_surrogates_stay_distinct(spark, monkeypatch):
    """Draws that collide are drawn again: here most first draws are made to."""
    plain = pii.surrogate_sql
    monkeypatch.setattr(pii, "surrogate_sql", lambda key, kind, canon, again: f"if({kind} = 'phone' AND {again} < 1, '15550000000', {plain(key, kind, canon, again)})")
    df = spark.createDataFrame([(k, f"call +1 (555) 555-{1000 + k % 20} now") for k in range(40)], "doc_id long, text string")
    for bound in (1000, 0):
        got = {r.doc_id: r.text for r in pii.replace_pii(df, broadcast_rows=bound).collect()}
        assert len(set(got.values())) == 20 and all(got[k] == got[k + 20] for k in range(20))


def test_pipeline(spark):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, out, data), name)
        kept.append(out.count())
        if name != "mix":
            assert out.columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    assert kept == sorted(kept, reverse=True) and kept[-1] == kept[-2] and kept[1] == exact_dedup.exact_dedup(docs).filter("kept").count()
    assert corpus_pipeline.run(spark, data).count() == kept[-1]


def test_pipeline_drops_what_it_should(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text + " ", "en", "a", 1), (3, "12 34", "en", "b", 1), (4, None, None, None, 0), (None, "an odd row without id", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.language(spark, docs, "")
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "1", "2", "None"]
    assert sorted(str(r.doc_id) for r in corpus_pipeline.dedup(spark, left, "").collect()) == ["2", "None"]
    again = spark.createDataFrame(rows[:2], docs.schema)
    assert corpus_pipeline.dedup(spark, again, "").count() == 1


def test_pipeline_tells_rows_of_one_id_apart(spark, tmp_path):
    """Null and repeated ids with exact copies, near copies and benchmark items."""
    w = [f"{a}{b}" for a in ("stone", "river", "light", "house", "garden", "night") for b in ("er", "ing", "ed", "ly", "ness", "ful", "some")]
    a, b, c = " ".join(w), " ".join(reversed(w)), " ".join(w[::2] + w[1::2])
    make = lambda rows: spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    assert left(corpus_pipeline.dedup(spark, make([(3, b), (5, a), (5, b), (None, b), (None, c), (None, c), (7, "x")]), "")) == sorted([("3", b), ("5", a), ("None", c), ("7", "x")])
    assert left(corpus_pipeline.near_dedup(spark, make([(3, b), (5, a), (5, b + " end"), (None, b + " last"), (None, c), (8, ""), (None, "")]), "")) == sorted([("3", b), ("5", a), ("None", c), ("8", ""), ("None", "")])
    spark.createDataFrame([(1, b)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert left(corpus_pipeline.decontaminate(spark, make([(5, a), (5, "see " + b), (None, b), (None, c)]), str(tmp_path))) == sorted([("5", a), ("None", c)])
