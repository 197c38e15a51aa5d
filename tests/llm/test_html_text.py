import html
import re

from phenoscope.llm import html_text as H


def _text(source, template=()):
    return H.main_text(H.parse(source), set(template))[0]


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li>Menu</li></ul></nav><!-- x --><div class="ad">Buy</div>
    <article><h1>Head &amp; more</h1><p><b>First &lt;b&gt;<br>line<p>Sec&nbsp;ond <i>in</i>line</p>
    <aside>side</aside><form>f <input value=1> g</form><div class="post-comments"><p>reader</p></div>
    <ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><div hidden>h</div>tail</article>
    <div id="cookieNotice">c</div><footer>&copy;</footer></body></html>"""
    assert _text(page) == "Head & more\nFirst <b> line\nSec ond inline\none\ntwo\na b\nc\ntail"
    assert _text(page[:page.index("tail")]).endswith("a b\nc")


def test_malformed_and_odd_pages():
    assert _text("") == "" and _text("plain &amp text <3") == "plain & text <3"
    assert _text("<p>a<p>b</b></div>c") == "a\nbc"
    assert _text("<article><script>never closed") == ""
    assert _text("<article>x<p class=\"a>b\">y</article>z") == "x\ny"
    assert _text("<div>" * 20_000 + "deep") == "deep"
    assert _text("<main>m</main><p>other</p>") == "m"
    assert _text("<ARTICLE><SCRIPT>x</SCRIPT>İy</ARTICLE>") == "İy"
    assert _text("<article><header><h1>t</h1>by me</header>body</article>") == "t\nbody"
    assert _text("<header>site</header><p>body</p>") == "body"


def _site(spark):
    rows = []
    for i in range(12):  # no mark says that the boxes are template; the article is not named
        rows.append((i, f"http://a.example/{i}", f"<body><div><span>Home</span> About us</div><div><p>Own text {i}</p>"
                     f"<p>Second {i}</p></div><div>Follow us everywhere</div></body>"))
        rows.append((100 + i, f"http://u@B.example:80/{i}", "<body><div>Same page</div></body>"))
        rows.append((200 + i, f"http://c.example/{i}", f"<p>menu {i}</p><article><p>quoted by all</p>"
                     f"<div>box in the article</div></article>"))
    return [*rows, (300, None, None), (301, None, ""), (302, "no url", "<div>Home About us</div>"), rows[0],
            (None, "http://a.example/x", rows[0][2])]


def test_template_is_what_recurs_on_different_pages_of_a_host(spark):
    pages = spark.createDataFrame([(*r, "z", "z") for r in _site(spark)],
                                  "page_id long, url string, html string, text string, host string")
    out = H.extract_main_text(pages)
    assert out.columns == ["page_id", "url", "html", "host", "text", "n_template"]
    got = [(r["page_id"], r["text"], r["n_template"]) for r in out.collect()]
    assert len(got) == len(_site(spark))
    for i in range(12):
        assert (i, f"Own text {i}\nSecond {i}", 2) in got
        assert (100 + i, "Same page", 0) in got
        assert (200 + i, "quoted by all\nbox in the article", 0) in got
    assert {(300, "", 0), (301, "", 0), (302, "Home About us", 0), (None, "Own text 0\nSecond 0", 2)} <= set(got)
    assert got.count((0, "Own text 0\nSecond 0", 2)) == 2
    assert H.extract_main_text(pages.limit(0)).count() == 0


def test_query_on_all_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in H.op1_html_extraction(spark, sf).collect()}
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]] == (r["url"], text, len(text))


def test_only_recurrence_tells_a_box_inside_the_article(spark):
    rows = [(i, f"http://d.example/{i}",
             f"<body><article><h1>Head {i}</h1><div class='x'><p>Get our letter</p></div><p>Own {i}</p><p>quoted</p>"
             f"<div><p>Body {i}</p></div>{'<ul><li>rare list</li></ul>' if i < 3 else ''}"
             "<section>Read more here</section></article></body>") for i in range(20)]
    out = H.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    for r in out.collect():
        i = r["page_id"]
        rare = "\nrare list" if i < 3 else ""
        assert (r["text"], r["n_template"]) == (f"Head {i}\nOwn {i}\nquoted\nBody {i}{rare}", 2)


ARTICLE = "<h1>Head</h1><p>Some words of the article.</p><h2 id=\"social-impact\">Impact</h2><p id=\"notice-1\">Noted.</p>"
WANTED = "Head\nSome words of the article.\nImpact\nNoted."


def test_a_word_in_a_class_empties_no_page(spark):
    shells = ["<body class='home right-sidebar'>{}</body>", "<article class='post share-enabled'>{}</article>",
              "<div class='content no-sidebar'>{}</div>", "<html class='cookie-consent'><body>{}</body></html>",
              "<html class='sidebar'><body class='ad'><main>{}</main></body></html>",
              "<div class='share'><article>{}</article></div>", "<form id='f'><article>{}</article></form>",
              "<div id='header-page'><div class='with-header'>{}</div></div>", "<body style='display:none'>{}</body>",
              "<div class='has-header'><article>{}</article><div class='comments'><article class='comment'>"
              "a very long reader comment, longer than everything else on the page together</article></div></div>",
              "<article class='widget'>{}</article>", "<article>{}</article><article class='promo'>Buy</article>"]
    for shell in shells:
        for box in ("", "<div class='ad'>Buy</div>", "<div class='post-comments'>hm</div><div id='cookieNotice'>c</div>"):
            assert _text(shell.format(ARTICLE + box)) == WANTED, shell
    rows = [(i, f"http://e.example/{i}", shells[i % 12].format(ARTICLE.replace("Some", f"Some {i}"))) for i in range(24)]
    out = H.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), many=25)
    assert {(r["page_id"], r["text"]) for r in out.collect()} == {
        (i, WANTED.replace("Some", f"Some {i}")) for i in range(24)}


def test_recurrence_against_brute_force(spark):
    """A site of boxes that carry no mark: a box goes where at least 3 different pages and
    2 % of the host's pages have it."""
    import random

    rng = random.Random(6)
    pool = [f"box {k}" for k in range(40)]
    pages = []
    for i in range(160):
        host = f"h{i % 3}.example"
        boxes = [f"own {i}", *rng.sample(pool, 4)] if i % 7 else ["own 1", "box 1"]  # some pages are copies
        rng.shuffle(boxes) if i % 7 else None
        pages.append((i, f"http://{host}/{i}", "<body>" + "".join(f"<div>{b}</div>" for b in boxes) + "</body>", boxes, host))
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(
        spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")).collect()}
    for host in {p[4] for p in pages}:
        different = {tuple(p[3]) for p in pages if p[4] == host}
        counts = {b: sum(b in d for d in different) for d in different for b in d}
        for i, _, _, boxes, _ in (p for p in pages if p[4] == host):
            left = [b for b in boxes if not (counts[b] >= 3 and counts[b] >= 0.02 * len(different))]
            assert got[i] == "\n".join(left)


def test_container_rule_with_odd_rows(spark):
    rows = [(i, "http://f.example/", f"<article><h1>H {i}</h1><div class='x'>letter</div></article>") for i in range(4)]
    rows += [rows[0], (None, "http://f.example/", rows[1][2]), (9, "http://f.example/", None), (10, None, "")]
    out = H.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(((r["page_id"] or -1, r["text"], r["n_template"]) for r in out.collect()))
    assert got == [(-1, "H 0", 1), (-1, "H 0", 1), (-1, "H 1", 1), (1, "H 1", 1), (2, "H 2", 1), (3, "H 3", 1),
                   (9, "", 0), (10, "", 0)]
