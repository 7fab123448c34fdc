"""Main text of literal pages, and of the whole table against its markup."""

import html
import re

from quarry.llm.html_text import extract, main_text
from quarry.llm.queries import REGISTRY

from odd import PROSE, SF


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>No</title>{head}</head><body>{body}</body></html>"


def test_article_without_furniture():
    body = (f"<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><article><h1>Headline</h1><p>{PROSE}</p>"
            f"<div class='ad'>{PROSE}</div><p>Short end.</p><script>var t='</p>';</script><aside>{PROSE}</aside>"
            f"<form><label>Name</label></form><section class='comments'><article><p>{PROSE}</p></article></section></article>"
            f"<div id='sidebar'>{PROSE}</div><footer>&copy; {PROSE}</footer>")
    assert main_text(page(body, "<style>p{}</style>")) == f"Headline {PROSE} Short end."


def test_rules_without_an_article_element():
    body = (f"<div class='cookie-notice'>{PROSE}</div><div><h2>Short head</h2><p>{PROSE}</p><p>Tiny.</p></div>"
            "<ul><li><a href=1>One link</a></li><li><a href=2>Two link</a></li></ul><p>&copy; 2020 The site</p>")
    assert main_text(page(body)) == f"Short head {PROSE} Tiny."


def test_references_white_space_and_inline_markup():
    assert main_text("<article><p>a&amp;b &lt;i&gt; &#233;&#x4e2d;&nbsp; x<b>y</b>z<br>q</p>\n\n<p> r\t s </p></article>") == "a&b <i> é中 xyz q r s"


def test_broken_markup():
    assert main_text(f"<article><p><b>{PROSE}<br><p>Next &am") == f"{PROSE} Next &am"
    assert main_text(f"<article><p>{PROSE}</article><footer>x <a hr") == PROSE
    assert main_text(f"<article><p>{PROSE} 1 < 2</p></artic") == f"{PROSE} 1 < 2"
    assert main_text(f"<div data-x='a>b\"'>{PROSE}</div><!-- never closed {PROSE}") == PROSE
    assert main_text("") == main_text("<html><body><nav>x</nav></body></html>") == ""
    many = "<div>" * 3000 + PROSE + "</div>" * 3000
    assert main_text(many) == PROSE


def test_odd_tables(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars int"
    long = "<article>" + f"<p>{PROSE}</p>" * 4000 + "</article>"
    rows = [(1, "u", None, "x", 1), (None, None, "", None, None), (2, "u", long, "", 1), (2, "u", long, "", 1)]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert [(r.page_id, r.text) for r in got[:2]] == [(1, ""), (None, "")]
    assert got[2] == got[3] and got[2].text == " ".join([PROSE] * 4000)
    assert extract(spark.createDataFrame([], schema)).count() == 0


def test_whole_table(spark):
    got = {r.page_id: r for r in REGISTRY["op1_html_extraction"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:  # these pages hold nothing but the article between its tags
        inner = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:h1|p|b|br)>", " ", inner)).split())
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want) and got[p.page_id].url == p.url


def test_a_name_drops_no_whole_article():
    for start in ("<article class='post comments-open'>", "<main class='has-comments'>", "<article id=comments>", "<div class='layout no-sidebar'>",
                  "<div class='with-nav'>", "<div id='header-fixed'>", "<form action=/>", "<div class='sidebar'>", "<div class='widget'><article>"):
        body = f"{start}<h1>Headline</h1><p>{PROSE}</p><div class='ad'>{PROSE}</div><div class='comments-area'><p>{PROSE}</p></div><p>{PROSE}</p>"
        assert main_text(page(body)) == f"Headline {PROSE} {PROSE}", start
    for name in ("sidebar", "cookie-notice", "nav-wrapper", "ad-2", "social share", "comment-list"):
        assert main_text(page(f"<div><p>{PROSE}</p></div><div class='{name}'><p>{PROSE}</p></div>")) == PROSE, name
    assert main_text(page(f"<article><h1>Only a headline</h1><section class='comments'><article class='comment'>{PROSE}</article></section></article>")) == "Only a headline"


def test_copyright_as_a_subject():
    law = PROSE + " The law of copyright is old, and the sign © is not."
    assert main_text(page(f"<div><p>{PROSE}</p><p>{law}</p><p>Copyright 2020 The site</p></div>")) == f"{PROSE} {law}"


def test_languages_without_listed_stop_words():
    texts = ["Москва является столицей и крупнейшим городом страны, её население превышает тринадцать миллионов человек, а площадь постоянно растёт. ",
             "Warszawa jest stolicą kraju oraz największym miastem, położonym nad Wisłą; mieszka tutaj prawie dwa miliony ludzi różnych zawodów. ",
             "القاهرة هي عاصمة البلاد وأكبر مدنها من حيث عدد السكان والمساحة وتقع على ضفاف النهر في شمال البلاد وفيها جامعات كثيرة قديمة. ",
             "दिल्ली देश की राजधानी है और यहाँ बहुत सारे लोग रहते हैं जो अलग अलग भाषाएँ बोलते हैं और कई तरह के काम करते हैं। ",
             "北京是中华人民共和国的首都，全国政治中心、文化中心、国际交往中心和科技创新中心，也是历史文化名城和古都之一，城市人口超过两千万，每年有许多游客来到这里参观长城和故宫以及其他名胜古迹。"]
    for text in texts:
        long, near = (text * 3).strip(), text.strip()
        links = "<p>" + "".join(f"<a href={i}>{near}</a> " for i in range(4)) + "</p>"
        body = f"<div><h2>1957</h2><p>{long}</p><p>{near}</p>{links}<p>© 2020</p></div>"
        assert main_text(page(body)) == f"1957 {long} {near}"
    body = f"<div><p>{PROSE}</p><p>{(texts[0] * 3).strip()}</p><p>{'tyre rim spoke hub axle brake ' * 20}</p><p>{PROSE}</p></div>"
    assert main_text(page(body)) == f"{PROSE} {(texts[0] * 3).strip()} {PROSE}"
    assert main_text(page(f"<div><p>{PROSE}</p><p>{'- 12 - ' * 60}</p></div>")) == PROSE


def test_furniture_within_a_paragraph():
    for inner in ("<button>Subscribe</button>", "<label>Name <span>x</span></label>", "<noscript>Turn it on</noscript>", "<svg><text>Icon</text></svg>",
                  "<span class='ad'>Buy <b>now</b></span>", "<a class='share' href=/>Share</a>", "<span hidden>Unseen</span>",
                  "<i style='display: none'>Unseen</i>", "<amp-ad>Buy</amp-ad>", "<object><p>Old</p> player</object>", "<span class='ad'><div>Buy</div> now</span>",
                  "<template>None</template>", "<canvas>None</canvas>", "<video>No <a href=/>video</a></video>", "<span class=comments>2 replies</span>"):
        for start, end in (("<article>", "</article>"), ("<div>", "</div>")):
            body = f"{start}<p>{PROSE} {inner} {PROSE}</p><p>Short end {inner}</p><p>{PROSE}</p>{end}"
            assert main_text(page(body)) == f"{PROSE} {PROSE} Short end {PROSE}", (inner, start)
    assert main_text(page(f"<my-page class='sidebar'>{PROSE}<button>Go</button></my-page>")) == PROSE


def test_a_second_article_is_weighed_by_its_names():
    for other in ("<article class='comment'>", "<article class='teaser related'>", "<div class='comment-thread'>", "<div class='user-reviews'>", "<div class='discussion'>",
                  "<div class='ad-slot-2'>", "<div class='sponsored-content'>", "<div class='gdpr-overlay'>", "<div class='left-sidebar'>"):
        close = "</article>" if "article" in other else "</div>"
        for start, end in (("<article>", "</article>"), ("<div>", "</div>"), ("<main><article class='post'>", "</article></main>")):
            main = f"{start}<h1>Headline</h1><p>{PROSE}</p><p>{PROSE}</p>{end}"
            side = f"{other}<p>{PROSE} Not this.</p>{close}"
            want = f"Headline {PROSE} {PROSE}"
            assert main_text(page(main + side)) == want, (start, other)
            if "article" not in other or start != "<div>":
                assert main_text(page(side + main)) == want, (start, other)
    assert main_text(page(f"<article class='post'><p>{PROSE}</p></article><article class='post'><p>{PROSE}</p></article>")) == f"{PROSE} {PROSE}"


def test_cookie_line_and_links_in_the_text():
    assert main_text(page(f"<p>We use cookies to improve this site.</p><div><h2>Head line</h2><p>{PROSE}</p><p>{PROSE}</p></div>")) == f"Head line {PROSE} {PROSE}"
    linked = "<p><a href=/>A paragraph that is mostly one link</a> indeed</p>"
    menu = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
    item = "<ul><li>First thing said</li><li><a href=/>Second thing said</a></li><li>Third thing said</li></ul>"
    got = main_text(page(f"<article><p>{PROSE}</p>{linked}<p>{PROSE}</p>{menu}<p>{PROSE}</p>{item}<p>{PROSE}</p></article>"))
    assert got == f"{PROSE} A paragraph that is mostly one link indeed {PROSE} {PROSE} First thing said Second thing said Third thing said {PROSE}"


def test_unbalanced_pages_take_linear_time():
    import time

    began = time.time()
    assert main_text("<div>" * 2000 + PROSE + "</p>" * 20_000) == PROSE
    assert main_text("<b>" * 20_000 + f"<p>{PROSE}" * 3) == " ".join([PROSE] * 3)
    main_text("<p>" + "<i>" * 3000 + "<p>x" * 3000 + "<a>" * 3000 + "</a>" * 5000)
    assert time.time() - began < 2
    deep = "<b><i><u><em><strong><font><span><a>" * 3
    assert main_text(f"<article><p>{deep}{PROSE}<p>{PROSE}</article>").startswith(PROSE)
