"""Main text of pages of known content."""

import json
import random

from procurelytics.llm import wrapper

SCHEMA = "page_id long, url string, html string, text string"


def extract(spark, rows):
    df = wrapper.extract(spark.createDataFrame(rows, SCHEMA))
    assert df.columns == ["page_id", "url", "html", "text"]
    return {r["page_id"]: r["text"] for r in df.collect()}


def test_template_with_article(spark):
    rng, rows, want = random.Random(1), [], {}
    for i in range(40):
        ps = ["word%d &lt;x&gt; &#233;" % rng.randint(0, 99) for _ in range(rng.randint(1, 9))]
        body = "".join(rng.choice(["<p>%s</p>", "<p><b>%s<br>"]) % p for p in ps)
        rows.append((i, "http://a.example/%d" % i, f"""<!doctype html><head><title>t</title><script>var a="</p><article>";</script></head><body class="has-sidebar">
<nav><ul><li><a href=x>m</a></ul></nav><div class='cookie-notice'>We use</div><article><h1>T{i}</h1>{body}<aside>see</aside><div class="ad">buy</div>
<form>f</form></article><section id="comments"><p>first!</p></section><footer>&copy;</footer>""", "own"))
        want[i] = " ".join([f"T{i}", *(p.replace("&lt;", "<").replace("&gt;", ">").replace("&#233;", "é") for p in ps)])
    assert extract(spark, rows) == want


def test_container_is_learned_where_no_tag_names_it(spark):
    rows = [(i, "//b.example", f"<body><div id=top>Menu <a>x</a></div><div class='c'><div class='post-{i}'><p>Long text number {i} with <i>in</i>line words and\n\n more of it</p><p>End.</p></div></div><div class=x>tail</div>", "") for i in range(9)]
    assert extract(spark, rows)[4] == "Long text number 4 with inline words and more of it End."


def test_odd_pages(spark):
    rows = [(1, None, None, ""), (2, "u", "", ""), (3, "", "<p>a<p>b", ""), (3, "", "<p>a<p>b", ""), (4, "//c", "no tags &amp; <", ""), (None, "//c", "<article>x <", None), (5, "//d", "<div>" * 3000 + "deep", ""), (6, "//e", "<main>" + "<p>x</p>" * 20000, "")]
    got = extract(spark, rows)
    assert got[1] == got[2] == "" and got[3] == "a b" and got[None] == "x <" and got[5] == "deep" and got[6] == " ".join(["x"] * 20000)
    assert wrapper.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_wrapper_stays_small_and_covers_both():
    a, b = wrapper.fold("body h1 # /h1 p # /p p # /p p # /p /body".split()), wrapper.fold("body h1 # /h1 div # /div p # /p /body".split())
    w = wrapper.align(a, b)
    assert w == ["body", "h1", "#", "/h1", ["?", "div", "#", "/div"], ["+", "p", "#", "/p"], "/body"] and wrapper.align(w, a) == w and wrapper.align(w, b) == w
    rng, one = random.Random(2), None
    for _ in range(300):
        page = wrapper.fold(["h1", "#", "/h1", *(t for _ in range(rng.randint(1, 30)) for t in rng.choice([["p", "#", "/p"], ["p", "b", "#", "br"], ["ul", "li", "#", "/li", "/ul"]]))])
        one = page if one is None else wrapper.align(one, page)
    assert len(json.dumps(one)) < 60_000


def test_alignment_leaves_nothing_out():
    one = None
    for k in range(3):
        page = wrapper.fold(["body", *(x for i in range(300) for x in (f"div.{'abc'[k]}{i}", "#", "/div")), "article", "#", "/article"][: None if k == 1 else 901])
        one = page if one is None else wrapper.align(one, page)
    labels = set(wrapper._leaves(one))
    assert {f"div.{c}{i}" for c in "abc" for i in range(300)} | {"article"} <= labels


def test_one_page_with_article_leaves_the_others_their_container(spark):
    plain = "<body><div id=top>Menu of all</div><div class='c'><p>Long text number {0} that goes on and on for a while</p><p>End {0}.</p></div><div class=x>tail</div>"
    rows = [(i, "//b.example", plain.format(i), "") for i in range(9)]
    odd = [(20, "//b.example", "<body><div id=top>Menu of all</div><article><p>Only one</p></article>", ""), (21, "//b.example", "<body><div id=top>Menu of all</div><main><p>Only main</p></main>", "")]
    got = extract(spark, rows + odd)
    assert got[4] == "Long text number 4 that goes on and on for a while End 4." and got[20] == "Only one" and got[21] == "Only main"


def test_texts_of_the_template_inside_the_article_are_left_out(spark):
    rng, rows, want = random.Random(4), [], {}
    for i in range(60):
        ps = [f"Words {i} {k} {rng.random()}" for k in range(rng.randint(1, 6))]
        body = "".join(rng.choice(["<p>%s</p>", "<p><b>%s<br>"]) % p for p in ps)
        more = "<ul><li>Point</li></ul>" if i % 2 else ""
        rows.append((i, "//t.example", f"<body><nav>n</nav><article><div class=share>Share this <b>page</b></div><h1>T{i}</h1>{body}{more}<p class=sign>Sign up!</p></article></body>", ""))
        want[i] = " ".join([f"T{i}", *ps, *(["Point"] if more else [])])
    plain = [(100 + i, "//t.example", f"<body><article><p>Share this</p><p>Own {i}</p></article></body>", "") for i in range(1)]
    copies = [(200 + i, "//copies.example", f"<body><i>{i}</i><article><p>Same text</p><p>on all pages</p></article></body>", "") for i in range(30)]
    got = extract(spark, rows)
    assert {k: got[k] for k in want} == want
    assert set(extract(spark, copies).values()) == {"Same text on all pages"}
    assert extract(spark, plain)[100] == "Share this Own 0"


def test_every_page_matches_its_wrapper():
    rng, pages = random.Random(5), []
    parts = [["p", "#", "/p"], ["p", "b", "#", "br"], ["ul", "li", "#", "/li", "/ul"], ["div.x", "img", "/div"], ["table", "tr", "td", "#", "td", "#", "/table"]]
    for i in range(150):
        body = [t if t != "#" else f"#{rng.randint(0, 9)}" for _ in range(rng.randint(0, 30)) for t in rng.choice(parts)]
        pages.append(["body", "h1", f"#{i}", "/h1", "div.share", "#share", "/div", *body, "/body"])
    one = None
    for page in pages:
        one = wrapper.fold(page) if one is None else wrapper.align(one, wrapper.fold(page))
    program = wrapper.Program(one)
    assert program.constants == {"#share"} and all(program.shared(page) == {5} for page in pages)
