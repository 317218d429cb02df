from postsieve.llm import dom, html

SCHEMA = "page_id long, url string, html string"


def extract(spark, rows):
    return {r["page_id"]: r for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def framed(body, n):
    return (
        f"<html><head><title>t{n}</title><script>var a='<p>x</p>';</script></head><body>"
        f"<div class='top'>Same on all pages</div><nav><a href=/>menu {n}</a></nav>"
        f"<div class=text>{body}</div><div id='comments-2'><p>I disagree {n}</p></div>"
        f"<footer>&copy; host</footer></body></html>"
    )


def test_constant_nodes_become_template(spark):
    rows = [(n, "https://User@Host.example:80/a", framed(f"<p>Story {n} tells.</p><p>More  of\n{n}.</p>", n)) for n in range(6)]
    found = extract(spark, rows)
    for n in range(6):
        assert found[n]["text"] == f"Story {n} tells.\nMore of {n}."
        assert found[n]["n_chars"] == len(found[n]["text"])


def test_article_marks_win(spark):
    page = (
        "<body><header>Site</header><form><main><article><header><h1>Head &amp; tail</h1></header>"
        "<p>One<br>two <span class='ad-box'>Buy!</span>three<ul><li>a<li>b</ul>"
        "<aside>Beside</aside><div class=share>Share</div></article></main></form>"
    )
    assert extract(spark, [(1, "u", page)])[1]["text"] == "Head & tail\nOne two\nthree\na\nb"


def test_constant_nodes_go_inside_the_article_too(spark):
    page = (
        "<body><article><p>Story {n} tells.</p><div class=box>Write to us every day</div><blockquote>Quote {n}</blockquote>"
        "<div class=talk><article class='comment'><p>I disagree {n}</p></article></div>"
        "<div class=comments><article><p>Me too {n}</p></article></div></article></body>"
    )
    found = extract(spark, [(n, "http://a.example/", page.format(n=n)) for n in range(6)])
    for n in range(6):
        assert found[n]["text"] == f"Story {n} tells.\nQuote {n}"


def test_marks_choose_among_varying_slots(spark):
    page = "<body><article><p>Write to us every day</p></article><div class=text><p>Story {n} tells.</p></div></body>"
    found = extract(spark, [(n, "http://a.example/", page.format(n=n)) for n in range(6)])
    assert [found[n]["text"] for n in range(6)] == [f"Story {n} tells." for n in range(6)]


def test_dropped_words_and_ranks():
    def texts(page):
        root, blocks = dom.parse(page)
        keep = dom.kept(root, set())
        return [t for n, t in blocks if keep[n]]

    # The only article stays whatever its class holds; a comment does not replace what it is in.
    assert texts("<main><article class='post tag-social'><p>a</p></article></main>") == ["a"]
    assert texts("<div class='has-sidebar'><article><p>a</p></article></div>") == ["a"]
    assert texts("<article class='has-sidebar'><p>a</p><article class='comment'>b</article></article>") == ["a"]
    assert texts("<main><p>a</p><article class='comment-7'>b</article></main>") == ["a"]
    assert texts("<article><p>a</p></article><article class=comment>b</article>") == ["a"]


def test_copies_under_changing_adverts_stay(spark):
    page = (
        "<body><div class=top>Same on all pages</div><div class=box>Buy {kind} now</div>"
        "<h1>Head {a}</h1><div class=text><p>Story {a} tells what happened in town number {a}.</p></div>"
        "<div class=foot><div>Call {phone} from Monday to Friday, all offices are open then {phone}</div></div></body>"
    )
    # 20 articles in 6 copies each; adverts differ from copy to copy, footers go through two variants.
    rows = [
        (10 * a + c, "http://a.example/", page.format(a=a, kind=f"{a} of {c}" if c else "socks", phone=c % 2))
        for a in range(20)
        for c in range(6)
    ]
    found = extract(spark, rows)
    assert len(found) == 120
    for number, row in found.items():
        a = number // 10
        assert row["text"].endswith(f"Head {a}\nStory {a} tells what happened in town number {a}.")
        assert "Same on all pages" not in row["text"] and "Monday" not in row["text"]


def test_three_copies_of_one_article_stay(spark):
    page = "<body><div class=box>Buy {n} now</div><div class=text><p>One story for all three pages.</p></div></body>"
    found = extract(spark, [(n, "http://a.example/", page.format(n=n)) for n in range(3)])
    assert all("One story for all three pages." in row["text"] for row in found.values())


def test_broken_and_odd_pages(spark):
    rows = [
        (1, None, None),
        (2, "", ""),
        (3, "http://a.example/", "<article><p><b>Title.<br><p>Text &quot;x&quot; &am"),
        (4, "http://a.example/", "no markup at all"),
        (5, "http://a.example/", "<p title=\"a>b\">kept</p><!-- <p>gone</p>"),
        (5, "http://a.example/", "<p title=\"a>b\">kept</p><!-- <p>gone</p>"),
        (None, "http://a.example/", "<p>" + "long " * 50000),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS text", "1 AS host")
    found = sorted(((r["page_id"] or 0), r["text"]) for r in html.extract(frame).collect())
    assert found == [
        (0, ("long " * 50000).strip()),
        (1, ""),
        (2, ""),
        (3, 'Title.\nText "x" &am'),
        (4, "no markup at all"),
        (5, "kept"),
        (5, "kept"),
    ]


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_match(a, b):
    """Nodes in a largest matching, by trying every way."""
    if a.label != b.label:
        return 0

    def lists(x, y):
        if not x or not y:
            return 0
        return max(lists(x[1:], y), lists(x, y[1:]), brute_match(x[0], y[0]) + lists(x[1:], y[1:]))

    return 1 + lists(a.children, b.children)


def test_tree_matching_against_every_way():
    trees = ["r(a(b()c())d())", "r(d()a(c()b()c()))", "r(a(b()c()))", "r(x(a(b())))", "r()"]
    for one in trees:
        for two in trees:
            a, b = dom.read(one), dom.read(two)
            assert len(dom.matches(a, b)) == brute_match(a, b)
            merged = dom.merge(dom.read(one), dom.read(two))
            for part in (one, two):
                page = dom.read(part)
                assert len(dom.matches(merged, page)) == len(dom.order(page))


def test_deep_nesting():
    one, _ = dom.parse("<div>" * 3000 + "<p>a</p>")
    two, _ = dom.parse("<div>" * 2500 + "<ul><li>b</ul>")
    assert len(dom.matches(dom.read(dom.write(one)), dom.read(dom.write(two)))) == 2501
    assert len(dom.order(dom.merge(one, two))) == 3004


def test_skeleton_text_round_trip():
    root, _ = dom.parse("<body><ul><li>a<li>b</ul><p>c</p><p>d</p></body>")
    assert dom.write(root) == "(body(ul(li())p()))"
    assert dom.write(dom.read(dom.write(root))) == dom.write(root)


COMMENTS = [
    "<div id='comments'><article class='comment-body'>{c}</article></div>",
    "<section class='comments'><article class='comment'>{c}</article></section>",
    "<div class='comment-list'><article>{c}</article><article>{c}</article></div>",
    "<ol class='commentlist'><li class='comment'><article><p>{c}</p></article></li></ol>",
]
FRAMES = ["<main>{a}{c}</main>", "<div class='content'>{a}{c}</div>", "<article>{a}{c}</article>", "<main>{a}</main>{c}"]


def test_the_article_and_not_its_comments(spark):
    """Hosts of every frame and kind of comment, from known articles."""
    pages, want = [], {}
    for host, (frame, comment) in enumerate((f, c) for f in FRAMES for c in COMMENTS):
        for n in range(4):
            number = 10 * host + n
            blocks = [f"Title {number} of host {host}", *[f"Paragraph {k} of {number} tells {k * number + 7} things." for k in range(n + 2)]]
            article = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
            said = comment.format(c=f"Reader {number} says {number * 31} much longer words than the article has, over and over again.")
            body = frame.format(a=article, c=said)
            pages.append((number, f"http://h{host}.example/{n}", f"<html><body><nav>Home</nav>{body}<footer>End</footer></body></html>"))
            want[number] = "\n".join(blocks)
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(table).select("page_id", "text").collect()}
    assert got == want


def test_parts_of_class_words_drop_nothing_of_an_article(spark):
    def page(n):
        return f"""<body><nav>menu {n}</nav><article><h1>Title {n}</h1>
            <section class='side-effects'><p>Effects of {n}.</p></section><div class='header-note'>Note {n}.</div>
            <div class='related-work'>Work {n}.</div><p class='sharing-economy'>Economy {n}.</p><div id='menu-of-the-day'>Soup {n}.</div>
            <p>We <span class='share'>share {n}</span> and <a class='ad-link' href='x'>link {n}</a> here.</p>
            <div class='share'>Tell others {n}</div><aside>Aside {n}</aside></article></body>"""

    table = spark.createDataFrame([(n, f"http://a.example/{n}", page(n)) for n in range(5)], "page_id long, url string, html string")
    for r in html.extract(table).collect():
        n = r.page_id
        assert r.text.split("\n") == [
            f"Title {n}", f"Effects of {n}.", f"Note {n}.", f"Work {n}.", f"Economy {n}.", f"Soup {n}.", f"We share {n} and link {n} here.",
        ]
