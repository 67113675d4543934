"""Main text and URL rules on small fixtures."""

from itertools import combinations, product

from fairwait.llm import html_text, url_filter
from fairwait.llm.queries import URL_RULES

PAGES = "page_id bigint, url string, html string, text int, host string, rule string"


def page(article, host="a.example.org", path="/1", extra=""):
    html = (
        '<!DOCTYPE html><html><head><title>Title here</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body>'
        '<nav><ul><li><a href="/x">Menu entry</a></li></ul></nav><div class="ad">Buy this thing now</div>'
        f"{article}{extra}<footer>&copy; somebody</footer></body></html>"
    )
    return (f"http://{host}{path}", html)


def run(spark, pages):
    rows = [(i, u, h, 1, "x", "y") for i, (u, h) in enumerate(pages)]
    got = html_text.extract(spark.createDataFrame(rows, PAGES).repartition(3), out="text")
    assert got.columns == ["page_id", "url", "host", "rule", "text"]
    return {r["page_id"]: r["text"] for r in got.collect()}


def test_blocks_of_the_article(spark):
    body = (
        "<article><h1>Head &amp; more</h1><p>First  <b>bold</b>ness\n of&nbsp;words and words and words.</p><p>Unclosed <i>one<p>Second &eacute;&#233; par<wbr>agraph<br>here</p>"
        "<ul><li>item one<li>item two</ul><aside>Sidebar note</aside><div class='share-buttons'>Share it</div><form>Name <input></form>"
        "<!-- hidden words --><section id=comments><p>I disagree with all of this, said a reader.</p></section></article>"
    )
    expected = "Head & more\nFirst boldness of words and words and words.\nUnclosed one\nSecond éé paragraph here\nitem one\nitem two"
    cut = page(body)[1]
    pages = [page(body), page(body, path="/2"), ("http://a.example.org/3", cut[: cut.index("<footer>")]), (None, cut), ("no host", cut)]
    got = run(spark, pages)
    assert set(got.values()) == {expected} and len(got) == 5


def test_odd_pages(spark):
    text = "<article><p>" + "many words here " * 30_000 + "</p></article>"
    pages = [("http://a/1", None), ("http://a/2", ""), ("http://a/3", "<nav>only a menu</nav>"), ("http://a/4", "plain text < no markup"),
             page(text), ("http://b/1", "<p class='x"), ("http://b/2", "<div><p>a</p></div></span></div></div><p>b b b b"), ("http://b/2", "<div><p>a</p></div></span></div></div><p>b b b b")]
    got = run(spark, pages)
    assert [got[i] for i in (0, 1, 2, 5)] == [""] * 4
    assert got[3] == "plain text < no markup" and got[4] == ("many words here " * 30_000).strip()
    assert got[6] == got[7] != ""
    assert html_text.extract(spark.createDataFrame([], PAGES), out="text").count() == 0


def test_the_host_agrees_on_a_path(spark):
    usual = "<div class='story7'><p>{}</p></div><div class='teasers'><p>{}</p></div>"
    pages = [page(usual.format("the story " * 40, "other stories")) for _ in range(20)]
    # Here the teasers are longer than the story, but the host's path is known.
    pages.append(page(usual.format("a short story", "other stories in many more words " * 30).replace("story7", "story12")))
    # None of the host's paths: the page chooses on its own.
    pages.append(page("<main><p>An odd page of its own, with its own place for text.</p></main>"))
    got = run(spark, pages)
    assert got[20] == "a short story" and got[21] == "An odd page of its own, with its own place for text."


def test_nothing_of_a_wrapped_or_split_article_goes(spark):
    long, less = "long words of it " * 40, "some more of the words " * 20
    l, s = long.strip(), less.strip()
    cases = [
        (f"<article><h1>T</h1><div class=entry><p>{long}</p></div></article>", f"T\n{l}"),
        (f"<main><h1>T</h1><p>Lead</p><section><p>{long}</p></section><section class=x><p>{less}</p></section></main>", f"T\nLead\n{l}\n{s}"),
        (f"<div class=text><div class=part1><p>{long}</p></div><div class=part2><p>{less}</p></div></div>", f"{l}\n{s}"),
        (f"<div class=post><h2>T <b>2</b></h2><div class=entry><p>{long}</p></div></div>", f"T 2\n{l}"),
        (f"<article><p>{long}</p></article><article><p>{less}</p></article>", f"{l}\n{s}"),
        (f"<main><div class=entry><p>{long}</p></div><div class=more><a href=x>{less}</a></div></main>", l),
    ]
    # Every layout is the usual one of a host, and stands on a page of its own without one.
    pages = [page(html, host=f"h{i}.example.org", path=f"/{k}") for i, (html, _) in enumerate(cases) for k in range(3)]
    pages += [page("<div class=odd><p>Words of a page with another layout.</p></div>", host=f"h{i}.example.org", path="/odd") for i in range(6)]
    got = run(spark, pages)
    assert [got[i] for i in range(18)] == [text for _, text in cases for _ in range(3)]
    assert [html_text.read(page(html)[1], []) for html, _ in cases] == [text for _, text in cases]


WORDS = "stone river lamp paper cloud green seven walk maple wind " * 6
BODY = f"<h1>Head</h1><p>{WORDS}</p><p>And more of it.</p>"
BODY_TEXT = f"Head\n{WORDS.strip()}\nAnd more of it."
ARTICLE = f"<article>{BODY}</article>"
TALK = "<section id=comments><p>I say no.</p><div class=reply><p>" + "I say yes, and yes again. " * 60 + "</p></div></section>"


def test_names_of_layouts_lose_nothing():
    wrapped = [
        "<div class='content overflow-hidden'>{}</div>", "<div id=page class='site has-sidebar'>{}</div>", "<div class=no-sidebar>{}</div>",
        "<div class=main-side>{}</div>", "<form method=post action=x>{}</form>", "<div class='search-page'><div class='w-1/2 header-fixed'>{}</div></div>",
        "<div class=sidebar-layout><div class='widget'>{}</div><div class=sidebar><article><p>A teaser</p></article></div></div>",
    ]
    for outer in wrapped:
        for inner in (ARTICLE, f"<main>{BODY}</main>", f"<div>{BODY}</div>"):
            html = page(outer.format(inner + TALK))[1]
            path = html_text.vote(html)
            assert html_text.read(html, []) == html_text.read(html, [path]) == BODY_TEXT, (outer, inner)
    # Related work is a part of the article where it is prose, and not where it is links.
    prose = "<section id=related><h2>Related</h2><p>Others wrote of it too.</p></section>"
    links = "<section id=related><h2>See</h2><p><a href=x>Others wrote of it too.</a></p></section>"
    assert html_text.read(f"<article>{BODY}{prose}</article>", []) == f"{BODY_TEXT}\nRelated\nOthers wrote of it too."
    assert html_text.read(f"<article>{BODY}{links}</article>", []) == BODY_TEXT


def test_furniture_stays_out():
    notes = ["<div class=ad-slot><p>Buy</p></div>", "<div class='cookie-notice'><h1>We use cookies</h1></div>", "<form><p>Your name</p><input></form>",
             "<div id=sidebar><p>Side</p></div>", "<p class=hidden>Not seen</p>", "<div class='related'><p>Others</p></div>", "<div role=search>Find</div>", TALK]
    for note in notes:
        for html in (f"<article>{BODY}{note}</article>", f"{note}<div class=has-sidebar>{ARTICLE}</div>", f"<main>{BODY}</main>{note}"):
            assert html_text.read(f"<html><body>{html}</body></html>", []) == BODY_TEXT, html
        assert html_text.read(f"<nav>Menu</nav><article></article>{note}", []) == "", note


def test_deep_pages_take_linear_memory_and_time():
    import time
    import tracemalloc

    def deep(kind, n):
        return f"<body><{kind}>" + f"<{kind} class=x>" * n + f"<article>{BODY}</article>" + "</i>" * n

    def took(html):
        begin = time.perf_counter()
        assert html_text.read(html, [html_text.vote(html)]) == BODY_TEXT
        return time.perf_counter() - begin

    def peak(html):
        tracemalloc.start()
        html_text.vote(html)
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return used

    for kind in ("div", "b", "form"):
        assert peak(deep(kind, 16_000)) < 12 * peak(deep(kind, 2_000)), kind
        assert took(deep(kind, 100_000)) < 30 * max(took(deep(kind, 12_500)), 0.05), kind


def plain_blocks(tree):
    """Text of a generated layout, read from the tree that it was made of and not from its markup."""
    kind, inner = tree
    if kind == "text":
        return [inner]
    return [] if kind == "furniture" else [b for t in inner for b in plain_blocks(t)]


def markup(tree, rng):
    kind, inner = tree
    if kind == "text":
        return rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>"]).format(inner)
    if kind == "furniture":
        return rng.choice(["<nav><a href=x>{}</a></nav>", "<div class='ad'>{}</div>", "<aside>{}</aside>", "<div class=share-buttons>{}</div>", "<div class='newsletter-box'><form>{}</form></div>"]).format(inner)
    return rng.choice(["<div class=c{}>".format(rng.randrange(9)), "<section>", "<div class='w-1/2 overflow-hidden'>", "<div class=has-sidebar>"]) + "".join(markup(t, rng) for t in inner) + "\0"


def closed(html):
    """Ends of the containers, put where the generator left a mark."""
    out, opened = [], []
    import re

    for part in re.split(r"(<div class=c\d>|<section>|<div class='w-1/2 overflow-hidden'>|<div class=has-sidebar>|\0)", html):
        if part == "\0":
            out.append(f"</{opened.pop()}>")
        else:
            if part.startswith(("<div class=c", "<section>", "<div class='w-", "<div class=has")) and part.endswith(">") and part.count("<") == 1:
                opened.append("section" if part == "<section>" else "div")
            out.append(part)
    return "".join(out)


def test_generated_layouts_of_a_host(spark):
    import random

    rng = random.Random(7)

    def tree(depth):
        inner = []
        for _ in range(rng.randint(2, 4)):
            roll = rng.random()
            words = " ".join(rng.choices("one two three four five six seven".split(), k=rng.randint(8, 30)))
            inner.append(("text", words) if roll < 0.6 or depth == 3 else ("furniture", "short words") if roll < 0.8 else tree(depth + 1))
        return ("box", [("text", "every part begins with some words of its own")] + inner)

    pages, expected = [], []
    for template in range(12):
        wrap = ["<article class=t{0}>{{}}</article>", "<main class=t{0}>{{}}</main>", "<div class=site-has-sidebar><article class=k{0}>{{}}</article></div>"][template % 3].format(template)
        for i in range(6):
            made = tree(0)
            pages.append(page(wrap.format(closed(markup(made, rng))), host="many.example.org", path=f"/{template}/{i}"))
            expected.append("\n".join(plain_blocks(made)))
    got = run(spark, pages)
    assert [got[i] for i in range(len(pages))] == expected


URLS = [
    "http://www.example.org/es/1", "https://EXAMPLE.ORG/en/12.html", "http://example.org/en/2", "http://a.example.com/fr/9", "http://a.example.com/de/9?x#y",
    "http://a.example.com/en/9", "http://notorg/x", "http://x.org", "http://x.org?q=/", "no scheme", None, "", "://org/", "http://shop.example.net/es/4",
    "ftp://User@Example.org:80/es/", "http://example.org/en/1", "http://example.org/en/1",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for verdict, rule in URL_RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            best = max(best or ("", ""), (rule, verdict), key=lambda r: len(r[0]))
    return host, path, *(best or (None, None))


def test_rules(spark):
    rows = [(i, u, "h", 1, "clash", "clash") for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    got = {r["page_id"]: r for r in url_filter.judge(df, "url", URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = brute(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    assert url_filter.judge(df.filter("false"), "url", URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(df.filter("page_id IN (9, 10, 11)"), "url", URL_RULES).collect()} == {"allow"}


def test_mined_rules_carry_over(spark):
    urls = [f"http://ads{i % 7}.example.net/banner/{i}" for i in range(60)] + [f"http://news{i % 7}.example.net/story/{i}" for i in range(60)]
    known = [("block", f"ads{k}.example.net/") for k in range(6)] + [("allow", f"news{k}.example.net/") for k in range(6)]
    df = spark.createDataFrame([(i, u, "h", 1, "x", "y") for i, u in enumerate(urls)], PAGES)
    got = {r["url"]: (r["rule"], r["verdict"]) for r in url_filter.judge(df, "url", known).collect()}
    unseen = [u for u in urls if "//ads6" in u or "//news6" in u]
    assert unseen and all(got[u] == (None, "block" if "banner" in u else "allow") for u in unseen)


def test_mining_against_counting(spark):
    data = [(["a", "b"], "block")] * 9 + [(["a", "b"], "allow")] + [(["a"], "allow")] * 10 + [(["c"], "allow")] * 5 + [([], "block"), (["c"], None)]
    df = spark.createDataFrame(data, "tokens array<string>, verdict string")
    rules = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in url_filter.fit(df, "tokens", "verdict", 0.1, 0.85).collect()}
    # {a, b} -> block is implied by {b} -> block.
    assert rules == {(("b",), "block"): 0.9, (("c",), "allow"): 1.0}


def test_tokens_of_equal_rows_are_mined_as_one(spark):
    data = [(["a", "b", "z"], "block")] * 9 + [(["a", "b"], "allow")] + [(["a", "y"], "allow")] * 10 + [(["x", "y"], "block")] * 10
    df = spark.createDataFrame(data, "tokens array<string>, verdict string").repartition(3)
    rows = url_filter.fit(df, "tokens", "verdict", 0.05, 0.85).collect()
    got = {(frozenset(t), r["verdict"]): (round(r["confidence"], 9), round(r["support"], 9)) for r in rows for t in product(*r["members"])}
    # Every antecedent counted, and those dropped that a shorter one implies.
    rules = {}
    for k in range(1, 6):
        for tokens in combinations("abxyz", k):
            inside = [v for t, v in data if set(tokens) <= set(t)]
            for v in ("allow", "block"):
                n = inside.count(v)
                if n >= 0.05 * len(data) and n >= 0.85 * len(inside):
                    rules[frozenset(tokens), v] = (round(n / len(inside), 9), round(n / len(data), 9))
    minimal = {r: c for r, c in rules.items() if not any(rules.get((r[0] - {t}, r[1]), (0,))[0] >= c[0] for t in r[0])}
    assert got == minimal and len(got) > 3


def test_long_constant_paths(spark):
    parts = "/".join(f"part{k}of" + "abcdefghij"[k % 10] for k in range(40))
    urls = [f"http://ads{i % 4}.example.net/{parts}/{i}" for i in range(200)] + [f"http://news{i % 4}.example.net/story/{i}" for i in range(200)]
    known = [("block", f"ads{k}.example.net/") for k in range(3)] + [("allow", f"news{k}.example.net/") for k in range(3)]
    # Only one of the forty parts, and at its place, is enough for the rule.
    urls.append("http://ads3.example.net/" + "x/" * 5 + "part5off")
    df = spark.createDataFrame([(i, u, "h", 1, "x", "y") for i, u in enumerate(urls)], PAGES)
    got = {r["url"]: r["verdict"] for r in url_filter.judge(df, "url", known).collect()}
    assert len(got) == 401 and all(got[u] == ("allow" if "news" in u else "block") for u in urls)
