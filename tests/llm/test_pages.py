"""Wrapper induction and quotation linking."""

import random

from pyspark.sql import functions as F

from carelens.llm import html_wrapper, quotes
from tests.llm.docs import words


def test_parts_that_are_no_article():
    page = """<!DOCTYPE html><html><head><title>t</title><script>var a = "</p>";</script><style>p{}</style></head><body>
    <header class="site-header"><a href="/">Home</a></header><nav><ul><li>menu</li></ul></nav><!-- <p>no</p> -->
    <div class="ad-banner">buy</div><main><article><header><h1>The  &amp;&#32;title</h1></header><p>One <b>b</b>old<i>x</i>
    line<br>two<p>Unclosed <span class="share">share me</span> words 5 &lt; 6<ul><li>first<li>second</ul>
    <form><input>name</form><aside>see also</aside><table><tr><td>a<td>b</table></article>
    <section id="comments"><p>reader</p></section></main><div class="cookie notice">we use</div><footer>foot</footer>"""
    assert html_wrapper.extract([page]) == ["The & title One boldx line two Unclosed words 5 < 6 first second a b"]
    assert html_wrapper.extract(["", "plain text", "<p", "<div><p>a</p><p>b"]) == ["", "plain text", "", "a b"]


def hosted(rng, k):
    body = "".join(f"<p>{words(rng, 25)}</p>" for _ in range(k % 4 + 2))
    text = " ".join(__import__("re").findall(r"<p>(.*?)</p>", body))
    page = f"<html><body><div class='top'><p>Welcome to the site</p></div><div class='layout'><div class='x1'>{body}</div></div><div class='end'><p>All rights are ours</p></div></body></html>"
    return page, text


def test_template_without_any_names():
    rng = random.Random(3)
    pages = [hosted(rng, k) for k in range(9)]
    assert html_wrapper.extract([p for p, _ in pages]) == [t for _, t in pages]
    # Copies of one page have nothing that varies: all that no markup excludes stays.
    assert html_wrapper.extract([pages[0][0]] * 3)[0].endswith("All rights are ours")


def test_tree_matching_counts_the_most_pairs():
    tree = lambda inner: html_wrapper.parse(f"<div>{inner}</div>")
    score = lambda a, b: html_wrapper.match(tree(a), tree(b), [])
    assert score("<p>a</p><ul><li>1</ul>", "<p>a</p><ul><li>1</ul>") == 5
    assert score("<p>a</p><h2>x</h2><p>b</p>", "<p>a</p><p>b</p>") == 4
    assert score("<h2>x</h2>", "<p>y</p>") == 2


def test_tree_matching_is_the_best_at_any_size():
    tree = lambda inner: html_wrapper.parse(f"<div>{inner}</div>")
    score = lambda a, b: html_wrapper.match(tree(a), tree(b), [])
    rows = "".join(f"<section>{k}</section><article>{k}</article>" for k in range(150))
    # One list starts with an element that the other lacks: in step no other element would find its like.
    pairs: list = []
    assert html_wrapper.match(tree("<ul></ul>" + rows), tree(rows), pairs) == 302 == len(pairs)
    assert all(p.label == q.label for p, q in pairs)
    assert score("<div>" * 3000 + "<ul><li>a</ul>", "<div>" * 3000 + "<ul><li>a</ul>") == 3004


def test_pages_of_all_kinds(spark):
    rng = random.Random(5)
    made = [hosted(rng, k) for k in range(60)]
    rows = [(i, "http://one.example/" + str(i), p, "x") for i, (p, _) in enumerate(made)]
    rows += [(900, None, None, None), (901, "odd", "", ""), (None, "https://u@Two.example:80/a", "<article>only</article>", ""), (0, rows[0][1], made[0][0], "x")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = html_wrapper.main_texts(frame).collect()
    want = [(i, u, made[i][1]) for i, u, *_ in rows[:60]] + [(900, None, ""), (901, "odd", ""), (None, rows[62][1], "only"), (0, rows[0][1], made[0][1])]
    assert sorted([tuple(r)[:3] for r in got], key=repr) == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_wrapper.main_texts(frame.limit(0)).count() == 0


def test_template_inside_the_article():
    """What is constant goes from the article too, unless the pages are few or versions of one article."""
    rng = random.Random(6)
    bodies = [[words(rng, 30) for _ in range(3)] for _ in range(10)]
    page = lambda ps: "<main><article><h1>" + ps[0][:20] + "</h1><p>Share this on Foo.</p>" + "".join(f"<p>{p}</p>" for p in ps) + "<p>Copyright our site.</p></article></main>"
    want = [" ".join([b[0][:20].strip(), *b]) for b in bodies]
    pages = [page(b) for b in bodies]
    full = [f"{b[0][:20].strip()} Share this on Foo. {' '.join(b)} Copyright our site." for b in bodies]
    assert html_wrapper.extract(pages) == want
    assert html_wrapper.extract(pages[:2]) == full[:2]  # two pages tell nothing
    assert html_wrapper.extract(pages[:1] * 9) == full[:1] * 9  # copies are one page
    # Versions of one article: a word differs, the rest is not template.
    versions = [[bodies[0][0], bodies[0][1], bodies[0][2] + f" v{k}"] for k in range(6)]
    got = html_wrapper.extract([page(v) for v in versions])
    assert all(v[0] in g and v[1] in g and v[2] in g for v, g in zip(versions, got, strict=True))


def test_names_count_whole():
    page = lambda name: html_wrapper.extract([f"<body><div><p>Before all.</p><section id='{name}'><p>Inside it.</p></section></div></body>"])[0]
    for name in ("related-work", "share-of-votes", "search-algorithms", "social-history", "notice-period", "address", "padding"):
        assert page(name) == "Before all. Inside it.", name
    for name in ("related", "related-posts", "share-buttons", "social_links", "ad", "ad-slot-3", "sidebar-left", "cookie-notice", "comments", "site-footer"):
        assert page(name) == "Before all.", name


MESSAGES = [
    (1, 0, "user", "How do I boil an egg properly? I never know."),
    (1, 1, "assistant", "> How do I boil an egg properly?\nYou put it in water for ten minutes.\nThen cool it quickly."),
    (1, 2, "user", "> > How do I boil an egg properly?\n> You put it in WATER, for ten minutes\nThanks, that is it!"),
    (1, 3, "user", ">> How do I boil an egg properly?\nAgain?"),
    (2, 0, "user", "Hello there my friend."),
    (2, 5, "user", ">You put it in water for ten minutes.\nreally?"),
    (3, 0, "user", "> nobody has ever said this\nfirst"),
    (3, 1, "user", None),
    (None, 1, "user", "> Hello there my friend.\nx"),
    (4, None, None, ""),
]


def test_quotes(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    docs = spark.createDataFrame(MESSAGES, schema).withColumn("place", F.lit("clash"))
    got = {(r["conv_id"], r["turn"]): r for r in quotes.conversations(docs).collect()}
    assert len(got) == len(MESSAGES)
    parent = lambda c, t: (got[c, t]["parent_conv"], got[c, t]["parent_turn"], got[c, t]["depth"])
    assert parent(1, 0) == (None, None, 0) and parent(1, 1) == (1, 0, 1)
    assert parent(1, 2) == (1, 1, 2)  # the outermost quote decides
    assert parent(1, 3) == (1, 0, 1)  # said by the first message only
    assert parent(2, 5) == (1, 1, 2)  # another conversation
    assert parent(3, 0) == (None, None, 0) and parent(3, 1) == (3, 0, 1)
    assert got[1, 2]["own_text"] == "Thanks, that is it!" and got[1, 2]["quote_depth"] == 2 and got[1, 2]["n_quotes"] == 2
    assert got[3, 1]["own_text"] == "" and got[None, 1]["own_text"] == "x" and got[None, 1]["depth"] is None
    thread = sorted((r["place"], k) for k, r in got.items() if (r["thread_conv"], r["thread_turn"]) == (1, 0))
    assert [k for _, k in thread][0] == (1, 0) and len(thread) == 5
    assert quotes.conversations(docs.limit(0)).count() == 0
    twice = quotes.conversations(docs.union(docs))
    assert twice.count() == 2 * len(MESSAGES)


def test_threads_over_blocks_of_turns(spark):
    rng = random.Random(11)
    line = "The same passage said over and over."
    turns = sorted(rng.sample(range(-3, 5 << quotes.TURN_BITS), 60))
    kinds = {t: rng.choice(["said", "quoted", "other", "other"]) for t in turns}
    texts = {"said": line, "quoted": f"> {line}\nyes", "other": "nothing of the kind"}
    docs = spark.createDataFrame([(7, t, "user", texts[k]) for t, k in kinds.items()], "conv_id bigint, turn bigint, role string, text string")
    parent, depth = {}, {}
    for i, t in enumerate(turns):
        said = [s for s in turns[:i] if kinds[s] == "said"]
        parent[t] = said[-1] if kinds[t] == "quoted" and said else turns[i - 1] if i else None
        depth[t] = depth[parent[t]] + 1 if i else 0
    got = {r["turn"]: r for r in quotes.linked(docs).collect()}
    assert {t: r["parent_turn"] for t, r in got.items()} == parent
    assert {t: r["depth"] for t, r in got.items()} == depth
    assert {(r["thread_conv"], r["thread_turn"]) for r in got.values()} == {(7, turns[0])}


def test_short_and_partial_quotes(spark):
    three = "The first point is this one. The second point differs a lot. And a third was made."
    wrapped = "A line that was wrapped\nby some mail program or other\nover several lines of text"
    rows = [
        (1, 0, "user", "Why not?"), (1, 1, "bot", "Because."), (1, 2, "user", "> Why not?\nI asked first"),
        (2, 0, "user", three), (2, 1, "bot", "Something else is said here."), (2, 2, "user", "> The second point differs a lot. And a third was made.\nyes"),
        (3, 0, "user", wrapped), (3, 1, "bot", "noted"), (3, 2, "user", "> by some mail program or other\n> over several lines of text\nindeed"),
        (4, 3, "user", "> The first point is this one. And a third was made.\nfrom elsewhere"),
        (5, 0, "user", "Why not?"), (6, 9, "user", "> Why not?\nshort ones stay in their conversation"),
        (7, 0, "user", "One thing is true here."), (7, 1, "bot", "ok"), (7, 2, "user", "> One thing is true here. But all the rest of this passage was never said by anyone.\nhm"),
    ]
    docs = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["parent_conv"], r["parent_turn"]) for r in quotes.conversations(docs).collect()}
    assert got[1, 2] == (1, 0) and got[2, 2] == (2, 0) and got[3, 2] == (3, 0)
    assert got[4, 3] == (2, 0)
    assert got[6, 9] == (None, None)
    assert got[7, 2] == (7, 1)  # too little of it was said


def test_passages_are_runs_of_one_level(spark):
    text = "> a\n> b\n>> c\nown\n> d\n" + "> e\n" * 3000
    row = spark.createDataFrame([(text,)], "text string").select(quotes._passages(quotes._lines(F.col("text"))).alias("p")).first()["p"]
    assert [(p["level"], p["content"][:3]) for p in row] == [(1, "a\nb"), (2, "c"), (0, "own"), (1, "d\ne"), (0, "")]
    assert row[3]["content"] == "\n".join(["d", *["e"] * 3000])


def test_planted_quotes_are_found(spark):
    """Quotes of random runs of sentences, nested or not: the share that gets its source."""
    rng = random.Random(12)
    said, rows, want = {}, [], {}
    for c in range(40):
        for t in range(6):
            own = " ".join(words(rng, rng.randint(4, 9)).capitalize() + "." for _ in range(rng.randint(1, 4)))
            text, source = own, None
            if t > 1 and rng.random() < 0.6:
                source = rng.randrange(t)
                parts = said[c, source].split(". ")
                k = rng.randrange(len(parts))
                piece = ". ".join(parts[k : k + rng.randint(1, len(parts))]).rstrip(".") + "."
                text = f"> {piece}\n{own}"
            said[c, t] = own
            rows.append((c, t, "user", text))
            want[c, t] = (c, source) if source is not None else ((c, t - 1) if t else (None, None))
    docs = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["parent_conv"], r["parent_turn"]) for r in quotes.conversations(docs).collect()}
    assert got == want
