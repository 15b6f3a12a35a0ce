import random

from prismframe.llm.html_extraction import DEFAULT_WEIGHTS, blocks, capacities, extract, extract_content, fit_classifier, min_cut, train

PAGE = "<html><head><title>T</title><script>var a='<p>x</p>'</script></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><article><h1>Big &amp; story</h1><p>First long paragraph, with words. And more of them, indeed.<p>Second paragraph goes on, and on. It ends here.</article><footer>&copy; us</footer>"


def energy(n, source, sink, edges, mask):
    return sum(sink[i] if mask >> i & 1 else source[i] for i in range(n)) + sum(c for a, b, c in edges if (mask >> a & 1) != (mask >> b & 1))


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(0, 8)
        source, sink = [rng.randint(0, 20) for _ in range(n)], [rng.randint(0, 20) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 10)) for a in range(n) for b in range(a) if rng.random() < 0.4]
        kept = min_cut(n, source, sink, edges)
        mask = sum(1 << i for i in range(n) if kept[i])
        costs = [energy(n, source, sink, edges, m) for m in range(1 << n)]
        assert costs[mask] == min(costs)
        assert all(m & mask == mask for m, c in enumerate(costs) if c == min(costs))  # ties: the fewest content blocks


def test_labelling_of_pages_by_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        page = "".join(f"<{t}>{'word, ' * rng.randint(1, 30)}{'<a>link</a>' * rng.randint(0, 2)}</{t}>" for t in (rng.choice(["p", "li", "div", "h2"]) for _ in range(rng.randint(1, 9))))
        found = blocks(page)
        s, t, e = capacities(found, DEFAULT_WEIGHTS)
        best = min(range(1 << len(found)), key=lambda m: (energy(len(found), s, t, e, m), bin(m).count("1")))
        assert extract(page, DEFAULT_WEIGHTS)[0] == "\n".join(b.text for i, b in enumerate(found) if best >> i & 1)


def test_page():
    text, n, kept = extract(PAGE, DEFAULT_WEIGHTS)
    assert "First long paragraph, with words. And more of them, indeed." in text and "Home" not in text and "©" not in text and "var a" not in text
    assert n == 6 and kept >= 2


def test_training_separates():
    rng = random.Random(3)
    rows = [([1.0, rng.gauss(3 * y, 1), *[0.0] * 6], y) for y in (0, 1) for _ in range(100)]
    w = train(rows)
    right = sum((sum(a * b for a, b in zip(w, f)) > 0) == bool(y) for f, y in rows)
    assert right >= 180 and train([]) == DEFAULT_WEIGHTS


def test_held_out_blocks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = fit_classifier(pages.filter("page_id % 2 = 0"))
    held = [r.html for r in pages.filter("page_id % 2 = 1").collect()]
    right = total = 0
    for html in held:
        found = blocks(html)
        kept = min_cut(len(found), *capacities(found, weights))
        for b, k in zip(found, kept):
            if b.hint:
                total += 1
                right += k == (b.hint > 0)
    assert right / total > 0.97


def test_edges(spark):
    rows = [(1, None, "c"), (2, "", "c"), (3, "<p", "c"), (4, "plain", "c"), (None, PAGE, "c"), (None, PAGE, "c"), (6, "<div>" * 3000 + "<p>deep, deep text. It goes on.</p>", "c"), (7, "<p>" + "very long, " * 30000 + "</p>", "c"), (8, "</div></p>&lt;&bogus;<b>", "c")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract_content(df).collect()
    assert len(got) == 9 and {r.page_id: r.n_blocks for r in got}[1] == 0
    assert [r.text for r in got if r.page_id == 1] == [None] and [r.text for r in got if r.page_id == 2] == [""]
    assert extract_content(df.filter("false")).count() == 0


def test_optional_end_tags():
    for chrome in ("<nav><ul>" + "<li><p>item" * 40 + "</nav>", "<header><table>" + "<tr><td>cell<td>cell" * 40 + "</header>", "<aside>" + "<font><span>x" * 60 + "</aside>"):
        found = blocks(chrome + "<article><p>Text of the story.</article><p>After")
        assert [(b.text, b.hint) for b in found][-2:] == [("Text of the story.", 1), ("After", 0)]
        assert all(b.hint == -1 for b in found[:-2])
    for page in ("<html><head><title>T</title><meta charset=utf-8><body><p>One<div>Two</div>", "<head><title>T</title><p>One<hr>Two"):
        assert [b.text for b in blocks(page)] == ["One", "Two"]
    assert [b.depth for b in blocks("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>")] == [1, 3, 3, 1, 1]


def test_clashing_names(spark):
    pages = spark.createDataFrame([(1, "<p>" + "some words of content here " * 9 + "</p>", 5, "n"), (2, None, 5, "n")], "page_id long, html string, n_blocks long, n_kept string")
    got = extract_content(pages, weights=DEFAULT_WEIGHTS)
    assert got.columns == ["page_id", "text", "n_blocks", "n_kept"] and [r.n_blocks for r in got.orderBy("page_id").collect()] == [1, 0]
