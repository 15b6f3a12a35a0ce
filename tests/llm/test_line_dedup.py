from prismframe.llm.line_dedup import drop_boilerplate_lines


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, lines int")


def run(df, **kw):
    return {r.page_id: (r.host, r.text, r.n_lines, r.n_dropped) for r in drop_boilerplate_lines(df, **kw).collect()}


def brute(rows, ratio, least):
    import re
    from collections import Counter, defaultdict

    def lines(h):
        text = re.sub(r"<[^>]+>", "\n", h or "")
        return [x for x in (re.sub(" +", " ", y).strip() for y in text.split("\n")) if x]

    seen, total = defaultdict(Counter), Counter()
    for _, host, h in rows:
        total[host] += 1
        seen[host].update(set(lines(h)))
    out = {}
    for i, host, h in rows:
        kept = [x for x in lines(h) if not (seen[host][x] >= least and seen[host][x] > ratio * total[host])]
        out[i] = (host, "\n".join(kept), len(lines(h)), len(lines(h)) - len(kept))
    return out


def test_against_brute_force(spark):
    import random

    rng = random.Random(2)
    rows = []
    for i in range(120):
        host = f"h{rng.randint(0, 4)}.org"
        body = "".join(f"<p>{rng.choice(['menu', 'foot  er', 'ad', f'own {i}', f'x {rng.randint(0, 40)}'])}</p>" for _ in range(rng.randint(0, 8)))
        rows.append((i, host, body))
    df = pages(spark, [(i, f"https://{h.upper()}:80/p?x=1", b, "clash", 0) for i, h, b in rows])
    assert run(df) == brute(rows, 0.3, 3)


def test_ties_at_the_ratio_stay(spark):
    rows = [(i, "http://a.org/", "<p>same</p>" if i < 3 else f"<p>own {i}</p>", "", 0) for i in range(10)]
    assert run(pages(spark, rows))[0][1] == "same"  # 3 of 10 is not more than 0.3
    assert run(pages(spark, rows[:9]))[0][1] == ""


def test_nulls_scripts_long_and_empty(spark):
    big = "<p>" + "long " * 40000 + "</p>"
    rows = [(1, None, "<p>a</p>", None, None), (None, "no scheme", None, None, None), (3, "http://b.org", "<script>var x='<p>no</p>'</script><style>p{}</style><!-- no -->", None, None), (4, "http://b.org/x", big, None, None), (4, "http://b.org/x", big, None, None)]
    df = pages(spark, rows)
    got = drop_boilerplate_lines(df).collect()
    assert len(got) == 5
    assert {(r.page_id, r.host, r.n_lines) for r in got} == {(1, "", 1), (None, "", 0), (3, "b.org", 0), (4, "b.org", 1)}
    assert drop_boilerplate_lines(df.filter("false")).count() == 0
