import random

import pyarrow as pa

from prismframe.llm.decontamination import contamination, decontaminate, masks, myers, normalise, pieces


def slow(pattern, text):
    """Least edit distance of pattern to any substring, by the textbook table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_against_the_table():
    rng = random.Random(1)
    for _ in range(400):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(lo, 14))) for lo in (1, 0))
        assert myers(masks(p), len(p), t) == slow(p, t)
    long = "".join(rng.choice("abcd") for _ in range(150))
    assert myers(masks(long), 150, "zz" + long[:70] + "x" + long[71:] + "zz") == 1


def test_pieces():
    for n in range(1, 40):
        for k in range(5):
            got = pieces("x" * n, k)
            assert len(got) == min(k + 1, n) and sum(len(p) for _, p in got) == n and max(len(p) for _, p in got) - min(len(p) for _, p in got) <= 1


def damaged(rng, words, edits):
    s = list(" ".join(words))
    for _ in range(edits):
        i = rng.randrange(max(1, len(s)))
        s[i : i + 1] = rng.choice([[], [rng.choice("xyz")], [*s[i : i + 1], "q"]])
    return "".join(s)


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    items = [(i, [rng.choice(vocab) for _ in range(rng.randint(1, 25))]) for i in range(25)]
    docs = []
    for d in range(80):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 50))]
        at, item = rng.randint(0, len(words)), rng.choice(items)[1]
        docs.append((d, " ".join(words[:at]) + " " + (damaged(rng, item, rng.randint(0, 14)).upper() if d % 2 else "") + ", " + " ".join(words[at:])))
    bench = [(i, " ".join(w)) for i, w in items]
    want = set()
    for d, t in zip((d for d, _ in docs), normalise(pa.array([t for _, t in docs])).to_pylist()):
        for i, p in zip((i for i, _ in bench), normalise(pa.array([b for _, b in bench])).to_pylist()):
            if (n := slow(p, t)) <= int(len(p) * 0.08):
                want.add((d, i, n))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    for chars in (10**6, 150):  # one pass, several passes
        assert {tuple(r) for r in contamination(*frames, chars_a_pass=chars).collect()} == want
    assert any(n for *_, n in want)
    kept = {r.doc_id for r in decontaminate(*frames, chars_a_pass=150).collect()}
    assert kept == {d for d, _ in docs} - {d for d, *_ in want}


def test_edges(spark):
    b = spark.createDataFrame([(1, "the quick brown fox jumps"), (1, "the quick brown fox jumps"), (2, None), (3, ""), (4, "?!"), (None, "lazy dogs sleep all day")], "item_id long, text string")
    rows = [(1, "a THE quick, brown fox-jumps", "x"), (2, None, "x"), (3, "", "x"), (None, "Lazy dogs sleep all day", "x"), (5, "z " * 100000 + "the quick brown fox jumps", "x"), (6, "clean", "x"), (6, "clean", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in contamination(d, b).collect()), key=str)
    assert got == sorted([(1, 1, 0), (1, 1, 0), (5, 1, 0), (5, 1, 0), (None, None, 0)], key=str)
    kept = decontaminate(d, b)
    assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "6", "6"]
    assert decontaminate(d.filter("false"), b).count() == 0 and decontaminate(d, b.filter("false")).count() == 7
