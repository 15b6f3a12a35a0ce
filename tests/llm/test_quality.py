import itertools
import math
import random

import numpy as np
import pyarrow as pa

from prismframe.llm import quality as Q

VOCAB = ["time", "house", "river", "market", "people", "letter", "winter", "story", "garden", "office", "morning", "question"]


def clean(rng, n):
    return " ".join((w.capitalize() + ".") if rng.random() < 0.1 else w for w in (rng.choice(VOCAB) + rng.choice(["", "s", "ing", "ed"]) for _ in range(n)))


def rows(seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(400):
        lang, source = rng.choice(["en", "de"]), rng.choice(["a", "b"])
        text = clean(rng, rng.randint(3, 200))
        if i % 9 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else " ".join(w + rng.choice(["***", "%%%", "$$$"]) for w in text.split())
        out.append((i, text, lang, source, len(text)))
    return out


def mcd(x):
    """Mean and covariance of one group in numpy: both starts, concentration steps by sorting."""
    n, h = len(x), math.ceil(Q.SUPPORT * len(x))
    low = lambda v: np.sort(v)[math.ceil(0.5 * n) - 1]
    med = np.array([low(x[:, i]) for i in range(Q.P)])
    scale = np.sqrt(np.array([1.4826 * low(abs(x[:, i] - med[i])) for i in range(Q.P)]) ** 2 + Q.FLOOR)
    z = np.tanh((x - med) / scale)
    zz = z.T @ z / n
    corr = zz / np.maximum(np.sqrt(np.outer(np.diag(zz), np.diag(zz))), 1e-9)

    def params(mu, cov, k, c=1.0):
        w, v = np.linalg.eigh(c * cov * k / max(1, k - 1) + Q.FLOOR * np.eye(Q.P))
        w = np.maximum(w, Q.FLOOR)
        return mu, (v * w) @ v.T, (v / w) @ v.T, np.log(w).sum()

    def step(p, c=1.0):
        d = np.einsum("ij,jk,ik->i", x - p[0], p[2], x - p[0])
        near = x[d <= np.sort(d)[h - 1]]
        return params(near.mean(0), np.cov(near.T, bias=True) if len(near) > 1 else np.zeros((Q.P, Q.P)), len(near), c)

    starts = [params(med, np.diag(scale**2), n), params(med, corr * np.outer(scale, scale), n)]
    for _ in range(2):
        starts = [step(p) for p in starts]
    p = min(starts, key=lambda s: s[3])
    while True:
        after = step(p)
        fell, p = after[3] < p[3] - Q.SETTLED, after if after[3] < p[3] else p
        if not fell:
            return step(p, Q.CONSISTENCY)[:2], p[3]


def brute(x, keys):
    """Squared distances under shrunk estimates."""
    langs, groups = sorted({k[0] for k in keys}), sorted(set(keys))
    at = {g: [i for i, k in enumerate(keys) if g == k] for g in groups} | {(lang,): [i for i, k in enumerate(keys) if k[0] == lang] for lang in langs}
    est = {g: mcd(x[i])[0] for g, i in at.items()}
    m = {g: len(i) for g, i in at.items()}
    mean = sum(m[lang,] * est[lang,][0] for lang in langs) / len(x)
    second = sum(m[lang,] * (est[lang,][1] + np.outer(est[lang,][0], est[lang,][0])) for lang in langs) / len(x)

    def mixed(n, a, b):
        w, d = n / (n + Q.PRIOR), a[0] - b[0]
        return w * a[0] + (1 - w) * b[0], w * a[1] + (1 - w) * b[1] + w * (1 - w) * np.outer(d, d)

    top = mixed(len(x), (mean, second - np.outer(mean, mean)), (Q.statistics(pa.array([""]))[0], np.eye(Q.P)))
    out = np.zeros(len(x))
    for g in groups:
        mu, cov = mixed(m[g], est[g], mixed(m[g[0],], est[g[0],], top))
        out[at[g]] = np.einsum("ij,jk,ik->i", x[at[g]] - mu, np.linalg.inv(cov), x[at[g]] - mu)
    return out


def test_distances_against_numpy(spark):
    data = rows() + [(900 + i, clean(random.Random(i), 30), "fr", f"small{i}", 1) for i in range(7)]
    got = {r.row.doc_id: r.distance2 for r in Q.score(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"), keep=["doc_id"]).collect()}
    want = brute(Q.statistics(pa.array([r[1] for r in data])), [(r[2], r[3]) for r in data])
    assert np.allclose([got[r[0]] for r in data], want, rtol=1e-4, atol=1e-4)


def test_determinant_against_every_subset():
    """The independent definition: of all subsets of the support's size the one of least determinant."""
    exact = 0
    for seed in range(12):
        rng = np.random.default_rng(seed)
        x = rng.normal(0, 1, (12, Q.P)) * 0.5
        x[9:] += 6 * rng.choice([-1, 1], (3, Q.P))
        least = min(np.linalg.slogdet(np.cov(x[list(c)].T) + Q.FLOOR * np.eye(Q.P))[1] for c in itertools.combinations(range(12), 9))
        found = mcd(x)[1]
        assert found >= least - 1e-9
        exact += found < least + 1e-6
    assert exact >= 11


def test_ties_at_the_quantile_count_alike(spark):
    data = [(i, "same words here again", "en", "s", 1) for i in range(40)] + [(100 + i, "Other words, there.", "en", "s", 1) for i in range(40)]
    got = Q.score(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"), keep=["text"]).collect()
    assert len({(r.row.text, r.distance2) for r in got}) == 2 and not any(r.rejected for r in got)


def test_junk_goes_and_clean_stays(spark):
    data = rows(2)
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    out = Q.reject_outliers(df)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    junk = {i for i in range(400) if i % 9 == 0}
    assert len(kept & junk) <= 0.15 * len(junk) and len(kept - junk) >= 0.99 * (400 - len(junk))


def test_statistics_in_slices_are_the_same(monkeypatch):
    texts = pa.array([None, "", "Ünïcode ÀÉ!", "x" * 5000, *[r[1] for r in rows(3)[:50]]])
    whole = Q.statistics(texts)
    monkeypatch.setattr(Q, "SLICE", 64)
    assert np.allclose(whole, Q.statistics(texts)) and np.isfinite(whole).all()
    assert np.allclose(whole[0], whole[1])


def test_chi2():
    assert abs(Q.chi2_quantile(0.95, 6) - 12.591587) < 1e-5 and abs(Q.chi2_cdf(4.0, 2) - (1 - math.exp(-2))) < 1e-12


def test_edges(spark):
    data = [(i, None if i % 3 else "a few words here", None if i % 2 else "en", "s", 1) for i in range(120)] + [(None, "ALL!! CAPS!!", "xx", None, None), (5, "w " * 90000, "en", "s", 0), (5, "w " * 90000, "en", "s", 0)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, x0 long")
    scored = Q.score(df).collect()
    assert len(scored) == len(data)
    lonely = [r for r in scored if r.row.lang == "xx"]
    assert lonely[0].distance2 > 0
    assert Q.reject_outliers(df).columns == df.columns
    assert Q.reject_outliers(df.filter("false")).count() == 0
