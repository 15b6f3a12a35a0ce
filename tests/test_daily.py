import random

from pyspark.sql import functions as F

from prismframe.plans import daily

TOPICS = {"budget": "parliament votes annual budget spending deficit finance minister", "quake": "earthquake rescue teams survivors rubble magnitude coast village", "final": "football champions final penalty shootout stadium supporters trophy"}


def test_a_synthetic_day(spark):
    rng, rows, vectors = random.Random(1), [], []
    for t, (name, words) in enumerate(TOPICS.items()):
        for k in range(8):
            i = t * 8 + k
            body = " ".join(rng.choice(words.split()) for _ in range(200))
            rows.append((i, "2026-08-06", f"o{k % 6}", f"c{k % 4}", "en" if k % 2 else "de", f"{name} report {rng.choice(words.split())} number{k}", f"https://s{k}.org/{name}/{k}?utm_a=1", body[:80], body))
            vectors.append((i, [float(x == t) + rng.gauss(0, 0.02) for x in range(3)]))
    items = spark.createDataFrame(rows, "id long, day string, outlet string, country string, lang string, title string, link string, summary string, body string").withColumn("day", F.to_date("day"))
    out = daily.run(items, spark.createDataFrame(vectors, "id long, embedding array<double>"))
    assert out["clusters"].select("cluster").distinct().count() == 3
    ranked = out["stories"].collect()
    assert len(ranked) == 3 and all(r.n_articles == 8 and r.salience == 12.0 for r in ranked)
    corpus = out["corpus"].collect()
    assert {r.signal_level for r in corpus} == {"body"} and max(r.signal_text_idx for r in corpus) == len(corpus) // 3 - 1
    assert all(out[k].count() >= 0 for k in ("words", "pairs", "exclusive"))


def test_a_thin_day_has_no_story(spark):
    items = spark.createDataFrame([(i, "2026-08-06", "o", "c", "en", f"t{i}", f"https://x.org/{i}", "s", "b") for i in range(3)], "id long, day string, outlet string, country string, lang string, title string, link string, summary string, body string").withColumn("day", F.to_date("day"))
    out = daily.run(items, spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "id long, embedding array<double>"))
    assert out["stories"].count() == 0 and out["corpus"].count() == 0
