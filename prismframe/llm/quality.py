"""Quality rules as robust multivariate outliers: a document whose statistics lie far from its language and source goes.

Six statistics of each text are smoothed towards usual values (so that short texts don't scatter), transformed by log or
logit, and compared by Mahalanobis distance with the minimum-covariance-determinant estimate of the document's language
and source. The estimate is found by concentration steps over all documents: distances, their ``SUPPORT`` quantile per
group, mean and covariance of the rows within it, until no determinant falls any more. Every step is a plain aggregation
whose state is a row per group; starts are deterministic (median and MAD; tanh correlations) and the lower determinant
wins. A group's estimate is then shrunk towards its language's, the language's towards that of all languages, and that
towards usual text, each by ``PRIOR`` documents: groups of one document and of a billion are treated alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, cut, table
from .text_arrays import WORD_BYTES, Texts, byte_sizes

#: Share of a group's documents whose covariance has the least determinant.
SUPPORT = 0.75
#: Variance added to each transformed statistic: differences below its root are no sign of quality.
FLOOR = 0.04
#: A clean document of a normal group is rejected with this probability.
REJECT = 1e-6
#: Documents that the next higher level counts as, when an estimate is shrunk towards it.
PRIOR = 50.0
#: A step that lowers a group's log determinant by less is its last.
SETTLED = 1e-4
#: Characters that each text's counts are padded with, at usual rates.
PAD = 100.0
#: Bytes of text worked on at once.
SLICE = 1 << 20
NAMES = ("letters", "upper", "symbols", "punctuation", "word_length", "variety")
P = len(NAMES)


def _bytes(test) -> np.ndarray:
    return np.array([bool(test(i)) for i in range(256)]).astype(np.int8)


_CHAR = _bytes(lambda i: i & 0xC0 != 0x80)
_LETTER = _bytes(lambda i: (i < 128 and chr(i).isalpha()) or i >= 0xC0)
_UPPER = _bytes(lambda i: 65 <= i <= 90)
_PUNCTUATION = _bytes(lambda i: i < 128 and chr(i) in ".,;:'\"-()!?")
_SYMBOL = _bytes(lambda i: 32 < i < 127 and not chr(i).isalnum() and chr(i) not in ".,;:'\"-()!?")


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text, transformed. Null and empty texts get the usual values."""
    found = []
    ahead, at = np.cumsum(byte_sizes(texts)), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ahead, (ahead[at - 1] if at else 0) + SLICE, "right")))
        t = Texts(texts.slice(at, to - at))
        n, letters = t.counts(_CHAR), t.counts(_LETTER)
        hashes, first, _ = t.words(WORD_BYTES)
        words = np.diff(first)
        distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)], dtype=float)

        def rate(count, usual, n=n):
            return (count + PAD * usual) / (n + PAD)

        share = rate(letters, 0.8)
        found.append(np.c_[
            np.log(share / (1 - share)), np.log(rate(t.counts(_UPPER), 0.03)), np.log(rate(t.counts(_SYMBOL), 0.01)), np.log(rate(t.counts(_PUNCTUATION), 0.03)),
            np.log((letters + PAD * 0.8) / (words + PAD / 5.5)), np.log(rate(distinct, 0.12)),
        ])
        at = to
    return np.concatenate(found) if found else np.zeros((0, P))


def with_statistics(docs: DataFrame, keep: list[str], lang: Column, source: Column, text_col: str) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), ``lang``, ``source`` and ``x0``.. of every row."""
    own = text_col in keep and isinstance(docs.schema[text_col].dataType, T.StringType)  # then the text travels once
    read = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), lang.alias("lang"), source.alias("source"), *([] if own else [col(text_col).cast("string").alias("text")]))
    schema = T.StructType([read.schema[c] for c in ("row", "lang", "source")] + [T.StructField(f"x{i}", T.DoubleType()) for i in range(P)])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            x = statistics(pc.struct_field(batch.column(0), [keep.index(text_col)]) if own else batch.column(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(np.ascontiguousarray(x[:, i])) for i in range(P)]], names=schema.names)

    return read.mapInArrow(batches, schema)


def chi2_cdf(x: float, dof: int) -> float:
    """By the series of the incomplete gamma function."""
    a, x = dof / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 10.0 * dof + 400
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return high


#: Makes the covariance of the central SUPPORT of a normal sample that of the whole.
CONSISTENCY = SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, P), P + 2)
CUTOFF = chi2_quantile(1 - REJECT, P)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


_PARAMS = pa.schema([("g", pa.string()), ("start", pa.int32()), ("n", pa.int64()), ("mu", pa.list_(pa.float64())), ("cov", pa.list_(pa.float64())), ("inv", pa.list_(pa.float64())), ("logdet", pa.float64())])
_SHAPE = "g string, start int, n long, mu array<double>, cov array<double>, inv array<double>, logdet double"


def square(upper: list[float]) -> np.ndarray:
    out = np.zeros((P, P))
    for (i, j), v in zip(PAIRS, upper, strict=True):
        out[i, j] = out[j, i] = v
    return out


def inverse(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(covariance, its inverse, log determinant), the least eigenvalues lifted to ``FLOOR``."""
    w, v = np.linalg.eigh(cov)
    w = np.maximum(w, FLOOR)
    return (v * w) @ v.T, (v / w) @ v.T, float(np.log(w).sum())


def _params(moments: DataFrame, scale: float) -> DataFrame:
    """Per (g, start): mean, covariance and its inverse (upper triangles), log determinant, from count, means and products."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            d = batch.to_pydict()
            out: dict[str, list] = {k: [] for k in _PARAMS.names}
            for g, start, n, mu, products in zip(*(d[k] for k in ("g", "start", "n", "mu", "products")), strict=True):
                # products of tanh scores need not be a covariance: its least eigenvalues are lifted
                cov, inv, logdet = inverse(scale * square(products) * (n / max(1, n - 1)) + FLOOR * np.eye(P))
                for k, x in zip(_PARAMS.names, (g, start, n, mu, [cov[p] for p in PAIRS], [inv[p] for p in PAIRS], logdet), strict=True):
                    out[k].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=_PARAMS)

    return moments.mapInArrow(batches, _SHAPE)


def shrink(n: float, mu: np.ndarray, cov: np.ndarray, above: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of a mixture of ``n`` documents and ``PRIOR`` of the level above."""
    w, between = n / (n + PRIOR), mu - above[0]
    return w * mu + (1 - w) * above[0], w * cov + (1 - w) * above[1] + w * (1 - w) * np.outer(between, between)


def usual() -> tuple[np.ndarray, np.ndarray]:
    """What text without any is taken for, with unit variances."""
    return statistics(pa.array([""], pa.string()))[0], np.eye(P)


def _shrunk(groups: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, source, mu, inv) of ``groups`` (lang, source, g, up, n, m): their estimates after shrinking. ``n``, ``m``: documents
    of the group and of its language.
    """
    flat = known.select("g", "n", *[F.col("mu")[i].alias(f"m{i}") for i in range(P)], *[(F.col("cov")[k] + F.col("mu")[i] * F.col("mu")[j]).alias(f"c{k}") for k, (i, j) in enumerate(PAIRS)])
    langs = groups.select(F.col("up").alias("g"), "m").distinct().join(flat.drop("n"), "g")
    mean = [(F.sum(F.col(c) * F.col("m")) / F.sum("m")).alias(c) for c in [f"m{i}" for i in range(P)] + [f"c{k}" for k in range(len(PAIRS))]]
    top = cut(langs.agg(F.sum("m").alias("all"), *mean)).select("all", F.array(*[f"m{i}" for i in range(P)]).alias("all_mu"), F.array(*[f"c{k}" for k in range(len(PAIRS))]).alias("all_products"))
    side = known.select("g", "mu", "cov")
    both = groups.join(side, "g").join(side.select(F.col("g").alias("up"), F.col("mu").alias("up_mu"), F.col("cov").alias("up_cov")), "up").crossJoin(top)
    schema = T.StructType([groups.schema["lang"], groups.schema["source"], T.StructField("mu", T.ArrayType(T.DoubleType())), T.StructField("inv", T.ArrayType(T.DoubleType()))])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            mus, invs = [], []
            for r in batch.to_pylist():
                mu = np.array(r["all_mu"])
                top = shrink(r["all"], mu, square(r["all_products"]) - np.outer(mu, mu), usual())
                lang = shrink(r["m"], np.array(r["up_mu"]), square(r["up_cov"]), top)
                mu, cov = shrink(r["n"], np.array(r["mu"]), square(r["cov"]), lang)
                mus.append(mu.tolist())
                invs.append([inverse(cov)[1][p] for p in PAIRS])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("source"), pa.array(mus, pa.list_(pa.float64())), pa.array(invs, pa.list_(pa.float64()))], names=schema.names)

    return both.select("lang", "source", "n", "m", "mu", "cov", "up_mu", "up_cov", "all", "all_mu", "all_products").mapInArrow(batches, schema)


def distance(prefix: str) -> Column:
    """Squared Mahalanobis distance of ``{prefix}i`` from ``mu`` and ``inv`` of the same row."""
    x = [F.col(f"{prefix}{i}") - F.col("mu")[i] for i in range(P)]
    total = None
    for k, (i, j) in enumerate(PAIRS):
        term = x[i] * x[j] * F.col("inv")[k] * (1.0 if i == j else 2.0)
        total = term if total is None else total + term
    return total


def _moments(rows: DataFrame, x: list[Column], by: tuple[str, ...] = ("g", "start")) -> DataFrame:
    n = F.count(F.lit(1))
    sums = rows.groupBy(*by).agg(n.alias("n"), *[F.avg(x[i]).alias(f"m{i}") for i in range(P)], *[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i, j in PAIRS])
    return sums.select(*by, "n", F.array(*[f"m{i}" for i in range(P)]).alias("mu"), F.array(*[f"c{i}_{j}" for i, j in PAIRS]).alias("products"))


def _step(rows: DataFrame, params: DataFrame, scale: float = 1.0) -> DataFrame:
    """A concentration step: estimates from the SUPPORT nearest rows of each group."""
    far = rows.join(params.select("g", "start", "mu", "inv"), "g").withColumn("d", distance("x"))
    limits = cut(far.groupBy("g", "start").agg(F.percentile_approx("d", F.lit(SUPPORT), F.lit(10_000)).alias("limit")))
    near = far.join(limits, ["g", "start"]).filter("d <= limit")
    return cut(_params(_moments(near, [F.col(f"x{i}") for i in range(P)]), scale))


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def fit(stats: DataFrame) -> DataFrame:
    """(lang, source, mu, inv): the shrunk estimate of every language and source in ``stats`` (lang, source, x0..)."""
    own, up = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    sizes = cut(stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")))
    groups = sizes.join(sizes.groupBy("lang").agg(F.sum("n").alias("m")), "lang").select("lang", "source", own.alias("g"), up.alias("up"), "n", "m")
    rows = stats.select(F.explode(F.array(own, up)).alias("g"), *[f"x{i}" for i in range(P)])
    middle = [F.percentile_approx(f"x{i}", F.lit(0.5), F.lit(10_000)) for i in range(P)]
    medians = cut(rows.groupBy("g").agg(*[m.alias(f"m{i}") for i, m in enumerate(middle)]))
    spreads = [F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5), F.lit(10_000)) * 1.4826 for i in range(P)]
    scales = cut(rows.join(medians, "g").groupBy("g").agg(*[F.first(f"m{i}").alias(f"m{i}") for i in range(P)], *[F.sqrt(s * s + F.lit(FLOOR)).alias(f"s{i}") for i, s in enumerate(spreads)]))
    scored = rows.join(scales, "g")
    z = [F.tanh((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"s{i}")) for i in range(P)]
    tanh = scored.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for i in range(P) for c in (f"m{i}", f"s{i}")],
        *[(F.avg(z[i] * z[j]) / F.greatest(F.sqrt(F.avg(z[i] * z[i]) * F.avg(z[j] * z[j])), F.lit(1e-9))).alias(f"r{i}_{j}") for i, j in PAIRS],
    )
    mu = F.array(*[f"m{i}" for i in range(P)]).alias("mu")
    starts = tanh.select("g", F.lit(0).alias("start"), "n", mu, F.array(*[(F.col(f"s{i}") * F.col(f"s{i}")) if i == j else F.lit(0.0) for i, j in PAIRS]).alias("products")).unionByName(
        tanh.select("g", F.lit(1).alias("start"), "n", mu, F.array(*[F.col(f"r{i}_{j}") * F.col(f"s{i}") * F.col(f"s{j}") for i, j in PAIRS]).alias("products"))
    )
    params = cut(_params(starts, 1.0))
    for _ in range(2):
        params = _step(rows, params)
    best = F.row_number().over(W.partitionBy("g").orderBy("logdet", "start"))
    moving, settled = cut(params.withColumn("b", best).filter("b = 1").drop("b")), []
    while True:  # every round lowers each remaining determinant by SETTLED, and none falls below that of FLOOR
        now = moving.join(_step(rows, moving).select("g", F.struct("n", "mu", "cov", "inv", "logdet").alias("after")), "g")
        fell = F.col("after.logdet") < F.col("logdet") - SETTLED
        both = cut(now.select("g", "start", F.when(F.col("after.logdet") < F.col("logdet"), F.col("after")).otherwise(F.struct("n", "mu", "cov", "inv", "logdet")).alias("to"), fell.alias("fell")).select("g", "start", "to.*", "fell"))
        settled.append(both.filter("NOT fell").drop("fell"))
        moving = both.filter("fell").drop("fell")
        if moving.isEmpty():
            break
    known = settled[0]
    for more in settled[1:]:
        known = known.unionByName(more)
    return cut(_shrunk(groups, _step(rows, known, CONSISTENCY)))


def score(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) of every row, as a struct ``row``, with ``distance2`` and ``rejected``.

    Null languages and sources are groups of their own. A null or empty text has the usual statistics, so it is far
    only from groups that are unusual. A very long text is used whole, in slices. Repeated rows weigh each and get the same
    verdict; rows that tie at the quantile are all within it. An empty table gives an empty one. Columns may have any
    names. Statistics are computed once: they are written with the ``keep`` columns, and the verdict is read from there.
    """
    stats = cut(with_statistics(docs, docs.columns if keep is None else keep, _key(col(lang_col)), _key(col(source_col)), text_col))
    params = fit(stats)
    return stats.join(params, ["lang", "source"]).select("row", distance("x").alias("distance2")).withColumn("rejected", F.col("distance2") > CUTOFF)


def reject_outliers(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` does not reject, with nulls, ties and the like as there."""
    kept = score(docs, lang_col, source_col, text_col).filter(~F.col("rejected"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scored.select("row.doc_id", F.round("distance2", 4).alias("distance2"), "rejected")
