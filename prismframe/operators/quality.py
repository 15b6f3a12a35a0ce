"""Contracts: codebooks, numbers against metrics, version stamps, structural differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def codebook_errors(frames: DataFrame, codebook: DataFrame, frame: str, sub_frame: str) -> DataFrame:
    """Rows whose frame is not in the codebook, or is OTHER without a sub-frame, with ``error``."""
    known = codebook.select(F.col(frame), F.lit(True).alias("_k")).distinct()
    error = F.when(F.col("_k").isNull(), "unknown frame").when((F.upper(frame) == "OTHER") & (F.coalesce(F.trim(F.col(sub_frame)), F.lit("")) == ""), "OTHER without sub-frame")
    return frames.join(known, frame, "left").withColumn("error", error).filter("error IS NOT NULL").drop("_k")


def number_errors(stated: DataFrame, metrics: DataFrame, keys: list[str], numbers: list[str], tolerance: float = 1e-6) -> DataFrame:
    """(keys.., ``name``, ``stated``, ``measured``) of stated numbers that differ from the metric or have none."""
    def long(df: DataFrame, value: str) -> DataFrame:
        return df.select(*keys, *[F.col(n).cast("double").alias(n) for n in numbers]).unpivot(keys, numbers, "name", value)

    both = long(stated, "stated").filter("stated IS NOT NULL").join(long(metrics, "measured"), [*keys, "name"], "left")
    return both.filter(F.col("measured").isNull() | (F.abs(F.col("stated") - F.col("measured")) > tolerance))


def schema_errors(rows: DataFrame, expected: dict[str, str]) -> list[str]:
    """Missing columns, other types, and columns that are not expected, in order."""
    have = dict(rows.dtypes)
    missing = [f"{c}: missing" for c in expected if c not in have]
    wrong = [f"{c}: {have[c]} instead of {t}" for c, t in expected.items() if c in have and have[c] != t]
    return missing + wrong + [f"{c}: not expected" for c in have if c not in expected]


def json_errors(rows: DataFrame, document: str, expected: dict[str, str], required: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``errors``: what a JSON text lacks or has of another type, in order of the path; "not JSON" alone if it is none.

    ``expected``: dotted path -> JSON type as variants name it (BIGINT, STRING, OBJECT<..> by its first word, ..).
    """
    doc = F.try_parse_json(F.col(document))
    found = []
    for path, kind in sorted(expected.items()):
        at = F.try_variant_get(doc, f"$.{path}", "variant")
        have = F.regexp_extract(F.schema_of_variant(at), r"^(\w+)", 1)
        lacks = F.lit(f"{path}: missing") if path in required else F.lit(None).cast("string")
        found.append(F.when(at.isNull() | (have == "VOID"), lacks).when(have != kind, F.concat(F.lit(f"{path}: "), have, F.lit(f" instead of {kind}"))))
    errors = F.when(doc.isNull(), F.array(F.lit("not JSON"))).otherwise(F.filter(F.array(*found), lambda e: e.isNotNull()))
    return rows.withColumn("errors", errors)


def restamp(rows: DataFrame, version: str, column: str = "meta_version") -> DataFrame:
    """The version overwritten where it differs, with ``restamped`` telling where."""
    old = F.col(column) if column in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("restamped", ~old.eqNullSafe(F.lit(version))).withColumn(column, F.lit(version))


def mixed_majors(rows: DataFrame, by: list[str], version: str = "meta_version") -> DataFrame:
    """Groups whose rows come from more than one major version."""
    return rows.groupBy(*by).agg(F.array_sort(F.collect_set(F.element_at(F.split(version, r"\."), 1))).alias("majors")).filter(F.size("majors") > 1)


def fingerprint(rows: DataFrame, columns: list[str] | None = None) -> Column:
    """A hash of a row's columns by name, for pins of inputs."""
    columns = sorted(columns or rows.columns)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)


def pin(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n, hash) of every input, whatever the order of its rows."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.select(F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash"))
        one = one.select(F.lit(name).alias("table"), "n", "hash")
        out = one if out is None else out.unionByName(one)
    return out


def structural_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, repeats counted, with ``side``."""
    cols = sorted(a.columns)
    left, right = a.select(*cols), b.select(*cols)
    return left.exceptAll(right).withColumn("side", F.lit("first")).unionByName(right.exceptAll(left).withColumn("side", F.lit("second")))
