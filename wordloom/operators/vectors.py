"""uint8 affine quantisation of a vector table (Q1–Q2), re-aimed from the
model-weight export: one global min/max pass (partial aggregates, one row),
then a row-local ``transform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quant_params(df: DataFrame, col: str = "embedding") -> DataFrame:
    """One row ``(scale, zero_point)``; the range is widened to contain 0."""
    # per-row extremes, then a global partial aggregate: no explode of elements
    mm = df.agg(
        F.min(F.array_min(col).cast("double")).alias("lo"),
        F.max(F.array_max(col).cast("double")).alias("hi"),
    )
    lo = F.least(F.col("lo"), F.lit(0.0))
    hi = F.greatest(F.col("hi"), F.lit(0.0))
    scale = F.when(hi > lo, (hi - lo) / F.lit(255.0)).otherwise(F.lit(1.0))
    return mm.select(scale.alias("scale"), lo.alias("_lo")).select(
        "scale", F.floor(-F.col("_lo") / F.col("scale") + F.lit(0.5)).cast("int").alias("zero_point")
    )


def quantise_uint8(df: DataFrame, col: str = "embedding", out: str = "q") -> DataFrame:
    """Q1: ``q = clamp(floor(x / scale + 0.5) + zp, 0, 255)`` for every element.
    The parameters are one row, taken as a scalar subquery."""
    params = quant_params(df, col).select(F.struct("scale", "zero_point").alias("p")).scalar()
    joined = df.withColumn("_qp", params).select("*", "_qp.scale", "_qp.zero_point").drop("_qp")
    q = F.transform(
        col,
        lambda x: F.least(
            F.lit(255),
            F.greatest(F.lit(0), (F.floor(x.cast("double") / F.col("scale") + F.lit(0.5)) + F.col("zero_point")).cast("int")),
        ).cast("int"),
    )
    return joined.withColumn(out, q)


def dequantise(q, scale="scale", zp="zero_point"):
    return F.transform(F.col(q), lambda v: (v - F.col(zp)).cast("double") * F.col(scale))


def quantise_report(qdf: DataFrame, col: str = "embedding", q: str = "q") -> DataFrame:
    """Q2: bytes before/after and the reconstruction error (<= scale / 2)."""
    pairs = qdf.select(
        "scale",
        F.explode(F.arrays_zip(F.col(col).alias("x"), dequantise(q).alias("y"))).alias("p"),
    )
    err = F.abs(F.col("p.x").cast("double") - F.col("p.y"))
    return pairs.agg(
        F.count(F.lit(1)).alias("n_values"),
        (F.count(F.lit(1)) * 4).alias("bytes_float32"),
        F.count(F.lit(1)).alias("bytes_uint8"),
        F.max(err).alias("max_abs_err"),
        F.avg(err).alias("mean_abs_err"),
        F.max(F.col("scale") / 2).alias("half_scale"),
    )
