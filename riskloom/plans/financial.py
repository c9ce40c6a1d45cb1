"""Q8 / Q9: loan-term and implied-rate blocks.

TERM (B26) = half-even rounded credit / annuity (missing or non-finite -> 0);
INTEREST_RATE (B28) and RATE_CREDIT / RATE_GOODS (B27) solve the level-annuity
equation with the fixed-step bisection expression of ``annuity_rate`` — a
per-row Catalyst expression instead of the reference's row loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import annuity_rate, bround_int, ieee_div
from ..session import cut_lineage, level

ID = "SK_ID_CURR"


def financial_block(app: DataFrame) -> DataFrame:
    """Q8: (id, TERM, INTEREST_RATE)."""
    term = bround_int(ieee_div("AMT_CREDIT", "AMT_ANNUITY", "inf"), 0)
    d = app.select(ID, "AMT_CREDIT", "AMT_ANNUITY", term.alias("TERM"))
    return d.select(ID, "TERM", annuity_rate("TERM", "AMT_ANNUITY", "AMT_CREDIT").alias("INTEREST_RATE"))


def term_features(df: DataFrame, zero: str = "null") -> DataFrame:
    """screwratio1/2, saint_CNT, angel_CNT, simple_diff."""
    c = F.col
    return df.select(
        "*",
        ieee_div(c("AMT_CREDIT") - c("AMT_GOODS_PRICE"), "AMT_GOODS_PRICE", zero).alias("screwratio1"),
        ieee_div(c("AMT_CREDIT") - c("AMT_GOODS_PRICE"), "AMT_CREDIT", zero).alias("screwratio2"),
        ieee_div("AMT_CREDIT", "AMT_ANNUITY", zero).alias("saint_CNT"),
        ieee_div("AMT_GOODS_PRICE", "AMT_ANNUITY", zero).alias("angel_CNT"),
        (c("AMT_CREDIT") - c("AMT_GOODS_PRICE")).alias("simple_diff"),
    )


TERM_FEATURES = ["saint_CNT", "AMT_ANNUITY", "angel_CNT", "AMT_GOODS_PRICE", "screwratio2", "screwratio1",
                 "AMT_CREDIT", "simple_diff"]


def rebuilt_term_block(prev: DataFrame, app: DataFrame, num_trees: int = 30, max_depth: int = 8,
                       seed: int = 42) -> DataFrame:
    """Q9 (L13 + B41 + B42 + B27): learn the loan term of prior applications from
    amounts, score applications, keep class probabilities, best guess,
    certainty = sum of squared probabilities, and implied rates on credit and goods.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    past = prev.where(F.col("CNT_PAYMENT").isNotNull()).select(
        ID, "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", F.col("CNT_PAYMENT").cast("int").alias("CNT_PAYMENT"))
    tr = term_features(level(past))  # a forest goes over its parts a dozen times
    # same fill on both sides (reference bug: scored rows were left unfilled)
    tr = tr.fillna(-1.0, subset=TERM_FEATURES)
    sc = term_features(app).fillna(-1.0, subset=TERM_FEATURES)
    idx = StringIndexer(inputCol="_term", outputCol="_label", stringOrderType="alphabetAsc").fit(
        past.select(F.col("CNT_PAYMENT").cast("string").alias("_term")))
    labels = [int(x) for x in idx.labels]
    va = VectorAssembler(inputCols=TERM_FEATURES, outputCol="_f", handleInvalid="keep")
    train = va.transform(idx.transform(tr.withColumn("_term", F.col("CNT_PAYMENT").cast("string"))))
    # read for the class count, the splits and the bagged points
    model = RandomForestClassifier(featuresCol="_f", labelCol="_label", numTrees=num_trees, maxDepth=max_depth,
                                   seed=seed).fit(cut_lineage(train.select("_label", "_f")))
    scored = model.transform(va.transform(sc)).select(ID, "AMT_ANNUITY", "AMT_CREDIT", "AMT_GOODS_PRICE",
                                                       vector_to_array("probability").alias("_p"))
    return implied_rates(scored, labels)


def implied_rates(scored: DataFrame, terms: list[int], probabilities: str = "_p") -> DataFrame:
    """B41, B42, B27 of rows with an array of class probabilities, one for each of ``terms``: the likeliest term,
    the sum of squared probabilities, and the rates that the term implies on credit and goods."""
    lab = F.array(*[F.lit(x) for x in terms])
    # equal probabilities: the smallest term wins
    best = -F.array_max(F.arrays_zip(F.col(probabilities).alias("p"), F.transform(lab, lambda t: -t).alias("t")))["t"]
    cert = F.aggregate(F.col(probabilities), F.lit(0.0), lambda a, x: a + x * x)
    out = scored.select(ID, "AMT_ANNUITY", "AMT_CREDIT", "AMT_GOODS_PRICE",
                        best.alias("REBUILT_CNT"), cert.alias("CERTAINTY"))
    return out.select(ID, "REBUILT_CNT", "CERTAINTY",
                      annuity_rate("REBUILT_CNT", "AMT_ANNUITY", "AMT_CREDIT").alias("RATE_CREDIT"),
                      annuity_rate("REBUILT_CNT", "AMT_ANNUITY", "AMT_GOODS_PRICE").alias("RATE_GOODS"))
