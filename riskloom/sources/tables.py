"""Scans and sinks.

Parquet is the default format (column pruning + predicate pushdown reach the
scan).  CSV is read with an explicit schema — never ``inferSchema`` at scale,
which costs a full extra pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import nan_to_null


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             key_types: dict[str, str] | None = None) -> DataFrame:
    """A1/A2: CSV scan with a header.

    ``schema`` pins every column (preferred).  Without it the frame is read as
    strings and ``key_types`` casts the listed keys (e.g. ``{"SK_ID_CURR": "long"}``)
    while numeric-looking columns stay for the caller to cast — no inference pass.
    """
    r = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        df = r.schema(schema).csv(path)
    else:
        df = r.csv(path)
    if key_types:
        df = df.select(*[F.col(c).cast(key_types[c]).alias(c) if c in key_types else F.col(c)
                         for c in df.columns])
    return nan_to_null(df)


def read_predictions(spark: SparkSession, path_glob: str, id_col: str = "SK_ID_CURR",
                     pred_col: str = "TARGET", model_regex: str = r"([^/]+)\.[^./]+$",
                     fmt: str = "csv", schema: str | None = None) -> DataFrame:
    """A5: ONE wildcard scan of many prediction files -> long table (id, model, pred).

    The model name comes from the file path via ``_metadata.file_path``; no
    driver-side loop over files.
    """
    if fmt == "csv":
        sch = schema or f"{id_col} long, {pred_col} double"
        df = spark.read.option("header", True).schema(sch).csv(path_glob)
    else:
        df = spark.read.parquet(path_glob)
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_extract(F.col("_metadata.file_path"), model_regex, 1).alias("model"),
        F.col(pred_col).cast("double").alias("pred"),
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> None:
    """Sink of feature / prediction / report tables (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def id_base(df: DataFrame, id_col: str = "SK_ID_CURR") -> DataFrame:
    """Distinct id base table."""
    return df.select(id_col).distinct()


def minimal_base(app: DataFrame, id_col: str = "SK_ID_CURR", target: str = "TARGET",
                 split: str = "split") -> DataFrame:
    """Id + split + TARGET."""
    return app.select(id_col, split, target)
