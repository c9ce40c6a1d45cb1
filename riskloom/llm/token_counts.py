"""Token counts of the documents in flat token files, which have no index: a separator scan.

A file is a row of fixed-width ids; each document ends with the end-of-document id.  Files are read by
Spark (``binaryFile``) and cut into blocks of ``BLOCK`` bytes; a task finds the separators of a block
with one vectorised comparison.  Documents that cross blocks are stitched by a prefix scan over block
summaries: tokens so far, separators so far, and the end of the last separator so far, first over groups of ``GROUP``
blocks, then within each group, so no task scans all blocks of a large file.

Ids are big-endian, the end-of-document id by default 0xC480.  That id is free in the vocabularies used here, and its two
bytes are one UTF-8 character, so that Spark's text writer, with that character as the line end, writes
exactly such a file, to any store that Spark writes to.

Defined results: tokens behind the last separator are a document of their own, ``closed`` false; a separator
right after another ends a document of no tokens (null or empty text is written so); an empty file
gives no rows; a file whose size is no multiple of the id width raises an error, as does one above
``most_bytes`` (a task reads a file whole; write smaller shards).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.state import checkpoint_folder, cut, prepare
from riskloom.llm.tokens import VOCABULARY, encode_column, encoder, vocabulary

SEPARATOR = 0xC480  #: as big-endian bytes: U+0100
BLOCK = 1 << 18
GROUP = 256
MOST_BYTES = 1 << 30


def _encode(tokens):
    schema = pa.schema([("ids", pa.binary())])

    def run(batches):
        encode = encoder(tokens.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in encode_column(encode, batch.column(0), ">u2")], pa.binary())],
                                             schema=schema)

    return run


def write_tokens(docs: DataFrame, folder: str, text_col: str = "text", path: str = VOCABULARY) -> None:
    """One flat file per partition of ``docs``, documents in the partition's order."""
    spark = docs.sparkSession
    prepare(spark, rows=1000, size="4m")
    tokens = vocabulary(spark, path)
    if len(tokens.value) > SEPARATOR:
        raise ValueError("write_tokens: the separator is an id of the vocabulary")
    (docs.select(F.col(text_col).cast("string")).mapInArrow(_encode(tokens), "ids binary")
     .select(F.col("ids").cast("string")).write.option("lineSep", chr(0x100)).mode("error").text(folder))


def _scan(separator: int, dtype: str):
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("ends", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            sizes, ends = [], []
            for block in batch.column(2):
                ids = np.frombuffer(block.as_buffer(), dtype)
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == separator).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                              pa.array(ends, pa.list_(pa.int32()))], schema=schema)

    return run


def _before(df: DataFrame, by: list[str], order: str, prefix: str) -> DataFrame:
    """Adds, from the earlier rows: tokens, separators, and the place behind the last separator (relative to the scan's start)."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = (df.withColumn(f"{prefix}_at", F.coalesce(F.sum("n").over(w), F.lit(0)))
          .withColumn(f"{prefix}_docs", F.coalesce(F.sum("seps").over(w), F.lit(0))))
    return df.withColumn(f"{prefix}_last", F.max(F.col(f"{prefix}_at") + F.col("last")).over(w))


def count_tokens(spark: SparkSession, path: str, separator: int = SEPARATOR, dtype: str = ">u2",
                 most_bytes: int = MOST_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in the files under ``path``."""
    prepare(spark)
    width = np.dtype(dtype).itemsize
    files = spark.read.format("binaryFile").load(path)
    bad = files.where((F.col("length") > most_bytes) | (F.col("length") % width != 0)).select("path", "length").first()
    if bad is not None:
        raise ValueError(f"count_tokens: {bad['path']} has {bad['length']} bytes; at most {most_bytes}, a multiple of {width}")
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / BLOCK).cast("int")),
                        lambda b: F.substring("content", b * BLOCK + 1, F.lit(BLOCK)))
    blocks = cut(files.where(F.col("length") > 0).select(F.col("path").alias("file"), F.posexplode(parts).alias("block", "bytes"))
                 .select("file", F.col("block").cast("long"), "bytes")
                 .mapInArrow(_scan(separator, dtype), "file string, block long, n long, ends array<int>"))
    one = blocks.select("file", "block", "n", F.floor(F.col("block") / GROUP).alias("group"), F.size("ends").cast("long").alias("seps"),
                        F.when(F.size("ends") > 0, F.element_at("ends", -1).cast("long") + 1).alias("last"))
    inner = _before(one, ["file", "group"], "block", "b")
    groups = (inner.groupBy("file", "group").agg(F.max(F.col("b_at") + F.col("last")).alias("last"), F.sum("n").alias("n"),
                                                 F.sum("seps").alias("seps")))
    outer = _before(groups, ["file"], "group", "g")
    joined = (inner.join(outer.select("file", "group", "g_at", "g_docs", "g_last"), ["file", "group"])
              .select("file", "block", (F.col("g_at") + F.col("b_at")).alias("at"), (F.col("g_docs") + F.col("b_docs")).alias("docs"),
                      F.coalesce(F.col("g_at") + F.col("b_last"), F.col("g_last"), F.lit(0)).alias("open")))
    rows = blocks.join(joined, ["file", "block"]).where(F.size("ends") > 0).select(
        "file", "at", "docs", "open", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("at") + F.element_at("ends", F.greatest("i", F.lit(1))) + 1)
    closed = rows.select("file", (F.col("docs") + F.col("i")).alias("ordinal"), start.alias("start"),
                         (F.col("at") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    tails = (groups.groupBy("file").agg(F.sum("n").alias("n"), F.sum("seps").alias("ordinal"))
             .join(outer.groupBy("file").agg(F.coalesce(F.max(F.col("g_at") + F.col("last")), F.lit(0)).alias("start")), "file")
             .where("n > start").select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")))
    return closed.union(tails)


def document_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """(id, n_tokens, file, start) of every row of ``docs``, by way of flat token files in the checkpoint folder.

    Rows are matched to documents by partition and place: partition p is written as file ``part-p``, in order.  The places
    come from a second read; a checksum over id, text and place, taken in the job that writes and again here, must be the
    same, or an error is raised: a frame that a rerun deals anew (a round-robin ``repartition``) should be written first.
    Repeated rows and null ids are rows of their own; a null text has no tokens; other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = f"{checkpoint_folder(spark)}/llm-tokens-{uuid.uuid4().hex}"
    placed = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .withColumn("part", F.spark_partition_id())
              .withColumn("ordinal", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
              .withColumn("mark", F.xxhash64("id", "text", "part", "ordinal")))
    sums = [F.count("*").alias("rows"), F.bit_xor("mark").alias("marks")]
    written = Observation()
    write_tokens(placed.observe(written, *sums), folder, "text", path)
    counted = cut(count_tokens(spark, folder).withColumn("part", F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).cast("int")))
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(files, True)  # its own files only
    ids = cut(placed.select("id", "part", "ordinal", "mark", F.length("text").alias("chars")))
    if ids.agg(*sums).first().asDict() != written.get:
        raise ValueError("document_tokens: the rows were in other places when read again; write the table and read it back first")
    return ids.join(counted, ["part", "ordinal"], "left").select(
        F.col("id").alias(id_col), F.col("n_tokens"), "chars", "part", "start")
