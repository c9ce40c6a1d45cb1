"""URL rules as a sort-merge range join over reversed-host keys.

A host becomes its labels in reverse, each ended by the byte 0x01 (``www.example.org`` ->
``org\\1example\\1www\\1``), so a rule's host and all its subdomains are one interval of keys: from
the rule's key to the same key with its last byte raised.  Intervals of rules nest or are disjoint.

Pages are dealt to tasks by ranges of (key, salt); cuts come from a sample of bounded size and only
affect balance, so a host with a third of all pages is parted like any other range.  A rule goes to
each range that it overlaps.  Within a range, rules and pages are sorted by key and swept once: a
stack holds the rules whose intervals are open, each nested in the one below, and a page tests the
path prefixes of the rules on the stack.

The longest rule wins (host and path characters); between equals the longer host, then block.
Pages that no rule fits get the default verdict.

Defined results: null url or none with ``://``: host and path empty and the default verdict (a rule
with an empty host fits no page); repeated pages are judged each; empty tables are fine.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.state import prepare, smallest_hashes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "\x01"
SAMPLE = 20_000  #: keys that the cuts are made from, at most


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    parts = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(parts, END), F.lit(END)))


def _after(key: Column) -> Column:
    """The first key behind all keys that begin with ``key``."""
    return F.concat(key.substr(F.lit(1), F.length(key) - 1), F.lit("\x02"))


def _cuts(keyed: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """Up to ``ranges - 1`` ascending (key, salt) bounds from a hash sample of at most SAMPLE rows."""
    rows = keyed.count()
    some = smallest_hashes(keyed.select("key", "salt"), F.xxhash64("salt", "key"), ["key", "salt"], rows, SAMPLE).collect()
    some = sorted((r["key"].encode(), r["salt"]) for r in some)
    return sorted({some[len(some) * i // ranges] for i in range(1, ranges)}) if some else []


def _deal(cuts):
    """Appends first_slot and last_slot of each row's [key, salt] to [until, last_salt]."""
    def run(batches):
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("key", "salt", "until", "last_salt")}
            first = [bisect.bisect_right(cuts, (k.encode(), s)) for k, s in zip(cols["key"], cols["salt"])]
            last = [bisect.bisect_right(cuts, (k.encode(), s)) for k, s in zip(cols["until"], cols["last_salt"])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                                             names=[*batch.schema.names, "first_slot", "last_slot"])
    return run


def _sweep(batches):
    """Over rows sorted by (slot, key, kind): the judged pages."""
    slot, stack = None, []  # of (until, host, path prefix, rule, block)
    for batch in batches:
        won, names = [], ("slot", "key", "until", "kind", "rule", "block", "host", "path")
        for s, key, until, kind, rule, block, host, path in zip(*(batch.column(n).to_pylist() for n in names)):
            if s != slot:
                slot, stack = s, []
            while stack and stack[-1][0] <= key:
                stack.pop()
            if kind == 0:
                stack.append((until, host, path, rule, block))
                continue
            fits = [(len(h) + len(p), len(h), b, r) for _, h, p, r, b in stack
                    if path.startswith(p) and (host == h or host.endswith("." + h))]
            won.append(max(fits)[2:] if fits else (None, None))
        pages = batch.filter(pc.equal(batch.column("kind"), 1))
        yield pa.RecordBatch.from_arrays(
            [pages.column("page"), pages.column("host"), pages.column("path"), pa.array([w[1] for w in won], pa.string()),
             pa.array([w[0] for w in won], pa.bool_())], names=["page", "host", "path", "rule", "block"])


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", ranges: int | None = None) -> DataFrame:
    """(id, host, path, rule, verdict) for every page; see the module text.

    ``rules`` has the columns host, path and block (boolean); a null host or path counts as empty.
    """
    spark: SparkSession = pages.sparkSession
    prepare(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(pages.select(F.col(id_col).alias("page")).dtypes)["page"]
    url, lowest = F.col(url_col).cast("string"), F.lit(-(1 << 63)).cast("long")
    none = lambda t: F.lit(None).cast(t)
    page_rows = (pages.select(F.col(id_col).alias("page"), host_of(url).alias("host"), path_of(url).alias("path"))
                 .withColumn("key", host_key(F.col("host"))).withColumn("salt", F.xxhash64("page", "path"))
                 .select("key", "salt", F.col("key").alias("until"), F.col("salt").alias("last_salt"), F.lit(1).alias("kind"),
                         none("string").alias("rule"), none("boolean").alias("block"), "host", "path", "page"))
    rule_rows = (rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
                              F.coalesce("path", F.lit("")).alias("path"), "block")
                 .where("host <> '' and block is not null").distinct().withColumn("key", host_key(F.col("host")))
                 .select("key", lowest.alias("salt"), _after(F.col("key")).alias("until"), lowest.alias("last_salt"),
                         F.lit(0).alias("kind"), F.concat("host", "path").alias("rule"), "block", "host", "path",
                         none(kind).alias("page")))
    cuts = _cuts(page_rows, ranges)
    schema = (f"key string, salt long, until string, last_salt long, kind int, rule string, block boolean, host string, "
              f"path string, page {kind}, first_slot int, last_slot int")
    swept = (page_rows.unionByName(rule_rows).mapInArrow(_deal(cuts), schema)
             .withColumn("slot", F.explode(F.sequence("first_slot", "last_slot")))
             .select("slot", "key", "until", "kind", "rule", "block", "host", "path", "page")
             .repartition(ranges, "slot").sortWithinPartitions("slot", "key", "kind", "rule")
             .mapInArrow(_sweep, f"page {kind}, host string, path string, rule string, block boolean"))
    verdict = F.when(F.col("block"), F.lit("block")).when(~F.col("block"), F.lit("allow")).otherwise(F.lit(default))
    return swept.select(F.col("page").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
