import numpy as np
import pytest
from riskloom.llm import token_counts as C
from riskloom.llm import tokens as K


def brute(ids, sep):
    out, start = [], 0
    for i in np.flatnonzero(ids == sep):
        out.append((len(out), start, int(i) - start, True))
        start = int(i) + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("block,group", [(2, 1), (6, 2), (64, 3), (1 << 18, 256)])
def test_any_blocks_give_the_plain_scan(spark, tmp_path, monkeypatch, block, group):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "GROUP", group)
    rng = np.random.RandomState(block)
    want = {}
    for name, n, share in (("a", 500, 0.1), ("b", 300, 0.9), ("c", 200, 0), ("d", 0, 0), ("e", 1, 1), ("f", 400, 0.01)):
        ids = np.where(rng.rand(n) < share, C.SEPARATOR, rng.randint(0, 50000, n)).astype(">u2")
        ids.tofile(tmp_path / name)
        want[name] = brute(ids, C.SEPARATOR)
    got = {}
    for r in C.count_tokens(spark, str(tmp_path)).collect():
        got.setdefault(r["file"].rpartition("/")[2], []).append((r["ordinal"], r["start"], r["n_tokens"], r["closed"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_sizes_are_checked(spark, tmp_path):
    np.zeros(3, np.uint8).tofile(tmp_path / "x")
    with pytest.raises(ValueError):
        C.count_tokens(spark, str(tmp_path))


def test_documents(spark, odd, empty, tmp_path):
    df_path = str(tmp_path / "odd")
    odd.select("doc_id", "text", "size").write.parquet(df_path)
    df = spark.read.parquet(df_path)
    encode = K.encoder(K.vocabulary(spark).value)
    want = sorted((str(r["doc_id"]), len(encode(r["text"] or ""))) for r in df.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in C.document_tokens(df).collect()) == want
    empty.select("doc_id", "text").write.parquet(str(tmp_path / "empty"))
    assert C.document_tokens(spark.read.parquet(str(tmp_path / "empty"))).count() == 0


def test_rows_in_other_places_raise_or_count_right(spark, table, tmp_path):
    rows = [(i, "a word " * (i % 17)) for i in range(400)] + [(None, "none"), (7, "twice"), (7, "twice"), (3, None)]
    table(rows).selectExpr("doc_id", "text", "1 as n_tokens", "2 as part", "'x' as start").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    encode = K.encoder(K.vocabulary(spark).value)
    want = sorted((str(i), len(encode(t or ""))) for i, t in rows)
    for frame in (df, df.where("doc_id is null or doc_id % 2 = 0 or doc_id % 2 = 1"), df.orderBy("doc_id"), df.repartition(7)):
        try:
            got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in C.document_tokens(frame).collect())
        except ValueError as e:
            assert frame is not df and "other places" in str(e)
        else:
            assert got == want


def test_a_frame_that_changes_raises(spark, table):
    from pyspark.sql import functions as F
    noise = F.udf(lambda: __import__("random").SystemRandom().random(), "double").asNondeterministic()
    df = table([(i, "a word " * (i % 17)) for i in range(300)]).repartition(3).withColumn("r", noise()).sort("r")
    with pytest.raises(ValueError, match="other places"):
        C.document_tokens(df)
