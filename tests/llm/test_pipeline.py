"""The pipeline on a small table with planted cases, each stage against a plain version on its own input."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C  # noqa: E402
from riskloom.llm import mixing as M  # noqa: E402
from riskloom.llm import tokens as K  # noqa: E402
from test_decontaminate import distance  # noqa: E402
from test_jaccard_join import brute  # noqa: E402

BAD = ["numbskull", "dunderhead", "blockhead"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, words, sentence):
    folder, rng = tmp_path_factory.mktemp("sf"), random.Random(6)
    items = [(i, sentence(rng.randint(12, 30), 8000 + i)) for i in range(5)]
    docs, labels = [], []
    for i in range(260):
        w = sentence(rng.randint(25, 120), 9000 + i).split()
        kind = i % 13
        if kind == 1:
            for _ in range(max(3, len(w) // 15)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        if kind == 2:
            w[5:5] = rng.choice(items)[1].split()
        if kind == 3:
            w = docs[-3][1].split() if i > 3 else w
        if kind == 4:
            w = [*docs[-2][1].split(), "end"]
        docs.append((i, " ".join(w), "en", f"s{i % 3}" if i % 7 else None, 1))
        labels.append((i, 1, int(any(b in w for b in BAD))))
    docs += [(None, sentence(40, 1), None, None, None), (900, None, "en", "s1", 0), (901, "", "en", "s1", 0), docs[0], docs[0]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items


def test_stages(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema, rows = docs.schema, docs.collect()
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, folder)
        if name != C.STAGES[-1][0]:
            assert out.schema == schema
        kept = out.collect()
        seen[name] = (rows, kept)
        if name != C.STAGES[-1][0]:
            rows, docs = kept, spark.createDataFrame(kept, schema)

    before, after = seen["toxicity"]
    clean = [r for r in before if not any(b in (r["text"] or "") for b in BAD)]
    assert sorted(map(str, after)) == sorted(map(str, clean)) and len(clean) < len(before)

    before, after = seen["ngram_jaccard_join"]
    groups = {c for d, n, c in brute([(r["doc_id"], r["text"]) for r in before]) if n}
    assert sorted(str(r["doc_id"]) for r in after if (r["text"] or "").split()) == sorted(map(str, groups))
    assert {900, 901} <= {r["doc_id"] for r in after} and len(after) < len(before)

    before, after = seen["benchmark_decontamination"]
    leaks = lambda r: any(distance(x.split(), (r["text"] or "").split()) <= len(x.split()) // 5 for _, x in items)
    assert sorted(map(str, after)) == sorted(str(r) for r in before if not leaks(r)) and len(after) < len(before)

    before, after = seen["entropy_mixing"]
    copies = {r["doc_id"]: r["copies"] for r in M.mix(spark.createDataFrame(before, schema)).collect()}
    assert sorted(map(str, after)) == sorted(str(r) for r in before for _ in range(copies[r["doc_id"]]))

    before, after = seen["token_packing"]
    encode = K.encoder(K.vocabulary(spark).value)
    assert sum(r["n_tokens"] for r in after) == sum(len(encode(r["text"])) + 1 for r in before if r["text"])
    sizes = {}
    for r in after:
        for d, a, b in zip(r["doc_ids"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            sizes[d] = sizes.get(d, 0) + b - a
    for d in sizes:
        assert sizes[d] == sum(len(encode(r["text"])) + 1 for r in before if r["doc_id"] == d)


def test_run_is_the_stages_in_a_row(spark, tables):
    folder, _ = tables
    out = C.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, folder)
    total = lambda df: df.agg(F.sum("n_tokens"), F.sum(F.size("doc_ids"))).first()
    assert total(out)[0] == total(docs)[0]


def test_empty_tables(spark, tables, tmp_path):
    folder, _ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
