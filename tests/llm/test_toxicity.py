import random

import zlib

import numpy as np
from riskloom.llm import toxicity as X


def rows(sentence, n=400):
    rng, out, labels = random.Random(4), [], []
    for i in range(n):
        w = sentence(rng.randint(20, 300), 7000 + i).split()
        bad = rng.random() < 0.2
        if bad:
            for _ in range(max(2, len(w) // 50)):
                w.insert(rng.randrange(len(w)), rng.choice(["numbskull", "dunderhead", "blockhead"]))
        out.append((i, " ".join(w).upper() if i % 9 == 0 else " ".join(w)))
        labels.append((i, 1, int(bad)))
    return out, labels


def test_held_out_accuracy(spark, table, sentence):
    docs, labels = rows(sentence)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in X.toxicity(table(docs), told).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((got[i] >= 0.7) == bool(labels[i][2]) for i in held)
    assert len(held) > 80 and right >= 0.97 * len(held) and all(0 <= s <= 1 for s in got.values())
    # labels of held-out rows change nothing
    flipped = spark.createDataFrame([(i, q, 1 - t if i in set(held) else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    same = {r["doc_id"]: r["score"] for r in X.toxicity(table(docs), flipped).collect()}
    assert max(abs(got[i] - same[i]) for i in got) < 1e-9
    kept = X.without_toxic(table(docs), told)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i] < 0.7} and kept.schema == table([]).schema


def test_odd_rows(spark, odd, empty, sentence):
    told = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, None, 0), (6, 1, None), (None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    got = X.toxicity(odd, told).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert X.toxicity(empty, told).count() == 0 and X.without_toxic(empty, told).count() == 0
    none = X.toxicity(odd, told.limit(0)).collect()
    assert {r["score"] < 0.01 for r in none} == {True}


def test_rates_of_slices_are_those_of_the_whole(monkeypatch):
    texts = [b"abcabcabcabc \n xyz", b"", b"abc", b"hello world, hello world"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    whole = X._rates(data, offsets)
    for size in (1, 3, 7):
        monkeypatch.setattr(X, "CHUNK_BYTES", size)
        part = X._rates(data, offsets)
        assert all((a == b).all() for a, b in zip(whole, part))
    grams = sum(max(0, len(set(t[i:i + n] for i in range(len(t) - n + 1)))) for t in [bytes(x).replace(b"\n", b" ") for x in texts] for n in X.SIZES)
    assert len(whole[0]) == grams
