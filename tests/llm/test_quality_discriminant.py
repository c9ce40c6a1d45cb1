import random
import zlib

import numpy as np

from riskloom.llm import quality_discriminant as Q


def rows(sentence, n=500):
    rng, out, labels = random.Random(4), [], []
    for i in range(n):
        text, bad = sentence(rng.randint(40, 300), 900 + i), rng.random() < 0.2
        if bad:
            words = text.split()
            text = rng.choice((" | ".join(words), " ".join(w + rng.choice(("###", "$$$")) for w in words), "the " * len(words),
                               " ".join(w.upper() + "!!" for w in words)))
        out.append((i, text))
        labels.append((i, int(not bad), 0))
    return out, labels


def scored(docs, labels):
    return {r["doc_id"]: r["score"] for r in Q.quality_scores(docs, labels).collect()}


def test_held_out_accuracy_and_labels_that_are_not_read(spark, table, sentence):
    docs, labels = rows(sentence)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = scored(table(docs), told)
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 100 and sum((got[i] >= 0.5) == bool(labels[i][1]) for i in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in got.values())
    flipped = spark.createDataFrame([(i, 1 - q if i in set(held) else q, t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    same = scored(table(docs).repartition(7), flipped)
    assert max(abs(got[i] - same[i]) for i in got) < 1e-6
    # lang, source and id of a row are no inputs
    moved = scored(table([(i, t, "zz", "other") for i, t in docs]), told)
    assert max(abs(got[i] - moved[i]) for i in got) < 1e-6


def test_against_densities_written_out():
    rng = np.random.default_rng(3)
    d = 5
    x = [rng.normal(c, 1 + c, (300, d)) @ rng.normal(0, 1, (d, d)) for c in (0, 1)]
    moments = np.stack([np.column_stack([np.ones(300), a]).T @ np.column_stack([np.ones(300), a]) for a in x])
    model = Q.discriminant(moments, 0.25, 0.1)
    shared = (np.cov(x[0].T, bias=True) + np.cov(x[1].T, bias=True)) / 2
    scale = np.sqrt(np.diag(shared))
    tests = rng.normal(0, 3, (50, d))
    logs = []
    for a in x:
        cov = 0.75 * np.cov((a / scale).T, bias=True) + 0.25 * shared / np.outer(scale, scale)
        cov = 0.9 * cov + 0.1 * np.trace(cov) / d * np.eye(d)
        left = tests / scale - (a / scale).mean(axis=0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", left, np.linalg.inv(cov), left) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.log_odds(tests), logs[1] - logs[0])


def test_statistics_of_rows_stand_alone():
    texts = ["One two two.\nOne two two.\n", "", "  ", "ÉÉ ## 12", "word " * 40]
    data = [t.encode() for t in texts]
    together = Q.statistics(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(x) for x in data]))
    for i, x in enumerate(data):
        assert np.allclose(together[i], Q.statistics(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[0])
    at = dict(zip(Q.STATISTICS, together[0]))
    assert np.isclose(at["words"], np.log(7)) and np.isclose(at["top_word"], np.sqrt(2 / 11)) and np.isclose(at["distinct_words"], np.log(4 / 7))
    assert np.isclose(at["repeated_lines"], np.sqrt(1 / 4)) and np.isclose(at["newline"], np.sqrt(2 / 11)) and at["unlettered_ends"] == 0


def test_odd_rows(spark, odd, empty):
    told = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, None, 0), (6, 1, None), (None, 1, 1), (7, 0, 0), (12, 0, 0), (3, 2, 0)],
                                 "doc_id long, quality int, toxic int")
    got = Q.quality_scores(odd, told).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert Q.quality_scores(empty, told).count() == 0
    assert {r["score"] for r in Q.quality_scores(odd, told.limit(0)).collect()} == {0.5}
    assert all(r["score"] > 0.99 for r in Q.quality_scores(odd, told.where("quality = 1")).collect())
