import random

import numpy as np
import pytest
from riskloom.llm import decontaminate as D


def distance(item, text):
    """Plain fitting edit distance on words."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_fit_is_the_plain_distance_and_span():
    rng = random.Random(3)
    for _ in range(200):
        item = [rng.randint(1, 5) for _ in range(rng.randint(1, 9))]
        text = [rng.randint(1, 5) for _ in range(rng.randint(1, 20))]
        d, a, b = D.fit(np.array(item, np.uint64), np.array(text, np.uint64))
        assert d == distance(item, text)
        whole = distance(item, text[a:b]) if b > a else len(item)
        assert whole == d


def test_matches_against_brute_force(spark, table, words, sentence):
    rng = random.Random(11)
    items = [(i, sentence(rng.randint(8, 50), 1000 + i)) for i in range(20)]
    docs, edits = [], []
    for i in range(240):
        text = sentence(rng.randint(20, 120), 2000 + i).split()
        if i % 2:
            w = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, len(w) * 20 // 100)):
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + [rng.choice(words)] + w[p + 1:], w[:p] + w[p + 1:], w[:p] + [rng.choice(words)] + w[p:]])
            p = rng.randrange(len(text))
            text[p:p] = w
        docs.append((i, " ".join(text).upper() if i % 3 == 0 else " ".join(text)))
    want = {}
    for d, t in docs:
        for i, x in items:
            k = distance(x.split(), t.lower().split())
            if k <= D.allowed(len(x.split()), 80):
                want[d, i] = k
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in D.contaminated(table(docs), bench).collect()}
    assert all(want.get(k) == v for k, v in got.items())           # nothing but true matches
    assert len(got) >= 0.9 * len(want) and len(want) > 100         # recall
    exact = {k for k, v in want.items() if v == 0}
    assert exact <= set(got)
    blocks = {(r["doc_id"], r["item_id"]) for r in D.contaminated(table(docs), bench, block=7).collect()}
    assert exact <= blocks
    kept = {r["doc_id"] for r in D.without_contaminated(table(docs), bench).collect()}
    assert kept & {d for d, _ in exact} == set() and {d for d, _ in docs} - {d for d, _ in want} <= kept


def test_odd_rows(spark, odd, empty, sentence):
    bench = spark.createDataFrame([(1, sentence(60, 1)), (1, sentence(60, 1)), (2, None), (3, ""), (None, sentence(60, 2)), (4, "one two")],
                                  "item_id long, text string")
    found = sorted((str(r["doc_id"]), str(r["item_id"])) for r in D.contaminated(odd, bench).collect())
    assert found == [("1", "1"), ("2", "1"), ("2", "1"), ("6", "None"), ("8", "4"), ("9", "4"), ("None", "1")]
    assert D.without_contaminated(odd, bench).count() == odd.count() - 5
    assert D.without_contaminated(odd, bench, shortest=1).count() == odd.count() - 7
    assert D.contaminated(empty, bench).count() == 0
    assert D.contaminated(odd, bench.limit(0)).count() == 0 and D.without_contaminated(odd, bench.limit(0)).count() == odd.count()


def test_short_items_are_exact_runs(spark, table, words):
    rng = random.Random(4)
    few = words[:12]
    items = [(f"i{n}", " ".join(rng.choice(few) for _ in range(n % 7 + 1))) for n in range(30)]
    docs = [(i, " ".join(rng.choice(few) for _ in range(i % 40)).upper()) for i in range(80)]
    want = {}
    for d, t in docs:
        w = t.lower().split()
        for i, x in items:
            x = x.split()
            places = [k for k in range(len(w) - len(x) + 1) if w[k:k + len(x)] == x]
            if places:
                want[d, i] = (0, len(x), places[0], places[0] + len(x) - 1)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = D.contaminated(table(docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]): (r["distance"], r["item_words"], r["first_word"], r["last_word"]) for r in got} == want
    assert len(got) == len(want)


def test_recall_where_no_gram_need_be_shared(spark, table, words, sentence):
    """Ten words at 70 %: three spread edits leave no 3-word gram."""
    rng = random.Random(6)
    items = [(i, sentence(10, 3000 + i)) for i in range(30)]
    docs = []
    for i in range(150):
        w = items[i % 30][1].split()
        for p in (2, 5, 8):
            w[p] = f"other{rng.randrange(10**6)}"
        docs.append((i, " ".join(sentence(30, 4000 + i).split() + w + sentence(30, 5000 + i).split())))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(table(docs), bench, percent=70).collect()}
    assert len(got & {(i, i % 30) for i in range(150)}) >= 0.9 * 150


def test_missed_target_is_an_error(sentence):
    items = [D._words(sentence(10, i)) for i in range(20)]
    with pytest.raises(ValueError):
        D.Index(list(range(20)), items, 30, 8, 0.999)
