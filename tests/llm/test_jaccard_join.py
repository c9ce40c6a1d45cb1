import random

import numpy as np
import pyarrow as pa
import pytest
from riskloom.llm import jaccard_join as J


def brute(rows, k=5, percent=80):
    """{row number: (size, component id)} over (id, text) rows."""
    def shingles(text):
        lower = (text or "").encode().lower()
        w = lower.split()
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j]:
                both = len(a & sets[j])
                if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            groups.setdefault(find(i), []).append(doc_id)
    return sorted(((d, len(sets[i]), min(groups.get(find(i), [None])) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def edited(rng, words, text, share):
    return " ".join(rng.choice(words) if rng.random() < share else w for w in text.split())


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect()), key=str)


@pytest.mark.parametrize("short", [64, 2])
def test_components_match_brute_force(table, words, sentence, monkeypatch, short):
    # long lists, and blocks of them, are the same search as short ones
    monkeypatch.setattr(J, "SHORT", short)
    if short == 2:
        monkeypatch.setattr(J, "LIST_BLOCK", 7)
    rng, rows = random.Random(8), []
    passage = sentence(50, 99)
    for family in range(6):
        base = sentence(rng.randint(40, 160), 100 + family)
        rows += [edited(rng, words, base, rng.choice([0, 0.01, 0.02, 0.04, 0.06])) for _ in range(14)]
    rows += [passage + " " + sentence(rng.randint(3, 12), 300 + i) for i in range(25)]
    rows += [sentence(rng.randint(1, 60), 500 + i) for i in range(40)]
    rng.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    assert got(table(rows)) == brute(rows)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert got(odd) == brute(rows)
    assert got(empty) == []


def test_one_row_of_each_component_stays(odd, empty):
    kept = J.one_per_component(odd)
    assert kept.schema == odd.schema
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect())
    # 1 and its copies (2, 2, null) leave 1; texts without words stay; 8 and 9 are one
    assert [i for none, i in ids if not none] == [1, 3, 4, 5, 6, 7, 8, 10, 11, 12]
    assert sum(none for none, _ in ids) == 1
    assert J.one_per_component(empty).count() == 0


def test_a_batch_of_texts_takes_bounded_memory_in_a_worker():
    """Slices of 2 MB took 81 MB of a worker here, 256 KB take 12."""
    import inspect
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from riskloom.llm import arrowtext as T
    from riskloom.llm.state import prepare
    assert inspect.signature(prepare).parameters["size"].default == "2m"
    rng = np.random.default_rng(1)
    column = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 5000, 300)) for _ in range(1500)])
    tracemalloc.start()
    n = sum(len(s) for _, _, data, offsets in T.chunks(column) for s in T.shingle_sets(data, offsets, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 400_000 and peak < 30e6


def test_texts_without_a_partner_are_not_shuffled(spark, table, sentence):
    """Texts that no other row shares or links with pass straight through; the odd rows among them are settled as before."""
    alone = [(i, sentence(400, 20_000 + i)) for i in range(120)]
    twice = [(500, sentence(400, 30_000)), (501, sentence(400, 30_000) + " end"), (502, sentence(400, 30_001)), (502, sentence(400, 30_001))]
    odd_ids = [(None, sentence(400, 30_002)), (None, sentence(400, 30_003)), (None, sentence(400, 30_003)), (600, None)]
    docs = table(alone + twice + odd_ids)
    kept = J.one_per_component(docs).cache()
    ids = sorted((r[0] is None, r[0] or 0) for r in kept.select("doc_id").collect())
    assert ids == [(False, i) for i in range(120)] + [(False, i) for i in (500, 502, 600)] + [(True, 0)] * 2
    assert kept.distinct().count() == kept.count()

    at = spark.sparkContext.broadcast(np.zeros(1 << 4, np.uint64))
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in alone])], names=["text"])
    (out,) = J._with_class(5, 0, at)(iter([batch]))
    assert out.column(1).null_count == len(alone)
