import math

import numpy as np
from riskloom.llm import mixing as M


def test_targets_by_hand():
    # weights 5, 2, 1 over sizes 100, 100, 100: 450 words; 281, 112, 56 -> first is full at 200, the rest 250 at 2:1
    t = M.cyclic_targets()(["b", None, "a"], [100, 100, 100])
    assert t[2] == 200.0 and math.isclose(t[0], 250 * 2 / 3) and math.isclose(t[1], 250 / 3)
    assert M.capped_shares([0, 10], [5, 2], 1.5, 2.0) == [0.0, 15.0]
    assert M.cyclic_targets()([], []) == []


def plain_rates(sizes, target, most=2.0, spare=0.5):
    """The same optimum by halving the multiplier over all documents."""
    size = np.array(sizes, float)
    z, lo, hi = size ** (1 - spare), -50.0, 50.0
    for _ in range(200):
        mid = (lo + hi) / 2
        rate = np.minimum(most, np.exp(np.minimum(mid * z, 50)))
        lo, hi = (mid, hi) if rate @ size < target else (lo, mid)
    return rate


def test_optimum_is_nearest_in_entropy(table, sentence):
    """No feasible change of rates has less divergence."""
    rows = [(i, sentence(5 + i * i % 120, i), "en", "a") for i in range(60)]
    got = M.mix(table(rows), targets=lambda names, sizes: [0.6 * s for s in sizes], spare=0.0).collect()
    size, rate = np.array([r["size"] for r in got], float), np.array([r["rate"] for r in got])
    kl = lambda r: float(np.sum(r * np.log(r) - r + 1))
    rng = np.random.RandomState(1)
    for _ in range(200):
        step = rng.normal(size=len(size))
        step -= size * (step @ size) / (size @ size)  # keeps the words taken
        other = rate + 0.02 * step / np.abs(step).max() * rate.min()
        assert kl(rate) <= kl(other) + 1e-12
    assert math.isclose(rate @ size, 0.6 * size.sum(), rel_tol=1e-9)


def test_heavy_lengths_and_odd_targets(table, sentence):
    rows = [(i, sentence(1 + i % 3, i), "en", "a") for i in range(300)] + [(1000, sentence(5000, 1), "en", "a"), (1001, None, "en", "a")]
    for share in (1e-4, 0.3, 1.0, 1.9, 1.999999, 2.0):
        got = M.mix(table(rows), targets=lambda names, sizes: [share * s for s in sizes]).collect()
        total = sum(r["size"] for r in got)
        assert math.isclose(sum(r["rate"] * r["size"] for r in got), share * total, rel_tol=1e-8)
        assert all(0 <= r["rate"] <= 2 and 0 <= r["copies"] <= 2 for r in got)
    assert {r["copies"] for r in got if r["size"]} == {2}
    none = M.mix(table(rows), targets=lambda names, sizes: [0.0 for _ in sizes]).collect()
    assert {r["copies"] for r in none} == {0}


def test_mix_meets_targets(table, sentence):
    rows = [(i, sentence(3 + i * 7 % 90, i), "en", ["a", "b", "c", None][i % 4]) for i in range(400)]
    df = table(rows)
    got = M.mix(df, block=50).collect()
    again = M.mix(df.repartition(7), block=50).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["copies"] <= 2 and r["size"] == len(rows[r["doc_id"]][1].split())
    want = M.cyclic_targets()(list(by), [sum(r["size"] for r in v) for v in by.values()])
    assert math.isclose(sum(want), 1.5 * sum(r["size"] for r in got))
    for (name, v), t in zip(by.items(), want):
        assert math.isclose(v[0]["target"], t) and v[0]["source_size"] == sum(r["size"] for r in v)
        for r, x in zip(v, plain_rates([r["size"] for r in v], t)):
            assert math.isclose(r["rate"], x, rel_tol=1e-6)
        assert math.isclose(sum(r["rate"] * r["size"] for r in v), t, rel_tol=1e-9)
        if 0 < t < 1.99 * v[0]["source_size"]:
            assert len({r["rate"] for r in v}) > 5  # by document, not by source
        assert abs(sum(r["copies"] * r["size"] for r in v) - t) <= 0.02 * t + 10


def test_odd_rows(odd, empty):
    got = M.mix(odd).collect()
    assert len(got) == odd.count() and all(r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    assert M.mix(empty).count() == 0 and M.mixed_documents(empty).count() == 0
    mixed = M.mixed_documents(odd)
    assert mixed.schema == odd.schema
    copies = {(r["doc_id"], r["size"]): r["copies"] for r in got}
    assert sum(r["doc_id"] == 7 for r in mixed.select("doc_id").collect()) == copies[7, 30_000]
