import random

import numpy as np
from riskloom.llm import packing as P
from riskloom.llm import tokens as K


def test_best_fit_is_best_fit():
    rng = random.Random(1)
    for length in (1, 7, 16, 100):
        sizes = np.array([rng.randint(1, length) for _ in range(300)])
        rooms, want = [], []
        for i in np.argsort(-sizes, kind="stable"):
            fit = [r for r in rooms if r >= sizes[i]]
            room = min(fit) if fit else length
            if fit:
                rooms.remove(room)
            else:
                want.append(room)
            rooms.append(room - sizes[i])
        rows = P.best_fit(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(300)) and len(rows) == len(want)
        assert sorted(length - sum(sizes[i] for i in r) for r in rows) == sorted(rooms)


def unpack(rows, eod, length):
    parts = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == length and r["cu_seqlens"][-1] == r["n_tokens"] and (ids[r["n_tokens"]:] == eod).all()
        assert r["position_resets"] == r["cu_seqlens"][:-1]
        where = P.position_ids(r, length)
        for a, b, d, o in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["doc_ids"], r["doc_offsets"]):
            assert (where[a:b] == np.arange(b - a)).all()
            parts.setdefault(d, []).append((o, ids[a:b]))
    return {d: np.concatenate([x for _, x in sorted(v, key=lambda x: x[0])]) for d, v in parts.items()}


def test_texts_come_back(spark, odd, empty, tmp_path):
    tokens = K.vocabulary(spark).value
    for length, window in ((64, 500), (2048, P.WINDOW)):
        df = odd.where("doc_id <> 2 and doc_id is not null")
        packed = P.pack(df, length=length, window=window)
        P.write_packed(packed, str(tmp_path / f"packed{length}"))
        rows = spark.read.parquet(str(tmp_path / f"packed{length}")).collect()
        back = unpack(rows, len(tokens), length)
        for d in df.select("doc_id", "text").collect():
            if d["text"]:
                assert back[d["doc_id"]][-1] == len(tokens)
                assert K.decode(tokens, back[d["doc_id"]][:-1]) == d["text"]
            else:
                assert d["doc_id"] not in back
    assert sum(r["doc_ids"].count(2) for r in P.pack(odd).collect()) == 2  # repeated rows
    assert P.pack(empty).count() == 0
    assert sorted(map(str, P.pack(odd).collect())) == sorted(map(str, P.pack(odd).collect()))
