import collections
import math
import random
import re

import numpy as np
from riskloom.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def check(df):
    texts = collections.defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        texts[r["doc_id"]].append(base(r["text"]))
    got = collections.defaultdict(list)
    for r in Q.quality(df).collect():
        got[r["doc_id"]].append(tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}


def test_base_counts_match_plain_counting(table, sentence):
    check(table([(i, sentence(40, i) + "\n" + sentence(10 + i % 3, i % 5) * (1 + i % 3) + " #é|" * (i % 4)) for i in range(40)]))


def test_odd_rows(odd, empty):
    check(odd)
    assert Q.quality(empty).count() == 0


def word_hash(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Q.T.span_hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])


def test_common_words_are_exact_however_rows_are_spread(table, monkeypatch):
    """Words near the cut, spread thinly over many rows, and a language whose buckets are all alike."""
    rng = random.Random(8)
    names = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(400):
        rows.append((i, " ".join(rng.choice(names[:1 + rng.randrange(300)]) for _ in range(30)), "en"))
        rows.append((1000 + i, " ".join(names[(i * 30 + j) % 300] for j in range(30)), None))
    rows.append((5000, "few words", "fr"))
    want = set()
    for lang in ("en", None):
        count = collections.Counter(w for _, t, x in rows if x == lang for w in t.split())
        order = sorted(count, key=lambda w: (-count[w], word_hash(w)))[:Q.COMMON]
        want |= {(lang, word_hash(w), count[w], k) for k, w in enumerate(order, 1)}
    df = table(rows).select("doc_id", "text", "lang")
    for parts, heavy in ((1, 64), (7, 64), (64, 64), (7, 3), (7, 1000)):
        monkeypatch.setattr(Q, "HEAVY", heavy)
        monkeypatch.setattr(Q, "MOST_HELD", 50 if parts == 7 else 1 << 20)
        assert {(r["lang"], r["key"], r["n"], r["place"]) for r in Q.common_words(df.repartition(parts))} == want


def test_js_distance():
    p, q = np.array([[1, 1, 0], [0, 0, 0]]), np.array([[0, 0, 3], [1, 1, 1]])
    assert math.isclose(Q.js_distance(p, q)[0], 1.0) and Q.js_distance(p, q)[1] == 0 and Q.js_distance(p, 5 * p)[0] == 0


def test_distances_match_plain_histograms(table, sentence):
    rows = [(i, sentence(200, i) + ".") for i in range(60)] + [(99, ("### $$$ 1234 " * 60))]
    got = {r["doc_id"]: r for r in Q.quality(table(rows)).collect()}
    letters = [re.findall(r"[a-zé]+", t) for _, t in rows]
    count = collections.Counter(w for ws in letters for w in ws)
    kinds = lambda t: [sum(c.islower() and c.isascii() for c in t), sum(c.isdigit() for c in t), t.count(" "), t.count("."),
                       sum(c in "#$" for c in t), t.count("é")]
    whole = np.sum([kinds(t) for _, t in rows], axis=0)
    order = sorted(count, key=lambda w: (-count[w], word_hash(w)))[:Q.COMMON]
    spread = lambda ws: [ws.count(w) for w in order] + [sum(w not in order for w in ws)]
    reference = np.sum([spread(ws) for ws in letters], axis=0)
    for (i, t), ws in zip(rows, letters):
        far = Q.js_distance(np.array([spread(ws)]), reference[None])[0] if len(t.split()) >= Q.WORD_WORDS else 0.0
        assert math.isclose(got[i]["word_distance"], far, abs_tol=1e-9)
        assert math.isclose(got[i]["char_distance"], Q.js_distance(np.array([kinds(t)]), whole[None])[0], abs_tol=1e-9)
    assert not got[99]["kept"] and all(got[i]["kept"] for i in range(60))
