import random

import pytest
from pyspark.sql import functions as F
from riskloom.llm import line_dedup as L


def edited(rng, text, most):
    b = list(text)
    for _ in range(rng.randint(0, most) if b else 0):
        p = rng.randrange(len(b) or 1)
        b = rng.choice([b[:p] + [rng.choice("abcé")] + b[p:], b[:p] + b[p + 1:], b[:p] + [rng.choice("abcé")] + b[p + 1:]])
    return "".join(b)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 5])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abcé🙂") for _ in range(rng.randint(1, 90 if rng.random() < 0.2 else 12)))
        rows.append((a, edited(rng, a, 6)))
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", L.banded_distance("a", "b", edits).alias("d")).collect()
    assert all(min(r["d"], edits + 1) == min(distance(r["a"], r["b"]), edits + 1) for r in got)


@pytest.mark.parametrize("edits", [1, 3])
def test_clusters_match_brute_force(table, edits):
    rng = random.Random(20 + edits)
    docs = []
    for k in range(12):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(16, 50)))
        docs.append((k, "\n".join([edited(rng, base, 2) for _ in range(5)] + ["short", ""])))
    df = table(docs + [docs[0]])
    lines = [(d, i, t) for d, text in docs for i, t in enumerate(text.split("\n")) if len(t) >= 16]
    root = {x[:2]: x[:2] for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(lines):
        for y in lines[:i]:
            if distance(x[2], y[2]) <= edits:
                a, b = find(x[:2]), find(y[:2])
                root[max(a, b)] = min(a, b)
    got = {(r["doc_id"], r["line_no"]): ((r["cluster_doc"], r["cluster_line"]), r["kept"])
           for r in L.line_clusters(df, edits=edits, min_chars=16, edit_chars=None).collect()}
    assert got == {x[:2]: (find(x[:2]), find(x[:2]) == x[:2]) for x in lines}
    clean = {r["doc_id"]: r["text"] for r in L.without_repeated_lines(df, edits=edits, min_chars=16, edit_chars=None).collect()}
    assert clean == {d: "\n".join(t for i, t in enumerate(text.split("\n")) if got.get((d, i), (0, True))[1]) for d, text in docs}


def test_odd_rows(odd, empty):
    got = L.line_clusters(odd)
    assert got.where("cluster_line is null").count() == 0
    kept = L.without_repeated_lines(odd)
    assert kept.schema == odd.schema and kept.count() == odd.count()
    texts = {r["doc_id"]: r["text"] for r in kept.where(F.col("doc_id").isin(3, 4, 5, 11)).collect()}
    assert texts[3] is None and texts[4] == "" and texts[5] == " \n\t " and "\n" not in texts[11]
    assert L.line_clusters(empty).count() == 0 and L.without_repeated_lines(empty).count() == 0


def test_no_python_on_the_main_path(odd, capsys):
    L.line_links(L._lines(odd, "doc_id", "text", 16), 1).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("edits", [1, 4])
def test_short_lines_cluster_too(table, edits):
    rng = random.Random(40 + edits)
    docs = []
    for k in range(10):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 24)))
        short = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(3)]
        docs.append((k, "\n".join([edited(rng, base, 4) for _ in range(4)] + short + ["Les.", "x", "", " \t"])))
    df = table(docs)
    lines = [(d, i, t) for d, text in docs for i, t in enumerate(text.split("\n")) if t.strip()]
    root = {x[:2]: x[:2] for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(lines):
        for y in lines[:i]:
            if distance(x[2], y[2]) <= min(edits, min(len(x[2]), len(y[2])) // 4):
                a, b = find(x[:2]), find(y[:2])
                root[max(a, b)] = min(a, b)
    got = {(r["doc_id"], r["line_no"]): ((r["cluster_doc"], r["cluster_line"]), r["kept"])
           for r in L.line_clusters(df, edits=edits, min_chars=1, edit_chars=4).collect()}
    assert got == {x[:2]: (find(x[:2]), find(x[:2]) == x[:2]) for x in lines}


def test_the_query_has_a_row_for_every_line(spark, table, tmp_path):
    from riskloom.llm.queries import op10_line_dedup
    table([(k, f"Les.\n{k * 7919} own words of document {k}\n\n...") for k in range(5)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = op10_line_dedup(spark, str(tmp_path)).collect()
    assert len(got) == 15 and sum(r["kept"] for r in got if r["line_no"] in (0, 3)) == 2


def test_the_query_links_lines_that_differ_in_a_short_word(spark, table, tmp_path):
    from riskloom.llm.queries import op10_line_dedup
    table([(1, "the cat sat on the mat all day"), (2, "the dog sat on the mat all day"), (3, "a bird sang in a tree at night")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["cluster_doc"] for r in op10_line_dedup(spark, str(tmp_path)).collect()} == {1: 1, 2: 1, 3: 3}


def test_a_family_of_near_copies_needs_linear_candidates(spark):
    base = "all rights reserved, printed in the city by the sea"
    rows = [(f"{base} {i:04d}",) for i in range(2000)]
    lines = spark.createDataFrame(rows, "line string").withColumn("chars", F.length("line"))
    postings = L._postings(lines, L._levels(4, None))
    heads = postings.where("own").groupBy("key").agg(F.min(F.struct("id", "sign")).alias("head"))
    pairs = L._met(postings, heads, 4).distinct().count()
    assert pairs < 12 * len(rows)
    links = L.line_links(lines, 4)
    roots = L.components(links)
    assert roots.count() == len(rows) and roots.select("root").distinct().count() == 1


def test_a_key_with_lines_beyond_the_threshold_is_searched_whole(table):
    """Lines share a segment, but differ beyond the threshold from the key's head; near ones still link."""
    rng = random.Random(9)
    tails = ["".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(8)]
    docs = [(k, "the very same beginning of it all " + (t if k % 2 == 0 else t[:10] + "#" + t[11:])) for k, t in enumerate(t for t in tails for _ in range(2))]
    got = {r["doc_id"]: r["cluster_doc"] for r in L.line_clusters(table(docs), edits=2, min_chars=16, edit_chars=None).collect()}
    assert got == {k: k - k % 2 for k in got}


def test_a_line_has_eight_keys_and_no_pairs_leave_a_join_unlinked(spark, monkeypatch):
    """Three edits took 26 keys a line, and every pair of a key's lines took both texts along."""
    rng = random.Random(3)
    rows = [("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 600))),) for _ in range(300)]
    lines = spark.createDataFrame(rows, "line string").withColumn("chars", F.length("line"))
    assert L._posted(lines, L._levels(3, 4)).count() < 11 * len(rows)
    same = "the very same beginning of a long line that many others have too "
    rows = [(same + "".join(rng.sample("abcdefghij" * 4, 40)),) for _ in range(60)]
    lines = spark.createDataFrame(rows, "line string").withColumn("chars", F.length("line"))
    met = []
    monkeypatch.setattr(L, "_verified", lambda texts, pairs, *a, f=L._verified: met.append(pairs.distinct().count()) or f(texts, pairs, *a))
    assert L.line_links(lines, 3, 4).count() == 0 and sum(met) < 8 * len(rows)
