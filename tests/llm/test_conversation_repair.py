import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from riskloom.llm import conversation_repair as R
from riskloom.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string, present string, conv string, again string, audit string"


def plain(rows):
    """Report of one conversation's (turn, role, text) rows by trying every sequence of edits, prefix by prefix."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = [c for c in text if c not in "\t\n\x0b\x0c\r "]
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    # prefixes by (rows taken, roles so far): all that can still be cheapest
    now = {("", ()): (0, "")}  # (pattern state, repaired rows) -> cost, audit

    def ok(state, c):
        return {"": c in "su", "s": c == "u", "u": c == "a", "a": c == "u"}[state]

    def insertions(table):
        out = dict(table)
        for _ in range(2):
            for (state, done), (cost, audit) in list(out.items()):
                for role in ("user", "assistant"):
                    if ok(state, role[0]):
                        key, value = (role[0], done + ((role, ""),)), (cost + 5, audit + "I")
                        if key not in out or value < out[key]:
                            out[key] = value
        return out

    def lean(table):  # the repaired rows matter for the digest only: of equal states keep the best few
        keep = {}
        for (state, done), value in sorted(table.items(), key=lambda x: x[1]):
            if sum(k[0] == state for k in keep) < 40:
                keep[state, done] = value
        return keep

    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def put(key, value):
            if key not in after or value < after[key]:
                after[key] = value

        for (state, done), (cost, audit) in insertions(now).items():
            put((state, done), (cost + 2, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] in ("s", "u", "a") and ok(state, role[0]):
                put((role[0], done + ((role, text),)), (cost + more, audit + "K"))
            for new in ("user", "assistant"):
                if ok(state, new[0]):
                    put((new[0], done + ((new, text),)), (cost + 1 + more, audit + "R"))
        now = lean(after)
    ends = [(value, done) for (state, done), value in insertions(now).items() if state in ("", "a")]
    (cost, audit), done = min(ends)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest(), done)


def conversations(n, seed):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for i in range(rng.randint(0, 9)):
            turn = None if rng.random() < 0.05 else i + rng.choice((0, 0, 0, 1, 2))
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None, "usr"))
            text = rng.choice(("Yes.", "No!", "Why?", "well", "  ", "", None, "é ", "Fine.\n", f"{rng.random()}."))
            rows.append((conv, turn, role, text))
    return rows


def test_against_every_sequence_of_edits(spark):
    rows = conversations(400, 3)
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair(spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)).collect()}
    by = {k: [(t, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in g] for k, g in itertools.groupby(rows, lambda r: r[0])}
    assert set(got) == set(by)
    for conv, own in by.items():
        assert got[conv] == plain(own)[:-1], (conv, own)


def test_repaired_rows_are_what_the_report_says(spark):
    rows = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in conversations(200, 8)], SCHEMA)
    report = {r["conv_id"]: r for r in R.repair(rows).collect()}
    out = {}
    for r in R.repaired(rows).orderBy("conv_id", "place").collect():
        out.setdefault(r["conv_id"], []).append(r)
    for conv, r in report.items():
        own = out.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(x["role"][0] for x in own))
        assert "".join(x["edit"] for x in own) == r["audit"].replace("D", "")
        assert [x["place"] for x in own] == list(range(1, len(own) + 1))
        assert hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in own).encode()).hexdigest() == r["repaired_sha256"]


def test_query_damage_and_conversations_without_rows(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Row {c} {t}. Yes!") for c in range(60) for t in range(3)]
    rows += [(None, None, None, None), (None, 1, "user", None), (77, None, "system", "Be. Kind")]
    table = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair(damaged(table), present=F.col("present")).collect()}
    want = {}
    for c, t, role, text in rows:
        own = want.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    none = hashlib.sha256(b"").hexdigest()
    assert set(got) == set(want)
    for c, own in want.items():
        assert got[c] == (plain(own)[:-1] if own else (0, 0, 0, 0, 0, 0, 0, "", none))
    dropped = spark.createDataFrame([(5, 1, "user", "a.", "x", "x", "x", "x")], SCHEMA)
    assert [tuple(r) for r in R.repair(dropped, present=F.lit(False)).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", none)]
    assert R.repair(table.limit(0)).count() == 0 and R.repaired(table.limit(0)).count() == 0


def test_one_long_conversation(spark):
    n = 30_000
    rows = spark.range(n).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role",
                                     "if(id % 7 = 3, 'cut off', concat('Row ', id, '.')) text")
    got = R.repair(rows).collect()
    assert len(got) == 1
    r = got[0]
    own = [(i, "user" if i % 2 == 0 else "assistant", "cut off" if i % 7 == 3 else f"Row {i}.") for i in range(n)]
    assert (r["gaps"], r["blank"], r["illegal"], r["duplicate"] + r["truncated"]) == (0, 0, 0, sum(x[2] == "cut off" for x in own))
    # a plain table of the four role states, without the texts
    now, seen = {"": (0, "")}, set()
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    for _, role, text in own[:400]:
        again = (role, text) in seen
        seen.add((role, text))
        cut, after = text == "cut off", {}
        for state, (cost, audit) in now.items():
            options = [(state, (cost + 2, audit + "D"))]
            for k in range(3):
                at = state
                for _ in range(k):
                    at = step[at]
                if not (cut and again):
                    if step[at] == role[0]:
                        options.append((role[0], (cost + 5 * k + 5 * cut, audit + "I" * k + "K")))
                    options.append((step[at], (cost + 5 * k + 1 + 5 * cut, audit + "I" * k + "R")))
            for to, value in options:
                after[to] = min(after.get(to, value), value)
        now = after
    first = R.repair(rows.where("turn < 400")).first()
    best = min([now[""], now["a"], (now["u"][0] + 5, now["u"][1] + "I")])
    assert (first["cost"], first["audit"]) == best and len(r["audit"].replace("I", "")) == n


def test_automaton():
    lr = R.Automaton()
    words = {"".join(w) for n in range(7) for w in itertools.product("sua", repeat=n)}
    stacks = R.Stacks(lr)
    for w in words:
        at = 0
        for c in w:
            at = stacks.shift(at, c) if at is not None else None
        assert (at is not None and stacks.accepts(at)) == bool(re.fullmatch("(s?(ua)+)?", w)), w
    assert len(stacks.nodes) < 20
