import hashlib
import random
import re
import zlib

import pytest
from tabloom.llm import conversation_repair as cr
from tabloom.llm import oracles
from tests_llm_rows import rows_of

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\v\f\r"


def cheapest(rows):
    """Best (cost, letters, turns) by trying every edit from every state, from the last row back."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", []), "a": (0, "", [])}
    for row in [None, *reversed(rows)]:
        ends = best if row is None else {}
        if row is not None:
            role, text, fault = row
            late = 5 if fault == "truncated" else 0
            for state in step:
                found = []
                if state in best:
                    c, w, t = best[state]
                    found.append((c + 2, "D" + w, t))
                if fault in (None, "truncated"):
                    own = role[:1]
                    for letter, cost, to, named in (("K", 0, own, role), ("R", 1, "u", "user"), ("R", 1, "a", "assistant")):
                        if to in best and to and (to == step[state] or (state == "" and to == "s")):
                            c, w, t = best[to]
                            found.append((c + cost + late, letter + w, [(named, text), *t]))
                if found:
                    ends[state] = min(found, key=lambda x: x[:2])
        for _ in range(3):
            for state, to in step.items():
                if to in ends:
                    c, w, t = ends[to]
                    new = (c + 5, "I" + w, [("user" if to == "u" else "assistant", ""), *t])
                    if state not in ends or new[:2] < ends[state][:2]:
                        ends[state] = new
        best = ends
    return best[""]


def brute(original, damaged):
    out = []
    for conv in {c for c, *_ in original}:
        rows = sorted(((t, r, x) for c, t, r, x in damaged if c == conv), key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
        seen, judged = set(), []
        for _, role, text in rows:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        marks = [r[:1] for _, r, _ in rows]
        cost, letters, kept = cheapest(judged)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in kept))
        count = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        out.append((conv, gaps, *count, illegal, cost, letters, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def hurt(rows):
    out = []
    for c, t, r, x in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, at int, edit string")


def made(seed, conversations, longest):
    draw, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "What?", "cut off", "", " \n", "é.", "Yes. ", None, "ok ok."]
    for conv in [None, *range(conversations)]:
        for i in range(draw.randint(1, longest)):
            turn = draw.choice([i, i, i, i, i + draw.randint(0, 2), None])
            rows.append((conv, turn, draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "support", None]), draw.choice(texts)))
    return rows


def test_auction_gives_the_first_cheapest_path(monkeypatch):
    draw = random.Random(1)
    fault = {"": None, "truncated": "truncated", "blank": "blank", "duplicate": "duplicate"}
    meaning = {c: (r, "x", fault[f]) for f, codes in cr.CODES.items() for c, r in zip(codes, ("system", "user", "assistant", "other"))}
    for stretch in (64, 3):
        monkeypatch.setattr(cr, "STRETCH", stretch)
        for _ in range(400):
            codes = "".join(draw.choice(draw.choice(["ua", "suao", "".join(cr.CODES.values())])) for _ in range(draw.randint(0, 20)))
            assert cr.repair(codes) == cheapest([meaning[c] for c in codes])[:2], codes


def test_prices_never_exceed_an_arc():
    draw = random.Random(2)
    for _ in range(50):
        codes = "".join(draw.choice("".join(cr.CODES.values())) for _ in range(12))
        price = cr.auction(codes, cr.END)
        assert all(p <= cr._choices(codes, cr.END, price, node)[0] for node, p in enumerate(price))


@pytest.mark.parametrize("seed,conversations,longest", [(1, 60, 6), (2, 2, 150)])
def test_equals_brute_force(spark, seed, conversations, longest):
    rows = made(seed, conversations, longest)
    clean = frame(spark, rows)
    assert rows_of(cr.damage(clean), "conv_id", "turn", "role", "text") == sorted(hurt(rows), key=repr)
    assert rows_of(cr.report(cr.damage(clean), clean), *COLUMNS) == brute(rows, hurt(rows))


def test_one_conversation_over_many_tasks(spark):
    """A range partition cuts the conversation into parts that are repaired as one."""
    rows = [(5, i, r, x) for i, (_, _, r, x) in enumerate(made(3, 0, 1) + made(4, 40, 12)) if r and x]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        clean = frame(spark, rows)
        placed = cr.placed(clean)
        plan = cr.plans(placed)
        assert len(plan.first()["starts"]) > 1
        got = rows_of(cr.report(clean, clean), *COLUMNS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert got == brute(rows, rows)
    turns = cr.repaired(placed, plan)
    assert turns.where("edit in ('K', 'R', 'D')").count() == len(rows)
    assert rows_of(cr.hashes(turns.where("edit <> 'D'")), "sha256") == [(got[0][-1],)]


def test_edges(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.report(none, none).collect() == []
    empty = hashlib.sha256(b"").hexdigest()
    one = frame(spark, [(7, 1, "user", "Hi.")])
    assert rows_of(cr.report(none, one), *COLUMNS) == [(7, 0, 0, 0, 0, 0, 0, "", empty)]
    odd = [(1, None, None, None), (2, 0, "", "x."), (2, 1, "user", "y."), (3, None, "system", "z."), (None, 4, "user", "a."), (None, 9, "assistant", "b.")]
    clean = frame(spark, odd)
    want = brute([(c, t, r or " " if r is None else r, x) for c, t, r, x in odd], [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd])
    assert rows_of(cr.report(clean, clean), *COLUMNS) == want


def test_query_and_sql_equal_brute_force(spark):
    import duckdb
    from tabloom.llm.queries import op12
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(rows, hurt(rows))
    assert rows_of(op12(spark, sf), *COLUMNS) == want
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    assert sorted(con.sql(f"select {', '.join(COLUMNS)} from ({oracles.REPAIR})").fetchall(), key=repr) == want
