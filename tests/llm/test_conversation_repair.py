"""Conversation repair against a plain search over edits, and its edge rows."""

import hashlib
import random
import re
import zlib

import pytest

from vehicle_metrics.llm import conversation_repair as R

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\v\f\r"


def plain_damage(rows):
    kept, ids = [], {}
    for conv, turn, role, text in rows:
        ids[conv] = True
        t = lambda x: " " if x is None else str(x)
        mode = zlib.crc32(f"{t(conv)}:{t(turn)}".encode()) % 20
        role, text = t(role), t(text)
        if mode == 0:
            continue
        text = "" if mode == 1 else re.sub("[.!?]", "", text) if mode == 2 else text
        role = "user" if mode == 4 else role
        kept += [(conv, turn, role, text)] * (2 if mode == 3 else 1)
    return list(ids), kept


def plain_repair(turns):
    """turns in order as (turn, role, text) -> the contract's values."""
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen
                      else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, "", ())}  # by the last initial written: cost, audit, repaired lines

    def step(state, letter):
        if letter == "s":
            return "s" if state == "" else None
        if letter == "u":
            return "u" if state in ("", "s", "a") else None
        return "a" if letter == "a" and state == "u" else None

    def offer(table, state, value):
        if state is not None and (state not in table or value[:2] < table[state][:2]):
            table[state] = value

    def inserts(table):
        for _ in range(3):
            for state, (c, e, out) in list(table.items()):
                for role in ("user", "assistant"):
                    offer(table, step(state, role[0]), (c + 5, e + "I", (*out, f"{role}:")))
        return table

    best = inserts(best)
    for (_, role, text), fault in zip(turns, faults):
        nxt, extra = {}, 5 if fault == "truncated" else 0
        for state, (c, e, out) in best.items():
            offer(nxt, state, (c + 2, e + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            offer(nxt, step(state, role[:1]), (c + extra, e + "K", (*out, f"{role}:{text}")))
            for other in ("user", "assistant"):
                if other != role:
                    offer(nxt, step(state, other[0]), (c + 1 + extra, e + "R", (*out, f"{other}:{text}")))
        best = inserts(nxt)
    cost, audit, out = min(v for s, v in best.items() if s in ("", "a"))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    inits = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(inits, inits[1:]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected(rows):
    ids, kept = plain_damage(rows)
    out = {}
    for conv in ids:
        turns = sorted(((t, r, x) for c, t, r, x in kept if c == conv), key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2]))
        out[conv] = plain_repair(turns)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.select("conv_id", *COLUMNS).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_whole_table_equals_plain_search(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(R.damaged_report(table)) == expected(rows)


@pytest.mark.parametrize("piece_turns", [1, 3, 64])
def test_random_and_edge_rows(spark, monkeypatch, piece_turns):
    monkeypatch.setattr(R, "PIECE_TURNS", piece_turns)
    rng = random.Random(7)
    texts = ["Fine.", "cut", "", " \t", "What?", "é done!", "x" * 50_000 + ".", None]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for c in range(60) for _ in range(rng.randint(1, 14))]
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (99, None, None, None)]
    rows += [(7, 3, "user", "Same.")] * 30  # repeated rows
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    assert got(R.damaged_report(df.repartition(5))) == expected(rows)


def test_long_conversation_over_many_pieces(spark):
    """One conversation with most rows is cut over tasks and equals the plain search."""
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", f"t{t}", "Again."])) for t in range(900)]
    rows += [(2, 0, "system", "Be kind."), (2, 1, "user", "Hi!"), (2, 2, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(R.damaged_report(df)) == expected(rows)


def test_empty_table_dropped_and_names(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert got(R.damaged_report(empty)) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert got(R.damaged_report(df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns_follow_the_grammar(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    edits = R.repaired_turns(R.damage(table)).collect()
    by = {}
    for r in sorted(edits, key=lambda r: r.step):
        if r.edit != "D":
            by.setdefault(r.conv_id, []).append(r.role[0])
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in by.values())
    plain = R.repair_report(R.undamaged(table)).agg({"cost": "sum"}).first()[0]
    assert plain is not None
