"""Least-cost repair of conversation structure over a suffix-shared automaton.

A conversation's turns become a signature, one symbol for each turn: the role's
initial and the turn's fault. The repaired roles must read ``(s?(ua)+)?``. What
a repair costs from some turn on depends only on the rest of the signature and
on the state of that grammar, so signatures are shared from the end:

* turns are sorted by range of (conversation, turn) and cut into pieces of at
  most 64 turns, so one conversation may lie in any number of tasks;
* the distinct (signature, what follows it) are sorted by their reversed text.
  Two neighbours then share the longest possible suffix, and a stack holds the
  automaton's nodes for the current one: a node, a distinct suffix, is worked
  out once, from its child, for each of the four grammar states: cost-to-go
  and best audit suffix;
* a piece in the middle of a conversation is worked out against the four costs
  that follow it, less their minimum, of which there are few. They come from
  the piece costs between all pairs of states, read from the last piece on;
* a stream over the pieces of each conversation, in order, applies the edits.

Among edits of equal cost the least letter is taken. At each state the letters
D, I, K and R name at most one edit each, so this gives the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.llm.common import heavy_keys, look_up
from vehicle_metrics.storage import materialize

PIECE_TURNS, PIECE_BYTES = 64, 1 << 20  # a piece ends at either
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLANK, DUPLICATE, GONE = "b", "d", "x"  # symbols; the others are the role's initial, in capitals if truncated

# States of the grammar: nothing yet, after system, after user, after assistant.
NEEDS = "uuau"  # the one of user and assistant that may follow
AFTER = {"s": 1, "u": 2, "a": 3}
NAMES = {"u": "user", "a": "assistant"}
NEVER = 1 << 40

Node = tuple[tuple[int, ...], tuple[str, ...], tuple[int, ...]]  # by state: cost-to-go, best audit, final state

END = "end"


def terminal(name: str) -> Node:
    """The node after the last symbol: the end of the conversation, or the
    four costs of what follows, as text."""
    if name == END:
        return (0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""), (0, 1, 2, 3)
    return tuple(map(int, name.split(","))), ("",) * 4, (0, 1, 2, 3)


def before(symbol: str, node: Node) -> Node:
    """The node that reads ``symbol`` and then goes on with ``node``."""
    cost, audit, final = node
    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    best = []
    for q in range(4):
        ways = [(DELETE + cost[q], "D", q)]
        if symbol != GONE:
            to = AFTER[NEEDS[q]]
            ways.append((REROLE + extra + cost[to], "R", to))
            if role == NEEDS[q] or (q == 0 and role == "s"):
                ways.append((extra + cost[AFTER[role]], "K", AFTER[role]))
        c, letter, to = min(ways)
        best.append((c, letter, letter + audit[to], final[to]))
    # An inserted turn moves on to the same node's next state; two of them lead nowhere new.
    plain = list(best)
    for q in (2, 3, 0, 1):
        to = AFTER[NEEDS[q]]
        then = plain[to] if q >= 2 else best[to]
        if (INSERT + then[0], "I") < plain[q][:2]:
            best[q] = (INSERT + then[0], "I", "I" + then[2], then[3])
    return tuple(b[0] for b in best), tuple(b[2] for b in best), tuple(b[3] for b in best)


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, body, dropped): rows damaged by the checksum of
    their id and turn modulo 20: 0 dropped (kept as a mark that the
    conversation exists), 1 emptied, 2 without final marks, 3 doubled, 4 role
    user. NULLs in the id, turn, role and text are read as one space."""
    def text(c: str) -> str:
        return f"coalesce(CAST(`{c}` AS STRING), ' ')"

    marked = conversations.selectExpr(
        f"`{conv_col}` AS conv", f"CAST(`{turn_col}` AS BIGINT) AS turn", f"{text(role_col)} AS role", f"{text(text_col)} AS body",
        f"crc32(CAST(concat({text(conv_col)}, ':', {text(turn_col)}) AS BINARY)) % 20 AS mode")
    return marked.selectExpr(
        "conv", "turn", "CASE WHEN mode = 4 THEN 'user' ELSE role END AS role",
        "CASE mode WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '') ELSE body END AS body", "mode = 0 AS dropped",
        "explode(CASE WHEN mode = 3 THEN array(1, 2) ELSE array(1) END) AS copy").drop("copy")


def _pieces(rows: DataFrame) -> DataFrame:
    """Turns in order, cut into pieces. ``piece`` is the number of its first
    turn in the order of all rows; ``base`` has the symbols, without duplicates."""
    space = r"\\x20\\x09-\\x0D"
    initial = "CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END"
    rows = rows.selectExpr(
        "conv", "turn", "role", "body", "dropped",
        f"CASE WHEN NOT rlike(body, '[^{space}]') THEN '{BLANK}' WHEN rlike(body, '[.!?][{space}]*\\\\z') THEN {initial} "
        f"ELSE upper({initial}) END AS symbol", "unhex(sha2(concat(CAST(length(role) AS STRING), ':', role, body), 256)) AS digest",
        "monotonically_increasing_id() AS row")  # parts rows that are equal
    order = ["conv", "turn", "role", "body", "row"]
    conv = rows.schema["conv"]
    fields = (f"piece long, conv {conv.dataType.simpleString()}, n int, base string, inits string, digests array<binary>, "
              "roles array<string>, texts array<string>, low long, high long, turns long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema, at, held, size, whose = None, TaskContext.get().partitionId() << 33, [], 0, None
        ready: list[tuple] = []

        def close() -> None:
            nonlocal at
            turns = [r[1] for r in held if r[1] is not None]
            edge = (turns[0], turns[-1]) if turns else (None, None)
            ready.append((at, whose[0], len(held), "".join(r[4] for r in held), "".join(_class(r[2]) for r in held),
                          [r[5] for r in held], [r[2] for r in held], [r[3] for r in held], *edge, len(set(turns))))
            at += max(1, len(held))

        def emit() -> pa.RecordBatch:
            columns = list(zip(*ready))
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            if schema is None:
                text, arrays = pa.string(), pa.list_(pa.string())
                schema = pa.schema([("piece", pa.int64()), ("conv", batch.schema.field("conv").type), ("n", pa.int32()), ("base", text),
                                    ("inits", text), ("digests", pa.list_(pa.binary())), ("roles", arrays), ("texts", arrays),
                                    *((c, pa.int64()) for c in ("low", "high", "turns"))])
            gone = batch.column(4).to_pylist()
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5, 6)]
            for row, dropped in zip(zip(*columns), gone):
                if whose is None or whose[0] != row[0] or len(held) >= PIECE_TURNS or size > PIECE_BYTES:
                    if whose is not None and (held or whose[0] != row[0]):
                        close()
                    held, size, whose = [], 0, (row[0],)
                if not dropped:
                    held.append(row)
                    size += len(row[3])
            if len(ready) >= 256:
                yield emit()
        if whose is not None:
            close()
        if ready:
            yield emit()

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, fields)


def _class(role: str) -> str:
    return role[0] if role[:1] in AFTER else "o"


def _signatures(pieces: DataFrame) -> DataFrame:
    """(piece, conv, sig, final, several, counts of faults): the light part of
    each piece, with the duplicates found among all turns of a conversation;
    ``several`` if the conversation has other pieces."""
    turns = pieces.where("n > 0").select("conv", "piece", F.posexplode("digests").alias("pos", "digest")).withColumn(
        "ord", F.col("piece") + F.col("pos"))
    firsts = turns.groupBy("conv", "digest").agg(F.min("ord").alias("ord")).select("ord")
    later = turns.select("piece", "pos", "ord").join(firsts, "ord", "left_anti").groupBy("piece").agg(
        F.collect_set("pos").alias("again"))
    marked = pieces.select("piece", "conv", "n", "base").join(later, "piece", "left").selectExpr(
        "piece", "conv", f"""CASE WHEN again IS NULL THEN base ELSE array_join(transform(sequence(1, n), i ->
            CASE WHEN array_contains(again, i - 1) AND substr(base, i, 1) <> '{BLANK}' THEN '{DUPLICATE}'
            ELSE substr(base, i, 1) END), '') END AS marked""")
    ends = pieces.groupBy("conv").agg(F.max("piece").alias("piece"), F.count("*").alias("parts"))
    return marked.join(ends.select("piece", "parts"), "piece", "left").selectExpr(
        "piece", "conv", f"translate(marked, '{BLANK}{DUPLICATE}', '{GONE}{GONE}') AS sig", "parts IS NOT NULL AS final", "parts IS NULL OR parts > 1 AS several",
        f"CAST(length(marked) - length(replace(marked, '{BLANK}', '')) AS BIGINT) AS blank",
        f"CAST(length(marked) - length(replace(marked, '{DUPLICATE}', '')) AS BIGINT) AS duplicate",
        "CAST(length(regexp_replace(marked, '[^SUAO]', '')) AS BIGINT) AS truncated")


def solve(strings: DataFrame) -> DataFrame:
    """(sig, follows, cost, spent, audit) for the distinct (sig, follows):
    arrays by entry state. Sorted by reversed text, so that the nodes of shared
    suffixes are on the stack already."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, nodes = None, "", []
        for batch in batches:
            out: list[tuple] = []
            for follows, back in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if follows != name:
                    name, held, nodes = follows, "", [terminal(follows)]
                shared = 0
                while shared < min(len(held), len(back)) and held[shared] == back[shared]:
                    shared += 1
                del nodes[shared + 1:]
                for symbol in back[shared:]:
                    nodes.append(before(symbol, nodes[-1]))
                held = back
                cost, audit, final = nodes[-1]
                left = nodes[0][0] if name != END else (0, 0, 0, 0)
                out.append((back[::-1], follows, list(cost), [c - left[f] for c, f in zip(cost, final)], list(audit)))
            if out:
                sig, follows, cost, spent, audit = zip(*out)
                numbers = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig), pa.array(follows), pa.array(cost, numbers), pa.array(spent, numbers),
                     pa.array(audit, pa.list_(pa.string()))], names=["sig", "follows", "cost", "spent", "audit"])

    order = ["follows", "back"]
    return (strings.selectExpr("follows", "reverse(sig) AS back").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(run, "sig string, follows string, cost array<long>, spent array<long>, audit array<string>"))


def _look_up_signature(pieces: DataFrame, solved: DataFrame, keys: list[str]) -> DataFrame:
    """``pieces`` with the columns of ``solved`` that has its ``keys``."""
    name = F.concat_ws("|", *keys).alias("name")
    rows = materialize(pieces.select("*", name), "repair_named")
    table = solved.select(name, *[c for c in solved.columns if c not in keys])
    return look_up(rows, heavy_keys(rows, "name", rows.count()), table, "name").drop("name")


def _follow(light: DataFrame) -> DataFrame:
    """(piece, follows) for the pieces of conversations of several pieces."""
    only = [",".join("0" if i == r else str(NEVER) for i in range(4)) for r in range(4)]
    rows = light.where("several").select("piece", "conv", "sig", "final")
    ends = F.when(F.col("final"), F.array(F.lit(END))).otherwise(F.array(*map(F.lit, only)))
    solved = solve(rows.select("sig", F.explode(ends).alias("follows")))
    table = solved.groupBy("sig", (F.col("follows") == END).alias("final")).agg(
        F.map_from_entries(F.collect_list(F.struct("follows", "cost"))).alias("costs"))
    found = _look_up_signature(rows.withColumn("kind", F.col("final").cast("string")),
                               table.select("sig", F.col("final").cast("string").alias("kind"), "costs"), ["sig", "kind"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        then = None
        for batch in batches:
            out = []
            for piece, final, costs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                costs = dict(costs)
                if final:
                    out.append((piece, END))
                    then = costs[END]
                    continue
                low = min(then)
                follows = [x - low for x in then]
                out.append((piece, ",".join(map(str, follows))))
                then = [min(costs[only[r]][q] + follows[r] for r in range(4)) for q in range(4)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int64()), pa.array([f for _, f in out])],
                                                 names=["piece", "follows"])

    return (found.repartition("conv").sortWithinPartitions("conv", F.desc("piece")).select("piece", "final", "costs")
            .mapInArrow(run, "piece long, follows string"))


def _apply(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[tuple[str, str, str]], int]:
    """The edits of a piece as (letter, role, text), and the state after it."""
    out, i = [], 0
    for letter in audit:
        if letter == "D":
            out.append(("D", roles[i], texts[i]))
        elif letter == "K":
            out.append(("K", roles[i], texts[i]))
            state = AFTER[roles[i][0]]
        else:
            need = NEEDS[state]
            out.append((letter, NAMES[need], texts[i] if letter == "R" else ""))
            state = AFTER[need]
        i += letter != "I"
    return out, state


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, n_turns long, n_repaired long")
EDITS = "step long, edit string, role string, text string"


def _solved_pieces(rows: DataFrame) -> DataFrame:
    """One row for each piece with its audits, and one with its texts, dealt
    by conversation and in order."""
    pieces = materialize(_pieces(rows), "repair_pieces")
    light = materialize(_signatures(pieces), "repair_light")
    light = light.join(_follow(light), "piece", "left").withColumn("follows", F.coalesce("follows", F.lit(END)))
    light = materialize(light, "repair_follows")
    solved = materialize(solve(light.select("sig", "follows")), "repair_solved")
    done = _look_up_signature(light, solved, ["sig", "follows"])
    facts = done.select("conv", "piece", F.lit(0).alias("kind"), "spent", "audit", "blank", "duplicate", "truncated").unionByName(
        pieces.select("conv", "piece", F.lit(1).alias("kind"), "inits", "roles", "texts", "low", "high", "turns"), True)
    return facts.select("conv", "piece", "kind", "spent", "audit", "blank", "duplicate", "truncated", "inits", "roles", "texts",
                        "low", "high", "turns").repartition("conv").sortWithinPartitions("conv", "piece", "kind")


def _stream(facts: DataFrame, conv_name: str, report: bool) -> DataFrame:
    conv_type = facts.schema["conv"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whose, state, now = None, 0, None  # a conversation's id in a tuple, grammar state, facts of the piece
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                conv, kind = row[0], row[2]
                if whose is None or whose[0] != conv:
                    if whose is not None and report:
                        out.append(_line(whose[0], total))
                    whose, state = (conv,), 0
                    total = {"sums": [0, 0, 0], "cost": 0, "audit": [], "hash": hashlib.sha256(), "kept": 0, "n": 0, "illegal": 0,
                             "before": "", "low": None, "high": None, "turns": 0, "step": 0}
                if kind == 0:
                    now = row
                    continue
                spent, audit = now[3][state], now[4][state]
                inits, roles, texts, low, high, turns = row[8:]
                for k in range(3):
                    total["sums"][k] += now[5 + k]
                total["cost"] += spent
                total["audit"].append(audit)
                total["n"] += len(inits)
                read = total["before"] + inits
                total["illegal"] += sum(read[i:i + 2] not in ("su", "ua", "au") for i in range(len(read) - 1))
                total["before"] = read[-1:]
                if low is not None:
                    total["turns"] += turns - (total["high"] == low)
                    total["low"] = low if total["low"] is None else total["low"]
                    total["high"] = high
                edits, state = _apply(audit, state, roles, texts)
                for letter, role, text in edits:
                    if not report:
                        total["step"] += 1
                        out.append((conv, total["step"], letter, role, text))
                    elif letter != "D":
                        total["hash"].update(f"{chr(10) if total['kept'] else ''}{role}:{text}".encode())
                        total["kept"] += 1
            if out:
                yield _batch(out, batch.schema.field(0).type)
        if whose is not None and report:
            yield _batch([_line(whose[0], total)], batch.schema.field(0).type)

    def _line(conv, t: dict) -> tuple:
        gaps = 0 if t["low"] is None else t["high"] - t["low"] + 1 - t["turns"]
        return (conv, gaps, *t["sums"], t["illegal"], t["cost"], "".join(t["audit"]), t["hash"].hexdigest(), t["n"], t["kept"])

    def _batch(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
        types = ([conv, *[pa.int64()] * 6, pa.string(), pa.string(), pa.int64(), pa.int64()] if report
                 else [conv, pa.int64(), pa.string(), pa.string(), pa.string()])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = [conv_name, *(x.split()[0] for x in (REPORT if report else EDITS).split(", "))]
    return facts.mapInArrow(run, f"`{conv_name}` {conv_type}, {REPORT if report else EDITS}")


def repair_report(rows: DataFrame, conv_name: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``rows`` (conv, turn, role, body,
    dropped): gaps, faults (a turn's first one counts), illegal neighbours,
    cost and letters of the cheapest edits, and the digest of the repaired text.

    Turns are taken by turn (NULLs first), then role and text. A role whose
    initial is not s, u or a never fits as it is. A conversation of only
    dropped rows has zeros, an empty audit and the digest of nothing; a NULL
    id is a conversation like any other; repeated rows are duplicates; an
    empty table gives an empty result. Texts of any length and conversations
    of any number of turns are read as a stream; only the audit, a letter for
    each edit, is held for a conversation.
    """
    return _stream(_solved_pieces(rows), conv_name, True)


def repaired_turns(rows: DataFrame, conv_name: str = "conv_id") -> DataFrame:
    """(conv, step, edit, role, text): every edit in order, with the role and
    text that result; deleted turns are those with edit D."""
    return _stream(_solved_pieces(rows), conv_name, False)


def undamaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``conversations`` in the form that ``repair_report`` takes."""
    return conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "body"))],
        F.lit(False).alias("dropped"))


def damaged_report(conversations: DataFrame) -> DataFrame:
    """``repair_report`` of the damaged table."""
    return repair_report(damage(conversations))
