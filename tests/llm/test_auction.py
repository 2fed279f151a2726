import hashlib
import itertools
import random
import zlib

import pytest

from visitlake.llm import auction as A
from visitlake.llm.queries import op12_auction_repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, h1 string, kind int"
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """By trying everything: (cost, audit) of rows (initial, fault), with further copies spelled out."""
    states = {"": (0, "")}

    def better(into, state, value):
        into[state] = min(into.get(state, value), value)

    def inserted(states):
        out = dict(states)
        for state, (cost, audit) in states.items():
            for extra in range(1, 4):
                state = NEXT[state]
                better(out, state, (cost + 2 * extra, audit + "I" * extra))
        return out

    for initial, fault in rows:
        ahead = {}
        for state, (cost, audit) in inserted(states).items():
            better(ahead, state, (cost + 3, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if NEXT[state] == initial or (initial, state) == ("s", ""):
                better(ahead, initial, (cost + extra, audit + "K"))
            better(ahead, NEXT[state], (cost + 2 + extra, audit + "R"))
        states = ahead
    return min(v for s, v in inserted(states).items() if s in ("", "a"))


def hashes(text):
    return tuple(int(x) for x in KNOWN[text])


KNOWN = {}


def brute(rows):
    """What ``repair`` gives for (conv, turn, role, text), ties of one turn by role and the text's hash."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashes(r[2])))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(own, faults, strict=True)])
        lines, state, rest = [], "", iter(own)
        for letter in audit:
            if letter == "I":
                state = NEXT[state]
                lines.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, role, text = next(rest)
            if letter == "K":
                state = role[:1]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = NEXT[state]
                lines.append({"u": "user:", "a": "assistant:"}[state] + text)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(own))
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), pairs, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def spoiled(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        if fate:
            row = (conv, turn, "user" if fate == 4 else role, "" if fate == 1 else text.translate({33: None, 46: None, 63: None}) if fate == 2 else text)
            out += [row] * (2 if fate == 3 else 1)
    return out


def frame(spark, rows):
    texts = sorted({" " if r[3] is None else r[3] for r in rows} | {"", " "})
    from visitlake.llm.common import line_key
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", *line_key(A.F.col("t"))).collect():
        KNOWN[r.t] = (r.h1, r.h2)
    return spark.createDataFrame([(*r, "clash", "x", 1) for r in rows], SCHEMA)


def run(spark, rows):
    return sorted(map(tuple, A.repair(frame(spark, rows)).collect()), key=repr)


def test_auction_and_trace_against_trying_everything():
    rng = random.Random(1)
    names = ["", "blank", "duplicate", "truncated"]
    cases = [list(c) for n in range(4) for c in itertools.product(itertools.product("sua", (0, 1, 3)), repeat=n)]
    cases += [[(rng.choice("suaxuau"), rng.randrange(4)) for _ in range(rng.randrange(40))] for _ in range(300)]
    for rows in cases:
        lattice = A.Lattice(rows, A.GOAL)
        cost = lattice.auction(A.START)
        assert (cost, lattice.trace(A.START)) == cheapest([(i, names[f]) for i, f in rows])
        # The prices are a dual solution: no arc is cheaper than its price difference.
        assert all(lattice.price[n] <= c + lattice.price[h] for n, out in enumerate(lattice.arcs) for _, c, h in out)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_segments_chain_to_the_same_path(size):
    rng = random.Random(size)
    for _ in range(150):
        rows = [(rng.choice("suaxuau"), rng.randrange(4)) for _ in range(rng.randrange(1, 24))]
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        ways = A.chained([A.measured(p) for p in parts])
        letters = "".join(A.solved(p, b, e) for p, (b, e) in zip(parts, ways, strict=True))
        assert letters == A.solved(rows, A.START, A.GOAL)


def made(seed, conversations=30):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Good. ", "A longer answer\nin two lines.", None, "zwölf."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, 9)):
            if rng.random() < 0.9:
                rows.append((conv if conv else None, turn if rng.random() < 0.95 else None, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]),
                             rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    return rows + rng.choices(rows, k=5)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_trying_everything(spark, seed):
    rows = made(seed)
    assert run(spark, rows) == brute(rows)


def test_long_conversation_in_many_segments(spark, monkeypatch):
    monkeypatch.setattr(A, "SEGMENT", 4)
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["One.", "Two", f"{t}.", f"{t}"])) for t in range(150)] + made(4, 10)
    rows += [(8, 5, "user", "the very same row.")] * 40
    assert run(spark, rows) == brute(rows)


def test_damage(spark):
    rows = [(c, t, "assistant" if (t or 0) % 2 else "user", f"Text {t}. Really?! Yes") for c in (None, *range(12)) for t in (None, *range(6))] + [(3, 3, None, None)]
    got = A.damaged(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(spoiled(rows), key=repr)


def test_every_conversation_is_returned(spark):
    rows = [(c, 0, "user", "Hi.") for c in range(60)]
    gone = {c for c, *_ in rows} - {r[0] for r in spoiled(rows)}
    got = A.repaired_conversations(frame(spark, rows), A.damaged(frame(spark, rows))).collect()
    assert len(got) == 60 and gone
    empty = hashlib.sha256().hexdigest()
    assert {tuple(r)[1:] for r in got if r.conv_id in gone} == {(0, 0, 0, 0, 0, 0, "", empty)}


def test_empty_table_and_kept_texts(spark):
    assert run(spark, []) == []
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Are you there?"), (1, 2, "assistant", "Yes.")]
    row = A.repair(frame(spark, rows), keep_text=True).first()
    assert (row.audit, row.cost, row.repaired) == ("KIKK", 2, "user:Hi.\nassistant:\nuser:Are you there?\nassistant:Yes.")


def test_query_over_the_whole_table(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = spoiled(table)
    frame(spark, rows)
    want = brute(rows)
    want += [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in {r[0] for r in table} - {r[0] for r in rows}]
    assert sorted(map(tuple, op12_auction_repair(spark, sf_dir).collect()), key=repr) == sorted(want, key=repr)
