"""Repair of conversations by an auction for shortest paths.

The rows of a conversation and the states of the pattern ``(s?(ua)+)?`` span a lattice:
keeping, renaming or deleting a row leads to the next row, inserting one stays before it,
each at a whole-number cost. The cheapest repair is a shortest path. The auction holds a
price for each node and a path from the origin: the node at the path's end takes the
lowest cost plus price among its arcs as its own price; if that raises the price, the path
is shortened by the node, otherwise the path grows by that arc. It ends when the path meets the
goal. All arcs of all shortest paths are tight then (price equals cost plus price), and the
least of the paths by letters is traced over the tight arcs that lead to the goal. Prices
start at what the rows to come cost whatever is done.

Rows are put in order by range, so that a conversation may span many tasks, and are packed
into segments. A conversation of one segment is one auction. In longer ones each segment is
auctioned from every state to every state, the segments' costs are chained, and then each
segment is traced between the states the chain gives it. Texts travel once, to where the
repaired conversation is hashed row after row; until then hashes stand for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, line_key, narrow, stored

SEGMENT = 64
BLANKS = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: States: nothing yet, after the system row, after the user, after the assistant.
STATES, START, SYSTEM, USER, ASSISTANT = 4, 0, 1, 2, 3
GOAL = STATES
FOLLOWING = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Solutions a task remembers; most conversations are one of a few kinds.
REMEMBERED = 20_000
KEY = ["conv", "has_turn", "turn", "role", "h1", "h2"]
SEGMENTS = "conv string, place long, rows array<struct<has_turn:boolean,turn:long,role:string,h1:long,h2:long,n:long,fault:int>>"
MEASURED = "conv string, place long, costs array<long>, ranks array<int>"
ROUTES = "conv string, place long, begin int, end int"
EDITS = "conv string, has_turn boolean, turn long, role string, h1 long, h2 long, kind int, n long, fault int, edits string, after string, text string"
REPAIRED = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string, repaired string")
NEVER = (1 << 62) - 1

Row = tuple[str, int]


def kept(state: int, initial: str) -> int | None:
    """Where a row that is kept leads to."""
    if initial == "s":
        return SYSTEM if state == START else None
    follower = FOLLOWING[state]
    return follower if initial == NAMES[follower][0] else None


@dataclass
class Lattice:
    """Arcs ``(letter, cost, head)`` of every node, in the order of their letters. A node is row times ``STATES`` plus state."""

    rows: list[Row]
    end: int
    arcs: list[list[tuple[str, int, int]]] = field(default_factory=list)
    price: list[int] = field(default_factory=list)

    def __post_init__(self):
        count = len(self.rows)
        self.goal = STATES * (count + 1)
        for i, (initial, fault) in enumerate(self.rows):
            extra = CUT_OFF if fault == TRUNCATED else 0
            for state in range(STATES):
                behind, follower = STATES * (i + 1), FOLLOWING[state]
                out = [("D", DELETE, behind + state), ("I", INSERT, STATES * i + follower)]
                if fault not in (BLANK, DUPLICATE):
                    if (head := kept(state, initial)) is not None:
                        out.append(("K", extra, behind + head))
                    out.append(("R", RENAME + extra, behind + follower))
                self.arcs.append(out)
        for state in range(STATES):
            ends = state in (START, ASSISTANT) if self.end == GOAL else state == self.end
            out = [("", 0, self.goal)] if ends else []
            # What is inserted at a border belongs to the segment behind it.
            self.arcs.append(out + ([("I", INSERT, STATES * count + FOLLOWING[state])] if self.end == GOAL else []))
        self.arcs.append([])
        self._prune()
        self.price = [0] * (self.goal + 1)
        for node in range(STATES * count - 1, -1, -1):
            fault = self.rows[node // STATES][1]
            sure = {BLANK: DELETE, DUPLICATE: DELETE, TRUNCATED: CUT_OFF}.get(fault, 0)
            self.price[node] = sure + self.price[STATES * (node // STATES + 1)]

    def _prune(self) -> None:
        """Leaves out what does not lead to the goal."""
        alive = [False] * self.goal + [True]
        for i in range(len(self.rows), -1, -1):
            for _ in range(STATES):
                for node in range(STATES * i, STATES * (i + 1)):
                    alive[node] = any(alive[head] for _, _, head in self.arcs[node])
        self.arcs = [[arc for arc in out if alive[arc[2]]] for out in self.arcs]

    def auction(self, origin: int) -> int | None:
        """The cost of the shortest path, its prices left behind; None if there is none."""
        if not self.arcs[origin]:
            return None
        price, path = self.price, [origin]
        while path[-1] != self.goal:
            node = path[-1]
            best, head = min((cost + price[head], head) for _, cost, head in self.arcs[node])
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
        return price[origin] - price[self.goal]

    def trace(self, origin: int) -> str:
        """Of all shortest paths the letters that come first. After an auction from ``origin``."""
        price = self.price
        leads = [False] * self.goal + [True]
        for i in range(len(self.rows), -1, -1):
            # Within a row only insertions lead on, to lower prices.
            for node in sorted(range(STATES * i, STATES * (i + 1)), key=price.__getitem__):
                leads[node] = any(leads[head] and price[node] == cost + price[head] for _, cost, head in self.arcs[node])
        letters, node = [], origin
        while node != self.goal:
            letter, _, node = next(arc for arc in self.arcs[node] if leads[arc[2]] and price[node] == arc[1] + price[arc[2]])
            letters.append(letter)
        return "".join(letters)


def solved(rows: list[Row], begin: int, end: int) -> str | None:
    """The cheapest edits from one state to another, the first by letters."""
    lattice = Lattice(rows, end)
    return None if lattice.auction(begin) is None else lattice.trace(begin)


def measured(rows: list[Row]) -> tuple[list[int], list[int]]:
    """Costs from every state to every state and to the goal, and the order by letters of those with one begin."""
    costs, paths = [NEVER] * (STATES * (STATES + 1)), {}
    for end in range(STATES + 1):
        lattice = Lattice(rows, end)
        # One goal: the prices of an auction stay good for the next origin.
        for begin in range(STATES):
            cost = lattice.auction(begin)
            if cost is not None:
                costs[begin * (STATES + 1) + end] = cost
                paths[begin, end] = lattice.trace(begin)
    ranks = [0] * len(costs)
    for begin in range(STATES):
        ends = sorted((path, end) for (b, end), path in paths.items() if b == begin)
        for rank, (_, end) in enumerate(ends):
            ranks[begin * (STATES + 1) + end] = rank
    return costs, ranks


def chained(segments: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """(begin, end) of each segment on the path of least cost that comes first by letters."""
    ahead, choices = None, []
    for costs, ranks in reversed(segments):
        ends = [GOAL] if ahead is None else range(STATES)
        best = [min((min(NEVER, costs[b * (STATES + 1) + e] + (ahead[e] if ahead else 0)), ranks[b * (STATES + 1) + e], e) for e in ends) for b in range(STATES)]
        choices.append([e for _, _, e in best])
        ahead = [cost for cost, _, _ in best]
    state, out = START, []
    for choice in reversed(choices):
        out.append((state, choice[state]))
        state = choice[state]
    return out


def by_row(letters: str, count: int) -> tuple[list[str], str]:
    """Each row's insertions with its own letter, and the insertions behind the last row."""
    out, waiting = [], ""
    for letter in letters:
        waiting += letter
        if letter != "I":
            out.append(waiting)
            waiting = ""
    assert len(out) == count
    return out, waiting


def lattice_rows(rows: list[dict]) -> list[Row]:
    return [(r["role"][:1], r["fault"]) for r in rows]


def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order into segments of one conversation each."""
    number, open_conv, rows = TaskContext.get().partitionId() << 40, None, []
    for batch in batches:
        done = []
        for row in batch.to_dict("records"):
            conv = row.pop("conv")
            if rows and (conv != open_conv or len(rows) == SEGMENT):
                done.append((open_conv, number, rows))
                number, rows = number + 1, []
            open_conv = conv
            rows.append(row)
        yield pd.DataFrame(done, columns=["conv", "place", "rows"])
    if rows:
        yield pd.DataFrame([(open_conv, number, rows)], columns=["conv", "place", "rows"])


def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [measured(lattice_rows(rows)) for rows in batch["rows"]]
        yield batch[["conv", "place"]].assign(costs=[f[0] for f in found], ranks=[f[1] for f in found])


def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The segments of one conversation after those of another, in order."""
    conv, places, found = None, [], []

    def routes() -> pd.DataFrame:
        ways = chained(found)
        return pd.DataFrame({"conv": conv, "place": places, "begin": [b for b, _ in ways], "end": [e for _, e in ways]})

    for batch in batches:
        for own, place, costs, ranks in zip(batch["conv"], batch["place"], batch["costs"], batch["ranks"], strict=True):
            if found and own != conv:
                yield routes()
                places, found = [], []
            conv = own
            places.append(place)
            found.append((list(map(int, costs)), list(map(int, ranks))))
    if found:
        yield routes()


def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits of every row."""
    names = [c.split()[0] for c in EDITS.split(", ")]
    known: dict[tuple, str] = {}
    for batch in batches:
        out = []
        for conv, rows, begin, end in zip(batch["conv"], batch["rows"], batch["begin"], batch["end"], strict=True):
            shape = lattice_rows(rows)
            key = (tuple(shape), begin, end)
            letters = known.get(key)
            if letters is None:
                letters = solved(shape, begin, end)
                if len(known) < REMEMBERED:
                    known[key] = letters
            edits, after = by_row(letters, len(rows))
            last = len(rows) - 1
            out += [(conv, r["has_turn"], r["turn"], r["role"], r["h1"], r["h2"], 0, r["n"], r["fault"], edits[i], after if i == last else "", None)
                    for i, r in enumerate(rows)]
        yield pd.DataFrame(out, columns=names)


class Repaired:
    """One conversation, built row after row."""

    def __init__(self, conv: str | None, keep: bool):
        self.conv, self.texts = conv, [] if keep else None
        self.sha, self.state, self.audit, self.cost, self.empty = hashlib.sha256(), START, [], 0, True
        self.faults, self.illegal, self.initial = [0, 0, 0, 0], 0, None
        self.turns, self.least, self.turn = 0, None, None
        self.waiting: tuple[str, str] | None = None

    def write(self, role: str, text: str) -> None:
        line = f"{role}:{text}" if self.empty else f"\n{role}:{text}"
        self.sha.update(line.encode())
        if self.texts is not None:
            self.texts.append(line)
        self.empty = False

    def insert(self, letters: str) -> None:
        for _ in letters:
            self.state = FOLLOWING[self.state]
            self.write(NAMES[self.state], "")
            self.cost += INSERT

    def row(self, has_turn: bool, turn: int, role: str, n: int, fault: int, edits: str, after: str) -> None:
        if has_turn and turn != self.turn:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.turn = turn
        self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else DUPLICATE] += n - 1
        initial = role[:1]
        self.illegal += n - 1 + (self.initial is not None and self.initial + initial not in LEGAL)
        self.initial = initial
        # Further copies are deleted right behind the first, before anything is inserted.
        self.audit.append(edits + "D" * (n - 1) + after)
        self.insert(edits[:-1])
        self.cost += DELETE * (n - 1)
        letter = edits[-1]
        if letter == "D":
            self.cost += DELETE
            self.insert(after)
            return
        self.cost += (RENAME if letter == "R" else 0) + (CUT_OFF if fault == TRUNCATED else 0)
        self.state = FOLLOWING[self.state] if letter == "R" else kept(self.state, initial)
        self.waiting = (NAMES[self.state] if letter == "R" else role, after)

    def text(self, text: str) -> None:
        if self.waiting is not None:
            role, after = self.waiting
            self.write(role, text)
            self.insert(after)
            self.waiting = None

    def result(self) -> tuple:
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
                "".join(self.audit), self.sha.hexdigest(), None if self.texts is None else "".join(self.texts))


def rebuild(keep: bool):
    names = [c.split()[0] for c in REPAIRED.split(", ")]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each row's edits and then its text, conversation after conversation."""
        current: Repaired | None = None
        for batch in batches:
            done = []
            columns = ["conv", "has_turn", "turn", "role", "kind", "n", "fault", "edits", "after", "text"]
            for conv, has_turn, turn, role, kind, n, fault, edits, after, text in zip(*(batch[c] for c in columns), strict=True):
                if current is None or conv != current.conv:
                    if current is not None:
                        done.append(current.result())
                    current = Repaired(conv, keep)
                if kind == 0:
                    current.row(has_turn, int(turn), role, int(n), int(fault), edits, after)
                else:
                    current.text(text)
            yield pd.DataFrame(done, columns=names)
        if current is not None:
            yield pd.DataFrame([current.result()], columns=names)

    return of


def shaped(rows: DataFrame) -> DataFrame:
    """Distinct rows with how often they occur and their first fault."""
    bare = F.btrim("text", F.lit(BLANKS))
    fault = F.when(F.length(bare) == 0, BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    keyed = rows.select("conv", "has_turn", "turn", "role", *line_key(F.col("text")), fault.alias("fault"))
    distinct = keyed.groupBy(*KEY, "fault").agg(F.count("*").alias("n"))
    same = ["role", "h1", "h2"]
    firsts = keyed.groupBy("conv", *same).agg(F.min(F.struct("has_turn", "turn")).alias("first")).withColumnRenamed("conv", "f_conv")
    joined = distinct.join(firsts.toDF("f_conv", "f_role", "f_h1", "f_h2", "first"),
                           F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("h1") == F.col("f_h1")) & (F.col("h2") == F.col("f_h2")))
    seen = (F.col("fault") != BLANK) & (F.struct("has_turn", "turn") > F.col("first"))
    return joined.select(*KEY, "n", F.when(seen, DUPLICATE).otherwise(F.col("fault")).cast("int").alias("fault"))


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows spoiled by a checksum of conversation and turn: 0 of 20 drops the row, 1 empties its text, 2 takes its
    full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's. A null counts as one space."""
    rows = narrow(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = rows.withColumn("fate", fate).filter("fate <> 0")
    spoiled = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(plain("role")).alias("role"), spoiled.alias("text"), copies.alias("copy")).drop("copy")


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row for each conversation that has rows: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn, nulls first; of one turn by role, then by a hash of the text, so
    equal ones stand together. A null role or text counts as one space; rows without a
    conversation are one conversation. Each row's first fault counts: blank, duplicate (role and
    text came before), truncated (its last character that is not blank ends no sentence).
    ``audit`` has the letters of the cheapest edits, D, I, K and R, the first of them in
    the order of ASCII; a conversation of which nothing is worth keeping ends empty.
    ``keep_text`` adds the repaired rows as ``repaired``.
    """
    kind = dict(conversations.dtypes)[conv_id]
    rows = narrow(importable(conversations), conv_id=conv_id, turn=turn, role=role, text=text)
    rows = rows.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    ordered = shaped(rows).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    segments = stored(ordered.select("conv", "has_turn", "turn", "role", "h1", "h2", "n", "fault").mapInPandas(pack, SEGMENTS))
    long = segments.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("l_conv"))
    parts = segments.join(long, F.col("conv").eqNullSafe(F.col("l_conv")), "left_semi").select("conv", "place", "rows").mapInPandas(measure, MEASURED)
    routes = parts.repartition("conv").sortWithinPartitions("conv", "place").mapInPandas(chain, ROUTES).toDF("r_conv", "r_place", "begin", "end")
    routed = segments.join(routes, F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("place") == F.col("r_place")), "left")
    begin, end = F.coalesce("begin", F.lit(START)).alias("begin"), F.coalesce("end", F.lit(GOAL)).alias("end")
    edits = routed.select("conv", "rows", begin, end).mapInPandas(trace, EDITS)
    none = F.lit(None).cast("string")
    texts = rows.select("conv", "has_turn", "turn", "role", *line_key(F.col("text")), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("fault"),
                        none.alias("edits"), none.alias("after"), "text")
    together = edits.unionByName(texts).repartition("conv").sortWithinPartitions(*KEY, "kind")
    out = together.mapInPandas(rebuild(keep_text), REPAIRED)
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *[c.split()[0] for c in REPAIRED.split(", ")[1 : None if keep_text else -1]])


def repaired_conversations(original: DataFrame, spoiled: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """The repair of ``spoiled``, with a row for every conversation of ``original``: one that has lost all its rows has none to repair."""
    everyone = narrow(original, o_id=conv_id).distinct()
    found = repair(spoiled)
    joined = everyone.join(found, F.col("o_id").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return joined.select(F.col("o_id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                         F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
