import random
import re

import numpy as np
import pytest

from visitlake.llm import components as C
from visitlake.llm import hyperminhash as H
from visitlake.llm.components import components


def brute(rows, share=85):
    """All pairs on full sets, written without the operator's code."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(i, least.get(find(x), i))
    return sorted((i, len(s), least[find(x)], i == least[find(x)]) for x, (i, s) in enumerate(sets))


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_against_all_pairs(spark):
    rng, rows = random.Random(4), []
    for g in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 12, 30, 90, 300]))]
        for _ in range(rng.randrange(1, 12)):
            rows.append(" ".join(near(rng, base, rng.randrange(0, 1 + len(base) // 60 + (g % 3 == 0)))))
    rows += ["", None, "  \t\n", "One", "one", "ONE\x0b", "É é", "é é", "a b c d e", "A B\tC d  e"] + ["x y z u v w"] * 3
    rows = list(enumerate(rows))
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, kept string, node int")
    got = sorted(map(tuple, H.linked(df.repartition(4)).collect()))
    assert got == brute(rows)


def test_a_chain_and_a_crowd_without_a_common_hub(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    chain, words = [], list(base)
    for k in range(30):
        words = list(words)
        words[(7 * k) % 200] = f"n{k}"
        chain.append(" ".join(words))
    crowd = [" ".join(near(rng, [f"c{i}" for i in range(250)], 5)) for _ in range(150)]
    rows = list(enumerate(chain + crowd))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, H.linked(df).collect())) == brute(sorted(rows))


def test_very_long_and_empty_tables(spark):
    long = " ".join(f"w{i % 9001}" for i in range(60_000))
    rows = [(1, long), (2, long + " more"), (3, "short text"), (None, "no id here at all"), (None, long)]
    got = H.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r[0], r[2], r[3]) for r in got), key=repr) == [(1, 1, True), (2, 1, False), (3, 3, True), (None, 1, False), (None, None, True)]
    assert H.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(1)
    for n in (400, 3000):
        for want in (0.0, 0.5, 0.85, 1.0):
            errors = []
            for _ in range(30):
                both = int(round(2 * n * want / (1 + want)))
                own = rng.integers(0, 2**63, size=2 * n, dtype=np.uint64)
                a, b = own[:n], np.concatenate([own[:both], own[n : 2 * n - both]])
                sketch = [H.registers(np.unique(x))[None] for x in (a, b)]
                errors.append(H.estimated(*sketch, np.array([n]), np.array([n]))[0] - want)
            assert abs(np.mean(errors)) < 0.03
    assert 0 < H.chance(10, 10) < 0.01


def test_sets_do_not_depend_on_the_order_of_repeats():
    of = lambda text: H.shingles(text, H.WordHashes())
    assert (of("a b c d e f a b c d e") == np.unique(of("a b c d e f a b c d e"))).all()
    assert len(of("a b")) == 1 and (of("a b") != of("a b c")).all()


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9)], [(i, i + 1) for i in range(20)], [(0, i) for i in range(1, 50)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges * 60:
        if a != b:
            low = min(want.get(a, a), want.get(b, b))
            want[a] = want[b] = low
    assert got == want


def test_rounds_are_stored_in_as_many_files_as_their_edges_need(spark, files_of, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i != 90], "a long, b long")
    want = {i: 0 if i <= 90 else 91 for i in range(201)}
    files = files_of(C)
    assert {r.node: r.component for r in components(edges).collect()} == want
    assert len(files) > 2 and max(files) == 1
    monkeypatch.setattr(C, "EDGES_AT_ONCE", 70)
    files.clear()
    assert {r.node: r.component for r in components(edges).collect()} == want
    assert max(files) == 1 + 199 // 70


def test_small_tables_are_stored_in_few_files(spark, files_of):
    files = files_of(H)
    rows = [(i, " ".join(f"w{(i // 2) * 50 + k}" for k in range(40)) + (" more" if i % 2 else "")) for i in range(200)]
    got = H.linked(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(i, i - i % 2) for i in range(200)]
    sketched, classes, members, sets, _, left, across, *_ = files
    assert sketched == 2 and classes == members == sets == 1 and left <= 1 and across <= 1


def test_one_of_each_component_stays(spark):
    rows = [(1, "a b c d e f", "s"), (2, "a b c d e f", "t"), (2, "a b c d e f", "t"), (1, "a b c d e f", "s"), (7, "", None), (8, None, "u"), (9, "other", "u")]
    kept = H.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert kept.columns == ["doc_id", "text", "source"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7, 8, 9]


def test_words_kept_are_bounded_by_bytes(monkeypatch):
    text = " ".join(f"word{i % 700}" for i in range(3000))
    whole = H.shingles(text, H.WordHashes())
    monkeypatch.setattr(H, "WORD_BYTES", 5000)
    known = H.WordHashes()
    assert (H.shingles(text, known) == whole).all() and len(known) < 5000 / H.ENTRY_BYTES


def test_stage_keeps_columns_of_any_name(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, "a", 7), (2, text, "b", 8), (3, "something else entirely", "c", 9)], "doc_id long, text string, __text string, __kept int")
    assert sorted(map(tuple, H.keep_one(docs).collect())) == [(1, text, "a", 7), (3, "something else entirely", "c", 9)]
