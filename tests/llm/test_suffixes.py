import hashlib
import random
from collections import Counter

import pytest

from visitlake.llm import suffixes as S


def brute(rows, length=S.LENGTH):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_array_by_sorting():
    rng = random.Random(1)
    cases = [[], [3], [1] * 50, [1, 2] * 30, [2, 1] * 30, list(range(40)), list(range(40, 0, -1)), [1, 1, 2] * 9 + [1, 1]]
    cases += [[rng.randrange(rng.choice([2, 3, 9, 200])) for _ in range(rng.randrange(120))] for _ in range(400)]
    for symbols in cases:
        assert S.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_a_string_has_one_anchor_wherever_it_stands():
    rng = random.Random(2)
    middle = bytes(rng.randrange(97, 101) for _ in range(S.LENGTH))
    seen = set()
    for _ in range(20):
        head, tail = (bytes(rng.randrange(256) for _ in range(rng.randrange(700))) for _ in range(2))
        for found in S.runs_of(head + middle + tail):
            for first, last, at, anchor, _ in zip(*found, strict=True):
                if first <= len(head) <= last:
                    seen.add((at - len(head), anchor))
    assert len(seen) == 1


def words(rng, n):
    return " ".join("".join(rng.choice("aeinrstö") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def made(seed):
    rng = random.Random(seed)
    passage, other = words(rng, 150), words(rng, 90)
    rows = [words(rng, rng.randrange(300)) for _ in range(12)]
    for _ in range(14):
        at = rng.randrange(len(passage) // 3)
        cut = passage[at : at + rng.randrange(300, 800)]
        rows.append(words(rng, rng.randrange(60)) + cut + words(rng, rng.randrange(60)) + (other if rng.random() < 0.4 else ""))
    base = words(rng, 260)
    for _ in range(8):
        edited = list(base)
        for _ in range(rng.randrange(4)):
            edited[rng.randrange(len(edited))] = rng.choice("xyzß ")
        rows.append("".join(edited))
    rows += ["Ther " * 200, "Ther " * 90 + "end", "a" * 1000, "a" * 399, "a" * 400, "ab" * 300, None, "", passage, passage, base * 3]
    return list(enumerate(rows))


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, runs string, n_bytes int")
    return sorted(map(tuple, S.remove_repeats(df.repartition(3)).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_strings(spark, seed):
    rows = made(seed)
    assert run(spark, rows) == brute(rows)


def test_large_groups_are_counted_start_by_start(spark, monkeypatch):
    rows = made(3)
    monkeypatch.setattr(S.repeated_spans, "__defaults__", (2,))
    assert run(spark, rows) == brute(rows)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(5)
    once, twice = words(rng, 60_000), words(rng, 40_000)
    rows = [(1, once + twice), (2, twice + "x"), (3, "y" * 300_000)]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[1][2] >= len(twice.encode()) and got[1][2] <= len(twice.encode()) + 8 and got[1][3] == 1
    assert got[2][2:4] == (len(twice.encode()), 1) and got[3][2:4] == (300_000, 1)


def test_repeated_rows_and_missing_ids(spark):
    rng = random.Random(6)
    one, two = words(rng, 120), words(rng, 130)
    rows = [(1, one), (1, one), (2, two), (None, two), (3, words(rng, 120)), (3, words(rng, 120))]
    assert run(spark, rows) == brute(rows)
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    kept = S.remove_repeats(spark.createDataFrame([(1, "é")], "doc_id long, text string"), keep_text=True).first()
    assert bytes(kept.kept) == "é".encode()
