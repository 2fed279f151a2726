import hashlib
import random
import re

import numpy as np
import pytest

from visitlake.llm import recompression as R
from visitlake.llm.queries import op13_recompression

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, words in docs:
        for k in range(len(words) - 12):
            window = tuple(words[k : k + 13])
            first[window] = min(first.get(window, i), i, key=order)
    out = []
    for i, words in docs:
        gone = bytearray(len(words))
        for k in range(len(words) - 12):
            if order(first[tuple(words[k : k + 13])]) < order(i):
                gone[k : k + 13] = b"\1" * 13
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **how):
    docs = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], "doc_id long, text string, anchor long, text_hash string, starts int")
    return sorted((tuple(r)[:4] for r in R.remove_repeats(docs, **how).collect()), key=repr)


def made(seed):
    rng = random.Random(seed)
    some = [f"w{k}" for k in range(rng.choice([2, 6, 400]))]
    sentence = lambda n: [rng.choice(some) for _ in range(n)]
    passage = sentence(60)
    rows = [sentence(rng.randrange(120)) for _ in range(10)]
    for _ in range(14):
        at = rng.randrange(40)
        rows.append(sentence(rng.randrange(30)) + passage[at : at + rng.randrange(11, 40)] + sentence(rng.randrange(30)))
    base = sentence(150)
    for _ in range(8):
        edited = list(base)
        edited[rng.randrange(len(edited))] = rng.choice(["new", base[0]])
        rows.append(edited)
    rows += [["again"] * rng.randrange(10, 60) for _ in range(4)] + [base, base]
    rng.shuffle(rows)
    return [(3 * i - 20, rng.choice([" ", "\n", "\t \r\n", "\x0b"]).join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_windows(spark, seed):
    rows = made(seed)
    assert run(spark, rows) == brute(rows)


def test_nulls_empty_repeated_and_missing_ids(spark):
    text = " ".join(f"word{k}" for k in range(30))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, " ".join(text.split()[:12])), (5, text), (5, text), (5, "x " + text), (None, text), (None, "y " + text),
            (9, text.replace(" ", " ")), (10, " ".join(text.split())), (6, text + " " + text), (11, "one")]
    assert run(spark, rows) == brute(rows)


def test_very_long_text_is_read_in_portions(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(9000)]
    rows = [(1, " ".join(words[4000:4400])), (2, " ".join(words)), (3, "z" * 9000 + " " + " ".join(words[:40]) + " " + "y" * 9000)]
    monkeypatch.setattr(R, "BYTES", 3000)
    monkeypatch.setattr(R, "WORDS", 500)
    assert run(spark, rows) == brute(rows)


def test_a_full_bitmap_changes_nothing(spark):
    rows = made(7)
    assert run(spark, rows, bits=32) == brute(rows)


def test_many_texts_are_parsed_in_portions_that_a_cache_holds():
    texts = [" ".join(f"w{k % 97}" for k in range(i, i + 4000)) for i in range(60)]
    found = list(R.parsed(texts))
    assert sum(len(f.start) for f in found) == 60 * 3988 and max(len(f.start) for f in found) <= 120_000
    assert [int(r) for f in found for r in f.row] == [i for i in range(60) for _ in range(3988)]


def test_bytes_are_split_where_words_end():
    text = "a\x1cb\x85c\u00a0d\u2003é\x0b\x0c\r\n\t  日本\x1f \x00 z"
    assert [w.decode() for w in R.without(text.encode(), None)[1]] == WORD.findall(text)
    words = [f"w{k}" for k in range(40)]
    count, left = R.without(" ".join(words).encode(), [{"start": 3, "count": 1}, {"start": 20, "count": 4}])
    assert (count, [w.decode() for w in left]) == (40, words[:3] + words[16:20] + words[36:])


def test_empty_table(spark):
    assert run(spark, []) == []


def test_words_that_stay(spark):
    docs = spark.createDataFrame([(2, "a b " * 10 + "end"), (1, "a  b " * 10)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in R.remove_repeats(docs, keep_text=True).collect()} == {1: " ".join(["a b"] * 10), 2: "end"}


def test_equal_windows_have_one_anchor_wherever_they_stand():
    """What recompression promises: symbols inside a passage do not depend on what surrounds it."""
    rng = np.random.default_rng(3)
    for size in (2, 5, 1000):
        middle, seen = rng.integers(1, size + 1, size=60).astype(np.uint64), set()
        for _ in range(30):
            head, tail = (rng.integers(1, size + 1, size=rng.integers(0, 50)).astype(np.uint64) for _ in range(2))
            words = R.mixed(np.concatenate([head, middle, tail]))
            starts, anchor, _ = R.anchored(words, np.zeros(len(words), dtype=np.int64))
            at = np.searchsorted(starts, len(head))
            seen.add(tuple(anchor[at : at + 48]))
        assert len(seen) == 1


def test_rounds_shrink_the_text_and_keep_supports_in_order():
    words = R.mixed(np.random.default_rng(4).integers(0, 300, size=5000).astype(np.uint64))
    found = R.rounds(words, np.zeros(5000, dtype=np.int64), 4)
    assert [len(f[0]) for f in found] == sorted((len(f[0]) for f in found), reverse=True) and len(found[-1][0]) < 2500
    for _, low, high in found:
        assert (np.diff(low) >= 0).all() and (np.diff(high) >= 0).all()


def test_query_over_the_whole_table(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, op13_recompression(spark, sf_dir).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_texts_that_lose_nothing_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(9)
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) + (" " + shared if i % 20 == 0 else "")) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joins, join = [], type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda a, b, *how: joins.append(a) or join(a, b, *how))
    out = R.remove_repeats(docs)
    sent = [r for r in joins[-1].collect() if r.data is not None]
    assert sorted(r.doc_id for r in sent) == [20, 40, 60, 80]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows)
