import random

import numpy as np

from pyspark.sql import functions as F

from visitlake.llm import latent as L

SPACE = np.ones((L.FEATURES + 1, 3), dtype=np.float32)


def words(rng, n, size=60_000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randrange(40))] for _ in range(2))
        assert L.common_subsequence(L.Item.places(a), b) == plain_lcs(a, b)


def test_decomposition_of_a_matrix_of_known_rank():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 80))
    block = rng.normal(size=(80, 14))
    vectors, values = L.decomposed(rows.T @ (rows @ block), block, 6)
    left, singular, right = np.linalg.svd(rows, full_matrices=False)
    assert np.allclose(values, singular[:6], rtol=1e-3)
    assert np.allclose(np.abs((vectors * right[:6].T).sum(axis=0)), 1, atol=1e-4)


def test_sketch_is_the_product_with_the_passages(spark):
    rng = random.Random(3)
    texts = [words(rng, n) for n in (0, 1, 15, 16, 17, 40, 200, 33)]
    df = spark.createDataFrame([(" ".join(t),) for t in texts] + [(None,)], "text string")
    tokens = L.tokenised(df)
    weights = L.inverse_frequencies(tokens)
    block = np.random.default_rng(1).normal(size=(L.FEATURES, 3)).astype(np.float32)
    rows = []
    for t in texts:
        halves = [t[i : i + L.HALF] for i in range(0, len(t), L.HALF)]
        for i, half in enumerate(halves):
            row = np.zeros(L.FEATURES)
            for c in L.columns_of(half + (halves[i + 1] if i + 1 < len(halves) else [])):
                row[c] += weights[c]
            rows.append(row)
    matrix = np.array(rows)
    assert np.allclose(L.sketch(tokens, weights, block), matrix.T @ (matrix @ block), rtol=1e-3, atol=1e-2)


def planted():
    rng = random.Random(5)
    items = [words(rng, n) for n in (15, 24, 40, 60, 18)]
    docs, truth = [], {}
    for i in range(150):
        doc = words(rng, rng.randrange(10, 500))
        if i % 3 == 0:
            k = rng.randrange(len(items))
            item = list(items[k])
            if i % 2:  # a paraphrase: a word in five replaced, none of the answer
                for j in range(0, len(item) * 3 // 4 - 2, 5):
                    item[j] = f"other{j}"
            at = rng.randrange(len(doc))
            doc[at:at] = [w.upper() + "," if i % 4 == 0 else w for w in item]
            truth[i] = k
        docs.append((i, " ".join(doc), "clash", 0))
    return items, docs, truth


def test_planted_items_are_found_and_nothing_else(spark, monkeypatch):
    items, docs, truth = planted()
    docs += [(900, None, "", 0), (901, "", "", 0), (None, " ".join(items[2]), "", 0), (0, docs[0][1], "", 0), (902, " ".join(items[1][:6]), "", 0),
             (903, " ".join(words(random.Random(8), 40_000)) + " " + " ".join(items[3]), "", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, leaks string, item_id int")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(77, None), (78, ""), (79, "...")], "item_id long, text string")
    want = sorted([(i, [truth[i]] if i in truth else []) for i in range(150)] + [(0, [truth[0]]), (900, []), (901, []), (902, []), (903, [3]), (None, [2])], key=repr)
    got = sorted(((r.doc_id, r.item_ids) for r in L.contaminated(df, bench).collect()), key=repr)
    assert got == want
    monkeypatch.setattr(L, "ITEMS_AT_ONCE", 3)
    more = sorted(((r.doc_id, r.item_ids) for r in L.contaminated(df.filter("doc_id < 100"), bench).collect()), key=repr)
    assert more == [w for w in want if w[0] is not None and w[0] < 100]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some text of an item")], "item_id long, text string")
    assert [r.leaked for r in L.contaminated(df, bench.limit(0)).collect()] == [False]
    assert L.contaminated(df.limit(0), bench).count() == 0


def test_every_exact_passage_of_the_table_is_found(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, " ".join(L.words_of(r.text))) for r in bench.collect()]
    holds = {(r.doc_id, k) for r in docs.collect() for t in [" ".join(L.words_of(r.text))] for k, i in items if f" {i} " in f" {t} "}
    found = {(r.doc_id, k) for r in L.contaminated(docs, bench).collect() for k in r.item_ids}
    assert holds and holds <= found and len(found - holds) <= 1


def found_in(spark, docs, items):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r.item_ids for r in L.contaminated(df, bench).collect()}


def test_an_item_in_a_third_of_the_rows_is_found(spark):
    rng = random.Random(11)
    items = [words(rng, 30), words(rng, 30)]
    paraphrase = [f"other{j}" if j % 5 < 2 and j < 20 else w for j, w in enumerate(items[0])]
    docs = []
    for i in range(150):
        doc = words(rng, 200)
        doc[90:90] = items[0] if i % 3 == 0 else items[1] if i == 1 else paraphrase if i == 2 else []
        docs.append(" ".join(doc))
    docs += [docs[0]] * 30
    want = {i: [0] if i % 3 == 0 or i == 2 or i >= 150 else [1] if i == 1 else [] for i in range(180)}
    assert found_in(spark, docs, [" ".join(i) for i in items]) == want


def test_tables_of_a_few_documents(spark):
    rng = random.Random(12)
    items = [words(rng, 24), words(rng, 40)]
    docs = [" ".join(words(rng, 60) + items[0] + words(rng, 60)), " ".join(words(rng, 100)), " ".join(words(rng, 20) + items[1])]
    texts = [" ".join(i) for i in items]
    assert found_in(spark, docs, texts) == {0: [0], 1: [], 2: [1]}
    assert found_in(spark, docs[:1], texts) == {0: [0]}
    assert found_in(spark, docs * 5, texts) == {i: [[0], [], [1]][i % 3] for i in range(15)}


def test_long_documents_do_not_make_their_words_common(spark):
    rng = random.Random(13)
    items = [words(rng, 30, 10**9), words(rng, 40, 10**9)]
    docs = []
    for i in range(60):
        doc = words(rng, 5_000, 10**9)
        doc[2_500:2_500] = items[i] if i < 2 else []
        docs.append(" ".join(doc))
    texts = [" ".join(i) for i in items]
    assert found_in(spark, docs, texts) == {i: [i] if i < 2 else [] for i in range(60)}
    rows = spark.createDataFrame([(d,) for d in docs], "text string")
    vocabulary = sorted({w for i in items for w in i})
    n_halves, by_column, n_texts, by_word = L.frequencies(L.tokenised(rows, vocabulary), len(vocabulary))
    assert n_texts == 60 and (by_word == 1).all()
    # Weights tell a rare word from one that stands everywhere, whatever columns it shares.
    weights = L.weights_of(n_halves, by_column)
    assert weights[L.columns_of(vocabulary)].min() > 5


def test_words_of_the_vocabulary_are_found_by_their_hashes():
    words = [f"word{i}" for i in range(3000)]
    places = L.Vocabulary(words[500:900])
    assert places.held(L.hashed([words[890], "none", words[500], words[890], words[10]])).tolist() == [0, 390]
    assert places.held(L.hashed([])).tolist() == L.Vocabulary([]).held(L.hashed(words)).tolist() == []
    assert sorted(set(L.columns_of(words).tolist())) == sorted({int(h) % L.FEATURES for h in L.hashed(words)})


def test_the_sample_is_bounded_and_stable(spark):
    rows = [(i, f"text {i} of its own with some words") for i in range(900)]
    tokens = L.tokenised(spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text")))
    assert L.sampled(tokens, 900).count() == 900
    first, again = (sorted(r.doc_id for r in L.sampled(t, 200).collect()) for t in (tokens, tokens.repartition(5)))
    assert first == again and 150 <= len(first) <= 250


def test_chunks_are_bounded_by_bytes_and_lose_no_text(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(L, "CHUNK_BYTES", 50)
    texts = ["x" * n for n in (10, 10, 200, 5, 49, 2, 0, 60)] + [None, "y"]
    parts = list(L.chunks(iter([pd.DataFrame({"text": texts}), pd.DataFrame({"text": []})])))
    assert [t for p in parts for t in p["text"]] == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p["text"]) <= 50 for p in parts)


def test_stage_keeps_columns_of_any_name(spark):
    item = " ".join(f"secret{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, 5, "x"), (2, "nothing of the kind", 6, "y"), (None, None, 7, "z")], "doc_id long, text string, __id int, __hash string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert sorted(map(tuple, L.keep_unleaked(docs, bench).collect()), key=repr) == [(2, "nothing of the kind", 6, "y"), (None, None, 7, "z")]


def test_the_space_is_fitted_on_every_row(spark, monkeypatch):
    seen, fit = [], L.latent_space
    monkeypatch.setattr(L, "FITTED", 10)
    monkeypatch.setattr(L.sampled, "__defaults__", (10,))
    monkeypatch.setattr(L, "latent_space", lambda tokens, *rest: seen.append(tokens.count()) or fit(tokens, *rest))
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join(words(rng, 40))) for i in range(60)], "doc_id long, text string")
    L.leaks(docs, spark.createDataFrame([(1, " ".join(words(rng, 20)))], "item_id long, text string"))
    assert seen == [60]


def test_words_of_many_texts_are_hashed_as_one_by_one(monkeypatch):
    rng = random.Random(21)
    some = ["a", "B_9", "élan", "Straße", "İx", "日本", "x" * 63, "y" * 64, "z" * 65, "é" * 90, "w" * 300, "naïve"]
    between = [" ", "\n", ", ", "—", "«", " ", "'", "\x85", "...", "\U0001f600", "\x00"]
    texts = ["".join(rng.choice(some) + rng.choice(between) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [None, "", "—", "one", " ", None, "ends", "x"]
    vocabulary = L.Vocabulary(sorted({w for t in texts[:5] for w in L.words_of(t)}))
    for size in (L.CHUNK_BYTES, 50):
        monkeypatch.setattr(L, "CHUNK_BYTES", size)
        found, counts = L.hashed_texts(texts)
        assert counts.tolist() == [len(L.words_of(t)) for t in texts]
        assert found.tolist() == [int(h) for t in texts for h in L.hashed(L.words_of(t))]
        held = vocabulary.held_by(found, counts)
        assert [h.tolist() for h in held] == [vocabulary.held(L.hashed(L.words_of(t))).tolist() for t in texts]
    assert [h.tolist() for h in L.Vocabulary([]).held_by(found, counts)] == [[]] * len(texts)
    assert [len(x) for x in L.hashed_texts([None, ""])] == [0, 2]


def test_rows_are_summed_by_number():
    rng = np.random.default_rng(6)
    numbers = np.where(rng.random((500, 5)) < 0.3, 7, rng.integers(0, 400, (500, 5))).astype(np.uint16)
    rows = rng.normal(size=(500, 3))
    want = np.zeros((400, 3))
    np.add.at(want, numbers.ravel(), np.repeat(rows, 5, axis=0))
    found, sums = L.summed(numbers, rows)
    assert sorted(found.tolist()) == np.unique(numbers).tolist() and np.allclose(sums, want[found])
    assert [len(x) for x in L.summed(numbers[:0], rows[:0])] == [0, 0]


def test_candidates_are_all_that_are_close_and_can_leak():
    """Against each passage and item compared by itself: what is left out has under half of the item around."""
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, n, 300))) for k, n in enumerate((5, 20, 33, 70))]
    texts = [words(rng, n, 300) for n in (0, 3, 16, 90, 250)] + [words(rng, 20, 300) + items[2][1].split() + words(rng, 9, 300)]
    space = np.random.default_rng(5).normal(size=(L.FEATURES + 1, 8)).astype(np.float32)
    space[-1] = 0
    held = {w: 0.01 for _, t in items for w in t.split()}
    table, passages = L.Items(items, held, space), L.Passages.of([L.columns_of(t) for t in texts])
    own = L.unit(passages.joined(passages.halves(space)))
    got, want = set(zip(*(x.tolist() for x in table.candidates(passages, space, 0.15)), strict=True)), set()
    for p, (doc, number) in enumerate(zip(passages.owner, passages.number, strict=True)):
        for k, item in enumerate(table.items):
            parts = L.Passages.of([L.columns_of(item.words)])
            latent = L.unit(parts.joined(parts.halves(space)))[::2]
            around = texts[doc][max(0, number * L.HALF - len(item.words)) : number * L.HALF + 2 * L.HALF + len(item.words)]
            if (latent @ own[p]).max() >= 0.15 and any(item.shares(around)):
                want.add((p, k))
    assert want and want <= got and len(got) < len(passages.owner) * len(items) / 2


def test_a_task_sums_several_partitions(spark, monkeypatch):
    seen, made = [], type(spark.range(1)).mapInPandas
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, " ".join(words(rng, 30))) for i in range(200)], "doc_id long, text string").repartition(80)
    tokens = L.tokenised(docs).repartition(80)
    monkeypatch.setattr(type(tokens), "mapInPandas", lambda df, *how: seen.append(df.rdd.getNumPartitions()) or made(df, *how))
    L.sketch(tokens, np.ones(L.FEATURES + 1, dtype=np.float32), np.ones((L.FEATURES, 2), dtype=np.float32))
    assert seen == [max(80 // L.FITTED_AT_ONCE, spark.sparkContext.defaultParallelism)]


def test_rows_that_stay_are_not_shuffled_to_be_told_from_leaks(spark):
    from tests.conftest import plan_of

    item = " ".join(f"secret{i}" for i in range(20))
    docs = spark.createDataFrame([(i, item if i == 3 else f"text {i}") for i in range(20)], "doc_id long, text string")
    kept = L.keep_unleaked(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert "BroadcastHashJoin" in plan_of(kept) and "SortMergeJoin" not in plan_of(kept)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(20) if i != 3]
