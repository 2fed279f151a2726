import numpy as np
import pytest

from visitlake.llm import productquant as Q

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, key int"


def brute(rows, limit=0.9):
    ok = [v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, dtype=np.float32).astype(float) / np.linalg.norm(np.array(v, dtype=np.float32).astype(float)) if o else None for (_, v), o in zip(rows, ok, strict=True)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and unit[i] @ unit[j] >= limit:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (v, _) in enumerate(rows):
        least[find(i)] = min(v, least.get(find(i), v))
    return sorted((v, links[i], least[find(i)], v == least[find(i)]) for i, (v, _) in enumerate(rows))


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "clash", 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, Q.linked(df.repartition(3)).collect()))


def made(seed, loose):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(60):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 14)):
            out.append((centre + rng.normal(size=16) * loose * np.linalg.norm(centre) / 4).astype(np.float32).tolist())
    return out


@pytest.mark.parametrize("loose", [0.1, 0.3])
def test_against_all_pairs(spark, loose, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 40)
    vectors = made(3, loose)
    vectors += [vectors[0]] * 30 + [[0.0] * 16, None, [], [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, [-0.0] * 16]
    vectors += [[2 * x for x in vectors[0]], [1.0] + [0.0] * 15, [0.9] + [0.0] * 14 + [0.43588989]]
    rows = [(7 + i, v) for i, v in enumerate(vectors)]
    got, want = run(spark, rows), brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= there and found >= 0.99 * there
    if loose == 0.1:
        assert got == want


def test_repeated_rows_and_missing_ids(spark):
    v, w = [1.0] + [0.0] * 15, [0.0, 1.0] + [0.0] * 14
    rows = spark.createDataFrame([(5, v, 1, "", 0), (5, v, 1, "", 0), (None, v, 1, "", 0), (9, w, 1, "", 0), (None, w[::-1], 1, "", 0)], SCHEMA)
    got = sorted(map(tuple, Q.linked(rows).collect()), key=repr)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (9, 0, 9, True), (None, 0, None, True)], key=repr)


def test_every_length_links_on_its_own(spark):
    rng = np.random.default_rng(5)
    long, short = rng.normal(size=(30, 16)), rng.normal(size=(20, 8))
    vectors = [v for x in (long, short) for v in (*x, *x, *(x + rng.normal(size=x.shape) * 0.01))] + [[1.0, 2.0, 3.0]] * 2 + [[5.0]]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    own = list(range(30)) * 3 + [90 + i for i in range(20)] * 3 + [150, 150, 152]
    got = run(spark, rows)
    assert got == [(i, sum(o == own[i] for o in own) - 1, own[i], i == own[i]) for i in range(len(rows))]


def test_empty(spark):
    assert Q.linked(spark.createDataFrame([], SCHEMA)).count() == 0
    assert run(spark, [(1, None), (2, [])]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_looked_up_distances_are_those_of_the_codes():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    book = Q.Codebook.fit(points, 500, 0.9)
    own = Q.nearest(points, book.centroids)[1]
    codes, error = book.encode(points, own)
    mine = np.flatnonzero(own == own[0])
    coded = book.centroids[own[0]] + np.concatenate([p[codes[mine][:, i]] for i, p in enumerate(book.parts)], axis=1)
    want = ((points[:50][:, None] - coded[None]) ** 2).sum(2)
    assert np.allclose(book.looked_up(points[:50], int(own[0]), codes[mine]), want, atol=1e-9)
    assert np.allclose(error[mine], np.linalg.norm(points[mine] - coded, axis=1))


def test_recall_on_the_table(spark, monkeypatch):
    monkeypatch.setattr(Q, "TRAIN", 600)  # fewer than there are, as on a large table
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    unit = np.array([v for _, v in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    crowd = unit[:1] + np.random.default_rng(1).normal(size=(300, 64)) * 0.02
    more = [(10_000 + i, v.tolist()) for i, v in enumerate(crowd)]
    df = spark.createDataFrame(rows + more, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in Q.linked(df).collect()}
    every = np.array([v for _, v in rows + more], dtype=float)
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    want = (every @ every.T >= 0.9).sum(1) - 1
    assert sum(got.values()) >= 0.99 * want.sum() and want.sum() > 50_000


def all_pairs(vectors, limit=0.9):
    unit = np.asarray(vectors, dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return (unit @ unit.T >= limit).sum(1) - 1


def test_what_is_sent_stays_in_proportion(spark):
    """No vector is sent to every list that it may have a neighbour in."""
    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        there = manager.getAllFiles()
        return {there.apply(i).getPath(): there.apply(i).length() for i in range(there.size())}

    vectors = np.random.default_rng(4).normal(size=(8000, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(4).cache()
    rows.count()
    before = files()
    assert Q.linked(rows).agg({"n_links": "sum"}).first()[0] == 0
    assert sum(n for f, n in files().items() if f not in before) < 8 * vectors.nbytes
    rows.unpersist()


@pytest.mark.parametrize("rank", [4, 64])
def test_places_lose_next_to_nothing(spark, monkeypatch, rank):
    """Few vectors at a place, many rounds and blocks; at the limit, and where vectors differ in few directions only."""
    for name, value in {"TRAIN": 1500, "BLOCK": 10, "PAIR_S": 1e-3, "PLACE_S": 0, "LITTLE": 1}.items():
        monkeypatch.setattr(Q, name, value)
    fitted, fit = [], Q.Places.fit
    monkeypatch.setattr(Q.Places, "fit", staticmethod(lambda *a: fitted.append(fit(*a)) or fitted[-1]))
    rng = np.random.default_rng(6)
    space = np.linalg.qr(rng.normal(size=(64, 64)))[0][:rank]
    centres = rng.normal(size=(2000 if rank == 64 else 500, rank)) @ space
    vectors = np.concatenate([c + rng.normal(size=(rng.integers(1, 4), rank)) @ space * np.linalg.norm(c) * rng.uniform(0, 0.5) / rank**0.5 for c in centres])
    vectors = np.concatenate([vectors, vectors[:1] + rng.normal(size=(150, rank)) @ space * 0.01 * np.linalg.norm(vectors[0]) / rank**0.5])
    want = all_pairs(vectors)
    got = dict(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").transform(Q.linked).select("vec_id", "n_links").collect())
    got = np.array([got[i] for i in range(len(vectors))])
    assert (got <= want).all() and got.sum() >= 0.995 * want.sum()
    assert rank == 4 or fitted[0].held > 1


def test_a_pair_counts_at_the_first_place_it_shares():
    x = np.array([[1, 5, 9], [2, 5, -1]], dtype=np.int32)
    assert Q.earlier(9, x, x).tolist() == [[True, True], [True, True]]
    assert Q.earlier(5, x, x).tolist() == [[True, False], [False, True]]


def test_the_furthest_pairs_of_directions():
    rng = np.random.default_rng(3)
    first, second = rng.normal(size=(2, 40, 9))
    want = np.argsort(-(first[:, :, None] + second[:, None]).reshape(40, -1), axis=1)[:, :7]
    assert (Q.furthest(first, second, 7) == want).all()
