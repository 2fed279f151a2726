import pytest
from pyspark.sql import functions as F

from visitlake.llm import toxicity as T

SCHEMA, LABELS = "doc_id long, text string, score string, __p int", "doc_id long, quality int, toxic int"


def made(n, toxic):
    rows = []
    for i in range(n):
        words = ["the", "cat", f"w{i % 17}", "sat", "on", "mats"] * 6
        if toxic(i):
            at = i % 30
            words[at : at + 6] = ["you", "idiot"] * 3
        rows.append((i, " ".join(words), "x", 1))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.createDataFrame(made(400, lambda i: i % 3 == 0), SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(400)] + [(3, 0, None), (3, 0, 0), (None, 1, 1)], LABELS)
    return T.fit(docs, labels, trees=4)


def test_scores_every_row(spark, learned):
    rows = [(1, "the cat sat", "x", 1), (2, "you idiot you idiot", "y", 1), (3, None, "z", 2), (4, "", "z", 2), (2, "you idiot you idiot", "y", 1),
            (None, "cat " * 50_000, None, None)]
    got = learned.score(spark.createDataFrame(rows, SCHEMA), score="p", predicted="label").collect()
    assert len(got) == len(rows) and all(0 <= r.p <= 1 and r.label == int(r.p >= 0.5) for r in got)
    assert [r.label for r in got if r.doc_id == 2] == [1, 1]
    assert {r.label for r in got if r.doc_id in (1, 3, 4)} == {0}
    assert set(got[0].asDict()) == {"doc_id", "text", "score", "p", "label", "__p"}


def test_no_labels_or_one_class(spark):
    docs = spark.createDataFrame(made(20, lambda i: False), SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in T.score_documents(docs, none).collect()} == {(0.0, 0)}
    ones = spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert {(r.score, r.predicted) for r in T.score_documents(docs, ones).collect()} == {(1.0, 1)}
    assert T.score_documents(docs.limit(0), ones).count() == 0


def test_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame([(i, str(i), "", 0) for i in range(200)], SCHEMA)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(200)], LABELS)
    narrow = T.labelled(docs.select("doc_id", "text"), labels.select("doc_id", F.col("toxic").alias("y")), 10_000)
    import zlib

    assert sorted(int(r.text) for r in narrow.collect()) == [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]


def test_the_sample_is_bounded_and_stable(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("y"))
    first, again = (sorted(r.text for r in T.labelled(docs, labels.repartition(n), 1000).collect()) for n in (3, 7))
    assert first == again and 600 < len(first) <= 1000


def test_features_see_hidden_and_near_words():
    weights = T.Weights({"idiot": 5.0, "loser*": 3.0})
    of = dict(zip(T.FEATURES, T.features("YOU are an IDIOT! an 1d10t and id*iot, losers", weights), strict=True))
    assert of["insults"] == 1 and of["near_you"] == 1 and of["hits"] == 2 and of["obfuscated_hits"] >= 1
    assert (weights["loser"], weights["losers"], weights["lose"], weights["idiots"]) == (0.0, 3.0, 0.0, 0.0)
    assert T.features(None, weights) == T.features("", weights) == [0.0] * len(T.FEATURES)


def test_held_out_accuracy(spark):
    from visitlake.llm.queries import op3_boosted_toxicity

    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = op3_boosted_toxicity(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seen = got.filter("held_out").join(truth, "doc_id").select("score", "toxic", "predicted").collect()
    right = sum(r.predicted == r.toxic for r in seen) / len(seen)
    assert right >= 0.93, right
    assert not [r for r in seen if r.predicted and not r.toxic]


def test_clean_documents_stay(spark):
    docs = spark.createDataFrame(made(400, lambda i: i % 3 == 0), SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(200)], LABELS)
    kept = T.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(400) if i % 3]
