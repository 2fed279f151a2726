"""Toxicity by boosted trees over dense features, calibrated by isotonic regression.

``fit`` learns from labelled rows: first a lexicon (words and word beginnings that toxic
rows hold far more often than clean ones), then trees over the features of ``FEATURES``,
then a monotone map from the trees' probability to the observed rate, on rows the trees
did not see. At most ``MAX_LABELLED`` labelled rows are used, picked by a hash of their id;
scoring reads every row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, narrow, stored, unused

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
MAX_LABELLED, LEXICON_SIZE, TREES, DEPTH = 100_000, 5_000, 30, 4
#: Rows a leaf of a tree has at least: fewer say nothing where one label in ten is wrong.
LEAF_ROWS = 8
STEMS, STRONG, WINDOW, NEAR, WEIGHTS_KEPT = (4, 5), 4.0, 40, 4, 400_000

INSULTS = frozenset("""
    asshole bastard bitch clown coward creep crap cretin degenerate disgusting dumb dumbass fool freak garbage
    hate idiot imbecile jerk kill loser lunatic moron nasty pathetic pig scum shit stupid trash ugly vermin
    vile worthless arschloch dumm dummkopf idioten trottel blöd hurensohn abschaum widerlich connard con idiote
    imbécile salaud stupide crétin ordure estúpido idiota imbécil basura asqueroso cabrón mierda pendejo
""".split())
YOU = frozenset("""
    you your yours yourself u ur ya du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous
    votre vos usted ustedes ti tú tus vosotros vuestro
""".split())
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                       "*": None, "#": None, "%": None, ".": None, "-": None, "_": None})
FEATURES = ("log_words", "hits", "hit_density", "weight", "weight_density", "strong", "strong_density", "most_in_window",
            "insults", "insult_density", "you_density", "near_you", "near_you_density", "capitals", "shouted_words",
            "exclaiming", "punctuation", "obfuscated", "obfuscated_hits", "digits")

WORD, MIXED, SHOUTED = (re.compile(x) for x in (
    r"[^\W\d_]+", r"[^\W\d_]+[0-9@$!*#%._-]+[^\W\d_]+[0-9@$!*#%._\-\w]*", r"\b[A-Z]{3,}\b"))
UPPER, DIGITS, EXCLAIMING, PUNCTUATION = (np.isin(np.arange(256), list(x)) for x in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"))


def terms(word: str) -> list[str]:
    """What the lexicon can hold of a word: itself, and its beginnings marked by a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


class Weights(dict):
    """The weight of a word; remembers words met before, up to a bound."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= WEIGHTS_KEPT:
            self.clear()
        weight = self[word] = max(self.lexicon.get(t, 0.0) for t in terms(word))
        return weight


def features(text: str | None, weights: Weights) -> list[float]:
    """One value for each of ``FEATURES``, over the whole text. All zero for null and empty texts."""
    if not text:
        return [0.0] * len(FEATURES)
    words = WORD.findall(text.lower())
    n, of = max(len(words), 1), np.fromiter(map(weights.__getitem__, words), dtype=float, count=len(words))
    hit = np.flatnonzero(of)
    strong = int((of >= STRONG).sum())
    most = int((np.searchsorted(hit, hit + WINDOW) - np.arange(len(hit))).max()) if len(hit) else 0
    insults = [i for i, w in enumerate(words) if w in INSULTS]
    you = np.array([i for i, w in enumerate(words) if w in YOU])
    marked = np.union1d(hit, insults).astype(int)
    near = 0
    if len(you) and len(marked):
        right = np.minimum(np.searchsorted(you, marked), len(you) - 1)
        near = int((np.minimum(abs(you[right] - marked), abs(you[np.maximum(right - 1, 0)] - marked)) <= NEAR).sum())
    data = text.encode()
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    mixed = MIXED.findall(text)
    hidden = sum((plain := m.lower().translate(PLAIN)) in INSULTS or weights[plain] > 0 for m in mixed)
    size = len(data)
    return [math.log1p(len(words)), len(hit), len(hit) / n, of.sum(), of.sum() / n, strong, strong / n, most,
            len(insults), len(insults) / n, len(you) / n, near, near / n, count[UPPER].sum() / size,
            len(SHOUTED.findall(text)) / n, count[EXCLAIMING].sum() / size, count[PUNCTUATION].sum() / size,
            len(mixed) / n, hidden, count[DIGITS].sum() / size]


def feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    weights: list[Weights] = []

    def of(texts: pd.Series) -> pd.Series:
        if not weights:
            weights.append(Weights(lexicon))
        return pd.Series([features(t if isinstance(t, str) else None, weights[0]) for t in texts])

    # Not deterministic by name only: so that a filter above does not have it run twice.
    return F.pandas_udf(of, "array<double>").asNondeterministic()(text)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """Texts with a label outside the held-out fold: ``text, y, fold``.

    Of several labels of an id the highest counts. The ids joined are bounded by
    ``max_labelled`` (a hash picks the same ones every time), so they may be broadcast.
    """
    ids = (labels.filter("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.max("y").alias("y"))
           .withColumn("fold", fold(F.col("doc_id"))).filter(F.col("fold") != HELD_OUT))
    total = ids.count()
    if total > max_labelled:
        share = max(max_labelled - 4 * math.isqrt(max_labelled), 1) / total
        ids = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) < int(share * 1_000_000_007))
    return docs.join(F.broadcast(ids), "doc_id").select("text", "y", "fold")


def learn_lexicon(rows: DataFrame, size: int) -> dict[str, float]:
    """The terms with the largest log odds of a toxic row, weighted by them.

    A term needs more toxic rows than chance gives, a number that grows with the sample.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(batch["text"], batch["y"], strict=True):
                own = {t for w in set(WORD.findall(text.lower())) for t in terms(w)} if isinstance(text, str) else ()
                (toxic if y else clean).update(own)
            both = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"term": both, "toxic": [toxic[t] for t in both], "clean": [clean[t] for t in both]})

    totals = rows.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = totals.toxic or 0, totals.n - (totals.toxic or 0)
    if not toxic or not clean:
        return {}
    support = math.ceil(3 + math.log10(totals.n))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    best = (rows.select("text", "y").mapInPandas(count, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter(F.col("toxic") >= support).withColumn("weight", odds)
            .filter(F.col("weight") / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)) >= 4)
            .filter("weight >= 2").orderBy(F.desc("weight"), F.desc("toxic"), "term").limit(size))
    return {r.term: float(r.weight) for r in best.collect()}


@dataclass
class ToxicityModel:
    """``trees`` is None where the labels had one class only: every score is then ``rate``."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def score(self, df: DataFrame, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
        """All rows and columns of ``df`` with a score from 0 to 1 and 1 where it is 0.5 or more.

        The columns travel as one, so that none of them can clash with what the model adds;
        columns named like the two results are replaced."""
        columns = [c for c in df.columns if c not in (score, predicted)]
        if self.trees is None:
            out = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), F.lit(self.rate).alias("__score"))
        else:
            table = importable(df).select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
                                          array_to_vector(feature_column(F.col(f"`{text}`"), self.lexicon)).alias("__features"))
            out = self.trees.transform(table).withColumn("__p", vector_to_array("__probability")[1])
            out = self.calibration.transform(out) if self.calibration else out.withColumn("__calibrated", F.col("__p"))
            # A trace of the uncalibrated value keeps the order within the steps of the calibration.
            value = F.col("__calibrated") * 0.999 + F.col("__p") * 0.001
            out = out.withColumn("__score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))
        return out.select(*[F.col("__row").getField(c).alias(c) for c in columns], F.col("__score").alias(score),
                          (F.col("__score") >= 0.5).cast("int").alias(predicted))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_labelled: int = MAX_LABELLED, lexicon_size: int = LEXICON_SIZE, trees: int = TREES) -> ToxicityModel:
    """Learns from the rows of ``labels`` outside the held-out fold.

    Null ids and null labels are left out; of several labels of an id the highest counts.
    Without labels, or with one class only, the model scores every text with the rate of
    toxic rows (0 without labels). Ids, languages and sources are no features.
    """
    docs, labels = narrow(importable(docs), doc_id=doc_id, text=text), narrow(labels, doc_id=doc_id, y=label)
    rows = stored(labelled(docs, labels, max_labelled))
    rate = rows.agg(F.avg("y")).first()[0] or 0.0
    learn = rows.filter(F.col("fold") != CALIBRATION)
    counts = learn.agg(F.sum("y"), F.count("*")).first()
    if not counts[0] or counts[0] == counts[1]:
        return ToxicityModel({}, None, None, float(rate))
    lexicon = learn_lexicon(learn, lexicon_size)
    table = stored(rows.select(array_to_vector(feature_column(F.col("text"), lexicon)).alias("__features"),
                               F.col("y").cast("double").alias("y"), "fold"))
    boosted = GBTClassifier(featuresCol="__features", labelCol="y", predictionCol="__tree", maxIter=trees,
                            maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=LEAF_ROWS, seed=7)
    boosted = boosted.setRawPredictionCol("__raw").setProbabilityCol("__probability")
    model = boosted.fit(table.filter(F.col("fold") != CALIBRATION).coalesce(8))
    unseen = model.transform(table.filter(F.col("fold") == CALIBRATION)).select(
        vector_to_array("__probability")[1].alias("__p"), "y")
    seen = unseen.agg(F.sum("y"), F.count("*")).first()
    calibration = None
    if seen[0] and seen[0] != seen[1]:
        calibration = IsotonicRegression(featuresCol="__p", labelCol="y", predictionCol="__calibrated").fit(unseen)
    return ToxicityModel(lexicon, model, calibration, float(rate))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null id is not held out."""
    model = fit(docs, labels)
    rows = narrow(docs, doc_id="doc_id", text="text")
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    return model.score(rows).select("doc_id", held_out, "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with their own columns, that the model does not reject.

    Null and empty texts are clean as long as the labels have clean rows; repeated rows stay repeated, an empty table stays empty."""
    columns = docs.columns
    score, rejected = unused(docs, "__score", "__rejected")
    scored = fit(docs, labels).score(docs, score=score, predicted=rejected)
    return scored.filter(F.col(rejected) == 0).select(*[F.col(f"`{c}`") for c in columns])
