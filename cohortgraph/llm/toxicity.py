"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A bounded, documented sample of labelled rows (``SAMPLE``, the smallest ids by hash) is dealt into
three folds by id hash: one finds the words that go with the label (a learned lexicon beside the
fixed one), one fits the trees, one the isotonic calibration. Labels of held-out ids are never read
into any of them. Features are made in one map-only pass over whole texts; the trees and the
calibration are MLlib models, so scoring stays a projection.

Defined cases: null text is empty and scored as such; a null or unlabelled id is scored, not learned
from; several labels of an id count as the largest; without both labels in a fold every document gets
the share of toxic labels; repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cohortgraph.llm import common

#: Labelled rows that are learned from at most.
SAMPLE = 20_000
#: Learned words: at least so many toxic texts, so much log odds, so many words at most (by log odds).
LEAST_TEXTS, LEAST_ODDS, WORDS = 5, 3.0, 5_000
FOLDS = {"words": (0, 4), "trees": (4, 8), "calibration": (8, 10)}
INSULTS = frozenset("idiot moron stupid loser pathetic worthless scum trash clown disgusting dumb fool jerk bastard".encode().split())
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine tu te toi ton ta tes vous votre usted ustedes ti tuyo vos".encode().split())
#: Bytes of the stem of a longer word: inflected words share it.
STEM = 4
NEAR = 5
WINDOW = 50
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UPPER = bytes(range(65, 91))
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_MIXED = re.compile(rb"[a-z]+[0-9@$*!|+]+[a-z]+|[0-9@$*!|+]+[a-z]{2,}")
_PLAIN = bytes.maketrans(b"0134578@$!|+", b"oieastbasiit")
_SPACED = re.compile(rb"(?:\b[a-z][ .\-_]){3,}[a-z]\b")
FEATURES = (
    "lexicon_density", "lexicon_count", "lexicon_kinds", "lexicon_window", "learned_density", "learned_count", "learned_weight", "learned_window",
    "stem_density", "stem_count", "stem_weight",
    "second_density", "second_near", "second_near_share", "capitals", "capital_words", "exclamations", "questions", "punctuation", "mixed_words", "hidden_lexicon",
    "spaced_letters", "digits", "non_ascii", "length",
)


def _window(hits: np.ndarray) -> float:
    """Most hits in any WINDOW words."""
    c = np.concatenate([[0], np.cumsum(hits)])
    return float((c[WINDOW:] - c[:-WINDOW]).max()) if len(hits) > WINDOW else float(c[-1])


def features(text: bytes, learned: dict[bytes, float], stems: dict[bytes, float]) -> list[float]:
    words = text.translate(_TABLE).split()
    n, size = len(words), max(1, len(text))
    base = max(1, n)
    insults = np.fromiter(map(INSULTS.__contains__, words), bool, n)
    weights = np.fromiter(map(learned.get, words, repeat(0.0)), np.float64, n)
    stemmed = np.fromiter(map(stems.get, [w[:STEM] for w in words], repeat(0.0)), np.float64, n) if stems else np.zeros(n)
    second = np.fromiter(map(SECOND.__contains__, words), bool, n)
    hits = insults | (weights > 0) | (stemmed > 0)
    beside = np.concatenate([[0], np.cumsum(second)])
    at = np.flatnonzero(hits)
    near = int((beside[np.minimum(at + NEAR + 1, n)] > beside[np.maximum(at - NEAR, 0)]).sum()) if len(at) else 0
    lower = text.lower()
    mixed = _MIXED.findall(lower)
    hidden = sum((p := w.translate(_PLAIN)) in INSULTS or p in learned for w in mixed)
    upper = len(text) - len(text.translate(None, _UPPER))
    shouted = sum(len(w) > 1 for w in re.findall(rb"\b[A-Z]+\b", text)) if upper else 0
    k = int(insults.sum())
    return [
        k / base, math.log1p(k), len({words[i] for i in np.flatnonzero(insults)}), _window(insults),
        float((weights > 0).sum()) / base, math.log1p(float((weights > 0).sum())), float(weights.max()) if n else 0.0, _window(weights > 0),
        float((stemmed > 0).sum()) / base, math.log1p(float((stemmed > 0).sum())), float(stemmed.max()) if n else 0.0,
        float(second.sum()) / base, math.log1p(near), near / max(1, len(at)), upper / size, shouted / base,
        text.count(b"!") / size, text.count(b"?") / size, (len(text) - len(text.translate(None, _PUNCT))) / size, len(mixed) / base, float(hidden),
        float(len(_SPACED.findall(lower))), (len(text) - len(text.translate(None, b"0123456789"))) / size,
        (len(text) - len(text.decode("utf-8", "replace"))) / size, math.log1p(n),
    ]


def with_features(docs: DataFrame, text_col: str, learned: tuple[dict[bytes, float], dict[bytes, float]], name: str = "_features") -> DataFrame:
    """All columns of ``docs`` and an array of features."""
    words = docs.sparkSession.sparkContext.broadcast(learned)

    def make():
        lexicon, stems = words.value

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [features((t or "").encode(), lexicon, stems) for t in part.column(text_col).to_pylist()]
            flat = pa.array(np.array(rows, np.float64).reshape(-1))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            return pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, flat)], names=[*part.schema.names, name])

        return step

    schema = StructType([*docs.schema.fields, StructField(name, ArrayType(DoubleType()))])
    return common.map_arrow(docs, make, schema, text_col)


def held_out(id_col: Column) -> Column:
    return common.id_remainder(id_col, 5) == 0


class Model:
    """Fitted words, trees and calibration; ``score`` adds a column to any table of documents."""

    def __init__(self, learned: tuple[dict[bytes, float], dict[bytes, float]], trees, calibration, prior: float):
        self.learned, self.trees, self.calibration, self.prior = learned, trees, calibration, prior

    def score(self, docs: DataFrame, *, text_col: str = "text", name: str = "score") -> DataFrame:
        """All columns of ``docs`` and the calibrated score from 0 to 1."""
        if self.trees is None:
            return docs.withColumn(name, F.lit(self.prior))
        kept = docs.columns
        fed = with_features(docs, text_col, self.learned).withColumn("_vector", array_to_vector("_features")).drop("_features")
        raw = self.trees.transform(fed).withColumn("_p", vector_to_array("_probability")[1])
        out = self.calibration.transform(raw)
        # a hundredth of the trees' own order parts what the steps of the calibration tie
        return out.select(*[out[c] for c in kept], (0.99 * F.least(F.greatest("_step", F.lit(0.0)), F.lit(1.0)) + 0.01 * F.col("_p")).alias(name))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_label")).filter(
        "_id IS NOT NULL AND _label IS NOT NULL").filter(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    mix = F.crc32(F.concat(F.lit("fold "), F.col("_id").cast("string")))
    chosen = known.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(sample)  # at most ``sample`` rows of two numbers
    rows = common.texts(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "_label", (mix % 10).alias("_fold"))
    rows = common.stored(rows, "toxicity-sample")
    fold = lambda name: rows.filter(F.col("_fold").between(FOLDS[name][0], FOLDS[name][1] - 1))
    counts = {(r["_fold"], r["_label"]): r["count"] for r in rows.groupBy("_fold", "_label").count().collect()}
    total = lambda name, label: sum(v for (f, y), v in counts.items() if FOLDS[name][0] <= f < FOLDS[name][1] and (y == 1) == label)
    everything = sum(counts.values())
    prior = sum(v for (_, y), v in counts.items() if y == 1) / everything if everything else 0.0
    if not all(total(name, label) for name in FOLDS for label in (True, False)):
        return Model(({}, {}), None, None, prior)

    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cells = F.transform(F.split(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " "), lambda w: w.cast("binary"))
    toxic, clean = F.sum(F.when(F.col("_label") == 1, 1).otherwise(0)), F.sum(F.when(F.col("_label") == 1, 0).otherwise(1))
    odds = F.log((F.col("t") + 0.5) / (total("words", True) + 1)) - F.log((F.col("c") + 0.5) / (total("words", False) + 1))

    def tellers(keys: Column) -> dict[bytes, float]:
        """The keys whose texts are mostly toxic, with their log odds."""
        each = fold("words").select("_label", F.explode(F.array_distinct(keys)).alias("w")).filter(F.octet_length("w") > 0)
        found = each.groupBy("w").agg(toxic.alias("t"), clean.alias("c")).filter(F.col("t") >= LEAST_TEXTS).withColumn("odds", odds)
        return {bytes(r.w): float(r.odds) for r in found.filter(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("odds"), "w").limit(WORDS).collect()}

    longer = F.filter(cells, lambda w: F.octet_length(w) > STEM)
    learned = tellers(cells), tellers(F.transform(longer, lambda w: F.substring(w, 1, STEM)))

    def fed(name: str) -> DataFrame:
        return with_features(fold(name), "text", learned).select(
            array_to_vector("_features").alias("_vector"), (F.col("_label") == 1).cast("double").alias("label")).coalesce(4)

    # bounded tables: a few thousand rows of dense vectors
    gbt = GBTClassifier(featuresCol="_vector", labelCol="label", predictionCol="_class", maxIter=20, maxDepth=3, stepSize=0.3,
                        maxBins=32, seed=7).setProbabilityCol("_probability").setRawPredictionCol("_raw")
    trees = gbt.fit(common.stored(fed("trees"), "toxicity-trees"))
    scored = trees.transform(common.stored(fed("calibration"), "toxicity-calibration")).select(vector_to_array("_probability")[1].alias("_p"), "label")
    calibration = IsotonicRegression(featuresCol="_p", labelCol="label", predictionCol="_step").fit(scored)
    return Model(learned, trees, calibration, prior)


def op6(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    scored = model.score(common.texts(docs))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
