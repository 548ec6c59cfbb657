"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: stems (the first letters of words) and words that are
far more frequent in texts labelled toxic, in three grades of log odds. The
trees see densities of the grades and how they stand: near words of address,
in capitals, amid exclamation marks, or spelled to dodge a filter. They are
fitted and calibrated on a bounded sample of labelled rows; scoring is a
narrow pass.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tripline.llm.common import empty_as
from tripline.sources.session import settle

#: About so many labelled rows are learned from; chosen by a hash of doc_id.
MAX_LABELLED = 12_000
#: Log odds at which a grade of the lexicon begins, strongest first.
GRADES = (4.0, 2.5, 1.5)
#: Least number of toxic texts that must hold an entry, and the least log odds in standard
#: errors: evidence, not a share, so that rare languages have their entries too.
LEAST_SUPPORT, LEAST_ERRORS = 4, 1.96
STEM_LENGTHS = (4, 5, 6)
TREES, DEPTH, STEP = 20, 3, 0.3
FIT_TASKS = 8
#: Words between a lexicon word and a word of address that still counts as near.
NEAR = 5

#: Words of address in the languages at hand.
SECOND_PERSON = frozenset((
    "you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "te", "usted",
    "ustedes", "vuestro",
))
_EDGES = ".,!?;:\"'()[]…"
_DODGED = re.compile(r"[A-Za-z]+[*@$!0-9#]+[A-Za-z]+|(?:\b[A-Za-z][.\-_ ]){3,}[A-Za-z]\b")
#: Holds wherever ``_DODGED`` does and nowhere else, and takes linear time.
_MAY_DODGE = re.compile(r"[A-Za-z][*@$!0-9#]+[A-Za-z]|(?:\b[A-Za-z][.\-_ ]){3}[A-Za-z]\b")
_UPPER = bytes(range(65, 91))

FEATURES = ("strong", "medium", "mild", "strong_count", "near_you", "you", "capitals",
            "exclaimed", "questioned", "dodged", "shouted_hits", "log_words")


#: What ``str.split`` takes for white space, so that words are learned as they are looked up.
BETWEEN = (r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+")
#: Steps of the share of labelled rows that a sample takes.
SHARES = 10**15


def stems(word: str) -> list[str]:
    """What the lexicon may hold of a bare lower-case word: stems end in a star."""
    return [word, *(word[:n] + "*" for n in STEM_LENGTHS if len(word) >= n)]


def _contracted(bare: str) -> str:
    """What stands before an apostrophe, as in "you're"; marks that a lexicon word keeps go too."""
    return bare.replace("’", "'").strip("¡¿“”„‘'«»").partition("'")[0].strip(_EDGES)


def describe(text: str | None, lexicon: dict[str, int]) -> list[float]:
    """The features of a text; all zero for a null or wordless one."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    low = text.lower().split()
    if len(low) != n:  # a letter whose lower case holds a space does not exist, but to be sure
        low = [w.lower() for w in words]
    counts, hits, you, grade_of = [0, 0, 0], [], [], lexicon.get
    for at, word in enumerate(low):
        bare = word.strip(_EDGES) if word[-1:] in _EDGES or word[:1] in _EDGES else word
        if bare in SECOND_PERSON or not bare.isalpha() and _contracted(bare) in SECOND_PERSON:
            you.append(at)
        best = None
        for entry in (bare, bare[:4] + "*", bare[:5] + "*", bare[:6] + "*"):
            grade = grade_of(entry)
            if grade is not None and (best is None or grade < best):
                best = grade
        if best is not None:
            counts[best] += 1
            if best == 0:
                hits.append(at)
    address = set(you)
    near = sum(1 for at in hits if any(
        at + d in address for d in range(-NEAR, NEAR + 1))) if address else 0
    raw = text.encode()
    size = len(raw)
    share = lambda signs: (size - len(raw.translate(None, signs))) / size
    dodged = len(_DODGED.findall(text)) if _MAY_DODGE.search(text) else 0
    return [
        counts[0] / n, counts[1] / n, counts[2] / n, math.log1p(counts[0]),
        near / len(hits) if hits else 0.0, len(you) / n, share(_UPPER), share(b"!"), share(b"?"),
        dodged / n, sum(words[at].isupper() for at in hits) / n, math.log1p(n)]


def with_features(docs: DataFrame, lexicon: dict[str, int], name: str = "features") -> DataFrame:
    """``docs`` with one more column, an array of the features of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([describe(t.as_py(), lexicon) for t in batch["text"]],
                              pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, values],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, ArrayType(DoubleType()))]))


def learn_lexicon(labelled: DataFrame) -> dict[str, int]:
    """entry -> grade, from rows of text and ``label`` (0 or 1).

    All entries with enough evidence; the rows are a bounded sample, which bounds them.
    """
    count = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"),
                         F.count("*").alias("all")).first()
    toxic, clean = int(count["toxic"]), int(count["all"]) - int(count["toxic"])
    if not toxic or not clean:
        return {}
    words = F.transform(F.split(F.lower("text"), BETWEEN),
                        lambda w: F.btrim(w, F.lit(_EDGES)))
    entries = F.flatten(F.transform(words, lambda w: F.concat(
        F.array(w), *(F.when(F.length(w) >= n, F.array(F.concat(F.substring(w, 1, n), F.lit("*"))))
                      .otherwise(F.array().cast("array<string>")) for n in STEM_LENGTHS))))
    seen = labelled.select("label", F.explode(F.array_distinct(entries)).alias("entry")).where(
        F.length("entry") > 2).groupBy("entry").agg(
        F.sum("label").alias("t"), (F.count("*") - F.sum("label")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    rows = seen.where(F.col("t") >= LEAST_SUPPORT).withColumn("odds", odds).where(
        (F.col("odds") >= GRADES[-1]) & (F.col("odds") >= LEAST_ERRORS * error)).collect()
    return {r.entry: next(g for g, least in enumerate(GRADES) if r.odds >= least) for r in rows}


@dataclass
class Model:
    """What scoring needs. Without both classes to learn from, ``trees`` is None."""

    lexicon: dict[str, int]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def _scored(self, docs: DataFrame) -> DataFrame:
        """The documents as column ``row`` and their ``score``."""
        rows = docs.select(F.struct("*").alias("row"), "text")
        if self.trees is None:
            return rows.select("row", F.lit(float(self.rate)).alias("score"))
        rows = self.trees.transform(_assembled(with_features(rows, self.lexicon))).withColumn(
            "raw_score", vector_to_array("probability")[1])
        return self.calibration.transform(rows).select("row", F.greatest(
            F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))).alias("score"))

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and score, a probability, of every row, null and empty texts too."""
        return self._scored(docs.select("doc_id", "text")).select("row.doc_id", "score")

    def accept(self, docs: DataFrame, limit: float = 0.5) -> DataFrame:
        """The documents that score below ``limit``, with all their columns."""
        return self._scored(docs).where(F.col("score") < limit).select("row.*")


def _assembled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("vector", array_to_vector("features")).drop("features")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; a null doc_id is in none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0,
        max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from the labelled rows whose fold is not ``held_out``.

    ``labels`` has doc_id and ``label``. Rows are sampled down to about
    ``max_labelled``; the rest of a fold is for calibration, the others for
    lexicon and trees. A doc_id with several labels counts with each.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
                         & (fold(F.col("doc_id"), folds) != held_out)).select("doc_id", "label")
    share = min(1.0, max_labelled / max(1, known.count()))
    # written, so that its size is known and texts don't move to meet it
    chosen = settle(known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(SHARES))
                                < int(share * SHARES)), "chosen")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)) == 0
    rows = settle(docs.select("doc_id", empty_as(F.col("text")).alias("text")).join(
        chosen, "doc_id").withColumn("calibrates", part), "labelled")
    sums = rows.agg(F.avg("label").alias("rate"), F.count_distinct(F.when(
        F.col("calibrates"), F.col("label"))).alias("a"), F.count_distinct(F.when(
            ~F.col("calibrates"), F.col("label"))).alias("b")).first()
    if sums["a"] < 2 or sums["b"] < 2:
        return Model({}, None, None, sums["rate"] or 0.0)
    lexicon = learn_lexicon(rows.where(~F.col("calibrates")))
    # few tasks for the fit; joined before Python, so that each has one worker
    described = settle(with_features(rows.coalesce(FIT_TASKS), lexicon).drop("text"), "described")
    ready = _assembled(described.withColumn("label", F.col("label").cast("double")))
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", predictionCol="predicted", maxIter=TREES,
        maxDepth=DEPTH, stepSize=STEP, seed=42,
    ).setRawPredictionCol("margin").setProbabilityCol("probability").fit(
        ready.where(~F.col("calibrates")))
    judged = trees.transform(ready.where("calibrates")).withColumn(
        "raw_score", vector_to_array("probability")[1])
    calibration = IsotonicRegression(
        featuresCol="raw_score", labelCol="label", predictionCol="calibrated").fit(judged)
    return Model(lexicon, trees, calibration, sums["rate"])
