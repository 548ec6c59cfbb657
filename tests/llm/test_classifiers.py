"""Held-out accuracy of the two classifiers, and their edges."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tripline.llm import quality, toxicity
from tripline.llm.queries import QUERIES


def held_out(rows, labels, folds, fold):
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    kept = [(r, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    return sum(r.predicted == label for r, label in kept) / len(kept)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op4_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and held_out(rows, labels, 5, 0) >= 0.9


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op6_quality"](spark, sf).collect()
    assert len(rows) == 1000 and held_out(rows, labels, 3, 1) >= 0.95


def test_features():
    lexicon = {"scum": 0, "lowe*": 0, "mild": 2}
    names = toxicity.FEATURES
    f = dict(zip(names, toxicity.describe("You are SCUM! A loweist mild thing", lexicon)))
    assert f["strong"] == 2 / 7 and f["mild"] == 1 / 7 and f["near_you"] == 1.0
    assert f["shouted_hits"] == 1 / 7 and f["you"] == 1 / 7
    for text in (None, "", " \n"):
        assert toxicity.describe(text, lexicon) == [0.0] * len(names)
        assert quality.describe(text) == [0.0] * len(quality.STATISTICS)
    assert toxicity.describe("st*pid", {})[names.index("dodged")] == 1.0


def test_discriminant_equals_densities():
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (300, 3))
    d = quality.Discriminant.of([400, 300], [a.sum(0), b.sum(0)], [a.T @ a, b.T @ b])
    covariances = [np.linalg.inv(w.T @ w) for w in d.inverses]
    x = rng.normal(0, 2, (50, 3))

    def density(k, prior):
        diff = x - d.means[k]
        return (math_log(prior) - 0.5 * np.log(np.linalg.det(covariances[k]))
                - 0.5 * np.einsum("ni,ij,nj->n", diff, np.linalg.inv(covariances[k]), diff))

    math_log = np.log
    want = 1 / (1 + np.exp(density(0, 4 / 7) - density(1, 3 / 7)))
    assert np.allclose(d.score(x), want)


def test_edges(spark, edges, edge_rows, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(1, 10)] + [(None, 1), (4, None)], "doc_id long, label int")
    scores = quality.score(edges, labels).collect()
    assert len(scores) == len(edge_rows) and all(0 <= r.score <= 1 for r in scores)
    model = toxicity.fit(edges, labels)
    scores = model.score(edges).collect()
    assert len(scores) == len(edge_rows) and all(0 <= r.score <= 1 for r in scores)
    assert model.accept(edges).columns == edges.columns
    none = labels.limit(0)
    assert {r.score for r in quality.score(edges, none).collect()} == {0.0}
    assert {r.score for r in toxicity.fit(edges, none).score(edges).collect()} == {0.0}
    assert quality.score(nothing, labels).count() == 0
    assert toxicity.fit(nothing, labels).score(nothing).count() == 0


def test_labels_of_the_held_out_fold_are_not_seen(spark):
    """Turning those labels round changes no score."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(
        "doc_id", F.col("quality").alias("label"))
    turned = labels.withColumn("label", F.when(
        toxicity.fold(F.col("doc_id"), 3) == 1, 1 - F.col("label")).otherwise(F.col("label")))
    one, two = ({r.doc_id: r.score for r in quality.score(docs, x).collect()}
                for x in (labels, turned))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_lexicon_holds_words_of_a_rare_language(spark):
    """10 of 400 toxic texts are no 3 %, but none of 2000 clean ones is evidence."""
    rows = [(f"zorblatt common{i % 7}", 1) for i in range(390)] + [("bococo common1", 1)] * 10 \
        + [(f"plain common{i % 7}", 0) for i in range(2000)] + [("seldom common2", 1)] * 3
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert lexicon["bococo"] == 0 and lexicon["zorblatt"] == 0
    assert not {"seldom", "plain", "common1"} & set(lexicon)


def test_held_out_recall_per_language(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.fit(docs, labels).score(docs).join(labels.where("label = 1"), "doc_id").where(
        toxicity.fold(F.col("doc_id"), 5) == 0).join(docs.select("doc_id", "lang"), "doc_id")
    found = {r.lang: r.recall for r in scored.groupBy("lang").agg(
        F.avg((F.col("score") >= 0.5).cast("int")).alias("recall")).collect()}
    assert set(found) == {"en", "de", "fr", "es"} and min(found.values()) >= 0.8


def test_all_ways_to_dodge_count():
    at = toxicity.FEATURES.index("dodged")
    rng = np.random.default_rng(4)
    texts = ["i.d.i.o.t", "i d i o t", "ST0PID", "a-b-c-d", "a.b.c", "it is 5", "a1B", "a!!", "x_y_z_w_"]
    texts += ["".join(rng.choice(list("aBc.-_ *@$!0#é"), 12)) for _ in range(5000)]
    for text in texts:
        if text.split():
            want = len(toxicity._DODGED.findall(text)) / len(text.split())
            assert toxicity.describe(text, {})[at] == want, text
    assert all(toxicity.describe(text, {})[at] > 0 for text in texts[:4])


def test_words_of_address_with_marks():
    at = toxicity.FEATURES.index("you")
    near = toxicity.FEATURES.index("near_you")
    for word in ("you,", "You!", "you're", "you’ll", "(you)", "¡tú!", "“du”", "«Vous»", "'you'"):
        found = toxicity.describe(f"scum {word} there", {"scum": 0})
        assert found[at] == 1 / 3 and found[near] == 1.0, word
    assert toxicity.describe("youth young's", {})[at] == 0


def test_words_are_learned_as_they_are_looked_up(spark):
    """French puts a no-break space before its marks: the word must not keep it."""
    every = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert re.fullmatch(toxicity.BETWEEN, every) and not re.search(toxicity.BETWEEN, "\u200b\x00a\ufeff")
    rows = [("salaud\u00a0! la maison", 1)] * 9 + [("la maison et le jardin", 0)] * 30
    learned = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert "salaud" in learned and not any("\u00a0" in entry for entry in learned)
    assert toxicity.describe("salaud\u00a0!", learned)[0] + toxicity.describe("salaud\u00a0!", learned)[1] > 0
