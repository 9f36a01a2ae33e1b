"""Toxicity: held-out accuracy on generated labels, ordered thresholds, cases without a model, awkward rows."""

import random

import numpy as np

from corpus_rows import AWKWARD, docs_of  # noqa: F401
from strata.llm import toxicity as t


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(500)]
    bad = ["idiot", "moron", "scum", "trash", "loser"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.choice([1, 2, 4, 8]) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(bad).title()
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(900, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels[:600] + [(None, 1), (5, None), (10**6, 1)], "doc_id long, toxic int")
    model = t.fit(docs, known)
    assert (np.diff(model.thresholds) > 0).all()
    scored = {r.doc_id: r for r in t.score(docs, model).collect()}
    held = range(600, 900)
    right = sum(scored[i].toxic == bool(labels[i][1]) for i in held)
    assert right >= 295
    severe = [scored[i].severity for i in held if labels[i][1]]
    mild = [scored[i].severity for i in held if not labels[i][1]]
    assert np.mean(severe) > 1 > 0.3 > np.mean(mild) and max(severe) <= 3 and min(mild) >= 0
    bound = t.fit(docs, known, per_class=20)
    assert bound is not None


def test_grades_of_their_own_are_kept(spark):
    rows, labels = corpus(300, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    graded = spark.createDataFrame([(i, 2 * y) for i, y in labels], "doc_id long, toxic int")
    assert len(t.fit(docs, graded).thresholds) == 2


def test_no_model_without_both_classes(spark, docs_of):
    docs = docs_of(AWKWARD)
    for labels in ([], [(1, 0), (2, 0)], [(1, 1)]):
        model = t.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert model is None
    got = t.score(docs, None).collect()
    assert len(got) == len(AWKWARD) and not any(r.toxic or r.severity or r.grade for r in got)


def test_awkward_rows_are_scored(docs_of, spark):
    rows, labels = corpus(200, 3)
    model = t.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = t.score(docs_of(AWKWARD), model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.severity <= 3 and r["a.b"] == "z" for r in got)
    assert t.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_verdicts_do_not_depend_on_the_sampling_rate(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(6000):  # every text with "slur" is toxic, a fifth of those with "hint"
        sort = "slur" if i % 60 == 0 else "hint" if i % 10 == 1 else "plain"
        words = [f"word{rng.randrange(60)}" for _ in range(12)] + [sort]
        rows.append((i, " ".join(words)))
        labels.append((i, int(sort == "slur" or sort == "hint" and rng.random() < 0.2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    above, below = ({r.doc_id: r for r in t.score(docs, t.fit(docs, known, n_features=40, per_class=n)).collect()}
                    for n in (6000, 400))  # all labels, and all toxic ones with a fifteenth of the others
    assert sum(above[i].toxic for i in above) < 200
    same = sum(above[i].toxic == below[i].toxic for i in above)
    assert same >= 0.97 * len(rows), same
    mean = [sum(found[i].severity for i in found) for found in (above, below)]
    assert 0.7 < mean[1] / mean[0] < 1.4, mean
