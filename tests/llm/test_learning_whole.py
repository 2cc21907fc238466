"""op8 learns from every labelled candidate, not from a sample of them."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from clinicmart.llm import boosting, personal


def test_personal_counts_every_candidate(spark):
    texts = [f"contact x{i % 3}.y@host{i % 5}.com and 10.0.{i % 7}.{250 + i % 20}" for i in range(6_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    wanted = Counter((kind, int(label)) for t in texts for kind, label, _ in personal.examples(t))
    assert max(wanted.values()) > 4_000
    examples = personal.labelled(docs)
    got = {(r.kind, r.label): r.n for r in examples.groupBy("kind", "label").agg(F.sum("weight").alias("n")).collect()}
    assert got == dict(wanted)
    detector = personal.learn(examples)
    assert detector.trees is not None and len(detector.trees.trees) == 40


def test_trees_on_a_table_equal_trees_in_memory(spark):
    rng = np.random.default_rng(7)
    rows = rng.integers(0, 40, (600, 4)).astype(float)
    labels = ((rows[:, 0] + rng.normal(0, 8, 600)) > 20).astype(float)
    table = spark.createDataFrame(
        [(r.tolist(), int(y), 1) for r, y in zip(rows, labels)], "features array<double>, label int, weight bigint"
    )
    local = boosting.fit(rows, labels, rounds=5)
    spread = boosting.fit_table(table, 4, rounds=5)
    assert np.allclose(local.probability(rows), spread.probability(rows))
