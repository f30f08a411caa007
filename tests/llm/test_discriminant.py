import zlib

import numpy as np
from pyspark.sql import functions as F

from glyphatlas.llm import discriminant as qd
from tests.llm.cases import empty, messy, messy_rows, prose


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        text = prose(i, 60 + i % 50)
        if i % 3 == 0:
            text = [" ".join(w + "###" for w in text.split()), text.upper().replace(" ", "!! "), " ".join([text.split()[0]] * 90)][i // 3 % 3]
        rows.append((i, text))
        labels.append((i, int(i % 3 > 0), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark):
    docs, labels = labelled(spark)
    out = qd.quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.97 * len(held)


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(spark, 120)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    # sums of doubles depend on the order of the tasks in the last digits only
    a, b = ({r["doc_id"]: r["score"] for r in qd.quality(docs, x).collect()} for x in (labels, flipped))
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_model_matches_the_densities():
    draw = np.random.default_rng(1)
    d = len(qd.STATISTICS)
    mean = (np.zeros(d), np.ones(d))
    cov = [np.eye(d) * 0.5 + 0.1, np.eye(d) * 2 + 0.3]
    factor = tuple(np.linalg.cholesky(c) for c in cov)
    model = qd.Model((-0.7, -0.7), mean, factor, tuple(float(np.linalg.slogdet(c)[1]) for c in cov))
    x = draw.normal(size=(20, d))
    density = [-0.5 * np.einsum("ni,ij,nj->n", x - mean[k], np.linalg.inv(cov[k]), x - mean[k]) - 0.5 * np.linalg.slogdet(cov[k])[1] for k in (0, 1)]
    assert np.allclose(model.log_odds(x), density[1] - density[0])


def test_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = qd.quality(messy(spark), labels).collect()
    assert len(out) == len(messy_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["score"] == 0.5 for r in qd.quality(messy(spark), labels.where("false")).collect())
    assert qd.quality(empty(spark), labels).count() == 0
