import numpy as np

from glyphatlas.operators import inference as I


def test_hashed_vectors_are_unit_and_repeatable(spark):
    texts = [(1, "prime numbers and divisors"), (2, "walks on a lattice"), (3, "prime numbers again"), (4, "x")]
    df = spark.createDataFrame(texts, "id bigint, text string")
    read = lambda d: {r["id"]: np.array(r["embedding"]) for r in I.hash_embed(d, 64).collect()}
    a, b = read(df), read(df.repartition(5))
    for i in a:
        assert np.allclose(a[i], b[i]) and a[i].shape == (64,)
    assert all(abs(np.linalg.norm(a[i]) - 1) < 1e-6 for i in (1, 2, 3)) and not a[4].any()
    assert a[1] @ a[3] > a[1] @ a[2]


def test_embedder_must_answer_every_row(spark):
    import pytest

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, text string").coalesce(1)
    with pytest.raises(Exception, match="2 texts but 1 vectors"):
        I.embed(df, lambda texts: [[1.0]]).collect()
