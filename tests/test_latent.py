import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators.latent import fit_latent, idf_weights, token_slots

SLOTS = 64


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(3)
    topics = [["river", "boat", "fish", "water"], ["court", "law", "judge", "trial"], ["bread", "flour", "oven", "salt"]]
    rows = []
    for i in range(120):
        own = topics[i % 3]
        rows.append((i, " ".join(rng.choice([*own, *own, *own, f"w{rng.integers(30)}"]) for _ in range(rng.integers(3, 30)))))
    rows += [(200, None), (201, ""), (202, "River RIVER, river!")]
    return rows, spark.createDataFrame(rows, "k int, t string").repartition(3)


def matrix(texts):
    rows, df = texts
    slots = {r["k"]: r["s"] for r in df.select("k", token_slots("t", SLOTS).alias("s")).collect()}
    counts = np.array([np.bincount(slots[k], minlength=SLOTS) for k, _ in rows], float)
    idf = np.log((len(rows) + 1) / ((counts > 0).sum(axis=0) + 1))
    x = counts * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), idf


def test_weights(texts):
    assert np.allclose(idf_weights(texts[1], "t", SLOTS), matrix(texts)[1])


def test_the_subspace_is_numpys(texts):
    x, idf = matrix(texts)
    _, values, right = np.linalg.svd(x)
    made = fit_latent(texts[1], "t", SLOTS, rank=5, oversample=20, iterations=12)
    assert np.allclose(made.idf, idf) and np.allclose(made.values, values[:5], atol=1e-6)
    want, got = right[:5].T @ right[:5], made.vectors @ made.vectors.T
    assert np.abs(want - got).max() < 1e-6
    again = fit_latent(texts[1].repartition(7), "t", SLOTS, rank=5, oversample=20, iterations=12)
    assert np.allclose(made.vectors, again.vectors, atol=1e-6)


def test_documents_of_a_topic_are_near(texts):
    rows, df = texts
    made = fit_latent(df, "t", SLOTS, rank=3)
    got = {r["k"]: np.array(r["vector"]) for r in made.encode(df, "t").collect()}
    x, _ = matrix(texts)
    for n, (k, _) in enumerate(rows):
        assert np.allclose(got[k], x[n] @ made.vectors, atol=1e-5)
    assert not got[200].any() and not got[201].any() and len(got) == len(rows)
    unit = np.array([got[k] / np.linalg.norm(got[k]) for k in range(120)])
    near = np.argsort(-(unit @ unit.T), axis=1)[:, 1]
    assert np.mean(near % 3 == np.arange(120) % 3) > 0.9
    assert fit_latent(df.filter(F.length("t") > 0), "t", SLOTS, rank=2).encode(df.limit(0), "t").count() == 0


@pytest.mark.parametrize("slots", [64, 9000])
def test_tokens_are_counted_once_and_passes_are_products(spark, slots, monkeypatch):
    """Rows as dense blocks and as entries give the same squares; the passes read different slots with their counts."""
    from millrace.operators import latent

    rng = np.random.default_rng(5)
    lists = [rng.integers(0, slots, n).tolist() for n in (0, 3, 40, 0, 200, 1, 0)]
    batch, block, idf = pa.array(lists, pa.list_(pa.int32())), rng.normal(size=(slots, 4)), rng.random(slots) + 0.1
    row, slot, value = latent._rows(batch, idf)
    whole = np.zeros((len(lists), slots))
    whole[row, slot] = value
    monkeypatch.setattr(latent, "_CELLS", 3 * slots)
    assert np.allclose(latent._squared(row, slot, value, block, len(lists)), whole.T @ (whole @ block))
    assert np.allclose(latent._squared(row[:0], slot[:0], value[:0], block, 0), 0.0)


def test_tokens_are_digested_once_per_batch(spark):
    from millrace.operators import latent

    texts = spark.createDataFrame([("Ab ab, Größe 7",), ("",), (None,), ("日本 x x",), ("ab",)], "t string").coalesce(1)
    found = texts.select(latent._token_bytes("t").alias("b"), token_slots("t", 97).alias("s")).toArrow()
    for at in (0, 2):  # also lists that do not begin at the first token
        got = latent._slotted(found.column("b").combine_chunks().slice(at), 97)
        assert got.to_pylist() == found.column("s").to_pylist()[at:]
