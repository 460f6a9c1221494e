import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loghelm.functions.hashing import hash_embedding, hash_matrix
from loghelm.operators.clusters import centers_of, fit_kmeans
from loghelm.operators.forest import Forest, average_path, fit_forest
from loghelm.operators.models import ModelTables, fit, score_texts, score_vectors
from loghelm.operators.subspace import fit_pca, mean_and_axes
from loghelm.operators.vectors import distinct_vectors, template_vectors, with_vectors
from loghelm.functions.scoring import MODELS, nearest_distance, residual_error

DIM = 16


def embed(spark, text, dim):
    return spark.createDataFrame([(text,)], "template string").select(hash_embedding("template", dim).alias("e")).first()["e"]


def test_golden_vector_384(spark):
    vector = embed(spark, "Receiving block <BLOCK> src: <IP> dest: <IP>", 384)
    assert len(vector) == 384
    assert {i: round(v, 6) for i, v in enumerate(vector) if v} == {
        101: 0.333333, 174: -0.333333, 248: -0.333333, 273: 0.333333, 297: 0.666667, 326: -0.333333
    }


def test_golden_vector_64(spark):
    vector = embed(spark, "Verification succeeded for <BLOCK>", 64)
    assert {i: v for i, v in enumerate(vector) if v} == {6: -0.5, 8: -0.5, 32: -0.5, 43: 0.5}


@pytest.mark.parametrize("text", ["", "   ", "\t\x1f"])
def test_blank_text_gives_zeros(spark, text):
    assert embed(spark, text, 8) == [0.0] * 8


@pytest.mark.parametrize("dim", [1, 7, 100, 384])
def test_hashing_equals_its_definition(spark, dim):
    text = "A b  a ÄÖ b <NUM> <NUM> x=1 y/z the end of a long line of words a b c d e f g"
    counts = [0] * dim
    for token in text.lower().split():
        number = int.from_bytes(hashlib.md5(token.encode()).digest(), "big")
        counts[number % dim] += 1 if number % 2 else -1
    norm = np.float32(math.sqrt(sum(c * c for c in counts)))
    expected = [float(np.float32(c) / norm) if norm else 0.0 for c in counts]
    assert embed(spark, text, dim) == expected


def test_templates_are_embedded_once(spark):
    lines = spark.createDataFrame([("a b",), ("a b",), ("c",)], "template string")
    rows = {r["template"]: r["n"] for r in template_vectors(lines, 8).collect()}
    assert rows == {"a b": 2, "c": 1}


@pytest.fixture(scope="module")
def vectors(spark):
    """Two clouds and a few far points; weights with one very heavy row."""
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 0.1, (60, DIM)), rng.normal(1, 0.1, (60, DIM)), rng.normal(0, 3, (4, DIM))])
    rows = [([float(v) for v in row], 1000 if i == 0 else 1 + i % 5, i) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "embedding array<double>, n long, key long")


def as_arrays(vectors):
    rows = vectors.orderBy("key").collect()
    return np.array([r["embedding"] for r in rows]), np.array([r["n"] for r in rows])


def test_long_texts_hash_like_short_ones(spark):
    words = [f"w{i % 700}" for i in range(20_000)]
    counts = {}
    for w in words:
        h = hashlib.md5(w.encode()).hexdigest()
        b = int(h, 16) % 384
        counts[b] = counts.get(b, 0) + (1 if int(h, 16) % 2 else -1)
    whole = np.zeros(384)
    for b, v in counts.items():
        whole[b] = v
    assert np.allclose(embed(spark, " ".join(words), 384), whole / np.linalg.norm(whole), atol=1e-6)


def test_average_path():
    assert [float(v) for v in average_path([0, 1, 2])] == [0.0, 0.0, 1.0]
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_forest_is_repeatable_and_partition_free(spark, vectors):
    total = vectors.agg(F.sum("n")).first()[0]
    order = ["tree", "node"]
    first = fit_forest(vectors.repartition(1), total).orderBy(*order).collect()
    assert first == fit_forest(vectors.repartition(7), total).orderBy(*order).collect()
    assert first != fit_forest(vectors, total, seed=1).orderBy(*order).collect()
    roots = [r for r in first if r["node"] == 0]
    assert len(roots) == 100
    assert {r["n"] for r in roots} == {256}
    assert max(r["depth"] for r in first) <= 8


def test_forest_isolates_far_points(spark, vectors):
    total = vectors.agg(F.sum("n")).first()[0]
    x, _ = as_arrays(vectors)
    score = Forest(fit_forest(vectors, total).toPandas()).isolation(x)
    assert ((score > 0) & (score < 1)).all()
    assert score[-4:].min() > np.median(score)
    assert score[0] < 0.5  # the heavy row is the most ordinary one


def test_forest_samples_lines_not_rows(spark, vectors):
    """A row of weight n is drawn like n rows: its share of the samples is its
    share of the lines."""
    total = vectors.agg(F.sum("n")).first()[0]
    x, n = as_arrays(vectors)
    forest = fit_forest(vectors, total).where("feature < 0").toPandas()
    heavy_share = forest.groupby("tree")["n"].max().mean() / 256
    assert heavy_share == pytest.approx(n[0] / total, abs=0.03)


def test_small_tables_use_all_rows(spark):
    rows = [([float(i), float(i % 3)], 1, i) for i in range(20)]
    nodes = fit_forest(spark.createDataFrame(rows, "embedding array<double>, n long, key long"), 20)
    assert {r["n"] for r in nodes.where("node = 0").collect()} == {20}


def test_kmeans_beats_random_centres(spark, vectors):
    x, n = as_arrays(vectors)
    centers = centers_of(fit_kmeans(vectors, 5))
    again = centers_of(fit_kmeans(vectors, 5))
    assert np.allclose(centers, again)
    cost = (nearest_distance(x, centers) ** 2 * n).sum()
    rng = np.random.default_rng(0)
    for _ in range(5):
        assert cost <= (nearest_distance(x, x[rng.choice(len(x), 5, replace=False)]) ** 2 * n).sum() + 1e-9


def test_pca_equals_svd_of_expanded_rows(spark, vectors):
    x, n = as_arrays(vectors)
    mean, axes = mean_and_axes(fit_pca(vectors, 4))
    full = np.repeat(x, n, axis=0)
    assert np.allclose(mean, full.mean(axis=0))
    _, _, vt = np.linalg.svd(full - full.mean(axis=0), full_matrices=False)
    expected = ((full - full.mean(axis=0)) - (full - full.mean(axis=0)) @ vt[:4].T @ vt[:4]) ** 2
    got = residual_error(full, mean, axes)
    assert np.allclose(got, expected.mean(axis=1), atol=1e-10)


def test_pca_error_falls_with_components(spark, vectors):
    x, n = as_arrays(vectors)
    errors = [np.average(residual_error(x, *mean_and_axes(fit_pca(vectors, k))), weights=n) for k in (1, 4, 12)]
    assert errors[0] > errors[1] > errors[2] >= 0
    with pytest.raises(ValueError):
        fit_pca(vectors, DIM + 1)


def test_scores_do_not_depend_on_the_batch(vectors):
    x, _ = as_arrays(vectors)
    centers, mean, axes = x[:3], x.mean(axis=0), np.eye(DIM)[:2]
    assert list(nearest_distance(x, centers)) == [nearest_distance(x[i : i + 1], centers)[0] for i in range(len(x))]
    assert list(residual_error(x, mean, axes)) == [residual_error(x[i : i + 1], mean, axes)[0] for i in range(len(x))]


def test_fit_save_load_score(spark, vectors, tmp_path):
    models = fit(vectors, n_clusters=4, ae_latent_dim=4)
    models.save(str(tmp_path / "m"))
    loaded = ModelTables.load(spark, str(tmp_path / "m"))
    params = {r["model"]: r for r in loaded.params.collect()}
    assert set(params) == set(MODELS)
    # With contamination 0.05 and the 95th percentile the forest threshold is 0.
    assert params["isolation_forest"]["threshold"] == pytest.approx(0.0, abs=1e-9)
    scored = score_vectors(vectors, loaded).toPandas()
    total = scored["n"].sum()
    for m in MODELS:
        p = params[m]
        assert scored[m].min() == pytest.approx(p["s_min"], abs=1e-9)
        assert scored[m].max() == pytest.approx(p["s_max"], abs=1e-9)
        assert 0 <= p["norm_threshold"] <= 1
        assert scored.loc[scored[m] >= p["threshold"], "n"].sum() >= 0.05 * total - 1
    settings = {r["key"]: r["value"] for r in loaded.settings.collect()}
    assert (settings["contamination"], settings["n_clusters"], settings["ae_latent_dim"]) == (0.05, 4.0, 4.0)


def test_loading_without_models_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ModelTables.load(spark, str(tmp_path))


def test_distinct_vectors_count_rows(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],), ([3.0, 4.0],)], "embedding array<double>")
    assert sorted(r["n"] for r in distinct_vectors(rows).collect()) == [1, 2]


ODD_TEXTS = ["", "  ", "a", "A a\ta", "x\x85y\u2003z\x1fz", "ÄÖ ß İ ΑΣ", "one two three one", "\u200bzero width", "Receiving block <BLOCK> src: <IP> dest: <IP>"]


@pytest.mark.parametrize("dim", [1, 7, 64, 384])
def test_matrix_equals_the_column(spark, dim):
    found = spark.createDataFrame([(t,) for t in ODD_TEXTS], "template string")
    rows = found.select(F.lower("template").alias("low"), hash_embedding("template", dim).alias("e")).collect()
    assert hash_matrix([r["low"] for r in rows], dim).tolist() == [r["e"] for r in rows]


def test_texts_are_scored_as_their_vectors(spark):
    lines = spark.createDataFrame([(t, i) for i in range(5) for t in ODD_TEXTS], "template string, i int")
    models = fit(template_vectors(lines, DIM), n_clusters=2, ae_latent_dim=2)
    columns = ["template", "i", *MODELS]
    given = score_vectors(lines.withColumn("embedding", hash_embedding("template", DIM)), models).select(columns)
    assert sorted(map(tuple, score_texts(lines, models, DIM).select(columns).collect())) == sorted(map(tuple, given.collect()))
    with pytest.raises(ValueError, match="16"):
        score_texts(lines, models, 8)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "rows_per_salt": 4}])
def test_lines_look_the_vector_of_their_template_up(spark, options):
    rows = [("f", i, t) for i, t in enumerate([*ODD_TEXTS, None] * 6)]
    lines = spark.createDataFrame(rows, "file string, line_no long, template string")
    found = with_vectors(lines, DIM, **options)
    assert "md5" not in found._jdf.queryExecution().toString()  # lines embed nothing
    given = lines.withColumn("embedding", hash_embedding("template", DIM))
    order = lambda df: sorted(map(tuple, df.select("line_no", "template", "embedding").collect()), key=lambda r: r[0])
    assert order(found) == order(given)
