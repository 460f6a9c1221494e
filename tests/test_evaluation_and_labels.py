import random

import pytest
from pyspark.sql import functions as F

from loghelm.functions.scoring import MODELS
from loghelm.operators.evaluation import class_balance, evaluate, roc_auc
from loghelm.operators.labels import label_lines, label_map, preprocessing_summary, sample_first_lines, template_counts, unique_templates
from loghelm.sources.records import read_block_labels, write_block_labels

THRESHOLDS = {"isolation_forest": 0.5, "kmeans": 0.3, "autoencoder": 0.7}


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return 0.0
    return 100 * sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)


def rows(n=500, seed=3):
    rng = random.Random(seed)
    # Few distinct scores, a third of the rows on a single one.
    value = lambda: 0.4 if rng.random() < 0.33 else round(rng.random(), 1)
    return [(value(), value(), value(), rng.choice([0, 0, 0, 1, -1])) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_quality_equals_brute_force(spark, partitions):
    data = rows()
    scored = spark.createDataFrame(data, ", ".join(f"{m} double" for m in MODELS) + ", label int").repartition(partitions)
    got = {r["model"]: r for r in evaluate(scored, THRESHOLDS).collect()}
    known = [r for r in data if r[3] >= 0]
    flags = [[int(r[i] >= THRESHOLDS[m]) for i, m in enumerate(MODELS)] for r in known]
    predicted = {m: [f[i] for f in flags] for i, m in enumerate(MODELS)} | {"ensemble": [int(sum(f) >= 2) for f in flags]}
    for model, hits in predicted.items():
        cells = {(y, h): sum(1 for r, g in zip(known, hits) if r[3] == y and g == h) for y in (0, 1) for h in (0, 1)}
        r = got[model]
        assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (cells[0, 0], cells[0, 1], cells[1, 0], cells[1, 1])
        assert r["precision"] == pytest.approx(100 * cells[1, 1] / max(1, cells[1, 1] + cells[0, 1]))
        assert r["recall"] == pytest.approx(100 * cells[1, 1] / (cells[1, 1] + cells[1, 0]))
        assert r["accuracy"] == pytest.approx(100 * (cells[1, 1] + cells[0, 0]) / len(known))
        column = MODELS.index(model) if model in MODELS else 0  # the vote borrows the forest's scores
        assert r["auc"] == pytest.approx(brute_auc([(k[column], k[3]) for k in known]))
    assert got["ensemble"]["name"] == "Ensemble (Majority Vote)"


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_auc_in_ranges(spark, rows_per_range):
    rng = random.Random(8)
    data = [("m", round(rng.gauss(y, 1), 1), y) for y in rng.choices([0, 1], k=400)]
    table = spark.createDataFrame(data, "model string, score double, label int").withColumn("n", F.lit(1))
    assert roc_auc(table, rows_per_range=rows_per_range).first()["auc"] == pytest.approx(brute_auc([(s, y) for _, s, y in data]))


def test_undefined_figures_are_zero(spark):
    scored = spark.createDataFrame([(0.0, 0.0, 0.0, 0), (0.1, 0.1, 0.1, 0)], ", ".join(f"{m} double" for m in MODELS) + ", label int")
    for r in evaluate(scored, THRESHOLDS).collect():
        assert (r["precision"], r["recall"], r["f1"], r["auc"], r["accuracy"]) == (0, 0, 0, 0, 100)


def test_class_balance(spark):
    row = class_balance(spark.createDataFrame([(0,), (0,), (1,), (-1,)], "label int")).first()
    assert (row["total"], row["normal"], row["anomaly"], row["normal_percent"]) == (4, 2, 1, 50.0)


LABEL_ROWS = [("b1", "Normal", 0), ("b2", "Anomaly", 1), ("b1", "Anomaly", 2), ("b3", "strange", 3)]


def test_last_label_counts(spark):
    labels = label_map(spark.createDataFrame(LABEL_ROWS, "block_id string, label string, line_no long"))
    assert {r["block_id"]: r["label"] for r in labels.collect()} == {"b1": "Anomaly", "b2": "Anomaly", "b3": "strange"}


def test_labelled_lines_and_summary(spark):
    labels = label_map(spark.createDataFrame(LABEL_ROWS, "block_id string, label string, line_no long"))
    lines = spark.createDataFrame([("f", i, b) for i, b in enumerate(["b1", "b2", None, "b3", "b9"])], "file string, line_no long, block_id string")
    labelled = label_lines(lines, labels)
    got = [(r["label_text"], r["label"]) for r in labelled.orderBy("line_no").collect()]
    assert got == [("Anomaly", 1), ("Anomaly", 1), ("Unknown", -1), ("strange", -1), ("Unknown", -1)]
    vectors = spark.createDataFrame([([0.0, 1.0, 0.0],)], "embedding array<double>")
    assert tuple(preprocessing_summary(labelled, vectors).first()) == (5, 3, 0, 2, 3)
    assert preprocessing_summary(labelled, vectors.limit(0)).first()["embedding_dim"] == 0


def test_sample_of_first_lines(spark):
    lines = ["x blk_1 a", "", "no block", "blk_2 blk_1", "blk_1", "blk_7 late"]
    table = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "file string, line_no long, value string")
    labels = spark.createDataFrame([("blk_1", "Normal"), ("blk_2", "Anomaly")], "block_id string, label string")
    sample, blocks, summary = sample_first_lines(table, labels, 5)
    assert sample.count() == 5
    assert {r["block_id"]: r["label"] for r in blocks.collect()} == {"blk_1": "Normal", "blk_2": "Anomaly"}
    assert summary.first().asDict() == {"sampled_lines": 5, "normal_lines": 2, "anomaly_lines": 1, "unknown_lines": 0, "unique_blocks": 2}
    assert sample_first_lines(table, labels, 6)[2].first()["unknown_lines"] == 1


def test_label_files(spark, tmp_path):
    path = str(tmp_path / "labels")
    labels = spark.createDataFrame([("b1", "Normal")], "block_id string, label string")
    assert write_block_labels(labels.limit(0), path) is False
    assert read_block_labels(spark, path).count() == 0
    assert write_block_labels(labels, path) is True
    parts = [p.read_text().splitlines() for p in (tmp_path / "labels").glob("*.csv")]
    assert {part[0] for part in parts} == {"BlockId,Label"}
    assert [line for part in parts for line in part[1:]] == ["b1,Normal"]
    assert [tuple(r) for r in read_block_labels(spark, path).collect()] == [("b1", "Normal", 0)]


def test_template_counts(spark):
    lines = spark.createDataFrame([("a",), ("a",), ("b",)], "template string")
    assert {r["template"]: r["n"] for r in template_counts(lines).collect()} == {"a": 2, "b": 1}
    assert unique_templates(lines).first()[0] == 2
    assert unique_templates(lines, approximate=True).first()[0] == 2
