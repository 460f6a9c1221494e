import pytest
from pyspark.sql import functions as F

from loghelm.functions.scoring import MODELS, scaled_threshold
from loghelm.operators import queue
from loghelm.operators.detection import above_cutoff, decide, load_params
from loghelm.plans.jobs import detect_log, evaluation_report, export_records, incident_reports, preprocess, prompt_table, sample_job_files, train
from loghelm.schemas import MODEL_PARAMS, SEVERITIES
from loghelm.session import parameter_table
from loghelm.sources.records import read_records

# Published calibration of the detectors.
PARAMS = [
    ("isolation_forest", 0.0, 0.8402429710708892, -0.09212727011816352, 0.017516326897968226),
    ("kmeans", 0.49855278859874735, 0.438008499775318, 0.0, 1.1382262775137955),
    ("autoencoder", 0.0006466215186707092, 0.3007829092187167, 1.5941203221099323e-10, 0.0021497843779009597),
]


@pytest.fixture(scope="module")
def params(spark):
    return load_params(parameter_table(spark, MODEL_PARAMS, PARAMS))


def scored(spark, *rows):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "pos int, " + ", ".join(f"{m} double" for m in MODELS))


def test_ensemble_threshold_and_vote(spark, params):
    low, high = (-0.09, 0.0, 0.0), (0.0, 0.49855278859874735, 0.0)
    rows = decide(scored(spark, low, high, (0.017, 0.1, 0.001)), params).orderBy("pos").collect()
    assert {r["threshold_used"] for r in rows} == {0.5263}
    assert [r["votes"] for r in rows] == [0, 2, 2]
    assert [r["is_anomaly"] for r in rows] == [False, True, True]


def test_anomaly_below_the_reported_threshold(spark, params):
    row = decide(scored(spark, (-0.08, 0.4986, 0.00065)), params).first()
    assert row["is_anomaly"] and row["anomaly_score"] < row["threshold_used"]


@pytest.mark.parametrize("model", [*MODELS, "unknown"])
def test_model_selector(spark, params, model):
    row = decide(scored(spark, (0.01, 0.2, 0.0001)), params, model).first()
    norm = {m: (x - params[m]["s_min"]) / (params[m]["s_max"] - params[m]["s_min"] + 1e-8) for m, x in zip(MODELS, (0.01, 0.2, 0.0001))}
    if model in MODELS:
        assert row["anomaly_score"] == pytest.approx(norm[model], abs=6e-5)
        assert row["threshold_used"] == pytest.approx(params[model]["norm_threshold"], abs=6e-5)
        assert row["is_anomaly"] == (model == "isolation_forest")
    else:
        assert row["anomaly_score"] == pytest.approx(max(norm.values()), abs=6e-5)
        assert row["is_anomaly"] is False


def test_scores_are_clipped(spark, params):
    rows = decide(scored(spark, (9, 9, 9), (-9, -9, -9)), params).orderBy("pos").collect()
    assert [r["anomaly_score"] for r in rows] == [1.0, 0.0]


def test_missing_ranges_come_from_the_batch(spark):
    bare = parameter_table(spark, MODEL_PARAMS, [(m, 2.0, None, None, None) for m in MODELS])
    found = load_params(bare, scored(spark, (1, 1, 5), (3, 5, 5)))
    assert (found["kmeans"]["s_min"], found["kmeans"]["s_max"]) == (1.0, 5.0)
    assert found["isolation_forest"]["norm_threshold"] == 0.5
    assert found["autoencoder"]["norm_threshold"] == 0.5  # empty range
    assert scaled_threshold(10, 0, 4) == 1.0


def test_cutoff_gate(spark):
    df = spark.createDataFrame([(0.4, True), (0.6, True), (0.9, False)], "anomaly_score double, is_anomaly boolean")
    assert [r["is_anomaly"] for r in above_cutoff(df, 0.5).orderBy("anomaly_score").collect()] == [False, True, False]


def detections(spark):
    rows = [("log_0000001", 0, 0.5, True), ("log_0000002", 1, 0.9, True), ("LOG_0000012", 2, 0.9, True), ("log_3", 3, 1.0, False), ("log_4", 4, 0.7, True)]
    return spark.createDataFrame(rows, "log_id string, pos long, anomaly_score double, is_anomaly boolean")


def test_queue_order_and_search(spark):
    rows = queue.incident_queue(detections(spark)).collect()
    assert [r["incident_id"] for r in rows] == ["log_0000002", "LOG_0000012", "log_4", "log_0000001"]
    assert (rows[0]["score"], rows[0]["consensus"]) == ("0.90", "2/3 Models")
    assert [r["incident_id"] for r in queue.incident_queue(detections(spark), "Log_00000").collect()] == ["log_0000002", "LOG_0000012", "log_0000001"]
    top = queue.top_incidents(detections(spark)).collect()
    assert [(r["rank"], r["log_id"]) for r in top] == [(1, "log_0000002"), (2, "LOG_0000012"), (3, "log_4")]


def test_figures(spark):
    verdicts = spark.createDataFrame([(3, 1, 2)], "total long, confirmed long, dismissed long")
    row = queue.key_figures(detections(spark), verdicts).first()
    assert (row["ingested"], row["flagged"], row["deviation_percent"], row["dismissed"]) == (5, 4, 80.0, 2)
    empty = queue.key_figures(detections(spark).limit(0), verdicts).first()
    assert empty["deviation_percent"] == 0.0
    assert queue.anomaly_rate(detections(spark)).first()[0] == pytest.approx(0.8)


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """A log with common and rare lines through all jobs."""
    folder = tmp_path_factory.mktemp("job")
    lines = []
    for i in range(400):
        if i % 50 == 17:
            lines.append(f"2025-02-11T06:31:07Z [ERROR] [billing]: worker stopped, no heap space left run {i} q{i}")
        elif i % 10 == 3:
            lines.append("")
        else:
            lines.append(f"120703 114259 27 INFO dfs.DataNode: Mirror block blk_{i % 9} src: /10.0.0.{i % 200}:50 step{i % 6}")
    (folder / "a.log").write_text("\n".join(lines) + "\n")
    (folder / "labels.csv").write_text("BlockId,Label\nblk_1,Normal\nblk_2,Anomaly\nblk_1,Anomaly\nblk_3,Odd\n")
    out, model = str(folder / "out"), str(folder / "model")
    summary = preprocess(spark, str(folder / "a.log"), str(folder / "labels.csv"), out, dim=32)
    train(spark, out, model, ae_latent_dim=4, n_clusters=3)
    return folder, lines, out, model, summary


def test_preprocessing_summary(job):
    _, lines, _, _, summary = job
    assert summary["total_records"] == sum(1 for t in lines if t)
    assert summary["embedding_dim"] == 32
    anomalous = sum(1 for t in lines if "blk_1 " in t or "blk_2 " in t)
    assert (summary["normal_records"], summary["anomaly_records"]) == (0, anomalous)
    assert summary["unknown_records"] == summary["total_records"] - anomalous


def test_sample_files(spark, job):
    folder, lines, _, _, _ = job
    out = str(folder / "sample")
    summary = sample_job_files(spark, str(folder / "a.log"), str(folder / "labels.csv"), out, num_lines=20)
    first = lines[:20]
    assert summary["sampled_lines"] == 20
    assert [r["value"] for r in spark.read.text(f"{out}/log").collect()] == first
    assert summary["anomaly_lines"] == sum(1 for t in first if "blk_1 " in t or "blk_2 " in t)


def test_evaluation_report(spark, job):
    _, _, out, model, summary = job
    rows = evaluation_report(spark, out, model, dim=32).collect()
    assert len(rows) == 4
    known = summary["normal_records"] + summary["anomaly_records"]
    assert {r["tn"] + r["fp"] + r["fn"] + r["tp"] for r in rows} == {known}


def test_prompt_table(spark, job):
    _, _, out, model, _ = job
    found = detect_log(spark, out, model, dim=32)
    rows = prompt_table(found, F.create_map(F.lit("cpu_percent"), F.lit(71.5))).collect()
    assert len(rows) == found.where("is_anomaly").count()
    for r in rows:
        assert r["log_id"] in r["prompt"] and "CPU=71.5%" in r["prompt"] and "recommended_actions" in r["system"]


def test_detection_contract(spark, job):
    _, lines, out, model, _ = job
    found = detect_log(spark, out, model, limit=50, dim=32).orderBy("pos").collect()
    assert len(found) == 50
    kept = [t for t in lines if t]
    for i, r in enumerate(found):
        assert 0 <= r["anomaly_score"] <= 1 and 0 <= r["threshold_used"] <= 1
        assert r["context_window"] == kept[:50][max(0, i - 2) : i + 3]
    everything = detect_log(spark, out, model, dim=32)
    rate = queue.anomaly_rate(everything).first()[0]
    assert 0 < rate < 0.25
    first = everything.orderBy("pos").first()
    assert first["log_id"] == "log_0000000"


def test_reports_of_the_log(spark, job):
    _, _, out, model, _ = job
    reports = incident_reports(spark, out, model, dim=32).collect()
    assert reports
    assert all(r["severity"] in SEVERITIES and len(r["explanation"]) > 10 for r in reports)
    assert any(r["severity"] == "critical" for r in reports)
    assert len(incident_reports(spark, out, model, limit=2, dim=32).collect()) == 2


def test_wide_records(spark, job):
    folder, lines, out, _, _ = job
    export_records(spark, out, str(folder / "records"), str(folder / "matrix"))
    records = read_records(spark, str(folder / "records"), "jsonl").collect()
    assert len(records) == sum(1 for t in lines if t)
    assert {len(r["embedding"]) for r in records} == {32}
    assert {r["metrics"] for r in records} == {None}
    matrix = spark.read.parquet(str(folder / "matrix"))
    assert matrix.columns == ["embedding", "label", "log_id", "block_id"]
    assert matrix.where(F.col("block_id") == "").count() == sum(1 for t in lines if "blk_" not in t and t)


def test_queue_text_rounds_by_the_binary_value(spark):
    values = [k / 1000 for k in range(1001)] + [0.1449, 0.99995, 1e-5]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", queue.two_digits(F.col("v")).alias("t"))
    assert all(r["t"] == f"{r['v']:.2f}" for r in df.collect())
