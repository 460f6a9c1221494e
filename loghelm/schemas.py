"""Table contracts (all explicit, nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUMBER, TRUTH, WHOLE, TIME = (
    T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.TimestampType()
)
TEXTS, VECTOR = T.ArrayType(TEXT), T.ArrayType(NUMBER)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PREPROCESSED = table(log_id=TEXT, timestamp=TEXT, raw_text=TEXT, source=TEXT, embedding=VECTOR, metrics=T.MapType(TEXT, NUMBER))
DETECTION = table(log_id=TEXT, anomaly_score=NUMBER, is_anomaly=TRUTH, threshold_used=NUMBER, context_window=TEXTS)
INCIDENT = table(log_id=TEXT, explanation=TEXT, severity=TEXT, recommended_actions=TEXTS, retrieved_context=TEXTS)
FEEDBACK = table(log_id=TEXT, administrator_verdict=TEXT, timestamp=TEXT)
BLOCK_LABELS = table(BlockId=TEXT, Label=TEXT)
METRICS = table(ts=TIME, host=TEXT, cpu_percent=NUMBER, memory_percent=NUMBER)
ANSWERS = table(log_id=TEXT, content=TEXT)

MODEL_PARAMS = table(model=TEXT, threshold=NUMBER, norm_threshold=NUMBER, s_min=NUMBER, s_max=NUMBER)
MODEL_SETTINGS = table(key=TEXT, value=NUMBER)
FOREST_NODES = table(tree=WHOLE, node=WHOLE, feature=WHOLE, split=NUMBER, left=WHOLE, right=WHOLE, n=WHOLE, depth=WHOLE)
CENTROIDS = table(cluster=WHOLE, center=VECTOR)
PCA_AXES = table(axis=WHOLE, vector=VECTOR)

# The enumerations of the contracts.
SEVERITIES = ("low", "medium", "high", "critical")
VERDICTS = ("confirmed", "dismissed")
LABELS = ("Normal", "Anomaly")
UNKNOWN_LABEL = "Unknown"
