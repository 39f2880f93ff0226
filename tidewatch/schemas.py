"""Panel description, table schemas and fixed default values."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Panel:
    """How a frame holds many series.

    ``keys`` name a series, ``ts`` orders it, ``value`` is measured, and
    ``step`` is the grid spacing in seconds. ``chunk_rows`` is how many grid
    steps of one series a single task may hold in a window: a series of any
    length is cut into pieces of that length, so none is ever one task.
    ``full`` promises that no series has a gap or a repeated time; row windows
    may then be cut by time alone, which saves the shuffle that ranks the rows.
    ``dealt`` says that rows come from ``deal``: with ``_chunk`` and ``_own``, each
    chunk's rows beside each other in time order, after at least so many earlier
    ones. Their windows run as rows stream by, and only own rows are returned.
    ``whole`` says that each series' rows stand beside each other in time order.
    """

    keys: tuple[str, ...] = ("series",)
    ts: str = "timestamp"
    value: str = "demand"
    step: int = 3600
    chunk_rows: int = 2048
    full: bool = False
    dealt: int | None = None
    whole: bool = False

    @property
    def step_us(self) -> int:
        return self.step * 1_000_000

    def by(self, *extra: str) -> "Panel":
        """The same panel with more key columns (e.g. the split)."""
        return replace(self, keys=(*self.keys, *extra))

    def on(self, **changes) -> "Panel":
        return replace(self, **changes)


HOURLY = Panel()
DAILY = Panel(step=86400)

# Fixed default values.
LAGS = (1, 2, 3, 24, 48, 168)
ROLLING_WINDOWS = (3, 6, 12, 24, 48, 168)
ROLLING_STATS = ("mean", "std", "min", "max")
IQR_MULTIPLIER = 1.5
ZSCORE_THRESHOLD = 3.0
MIN_DEMAND = 0.0
MAX_DEMAND = 10000.0
TRAIN_RATIO = 0.7
VAL_RATIO = 0.15
CV_SPLITS = 5
CV_GAP = 24
RIDGE_ALPHA = 1.0
LASSO_ALPHA = 0.1
SEQUENCE_LENGTH = 24
ROLLING_Z_WINDOW = 168
RESIDUAL_MULTIPLIER = 3.0
SEVERITY = {"high": 0.8, "medium": 0.6, "low": 0.3}
FOREST_TREES = 200
FOREST_SAMPLE = 256
CONTAMINATION = 0.05
DRIFT_THRESHOLD = 0.1
KS_ALPHA = 0.05
LATENCY_SLA_MS = 500.0
LATENCY_WINDOW = 1000
FIXED_HOLIDAYS = ((1, 1), (12, 25), (12, 26), (7, 4))
EPS = 1e-8

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()
_TS, _L, _I = T.TimestampType(), T.LongType(), T.IntegerType()


def _table(*columns):
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in columns])


SERIES_TABLE = _table(
    ("series", _S, False), ("timestamp", _TS, False), ("demand", _D, True),
    ("source", _S, True), ("is_processed", _B, True), ("created_at", _TS, True),
)
PREDICTION_TABLE = _table(
    ("series", _S, False), ("request_id", _S, False), ("timestamp", _TS, False),
    ("predicted_demand", _D, False), ("model_name", _S, False), ("model_version", _S, True),
    ("latency_ms", _D, True), ("created_at", _TS, True),
)
ANOMALY_TABLE = _table(
    ("series", _S, False), ("timestamp", _TS, False), ("actual_demand", _D, False),
    ("predicted_demand", _D, True), ("anomaly_score", _D, False), ("is_anomaly", _B, False),
    ("severity", _S, True), ("method", _S, True), ("notes", _S, True), ("created_at", _TS, True),
)
METRICS_TABLE = _table(
    ("model_name", _S, False), ("model_version", _S, True), ("rmse", _D, True), ("mae", _D, True),
    ("mape", _D, True), ("r2", _D, True), ("n_train_samples", _L, True), ("n_test_samples", _L, True),
    ("training_duration_s", _D, True), ("notes", _S, True), ("created_at", _TS, True),
)
ANOMALY_RESULT = _table(
    ("timestamp", _TS, True), ("actual", _D, True), ("predicted", _D, True),
    ("anomaly_score", _D, True), ("is_anomaly", _B, True), ("severity", _S, True), ("method", _S, True),
)
METRICS_FILE = "map<string, struct<metrics: map<string, double>, n_predictions: bigint>>"
PREDICT_REQUEST = "timestamp string, features map<string, double>, model_name string"
ANOMALY_REQUEST = (
    "timestamp string, actual_demand double, predicted_demand double, "
    "features map<string, double>, method string"
)
