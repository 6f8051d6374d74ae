"""Data model: the activity record, the fixed settings and the job configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, table names, horizons and thresholds of the system.
DATE = "date"
CUSTOMER = "customer_number"
TARGET = "target"
RESCUED = "_rescued_data"
ARRIVAL = "_arrival"
PREDICTION = "prediction"
PREDICTION_DATE = "prediction_date"
NUMERICAL = ["feature1", "feature2", "feature3"]
CATEGORICAL = ["feature4"]
FEATURES = NUMERICAL + CATEGORICAL
TRAINING_COLUMNS = [CUSTOMER, "feature1", "feature2", "feature3", "feature4", DATE, TARGET]
OFFLINE_KEYS = [DATE, CUSTOMER]
OFFLINE_PARTITION = [DATE]
ONLINE_KEYS = [CUSTOMER]

TRAIN_DAYS = 730
EVAL_DAYS = 32
LABEL_DELAY_DAYS = 1
DRIFT_DAYS = 60
DRIFT_BEGIN_DAYS = 14
DRIFT_MID_DAYS = 7

RETRAIN_BELOW_F1 = 0.6
DRIFT_THRESHOLD = 0.15

# Regularised logistic regression.
HYPERPARAMETERS = {"penalty": "l2", "C": 1.0, "tol": 1e-4, "max_iter": 100, "fit_intercept": True}

ACTIVITY = T.StructType(
    [
        T.StructField(CUSTOMER, T.IntegerType(), False),
        T.StructField("feature1", T.DoubleType(), True),
        T.StructField("feature2", T.DoubleType(), True),
        T.StructField("feature3", T.DoubleType(), True),
        T.StructField("feature4", T.StringType(), True),
        T.StructField(DATE, T.DateType(), False),
        T.StructField(TARGET, T.IntegerType(), False),
    ]
)

# Row rules of the checked layer: rule name -> condition a row has to meet.
ACTIVITY_RULES = {
    CUSTOMER: f"{CUSTOMER} IS NOT NULL",
    RESCUED: f"{RESCUED} IS NULL",
}


@dataclass
class Settings:
    """Places and names one installation works with.

    ``root`` is a folder every executor can reach. The schema names are catalog
    databases; each is created below ``root`` when it does not exist.
    """

    root: str
    table: str = "activity"
    keys: list[str] = field(default_factory=lambda: list(OFFLINE_KEYS))
    # Order of the rows of one key; rows that tie are ordered by their arrival.
    order: list[str] = field(default_factory=lambda: [DATE])
    # Condition of a row that deletes its key.
    delete_when: str | None = None
    rules: dict[str, str] = field(default_factory=lambda: dict(ACTIVITY_RULES))
    layer_schema: str = "default"
    offline_schema: str = "offline"
    online_schema: str = "online"
    training_table: str = "training"
    serving_table: str = "serving"
    model_name: str = "activity_model"
    stage: str = "Production"
    user: str = "batch"
    keep_versions: int = 2
    # Folders that silver is dealt into by its keys where these hold no date; stays as it is for the life of the table.
    key_buckets: int = 64
    # Size of the files of one micro-batch, so that a first run over a long history is many of them.
    bytes_per_batch: int = 1 << 40
    raw_path: str | None = None
    # Decimals feature3 is known to hold; its sums are then exact whatever the row order.
    sum_digits: int | None = None

    @property
    def raw(self) -> str:
        return self.raw_path or f"{self.root}/raw/{self.table}"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/{self.table}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.table}"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints/{self.table}"

    @property
    def predictions(self) -> str:
        return f"{self.root}/predictions"

    @property
    def registry(self) -> str:
        return f"{self.root}/registry"

    @property
    def online_store(self) -> str:
        return f"{self.root}/online_store/{self.serving_table}"

    @property
    def bronze_table(self) -> str:
        return f"{self.layer_schema}.{self.table}_bronze"

    @property
    def silver_table(self) -> str:
        return f"{self.layer_schema}.{self.table}_silver"

    @property
    def training(self) -> str:
        return f"{self.offline_schema}.{self.training_table}"

    @property
    def offline_serving(self) -> str:
        return f"{self.offline_schema}.{self.serving_table}"

    @property
    def online_serving(self) -> str:
        return f"{self.online_schema}.{self.serving_table}"
