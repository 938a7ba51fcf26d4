"""Table shapes and the feature contract shared by training and scoring."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Column names of the mobility files, and the short metric names
# the JSON messages use for them.
LONG_TO_SHORT = {
    "retail_and_recreation_percent_change_from_baseline": "retail",
    "grocery_and_pharmacy_percent_change_from_baseline": "grocery",
    "parks_percent_change_from_baseline": "parks",
    "transit_stations_percent_change_from_baseline": "transit",
    "workplaces_percent_change_from_baseline": "workplaces",
    "residential_percent_change_from_baseline": "residential",
}
PLACE_COLUMNS = ("country_region_code", "country_region", "place_id")
DATE_PARTS = ("année", "mois", "jour")
MONTH_PARTS = DATE_PARTS[:2]

METRICS = tuple(LONG_TO_SHORT.values())
SHORT_TO_LONG = {short: long for long, short in LONG_TO_SHORT.items()}

MOBILITY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in PLACE_COLUMNS]
    + [T.StructField("date", T.DateType())]
    + [T.StructField(name, T.IntegerType()) for name in LONG_TO_SHORT]
)

CORRUPT_COLUMN = "_corrupt_record"

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("date", T.DateType()),
                    T.StructField("country", T.StringType()),
                    T.StructField(
                        "metrics",
                        T.StructType([T.StructField(m, T.DoubleType()) for m in METRICS]),
                    ),
                ]
            ),
        ),
    ]
)

# One row per scored message. The first eight columns are the prediction row the
# dashboard reads; the rest say what was predicted and why a row was refused.
SCORED_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("country", T.StringType()),
        T.StructField("residential", T.DoubleType()),
        T.StructField("features_json", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("epoch_id", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("stream_id", T.StringType()),
    ]
)
PREDICTION_COLUMNS = tuple(
    name for name in SCORED_SCHEMA.fieldNames() if name not in ("reject_reason", "raw_value")
)


@dataclass(frozen=True)
class FeatureContract:
    """Ordered model inputs plus the label they predict.

    ``dropped`` lists features that were given up because the data did not carry
    them, so that a pruned column is visible in the model registry.
    """

    label: str
    features: tuple[str, ...]
    dropped: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.features:
            raise ValueError("a feature contract needs at least one feature")
        if self.label in self.features:
            raise ValueError(f"label {self.label!r} must not be one of its own features")

    def without(self, columns) -> "FeatureContract":
        gone = tuple(c for c in self.features if c in set(columns))
        kept = tuple(c for c in self.features if c not in gone)
        return replace(self, features=kept, dropped=self.dropped + gone)

    def require(self, columns, with_label: bool = False) -> None:
        """Raise before any job runs when a promised column is absent."""
        wanted = self.features + ((self.label,) if with_label else ())
        missing = [c for c in wanted if c not in columns]
        if missing:
            raise ValueError(f"input lacks contracted columns {missing}; it has {list(columns)}")


DEFAULT_CONTRACT = FeatureContract(
    label="retail",
    features=("grocery", "parks", "transit", "workplaces", "residential"),
)
