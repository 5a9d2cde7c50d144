"""Data contracts: what a delivery must look like, as data."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from enum import Enum

from pyspark.sql import types as T


class Severity(str, Enum):
    CRITICAL = "critical"
    WARNING = "warning"


class ErrorType(str, Enum):
    """Why a record was not accepted; fixed values, in order of precedence."""

    SCHEMA_MISMATCH = "schema_mismatch"
    TYPE_ERROR = "type_error"
    MISSING_CRITICAL = "missing_critical_column"
    BUSINESS_RULE = "business_rule_failed"
    INDETERMINATE = "rule_indeterminate"


TYPE_NAMES: dict[str, T.DataType] = {
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = False
    minimum: float | None = None
    domain: tuple[str, ...] | None = None
    monetary: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return TYPE_NAMES[self.kind]


@dataclass(frozen=True)
class Contract:
    dataset: str
    version: str
    fields: tuple[Field, ...]
    owner: str = ""
    file_format: str = "csv"
    encoding: str = "UTF-8"
    time_zone: str = "UTC"
    arrival_day: int = 5
    not_before: tuple[tuple[str, str], ...] = ()
    warn_above: dict[str, float] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def to_struct(self) -> T.StructType:
        """Read schema. Every field is nullable: a reader does not enforce NOT NULL, a rule does."""
        return T.StructType([T.StructField(f.name, f.spark_type, True) for f in self.fields])

    def types(self) -> dict[str, str]:
        return {f.name: f.spark_type.simpleString() for f in self.fields}

    def required(self) -> list[str]:
        """Columns that must hold a value."""
        return [f.name for f in self.fields if not f.nullable]

    def missing_from(self, columns: list[str]) -> list[str]:
        return [n for n in self.names if n not in columns]

    def restricted_to(self, columns: list[str]) -> Contract:
        """The part of the contract that speaks about the given columns."""
        return replace(
            self,
            fields=tuple(f for f in self.fields if f.name in columns),
            not_before=tuple(p for p in self.not_before if p[0] in columns and p[1] in columns),
            warn_above={c: v for c, v in self.warn_above.items() if c in columns},
        )


# Columns, types, minima and domain of a yellow-taxi trip file.
TRIP_CONTRACT = Contract(
    dataset="yellow_taxi_trips",
    version="1.0.0",
    time_zone="America/New_York",
    fields=(
        Field("VendorID", "integer", minimum=1),
        Field("tpep_pickup_datetime", "timestamp"),
        Field("tpep_dropoff_datetime", "timestamp"),
        Field("passenger_count", "float", minimum=0),
        Field("trip_distance", "float", minimum=0),
        Field("RatecodeID", "float", minimum=1),
        Field("store_and_fwd_flag", "string", domain=("Y", "N")),
        Field("PULocationID", "integer"),
        Field("DOLocationID", "integer"),
        Field("payment_type", "integer", minimum=1),
        Field("fare_amount", "float", minimum=0, monetary=True),
        Field("extra", "float", minimum=0, monetary=True),
        Field("mta_tax", "float", minimum=0, monetary=True),
        Field("tip_amount", "float", minimum=0, monetary=True),
        Field("tolls_amount", "float", minimum=0, monetary=True),
        Field("improvement_surcharge", "float", minimum=0, monetary=True),
        Field("total_amount", "float", minimum=0, monetary=True),
        Field("congestion_surcharge", "float", minimum=0, monetary=True),
        Field("Airport_fee", "float", minimum=0, monetary=True),
        Field("cbd_congestion_fee", "float", minimum=0, monetary=True),
    ),
    not_before=(("tpep_dropoff_datetime", "tpep_pickup_datetime"),),
    warn_above={"passenger_count": 6, "trip_distance": 300, "total_amount": 1000},
)

# How trips are cleaned.
DEDUP_KEYS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "total_amount",
)
CRITICAL_COLUMNS = (
    "tpep_pickup_datetime",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
)
FILL_DEFAULTS = {"passenger_count": 1.0, "tip_amount": 0.0}
EARLIEST_PICKUP = "2009-01-01 00:00:00"
