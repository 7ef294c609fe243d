"""Logical tables as explicit schemas, and helpers that look at schemas only."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "binary": T.BinaryType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def struct_of(spec: str) -> T.StructType:
    """``"name type"`` or ``"name type!"`` (not nullable), comma separated."""
    fields = []
    for item in spec.split(","):
        name, ddl = item.split()
        fields.append(T.StructField(name, _TYPES[ddl.rstrip("!")], not ddl.endswith("!")))
    return T.StructType(fields)


ADMISSIONS = struct_of(
    "admission_id string!, patient_id string!, admit_time timestamp!, discharge_time timestamp, los_days int,"
    "admit_acuity double, age int, sex string, diabetes int, ckd int, copd int, chf int, comorbidity_count int"
)
VITALS = struct_of(
    "admission_id string!, patient_id string!, event_time timestamp!,"
    "hr double, sbp double, dbp double, spo2 double, event_date date"
)
LABS = struct_of(
    "admission_id string!, patient_id string!, event_time timestamp!,"
    "wbc double, creatinine double, lactate double, event_date date"
)
OUTCOMES = struct_of(
    "admission_id string!, patient_id string!, deterioration int!, deterioration_time timestamp, outcome_type string"
)
RAW_TABLES = {"admissions": ADMISSIONS, "vitals": VITALS, "labs": LABS, "outcomes": OUTCOMES}

_NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise unless every column of ``schema`` is there with its type; extra columns may stay."""
    missing = missing_columns(df, schema.names)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    wrong = [
        f"{f.name} is {df.schema[f.name].dataType.simpleString()}, expected {f.dataType.simpleString()}"
        for f in schema
        if df.schema[f.name].dataType != f.dataType
    ]
    if wrong:
        raise ValueError("wrong types: " + "; ".join(wrong))
    return df


def enforce_schema(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Project to the columns of ``schema`` and cast. ``lenient`` turns bad values into nulls."""
    missing = missing_columns(df, schema.names)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")

    def converted(f: T.StructField):
        if df.schema[f.name].dataType == f.dataType:
            return F.col(f.name)
        c = F.col(f.name)
        return (c.try_cast(f.dataType) if lenient else c.cast(f.dataType)).alias(f.name)

    return df.select(*[converted(f) for f in schema])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, _NUMERIC) and f.name not in skip]


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in wanted if c in have]
