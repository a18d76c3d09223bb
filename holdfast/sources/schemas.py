"""Table schemas and the schema-file reader."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Warehouse type names and their Spark types.
WAREHOUSE_TYPES = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}

# The declared columns of the source tables and of the prediction log.
STUDENT_DEMOGRAPHICS = """
    student_id string not null, first_name string not null, last_name string not null,
    email string not null, ssn_last4 string, birth_date date, gender string, ethnicity string,
    first_generation_flag boolean, hs_gpa double, sat_score bigint, act_score bigint,
    home_state string, home_zip string, campus string, campus_latitude double,
    campus_longitude double, campus_distance_miles double, hs_latitude double,
    hs_longitude double, cohort_year bigint, notes string, address_line2 string
"""
ACADEMIC_RECORDS = """
    student_id string not null, term string not null, term_code bigint not null, term_gpa double,
    cumulative_gpa double, credits_attempted bigint, credits_earned bigint, course_count bigint,
    major string, major_changed_flag boolean, academic_standing string, campus string
"""
FINANCIAL_AID = """
    student_id string not null, fafsa_filed_date date, efc double, pell_eligible boolean,
    total_aid_amount double, loan_amount double, grant_amount double, scholarship_amount double,
    unmet_need double, work_study_flag boolean
"""
ENROLLMENT_EVENTS = """
    student_id string not null, event_type string not null, event_date date not null, term string,
    enrollment_status string, second_year_ret_flag bigint
"""
PREDICTION_LOG = """
    prediction_id string not null, student_id string not null,
    prediction_timestamp timestamp not null, model_version string not null,
    predicted_class bigint not null, predicted_probability double not null, features_json string,
    latency_ms double, served_from_cache boolean
"""

SOURCE_TABLES = {
    "demographics": STUDENT_DEMOGRAPHICS,
    "academic_records": ACADEMIC_RECORDS,
    "financial_aid": FINANCIAL_AID,
    "enrollment_events": ENROLLMENT_EVENTS,
}


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema_of(columns: str) -> T.StructType:
    """``name type [not null], ...`` to a StructType; unlike Spark's own DDL reader it needs no session."""
    fields = []
    for column in columns.split(","):
        name, kind, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[kind], rest != ["not", "null"]))
    return T.StructType(fields)


def struct_type(entries: list[dict]) -> T.StructType:
    """``[{name, type, mode, description}]`` to a StructType; REQUIRED means not nullable."""
    fields = []
    for entry in entries:
        kind = WAREHOUSE_TYPES.get(entry["type"].upper())
        if kind is None:
            raise ValueError(f"unknown column type {entry['type']!r} for {entry['name']!r}")
        meta = {"comment": entry["description"]} if entry.get("description") else {}
        nullable = entry.get("mode", "NULLABLE").upper() != "REQUIRED"
        fields.append(T.StructField(entry["name"], kind, nullable, meta))
    return T.StructType(fields)


def struct_type_from_json(path: str) -> T.StructType:
    with open(path, encoding="utf-8") as handle:
        return struct_type(json.load(handle))
