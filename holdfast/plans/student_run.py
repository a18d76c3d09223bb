"""Queries: the whole preparation over student-shaped tables derived from the shared ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import prep, privacy, quality, relate
from holdfast.plans import students
from holdfast.plans.registry import query
from holdfast.sources.schemas import SOURCE_TABLES, schema_of

AS_OF = "2026-01-01"


def _plain(name):
    """The derivation in the words of the checking engine."""
    sql = students.DERIVED[name].replace("explode(array(", "unnest(list_value(")
    for table in ("orders", "lineitem", "customer"):
        sql = sql.replace("{" + table + "}", table)
    return sql


_TERM = [f.name for f in schema_of(SOURCE_TABLES["academic_records"]).fields if f.name not in ("student_id", "term", "campus")]
MERGED_SQL = f"""
    demographics as ({_plain("demographics")}),
    academic as ({_plain("academic_records")}),
    aid as ({_plain("financial_aid")}),
    enrollment_events as ({_plain("enrollment_events")}),
    latest as (
        select student_id, {", ".join(f"arg_max({c}, term_code) as {c}" for c in [*_TERM, "term", "campus"])}
        from academic group by student_id
    ),
    merged as (
        select e.*, d.* exclude (student_id), f.* exclude (student_id),
               l.* exclude (student_id, term, campus), l.term as term_acad, l.campus as campus_acad
        from enrollment_events e
        left join demographics d on e.student_id = d.student_id
        left join aid f on e.student_id = f.student_id
        left join latest l on e.student_id = l.student_id
        where event_type = 'enrollment'
    )
"""
_SHOWN = ["student_id", "term", "second_year_ret_flag", "hs_gpa", "sat_score", "campus", "efc", "total_aid_amount",
          "unmet_need", "pell_eligible", "term_gpa", "cumulative_gpa", "credits_earned", "major", "term_acad",
          "campus_acad", "academic_standing", "ssn_last4", "address_line2"]
_ROUNDED = ("hs_gpa", "efc", "total_aid_amount", "unmet_need", "term_gpa", "cumulative_gpa")


def _features_sql():
    raw = ["hs_gpa", "sat_score", "act_score", "cumulative_gpa", "term_gpa", "credits_earned", "credits_attempted", "efc",
           "total_aid_amount", "loan_amount", "unmet_need", "campus_distance_miles"]
    filled = ", ".join(f"coalesce({c}, -1)::double as {c}" for c in raw)
    derived = {
        "gpa_change": "cumulative_gpa - hs_gpa",
        "gpa_momentum": "case when cumulative_gpa > 0 then term_gpa / cumulative_gpa else 1.0 end",
        "credit_ratio": "case when credits_attempted > 0 then credits_earned / credits_attempted else 0.0 end",
        "credit_deficit": "credits_attempted - credits_earned",
        "aid_coverage_ratio": "least(50.0, greatest(0.0, case when efc > 0 then total_aid_amount / efc else 0.0 end))",
        "loan_dependency": "case when total_aid_amount > 0 then loan_amount / total_aid_amount else 0.0 end",
        "test_score_composite": "least(1.0, greatest(0.0, ((sat_score - 400) / 1200 + (act_score - 1) / 35) / 2))",
    }
    miles = "campus_distance_miles"
    bins = (f"case when {miles} < 0 then -1 when {miles} <= 25 then 0 when {miles} <= 50 then 1 when {miles} <= 100 then 2 "
            f"when {miles} <= 250 then 3 when {miles} <= 500 then 4 else 5 end as distance_bin")
    shown = [f"round({c}, 6) as {c}" for c in raw] + [f"round({e}, 6) as {c}" for c, e in derived.items()]
    return (f"with {MERGED_SQL}, filled as (select student_id, cohort_year, {filled} from merged) "
            f"select student_id, cohort_year, {bins}, {', '.join(shown)} from filled")


def _run(spark, sf, **options):
    return students.prepare(students.derived_tables(spark, sf), as_of=F.lit(AS_OF), **options)


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "student_merge",
    f"with {MERGED_SQL} select "
    + ", ".join(f"round({c}, 6) as {c}" if c in _ROUNDED else c for c in _SHOWN)
    + " from merged",
)
def student_merge(spark, sf):
    """The analysis frame: enrolments with demographics, aid and latest term values."""
    return _rounded(relate.merge_students(students.derived_tables(spark, sf)).select(*_SHOWN))


@query("student_reduced_frame")
def student_reduced_frame(spark, sf):
    """All eight stages; the reduced frame."""
    return _run(spark, sf).frames["reduced"]


@query("student_feature_export", _features_sql())
def student_feature_export(spark, sf):
    """Merge, redact, harmonise, clean, derive, export."""
    return _rounded(_run(spark, sf, with_reduction=False).frames["export"])


@query("student_stage_report")
def student_stage_report(spark, sf):
    """What every stage reported, as (stage, item, detail) rows."""
    run = _run(spark, sf)
    out = None
    for name, report in run.reports.items():
        item = F.col(report.columns[0]).cast("string")
        row = report.select(F.lit(name).alias("stage"), item.alias("item"), F.to_json(F.struct("*")).alias("detail"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "student_quality_summary",
    f"""
    with {MERGED_SQL}
    select round(avg((notes is not null)::int), 6) as pii_in_notes,
           round(avg((address_line2 is not null)::int), 6) as pii_in_address,
           round(avg((hs_gpa is null)::int), 6) as null_hs_gpa,
           round(avg((sat_score < 400 or sat_score > 1600)::int), 6) as bad_sat,
           (select round(avg(second_year_ret_flag), 6) from merged) as retention_rate
    from demographics
    """,
)
def student_quality_summary(spark, sf):
    """Retention rate and rates of the injected faults over the source tables."""
    tables = students.derived_tables(spark, sf)
    enrolled = tables["enrollment_events"].where("event_type = 'enrollment'")
    retention = quality.quality_rates(enrolled, {"retention_rate": (None, F.col("second_year_ret_flag"))})
    faults = quality.quality_rates(
        tables["demographics"],
        {
            "pii_in_notes": (None, F.col("notes").isNotNull()),
            "pii_in_address": (None, F.col("address_line2").isNotNull()),
            "null_hs_gpa": (None, F.col("hs_gpa").isNull()),
            "bad_sat": (None, (F.col("sat_score") < 400) | (F.col("sat_score") > 1600)),
        },
    )
    return _rounded(faults.withColumn("retention_rate", retention.scalar()))


@query(
    "student_pii_density",
    f"""
    with {MERGED_SQL}
    select count(*) as total_records, count(email) as has_email, count(first_name) as has_first_name,
           count(last_name) as has_last_name, count(ssn_last4) as has_ssn_last4, count(birth_date) as has_birth_date,
           count(*) filter (regexp_matches(notes, '\\d{{3}}-\\d{{2}}-\\d{{4}}')) as ssn_in_notes,
           count(*) filter (regexp_matches(address_line2, '\\(\\d{{3}}\\)')) as phone_in_address
    from demographics
    """,
)
def student_pii_density(spark, sf):
    return privacy.density_report(students.derived_tables(spark, sf)["demographics"])


_FILLABLE = [
    c
    for ddl in SOURCE_TABLES.values()
    for c in [f.name for f in schema_of(ddl).fields if f.dataType.typeName() != "date"]
]
_COUNTED = " + ".join(
    f"(count(*) > count({c}))::int"
    for c in [*dict.fromkeys(_FILLABLE), "term_acad", "campus_acad"]
)


@query(
    "student_harmonise_report",
    f"""
    with {MERGED_SQL}
    select count(*) as initial_rows, count(*) - (select count(*) from (select distinct * from merged)) as duplicates_removed,
           33::int as columns_coerced,
           ({_COUNTED})::int as nulls_filled,
           (select count(*) from (select distinct * from merged)) as output_rows, 48::int as output_columns
    from merged
    """,
)
def student_harmonise_report(spark, sf):
    return prep.harmonise_report(relate.merge_students(students.derived_tables(spark, sf)))
