"""The student preparation run: four source tables to a reduced numeric frame, with stage reports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators import prep, privacy, quality, reduce, relate
from holdfast.session import stage
from holdfast.sources.schemas import SOURCE_TABLES, schema_of

TARGET = "second_year_ret_flag"


@dataclass
class Prepared:
    """Frames and reports by stage name."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)


def prepare(
    tables: dict[str, DataFrame],
    target: str = TARGET,
    entity: str = "student_id",
    as_of: Column | None = None,
    anomaly_threshold: int = 0,
    pii_threshold: float = 1.0,
    redact_mode: str = "replace",
    correlation_threshold: float = 0.85,
    vif_threshold: float = 10.0,
    folder: str | None = None,
    exact_profile: bool = True,
    with_reduction: bool = True,
) -> Prepared:
    """Merge, validate, redact, harmonise, clean, derive features, export, reduce.

    Stages chain lazily.  The frame is written where several later steps read it: after the merge
    (profile, checks, personal data scan, harmonise) and after the feature stage, which both the
    export and the reduction read.  Gates raise before anything later is written.
    """
    out = Prepared()
    merged = stage(relate.merge_students(tables), "01_ingested", folder)
    out.frames["ingest"] = merged

    findings = quality.anomalies(merged, quality.STUDENT_RANGES, F.current_date() if as_of is None else as_of, target)
    quality.gate(findings, anomaly_threshold)
    out.reports["anomalies"] = findings
    out.reports["profile"] = quality.column_profile(merged, exact=exact_profile)

    redacted, pii, density = privacy.scan(merged, pii_threshold, redact_mode)
    out.reports["personal_data"], out.reports["text_density"] = pii, density

    # the clean stage asks for constants and categories of this frame, hence written as well
    out.reports["harmonise"] = prep.harmonise_report(redacted)
    harmonised = stage(prep.harmonise(redacted), "04_harmonized", folder)
    out.frames["harmonise"] = harmonised

    cleaned, out.reports["clean"] = prep.clean(harmonised, target, entity)
    features = stage(prep.engineer_features(cleaned), "06_features", folder)
    out.frames["features"] = features

    out.reports["features"] = prep.stage_report(cleaned, features)

    out.frames["export"] = prep.export_features(features, entity)
    out.reports["export"] = prep.export_report(features, out.frames["export"])
    if with_reduction:
        out.frames["reduced"], out.reports["reduce"] = reduce.reduce_dimensions(
            features, target, entity, correlation_threshold, vif_threshold=vif_threshold
        )
    return out


def _draw(name: str, n: int) -> str:
    """Number in 0..n-1 from the order key: two rounds of multiplying and wrapping, differing by name."""
    seed = sum((i + 1) * ord(c) for i, c in enumerate(name))
    return f"((o_orderkey * {100003 + 2 * seed} + {seed * 7919}) % 1000003 * {7001 + 2 * seed} % 999983 % {n})"


def _pick(name: str, *values: str) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"(case {_draw(name, len(values))} {cases} end)"


def _digits(number: str, width: int) -> str:
    return f"lpad(cast({number} as varchar(20)), {width}, '0')"


# The student tables as SQL over the shared tables.
# Every order plays a student, its lines the terms, its customer the financial aid.
DERIVED = {
    "demographics": f"""
        select {_digits("o_orderkey", 12)} as student_id,
               concat('First', o_custkey) as first_name,
               concat('Last', o_orderkey) as last_name,
               concat('s', o_orderkey, '@example.edu') as email,
               case when {_draw("ssn", 10)} < 7 then {_digits(_draw("four", 10000), 4)} end as ssn_last4,
               date '2001-01-01' + cast({_draw("birth", 1000)} as int) as birth_date,
               {_pick("gender", "F", "M", "X", "U")} as gender,
               {_pick("ethnicity", "A", "B", "C", "D", "E", "F", "G", "H")} as ethnicity,
               {_draw("first", 10)} < 3 as first_generation_flag,
               case when {_draw("nogpa", 50)} > 0 then 1.5e0 + {_draw("gpa", 251)} / 100e0 end as hs_gpa,
               case when {_draw("badsat", 100)} = 0 then 9999 else 400 + 10 * {_draw("sat", 121)} end as sat_score,
               1 + {_draw("act", 36)} as act_score,
               concat('S', {_draw("state", 20)}) as home_state,
               {_digits(_draw("zip", 100000), 5)} as home_zip,
               {_pick("campus", "North", "South", "East", "West", "Online")} as campus,
               40e0 + {_draw("campus", 5)} as campus_latitude,
               -80e0 - {_draw("campus", 5)} as campus_longitude,
               {_draw("miles", 8000)} / 10e0 as campus_distance_miles,
               30e0 + {_draw("lat", 2000)} / 100e0 as hs_latitude,
               -120e0 + {_draw("lon", 4000)} / 100e0 as hs_longitude,
               2019 + o_orderkey % 3 as cohort_year,
               case when {_draw("note", 100)} < 15 then concat('SSN on file is ',
                    {_digits(_draw("s1", 1000), 3)}, '-', {_digits(_draw("s2", 100), 2)}, '-',
                    {_digits(_draw("s3", 10000), 4)}) end as notes,
               case when {_draw("line", 100)} < 5 then concat('Reach at (', 200 + {_draw("p1", 800)}, ') ',
                    200 + {_draw("p2", 800)}, '-', 1000 + {_draw("p3", 9000)}) end as address_line2
        from {{orders}}
    """,
    # several lines of an order may share a number, so a term is one number of one order
    "academic_records": f"""
        select {_digits("l_orderkey", 12)} as student_id,
               concat('Term ', l_linenumber) as term,
               201900 + 100 * l_linenumber as term_code,
               gpa / 12.5e0 as term_gpa,
               case when supp % 9 > 0 then discount * 40 end as cumulative_gpa,
               12 + supp % 7 as credits_attempted,
               8 + supp % 5 as credits_earned,
               4 + supp % 3 as course_count,
               concat('Major ', supp % 12) as major,
               supp % 8 = 0 as major_changed_flag,
               case when gpa < 18.75e0 then 'suspension' when gpa < 25e0 then 'probation' else 'good' end
                   as academic_standing,
               concat('Campus ', supp % 5) as campus
        from (
            select l_orderkey, l_linenumber, max(l_quantity) as gpa, max(l_discount) as discount, max(l_suppkey) as supp
            from {{lineitem}} group by l_orderkey, l_linenumber
        ) t
    """,
    "financial_aid": f"""
        select {_digits("o_orderkey", 12)} as student_id,
               cast(o_orderdate as date) as fafsa_filed_date,
               abs(c_acctbal) * 3 as efc,
               abs(c_acctbal) * 3 < 6000 as pell_eligible,
               o_totalprice / 20 as total_aid_amount,
               o_totalprice / 20 * ({_draw("loan", 100)} / 100e0) as loan_amount,
               o_totalprice / 20 * ({_draw("grant", 60)} / 100e0) as grant_amount,
               o_totalprice / 20 * ({_draw("schol", 40)} / 100e0) as scholarship_amount,
               greatest(0e0, 20000 - o_totalprice / 20 - abs(c_acctbal)) as unmet_need,
               {_draw("work", 5)} = 0 as work_study_flag
        from {{orders}} join {{customer}} on o_custkey = c_custkey
    """,
    "enrollment_events": f"""
        select {_digits("o_orderkey", 12)} as student_id,
               event_type,
               case when {_draw("future", 200)} = 0 then date '2037-06-15' else cast(o_orderdate as date) end as event_date,
               concat('Fall ', 2019 + o_orderkey % 3) as term,
               case when event_type <> 'enrollment' then 'not_enrolled'
                    else {_pick("status", "full-time", "part-time")} end as enrollment_status,
               case when event_type = 'enrollment' then coalesce(returned, 0) end as second_year_ret_flag
        from (
            select o_orderkey, o_orderdate, returned, explode(array('application', 'acceptance', 'enrollment')) as event_type
            from {{orders}}
            left join (select l_orderkey, max(case when l_returnflag = 'R' then 1 else 0 end) as returned
                       from {{lineitem}} group by l_orderkey) r on o_orderkey = l_orderkey
        ) t
    """,
}


def derived_tables(spark, sf_dir: str) -> dict[str, DataFrame]:
    """The four student tables in the shape of their schemas, computed from the shared tables."""
    given = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem", "customer")}
    out = {}
    for name, sql in DERIVED.items():
        shaped = spark.sql(sql, **{n: df for n, df in given.items() if "{" + n + "}" in sql})
        fields = schema_of(SOURCE_TABLES[name]).fields
        out[name] = shaped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    return out
