"""Queries: personal data in documents and customer columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import privacy
from holdfast.plans.registry import query, table

PERSONAL = {"c_name": "PERSON_NAME", "c_mktsegment": "PERSON_NAME", "c_acctbal": "ACCOUNT"}
_P = privacy.PATTERNS


def people(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"),
    )


PEOPLE_SQL = """
    select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as c_mktsegment,
           case when c_acctbal > 0 then c_acctbal end as c_acctbal
    from customer
"""


def texts(spark, sf):
    """Documents with a reference number appended to every third text, which has the shape of a SSN."""
    number = F.concat(
        F.lit(" ref "),
        F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0"),
        F.lit("-"),
        F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0"),
    )
    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.concat("text", number)).otherwise(F.col("text")).alias("notes"),
        F.when(F.col("source") != "web", F.col("text")).alias("address_line2"),
    )


TEXTS_SQL = """
    select doc_id,
           case when doc_id % 3 = 0 then text || ' ref ' || lpad((doc_id % 1000)::varchar, 3, '0') || '-'
                || lpad((doc_id % 100)::varchar, 2, '0') || '-' || lpad((doc_id % 10000)::varchar, 4, '0')
                else text end as notes,
           case when source <> 'web' then text end as address_line2
    from documents
"""


def _hits(column, name):
    return f"count(*) filter (regexp_matches({column}, '{_P[name]}'))"


@query(
    "pii_findings",
    f"with t as ({TEXTS_SQL}), f as ("
    + " union all ".join(
        f"select '{name}_in_{c}' as info_type, {_hits(c, name)} as findings from t"
        for c in ("notes", "address_line2")
        for name in _P
    )
    + ") select * from f where findings > 0",
)
def pii_findings(spark, sf):
    return privacy.findings(texts(spark, sf))


@query(
    "pii_column_findings",
    f"""
    with t as ({PEOPLE_SQL})
    select 'PERSON_NAME' as info_type, (count(c_name) + count(c_mktsegment))::bigint as findings from t
    union all select 'ACCOUNT', count(c_acctbal) from t
    """,
)
def pii_column_findings(spark, sf):
    return privacy.findings(people(spark, sf), PERSONAL, ())


@query(
    "pii_density",
    f"""
    with t as ({TEXTS_SQL}),
    c as (
        select count(*) as n, count(notes) + count(address_line2) as cells,
               {" + ".join(_hits(c, name) for c in ("notes", "address_line2") for name in _P)} as hits
        from t
    )
    select n as rows_scanned, hits as text_findings, cells as text_cells,
           round(hits / cells, 4) as density, round(hits / cells, 4) > 0.05 as blocked
    from c
    """,
)
def pii_density(spark, sf):
    return privacy.text_density(texts(spark, sf))


def _redacted(column):
    out = column
    for name, pattern in _P.items():
        out = f"regexp_replace({out}, '{pattern}', '[{name}]', 'g')"
    return out


@query(
    "pii_redact_text",
    f"""
    select doc_id, sha256({_redacted("notes")}) as notes_digest,
           sha256({_redacted("address_line2")}) as address_digest,
           length({_redacted("notes")})::bigint as notes_length
    from ({TEXTS_SQL})
    """,
)
def pii_redact_text(spark, sf):
    redacted = privacy.redact_text(texts(spark, sf))
    return redacted.select(
        "doc_id",
        F.sha2("notes", 256).alias("notes_digest"),
        F.sha2("address_line2", 256).alias("address_digest"),
        F.length("notes").cast("bigint").alias("notes_length"),
    )


@query(
    "pii_hash",
    f"""
    select c_custkey, substr(sha256(c_name), 1, 16) as c_name, substr(sha256(c_mktsegment), 1, 16) as c_mktsegment
    from ({PEOPLE_SQL})
    """,
)
def pii_hash(spark, sf):
    frame = people(spark, sf).select("c_custkey", "c_name", "c_mktsegment")
    return privacy.redact_columns(frame, "hash", {"c_name": "PERSON_NAME", "c_mktsegment": "PERSON_NAME"})


@query(
    "pii_token",
    f"""
    select c_custkey, case when c_name is not null then '[PERSON_NAME]' end as c_name,
           case when c_mktsegment is not null then '[PERSON_NAME]' end as c_mktsegment,
           case when c_acctbal is not null then '[ACCOUNT]' end as c_acctbal
    from ({PEOPLE_SQL})
    """,
)
def pii_token(spark, sf):
    return privacy.redact_columns(people(spark, sf), "replace", PERSONAL)


@query("pii_drop", f"select c_custkey from ({PEOPLE_SQL})")
def pii_drop(spark, sf):
    return privacy.redact_columns(people(spark, sf), "drop", PERSONAL)


@query(
    "pii_column_report",
    f"""
    select count(*) + (select count(*) from ({TEXTS_SQL}) where doc_id not in (select c_custkey from customer)) as total_records,
           count(c_mktsegment) as has_email, count(c_name) as has_first_name,
           count(c_name) as has_last_name, count(c_acctbal) as has_ssn_last4, count(c_custkey) as has_birth_date,
           (select count(*) filter (regexp_matches(notes, '\\d{{3}}-\\d{{2}}-\\d{{4}}')) from ({TEXTS_SQL})
            ) as ssn_in_notes,
           (select count(*) filter (regexp_matches(address_line2, '\\(\\d{{3}}\\)')) from ({TEXTS_SQL})
            ) as phone_in_address
    from ({PEOPLE_SQL})
    """,
)
def pii_column_report(spark, sf):
    frame = people(spark, sf).join(texts(spark, sf), F.col("c_custkey") == F.col("doc_id"), "full")
    return privacy.density_report(
        frame.select(
            F.col("c_mktsegment").alias("email"),
            F.col("c_name").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.col("c_acctbal").alias("ssn_last4"),
            F.col("c_custkey").alias("birth_date"),
            "notes",
            "address_line2",
        )
    )
