"""Personal data: findings by column name and by pattern, density gate, redaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.scalars import short_sha256, token
from holdfast.operators.quality import col

# Detection patterns.
PATTERNS = {
    "US_SOCIAL_SECURITY_NUMBER": r"\b\d{3}-\d{2}-\d{4}\b",
    "PHONE_NUMBER": r"\(\d{3}\)\s?\d{3}-\d{4}",
    "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
}
# A character every match of the pattern holds; looking for it first spares most texts the pattern.
MARKS = {
    PATTERNS["US_SOCIAL_SECURITY_NUMBER"]: "-",
    PATTERNS["PHONE_NUMBER"]: "(",
    PATTERNS["EMAIL_ADDRESS"]: "@",
}
# Columns that are personal by name, and free-text columns.
PERSONAL_COLUMNS = {
    "first_name": "PERSON_NAME",
    "last_name": "PERSON_NAME",
    "email": "EMAIL_ADDRESS",
    "ssn_last4": "US_SOCIAL_SECURITY_NUMBER",
    "birth_date": "DATE_OF_BIRTH",
}
TEXT_COLUMNS = ("notes", "address_line2")


def _matches(value: Column, pattern: str) -> Column:
    mark = MARKS.get(pattern)
    return value.rlike(pattern) if mark is None else value.contains(mark) & value.rlike(pattern)


def _replaced(value: Column, pattern: str, by: str) -> Column:
    changed, mark = F.regexp_replace(value, pattern, by), MARKS.get(pattern)
    return changed if mark is None else F.when(value.contains(mark), changed).otherwise(value)


def _counts(df: DataFrame, personal: dict[str, str], text: Sequence[str], patterns: dict[str, str]):
    """One aggregate over the frame: non-null counts and pattern hits, each scanned once."""
    personal = {c: t for c, t in personal.items() if c in df.columns}
    text = [c for c in text if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(col(c)).alias(f"p{i}") for i, c in enumerate(personal)]
    aggs += [F.count(col(c)).alias(f"t{j}") for j, c in enumerate(text)]
    for j, c in enumerate(text):
        aggs += [F.count_if(_matches(col(c), p)).alias(f"m{j}_{k}") for k, p in enumerate(patterns.values())]
    return df.agg(*aggs), personal, text


def _findings(counts: DataFrame, personal: dict[str, str], text: Sequence[str], patterns: dict[str, str]) -> DataFrame:
    rows = [
        F.struct(F.lit(info).alias("info_type"), F.col(f"p{i}").alias("findings"))
        for i, info in enumerate(personal.values())
    ]
    for j, c in enumerate(text):
        rows += [
            F.struct(F.lit(f"{name}_in_{c}").alias("info_type"), F.col(f"m{j}_{k}").alias("findings"))
            for k, name in enumerate(patterns)
        ]
    return (
        counts.select(F.inline(F.array(*rows)))
        .groupBy("info_type")
        .agg(F.sum("findings").alias("findings"))
        .where("findings > 0")
    )


def _density(counts: DataFrame, text: Sequence[str], patterns: dict[str, str], threshold: float) -> DataFrame:
    hits, cells = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for j in range(len(text)):
        cells = cells + F.col(f"t{j}")
        for k in range(len(patterns)):
            hits = hits + F.col(f"m{j}_{k}")
    density = F.round(F.coalesce(F.try_divide(hits, cells), F.lit(0.0)), 4)
    return counts.select(
        F.col("rows").alias("rows_scanned"),
        hits.alias("text_findings"),
        cells.alias("text_cells"),
        density.alias("density"),
        (density > threshold).alias("blocked"),
    )


def findings(
    df: DataFrame,
    personal: dict[str, str] = PERSONAL_COLUMNS,
    text: Sequence[str] = TEXT_COLUMNS,
    patterns: dict[str, str] = PATTERNS,
) -> DataFrame:
    """Positive findings per info type; free-text hits are keyed ``<TYPE>_in_<column>``."""
    return _findings(*_counts(df, personal, text, patterns), patterns)


def text_density(
    df: DataFrame, text: Sequence[str] = TEXT_COLUMNS, patterns: dict[str, str] = PATTERNS, threshold: float = 0.05
) -> DataFrame:
    """Pattern hits over non-null text cells (a cell counts once per pattern) and the blocking flag."""
    counts, _, text = _counts(df, {}, text, patterns)
    return _density(counts, text, patterns, threshold)


def redact_columns(
    df: DataFrame, mode: str = "replace", personal: dict[str, str] = PERSONAL_COLUMNS
) -> DataFrame:
    """Replace personal columns by tokens, hash them, or drop them."""
    present = {c: t for c, t in personal.items() if c in df.columns}
    if mode == "drop":
        return df.drop(*present)
    if mode == "hash":
        return df.withColumns({c: short_sha256(col(c)) for c in present})
    if mode == "replace":
        return df.withColumns({c: token(col(c), t) for c, t in present.items()})
    raise ValueError(f"unknown redaction mode {mode!r}")


def redact_text(
    df: DataFrame, text: Sequence[str] = TEXT_COLUMNS, patterns: dict[str, str] = PATTERNS
) -> DataFrame:
    """Replace every pattern hit by its token, pattern after pattern in their given order."""
    changed = [c for c in text if c in df.columns]
    # one projection per pattern, as each looks at the result of the one before
    for name, pattern in patterns.items():
        if changed:
            df = df.withColumns({c: _replaced(col(c), pattern, f"[{name}]") for c in changed})
    return df


def scan(
    df: DataFrame,
    threshold: float = 0.05,
    mode: str = "replace",
    personal: dict[str, str] = PERSONAL_COLUMNS,
    text: Sequence[str] = TEXT_COLUMNS,
    patterns: dict[str, str] = PATTERNS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Redacted frame, findings and density; raises before anything is written when too dense."""
    counts, present, scanned = _counts(df, personal, text, patterns)
    # the texts are searched once; both reports are made from that one row of counts
    counted = df.sparkSession.createDataFrame(counts.collect(), counts.schema)
    density = _density(counted, scanned, patterns, threshold)
    row = density.first()
    if row["blocked"]:
        raise ValueError(f"personal data density {row['density']} exceeds the threshold {threshold}")
    redacted = redact_text(redact_columns(df, mode, personal), text, patterns)
    return redacted, _findings(counted, present, scanned, patterns), density


def density_report(df: DataFrame) -> DataFrame:
    """Counts of personal fields and of embedded numbers over the demographics table, one row."""
    names = ["email", "first_name", "last_name", "ssn_last4", "birth_date"]
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count(c).alias(f"has_{c}") for c in names],
        F.count_if(F.col("notes").rlike(r"\d{3}-\d{2}-\d{4}")).alias("ssn_in_notes"),
        F.count_if(F.col("address_line2").rlike(r"\(\d{3}\)")).alias("phone_in_address"),
    )
