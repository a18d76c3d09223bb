"""Secrets in texts, found once per distinct text by way of a ledger of scanned blobs.

A text is addressed by its SHA-256. The ledger remembers which (blob, rule version) pairs have been
scanned and what was found; a run scans only unseen pairs and joins the findings back to every row
that holds the blob. Everything is DataFrame work: no Python touches a text.

Defined results: a null text is the empty text; rows with equal or null ids are separate rows; a text
without secrets has an empty list of spans; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import fresh_path, text_or_empty, unused


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


WORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
#: kind: pattern, the group whose length decides, the least length of that group.
RULES: dict[str, tuple[str, int, int]] = {
    "assign": (rf"""({WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]+", 0, 16),
}
#: Cheap test whether a text can hold a passing match at all.
HINTS = {"assign": RULES["assign"][0].removesuffix("+)") + "{12,})", "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}
SPAN = "array<struct<kind:string,start:int,end:int>>"


def rule_version(rules: dict = RULES) -> str:
    """Changes whenever a rule does, so that old findings are not taken for new ones."""
    import hashlib

    return hashlib.sha256(repr(sorted(rules.items())).encode()).hexdigest()[:16]


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _kind_spans(kind: str, text: str) -> str:
    """SQL for the passing spans of one kind: gaps between matches and match lengths give positions."""
    pattern, group, least = RULES[kind]
    p = _literal(pattern)
    # the runs of a repeated class that are long enough are found directly; only assignments, whose
    # failing matches can swallow the start of another one, are matched first and dropped afterwards
    if group == 0:
        p = _literal(HINTS[kind])
    found = f"regexp_extract_all({text}, {p}, 0)"
    long_enough = f"transform(regexp_extract_all({text}, {p}, {group}), v -> length(v) >= {least})"
    gaps = f"slice(split({text}, {p}, -1), 1, size({found}))"
    steps = f"zip_with(zip_with({gaps}, {found}, (g, m) -> struct(length(g) AS gap, length(m) AS len)), {long_enough}, (x, ok) -> struct(x.gap AS gap, x.len AS len, ok AS ok))"
    one = f"array(struct('{kind}' AS kind, a.at + x.gap AS start, a.at + x.gap + x.len AS end))"
    fold = f"aggregate({steps}, struct(0 AS at, CAST(array() AS {SPAN}) AS out), (a, x) -> struct(a.at + x.gap + x.len AS at, IF(x.ok, concat(a.out, {one}), a.out) AS out), a -> a.out)"
    return f"CASE WHEN {text} RLIKE {_literal(HINTS[kind])} THEN {fold} ELSE CAST(array() AS {SPAN}) END"


def spans(text: str = "text") -> Column:
    """All spans of a text as (kind, start, end) in code points, by start and then in the order of the rules."""
    kinds = list(RULES)
    rank = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(kinds)) + " END"
    order = rank.replace("CASE kind", "CASE {}.kind")
    every = "concat(" + ", ".join(_kind_spans(k, f"`{text}`") for k in kinds) + ")"
    compare = f"CASE WHEN l.start != r.start THEN l.start - r.start ELSE {order.format('l')} - {order.format('r')} END"
    return F.expr(f"array_sort({every}, (l, r) -> {compare})")


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


class Ledger:
    """Scanned (blob, rule version) pairs and their findings, as Parquet below ``folder``.

    The ledger only grows: every scan writes to folders of its own (``run=...``), whose name no other scan
    has. A scan notes its blobs as scanned after their findings, so one that stops between is done again by
    the next; findings that are there twice are read once.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, (folder or fresh_path(spark, "ledger")).rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{table}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def scanned(self, version: str) -> DataFrame:
        return self._read("scanned", "blob string, version string, run string").where(F.col("version") == version).select("blob")

    def findings(self, version: str) -> DataFrame:
        """One row per blob with secrets."""
        rows = self._read("findings", f"blob string, found {SPAN}, version string, run string").where(F.col("version") == version)
        return rows.groupBy("blob").agg(F.first("found").alias("found"))

    def scan(self, rows: DataFrame, version: str, label: str = "scan") -> None:
        """Scan the blobs of (path, blob, body) rows that no earlier run has scanned under this version.

        One row stands for all copies of a blob; the choice moves only ids and digests, the texts are
        shuffled once, to meet it.
        """
        firsts = rows.groupBy("blob").agg(F.min("path").alias("path"))
        unseen = firsts.join(self.scanned(version), "blob", "left_anti")
        run = f"{label}-{uuid.uuid4().hex}"
        at = {t: f"{self.folder}/{t}/version={version}/run={run}" for t in ("todo", "findings", "scanned")}
        unseen.write.parquet(at["todo"])
        todo = self.spark.read.schema("blob string, path " + dict(rows.dtypes)["path"]).parquet(at["todo"])
        same = (F.col("r.blob") == F.col("t.blob")) & F.col("r.path").eqNullSafe(F.col("t.path"))
        bodies = rows.alias("r").join(todo.alias("t").hint("shuffle_hash"), same, "left_semi")
        found = bodies.select("blob", spans("body").alias("found")).where(F.size("found") > 0)
        found.write.parquet(at["findings"])
        todo.select("blob").write.parquet(at["scanned"])


def blobs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """path, blob (SHA-256 of the text) and body."""
    body = docs.select(F.col(f"`{doc_id}`").alias("path"), text_or_empty(text).alias("body"))
    return body.select("path", F.sha2("body", 256).alias("blob"), "body")


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ledger: Ledger | None = None, run: str = "scan") -> DataFrame:
    """path, blob and found (all spans) of every row, scanning only what the ledger lacks; ``run`` labels the scan."""
    ledger = ledger or Ledger(docs.sparkSession)
    version = rule_version()
    rows = blobs(docs, doc_id, text)
    ledger.scan(rows, version, run)
    # blobs with findings are few next to paths; copies of one blob may be a third of all paths, but
    # each path row is narrow and meets at most one finding, so skewed partitions can be split
    return rows.select("path", "blob").join(ledger.findings(version), "blob", "left").withColumn("found", F.coalesce("found", F.expr(f"CAST(array() AS {SPAN})")))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ledger: Ledger | None = None, run: str = "scan", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, with each (merged) secret in the text replaced by ``mask``; null texts stay null."""
    ledger = ledger or Ledger(docs.sparkSession)
    version = rule_version()
    ledger.scan(blobs(docs, doc_id, text), version, run)
    key, blob, found = (unused(docs, n) for n in ("_key", "_blob", "_found"))
    findings = ledger.findings(version).select(F.col("blob").alias(blob), F.col("found").alias(found))
    t = f"`{text}`"
    # a text that holds no hint has no finding: it stays where it lies
    hint = F.expr(" OR ".join(f"coalesce({t}, '') RLIKE {_literal(h)}" for h in HINTS.values()))
    marked = docs.where(hint).withColumn(key, F.sha2(text_or_empty(text), 256)).join(findings, F.col(key) == F.col(blob), "left")
    step = f"struct(greatest(a.at, x.end) AS at, IF(x.end <= a.at OR x.start < a.at, a.out, concat(a.out, substring({t}, a.at + 1, x.start - a.at), '{mask}')) AS out)"
    clean = f"aggregate({found}, struct(0 AS at, '' AS out), (a, x) -> {step}, a -> concat(a.out, substring({t}, a.at + 1)))"
    out = F.expr(f"CASE WHEN {found} IS NULL OR {t} IS NULL THEN {t} ELSE {clean} END")
    return docs.where(~hint).unionAll(marked.withColumn(text, out).select(*[F.col(f"`{c}`") for c in docs.columns]))
