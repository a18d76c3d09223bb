"""The registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import decontaminate, divergence, fingerprints, html_main, merkle, near_text, near_vectors, rans, secrets, sentencepieces, token_counts, toxicity, warc
from holdfast.llm.common import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a published tokenizer file on this machine; executors hold the same folder."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _secrets_sql() -> str:
    parts, spans = [], []
    for rank, (kind, (pattern, group, least)) in enumerate(secrets.RULES.items()):
        p = "'" + (pattern if group else secrets.HINTS[kind]).replace("'", "\\x27") + "'"
        parts.append(
            f"list_zip(string_split_regex(t, {p})[1:len(regexp_extract_all(t, {p}))], regexp_extract_all(t, {p}), regexp_extract_all(t, {p}, {group})) AS m{rank}"
        )
        spans.append(
            f"list_filter(list_transform(range(1, len(m{rank}) + 1), lambda i: struct_pack(start := CAST(list_sum(list_transform(m{rank}[1:i], lambda x: length(x[1]) + length(x[2]))) AS BIGINT) - length(m{rank}[i][2]), "
            f"rank := {rank}, kind := '{kind}', stop := CAST(list_sum(list_transform(m{rank}[1:i], lambda x: length(x[1]) + length(x[2]))) AS BIGINT), keep := length(m{rank}[i][3]) >= {least})), lambda s: s.keep)"
        )
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        matched AS (SELECT doc_id, t, {', '.join(parts)} FROM texts),
        found AS (SELECT doc_id, t, list_sort(list_concat({', '.join(spans)})) AS s FROM matched),
        told AS (SELECT doc_id, t, s, array_to_string(list_transform(s, lambda x: x.kind || ':' || x.start || ':' || x.stop), ',') AS spans FROM found)
        SELECT doc_id, sha256(t) AS blob,
               CAST(len(list_filter(s, lambda x: x.kind = 'assign')) AS BIGINT) AS n_assign,
               CAST(len(list_filter(s, lambda x: x.kind = 'access')) AS BIGINT) AS n_access,
               CAST(len(list_filter(s, lambda x: x.kind = 'hex')) AS BIGINT) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM told"""


@query("op1_secret_scan", _secrets_sql())
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by way of a ledger that has seen an earlier state of the table: the
    documents up to the middle id. Only the blobs that this state lacks are scanned for the whole table."""
    docs, ledger = table(spark, sf_dir, "documents"), secrets.Ledger(spark)
    middle = docs.select(F.expr("(min(doc_id) + max(doc_id)) / 2").alias("m")).first()["m"]
    if middle is not None:
        earlier = docs.where(F.col("doc_id") <= middle)
        ledger.scan(secrets.blobs(earlier), secrets.rule_version(), "earlier")
    found = secrets.scan_documents(docs, ledger=ledger)
    counts = [F.expr(f"CAST(size(filter(found, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in secrets.RULES]
    told = found.select(F.col("path").alias("doc_id"), "blob", *counts, secrets.joined(F.col("found")).alias("spans"))
    return told.withColumn("base_sha256", F.sha2("spans", 256))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the compiled transducer."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op3_benchmark_overlap")
def op3_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents repeat, with the place of the best diagonal."""
    return decontaminate.repeated_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the lattice, and whether decoding restores the text."""
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op5_token_id_files")
def op5_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy-coded id files of all documents, written and read back."""
    folder = fresh_path(spark, "token-ids")
    rans.write_ids(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), folder)
    return rans.read_ids(spark, folder).drop("ids")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and toxic spans of all documents; labels of held-out documents are not read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model).drop("text")
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted, "spans")


@query("op6_near_copies")
def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    return near_text.near_copies(table(spark, sf_dir, "documents"))


@query("op9_near_vectors")
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of one label."""
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages without the templates of their hosts."""
    return html_main.extract(table(spark, sf_dir, "pages"))


@query(
    "op10_warc",
    """
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS page FROM pages),
    t AS (SELECT page_id, url, CAST(octet_length(encode(page)) AS BIGINT) AS payload_bytes, sha256(page) AS payload_digest FROM p),
    f AS (SELECT payload_digest, min(page_id) AS first FROM t WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
    FROM t LEFT JOIN f USING (payload_digest)""",
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as web archive records, read back by way of the capture index."""
    captures = warc.archive(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of a short ASCII text: each byte is mixed in, then eight single steps follow."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, x: {step}), 4294967295)"


def _merkle_sql() -> str:
    told = {f: f"coalesce(octet_length(encode(CAST({f} AS VARCHAR))) || ':' || CAST({f} AS VARCHAR), '-')" for f in merkle.FIELDS}
    held = told | {"text": "coalesce(octet_length(encode(held)) || ':' || held, '-')"}
    return f"""
        WITH RECURSIVE d AS (
            SELECT *, CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS held FROM documents),
        l AS (SELECT doc_id, source, sha256({' || '.join(told.values())}) AS leaf, sha256({' || '.join(held.values())}) AS held FROM d),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM l),
        up AS (
            SELECT source, CAST(0 AS BIGINT) AS level, place, leaf AS node, n FROM leaves
            UNION ALL
            SELECT source, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY source, level, n, place // 3),
        tops AS (SELECT source, level AS height, node AS subroot FROM up WHERE n = 1),
        groups AS (
            SELECT *, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tops),
        above AS (
            SELECT CAST(0 AS BIGINT) AS level, place, subroot AS node, n FROM groups
            UNION ALL
            SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY level, n, place // 3),
        runs AS (SELECT source, level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM up WHERE n > 1 GROUP BY source, level, place // 3),
        high AS (SELECT level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM above WHERE n > 1 GROUP BY level, place // 3),
        steps AS (
            SELECT r.source, r.level, r.run, CAST(NULL AS BIGINT) AS own, r.nodes FROM runs r
            UNION ALL
            SELECT g.source, g.height + h.level, h.run, CAST(g.place // CAST(power(3, h.level) AS BIGINT) AS BIGINT), h.nodes
            FROM groups g JOIN high h ON h.run = g.place // CAST(power(3, h.level + 1) AS BIGINT)),
        folded AS (
            SELECT doc_id, source, CAST(0 AS BIGINT) AS level, place, held AS node, '' AS siblings FROM leaves
            UNION ALL
            SELECT f.doc_id, f.source, f.level + 1, f.place // 3,
                   sha256(array_to_string(s.nodes[1:coalesce(s.own, f.place) % 3], '') || f.node || array_to_string(s.nodes[coalesce(s.own, f.place) % 3 + 2:], '')),
                   f.siblings || array_to_string(s.nodes[1:coalesce(s.own, f.place) % 3], '') || array_to_string(s.nodes[coalesce(s.own, f.place) % 3 + 2:], '')
            FROM folded f JOIN steps s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.level AND (s.own IS NOT NULL OR s.run = f.place // 3)),
        ends AS (SELECT doc_id, arg_max(node, level) AS folded_root, arg_max(siblings, level) AS siblings FROM folded GROUP BY doc_id),
        root AS (SELECT node AS root FROM above WHERE n = 1)
        SELECT l.doc_id, l.leaf, t.subroot, r.root, sha256(e.siblings) AS proof_sha256, e.folded_root, e.folded_root = r.root AS verified
        FROM leaves l JOIN tops t ON l.source IS NOT DISTINCT FROM t.source JOIN ends e ON l.doc_id = e.doc_id CROSS JOIN root r"""


@query("op11_merkle_manifest", _merkle_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and the proof of each against a copy that lost its line ends in places."""
    lost = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    made = merkle.manifest(table(spark, sf_dir, "documents"), held={"text": F.when(lost, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))})
    return merkle.audit(made).withColumnRenamed("name", "doc_id")


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edited_documents(table(spark, sf_dir, "documents"))


_DIVERGENCE_SQL = """
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS word FROM d),
    w AS (SELECT r, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM t),
    c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
    k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
    v AS (SELECT lang, count(*) AS kept, sum(n) AS total FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS of_lang FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    sums AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY ALL),
    p AS (SELECT grid.lang, grid.source, term, n,
                 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sums.total + 5 * kept) AS p,
                 1 + (CAST(1000000000 AS HUGEINT) * (of_lang + 5)) // (v.total + 5 * kept) AS q
          FROM grid JOIN sums USING (lang, source) JOIN v USING (lang)),
    apart AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
    rows AS (
        SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(apart.value, 0) AS BIGINT) AS value
        FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN apart ON apart.lang = x.lang AND apart.source = x.source AND apart.item = y.source
        UNION ALL
        SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM rows)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


@query("op12_source_divergence", _DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and their most telling terms, over all documents."""
    return divergence.audit(table(spark, sf_dir, "documents"))
