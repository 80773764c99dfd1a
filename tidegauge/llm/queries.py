"""The registered queries of this package, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegauge.llm import (
    chat,
    decontaminate,
    extraction,
    fingerprints,
    infill,
    mixing,
    near_dedup,
    packing,
    pii,
    quality,
    repair,
    toxicity,
    urls,
)
from tidegauge.llm.common import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hex(column: str) -> F.Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


@_query()
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = near_dedup.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", _hex("fingerprint").alias("fingerprint"), "component_id")


_CHAT_ROWS = "conv_id bigint, turn bigint, role string, text string"
_SAME = "</s>[INST] ok [/INST]"


@_query(
    rf"""
    WITH raw AS (
      SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
        coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '{_SAME}'), (-7, 1, 'assistant', '{_SAME}')),
    r AS (
      SELECT *, length(text) + len(regexp_extract_all(text, '</?s>|\[/?INST\]|\[SYS\]|\[/?ROLE\]|\\')) AS body,
        CASE role WHEN 'user' THEN 7 WHEN 'assistant' THEN 8 WHEN 'system' THEN 6
          ELSE 16 + length(role) + len(regexp_extract_all(role, '</?s>|\[/?INST\]|\[SYS\]|\[/?ROLE\]|\\')) END AS mark
      FROM raw)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(3 + mark + body + 4) AS BIGINT) AS formatted_chars
    FROM r GROUP BY conv_id
    """
)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every rendered conversation, each row taken as one message event."""
    said = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    said = said.union(spark.createDataFrame([(-7, 0, "user", _SAME), (-7, 1, "assistant", _SAME)], _CHAT_ROWS))
    # Rows of one turn stay apart: the place in the conversation is the turn.
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    events = said.select(
        "conv_id", place.alias("seq"), place.alias("turn"), F.lit("message").alias("kind"), "role", "text"
    )
    return chat.digest(chat.render(chat.fold_events(events)))


URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


@_query(
    rf"""
    WITH rules (verdict, host, path) AS (VALUES {", ".join(str(tuple(r)) for r in URL_RULES)}),
    p AS (
      SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
    q AS (SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM p)
    SELECT page_id, host, path,
      (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
        WHERE (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)) AS rule,
      coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
        WHERE (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)), 'allow') AS verdict
    FROM q
    """
)
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    judged = urls.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "url_verdict.*")


def _remainder(divisor: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


def training_rows(labels: DataFrame) -> DataFrame:
    """The labels that the quality model may learn from."""
    return labels.filter(_remainder(4) != 2)


def _scored(docs: DataFrame, held_out: F.Column, score: F.Column) -> DataFrame:
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


@_query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, training_rows(labels))
    return _scored(docs, _remainder(4) == 2, quality.quality_score(model, F.col("text")))


@_query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.filter(_remainder(3) != 1))
    return _scored(docs, _remainder(3) == 1, toxicity.toxicity_score(docs, model, F.col("text")))


@_query()
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of plain identifiers, their digest, and all spans of every document."""
    found = _table(spark, sf_dir, "documents").select("doc_id", pii.pii_spans("text").alias("found"))
    plain = F.filter("found", lambda s: ~s["disguised"])

    def count(kind: str) -> F.Column:
        own = F.filter("found", lambda s: ~s["disguised"] & (s["kind"] == kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_list(plain), 256).alias("base_sha256"), pii.span_list(F.col("found")).alias("spans")
    )


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 ids."""
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, with likenesses."""
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


@_query()
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, exactly or nearly, with the item."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "hamming", "first_shingle", "shingles")


@_query()
def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract_text(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


@_query(
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
    c AS (
      SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
            OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
          WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (
      SELECT *, array_to_string(u[1:least(x, y)], '') AS prefix, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
        array_to_string(u[greatest(x, y) + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM p
    """
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts, form and digests of every document's fill-in-the-middle text, and of the text restored from it."""
    made = infill.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    made = made.select("doc_id", "infill.*")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@_query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, repair cost, audit and repaired text's digest of every conversation, damaged by plan."""
    return repair.repair_report(repair.damaged(_table(spark, sf_dir, "conversations")))


@_query(
    r"""
    WITH d AS (
      SELECT doc_id, source, coalesce('=' || source, '') AS key, coalesce(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT), 0) AS size,
        sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h FROM documents),
    w AS (
      SELECT key, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * 2 AS lim,
        [5, 2, 1][(row_number() OVER (ORDER BY min(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY key),
    r AS (
      SELECT *, row_number() OVER o AS place, sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
        CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain
      FROM w WINDOW o AS (ORDER BY lim / weight, key = '', key)),
    f AS (SELECT min(place) AS first FROM r WHERE remain * weight / weights < lim),
    l AS (SELECT remain, weights FROM r, f WHERE place = first),
    t AS (
      SELECT key, source_size, CASE WHEN first IS NULL OR place < first THEN lim
        ELSE (SELECT remain FROM l) * weight / (SELECT weights FROM l) END AS target FROM r, f),
    e AS (
      SELECT key, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 100000000 + 0.5) AS BIGINT) ELSE 0 END AS parts,
        CAST('0x' || substr(sha256('7:' || key), 1, 13) AS BIGINT) % 100000000 AS start FROM t),
    s AS (
      SELECT doc_id, size, source_size, target, parts, start + sum(parts) OVER (
        PARTITION BY d.key ORDER BY size, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM d JOIN e ON d.key = e.key)
    SELECT doc_id, size, source_size, target, CAST(size * (upto // 100000000 - (upto - parts) // 100000000) AS BIGINT) AS taken FROM s
    """
)
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document, size and target of its source, and the words that the mix takes of it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # Texts are read once; sizes and hashes are all that the mix needs.
    rows = stored(mixing.sized(docs).drop("text"), "sizes")
    mixed = mixing.mix_sources(rows)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
