"""One query per operator over its whole table, and the pipeline; SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    bpe,
    decontam,
    fuzzy_lines,
    language,
    near_copies,
    personal,
    quality_rules,
    repair,
    reply_trees,
    runs,
    token_files,
    url_rules,
    warc,
)
from larder.llm.common import fresh_path, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn_languages(docs))
    held = F.coalesce(language.is_held_out(), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal.find_personal_data(docs, personal.learn_spans(docs))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in personal.KINDS),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )


@query()
def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", near_copies.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def _escaped_sql(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for mark in reply_trees.CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


@query(
    f"""WITH turns AS (SELECT conv_id, turn, role, text FROM conversations
      UNION ALL SELECT -7, n, who, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, who)),
    whole AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), ''
          ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said,
        coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (role = '{reply_trees.LOSS_ROLE}'), '') AS learned,
        sum(length('{reply_trees.START}{reply_trees.SEP}{reply_trees.END}' || {_escaped_sql("role")} || {_escaped_sql("text")})) AS formatted_chars
      FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
      formatted_chars::BIGINT AS formatted_chars FROM whole"""
)
def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", same), (-7, 1, "assistant", same)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = reply_trees.read_back(reply_trees.format_conversations(rows.union(extra)))
    turns = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda t: F.concat(t["roles"], F.lit("\n"), t["texts"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("texts").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query()
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query()
def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dropped_lines(table(spark, sf_dir, "documents"))


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"))
    return token_files.checksums(token_files.read_token_files(spark, folder))


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


@query(
    """WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    digests AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS least FROM digests)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
      array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1) FOR i IN range(0, 32)], '') AS payload_digest,
      CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> least THEN least END AS refers_to FROM firsts"""
)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_warc(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return warc.read_warc(written, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def repeated_tail(doc_id: int | None, n: int):
    """One document in ten repeats its last words with a period, by the checksum of its id; others stay."""
    import zlib

    import numpy as np

    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("a"), (-r["period"]).alias("q")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("top", F.array_max(order)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.a")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.q")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.q")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) dropped, emptied, cut, repeated or given another role, by their checksum."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    kind = F.col("kind")
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    changed = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return marked.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), F.explode(times).alias("copy")
    ).drop("copy")


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair_conversations(damaged(rows), rows.select("conv_id"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
