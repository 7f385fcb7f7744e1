"""The operators over their whole tables, by name, and SQL for those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    chat,
    decontaminate,
    html,
    language,
    packing,
    quality,
    repair,
    scoring,
    sharding,
    simhash,
    urls,
    vectors,
    whitening,
)
from salesloom.llm.sql import REPAIR, SHARDING


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def op1_simhash(spark: SparkSession, base: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, base, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_quality(spark: SparkSession, base: str) -> DataFrame:
    found, sampler = quality.sample_keys(
        _table(spark, base, "documents"), _table(spark, base, "labels")
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "log_weight",
        "sample_key",
        (F.col("sample_key") >= F.lit(sampler.least)).alias("selected"),
    )


def op3_decontaminate(spark: SparkSession, base: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(
        _table(spark, base, "documents"), _table(spark, base, "benchmark")
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_packing(spark: SparkSession, base: str) -> DataFrame:
    return packing.packed_digests(
        _table(spark, base, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op5_vectors(spark: SparkSession, base: str) -> DataFrame:
    found = vectors.near_vectors(_table(spark, base, "embeddings"))
    return found.select(
        "vec_id",
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("vec_id") == F.col("component")).alias("kept"),
    )


def op6_scoring(spark: SparkSession, base: str) -> DataFrame:
    return scoring.score(_table(spark, base, "documents"))


def op7_html(spark: SparkSession, base: str) -> DataFrame:
    found = html.extract_pages(_table(spark, base, "pages").select("page_id", "url", "html"))
    return found.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op8_language(spark: SparkSession, base: str) -> DataFrame:
    found = language.identify(_table(spark, base, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_chat(spark: SparkSession, base: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user'), (-1L, 1L, 'assistant') AS t(conv_id, turn, role)"
    ).withColumn("text", F.lit(said))
    rows = _table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    done = chat.format_conversations(rows)
    back = done.withColumns(
        {
            "turns": chat.read_turns(F.col("formatted")),
            "loss": chat.read_loss(F.col("formatted"), F.col("loss_spans")),
        }
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


# Host, path and verdict of the rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op10_urls(spark: SparkSession, base: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(_table(spark, base, "pages"), rules)


def op11_repair(spark: SparkSession, base: str) -> DataFrame:
    rows = _table(spark, base, "conversations")
    return repair.summaries(repair.damaged(rows), rows.select("conv_id").distinct())


def op12_sharding(spark: SparkSession, base: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, base, "documents"))


def op13_whitening(spark: SparkSession, base: str) -> DataFrame:
    found = whitening.whiten(_table(spark, base, "embeddings"))
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    found = found.select("vec_id", "n", "deviation", "identity_error", parts)
    return found.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "part.*", "identity_error"
    )


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_vectors": op5_vectors,
    "op6_scoring": op6_scoring,
    "op7_html": op7_html,
    "op8_language": op8_language,
    "op9_chat": op9_chat,
    "op10_urls": op10_urls,
    "op11_repair": op11_repair,
    "op12_sharding": op12_sharding,
    "op13_whitening": op13_whitening,
}

# The words of a text, for DuckDB.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLE = {
    "op3_decontaminate": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        starts AS (
            SELECT item_id, w, least(len(w), 10) AS l, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p
            FROM i WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, l, w[p:p + l - 1] AS gram FROM starts),
        runs AS (
            SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p
            FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l),
        hits AS (
            SELECT DISTINCT r, p, runs.l, item_id FROM runs
            JOIN win ON runs.l = win.l AND runs.w[runs.p:runs.p + runs.l - 1] = win.gram),
        covered AS (
            SELECT r, count(DISTINCT q) AS n
            FROM (SELECT r, unnest(range(p, p + l)) AS q FROM hits) GROUP BY r),
        held AS (
            SELECT r, count(*) AS n,
                sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS digest
            FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
            coalesce(held.n, 0)::BIGINT AS n_items,
            coalesce(digest, sha256('')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN held USING (r)
    """,
    # The template's control strings take 8 + 8 + 7 characters a turn; escaping adds one each.
    "op9_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                AS loss_sha256,
            sum(length(role) + length(text) + 23
                + len(regexp_extract_all(text, '(<|\[)\\*(\||/?s>|/?INST\]|/?SYS>)')))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op11_repair": REPAIR,
    "op12_sharding": SHARDING,
}
