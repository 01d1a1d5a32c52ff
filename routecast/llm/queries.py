"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm import (
    chat, decontamination, html_wrappers, language, lexical_search, near_duplicates, packing, periodic_runs, quality_fm, sharding, store,
    token_counts, token_files, topk,
)

TOKENIZER = "word_bpe_49k.json"
PACK_END, FILE_END, SEQUENCE, SHARDS = 1, 2, 4096, 24
#: Score from which a text counts as good.
QUALITY = 0.3
#: Fixed value: the extra conversation of the chat query.
PROBE = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), PACK_END, SEQUENCE)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    # Each stored row is one whole-message event; rows that share a turn stay messages of their own.
    events = rows.unionByName(probe).select(
        "conv_id", F.monotonically_increasing_id().alias("message_id"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text"
    )
    out = chat.format_conversations(events).withColumn("formatted", chat.formatted_text(F.col("segments")))
    out = out.withColumn("turns", chat.parse_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), SHARDS)


def op4_string_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language.held_out("doc_id").alias("held_out"))
    model = language.fit(docs.where(~F.col("held_out")), spread="doc_id")
    return language.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.fresh_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), FILE_END)
    return token_files.with_crc32(token_files.read_token_files(spark, path))


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    text = html_wrappers.extract_text(pages, html_wrappers.infer_wrappers(pages))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, _table(spark, sf_dir, "benchmark"), k=20)


def op12_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", language.held_out("doc_id").alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~language.held_out("doc_id"))
    model = quality_fm.fit(docs, labels, "quality", metadata=("n_chars",))
    scored = quality_fm.predict(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= QUALITY).cast("int").alias("predicted"))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth text (by its doc_id's CRC) repeats from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\x20\x09-\x0D]+"), ""))
    named = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w")).withColumn("n", F.size("w"))
    placed = named.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.nullif(F.col("n"), F.lit(0))).cast("int")))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    block = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    repeated = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(block), F.lit(1), rest)), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(planted(_table(spark, sf_dir, "documents")))
    # The greatest length / period, compared exactly; runs come by start, then period, and the first of equals stays.
    none = F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)")
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_feistel_sharding": op3_feistel_sharding,
    "op4_string_kernels": op4_string_kernels,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_token_files": op7_token_files,
    "op8_html_wrappers": op8_html_wrappers,
    "op9_decontamination": op9_decontamination,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_block_max_search": op11_block_max_search,
    "op12_quality_fm": op12_quality_fm,
    "op13_synchronised_runs": op13_synchronised_runs,
}

_LOWER = """translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS said FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(role) + length(said) + length(said) - length(replace(replace(said, '\', ''), '<', '')) + 15 AS drawn FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role, said)) AS turns_sha256,
  CAST(coalesce(sum(length(said)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(said, '' ORDER BY turn, role, said) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(drawn) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op6_ngram_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.seen
)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.seen) AS component_id
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
""",
    "op9_decontamination": rf"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS s
  FROM iw WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows
), runs AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS s
  FROM dw, lengths WHERE len(w) >= n
), found AS (SELECT r.doc_id, r.i, r.n, v.item_id FROM runs r JOIN windows v ON r.n = v.n AND r.s = v.s
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op10_exact_top_k": """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS ints
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op11_block_max_search": rf"""
WITH terms AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS t FROM documents
), totals AS (SELECT CAST(count(*) FILTER (WHERE len(t) > 0) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS words FROM terms
), tf AS (SELECT doc_id, term, count(*) AS f, n FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM terms) GROUP BY ALL
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * f) // (1000 * f + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
