"""A check query per operator, over its whole table, with SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.llm import (
    chat,
    decontaminate,
    divergence,
    language,
    licenses,
    line_dedup,
    packing,
    pairwise_quality,
    quality_rules,
    ranked_search,
    simhash,
    token_files,
    toxicity,
)
from tablejobs.llm.common import fold, read
from tablejobs.storage import shared_folder


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _with_fold(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "score", "predicted"
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = fold(F.col("id"), 5) != 0
    return _with_fold(
        toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), learn)
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(read(spark, sf_dir, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), _vocabulary()).withColumnRenamed("id", "doc_id")


def op6_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = fold(F.col("id"), 5) != 0
    return _with_fold(
        pairwise_quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), learn)
    )


#: Conversation -1: what its turns say are control strings of the template.
CONTROLS = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROLS).alias("text"),
    )
    formatted = chat.format_conversations(turns.unionByName(planted))
    back = formatted.select(
        "conv",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss("formatted", "loss").alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language.identify(docs, fold(F.col("doc_id"), 4) != 2)
    return found.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), 4) == 2).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_texts(read(spark, sf_dir, "documents"))
    return found.drop("row").withColumnRenamed("id", "doc_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").cast("long").alias("doc_id"),
        "n_words",
        decontaminate.hit_words(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    root = shared_folder(spark, "token_files")
    token_files.write_token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), root)
    back = token_files.read_token_files(spark, root, with_ids=False)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


_SPACES = "[ \\t\\n\\x0B\\f\\r]+"

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, coalesce(lag(role) OVER w <> role, true) AS opens, coalesce(lead(role) OVER w <> role, true) AS closes,
    length(regexp_replace(text,
      '(<)(\\*)(<SYS>>|</SYS>>|s>|/s>)|(\[)(\\*)(INST\]|/INST\]|ROLE\]|/ROLE\]|AS\]|TURN\])', '\1\2\\\3\4\5\6', 'g'))
      AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars
    + CASE WHEN NOT opens THEN 6 WHEN role = 'system' THEN 8 WHEN role = 'user' THEN 7 WHEN role = 'assistant' THEN 4 END
    + CASE WHEN NOT closes THEN 0 WHEN role = 'system' THEN 10 WHEN role = 'user' THEN 8 WHEN role = 'assistant' THEN 5 END
  ) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

DECONTAMINATION_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS window_text
  FROM (SELECT item, w, least(10, len(w)) AS size, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
        FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS window_text
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM doc_words, sizes WHERE len(w) >= size)
), hits AS (
  SELECT p.doc_id, p.i, p.size, w.item FROM places p JOIN item_windows w USING (size, window_text)
), hit_places AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_places USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

SEARCH_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), item_terms AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tf AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
whole AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM doc_terms),
normal AS (
  SELECT doc_id, 75 + (25 * count(*) * any_value(n_docs)) // any_value(n_terms) AS m FROM doc_terms, whole GROUP BY doc_id
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM item_terms JOIN tf USING (term) JOIN weights USING (term) JOIN normal USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""

DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source FROM documents
), words AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
shares AS (
  SELECT lang, source, term, n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // CAST(total + 5 * v AS HUGEINT) AS BIGINT) AS p
  FROM cells JOIN totals USING (lang, source) JOIN sizes USING (lang)
), lang_shares AS (
  SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (sum(n) + 5))
    // CAST(sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v) AS HUGEINT) AS BIGINT) AS q
  FROM cells JOIN sizes USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), values AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM values
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

QUERIES = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_quality_rules,
        op3_license_scan,
        op4_simhash,
        op5_packing,
        op6_quality_ranking,
        op7_chat_format,
        op8_language,
        op9_line_dedup,
        op10_decontaminate,
        op11_ranked_search,
        op12_source_divergence,
        op13_token_files,
    )
}
ORACLE_SQL = {
    "op7_chat_format": CHAT_SQL,
    "op10_decontaminate": DECONTAMINATION_SQL,
    "op11_ranked_search": SEARCH_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
}
