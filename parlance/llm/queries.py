"""Registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from parlance.llm import (
    chat, exact_dedup, exact_topk, language_id, mixing, packing, quality_rules, resampling, sharding, simhash_dedup, spelling, token_counts, toxicity,
)
from parlance.llm.common import LOWER, UPPER, documents, fold, word_count, written


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    sized = written(documents(spark, folder).select("doc_id", "source", word_count(F.col("text")).alias("size")), "words")
    mixed = mixing.mix(sized, F.col("size"))
    return mixed.select(
        F.col("_row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        F.col("_row.source").alias("source"), "rate", "copies")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, folder))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(documents(spark, folder), shingle=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), ids=F.crc32("ids").alias("ids_crc32"), added=packing.ADDED)


def op6_shards(spark: SparkSession, folder: str) -> DataFrame:
    sharded = sharding.shard_by_bytes(documents(spark, folder), shards=8)
    text = F.coalesce(F.col("_row.text"), F.lit("")).cast("binary")
    return sharded.select(
        F.col("_row.doc_id").alias("doc_id"), "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_sentences", "offending")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.conversations(chat.linear_threads(rows)).select("conv", "formatted", "mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, mask in zip(*(c.to_pylist() for c in batch.columns)):
                turns = chat.read_turns(text)
                loss = "".join(chat.unescape(text[m["start"] : m["end"]]) for m in mask)
                rows.append((conv, len(turns), _sha256("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha256(loss), len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, _CHAT_TYPES)], _CHAT_NAMES)

    return formatted.mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def chat_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The two best branches of each conversation, in which every third message replies to the last but one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    above = F.col("turn") - F.when(F.col("turn") % 3 == 2, 2).otherwise(1)
    messages = spark.read.parquet(f"{folder}/conversations.parquet").select(
        F.concat_ws(":", "conv_id", "turn").alias("node"), F.concat_ws(":", "conv_id", above).alias("parent"),
        (F.length(text) % 10).cast("double").alias("score"))
    return chat.best_paths(messages, n_best=2)


_CHAT_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_CHAT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, folder))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold(F.col("doc_id"), 4) == 2
    learned, margin = language_id.learn(docs.where(~held_out), F.col("text"), F.col("lang"), F.col("doc_id"))
    found = language_id.identify(docs, learned, margin=margin).withColumn("doc_id", F.col("_row.doc_id"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return exact_topk.exact_top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    # Runs that are shorter than a word need not leave their text.
    runs = F.regexp_extract_all("text", F.lit(f"[A-Za-z\u00c0-\u00ff]{{{spelling.MIN_CHARS},}}"), F.lit(0))
    found = documents(spark, folder).select("doc_id", F.explode(runs).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return spelling.variants(spelling.vocabulary(found, F.when(h % 199 == 0, shorter).otherwise(F.col("run"))))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_mix_sources, op3_quality_rules, op4_simhash, op5_pack, op6_shards, op7_toxicity, op8_chat, op9_exact_dedup, op10_language,
    op11_resample, op12_exact_topk, op13_spelling)}
QUERIES["chat_reply_trees"] = chat_reply_trees
QUERIES["pipeline"] = corpus_pipeline.run

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# DuckDB has no crc32: a table of 256 remainders, and one step a byte.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS t)"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a short text's UTF-8 bytes; needs the column t of _CRC_TABLE."""
    byte = f"list_transform(range(CAST(length(hex({text})) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce({byte}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295))"


SQL = {
    "op3_quality_rules": f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
        words AS (SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
        grams AS (
            SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
        twins AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
        marks AS (SELECT rid, count(DISTINCT i + k) AS n FROM twins, (VALUES (0), (1), (2)) AS ks(k) GROUP BY rid),
        lines AS (
            SELECT rid, source, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
                regexp_replace(regexp_replace(regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'), '[0-9]+', '0', 'g'),
                    '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '') AS plain
            FROM (SELECT rid, source, unnest(string_split(text, chr(10))) AS line FROM docs)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
        dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
        frequent AS (SELECT source, plain FROM lines GROUP BY ALL HAVING count(DISTINCT rid) > 20),
        removed AS (
            SELECT rid, sum(n) AS n FROM lines JOIN frequent ON lines.source IS NOT DISTINCT FROM frequent.source
            AND lines.plain = frequent.plain GROUP BY rid),
        facts AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(marks.n, 0) AS BIGINT) AS n_repeat_words,
                CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
            FROM docs JOIN words USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN marks USING (rid) LEFT JOIN removed USING (rid)),
        base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM facts)
        SELECT *, NOT base_failed AND n_words - n_removed_words >= 0.3 * n_words AS kept FROM base
    """,
    "op8_chat": """
        WITH rows AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
            CAST(sum(20 + length(regexp_replace(role, '(\\\\|</?s>|\\[/?INST\\])', '\\\\\\1', 'g'))
                + length(regexp_replace(text, '(\\\\|</?s>|\\[/?INST\\])', '\\\\\\1', 'g'))) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "chat_reply_trees": """
        WITH RECURSIVE messages AS (
            SELECT conv_id || ':' || turn AS node, conv_id || ':' || (turn - CASE WHEN turn % 3 = 2 THEN 2 ELSE 1 END) AS parent,
                CAST(length(coalesce(text, '')) % 10 AS DOUBLE) AS score FROM conversations),
        walk AS (
            SELECT node AS leaf, node, parent, CAST(0 AS BIGINT) AS height, score FROM messages WHERE node NOT IN (SELECT parent FROM messages)
            UNION ALL SELECT leaf, m.node, m.parent, height + 1, m.score FROM walk JOIN messages AS m ON m.node = walk.parent),
        branches AS (SELECT leaf, max_by(node, height) AS root, sum(score) / count(*) AS mean FROM walk GROUP BY leaf),
        ranked AS (SELECT leaf, root, CAST(row_number() OVER (PARTITION BY root ORDER BY mean DESC, leaf) AS INTEGER) AS rank FROM branches)
        SELECT root, leaf, rank, node, height FROM walk JOIN ranked USING (leaf) WHERE rank <= 2
    """,
    "op9_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM d WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op11_resample": f"""
        WITH {_CRC_TABLE},
        docs AS (SELECT row_number() OVER () AS rid, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        goal AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
        own AS (SELECT rid, unnest(w) AS word FROM docs),
        words AS (SELECT word, {_crc32('word')} % 10000 AS bucket FROM (SELECT word FROM own UNION SELECT word FROM goal), crc),
        s AS (SELECT bucket, count(*) AS s FROM own JOIN words USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM goal JOIN words USING (word) GROUP BY bucket),
        gains AS (
            SELECT b.bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM own) + 10000) AS DOUBLE)
                / CAST((coalesce(s, 0) + 1) * ((SELECT count(*) FROM goal) + 10000) AS DOUBLE))) AS BIGINT) AS gain
            FROM (SELECT unnest(range(10000)) AS bucket) AS b LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket),
        sums AS (SELECT rid, sum(gain) AS gain FROM own JOIN words USING (word) JOIN gains USING (bucket) GROUP BY rid),
        scored AS (
            SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_features,
                CAST(coalesce(floor(CAST(gain AS DOUBLE) / len(w)), 0) AS BIGINT) AS weight,
                CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
            FROM docs LEFT JOIN sums USING (rid)),
        noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
        ranked AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM noisy WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank FROM noisy LEFT JOIN ranked USING (rid)
    """,
    "op12_exact_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.rid, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.rid <> v.rid WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5
    """,
    "op13_spelling": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run
            FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00c0-\u00ff]+')) AS run FROM documents) WHERE length(run) >= 6),
        counted AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
        hashed AS (SELECT run, k, {_crc32("(doc_id || ':' || run)")} AS h FROM counted, crc),
        vocab AS (
            SELECT word, CAST(sum(k) AS BIGINT) AS n
            FROM (SELECT k, CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word FROM hashed)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
        cut AS (SELECT DISTINCT word, i, word[: i - 1] AS head, word[i + 1 :] AS tail
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
        near AS (
            SELECT a.word, b.word AS other FROM cut AS a JOIN cut AS b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
            UNION SELECT cut.word, vocab.word FROM cut JOIN vocab ON vocab.word = head || tail
            UNION SELECT vocab.word, cut.word FROM cut JOIN vocab ON vocab.word = head || tail),
        best AS (
            SELECT near.word, count(*) AS n_near, min((-b.n, other)) AS best FROM near JOIN vocab AS b ON b.word = other GROUP BY near.word),
        forms AS (
            SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN -best[1] >= 5 * n THEN best[2] END AS form,
                CASE WHEN -best[1] >= 5 * n THEN -best[1] END AS form_n
            FROM vocab LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS at FROM vocab
            UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL),
        ends AS (SELECT chain.word, chain.at AS root FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
