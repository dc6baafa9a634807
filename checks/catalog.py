"""Every registered query next to its SQL counterpart.

Arrays leave as text and doubles rounded, so that two engines' rows can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as S
from checks.sqltext import r, with_
from checks.views import Views
from parlance.functions import text as tx
from parlance.operators import (
    batching, cleaning, drift, nextword, pairs, quality, ranking, scorer, sequences, trainlog, trajectory, vocabulary,
)
from parlance.plans import quality_report as reports
from parlance.plans.training_data import prepare_texts
from parlance.session import ensure_checkpoint_dir, freeze
from parlance.sources import conversations as conv
from parlance.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Views(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rnd(column: Column | str, digits: int = 6) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.round(col + F.lit(3.71828e-11), digits)


def joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def round_metrics(df: DataFrame) -> DataFrame:
    return df.withColumn("value", rnd("value"))


SIX = S.COLS
METRIC = lambda name, value, bad, total, threshold: (
    f"SELECT '{name}' AS metric, {r(value)} AS value, ({bad})::BIGINT AS n_bad, ({total})::BIGINT AS n_total, "
    f"{threshold}::DOUBLE AS threshold, coalesce(({value}) >= {threshold}::DOUBLE, FALSE) AS pass"
)

# ---------------------------------------------------------------- sources and sinks


@query("csv_roundtrip", "SELECT doc_id, nullif(text,'') AS text, lang, source, n_chars FROM documents")
def _(v: Views) -> DataFrame:
    ensure_checkpoint_dir(v.spark)
    docs = v.table("documents")
    path = f"{v.spark.sparkContext.getCheckpointDir()}/csv-{uuid.uuid4().hex}"
    files.write_csv(docs, path)
    return files.read_csv(v.spark, path, docs.schema, multi_line=True)


@query("synth_train", with_(["train"], "SELECT * FROM train"))
def _(v):
    return v.train()


@query("synth_prod", with_(["prod"], "SELECT * FROM prod"))
def _(v):
    return v.prod()


@query("inject_missing", with_(["holes"], "SELECT * FROM holes"))
def _(v):
    return conv.inject_missing(v.train(), "id")


@query("inject_duplicates", with_(["copies"], "SELECT * FROM copies"))
def _(v):
    return conv.inject_duplicates(conv.inject_missing(v.train(), "id"), "id")


@query("inject_invalid", with_(["dirty"], "SELECT * FROM dirty"))
def _(v):
    return v.dirty()


# ---------------------------------------------------------------- quality

_DL = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_DL_MISSING = " + ".join(f"({c} IS NULL)::INT" for c in _DL)


@query("completeness", with_(["docs_labeled"], "SELECT * FROM (" + METRIC(
    "completeness", "1 - bad::DOUBLE/total", "bad", "total", "0.95")
    + f" FROM (SELECT sum({_DL_MISSING}) AS bad, count(*)*{len(_DL)} AS total FROM docs_labeled))"))
def _(v):
    return round_metrics(quality.completeness(v.docs_labeled()))


@query("duplicate_rate", METRIC(
    "duplicate_rate", "1 - bad::DOUBLE/total", "bad", "total", "0.98")
    + """ FROM (SELECT sum(n-1) AS bad, sum(n) AS total
      FROM (SELECT count(*) AS n FROM documents GROUP BY lang, source, text))""")
def _(v):
    return round_metrics(quality.duplicate_rate(v.texts()))


_VALID = f"(SELECT count(*) FILTER ({S.OK}) AS good, count(\"timestamp\") AS total FROM dirty)"


@query("format_validity", with_(["dirty"], METRIC(
    "format_validity", "good::DOUBLE/total", "total-good", "total", "0.99") + f" FROM {_VALID}"))
def _(v):
    return round_metrics(quality.format_validity(v.dirty()))


def _scorecard(relation: str, columns: list[str], timestamp: str | None) -> str:
    names = ", ".join(f'"{c}"' for c in columns)
    missing = " + ".join(f'("{c}" IS NULL)::INT' for c in columns)
    validity = (
        METRIC("format_validity", "good::DOUBLE/total", "total-good", "total", "0.99") + f" FROM {_VALID}"
        if timestamp else METRIC("format_validity", "1.0::DOUBLE", "0", "0", "0.99")
    )
    return (
        METRIC("completeness", "1 - bad::DOUBLE/total", "bad", "total", "0.95")
        + f" FROM (SELECT sum({missing}) AS bad, count(*)*{len(columns)} AS total FROM {relation}) UNION ALL "
        + METRIC("duplicate_rate", "1 - bad::DOUBLE/total", "bad", "total", "0.98")
        + f" FROM (SELECT sum(n-1) AS bad, sum(n) AS total FROM (SELECT count(*) AS n FROM {relation} GROUP BY {names}))"
        + " UNION ALL " + validity
    )


# A table without a timestamp column: the guard answers beside the other two metrics.
@query("format_validity_nocol", _scorecard("documents", ["lang", "source", "text"], None))
def _(v):
    return round_metrics(quality.dq_scorecard(v.texts()))


DQ_DOCS_SQL = with_(["docs_labeled"], _scorecard("docs_labeled", _DL, None))


@query("dq_scorecard", DQ_DOCS_SQL)
def _(v):
    return round_metrics(quality.dq_scorecard(v.docs_labeled()))


@query("dq_scorecard_conversations", with_(["dirty"], _scorecard("dirty", conv.COLUMNS, "timestamp")))
def _(v):
    return round_metrics(quality.dq_scorecard(v.dirty()))


# ---------------------------------------------------------------- drift

_F3 = {"product_category": "product_category", "sentiment": "sentiment", "quarter": S.quarter('"timestamp"')}
_FM = {"product_category": "product_category", "sentiment": "sentiment", "outcome": "outcome"}
_KL_DIRTY = lambda features: S.kl(S.unpivoted("dirty", features), S.unpivoted("prod", features))


def _with_kl(ctes: list[str], chain: str, body: str) -> str:
    head = with_(ctes, "")
    return (head.rstrip() + ",\n" if head.strip() else "WITH ") + chain + "\n" + body


@query("value_distribution", with_(["dirty"], f"""SELECT feature, value, count(*) AS n,
    {r('count(*)::DOUBLE/sum(count(*)) OVER (PARTITION BY feature)', 8)} AS share
    FROM ({S.unpivoted('dirty', _FM)}) GROUP BY feature, value"""))
def _(v):
    return drift.value_distribution(v.dirty(), list(_FM)).withColumn("share", rnd("share", 8))


@query("dist_align", _with_kl(["dirty", "prod"], _KL_DIRTY(_F3),
                              f"SELECT feature, value, {r('p', 8)} AS p, {r('q', 8)} AS q FROM dist"))
def _(v):
    raw = v.dirty()
    aligned = drift.aligned_distribution(v.prod(), raw, drift.conversation_features(raw))
    return aligned.withColumns({"p": rnd("p", 8), "q": rnd("q", 8)})


@query("quarter_buckets", with_(["dirty"], f"""SELECT {S.quarter('"timestamp"')} AS quarter, count(*) AS n
    FROM dirty GROUP BY 1"""))
def _(v):
    return v.dirty().groupBy(drift.quarter_label(F.col("timestamp")).alias("quarter")).agg(F.count(F.lit(1)).alias("n"))


@query("kl_categorical", _with_kl(["train", "prod"], S.kl(
    S.unpivoted("train", {"product_category": "product_category"}),
    S.unpivoted("prod", {"product_category": "product_category"})), f"SELECT feature, {r('kl')} AS kl FROM klrows"))
def _(v):
    return drift.kl_divergence(v.prod(), v.train(), ["product_category"]).withColumn("kl", rnd("kl"))


@query("kl_multi_feature", _with_kl(["dirty", "prod"], _KL_DIRTY(_FM), f"SELECT feature, {r('kl')} AS kl FROM klrows"))
def _(v):
    return drift.kl_divergence(v.prod(), v.dirty(), list(_FM)).withColumn("kl", rnd("kl"))


_Q = lambda c: {"quarter": f"year({c})||'-Q'||quarter({c})"}


@query("kl_temporal", _with_kl([], S.kl(S.unpivoted("lineitem", _Q("l_shipdate")), S.unpivoted("orders", _Q("o_orderdate"))),
                               f"SELECT feature, {r('kl')} AS kl FROM klrows"))
def _(v):
    ship = {"quarter": drift.quarter_label(F.col("l_shipdate"), "drop", typed=True)}
    order = {"quarter": drift.quarter_label(F.col("o_orderdate"), "drop", typed=True)}
    return drift.kl_divergence(
        v.table("orders"), v.table("lineitem"), ship, production_features=order
    ).withColumn("kl", rnd("kl"))


_DDQ = f"""SELECT CASE feature WHEN 'product_category' THEN 'category_balance' WHEN 'sentiment' THEN 'sentiment_distribution'
    ELSE 'temporal_consistency' END AS metric, {r('kl')} AS value, 0.1::DOUBLE AS threshold, kl < 0.1::DOUBLE AS pass FROM klrows"""


@query("ddq_scorecard", _with_kl(["dirty", "prod"], _KL_DIRTY(_F3), _DDQ))
def _(v):
    return round_metrics(drift.ddq_scorecard(v.dirty(), v.prod()))


# ---------------------------------------------------------------- cleaning and the report


@query("remove_duplicates", "SELECT DISTINCT lang, source, text FROM documents")
def _(v):
    return cleaning.remove_duplicates(v.texts())


@query("dedup_first", """SELECT doc_id, lang, source, text FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def _(v):
    return cleaning.first_per_key(v.table("documents").select("doc_id", "lang", "source", "text"), ["text"], ["doc_id"])


@query("fix_invalid_timestamps", with_(["dirty"], f"SELECT * FROM dirty WHERE {S.OK}"))
def _(v):
    return cleaning.fix_invalid_timestamps(v.dirty())


@query("drop_missing", with_(["docs_labeled"], f"SELECT * FROM docs_labeled WHERE {_DL_MISSING} = 0"))
def _(v):
    return cleaning.handle_missing(v.docs_labeled(), "drop")


_MODE = lambda c: f"""coalesce("{c}", (SELECT "{c}" FROM dirty WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS "{c}\""""


@query("impute_missing", with_(["dirty"], f"SELECT {', '.join(_MODE(c) for c in conv.COLUMNS)} FROM dirty"))
def _(v):
    return cleaning.handle_missing(v.dirty(), "impute")


@query("impute_numeric", with_(["docs_labeled"], """SELECT doc_id, n_chars,
    coalesce(quality::DOUBLE, (SELECT median(quality) FROM labels)) AS quality,
    coalesce(toxic::DOUBLE, (SELECT median(toxic) FROM labels)) AS toxic FROM docs_labeled"""))
def _(v):
    return cleaning.impute_missing(v.docs_labeled().select("doc_id", "n_chars", "quality", "toxic"))


@query("exact_median", f"""SELECT {r('median(o_totalprice)')} AS median FROM orders""")
def _(v):
    return ranking.median_of(v.table("orders"), "o_totalprice").select(rnd("median").alias("median"))


@query("non_null_texts", with_(["dirty"], "SELECT conversation_text FROM dirty WHERE conversation_text IS NOT NULL"))
def _(v):
    return cleaning.non_null(v.dirty(), "conversation_text")


_LOG = """SELECT 1 AS step, 'remove_duplicates' AS operation, sum(n-1)::BIGINT AS removed FROM profile UNION ALL
    SELECT 2, 'fix_invalid_timestamps', count(*) FILTER (NOT ok) FROM profile UNION ALL
    SELECT 3, 'handle_missing_drop', count(*) FILTER (ok AND missing > 0) FROM profile"""


@query("cleaning_log", with_(["profile"], _LOG))
def _(v):
    return cleaning.cleaning_log(v.dirty())


@query("cleaned_table", with_(["profile"], f"SELECT {SIX} FROM profile WHERE ok AND missing = 0"))
def _(v):
    return cleaning.clean(v.dirty())


_TAGGED = lambda section, dataset, inner: (
    f"SELECT '{section}' AS section, '{dataset}' AS dataset, metric, value, n_bad, n_total, threshold, pass FROM ({inner})"
)
_CLEANED = _scorecard("cleanrows", conv.COLUMNS, "timestamp").replace("FROM dirty", "FROM cleanrows")


@query("quality_metrics", _with_kl(["dirty", "profile", "prod"],
       f"cleanrows AS (SELECT {SIX} FROM profile WHERE ok AND missing = 0),\n" + _KL_DIRTY(_F3),
       _TAGGED("dq_raw", "raw", _scorecard("dirty", conv.COLUMNS, "timestamp")) + " UNION ALL "
       + _TAGGED("dq", "cleaned", _CLEANED)
       + f" UNION ALL SELECT 'ddq', 'raw', metric, value, NULL::BIGINT, NULL::BIGINT, threshold, pass FROM ({_DDQ})"))
def _(v):
    return round_metrics(reports.quality_metrics(v.dirty(), v.prod()))


@query("quality_report", _with_kl(["dirty", "profile", "prod"],
       f"cleanrows AS (SELECT {SIX} FROM profile WHERE ok AND missing = 0),\n" + _KL_DIRTY(_F3) + f""",
       verdicts AS (SELECT (SELECT bool_and(pass) FROM ({_CLEANED})) AS dq, (SELECT bool_and(pass) FROM ({_DDQ})) AS ddq)""",
       """SELECT CASE WHEN dq THEN 'PASS' ELSE 'FAIL' END AS dq_status, CASE WHEN ddq THEN 'PASS' ELSE 'FAIL' END AS ddq_status,
         CASE WHEN dq AND ddq THEN 'PASS' ELSE 'FAIL' END AS overall_status,
         (SELECT sum(n-1)::BIGINT FROM profile) AS removed_duplicates,
         (SELECT count(*) FILTER (NOT ok) FROM profile) AS removed_invalid,
         (SELECT count(*) FILTER (ok AND missing > 0) FROM profile) AS removed_incomplete FROM verdicts"""))
def _(v):
    return reports.report_summary(v.dirty(), v.prod())


@query("status_rollup", _with_kl(["dirty", "profile", "prod"],
       f"cleanrows AS (SELECT {SIX} FROM profile WHERE ok AND missing = 0),\n" + _KL_DIRTY(_F3), f"""SELECT section, CASE WHEN bool_and(pass) THEN 'PASS' ELSE 'FAIL' END AS status
       FROM (SELECT 'dq_raw' AS section, pass FROM ({_scorecard("dirty", conv.COLUMNS, "timestamp")})
             UNION ALL SELECT 'dq', pass FROM ({_CLEANED})
             UNION ALL SELECT 'ddq', pass FROM ({_DDQ})) GROUP BY section"""))
def _(v):
    return reports.roll_up(reports.quality_metrics(v.dirty(), v.prod()), "section")


# ---------------------------------------------------------------- vocabulary, splits, batches


def _vocab(v: Views) -> DataFrame:
    return vocabulary.build_vocab(v.documents(), "text")


def _encoded(v: Views, **options) -> DataFrame:
    return vocabulary.encode(v.documents(), "doc_id", "text", _vocab(v), **options)


@query("word_counts", with_(["docwords"], 'SELECT token, count(*) AS "count" FROM (SELECT unnest(ws) AS token FROM docwords) GROUP BY token'))
def _(v):
    return vocabulary.word_counts(v.documents(), "text")


@query("build_vocab", with_(["vocab"], "SELECT * FROM vocab"))
def _(v):
    return _vocab(v)


@query("vocab_with_sep", with_(["vocabsep"], "SELECT * FROM vocabsep"))
def _(v):
    return vocabulary.with_separator(_vocab(v))


_SEQ = lambda c: f"array_to_string({c}, ' ') AS {c}"


@query("encode", with_(["enc"], f"SELECT doc_id, {_SEQ('ids')} FROM enc"))
def _(v):
    return _encoded(v).select("doc_id", joined("ids"))


@query("encode_keep_eos", with_(["enckeep"], f"SELECT doc_id, {_SEQ('ids')} FROM enckeep"))
def _(v):
    return _encoded(v, keep_eos=True).select("doc_id", joined("ids"))


@query("encode_whole_texts", with_(["docids"], "SELECT key AS doc_id, array_to_string([2]||ids||[3], ' ') AS ids FROM docids"))
def _(v):
    return _encoded(v, max_length=None).select("doc_id", joined("ids"))


@query("decode", with_(["enc", "vocab"], """SELECT doc_id, coalesce(string_agg(coalesce(token,'<UNK>'), ' ' ORDER BY pos), '') AS text
    FROM (SELECT doc_id, unnest(ids) AS id, unnest(range(1, len(ids)+1)) AS pos FROM enc) e LEFT JOIN vocab USING (id)
    WHERE id NOT IN (0,2,3) GROUP BY doc_id
    UNION ALL SELECT doc_id, '' FROM enc WHERE len(list_filter(ids, lambda i: i NOT IN (0,2,3))) = 0"""))
def _(v):
    vocab = freeze(_vocab(v))
    encoded = vocabulary.encode(v.documents(), "doc_id", "text", vocab)
    return vocabulary.decode(encoded, "doc_id", "ids", vocab)


@query("next_token_pairs", with_(["ntp"], f"SELECT doc_id, {_SEQ('input_ids')}, {_SEQ('target_ids')} FROM ntp"))
def _(v):
    return batching.next_token_pairs(_encoded(v)).select("doc_id", joined("input_ids"), joined("target_ids"))


@query("pad_batches", with_(["padded"], f"SELECT doc_id, batch_id, {_SEQ('input_ids')}, {_SEQ('target_ids')} FROM padded"))
def _(v):
    padded = batching.pad_language_batches(
        batching.next_token_pairs(_encoded(v)), "doc_id",
        keys=v.table("documents").where(F.col("text").isNotNull()).select("doc_id"),
    )
    return padded.select("doc_id", "batch_id", joined("input_ids"), joined("target_ids"))


@query("pad_batches_in_order", with_(["ntp"], f"""SELECT doc_id, batch_id, array_to_string(list_resize(input_ids, m, 0), ' ') AS input_ids
    FROM (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS m
          FROM (SELECT *, (row_number() OVER (ORDER BY doc_id)-1)//32 AS batch_id FROM ntp))"""))
def _(v):
    examples = batching.next_token_pairs(_encoded(v)).drop("target_ids")
    padded = batching.pad_batches(examples, "doc_id", {"input_ids": 0}, order=[("doc_id", True)])
    return padded.select("doc_id", "batch_id", joined("input_ids"))


@query("split_exact", with_(["splitdocs"], "SELECT doc_id, split FROM splitdocs"))
def _(v):
    return ranking.hash_split(v.table("documents").select("doc_id"), "doc_id")


@query("split_threshold", f"""SELECT doc_id, CASE WHEN {S.u("'42:split:'||doc_id")} < 0.8::DOUBLE THEN 'train' ELSE 'val' END AS split FROM documents""")
def _(v):
    return v.table("documents").select("doc_id", ranking.threshold_split(F.col("doc_id")).alias("split"))


@query("split_ordered", with_(["sft"], """SELECT id, quality_score, CASE WHEN row_number() OVER (ORDER BY quality_score DESC, id)
    <= floor((SELECT count(*) FROM sft)*0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM sft"""))
def _(v):
    scored = v.sft().select("id", "quality_score")
    return ranking.ordered_split(scored, [("quality_score", False), ("id", True)])


@query("hash_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:'||o_orderkey), o_orderkey)-1 AS rank FROM orders")
def _(v):
    return ranking.hash_rank(v.table("orders").select("o_orderkey"), "o_orderkey")


@query("turn_numbers", """SELECT event_id, user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1)::INT AS turn FROM events""")
def _(v):
    numbered = ranking.number_turns(v.table("events").select("event_id", "user_id"), "user_id", ["event_id"])
    return numbered.withColumn("turn", F.col("turn").cast("int"))


@query("pretrain_prep", with_(["trainids", "splitdocs"], """SELECT doc_id, split, array_to_string(list_slice(ids,1,len(ids)-1),' ') AS input_ids,
    array_to_string(list_slice(ids,2,len(ids)),' ') AS target_ids
    FROM (SELECT key AS doc_id, list_slice([2]||ids||[3], 1, 256) AS ids FROM trainids) JOIN splitdocs USING (doc_id)"""))
def _(v):
    examples = prepare_texts(v.documents(), "doc_id", "text").examples
    return examples.select("doc_id", "split", joined("input_ids"), joined("target_ids"))


# ---------------------------------------------------------------- pairs and preferences


@query("sft_pairs", with_(["sft"], f"SELECT id, context, response, {r('quality_score', 5)} AS quality_score FROM sft"))
def _(v):
    return v.sft().withColumn("quality_score", rnd("quality_score", 5))


@query("top_n_label", with_(["sft"], "SELECT id, quality_score, row_number() OVER (ORDER BY quality_score DESC, id) <= 500 AS is_good FROM sft"))
def _(v):
    return pairs.top_n_label(v.sft().select("id", "quality_score"), "id")


@query("label_averages", with_(["sft"], f"""SELECT label, n, {r('avg_score')} AS avg_score FROM (
    SELECT CASE WHEN g THEN 'good' ELSE 'other' END AS label, count(*) AS n, avg(quality_score) AS avg_score FROM
      (SELECT quality_score, row_number() OVER (ORDER BY quality_score DESC, id) <= 500 AS g FROM sft) GROUP BY g
    UNION ALL SELECT 'all', count(*), avg(quality_score) FROM sft)"""))
def _(v):
    labelled = pairs.top_n_label(v.sft(), "id")
    return pairs.label_averages(labelled).withColumn("avg_score", rnd("avg_score"))


@query("score_bands", with_(["sft"], """SELECT CASE WHEN quality_score >= 4 THEN 'good' WHEN quality_score < 3.5 THEN 'bad' END AS band,
    count(*) AS n FROM sft GROUP BY 1"""))
def _(v):
    return v.sft().groupBy(pairs.score_band(F.col("quality_score")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("contexts_both", with_(["sft"], """SELECT context FROM sft GROUP BY context
    HAVING bool_or(quality_score >= 4) AND bool_or(quality_score < 3.5)"""))
def _(v):
    return pairs.contexts_with_both(v.sft())


@query("contexts_first_n", with_(["sft"], "SELECT context, min(id) AS first_at FROM sft GROUP BY context ORDER BY 2, 1 LIMIT 100"))
def _(v):
    return pairs.first_contexts(v.sft(), "id", n=100)


def _preference_sql(relation: str, key: str, good: str, bad: str, score: str) -> str:
    side = lambda name, test: f"""{name} AS (SELECT context, response, {score} AS score FROM {relation} WHERE {test}
      QUALIFY row_number() OVER (PARTITION BY context ORDER BY md5('42:pick:'||{key}), {key}) = 1)"""
    return f"{side('good', good)},\n{side('bad', bad)}"


_PAIRS = """SELECT context, g.response AS good_response, b.response AS bad_response, g.score::DOUBLE AS good_score,
    b.score::DOUBLE AS bad_score FROM good g JOIN bad b USING (context)"""
_SFT_PREF = _preference_sql("sft", "id", "quality_score >= 4", "quality_score < 3.5", "quality_score")


@query("preference_pairs", _with_kl(["sft"], _SFT_PREF, _PAIRS))
def _(v):
    return pairs.preference_pairs(v.sft(), "id")


@query("preference_pairs_first_n", _with_kl(["sft"], _SFT_PREF, _PAIRS + """ WHERE context IN
    (SELECT context FROM (SELECT context, min(id) AS f FROM sft GROUP BY context ORDER BY f, context LIMIT 100))"""))
def _(v):
    return pairs.preference_pairs(v.sft(), "id", n_contexts=100)


@query("preference_pairs_documents", _with_kl(["docpref"], _preference_sql("docpref", "doc_id", "quality=1", "quality=0", "quality"), _PAIRS))
def _(v):
    band = F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("bad"))
    return pairs.preference_pairs(v.doc_preferences(), "doc_id", score="quality", band=band)


@query("preference_examples", _with_kl(["sft"], _SFT_PREF, f"""SELECT unnest([context||' '||good_response, context||' '||bad_response]) AS text,
    unnest([1.0::DOUBLE, 0.0::DOUBLE]) AS label FROM ({_PAIRS})"""))
def _(v):
    return pairs.preference_examples(pairs.preference_pairs(v.sft(), "id"))


def _sft_sequences(v: Views, **options) -> DataFrame:
    return pairs.sft_sequences(
        v.turns(), "pair_id", "context", "response", vocabulary.with_separator(freeze(_vocab(v))), **options
    )


@query("sft_sequences", with_(["sftseq"], f"SELECT pair_id, {_SEQ('input_ids')}, {_SEQ('target_ids')} FROM sftseq"))
def _(v):
    return _sft_sequences(v).select("pair_id", joined("input_ids"), joined("target_ids"))


@query("sft_sequences_shifted", with_(["sftseq"], """SELECT pair_id, array_to_string(list_slice(input_ids,1,len(input_ids)-1),' ') AS input_ids,
    array_to_string(list_slice(target_ids,2,len(target_ids)),' ') AS target_ids FROM sftseq"""))
def _(v):
    return _sft_sequences(v, shift=True).select("pair_id", joined("input_ids"), joined("target_ids"))


@query("pad_batches_sft", with_(["sftseq"], """SELECT pair_id, batch_id, array_to_string(list_resize(input_ids, m, 0),' ') AS input_ids,
    array_to_string(list_resize(target_ids, m, -100),' ') AS target_ids
    FROM (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS m
          FROM (SELECT *, (row_number() OVER (ORDER BY md5('42:'||pair_id), pair_id)-1)//16 AS batch_id FROM sftseq))"""))
def _(v):
    padded = batching.pad_response_batches(_sft_sequences(v), "pair_id")
    return padded.select("pair_id", "batch_id", joined("input_ids"), joined("target_ids"))


@query("extract_response", with_(["sft"], r"""SELECT id, regexp_replace(replace(lower(context)||'  '||response||' ', lower(context), ''),
    '^\s+|\s+$', '', 'g') AS response FROM sft"""))
def _(v):
    generated = F.concat(F.lower("context"), F.lit("  "), F.col("response"), F.lit(" "))
    return v.sft().select("id", tx.extract_response(generated, F.col("context")).alias("response"))


@query("text_preview", "SELECT doc_id, substr(text,1,100)||'...' AS preview FROM documents")
def _(v):
    return v.table("documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


# ---------------------------------------------------------------- logged interactions


@query("satisfaction_delta", with_(["steps"], f"SELECT event_id, {S.DELTA} AS delta FROM steps"))
def _(v):
    return v.steps().select("event_id", trajectory.satisfaction_delta().alias("delta"))


@query("purchase_probability", with_(["steps"], f"SELECT event_id, {r(f'satisfaction_after*{S.SELL}')} AS probability FROM steps"))
def _(v):
    return v.steps().select(
        "event_id", rnd(trajectory.purchase_probability(F.col("satisfaction_after"))).alias("probability")
    )


_NAMES = S.lst(trajectory.ACTION_NAMES)


@query("step_rewards", with_(["steps"], f"""SELECT event_id, turn, ({_NAMES})[action+1] AS action_name, {r('satisfaction')} AS satisfaction,
    {r('satisfaction_after')} AS satisfaction_after, {r('reward')} AS reward FROM steps"""))
def _(v):
    return v.steps().select(
        "event_id", "turn", trajectory.action_name(F.col("action")).alias("action_name"),
        rnd("satisfaction").alias("satisfaction"), rnd("satisfaction_after").alias("satisfaction_after"),
        rnd("reward").alias("reward"),
    )


@query("terminal_steps", with_(["steps"], "SELECT event_id, ends FROM steps"))
def _(v):
    return v.steps().select("event_id", v.terminal().alias("ends"))


@query("discounted_returns", with_(["returns"], f"SELECT event_id, {r('discounted_return')} AS discounted_return FROM returns"))
def _(v):
    returns = sequences.discounted_returns(v.steps(), "episode", "turn", "reward", max_turns=10)
    return returns.select("event_id", rnd("discounted_return").alias("discounted_return"))


@query("discounted_returns_long", f"""SELECT event_id, {r('g')} AS discounted_return FROM (SELECT event_id,
    sum(pow(0.99::DOUBLE, turn)*reward) OVER (PARTITION BY user_id ORDER BY turn
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)/pow(0.99::DOUBLE, turn) AS g
    FROM (SELECT event_id, user_id, value/100::DOUBLE AS reward,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1 AS turn FROM events))""")
def _(v):
    rewards = v.table("events").select("event_id", "user_id", (F.col("value") / 100.0).alias("reward"))
    numbered = ranking.number_turns(rewards, "user_id", ["event_id"])
    returns = sequences.discounted_returns(numbered, "user_id", "turn", "reward")
    return returns.select("event_id", rnd("discounted_return").alias("discounted_return"))


@query("satisfaction_gain", """SELECT event_id, round(value - coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 0) + 3.71828e-11::DOUBLE, 6) AS gain
    FROM events""")
def _(v):
    numbered = ranking.number_turns(v.table("events").select("event_id", "user_id", "value"), "user_id", ["event_id"])
    gains = sequences.previous_value(numbered, "user_id", "turn", "value", 0.0, "before", chunk=16)
    return gains.select("event_id", rnd(F.col("value") - F.col("before")).alias("gain"))


@query("state_features", with_(["featured"], "SELECT event_id, unnest(range(0,10))::INT AS i, round(unnest(features) + 3.71828e-11::DOUBLE, 6) AS x FROM featured"))
def _(v):
    return v.steps().select("event_id", F.posexplode(trajectory.state_features()).alias("i", "x")).withColumn("x", rnd("x"))


def _training_set(v: Views) -> DataFrame:
    return trajectory.value_training_set(v.steps(), max_turns=10)


@query("value_training_set", with_(["featured"], f"""SELECT event_id, {r('discounted_return')} AS discounted_return,
    {r('list_sum(list_transform(features, lambda x, i: x*i))')} AS weighted FROM featured"""))
def _(v):
    weighted = F.aggregate(
        F.transform("features", lambda x, i: x * (i + 1)), F.lit(0.0), lambda total, x: total + x
    )
    return _training_set(v).select(
        "event_id", rnd("discounted_return").alias("discounted_return"), rnd(weighted).alias("weighted")
    )


@query("gram_matrix", with_(["featured"], f"""SELECT i::INT AS i, j::INT AS j, {r('sum(x*y)', 4)} AS value FROM (
    SELECT i, j, features[i+1] AS x, CASE WHEN j=10 THEN discounted_return ELSE features[j+1] END AS y
    FROM featured, range(0,10) AS a(i), range(0,11) AS b(j) WHERE i <= j) GROUP BY i, j"""))
def _(v):
    return trajectory.gram_matrix(_training_set(v)).withColumn("value", rnd("value", 4))


_NAMED = ", ".join(f"'{name}'" for name in trajectory.FEATURES)


@query("value_theta", _with_kl(["featured"], """cells AS (
      SELECT i, j, sum(features[i+1] * CASE WHEN j=10 THEN discounted_return ELSE features[j+1] END) AS s
      FROM featured, range(0,10) AS a(i), range(0,11) AS b(j) GROUP BY i, j),
    start AS (SELECT list(line ORDER BY i) AS a FROM (SELECT i, list(s ORDER BY j) AS line FROM cells GROUP BY i)),
    steps_done(k, a) AS (SELECT 0, a FROM start UNION ALL
      SELECT k+1, list_transform(a, lambda line, i: CASE WHEN i = k+1 THEN list_transform(line, lambda x: x / line[k+1])
        ELSE list_transform(line, lambda x, j: x - line[k+1] * a[k+1][j] / a[k+1][k+1]) END) FROM steps_done WHERE k < 10)
    """, f"SELECT ([{_NAMED}])[i] AS feature, {r('a[i][11]')} AS weight FROM steps_done, range(1,11) AS n(i) WHERE k = 10")
       .replace("WITH", "WITH RECURSIVE", 1))
def _(v):
    return trajectory.fit_value_weights(_training_set(v)).withColumn("weight", rnd("weight"))


THETA = [(i + 1) / 8 if i % 2 else -(i + 1) / 16 for i in range(10)]  # any weights do
_DOT = " + ".join(f"features[{i + 1}]*({w}::DOUBLE)" for i, w in enumerate(THETA))


@query("value_scores", with_(["featured"], f"SELECT event_id, {r(_DOT)} AS value FROM featured"))
def _(v):
    scored = v.steps().withColumn("features", trajectory.state_features())
    return scored.select("event_id", rnd(trajectory.value_score(THETA)).alias("value"))


@query("fit_quality", with_(["featured"], f"""SELECT count(*) AS n, {r('avg(e*e)')} AS mse, {r('1 - avg(e*e)/var_pop(y)')} AS r2
    FROM (SELECT discounted_return AS y, {_DOT} - discounted_return AS e FROM featured)"""))
def _(v):
    fit = trajectory.fit_quality(_training_set(v), trajectory.value_score(THETA))
    return fit.withColumns({"mse": rnd("mse"), "r2": rnd("r2")})


@query("policy_metrics", with_(["episodes"], f"""SELECT product_category, count(*) AS episodes, {r('avg(reward)')} AS avg_reward, {r('stddev_pop(reward)')} AS std_reward,
    {r('sum(p)/count(*)::DOUBLE')} AS purchase_rate, {r('sum(e)/count(*)::DOUBLE')} AS escalation_rate, {r('avg(turns)')} AS avg_turns
    FROM (SELECT product_category, episode, sum(reward) AS reward, sum(purchased::INT) AS p, sum(escalated::INT) AS e, count(*) AS turns
          FROM episodes GROUP BY product_category, episode) GROUP BY product_category"""))
def _(v):
    metrics = trajectory.policy_metrics(v.episodes(), ["product_category"])
    doubles = ["avg_reward", "std_reward", "purchase_rate", "escalation_rate", "avg_turns"]
    return metrics.withColumns({c: rnd(c) for c in doubles})


@query("policy_eval_first_turn", with_(["steps"], f"""SELECT product_category, count(*) AS episodes, {r('avg(reward)')} AS avg_reward,
    {r('avg(purchased::INT)')} AS purchase_rate, {r('avg(escalated::INT)')} AS escalation_rate
    FROM steps WHERE turn = 0 GROUP BY product_category"""))
def _(v):
    metrics = trajectory.first_step_evaluation(v.steps(), ["product_category"])
    return metrics.withColumns({c: rnd(c) for c in ["avg_reward", "purchase_rate", "escalation_rate"]})


@query("policy_context", with_(["steps"], "SELECT event_id, 'Category: '||product_category||', Satisfaction: '||printf('%.2f', satisfaction) AS context FROM steps"))
def _(v):
    return v.steps().select(
        "event_id", tx.state_context(F.col("product_category"), F.col("satisfaction")).alias("context")
    )


@query("combined_reward", with_(["steps"], f"SELECT event_id, {r('reward + 0.5::DOUBLE*satisfaction')} AS total FROM steps"))
def _(v):
    return v.steps().select(
        "event_id", rnd(trajectory.combined_reward(F.col("reward"), F.col("satisfaction"))).alias("total")
    )


@query("advantages", with_(["ppo"], f"SELECT event_id, {r('advantage')} AS advantage FROM ppo"))
def _(v):
    return v.ppo_steps().select("event_id", rnd("advantage").alias("advantage"))


# ---------------------------------------------------------------- training logs


@query("loss_perplexity", with_(["trainlog"], f"""SELECT epoch, split, count(*) AS batches, {r('avg(loss)')} AS loss, {r('exp(avg(loss))')} AS perplexity,
    exp(avg(loss)) < 50 AS target_met FROM (SELECT *, CASE WHEN event_id%5=0 THEN 'val' ELSE 'train' END AS split FROM trainlog) GROUP BY epoch, split"""))
def _(v):
    log = v.train_log().withColumn("split", F.when(F.col("event_id") % 5 == 0, F.lit("val")).otherwise(F.lit("train")))
    summary = trainlog.loss_perplexity(log, ["epoch", "split"])
    return summary.withColumns({"loss": rnd("loss"), "perplexity": rnd("perplexity")})


@query("masked_token_loss", with_(["padded"], f"""SELECT batch_id, count(*) FILTER (target <> 0) AS tokens, {r('avg(nll) FILTER (target <> 0)')} AS loss
    FROM (SELECT batch_id, target, -ln({S.u("'nll:'||doc_id||':'||pos")}*0.9::DOUBLE+0.05::DOUBLE) AS nll
      FROM (SELECT doc_id, batch_id, unnest(target_ids) AS target, unnest(range(0, len(target_ids))) AS pos FROM padded)) GROUP BY batch_id"""))
def _(v):
    from parlance.functions.hashing import uniform

    padded = batching.pad_language_batches(
        batching.next_token_pairs(_encoded(v)), "doc_id",
        keys=v.table("documents").where(F.col("text").isNotNull()).select("doc_id"),
    )
    tokens = padded.select("doc_id", "batch_id", F.posexplode("target_ids").alias("pos", "target"))
    nll = -F.ln(uniform("nll", F.col("doc_id"), F.col("pos")) * 0.9 + 0.05)
    return trainlog.masked_token_loss(tokens.withColumn("nll", nll), ["batch_id"]).withColumn("loss", rnd("loss"))


@query("trailing_loss", with_(["trainlog"], f"""SELECT epoch, batch::INT AS batch, {r('m')} AS avg_loss FROM (SELECT epoch, batch, avg(loss) OVER
    (PARTITION BY epoch ORDER BY batch ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS m FROM trainlog) WHERE batch % 20 = 0"""))
def _(v):
    return trainlog.trailing_loss(v.train_log()).withColumn("avg_loss", rnd("avg_loss"))


@query("best_checkpoints", with_(["trainlog"], f"""SELECT epoch, {r('accuracy')} AS accuracy, accuracy >= 0.85 AS target_met FROM (
    SELECT *, max(accuracy) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
    FROM (SELECT epoch, avg((event_type='purchase')::INT) AS accuracy FROM trainlog GROUP BY epoch)) WHERE accuracy > coalesce(best, 0)"""))
def _(v):
    epoch = F.datediff("ts", F.lit("2024-01-01")).alias("epoch")
    hit = (F.col("event_type") == "purchase").cast("double")
    history = v.table("events").groupBy(epoch).agg(F.avg(hit).alias("accuracy"))
    return trainlog.best_checkpoints(history).withColumn("accuracy", rnd("accuracy"))


@query("preference_accuracy", with_(["scored"], f"""SELECT source, count(*) AS n, {r('avg(((1/(1+exp(-score)) > 0.5)::INT = label)::INT)')} AS accuracy
    FROM scored GROUP BY source"""))
def _(v):
    return trainlog.preference_accuracy(v.scored(), ["source"]).withColumn("accuracy", rnd("accuracy"))


@query("preference_bce", with_(["scored"], f"""SELECT source, count(*) AS n,
    {r('avg(-(label*ln(1/(1+exp(-score))) + (1-label)*ln(1-1/(1+exp(-score)))))')} AS bce FROM scored GROUP BY source"""))
def _(v):
    return trainlog.preference_bce(v.scored(), ["source"]).withColumn("bce", rnd("bce"))


@query("ppo_objective", with_(["ppo"], f"""SELECT product_category, count(*) AS n, {r('-avg(least(x*advantage, least(greatest(x, 0.8::DOUBLE), 1.2::DOUBLE)*advantage))')} AS ppo_loss
    FROM (SELECT *, exp(new_logp-old_logp) AS x FROM ppo) GROUP BY product_category"""))
def _(v):
    return trainlog.ppo_objective(v.ppo_steps(), ["product_category"]).withColumn("ppo_loss", rnd("ppo_loss"))


# ---------------------------------------------------------------- next-token statistics, scorer


def _model(v: Views) -> DataFrame:
    return nextword.bigram_model(_encoded(v, max_length=None), vocabulary.VOCAB_SIZE)


@query("bigram_model", with_(["model"], f"SELECT prev, next, n, prev_n, {r('probability', 8)} AS probability FROM model"))
def _(v):
    return _model(v).withColumn("probability", rnd("probability", 8))


@query("bigram_perplexity", with_(["model"], f"""SELECT doc_id, count(*) AS tokens, {r('avg(-ln(probability))')} AS nll,
    {r('exp(avg(-ln(probability)))', 3)} AS perplexity FROM tokenpairs JOIN model USING (prev, next) GROUP BY doc_id"""))
def _(v):
    # written once: the ids take less room than the texts, and both the model and the scores read them
    encoded = freeze(vocabulary.encode(v.documents(), "doc_id", "text", freeze(_vocab(v)), max_length=None))
    model = freeze(nextword.bigram_model(encoded, vocabulary.VOCAB_SIZE))
    scored = nextword.sequence_perplexity(encoded, "doc_id", model, vocabulary.VOCAB_SIZE)
    return scored.withColumns({"nll": rnd("nll"), "perplexity": rnd("perplexity", 3)})


@query("validation_perplexity", _with_kl(["trainids", "splitdocs"], """vseq AS (SELECT key AS doc_id, [2]||ids||[3] AS ids FROM trainids),
    vp AS (SELECT doc_id, unnest(list_slice(ids,1,len(ids)-1)) AS prev, unnest(list_slice(ids,2,len(ids))) AS next FROM vseq),
    sp AS (SELECT prev, next, split FROM vp JOIN splitdocs USING (doc_id)),
    pm AS (SELECT prev, next, count(*) AS n FROM sp WHERE split='train' GROUP BY ALL),
    pt AS (SELECT prev, sum(n)::BIGINT AS m FROM pm GROUP BY prev)""",
    f"""SELECT count(*) AS tokens, {r('avg(c)')} AS nll, {r('exp(avg(c))', 3)} AS perplexity FROM (
    SELECT -ln((coalesce(n,0)+0.1::DOUBLE)/(coalesce(m,0)+500::DOUBLE)) AS c FROM sp LEFT JOIN pm USING (prev, next) LEFT JOIN pt USING (prev)
    WHERE split='val')"""))
def _(v):
    examples = prepare_texts(v.documents(), "doc_id", "text", max_length=None).examples
    # both parts are counted in one pass over the texts
    counts = freeze(nextword.shifted_pairs(examples, "split").groupBy("split", "prev", "next").agg(F.count(F.lit(1)).alias("n")))
    part = lambda name: counts.where(F.col("split") == name).drop("split")
    model = nextword.model_of_counts(part("train"), vocabulary.VOCAB_SIZE)
    result = nextword.perplexity_of_counts(part("val"), model, vocabulary.VOCAB_SIZE)
    return result.withColumns({"nll": rnd("nll"), "perplexity": rnd("perplexity", 3)})


@query("next_token_topk", with_(["model"], """SELECT prev, next, n, rank::INT AS rank FROM (SELECT *, row_number() OVER
    (PARTITION BY prev ORDER BY n DESC, next) AS rank FROM model) WHERE rank <= 3"""))
def _(v):
    return nextword.next_token_topk(_model(v)).select("prev", "next", "n", "rank")


@query("preference_scorer", """SELECT source, count(*) AS n, sum(quality)::BIGINT AS positives, TRUE AS beats_majority FROM (
    SELECT source, quality, row_number() OVER (ORDER BY md5('42:'||doc_id), doc_id) > floor(count(*) OVER () * 0.8::DOUBLE) AS val
    FROM documents JOIN labels USING (doc_id)) WHERE val GROUP BY source""")
def _(v):
    labelled = v.documents().join(v.table("labels"), "doc_id").select(
        "doc_id", "source", "text", F.col("quality").cast("double").alias("label")
    )
    split = ranking.hash_split(labelled, "doc_id")
    scored = scorer.preference_scores(
        split.where(F.col("split") == "train"), split.where(F.col("split") == "val")
    )
    right = trainlog.preference_accuracy(scored).select("accuracy").scalar()
    share = F.avg("label")
    majority = scored.agg(F.greatest(share, 1 - share)).scalar()
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives")
    ).withColumn("beats_majority", right >= majority)


# Newton's method on the same penalised likelihood, written out for a bias and two weights.
_FIT = """rated AS (SELECT doc_id, quality::DOUBLE AS y, ln(1 + n_chars::DOUBLE) - 7 AS x1, (lang = 'en')::INT::DOUBLE AS x2
      FROM documents JOIN labels USING (doc_id)),
    newton(k, b, w1, w2) AS (SELECT 0, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE UNION ALL
      SELECT k + 1, b - (g0*(h11*h22-h12*h12) - g1*(h01*h22-h02*h12) + g2*(h01*h12-h02*h11)) / det,
        w1 - (g1*(h00*h22-h02*h02) - g0*(h01*h22-h02*h12) - g2*(h00*h12-h01*h02)) / det,
        w2 - (g2*(h00*h11-h01*h01) + g0*(h01*h12-h02*h11) - g1*(h00*h12-h01*h02)) / det
      FROM (SELECT *, h00*(h11*h22-h12*h12) - h01*(h01*h22-h12*h02) + h02*(h01*h12-h11*h02) AS det FROM (
        SELECT k, b, w1, w2, avg(p-y) AS g0, avg((p-y)*x1)+0.01::DOUBLE*w1 AS g1, avg((p-y)*x2)+0.01::DOUBLE*w2 AS g2, avg(s) AS h00, avg(s*x1) AS h01,
          avg(s*x2) AS h02, avg(s*x1*x1)+0.01::DOUBLE AS h11, avg(s*x1*x2) AS h12, avg(s*x2*x2)+0.01::DOUBLE AS h22
        FROM (SELECT *, p*(1-p) AS s FROM (SELECT *, 1/(1+exp(-(b+w1*x1+w2*x2))) AS p FROM newton, rated WHERE k < 12)) GROUP BY k, b, w1, w2))),
    fitted AS (SELECT b, w1, w2 FROM newton WHERE k = 12)"""
_RATED = lambda v: v.table("documents").join(v.table("labels"), "doc_id").select(
    "doc_id", F.col("quality").cast("double").alias("label"), (F.ln(F.lit(1.0) + F.col("n_chars")) - 7).alias("length"),
    (F.col("lang") == "en").cast("double").alias("english"))


@query("preference_scorer_scores", f"WITH RECURSIVE {_FIT} SELECT doc_id, {r('b + w1*x1 + w2*x2', 4)} AS score FROM rated, fitted")
def _(v):
    rated = _RATED(v)
    return scorer.fitted_scores(rated, rated, ["length", "english"]).select("doc_id", rnd("score", 4).alias("score"))


@query("preference_scorer_weights", f"""WITH RECURSIVE {_FIT} SELECT unnest(['bias', 'length', 'english']) AS feature,
    unnest([{r('b', 4)}, {r('w1', 4)}, {r('w2', 4)}]) AS weight FROM fitted""")
def _(v):
    return scorer.fit(_RATED(v), ["length", "english"]).withColumn("weight", rnd("weight", 4))


from checks import awkward  # noqa: E402, F401  registers its queries
