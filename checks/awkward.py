"""Queries on inputs with NULL groups, missing scores, gaps and wide numbers, and on rebalanced classes.

The gaps and holes are cut into the given tables by plain arithmetic on their keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks import sqltext as S
from checks.catalog import SQL, _with_kl, joined, query, rnd
from checks.sqltext import r, with_
from checks.views import Views
from parlance.functions.text import words
from parlance.operators import cleaning, drift, pairs, ranking, rebalance, sequences, trainlog, trajectory, vocabulary
from parlance.plans import quality_report as reports
from parlance.session import ensure_checkpoint_dir, freeze
from parlance.sources import files

# ---------------------------------------------------------------- sequences: a user-day is an episode


def _user_days(v: Views) -> DataFrame:
    """Events of user-days, numbered by event: turns with gaps; every fifth user is NULL and shares one episode."""
    user = F.when(F.col("user_id") % 5 != 0, F.concat_ws("|", "user_id", F.to_date("ts").cast("string")))
    return v.table("events").select("event_id", user.alias("episode"), F.col("event_id").alias("turn"), (F.col("value") / 100.0).alias("reward"))


_DAYS = """WITH days AS (SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN user_id||'|'||ts::DATE END AS episode,
    value/100::DOUBLE AS reward FROM events)"""


@query("turns_of_user_days", f"""{_DAYS} SELECT event_id, (row_number() OVER (PARTITION BY episode ORDER BY event_id)-1)::INT AS number FROM days""")
def _(v):
    return ranking.number_turns(_user_days(v), "episode", ["turn"], "number").select("event_id", F.col("number").cast("int").alias("number"))


@query("gain_over_gaps", f"""{_DAYS} SELECT event_id, {r('reward - coalesce(lag(reward) OVER (PARTITION BY episode ORDER BY event_id), 0)')} AS gain FROM days""")
def _(v):
    before = sequences.previous_value(_user_days(v), "episode", "turn", "reward", 0.0, "before", chunk=50)
    return before.select("event_id", rnd(F.col("reward") - F.col("before")).alias("gain"))


@query("returns_over_gaps", f"""{_DAYS} SELECT event_id, {r('sum(pow(0.999::DOUBLE, event_id)*reward) OVER (PARTITION BY episode ORDER BY event_id DESC)/pow(0.999::DOUBLE, event_id)')} AS g FROM days""")
def _(v):
    returns = sequences.discounted_returns(_user_days(v), "episode", "turn", "reward", 0.999, "g", chunk=500)
    return returns.select("event_id", rnd("g").alias("g"))


@query("returns_undiscounted", f"""{_DAYS} SELECT event_id, {r('sum(reward) OVER (PARTITION BY episode ORDER BY event_id DESC)')} AS g FROM days""")
def _(v):
    returns = sequences.discounted_returns(_user_days(v), "episode", "turn", "reward", 1.0, "g", chunk=300)
    return returns.select("event_id", rnd("g").alias("g"))


@query("best_of_user_days", f"""{_DAYS} SELECT event_id, max(reward) OVER (PARTITION BY episode ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM days""")
def _(v):
    return sequences.best_before(_user_days(v), "episode", "turn", "reward", "best", chunk=200).select("event_id", "best")


def _gapped_log(v: Views) -> DataFrame:
    """Every event as a logged batch, numbered with gaps: after each fifth number two are left out."""
    batch = F.col("event_id") + F.floor(F.col("event_id") / 5) * 2
    return v.table("events").select(F.col("event_type").alias("epoch"), batch.alias("batch"), (F.col("value") / 100.0).alias("loss"))


@query("trailing_loss_gaps_whole", f"""SELECT epoch, batch, {r('m')} AS avg_loss FROM (
    SELECT epoch, batch, avg(loss) OVER (PARTITION BY epoch ORDER BY batch ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS m FROM (
      SELECT event_type AS epoch, event_id + event_id // 5 * 2 AS batch, value/100::DOUBLE AS loss FROM events)) WHERE batch % 20 = 0""")
def _(v):
    return trainlog.trailing_loss(_gapped_log(v)).withColumn("avg_loss", rnd("avg_loss"))


@query("step_rewards_user_days", with_(["daysteps"], f"SELECT event_id, turn, {r('satisfaction')} AS satisfaction, {r('reward')} AS reward FROM daysteps"))
def _(v):
    return v.day_steps().select("event_id", "turn", rnd("satisfaction").alias("satisfaction"), rnd("reward").alias("reward"))


@query("policy_metrics_user_days", with_(["dayepisodes"], f"""SELECT product_category, count(*) AS episodes, {r('avg(reward)')} AS avg_reward,
    {r('stddev_pop(reward)')} AS std_reward, {r('sum(p)/count(*)::DOUBLE')} AS purchase_rate, {r('sum(e)/count(*)::DOUBLE')} AS escalation_rate,
    {r('avg(turns)')} AS avg_turns FROM (SELECT product_category, episode, sum(reward) AS reward, sum(purchased::INT) AS p,
      sum(escalated::INT) AS e, count(*) AS turns FROM dayepisodes GROUP BY product_category, episode) GROUP BY product_category"""))
def _(v):
    metrics = trajectory.policy_metrics(trajectory.until_terminal(v.day_steps(), v.terminal()), ["product_category"])
    doubles = ["avg_reward", "std_reward", "purchase_rate", "escalation_rate", "avg_turns"]
    return metrics.withColumns({c: rnd(c) for c in doubles})


@query("value_training_user_days", with_(["dayfeatured"], f"""SELECT event_id, {r('discounted_return')} AS discounted_return,
    {r('features[1]')} AS satisfaction, {r('features[10]')} AS progress FROM dayfeatured"""))
def _(v):
    rows = trajectory.value_training_set(v.day_steps())
    return rows.select("event_id", rnd("discounted_return").alias("discounted_return"),
                       rnd(F.col("features")[0]).alias("satisfaction"), rnd(F.col("features")[9]).alias("progress"))


# ---------------------------------------------------------------- missing scores, wide integers


def _scores(v: Views) -> DataFrame:
    """Lengths as scores; some are NULL and some NaN."""
    score = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("n_chars").cast("double"))
    return v.table("documents").select("doc_id", score.alias("score"))


_SCORES = """WITH scores AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN n_chars END AS score FROM documents),
    placed AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC NULLS LAST, doc_id) AS best,
      row_number() OVER (ORDER BY score NULLS LAST, doc_id) AS least, count(*) OVER () AS n FROM scores)"""


@query("top_n_missing_scores", f"{_SCORES} SELECT doc_id, best <= floor(n*0.85::DOUBLE) AS is_good FROM placed")
def _(v):
    scores = _scores(v)
    n = int(scores.count() * 0.85)
    return pairs.top_n_label(scores, "doc_id", "score", n).select("doc_id", "is_good")


@query("split_missing_scores", f"{_SCORES} SELECT doc_id, CASE WHEN least <= floor(n*0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM placed")
def _(v):
    return ranking.ordered_split(_scores(v), [("score", True), ("doc_id", True)], 0.9).select("doc_id", "split")


@query("score_bands_missing", """SELECT CASE WHEN score >= 4 THEN 'good' WHEN score < 3.5 THEN 'bad' END AS band, count(*) AS n FROM (
    SELECT CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN n_chars/1000::DOUBLE END AS score FROM documents) GROUP BY 1""")
def _(v):
    band = pairs.score_band(F.col("score") / 1000.0).alias("band")
    return _scores(v).groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@query("impute_wide_integers", """SELECT doc_id + 9007199254740992 AS wide,
    coalesce(score, (SELECT median(score) FROM (SELECT CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN n_chars::DOUBLE END AS score FROM documents))) AS score
    FROM (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN n_chars::DOUBLE END AS score FROM documents)""")
def _(v):
    wide = _scores(v).select((F.col("doc_id") + F.lit(9007199254740992)).alias("wide"), "score")
    return cleaning.impute_missing(wide)


_WIDE = """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN 12345678901234567890::HUGEINT + 2*doc_id*n_chars END AS wide,
      CASE WHEN doc_id % 3 <> 0 THEN 9007199254740993::HUGEINT + doc_id * 7 END AS long FROM documents),
    middle AS (SELECT (SELECT sum(wide)*10 // count(*) FROM (SELECT wide, row_number() OVER (ORDER BY wide)-1 AS r, count(*) OVER () AS n FROM d WHERE wide IS NOT NULL) WHERE r IN ((n-1)//2, n//2)) AS wide,
      (SELECT sum(long)*10 // count(*) FROM (SELECT long, row_number() OVER (ORDER BY long)-1 AS r, count(*) OVER () AS n FROM d WHERE long IS NOT NULL) WHERE r IN ((n-1)//2, n//2)) AS long),
    filled AS (SELECT doc_id, coalesce(d.wide*10, m.wide) AS wide, coalesce(d.long*10, m.long) AS long FROM d, middle m)"""


def _wide(v: Views) -> DataFrame:
    """Decimals of 20 digits and integers beyond 2^53, some missing; doubles would not tell them apart."""
    wide = F.when(F.col("doc_id") % 5 != 0, F.lit("12345678901234567890").cast("decimal(38,0)") + F.col("doc_id") * F.col("n_chars") * 2)
    long = F.when(F.col("doc_id") % 3 != 0, F.lit(9007199254740993) + F.col("doc_id") * 7)
    return v.table("documents").select("doc_id", wide.cast("decimal(38,0)").alias("wide"), long.alias("long"))


@query("impute_wide_decimals", f"""{_WIDE} SELECT doc_id, (wide // 10)::VARCHAR AS wide, (long // 10)||'.'||(long % 10) AS long FROM filled""")
def _(v):
    filled = cleaning.impute_missing(_wide(v))
    return filled.select("doc_id", F.col("wide").cast("string").alias("wide"), F.col("long").cast("string").alias("long"))


@query("median_wide_decimals", f"""{_WIDE} SELECT (wide // 10)::VARCHAR AS wide, (long // 10)||'.'||(long % 10) AS long FROM middle""")
def _(v):
    found = [ranking.median_of(_wide(v), c).select(F.col("median").cast("string").alias(c)) for c in ("wide", "long")]
    return found[0].crossJoin(found[1])


# ---------------------------------------------------------------- a vocabulary too large for one value

_GRAMS = """lists AS (SELECT key AS doc_id, ws || list_transform(range(1, len(ws)), lambda i: ws[i]||'_'||ws[i+1])
      || list_transform(range(1, len(ws)-1), lambda i: ws[i]||'_'||ws[i+1]||'_'||ws[i+2]) AS g FROM docwords WHERE ws IS NOT NULL),
    grams AS (SELECT doc_id, unnest(g) AS token, generate_subscripts(g, 1) AS pos FROM lists),
    gramvocab AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 3 AS id FROM grams GROUP BY token)"""


def _grams(v: Views) -> DataFrame:
    """Each document's words, and its runs of two and three words as words of their own."""
    def runs(ws: Column) -> Column:
        # a run that is not followed by another word becomes NULL, which is left out of the text
        follow = lambda starts, k: F.zip_with(starts, F.slice(ws, k, F.size(ws)), lambda x, y: F.concat(x, F.lit("_"), y))
        return F.transform(F.array(follow(ws, 2)), lambda two: F.array_join(F.concat(ws, two, follow(two, 3)), " "))[0]

    return v.documents().select("doc_id", F.transform(F.array(words(F.col("text"))), runs)[0].alias("text"))


def _gram_vocab(texts: DataFrame) -> DataFrame:
    return freeze(vocabulary.build_vocab(texts, "text", 5_000_000))


@query("encode_large_vocab", _with_kl(["docwords"], _GRAMS, """SELECT doc_id, coalesce(ids, '2 3') AS ids FROM lists LEFT JOIN (
    SELECT doc_id, '2 '||string_agg(id::VARCHAR, ' ' ORDER BY pos)||' 3' AS ids FROM grams JOIN gramvocab USING (token) GROUP BY doc_id) USING (doc_id)"""))
def _(v):
    texts = _grams(v)
    return vocabulary.encode(texts, "doc_id", "text", _gram_vocab(texts), max_length=None).select("doc_id", joined("ids"))


@query("decode_large_vocab", _with_kl(["docwords"], _GRAMS, """SELECT doc_id, coalesce(array_to_string(g, ' '), '') AS text FROM lists"""))
def _(v):
    texts = _grams(v)
    vocab = _gram_vocab(texts)
    return vocabulary.decode(vocabulary.encode(texts, "doc_id", "text", vocab, max_length=None), "doc_id", "ids", vocab)


# ---------------------------------------------------------------- rebalancing


@query("class_weights", """SELECT lang, n, round(total / (classes * n::DOUBLE) + 3.71828e-11::DOUBLE, 6) AS weight FROM (
    SELECT lang, count(*) AS n, sum(count(*)) OVER ()::DOUBLE AS total, count(*) OVER () AS classes FROM documents GROUP BY lang)""")
def _(v):
    return rebalance.class_weights(v.table("documents"), "lang").withColumn("weight", rnd("weight"))


_COPIES = f"""SELECT doc_id, lang, unnest(range(0, (floor(share) + (CASE WHEN {S.u("'42:copies:'||doc_id")} < share - floor(share) THEN 1 ELSE 0 END))::BIGINT)) AS copy
    FROM (SELECT doc_id, lang, greatest(1::DOUBLE, max(n) OVER () / n::DOUBLE) AS share FROM (SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) AS n FROM documents))"""
_LABELLED = "(SELECT lang FROM documents JOIN labels USING (doc_id) WHERE quality = 0)"
_MATCHED = f"""SELECT doc_id, lang FROM documents JOIN (
      SELECT lang, ratio / max(ratio) OVER () AS fraction FROM (
        SELECT h.lang, w.n::DOUBLE / h.n AS ratio FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang) h
        JOIN (SELECT lang, count(*) AS n FROM {_LABELLED} GROUP BY lang) w ON h.lang IS NOT DISTINCT FROM w.lang)) f USING (lang)
    WHERE {S.u("'42:stratum:'||doc_id")} < fraction"""


def _oversampled(v: Views) -> DataFrame:
    return rebalance.oversample(v.table("documents").select("doc_id", "lang"), "doc_id", "lang")


def _low_quality(v: Views) -> DataFrame:
    return v.table("documents").join(v.table("labels").where("quality = 0"), "doc_id").select("lang")


def _matched(v: Views) -> DataFrame:
    return rebalance.stratified_match(v.table("documents").select("doc_id", "lang"), _low_quality(v), "doc_id", "lang")


@query("oversample", f"SELECT doc_id, lang, copy::INT AS copy FROM ({_COPIES})")
def _(v):
    return _oversampled(v).withColumn("copy", F.col("copy").cast("int"))


@query("stratified_match", _MATCHED)
def _(v):
    return _matched(v)


def _kl_sql(name: str, current: str) -> str:
    """KL of the reference against a sample; every language is on both sides of the given tables."""
    return f"""SELECT '{name}' AS step, sum(p * ln(p / q)) AS kl FROM
      (SELECT lang, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM {_LABELLED} GROUP BY lang)
      JOIN (SELECT lang, count(*)::DOUBLE / sum(count(*)) OVER () AS q FROM ({current}) GROUP BY lang) USING (lang)"""


@query("kl_after_matching", f"SELECT step, {r('kl')} AS kl FROM ({_kl_sql('before', 'SELECT lang FROM documents')} UNION ALL {_kl_sql('after', _MATCHED)})")
def _(v):
    features = {"lang": F.col("lang")}
    step = lambda name, df: drift.kl_divergence(_low_quality(v), df, features).select(F.lit(name).alias("step"), rnd("kl").alias("kl"))
    return step("before", v.table("documents")).unionByName(step("after", _matched(v)))


# ---------------------------------------------------------------- the nested report, written and read back


@query("report_json_roundtrip", SQL["quality_report"])
def _(v):
    ensure_checkpoint_dir(v.spark)
    path = f"{v.spark.sparkContext.getCheckpointDir()}/report-{uuid.uuid4().hex}"
    report = reports.quality_report(v.dirty(), v.prod())
    files.write_json(report, path)
    return reports.summarise(files.read_json(v.spark, path, report.schema))

