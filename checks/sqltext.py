"""Building blocks of the SQL counterparts: named common table expressions."""

from __future__ import annotations

from parlance.sources import conversations as conv

WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def u(key: str, shift: int = 0) -> str:
    """Uniform of a text expression; ``shift`` 1 excludes zero."""
    return f"((('0x'||substr(md5({key}),1,8))::BIGINT + {shift})::DOUBLE/4294967296.0::DOUBLE)"


def normal(key: str) -> str:
    a, b = u(f"{key}||':a'", 1), u(f"{key}||':b'")
    return f"round(sqrt(-2.0::DOUBLE*ln({a}))*cos(2.0::DOUBLE*pi()*{b}), 5)"


def choose(values, key: str) -> str:
    return f"({lst(values)})[floor({u(key)}*{len(values)}.0::DOUBLE)::INT+1]"


def r(expr: str, digits: int = 6) -> str:
    """Rounding that sends both engines the same way at exact halves.

    Discounted sums of short decimals often end in an exact half. The shift is larger than
    their rounding error, and no short decimal, so that it makes no new halves.
    """
    return f"round(({expr})::DOUBLE + 3.71828e-11::DOUBLE, {digits})"


# Conversation records from the cells of an order and of an event.
_TRAIN = """SELECT o_orderkey AS id, printf('CUST_%06d', o_custkey) AS customer_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Electronics' WHEN '2-HIGH' THEN 'Electronics' WHEN '3-MEDIUM' THEN 'Clothing'
        WHEN '5-LOW' THEN 'Home' ELSE 'Sports' END AS product_category,
      CASE WHEN o_totalprice >= 300000 THEN 'positive' WHEN o_totalprice >= 100000 THEN 'neutral' ELSE 'negative' END AS sentiment,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
      'My order of '||year(o_orderdate)||' is '||o_orderpriority AS conversation_text,
      CASE o_orderstatus WHEN 'F' THEN 'purchase' WHEN 'O' THEN 'abandon' ELSE 'escalate' END AS outcome
    FROM orders"""
_PROD = """SELECT event_id AS id, printf('PROD_%06d', user_id) AS customer_id,
      CASE event_type WHEN 'signup' THEN 'Electronics' WHEN 'click' THEN 'Clothing' WHEN 'view' THEN 'Home' ELSE 'Sports' END AS product_category,
      CASE WHEN value >= 30 THEN 'positive' WHEN value >= 10 THEN 'neutral' ELSE 'negative' END AS sentiment,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp", props AS conversation_text,
      CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'escalate' ELSE 'abandon' END AS outcome
    FROM events"""


def _holes(rate: str = "0.2") -> str:
    keep = lambda c: f"{u(q(f'42:missing:{c}:') + '||id')} >= {rate}::DOUBLE"
    return ", ".join(f'CASE WHEN {keep(c)} THEN "{c}" END AS "{c}"' for c in conv.COLUMNS)


COLS = ", ".join(f'"{c}"' for c in conv.COLUMNS)
ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
OK = f"""regexp_matches("timestamp", '{ISO}')"""
NULLS = " + ".join(f'("{c}" IS NULL)::INT' for c in conv.COLUMNS)


def quarter(ts: str) -> str:
    parsed = f"try_cast({ts} AS TIMESTAMP)"
    return (
        f"CASE WHEN {ts} IS NULL THEN 'nan-Qnan' WHEN {parsed} IS NULL THEN 'invalid' "
        f"ELSE year({parsed})||'-Q'||quarter({parsed}) END"
    )


# Fixed values, written out on their own so that a wrong table of the library shows.
RESPONSE_TEMPLATES = {
    "positive": [
        "I'm glad you're interested! I recommend {product} which has excellent reviews.",
        "Great choice! Our {product} is highly rated for {quality}.",
        "Perfect! I suggest {product} - it's one of our best sellers.",
    ],
    "neutral": [
        "I can help you with that. I recommend {product} for your needs.",
        "Let me suggest {product} which fits your requirements.",
        "I'd recommend {product} based on what you're looking for.",
    ],
    "negative": [
        "I understand your frustration. Let me help you find {product} with {quality}.",
        "I apologize for the issue. I recommend {product} which has {quality}.",
        "I'm sorry about that. Our {product} has excellent {quality} ratings.",
    ],
}
PRODUCTS = {
    "Electronics": ["TechPro Laptop", "UltraSound Headphones", "SmartView Monitor"],
    "Clothing": ["TrekPro Jeans", "ComfortFit Shirt", "ActiveWear Jacket"],
    "Home": ["DuraClean Vacuum", "SmartCook Blender", "CozyComfort Sofa"],
    "Sports": ["TrailRunner Shoes", "FlexFit Yoga Mat", "PowerLift Weights"],
}
QUALITIES = [
    "excellent durability",
    "high customer ratings",
    "premium quality materials",
    "outstanding performance",
    "long warranty coverage",
]


def _sft() -> str:
    by_sentiment = " ".join(
        f"WHEN {q(s)} THEN {choose(t, q('42:template:') + '||id')}" for s, t in RESPONSE_TEMPLATES.items()
    )
    by_category = " ".join(
        f"WHEN {q(c)} THEN {choose(p, q('42:product:') + '||id')}" for c, p in PRODUCTS.items()
    )
    return f"""SELECT id, context, response,
      round(least(greatest(3.5::DOUBLE
        + CASE WHEN sentiment='negative' AND contains(response,'understand') THEN 0.5::DOUBLE ELSE 0::DOUBLE END
        + CASE WHEN sentiment='positive' AND contains(response,'glad') THEN 0.3::DOUBLE ELSE 0::DOUBLE END
        + 0.3::DOUBLE*{normal("'42:noise:'||id")}, 2::DOUBLE), 5::DOUBLE), 6) AS quality_score
    FROM (SELECT id, sentiment,
        'Category: '||product_category||', Sentiment: '||sentiment||', Outcome: '||outcome||', Message: '||conversation_text AS context,
        replace(replace(CASE sentiment {by_sentiment} END, '{{product}}', CASE product_category {by_category} END),
          '{{quality}}', {choose(QUALITIES, q('42:quality:') + '||id')}) AS response
      FROM train)"""


# Fixed values, written out on their own so that a wrong rule of the library shows.
DELTA = """CASE
    WHEN action = 0 THEN CASE WHEN asked_about_price THEN 0.2 ELSE 0.05 END
    WHEN action = 1 THEN CASE WHEN customer_segment = 'vip' THEN 0.25 WHEN mentioned_issue THEN 0.2 ELSE 0.1 END
    WHEN action = 2 THEN 0.1
    WHEN action = 3 THEN CASE WHEN mentioned_issue THEN 0.3 ELSE 0.15 END
    WHEN action = 4 THEN CASE WHEN mentioned_issue THEN 0.4 ELSE 0.25 END
    WHEN action = 5 THEN CASE WHEN satisfaction < 0.4::DOUBLE THEN 0.1 ELSE -0.1 END
    ELSE 0 END::DOUBLE"""
SELL = """CASE
    WHEN action = 0 THEN 0.8
    WHEN action = 1 THEN CASE WHEN customer_segment = 'vip' THEN 0.7 ELSE 0.5 END
    ELSE 0 END::DOUBLE"""


def word_list(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), '{WS}'), lambda x: x <> '')"


def encoded(source: str, words: str, vocab: str) -> str:
    """Per key: word ids in order, from a relation (key, ws)."""
    return f"""SELECT s.key, coalesce(list(coalesce(v.id, 1) ORDER BY s.pos) FILTER (s.pos IS NOT NULL), []::INT[]) AS ids
      FROM (SELECT key, unnest(CASE WHEN len({words})=0 THEN [NULL] ELSE {words} END) AS token,
              unnest(CASE WHEN len({words})=0 THEN [NULL] ELSE range(1, len({words})+1) END) AS pos FROM {source}) s
      LEFT JOIN {vocab} v ON v.token = s.token GROUP BY s.key"""


def vocab(words_relation: str, size: int = 5000) -> str:
    return f"""SELECT i AS id, t AS token, 0::BIGINT AS "count"
        FROM (VALUES (0,'<PAD>'),(1,'<UNK>'),(2,'<BOS>'),(3,'<EOS>')) AS s(i,t)
      UNION ALL SELECT (3 + row_number() OVER (ORDER BY n DESC, token))::INT, token, n
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(ws) AS token FROM {words_relation}) GROUP BY token
              ORDER BY n DESC, token LIMIT {size - 4})"""


FEATURE_SQL = """[satisfaction, (customer_segment='vip')::INT::DOUBLE, (customer_segment='regular')::INT::DOUBLE,
  (product_category='Electronics')::INT::DOUBLE, (product_category='Clothing')::INT::DOUBLE,
  (product_category='Home')::INT::DOUBLE, (product_category='Sports')::INT::DOUBLE,
  mentioned_issue::INT::DOUBLE, asked_about_price::INT::DOUBLE, turn::DOUBLE/10::DOUBLE]"""

def _logged(episode: str, turn: str, e: str) -> str:
    """Events as steps of episodes; ``e`` is the number that segment and category hang on."""
    return f"""SELECT event_id, user_id, {episode} AS episode, {turn} AS turn,
        ((event_id*7+user_id)%6)::INT AS action, event_type='purchase' AS purchased, event_type='error' AS escalated,
        CASE WHEN event_type='purchase' THEN 0.95::DOUBLE ELSE least(1::DOUBLE, value/100::DOUBLE) END AS satisfaction_after,
        (['new','regular','vip'])[({e})%3+1] AS customer_segment,
        (['Electronics','Clothing','Home','Sports'])[({e})%4+1] AS product_category,
        ({e})%10 < 3 AS mentioned_issue, ({e})%10 >= 6 AS asked_about_price FROM events"""


def _trajectory(logged: str, prefix: str) -> dict[str, tuple[list[str], str]]:
    """Rewards, the steps up to the terminal one, returns and features of logged steps."""
    return {
        f"{prefix}steps": ([logged], f"""SELECT *, 0.5::DOUBLE*(satisfaction_after-satisfaction)
          + 0.35::DOUBLE*purchased::INT::DOUBLE + (-0.15)::DOUBLE*escalated::INT::DOUBLE AS reward,
        turn+1 >= 10 OR purchased OR escalated OR satisfaction_after < 0.2::DOUBLE AS ends
      FROM (SELECT *, coalesce(lag(satisfaction_after) OVER (PARTITION BY episode ORDER BY turn), 0.55::DOUBLE) AS satisfaction
            FROM {logged})"""),
        f"{prefix}episodes": ([f"{prefix}steps"], f"""SELECT * FROM (SELECT *, coalesce(max(ends::INT) OVER (PARTITION BY episode ORDER BY turn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM {prefix}steps) WHERE ended = 0"""),
        f"{prefix}returns": ([f"{prefix}steps"], f"""SELECT *, sum(pow(0.99::DOUBLE, turn)*reward) OVER (PARTITION BY episode ORDER BY turn
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)/pow(0.99::DOUBLE, turn) AS discounted_return FROM {prefix}steps"""),
        f"{prefix}featured": ([f"{prefix}returns"], f"SELECT *, {FEATURE_SQL} AS features FROM {prefix}returns"),
    }


# name -> (names it needs, text)
CTES: dict[str, tuple[list[str], str]] = {
    "train": ([], _TRAIN),
    "prod": ([], _PROD),
    "holes": (["train"], f"SELECT id, {_holes()} FROM train"),
    "copies": (["holes"], f"""SELECT *, unnest(CASE WHEN {u("'42:duplicate:'||id")} < 0.05::DOUBLE THEN [0,1] ELSE [0] END) AS copy_no
      FROM holes"""),
    "dirty": (["copies"], f"""SELECT customer_id, product_category, sentiment,
      CASE WHEN {u("'42:invalid:'||id||':'||copy_no")} < 0.03::DOUBLE THEN 'INVALID_DATE_'||id||'_'||copy_no ELSE "timestamp" END AS "timestamp",
      conversation_text, outcome FROM copies"""),
    "profile": (["dirty"], f"""SELECT *, count(*) AS n, {NULLS} AS missing, "timestamp" IS NOT NULL AS filled,
      coalesce({OK}, FALSE) AS ok FROM dirty GROUP BY {COLS}"""),
    "docs_labeled": ([], "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"),
    "sft": (["train"], _sft()),
    "docpref": ([], """SELECT doc_id, lang||'|'||source AS context, text AS response, quality
      FROM documents JOIN labels USING (doc_id)"""),
    "turns": ([], """SELECT conv_id||':'||turn AS pair_id, context, response FROM (
      SELECT conv_id, turn, role, text AS context, lead(role) OVER w AS next_role, lead(text) OVER w AS response,
        lead(turn) OVER w AS next_turn
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
      WHERE role='user' AND next_role='assistant' AND next_turn = turn + 1"""),
    "logged": ([], _logged("event_id//10", "(event_id%10)::INT", "event_id//10")),
    "daylogged": ([], _logged("CASE WHEN user_id%5 <> 0 THEN user_id||'|'||ts::DATE END",
        "(row_number() OVER (PARTITION BY CASE WHEN user_id%5 <> 0 THEN user_id||'|'||ts::DATE END ORDER BY event_id)-1)::INT", "user_id")),
    **_trajectory("logged", ""),
    **_trajectory("daylogged", "day"),
    "trainlog": ([], """SELECT datediff('day', DATE '2024-01-01', ts::DATE)::INT AS epoch, event_id, event_type, value/100::DOUBLE AS loss,
        row_number() OVER (PARTITION BY ts::DATE ORDER BY event_id) AS batch FROM events"""),
    "scored": ([], f"""SELECT doc_id, source, quality::DOUBLE AS label,
        CASE WHEN quality=1 THEN 1::DOUBLE ELSE -1::DOUBLE END + {normal("'logit:'||doc_id")} AS score
      FROM labels JOIN documents USING (doc_id)"""),
    "ppo": (["steps"], f"""SELECT *, ln({u("'old:'||event_id")}*0.9::DOUBLE+0.05::DOUBLE) AS old_logp,
        ln({u("'new:'||event_id")}*0.9::DOUBLE+0.05::DOUBLE) AS new_logp, reward - satisfaction AS advantage FROM steps"""),
    "docwords": ([], f"SELECT doc_id AS key, {word_list('text')} AS ws FROM documents"),
    "vocab": (["docwords"], vocab("docwords")),
    "vocabsep": (["vocab"], """SELECT * FROM vocab UNION ALL
        SELECT (SELECT count(*) FROM vocab)::INT, '<SEP>', 0 WHERE '<SEP>' NOT IN (SELECT token FROM vocab)"""),
    "docids": (["docwords", "vocab"], encoded("docwords", "ws", "vocab")),
    "enc": (["docids"], "SELECT key AS doc_id, list_slice([2]||ids||[3], 1, 256) AS ids FROM docids"),
    "enckeep": (["docids"], "SELECT key AS doc_id, [2]||list_slice(ids, 1, 254)||[3] AS ids FROM docids"),
    "ntp": (["enc"], "SELECT doc_id, list_slice(ids,1,len(ids)-1) AS input_ids, list_slice(ids,2,len(ids)) AS target_ids FROM enc WHERE len(ids) > 1"),
    "ranked": (["ntp"], "SELECT *, (row_number() OVER (ORDER BY md5('42:'||doc_id), doc_id)-1)//32 AS batch_id FROM ntp"),
    "padded": (["ranked"], """SELECT doc_id, batch_id, list_resize(input_ids, m, 0) AS input_ids, list_resize(target_ids, m, 0) AS target_ids
      FROM (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS m FROM ranked)"""),
    "ctxwords": (["turns"], f"SELECT pair_id AS key, {word_list('context')} AS ws FROM turns"),
    "rspwords": (["turns"], f"SELECT pair_id AS key, {word_list('response')} AS ws FROM turns"),
    "ctxids": (["ctxwords", "vocabsep"], encoded("ctxwords", "ws", "vocabsep")),
    "rspids": (["rspwords", "vocabsep"], encoded("rspwords", "ws", "vocabsep")),
    "sftseq": (["ctxids", "rspids"], """SELECT key AS pair_id,
        list_slice([2]||c.ids||[(SELECT max(id) FROM vocabsep WHERE token='<SEP>')]||p.ids||[3], 1, 256) AS input_ids,
        list_slice(list_resize([]::INT[], len(c.ids)+2, -100)||p.ids||[3], 1, 256) AS target_ids
      FROM ctxids c JOIN rspids p USING (key)"""),
    "splitdocs": ([], """SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:'||doc_id), doc_id)
        <= floor((SELECT count(*) FROM documents)*0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM documents"""),
    "trainwords": (["splitdocs"], f"SELECT doc_id AS key, {word_list('text')} AS ws FROM splitdocs WHERE split='train'"),
    "trainvocab": (["trainwords"], vocab("trainwords")),
    "allwords": (["splitdocs"], f"SELECT doc_id AS key, {word_list('text')} AS ws FROM splitdocs"),
    "trainids": (["allwords", "trainvocab"], encoded("allwords", "ws", "trainvocab")),
    "tokenpairs": (["docids"], """SELECT key AS doc_id, unnest([2]||ids) AS prev, unnest(ids||[3]) AS next FROM docids"""),
    "model": (["tokenpairs"], """SELECT prev, next, n, sum(n) OVER (PARTITION BY prev)::BIGINT AS prev_n,
        (n+0.1::DOUBLE)/(sum(n) OVER (PARTITION BY prev)::BIGINT+500::DOUBLE) AS probability
      FROM (SELECT prev, next, count(*) AS n FROM tokenpairs GROUP BY ALL)"""),
}


def with_(names: list[str], body: str) -> str:
    """``body`` preceded by the named expressions and all they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    heads = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {heads}\n{body}" if ordered else body


def kl(train_from: str, prod_from: str) -> str:
    """KL per feature from two relations already unpivoted to (feature, value)."""
    return f"""p AS (SELECT feature, value, count(*)::DOUBLE/sum(count(*)) OVER (PARTITION BY feature)::DOUBLE AS x FROM ({prod_from}) GROUP BY feature, value),
    t AS (SELECT feature, value, count(*)::DOUBLE/sum(count(*)) OVER (PARTITION BY feature)::DOUBLE AS x FROM ({train_from}) GROUP BY feature, value),
    a AS (SELECT feature, value, coalesce(p.x, 1e-10::DOUBLE) AS p0, coalesce(t.x, 1e-10::DOUBLE) AS q0
          FROM p FULL JOIN t USING (feature, value)),
    dist AS (SELECT feature, value, p0/sum(p0) OVER (PARTITION BY feature) AS p, q0/sum(q0) OVER (PARTITION BY feature) AS q FROM a),
    klrows AS (SELECT feature, sum(p*ln(p/q)) AS kl FROM dist GROUP BY feature)"""


def unpivoted(relation: str, features: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {q(name)} AS feature, ({expr})::VARCHAR AS value FROM {relation} WHERE ({expr}) IS NOT NULL"
        for name, expr in features.items()
    )
