"""The same queries as DuckDB SQL over the given tables."""

from __future__ import annotations

from tidemark.plans.catalog import MIN_DF, PHRASES, PLAN_END, PLAN_START, QUOTA, ROUTES, SOURCES, TOP_FEATURES, VOCAB
from tidemark.schemas import CLEANED, POST, WORDS
from tidemark.sources.tables import BROKEN_JSON, DAYS, EMPTY_TEXT, FIRST_DAY, NULL_TEXT

URLS = r"'http\S+|www\.\S+'"
LETTERS = r"'[^a-zA-Z\n ]'"


def _clean(text: str) -> str:
    return f"regexp_replace(regexp_replace(lower(trim({text})), {URLS}, '', 'g'), {LETTERS}, '', 'g')"


def _words(clean: str) -> str:
    body = f"rtrim({clean}, E' \\n')"
    return (
        f"CASE WHEN {clean} = '' THEN [''] WHEN {body} = '' THEN []::VARCHAR[] "
        f"ELSE string_split_regex({body}, '[ \\n]') END"
    )


def _grams(n: int) -> str:
    if n == 1:
        return "w"
    parts = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len(w) - {n} + 2), lambda i: {parts})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


WORDED = (
    f"cleaned AS (SELECT doc_id, {_clean('text')} AS c FROM documents)",
    f"worded AS (SELECT doc_id, c, {_words('c')} AS w FROM cleaned)",
)

def _bucket(seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || doc_id), 1, 8))::BIGINT % 1000000)"


TRAINED = f"{_bucket(2000)} < 800000"

LABELLED = (
    f"cleaned AS (SELECT d.doc_id, CAST(4 * l.quality AS VARCHAR) AS label, {_clean('d.text')} AS c "
    "FROM documents d JOIN labels l USING (doc_id))",
    f"worded AS (SELECT doc_id, label, c, {_words('c')} AS w FROM cleaned)",
)

TRAINING = (LABELLED[0].removesuffix(")") + f" WHERE {TRAINED})", LABELLED[1])


def _counts(max_n: int, key: str = "doc_id") -> str:
    parts = [
        f"SELECT {n} AS n, {key}, term, count(*) AS tf "
        f"FROM (SELECT {key}, unnest({_grams(n)}) AS term FROM worded) GROUP BY ALL"
        for n in range(1, max_n + 1)
    ]
    return "counts AS (" + " UNION ALL ".join(parts) + ")"


VOCABULARY = (
    "stats AS (SELECT n, term, sum(tf)::BIGINT AS total, count(*) AS df FROM counts GROUP BY n, term)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY total DESC, term) - 1 AS idx FROM stats)",
    f"vocab AS (SELECT *, (n - 1) * {VOCAB} + idx AS feature, CASE WHEN df < {MIN_DF} THEN 0.0 "
    "ELSE ln(((SELECT count(*) FROM worded) + 1.0) / (df + 1.0)) END AS idf "
    f"FROM ranked WHERE idx < {VOCAB})",
)


def _ngram(n: int) -> str:
    return _with(*WORDED) + (
        f"SELECT doc_id, len(g) AS n_grams, array_to_string(g, '|') AS grams "
        f"FROM (SELECT doc_id, {_grams(n)} AS g FROM worded)"
    )


def _vocabulary(n: int) -> str:
    return _with(*WORDED) + (
        "SELECT term, total, row_number() OVER (ORDER BY total DESC, term) - 1 AS idx FROM "
        f"(SELECT term, count(*) AS total FROM (SELECT unnest({_grams(n)}) AS term FROM worded) "
        f"GROUP BY term ORDER BY total DESC, term LIMIT {VOCAB})"
    )


# --- chi-squared -----------------------------------------------------------

CHI2 = (
    "label_n AS (SELECT label, count(*)::DOUBLE AS cl FROM worded GROUP BY label)",
    "corpus AS (SELECT count(*)::DOUBLE AS nn FROM worded)",
    "found AS (SELECT v.feature, c.tf, w.label, count(*) AS o FROM counts c "
    "JOIN vocab v ON v.n = c.n AND v.term = c.term JOIN worded w USING (doc_id) GROUP BY ALL)",
    "tfs AS (SELECT feature, tf, sum(o)::DOUBLE AS r FROM found GROUP BY feature, tf)",
    "zeros AS (SELECT feature, 0 AS tf, (SELECT nn FROM corpus) - sum(r) AS r FROM tfs GROUP BY feature)",
    "sizes AS (SELECT * FROM tfs UNION ALL SELECT * FROM zeros WHERE r > 0)",
    "absent AS (SELECT f.feature, l.label, l.cl - coalesce(s.o, 0) AS o FROM "
    "(SELECT DISTINCT feature FROM tfs) f CROSS JOIN label_n l LEFT JOIN "
    "(SELECT feature, label, sum(o) AS o FROM found GROUP BY feature, label) s "
    "ON s.feature = f.feature AND s.label = l.label)",
    "cells AS (SELECT s.feature, s.tf, coalesce(f.o, a.o, 0)::DOUBLE AS o, s.r * l.cl / nn AS e "
    "FROM sizes s CROSS JOIN label_n l CROSS JOIN corpus "
    "LEFT JOIN found f ON f.feature = s.feature AND f.tf = s.tf AND f.label = l.label "
    "LEFT JOIN absent a ON s.tf = 0 AND a.feature = s.feature AND a.label = l.label)",
    "by_value AS (SELECT feature, tf, sum((o - e) * (o - e) / e) AS part FROM cells GROUP BY feature, tf)",
    "tested AS (SELECT feature, sum(part::DECIMAL(38, 16))::DOUBLE AS statistic, "
    "(count(*) - 1) * ((SELECT count(*) FROM label_n) - 1) AS dof FROM by_value GROUP BY feature)",
)

# 1 - P(dof / 2, statistic / 2), P as a sum of positive Poisson-like terms.
P_VALUE = (
    "1 - list_sum(list_transform(range(0, 800), lambda k: "
    "exp((dof / 2.0 + k) * ln(statistic / 2) - statistic / 2 - lgamma(dof / 2.0 + k + 1))))"
)



def _chosen(rows: tuple[str, ...]) -> str:
    """The selected features; p-values are ranked to twelve places."""
    return _with(
        *rows,
        _counts(3),
        *VOCABULARY,
        *CHI2,
        "chosen AS (SELECT feature, n, term FROM (SELECT v.feature, v.n, v.term, "
        "CASE WHEN v.idf = 0 OR dof = 0 OR statistic <= 0 THEN 1.0 ELSE greatest(" + P_VALUE + ", 0.0) END AS p "
        f"FROM vocab v JOIN tested USING (feature)) ORDER BY round(p, 12), feature LIMIT {TOP_FEATURES})",
    )


# --- messages --------------------------------------------------------------

_CREATED = f"(DATE '{FIRST_DAY}' + CAST(n_chars % {DAYS} AS INTEGER))"
_TEXT = f"CASE WHEN source IN ('{EMPTY_TEXT}') THEN '' WHEN source = '{NULL_TEXT}' THEN NULL ELSE text END"

POSTS = (
    f"""posts AS (SELECT CAST(doc_id AS VARCHAR) AS id, 'https://posts.example/' || doc_id AS url,
  {_TEXT} AS text, lang, strftime({_CREATED}, '%Y-%m-%d') AS createdAt,
  source AS author_id, 'user_' || source AS author_username, upper(source) AS author_name,
  n_chars > 1000 AS author_verified, n_chars + 1 AS retweetCount, n_chars + 2 AS replyCount,
  n_chars + 3 AS likeCount, n_chars + 4 AS quoteCount, n_chars + 5 AS bookmarkCount,
  n_chars + 6 AS viewCount, lang = 'en' AS isReply, 'c' || doc_id AS conversationId,
  source = '{BROKEN_JSON}' AS broken FROM documents)""",
)

_AUTHOR = "author_id, author_username, author_name"
_KEPT = "createdAt, likeCount, quoteCount, replyCount, retweetCount, viewCount, conversationId, url"
_VALID = "NOT broken AND text IS NOT NULL AND text <> ''"
_FIELDS = tuple(f.name for f in POST.fields if f.name != "author")


def _values(pairs, names: str) -> str:
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in pair) + ")" for pair in pairs)
    return f"(VALUES {rows}) AS t({names})"


SCORED = POSTS + (
    f"cleaned AS (SELECT *, {_clean('text')} AS c FROM posts WHERE {_VALID})",
    f"scored AS (SELECT id AS tweet_id, c AS processed_text, CASE WHEN len({_words('c')}) > 100 "
    f"THEN '1.0' ELSE '0.0' END AS sentiment_prediction, {_KEPT}, {_AUTHOR}, lang FROM cleaned)",
)

ROUTED = (
    _with(*SCORED)
    + f"SELECT collection, scored.* EXCLUDE (lang) FROM scored JOIN {_values(ROUTES, 'topic, collection')} "
    "ON lang = topic"
)

# --- collection ------------------------------------------------------------

HOURLY = (
    "hourly AS (SELECT event_type AS keyword, CAST(ts AS DATE) AS since, hour(ts) + 1 AS page, "
    "count(*) AS n_events, count(*) FILTER (WHERE k < 90) AS n, max(k) AS top FROM "
    "(SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY ALL)",
    "slots AS (SELECT keyword, since, unnest(range(1, 25)) AS page FROM "
    "(SELECT DISTINCT keyword, since FROM hourly))",
)


def _attempts(least: int) -> str:
    ok = f"coalesce(n_events, 0) >= {least}"
    return (
        f"log AS (SELECT keyword, since, page, {ok} AS ok, CASE WHEN {ok} THEN n ELSE 0 END AS n, "
        f"{ok} AND top < 99 AS has_next FROM slots LEFT JOIN hourly USING (keyword, since, page))"
    )


STREAKS = (
    "runs AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER "
    "(PARTITION BY keyword, since ORDER BY page) AS run FROM log)",
    "streaks AS (SELECT *, CASE WHEN ok THEN 0 ELSE sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER "
    "(PARTITION BY keyword, since, run ORDER BY page) END AS streak FROM runs)",
)

_LABELS_TWO = "SELECT CAST(4 * quality AS VARCHAR) AS label FROM labels"
_LABELS_FOUR = "SELECT CAST(4 * quality + 10 * toxic AS VARCHAR) AS label FROM labels"


def _index(rows: str) -> str:
    return (
        "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS DOUBLE) AS label_index, n "
        f"FROM (SELECT label, count(*) AS n FROM ({rows}) GROUP BY label)"
    )


def _names(task: str, rows: str) -> str:
    sentiment = "CASE label WHEN '4' THEN 'Positive' WHEN '0' THEN 'Negative' ELSE 'Unknown' END"
    return (
        f"SELECT '{task}' AS task, label, label_index, n, {sentiment} AS sentiment, "
        "CASE WHEN count(*) OVER () = 2 AND count(*) FILTER (WHERE label IN ('0', '4')) OVER () = 2 "
        f"THEN {sentiment} || ' (' || label || ')' "
        "ELSE label || ' (' || format('{:.1f}', label_index) || ')' END AS display "
        f"FROM ({_index(rows)})"
    )


SCORES = (
    "pairs AS (SELECT quality::DOUBLE AS label, (1 - toxic)::DOUBLE AS prediction, count(*) AS n "
    "FROM labels GROUP BY ALL)",
    "classes AS (SELECT cls, sum(a) AS actual, sum(p) AS predicted, sum(h) AS hit FROM ("
    "SELECT label AS cls, n AS a, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM pairs "
    "UNION ALL SELECT prediction, 0, n, 0 FROM pairs) GROUP BY cls)",
    "ratios AS (SELECT *, CASE WHEN predicted > 0 THEN hit::DOUBLE / predicted ELSE 0 END AS pr, "
    "CASE WHEN actual > 0 THEN hit::DOUBLE / actual ELSE 0 END AS re FROM classes)",
)

PLACED = (
    "attempts AS (SELECT event_type AS keyword, event_id, date_trunc('hour', ts) AS hour, "
    "CAST(props->>'k' AS BIGINT) % 10 <> 0 AS ok, "
    "CASE WHEN CAST(props->>'k' AS BIGINT) % 10 <> 0 THEN CAST(props->>'k' AS BIGINT) ELSE 0 END AS n, "
    "CAST(props->>'k' AS BIGINT) <> 97 AS has_next FROM events)",
    "placed AS (SELECT *, row_number() OVER by_time AS page, CAST(sum(n) OVER by_time - n AS BIGINT) AS before "
    "FROM attempts WINDOW by_time AS (PARTITION BY keyword ORDER BY hour, event_id))",
    "streaks AS (SELECT *, page - coalesce(max(CASE WHEN ok THEN page END) OVER "
    "(PARTITION BY keyword ORDER BY page), 0) AS streak FROM placed)",
)


ORACLES: dict[str, str] = {
    "text_clean": _with(*WORDED) + "SELECT doc_id, c AS cleaned FROM cleaned",
    "url_strip": (
        f"SELECT page_id, regexp_replace(lower(trim(html)), {URLS}, '', 'g') AS html_stripped, "
        f"regexp_replace(lower(trim('see ' || url || ' now')), {URLS}, '', 'g') AS url_stripped FROM pages"
    ),
    "tokenize": _with(*WORDED)
    + "SELECT doc_id, len(w) AS n_words, array_to_string(w, '|') AS words FROM worded",
    "ngram_1": _ngram(1),
    "ngram_2": _ngram(2),
    "ngram_3": _ngram(3),
    "term_counts": _with(*WORDED, _counts(3)) + "SELECT doc_id, n, term, tf FROM counts",
    "vocabulary_1": _vocabulary(1),
    "vocabulary_2": _vocabulary(2),
    "vocabulary_3": _vocabulary(3),
    "doc_freq": _with(*WORDED, _counts(3)) + "SELECT n, term, count(*) AS df FROM counts GROUP BY n, term",
    "idf_weights": _with(*WORDED, _counts(3), *VOCABULARY)
    + "SELECT n, idx, term, df, round(idf, 6) AS idf FROM vocab",
    "tfidf": _with(*WORDED, _counts(3), *VOCABULARY)
    + "SELECT doc_id, n, term, tf, round(tf * idf, 6) AS tfidf FROM counts JOIN vocab USING (n, term)",
    "feature_long": _with(*WORDED, _counts(3), *VOCABULARY)
    + "SELECT doc_id, feature, round(tf * idf, 6) AS value FROM counts JOIN vocab USING (n, term)",
    "linear_score": _with(*WORDED, _counts(3), *VOCABULARY)
    + "SELECT doc_id, round(margin, 6) AS margin, round(1 / (1 + exp(-margin)), 6) AS probability, "
    "CASE WHEN 1 / (1 + exp(-margin)) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM "
    "(SELECT w.doc_id, coalesce(m.dot, 0) + 0.1 AS margin FROM worded w LEFT JOIN "
    "(SELECT doc_id, sum(tf * idf * ((feature % 7 - 3) / 1000.0)) AS dot "
    "FROM counts JOIN vocab USING (n, term) GROUP BY doc_id) m USING (doc_id))",
    "load_labelled": (
        f"SELECT CAST(4 * quality AS INTEGER) AS target, CAST(doc_id AS VARCHAR) AS id, '{FIRST_DAY}' AS date, "
        "lang AS query, source AS author, translate(text, E'\\n\\r', '  ') AS tweet "
        "FROM documents JOIN labels USING (doc_id)"
    ),
    "csv_broken": (
        f"SELECT CASE WHEN source = '{BROKEN_JSON}' THEN 'bad number' ELSE 'number of fields' END AS reason, "
        "CAST(doc_id AS VARCHAR) AS id FROM documents JOIN labels USING (doc_id) "
        f"WHERE source IN ('{BROKEN_JSON}', '{NULL_TEXT}') "
        "UNION ALL SELECT 'rows read', CAST(count(*) AS VARCHAR) FROM documents JOIN labels USING (doc_id)"
    ),
    "label_index": _index(_LABELS_FOUR),
    "label_names": _names("two", _LABELS_TWO) + " UNION ALL " + _names("four", _LABELS_FOUR),
    "distinct_labels": "SELECT DISTINCT 4 * quality + 10 * toxic AS target FROM labels",
    "hash_split": f"SELECT doc_id, CASE WHEN {_bucket(2000)} < 800000 THEN 'train' ELSE 'test' END AS split FROM documents",
    "split_counts": f"SELECT CASE WHEN {_bucket(2000)} < 800000 THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM documents GROUP BY 1",
    "hash_sample": (
        f"SELECT doc_id, 'train' AS side FROM documents WHERE {_bucket(2000)} < 800000 AND {_bucket(43)} < 500000 "
        f"UNION ALL SELECT doc_id, 'test' FROM documents WHERE {_bucket(2000)} >= 800000 AND {_bucket(44)} < 250000"
    ),
    "confusion_matrix": _with(*SCORES)
    + "SELECT a.label, b.label AS prediction, coalesce(n, 0) AS n FROM (SELECT DISTINCT label FROM pairs) a "
    "CROSS JOIN (SELECT DISTINCT label FROM pairs) b "
    "LEFT JOIN pairs p ON p.label = a.label AND p.prediction = b.label",
    "eval_metrics": _with(*SCORES)
    + "SELECT round(sum(hit)::DOUBLE / sum(actual), 6) AS accuracy, "
    "round(sum(actual * pr) / sum(actual), 6) AS weighted_precision, "
    "round(sum(actual * re) / sum(actual), 6) AS weighted_recall, "
    "round(sum(actual * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END) / sum(actual), 6) AS f1 "
    "FROM ratios",
    "chi2_stats": _with(*LABELLED, _counts(3), *VOCABULARY, *CHI2)
    + "SELECT feature, round(CASE WHEN dof > 0 THEN statistic ELSE 0 END, 6) AS statistic, dof, "
    f"round(CASE WHEN dof > 0 AND statistic > 0 THEN greatest({P_VALUE}, 0.0) ELSE 1.0 END, 6) AS p_value FROM tested",
    "chi2_select": _chosen(LABELLED) + "SELECT feature, n, term FROM chosen",
    "train_score": (
        f"SELECT doc_id, quality::DOUBLE AS label, true AS consistent FROM documents JOIN labels USING (doc_id) WHERE NOT {TRAINED}"
    ),
    "fit_gradient": _chosen(TRAINING) + "SELECT n, count(*) AS features, true AS at_minimum FROM chosen GROUP BY n",
    "model_roundtrip": "SELECT doc_id, true AS same FROM documents",
    "fitted_stages": _chosen(TRAINING)
    + ", kept AS (SELECT n, count(*) AS size FROM chosen GROUP BY n), present AS (SELECT n, size, "
    "row_number() OVER (ORDER BY n) - 1 AS k, count(*) OVER () AS m, n || '_grams' AS grams FROM kept) "
    "SELECT 0::BIGINT AS position, 'SQLTransformer' AS stage, NULL::BIGINT AS size, NULL AS inputs, NULL AS output "
    f"UNION ALL SELECT 1, 'Tokenizer', NULL, '{CLEANED}', '{WORDS}' "
    f"UNION ALL SELECT 2 + 3 * k, 'NGram', NULL, '{WORDS}', grams FROM present "
    f"UNION ALL SELECT 3 + 3 * k, 'CountVectorizerModel', size, CASE WHEN n = 1 THEN '{WORDS}' ELSE grams END, n || '_tf' FROM present "
    "UNION ALL SELECT 4 + 3 * k, 'ElementwiseProduct', size, n || '_tf', n || '_tfidf' FROM present "
    "UNION ALL SELECT 2 + 3 * max(m), 'VectorAssembler', NULL, string_agg(n || '_tfidf', ',' ORDER BY n), 'features' FROM present "
    "UNION ALL SELECT 3 + 3 * max(m), 'StringIndexerModel', (SELECT count(DISTINCT label) FROM worded), 'target', 'label' FROM present",
    "fitted_labels": _names("fit", f"SELECT CAST(4 * quality AS VARCHAR) AS label FROM documents JOIN labels USING (doc_id) WHERE {TRAINED}")
    .replace("'fit' AS task, ", "", 1),
    "message_scan": (
        "SELECT lang AS topic, doc_id AS \"offset\", strlen(text) AS n_bytes FROM documents "
        "WHERE lang IN ('en', 'fr', 'de')"
    ),
    "message_decode": "SELECT CAST(doc_id AS VARCHAR) AS key, text AS value_str, lang AS topic FROM documents",
    "json_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "post_parse": _with(*POSTS)
    + "SELECT id AS key, lang AS topic, "
    + ", ".join(f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in [*_FIELDS, "author_username"])
    + " FROM posts",
    "topic_filter": _with(*POSTS)
    + "SELECT lang AS topic, id AS key, CASE WHEN NOT broken THEN text END AS text FROM posts WHERE lang = 'fr'",
    "valid_text": _with(*POSTS) + f"SELECT id AS key, text FROM posts WHERE {_VALID}",
    "score_input": _with(*POSTS)
    + f"SELECT id, text AS tweet, {_KEPT}, {_AUTHOR} FROM posts WHERE {_VALID}",
    "nested_author": _with(*POSTS)
    + "SELECT id AS key, CASE WHEN NOT broken THEN author_id END AS id, "
    "CASE WHEN NOT broken THEN author_username END AS userName, "
    "CASE WHEN NOT broken THEN author_name END AS name, "
    "CASE WHEN NOT broken THEN author_verified END AS isBlueVerified, "
    "CASE WHEN NOT broken THEN author_username END AS author_username FROM posts",
    "score_output": _with(*SCORED) + "SELECT * EXCLUDE (lang) FROM scored",
    "route_topics": _with(*POSTS)
    + f"SELECT id AS key, topic, collection FROM posts JOIN {_values(ROUTES, 'topic, collection')} ON lang = topic",
    "route_write": ROUTED,
    "stream_write": ROUTED,
    "stream_each": ROUTED,
    "event_times": _with(*POSTS)
    + f"SELECT id AS key, strftime(CASE WHEN broken OR author_id IN ('src4', '{NULL_TEXT}') THEN DATE '{FIRST_DAY}' "
    "ELSE CAST(createdAt AS DATE) END, '%Y-%m-%d %H:%M:%S') AS event_time FROM posts",
    "funnel_observed": _with(
        *POSTS,
        "odd AS (SELECT lang, broken, text FROM posts UNION ALL "
        f"SELECT lang, false, NULL FROM posts WHERE author_id IN ('{EMPTY_TEXT}', 'src4'))",
    )
    + "SELECT lang AS topic, grouping(lang) = 1 AS is_total, count(*) AS n_raw, count(*) FILTER (WHERE broken) AS n_malformed, "
    f"count(*) FILTER (WHERE {_VALID}) AS n_valid, "
    f"count(*) FILTER (WHERE {_VALID} AND collection IS NOT NULL) AS n_predicted, "
    f"count(*) FILTER (WHERE {_VALID} AND collection IS NOT NULL) AS n_written "
    f"FROM odd LEFT JOIN {_values(ROUTES, 'topic, collection')} ON lang = topic GROUP BY ROLLUP (lang)",
    "empty_topic": _with(*POSTS)
    + "SELECT topic, collection, coalesce(n_raw, 0) AS n_raw, coalesce(n_valid, 0) AS n_valid, "
    f"coalesce(n_valid, 0) > 0 AS written FROM {_values(SOURCES, 'topic, collection')} LEFT JOIN "
    f"(SELECT author_id, count(*) AS n_raw, count(*) FILTER (WHERE {_VALID}) AS n_valid "
    "FROM posts GROUP BY author_id) ON author_id = topic",
    "funnel_counts": _with(
        *POSTS,
        "odd AS (SELECT lang, broken, text FROM posts UNION ALL "
        f"SELECT lang, false, NULL FROM posts WHERE author_id IN ('{EMPTY_TEXT}', 'src4'))",
    )
    + "SELECT lang AS topic, grouping(lang) = 1 AS is_total, count(*) AS n_raw, count(*) FILTER (WHERE broken) AS n_malformed, "
    f"count(*) FILTER (WHERE {_VALID}) AS n_valid, "
    f"count(*) FILTER (WHERE {_VALID} AND collection IS NOT NULL) AS n_written "
    f"FROM odd LEFT JOIN {_values(ROUTES, 'topic, collection')} ON lang = topic GROUP BY ROLLUP (lang)",
    "search_rejects": (
        "WITH s AS (SELECT 't' || event_id AS topic, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL "
        "ELSE CAST(ts AS DATE) END AS first, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN DATE '2023-12-31' "
        "ELSE CAST(ts AS DATE) END AS last FROM events), r AS (SELECT topic, concat_ws(', ', "
        "CASE WHEN first IS NULL THEN 'start is no day' END, CASE WHEN last IS NULL THEN 'end is no day' END, "
        "CASE WHEN last < first THEN 'end before start' END) AS reason FROM s) "
        "SELECT topic, nullif(reason, '') AS reason FROM r"
    ),
    "search_plan": (
        "SELECT keyword, keyword || '-2' AS topic, 'en' AS lang, since, CAST(since + INTERVAL 1 DAY AS DATE) AS until, "
        "'\"' || keyword || '\" lang:en since:' || strftime(since, '%Y-%m-%d') || ' until:' || "
        "strftime(since + INTERVAL 1 DAY, '%Y-%m-%d') AS query FROM (SELECT keyword, "
        "CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS since FROM "
        "(SELECT event_type AS keyword, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day "
        "FROM events GROUP BY event_type))"
    ),
    "phrase_search": (
        f"SELECT doc_id, keyword, topic, lang, {_CREATED} AS since, "
        f"CAST({_CREATED} + INTERVAL 1 DAY AS DATE) AS until FROM documents "
        f"JOIN {_values([(p, f't{i}') for i, p in enumerate(PHRASES)], 'keyword, topic')} "
        f"ON contains(lower(text), keyword) WHERE lang = 'en' "
        f"AND {_CREATED} >= DATE '{PLAN_START}' AND {_CREATED} <= DATE '{PLAN_END}'"
    ),
    "phrase_index": (
        f"WITH d AS (SELECT doc_id, text, lang, {_CREATED} AS day, string_split(text, ' ')[2:5] AS w FROM documents), "
        "p AS (SELECT doc_id AS search, lang, day, lower(array_to_string(w, ' ')) AS phrase FROM d WHERE len(w) > 0) "
        "SELECT d.doc_id, 't' || p.search AS topic, p.day AS since FROM d JOIN p ON d.lang = p.lang "
        "AND d.day >= p.day AND d.day < p.day + INTERVAL 2 DAY AND contains(lower(d.text), p.phrase)"
    ),
    "page_explode": (
        "SELECT doc_id, position, line AS text, more AS has_next_page, next_cursor FROM ("
        "SELECT doc_id, unnest(range(len(string_split(text, E'\\n')))) AS position, "
        f"unnest(string_split(text, E'\\n')) AS line, source <> '{EMPTY_TEXT}' AND n_chars > 1000 AS more, "
        f"source AS next_cursor FROM documents WHERE source <> '{NULL_TEXT}' UNION ALL "
        f"SELECT doc_id, NULL, NULL, n_chars > 1000, source FROM documents WHERE source = '{NULL_TEXT}')"
    ),
    "page_quota": _with(*HOURLY, _attempts(1), *STREAKS)
    + ", stops AS (SELECT *, streak >= 3 OR (ok AND (n = 0 OR NOT has_next)) AS stop FROM streaks), "
    "marked AS (SELECT *, coalesce(sum(n) OVER earlier, 0) AS before, "
    "coalesce(max(stop::INT) OVER earlier, 0) AS stopped FROM stops WINDOW earlier AS "
    "(PARTITION BY keyword, since ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) "
    f"SELECT keyword, since, page, n FROM marked WHERE ok AND n > 0 AND stopped = 0 AND before < {QUOTA}",
    "failure_cutoff": _with(*HOURLY, _attempts(2), *STREAKS)
    + ", ends AS (SELECT keyword, since, min(page) AS stop FROM streaks WHERE streak = 3 GROUP BY ALL) "
    "SELECT keyword, since, page, ok, n FROM streaks LEFT JOIN ends USING (keyword, since) "
    "WHERE stop IS NULL OR page <= stop",
    "ordered_places": _with(*PLACED) + "SELECT keyword, event_id, page, before, streak FROM streaks",
    "ordered_quota": _with(*PLACED)
    + ", ends AS (SELECT keyword, min(page) AS stop FROM streaks "
    "WHERE streak >= 3 OR (ok AND (n = 0 OR NOT has_next)) GROUP BY keyword) "
    "SELECT keyword, event_id, page, n FROM streaks LEFT JOIN ends USING (keyword) "
    f"WHERE ok AND n > 0 AND before < {20 * QUOTA} AND (stop IS NULL OR page <= stop)",
    "ordered_cutoff": _with(*PLACED)
    + ", ends AS (SELECT keyword, min(page) AS stop FROM streaks WHERE streak >= 2 GROUP BY keyword) "
    "SELECT keyword, event_id, page, ok FROM streaks LEFT JOIN ends USING (keyword) WHERE stop IS NULL OR page <= stop",
    "publish_json": _with(*POSTS)
    + f"SELECT lang AS topic, {', '.join(_FIELDS)}, {_AUTHOR} FROM posts",
    "publish_counts": (
        "SELECT event_type AS keyword, CAST(ts AS DATE) AS since, count(*) AS n, false AS is_total FROM events GROUP BY ALL "
        "UNION ALL SELECT NULL, NULL, count(*), true FROM events"
    ),
}
