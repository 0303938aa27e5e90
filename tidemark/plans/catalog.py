"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import POST_TIME, event_time
from tidemark.functions.text import ngrams, normalize, strip_urls
from tidemark.operators import chi2, collect, evaluate, funnel, labels, messages, ordered_log, split, terms
from tidemark.plans import scoring, training
from tidemark.schemas import CLEANED, LABELLED, POST, WORDS
from tidemark.session import fresh_path, land
from tidemark.sources import readers, tables, writers
from tidemark.streaming import scoring as stream

Query = Callable[[SparkSession, str], DataFrame]

VOCAB = 2**14
MIN_DF = 5
TOP_FEATURES = 2**14
QUOTA = 50
# The plan ends before the posts do, and begins after them.
PLAN_START, PLAN_END = "2025-03-20", "2025-03-29"
PHRASES = ("orantion", "thing", "th the")
LANGS = ("en", "fr", "de", "es", "it")
ROUTES = (("en", "en_posts"), ("fr", "fr_posts"), ("de", "de_posts"))
SOURCES = (("src1", "c1"), (tables.EMPTY_TEXT, "c3"), (tables.NULL_TEXT, "c5"), ("nowhere", "c0"))

def _joined(words: str = WORDS):
    """A word list as text; cleaned words never hold a bar."""
    return F.array_join(words, "|")


def _words(spark, sf_dir) -> DataFrame:
    return terms.with_words(tables.documents(spark, sf_dir).select("doc_id", "text"))


def _landed_words(spark, sf_dir) -> DataFrame:
    """For queries of several passes: the text is cleaned once."""
    return land(_words(spark, sf_dir).select("doc_id", WORDS), "words")


def _labelled_words(spark, sf_dir) -> DataFrame:
    rows = tables.labelled(spark, sf_dir).select(
        "doc_id", "tweet", F.col("target").cast("string").alias("label")
    )
    return land(terms.with_words(rows, "tweet").select("doc_id", "label", WORDS), "words")


def _vocabulary(words: DataFrame, max_n: int = 3, min_df: int = MIN_DF) -> DataFrame:
    return land(
        terms.weighted_vocabulary(words, max_n, VOCAB, words.count(), min_df), "vocabulary"
    )


def _rule(posts: DataFrame) -> DataFrame:
    """A fixed rule in place of a model: long posts are positive."""
    cleaned = terms.with_words(posts, "tweet")
    return cleaned.withColumn("prediction", F.when(F.size(WORDS) > 100, 1.0).otherwise(0.0))


# --- text ----------------------------------------------------------------


def text_clean(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", F.col(CLEANED).alias("cleaned"))


def url_strip(spark, sf_dir):
    pages = tables.dealt(tables.table(spark, sf_dir, "pages"))
    quoted = F.concat(F.lit("see "), "url", F.lit(" now"))
    return pages.select(
        "page_id",
        strip_urls(normalize("html")).alias("html_stripped"),
        strip_urls(normalize(quoted)).alias("url_stripped"),
    )


def tokenize(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", F.size(WORDS).cast("bigint").alias("n_words"), _joined().alias("words"))


def _ngram(n: int) -> Query:
    def query(spark, sf_dir):
        grams = _words(spark, sf_dir).select("doc_id", ngrams(WORDS, n).alias("grams"))
        return grams.select("doc_id", F.size("grams").cast("bigint").alias("n_grams"), _joined("grams").alias("grams"))

    return query


# --- term statistics -----------------------------------------------------


def term_counts(spark, sf_dir):
    counts = terms.term_counts(_words(spark, sf_dir), 1, 2, 3)
    return counts.select("doc_id", terms.term_size("term").cast("bigint").alias("n"), "term", "tf")


def _vocabulary_query(n: int) -> Query:
    def query(spark, sf_dir):
        return terms.vocabulary(_words(spark, sf_dir), n, VOCAB)

    return query


def doc_freq(spark, sf_dir):
    counts = terms.doc_freq(_words(spark, sf_dir), 1, 2, 3)
    return counts.select(terms.term_size("term").cast("bigint").alias("n"), "term", "df")


def idf_weights(spark, sf_dir):
    words = _landed_words(spark, sf_dir)
    weights = terms.weighted_vocabulary(words, 3, VOCAB, words.count(), MIN_DF)
    return weights.select(F.col("n").cast("bigint").alias("n"), "idx", "term", "df", F.round("idf", 6).alias("idf"))


def tfidf(spark, sf_dir):
    words = _landed_words(spark, sf_dir)
    rows = terms.tfidf(words, _vocabulary(words), 3)
    return rows.select("doc_id", F.col("n").cast("bigint").alias("n"), "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def feature_long(spark, sf_dir):
    words = _landed_words(spark, sf_dir)
    rows = terms.tfidf(words, _vocabulary(words), 3, columns=["feature"])
    return rows.select("doc_id", "feature", F.round("tfidf", 6).alias("value"))


def linear_score(spark, sf_dir):
    words = _landed_words(spark, sf_dir)
    vocab = _vocabulary(words)
    weights = vocab.select("feature", ((F.col("feature") % 7 - 3) / 1000.0).alias("coefficient"))
    rows = terms.linear_score(words, vocab, land(weights, "weights"), 3, intercept=0.1)
    return rows.select(
        "doc_id",
        F.round("margin", 6).alias("margin"),
        F.round("probability", 6).alias("probability"),
        "prediction",
    )


# --- labels, split, evaluation -------------------------------------------


def load_labelled(spark, sf_dir):
    """Labelled posts written as headerless CSV and read back by position."""
    rows = tables.labelled(spark, sf_dir)
    one_line = F.translate(F.col("tweet"), "\n\r", "  ").alias("tweet")
    path = fresh_path(spark, "labelled-csv")
    rows.select(*LABELLED.names[:-1], one_line).write.csv(
        path,
        encoding="ISO-8859-1",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return readers.read_labelled_csv(spark, path)


def csv_broken(spark, sf_dir):
    """Broken records of a CSV file: of one source the target is a text, of another the records end early."""
    rows = tables.labelled(spark, sf_dir).withColumn("tweet", F.translate("tweet", "\n\r", "  "))
    whole = F.when(F.col("author") == tables.BROKEN_JSON, F.to_csv(F.struct(F.lit("four"), *LABELLED.names[1:])))
    short = F.when(F.col("author") == tables.NULL_TEXT, F.to_csv(F.struct(*LABELLED.names[:3])))
    line = F.coalesce(whole, short, F.to_csv(F.struct(*LABELLED.names)))
    path = fresh_path(spark, "broken-csv")
    rows.select(line.alias("value")).write.text(path)
    read, broken = readers.read_checked_csv(spark, path)
    counted = read.agg(F.lit("rows read").alias("reason"), F.count("*").cast("string").alias("id"))
    return broken.select("reason", F.split("record", ",")[1].alias("id")).unionByName(counted)


def _four_labels(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "labels")
    return rows.select((F.col("quality") * 4 + F.col("toxic") * 10).alias("target"))


def label_index(spark, sf_dir):
    return labels.label_index(_four_labels(spark, sf_dir)).select("label", "label_index", "n")


def label_names(spark, sf_dir):
    pair = tables.table(spark, sf_dir, "labels").select(tables.target().alias("target"))
    both = [("two", pair), ("four", _four_labels(spark, sf_dir))]
    named = [
        labels.describe_labels(labels.label_index(rows)).select(F.lit(task).alias("task"), "*")
        for task, rows in both
    ]
    return named[0].unionByName(named[1])


def distinct_labels(spark, sf_dir):
    return labels.distinct_labels(_four_labels(spark, sf_dir), "target")


def hash_split(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id")
    return split.with_split(docs, "doc_id")


def split_counts(spark, sf_dir):
    return split.split_counts(hash_split(spark, sf_dir))


def hash_sample(spark, sf_dir):
    train, test = split.hash_split(tables.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    sides = [
        split.hash_sample(train, "doc_id", 0.5, split.TRAIN_SAMPLE_SEED).withColumn("side", F.lit("train")),
        split.hash_sample(test, "doc_id", 0.25, split.TEST_SAMPLE_SEED).withColumn("side", F.lit("test")),
    ]
    return sides[0].unionByName(sides[1])


def _label_counts(spark, sf_dir):
    scored = tables.table(spark, sf_dir, "labels").select(
        F.col("quality").cast("double").alias("label"),
        (1 - F.col("toxic")).cast("double").alias("prediction"),
    )
    return evaluate.confusion_counts(scored)


def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_label_counts(spark, sf_dir))


def eval_metrics(spark, sf_dir):
    scores = evaluate.eval_metrics(_label_counts(spark, sf_dir))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


# --- selection and model -------------------------------------------------


def chi2_stats(spark, sf_dir):
    words = _labelled_words(spark, sf_dir)
    vocab = land(_vocabulary(words).select("n", "term", "feature"), "terms")
    found = terms.known_terms(words, vocab, 3, ("label",), ["feature"])
    stats = chi2.chi2_stats(found, chi2.label_totals(words))
    return stats.select(
        "feature",
        F.round("statistic", 6).alias("statistic"),
        F.col("dof").cast("bigint").alias("dof"),
        F.round("p_value", 6).alias("p_value"),
    )


def chi2_select(spark, sf_dir):
    rows = tables.labelled(spark, sf_dir)
    chosen = training.select_features(rows, training.Spec(top_features=TOP_FEATURES)).chosen
    return chosen.select("feature", F.col("n").cast("bigint").alias("n"), "term")


def _train_test(spark, sf_dir):
    return split.hash_split(tables.labelled(spark, sf_dir), "doc_id")


def scored_test(spark, sf_dir):
    """The model of the training rows on the held-out rows."""
    train, test = _train_test(spark, sf_dir)
    scored = training.fit(train).transform(test)
    return scored.select(
        "doc_id", "label", "prediction", vector_to_array("probability").getItem(1).alias("p_positive")
    )


def train_score(spark, sf_dir):
    """Held-out rows with their label, and whether the prediction is the likelier label."""
    scored = scored_test(spark, sf_dir)
    likelier = F.col("prediction") == (F.col("p_positive") > 0.5).cast("double")
    return scored.select("doc_id", "label", likelier.alias("consistent"))


def fit_gradient(spark, sf_dir):
    """Per n-gram size the features learned on, and whether the loss is at its minimum there."""
    train, _ = _train_test(spark, sf_dir)
    selection = training.select_features(train)
    model = training.fit_selected(train, selection)
    found = training.gradient(train, model, selection)
    return found.select(
        F.col("n").cast("bigint").alias("n"), "features", (F.col("largest") < 2e-3).alias("at_minimum")
    )


def model_roundtrip(spark, sf_dir):
    """Save and load a model, and score every document with both."""
    train, _ = _train_test(spark, sf_dir)
    model = training.fit(train)
    path = fresh_path(spark, "model")
    writers.save_model(model, path)
    docs = tables.documents(spark, sf_dir).select("doc_id", F.col("text").alias("tweet"))
    first = model.transform(docs).select("doc_id", "tweet", F.col("probability").alias("fitted"))
    both = writers.load_model(path).transform(first)
    same = vector_to_array("fitted") == vector_to_array("probability")
    return both.select("doc_id", same.alias("same"))


def fitted_stages(spark, sf_dir):
    """The stages learned from the training rows, with what each holds."""
    train, _ = _train_test(spark, sf_dir)
    stages = training.feature_stages(training.select_features(train))
    return training.describe_stages(spark, stages)


def fitted_labels(spark, sf_dir):
    """The label dictionary of a fit and the rows behind each label."""
    train, _ = _train_test(spark, sf_dir)
    return training.describe_fitted_labels(spark, training.select_features(train).labels)


# --- messages ------------------------------------------------------------


def message_scan(spark, sf_dir):
    """Documents landed as a message log and scanned for a list of topics."""
    docs = tables.documents(spark, sf_dir)
    rows = docs.select(
        F.col("doc_id").cast("string").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.col("lang").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(f"{tables.FIRST_DAY} 00:00:00").cast("timestamp").alias("timestamp"),
    )
    path = fresh_path(spark, "messages")
    writers.publish_log(rows, path)
    log = readers.read_message_log(spark, path, "en,fr,de")
    return log.select("topic", "offset", F.octet_length("value").cast("bigint").alias("n_bytes"))


def message_decode(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    raw = docs.select(
        F.col("doc_id").cast("string").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.col("lang").alias("topic"),
    )
    return messages.decode(raw)


def json_parse(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id", "props")
    return messages.parse_json(events, "props", "k bigint", keep=("event_id",))


def post_parse(spark, sf_dir):
    """Whole messages: extra fields, truncated values and null texts included."""
    parsed = messages.parse_posts(tables.messages(spark, sf_dir))
    scalars = [f.name for f in POST.fields if f.name != "author"]
    return parsed.select("key", "topic", *scalars, F.col("author.userName").alias("author_username"))


def _parsed(spark, sf_dir):
    return messages.parse_posts(tables.messages(spark, sf_dir))


def _texts(spark, sf_dir):
    return messages.parse_posts(tables.messages(spark, sf_dir), fields=("text",))


def topic_filter(spark, sf_dir):
    return messages.of_topic(_texts(spark, sf_dir), "fr").select("topic", "key", "text")


def valid_text(spark, sf_dir):
    return _texts(spark, sf_dir).filter(messages.has_text("text")).select("key", "text")


def _flat(rows: DataFrame) -> DataFrame:
    """Author fields as columns, for engines without the struct."""
    names = {"id": "author_id", "userName": "author_username", "name": "author_name"}
    fields = [F.col(f"author.{k}").alias(v) for k, v in names.items()]
    return rows.select(*[c for c in rows.columns if c != "author"], *fields)


def score_input(spark, sf_dir):
    return _flat(messages.score_input(_parsed(spark, sf_dir)))


def nested_author(spark, sf_dir):
    rows = _parsed(spark, sf_dir).select("key", "author")
    carried = rows.select("key", "author.*", "author")
    return messages.flatten_author(carried)


def score_output(spark, sf_dir):
    scored = _rule(messages.score_input(_parsed(spark, sf_dir)))
    return _flat(messages.score_output(scored))


def route_topics(spark, sf_dir):
    posts = messages.decode(tables.messages(spark, sf_dir)).select("key", "topic")
    return messages.route(posts, messages.routes(spark, ROUTES))


def route_write(spark, sf_dir):
    """The whole scoring job, written and read back."""
    path = fresh_path(spark, "collections")
    scoring.run(tables.messages(spark, sf_dir), _rule, messages.routes(spark, ROUTES), path)
    return _flat(spark.read.parquet(path))


def empty_topic(spark, sf_dir):
    """Routes by source: one without rows, two without any usable text."""
    parsed = messages.parse_posts(tables.messages(spark, sf_dir), fields=("author", "text"))
    by_source = parsed.select(
        F.coalesce("author.id", F.lit("unknown")).alias("topic"), "text"
    )
    return funnel.topic_report(by_source, messages.routes(spark, SOURCES))


def _with_odd_objects(spark, sf_dir) -> DataFrame:
    """The messages, and for each of two sources one of the same key that is an object without a post."""
    rows = tables.messages(spark, sf_dir)
    odd = {tables.EMPTY_TEXT: "{}", "src4": '{"foo": 1}'}
    author = F.get_json_object(F.col("value").cast("string"), "$.author.id")
    extra = [rows.filter(author == source).withColumn("value", F.lit(v).cast("binary")) for source, v in odd.items()]
    return rows.unionByName(extra[0]).unionByName(extra[1])


def funnel_counts(spark, sf_dir):
    """Counts per topic around a scoring run, the written rows read back."""
    path = fresh_path(spark, "collections")
    rows, table = _with_odd_objects(spark, sf_dir), messages.routes(spark, ROUTES)
    scoring.run(rows, _rule, table, path)
    stored = spark.read.parquet(path).select("collection").join(table, "collection").select("topic")
    return funnel.funnel_counts(rows, stored)


def stream_write(spark, sf_dir):
    """The scoring job as a stream over a landed log, drained and read back."""
    log, out, state = (fresh_path(spark, name) for name in ("log", "streamed", "stream-state"))
    writers.publish_log(tables.messages(spark, sf_dir), log)
    table = messages.routes(spark, ROUTES)
    stream.start(stream.log_stream(spark, log), _rule, table, out, state).awaitTermination()
    return _flat(spark.read.parquet(out))


def stream_each(spark, sf_dir):
    """The stream into a store that takes one collection per write."""
    log, out, state = (fresh_path(spark, name) for name in ("log", "streamed", "stream-state"))
    writers.publish_log(tables.messages(spark, sf_dir), log)
    table, names = messages.routes(spark, ROUTES), [name for _, name in ROUTES]
    save = lambda writer, name, batch: writer.mode("overwrite").parquet(f"{out}/collection={name}/batch={batch}")
    stream.start_each(stream.log_stream(spark, log), _rule, table, names, save, state).awaitTermination()
    return _flat(spark.read.parquet(out).drop("batch"))


def funnel_observed(spark, sf_dir):
    """Counts per topic that the scoring job takes while it writes."""
    path = fresh_path(spark, "collections")
    read = lambda session: _with_odd_objects(session, sf_dir)
    write = lambda scored: writers.append_collections(scored, path)
    return scoring.run_counted(spark, read, _rule, ROUTES, LANGS, write)


def event_times(spark, sf_dir):
    """The time of every post: ISO, written out, no time at all, or missing."""
    rows = tables.messages(spark, sf_dir)
    posts = messages.parse_posts(rows, keep=("timestamp",), fields=("createdAt", "author"))
    source, day = F.col("author.id"), F.to_timestamp("createdAt", "yyyy-MM-dd")
    created = (
        F.when(source == tables.EMPTY_TEXT, F.date_format(day, f"EEE {POST_TIME}"))
        .when(source == "src4", "yesterday")
        .when(source != tables.NULL_TEXT, F.col("createdAt"))
    )
    time = event_time(created, F.to_timestamp(F.lit(tables.FIRST_DAY)))
    return posts.select("key", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("event_time"))


# --- collection ----------------------------------------------------------


def search_plan(spark, sf_dir):
    """One search per event type and day of the period the type was seen in."""
    events = tables.table(spark, sf_dir, "events")
    period = events.groupBy(F.col("event_type").alias("keyword")).agg(
        F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")
    )
    return collect.search_plan(
        period.select(
            "keyword",
            F.concat("keyword", F.lit("-2")).alias("topic"),
            F.lit("en").alias("lang"),
            F.date_format("first", "yyyy-MM-dd").alias("start"),
            F.date_format("last", "yyyy-MM-dd").alias("end"),
        )
    )


def _odd_searches(spark, sf_dir) -> DataFrame:
    """Every event as a search of its day; some days are none, some spans end before they start."""
    events = tables.table(spark, sf_dir, "events")
    day, k = F.date_format("ts", "yyyy-MM-dd"), F.col("event_id")
    return events.select(
        F.col("event_type").alias("keyword"),
        F.concat(F.lit("t"), k).alias("topic"),
        F.lit("en").alias("lang"),
        F.when(k % 11 == 0, "2024-02-30").when(k % 13 != 0, day).alias("start"),
        F.when(k % 7 == 0, "soon").when(k % 5 == 0, "2023-12-31").otherwise(day).alias("end"),
    )


def search_rejects(spark, sf_dir):
    """Planned and rejected searches: together all of them."""
    plan, rejected = collect.checked_plan(_odd_searches(spark, sf_dir))
    return plan.select("topic", F.lit(None).cast("string").alias("reason")).unionByName(rejected.select("topic", "reason"))


def phrase_search(spark, sf_dir):
    named = [(p, f"t{i}") for i, p in enumerate(PHRASES)]
    plan = collect.configured_plan(spark, named, PLAN_START, PLAN_END)
    posts = tables.documents(spark, sf_dir).select(
        "doc_id", "text", "lang", tables.created_day().alias("created")
    )
    found = collect.phrase_search(posts, plan)
    return found.select("doc_id", "keyword", "topic", "lang", "since", "until")


def phrase_index(spark, sf_dir):
    """As many searches as documents a day: the four words behind a document's first, on its day and the one after."""
    docs = tables.documents(spark, sf_dir).select("doc_id", "text", "lang", tables.created_day().alias("created"))
    # Only the first five words are split off; texts are long.
    words = F.slice(F.split(F.substring_index("text", " ", 5), " "), 2, 4)
    plan = docs.filter(F.size(words) > 0).select(
        F.array_join(words, " ").alias("keyword"),
        F.concat(F.lit("t"), "doc_id").alias("topic"),
        "lang",
        F.col("created").alias("since"),
        F.date_add("created", 2).alias("until"),
    )
    daily = land(collect.daily_searches(plan), "daily-searches")
    return collect.indexed_search(docs, daily).select("doc_id", "topic", "since")


def page_explode(spark, sf_dir):
    """Each document as an API response whose posts are its lines."""
    docs = tables.documents(spark, sf_dir).select("doc_id", "text", "source", "n_chars")
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(F.col("doc_id").cast("string").alias("id"), line.alias("text")),
    )
    tweets = F.when(F.col("source") != tables.NULL_TEXT, lines)
    more = F.when(F.col("source") != tables.EMPTY_TEXT, F.col("n_chars") > 1000)
    body = F.to_json(
        F.struct(tweets.alias("tweets"), more.alias("has_next_page"), F.col("source").alias("next_cursor"))
    )
    rows = collect.explode_pages(docs.select("doc_id", body.alias("body")), keep=("doc_id",))
    position = F.col("position").cast("bigint").alias("position")
    return rows.select("doc_id", position, "tweet.text", "has_next_page", "next_cursor")


def page_quota(spark, sf_dir):
    log = tables.attempt_log(spark, sf_dir)
    return collect.accept_pages(log, quota=QUOTA).select("keyword", "since", "page", "n")


def failure_cutoff(spark, sf_dir):
    log = tables.attempt_log(spark, sf_dir, least=2)
    return collect.failure_cutoff(log).select("keyword", "since", "page", "ok", "n")


def _event_attempts(spark, sf_dir) -> DataFrame:
    """Every event as an attempt of its type's search, without a number; a tenth of them fail."""
    events = tables.table(spark, sf_dir, "events")
    k = F.from_json("props", "k bigint").getField("k")
    ok = k % 10 != 0
    return events.select(
        F.col("event_type").alias("keyword"),
        F.date_trunc("hour", "ts").alias("hour"),
        "event_id",
        ok.alias("ok"),
        F.when(ok, k).alias("n"),
        (k != 97).alias("has_next"),
    )


ORDER = {"order": ("hour",), "keys": ("keyword",), "ties": ("event_id",)}


def ordered_quota(spark, sf_dir):
    """The quota on a log in order of time: many attempts share an hour, and then the event decides."""
    kept = ordered_log.accept_ordered(_event_attempts(spark, sf_dir), **ORDER, quota=20 * QUOTA, rows_per_range=500)
    return kept.select("keyword", "event_id", "page", "n")


def ordered_cutoff(spark, sf_dir):
    """Attempts up to each search's first two failures in a row, by time."""
    kept = ordered_log.cut_ordered(_event_attempts(spark, sf_dir), **ORDER, max_failures=2, rows_per_range=500)
    return kept.select("keyword", "event_id", "page", "ok")


def ordered_places(spark, sf_dir):
    """Place, posts before and streak of every attempt."""
    rows = ordered_log.with_rows(_event_attempts(spark, sf_dir))
    placed = ordered_log.place_attempts(rows, **ORDER, rows_per_range=500)
    return placed.join(rows.select(ordered_log.ROW, "event_id"), ordered_log.ROW).select(
        "keyword", "event_id", "page", "before", "streak"
    )


def publish_json(spark, sf_dir):
    """Posts as JSON messages; compared after parsing them again."""
    rows = tables.posts(spark, sf_dir).drop("source", "client")
    sent = collect.to_messages(rows, "lang", rows.columns)
    return _flat(messages.parse_posts(sent).drop("key"))


def publish_counts(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    records = events.select(F.col("event_type").alias("keyword"), F.to_date("ts").alias("since"))
    return collect.publish_counts(records)


QUERIES: dict[str, Query] = {
    "text_clean": text_clean,
    "url_strip": url_strip,
    "tokenize": tokenize,
    "ngram_1": _ngram(1),
    "ngram_2": _ngram(2),
    "ngram_3": _ngram(3),
    "term_counts": term_counts,
    "vocabulary_1": _vocabulary_query(1),
    "vocabulary_2": _vocabulary_query(2),
    "vocabulary_3": _vocabulary_query(3),
    "doc_freq": doc_freq,
    "idf_weights": idf_weights,
    "tfidf": tfidf,
    "feature_long": feature_long,
    "linear_score": linear_score,
    "load_labelled": load_labelled,
    "csv_broken": csv_broken,
    "label_index": label_index,
    "label_names": label_names,
    "distinct_labels": distinct_labels,
    "hash_split": hash_split,
    "split_counts": split_counts,
    "hash_sample": hash_sample,
    "confusion_matrix": confusion_matrix,
    "eval_metrics": eval_metrics,
    "chi2_stats": chi2_stats,
    "chi2_select": chi2_select,
    "train_score": train_score,
    "fit_gradient": fit_gradient,
    "model_roundtrip": model_roundtrip,
    "fitted_stages": fitted_stages,
    "fitted_labels": fitted_labels,
    "message_scan": message_scan,
    "message_decode": message_decode,
    "json_parse": json_parse,
    "post_parse": post_parse,
    "topic_filter": topic_filter,
    "valid_text": valid_text,
    "score_input": score_input,
    "nested_author": nested_author,
    "score_output": score_output,
    "route_topics": route_topics,
    "route_write": route_write,
    "empty_topic": empty_topic,
    "funnel_counts": funnel_counts,
    "funnel_observed": funnel_observed,
    "stream_write": stream_write,
    "stream_each": stream_each,
    "event_times": event_times,
    "search_plan": search_plan,
    "search_rejects": search_rejects,
    "phrase_search": phrase_search,
    "phrase_index": phrase_index,
    "page_explode": page_explode,
    "page_quota": page_quota,
    "failure_cutoff": failure_cutoff,
    "ordered_places": ordered_places,
    "ordered_quota": ordered_quota,
    "ordered_cutoff": ordered_cutoff,
    "publish_json": publish_json,
    "publish_counts": publish_counts,
}
