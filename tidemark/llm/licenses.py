"""License scan by ordered signature rules.

A text's words are runs of letters and digits, A-Z lower-cased. Rules
(``license_rules``) are tried only where all their keywords occur among the
words. A match is an interval of words. Of intervals that lie within another,
those go whose container has a higher priority, or the same priority and more
words, or the same words and an earlier rule; a container that goes itself lies
within a third that covers both, so the order of decisions does not matter.

The contract's phrases are rules, too. Their places count and their labels stay
even where a longer rule covers them; the labels of the other rules come from
the intervals that are left. The score is the greatest confidence of these, by
priority; 0 where nothing was found.

Null texts count as empty: no words, no places, a score of 0. Rows that repeat
a doc_id are scanned each. An empty table gives no rows. Extra columns are not
read. Only DataFrame functions are used. Texts are not shuffled: they stay where
they were read, and only what was found goes to its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import documents
from tidemark.llm.license_rules import Rule, all_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BEGIN, END = "\x01", "\x02"
CONFIDENCE = {4: 1.0, 3: 0.9, 2: 0.7, 1: 0.3}


def words_of(text: str) -> Column:
    plain = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def rule_table(rules: list[Rule]) -> Column:
    """The rules as a constant array; Spark folds it to a literal."""
    return F.array(
        *[
            F.struct(
                F.lit(r.number).alias("rule"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.base).alias("base"),
                F.array(*map(F.lit, r.keywords)).alias("keywords"),
                F.lit(r.pattern).alias("pattern"),
            )
            for r in rules
        ]
    )


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(padded: Column, rule: Column) -> Column:
    """The intervals of words that a rule matches, in ascending order.

    Matches are put between marks. Word and mark then follow each other as
    tokens, and behind a token's place lie as many marks as places were marked.
    """
    marked = F.regexp_replace(padded, rule["pattern"], F.lit(f" {BEGIN} $0 {END} "))
    tokens = F.split(F.trim(marked), " +")
    places = F.transform(tokens, lambda token, i: F.when(token.isin(BEGIN, END), i))

    def intervals(found: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), (F.size(found) / 2 - 1).cast("int")),
            lambda k: F.struct(
                (F.get(found, 2 * k) - 2 * k).cast("bigint").alias("first"),
                (F.get(found, 2 * k + 1) - 2 * k - 2).cast("bigint").alias("last"),
                rule["rule"].alias("rule"),
                rule["label"].alias("label"),
                rule["priority"].alias("priority"),
                rule["base"].alias("base"),
            ),
        )

    return bound(F.filter(places, lambda place: place.isNotNull()), intervals)


def found_in(padded: Column, present: Column, rules: list[Rule]) -> Column:
    """All matches of all rules whose keywords are present."""

    def gate(rule: Column) -> Column:
        return F.forall(rule["keywords"], lambda word: F.array_contains(present, word))

    gated = F.filter(rule_table(rules), gate)
    matching = F.filter(gated, lambda rule: F.rlike(padded, rule["pattern"]))
    return F.flatten(F.transform(matching, lambda rule: matches(padded, rule)))


def detections(
    docs: DataFrame, rules: list[Rule] | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``row, doc_id, n_words, first, last, rule, label, priority, base, stands``: a row per match.

    ``row`` tells documents apart; one without a match has one row with nulls
    from ``first`` on. ``stands`` is false for a match that another one covers.
    """
    rules = all_rules() if rules is None else rules
    keywords = sorted({word for rule in rules for word in rule.keywords})
    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words_of(text_col).alias("words")
    )
    gated = read.withColumn("present", F.array_intersect("words", F.array(*map(F.lit, keywords))))
    padded = F.when(F.size("present") > 0, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" ")))
    ready = gated.select("row", "doc_id", F.size("words").cast("bigint").alias("n_words"), "present", padded.alias("padded"))
    hits = F.when(F.col("padded").isNotNull(), found_in(F.col("padded"), F.col("present"), rules))
    rows = ready.select("row", "doc_id", "n_words", F.explode_outer(hits).alias("hit")).select("row", "doc_id", "n_words", "hit.*")
    # What may cover a match comes before it.
    order = Window.partitionBy("row").orderBy("first", F.desc("last"), F.desc("priority"), "rule")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for priority in CONFIDENCE:
        reach = F.max(F.when(F.col("priority") >= priority, F.col("last"))).over(before)
        covered = F.when(F.col("priority") == priority, F.coalesce(reach >= F.col("last"), F.lit(False))).otherwise(covered)
    return rows.withColumn("stands", F.col("first").isNotNull() & ~covered)


def labelled(found: DataFrame) -> DataFrame:
    """A row per document of ``detections``: places, labels and score."""

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    score = F.lit(0.0)
    for priority, confidence in CONFIDENCE.items():
        score = F.when(F.col("priority") == priority, confidence).otherwise(score)
    base, stands = F.coalesce(F.col("base"), F.lit(False)), F.col("stands")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(base | stands, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(stands, score)), F.lit(0.0)).alias("score"),
    ).drop("row")


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places, labels and scores of all documents."""
    return labelled(detections(documents(spark, sf_dir)))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle_sql() -> str:
    rows = ",\n  ".join(
        f"({r.number}, {_quoted(r.label)}, {r.priority}, {str(r.base).lower()}, "
        f"[{', '.join(map(_quoted, r.keywords))}], {_quoted(r.pattern)})"
        for r in all_rules()
    )
    confidence = " ".join(f"WHEN {p} THEN {c}" for p, c in CONFIDENCE.items())
    return f"""
WITH rules(rule, label, priority, base, keywords, pattern) AS (VALUES
  {rows}
), read AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
  FROM documents
), tried AS MATERIALIZED (
  SELECT row, r.*, ' ' || array_to_string(words, '  ') || ' ' AS padded
  FROM read JOIN rules r ON list_has_all(words, r.keywords)
), marked AS (
  SELECT row, rule, label, priority, base,
         string_split_regex(trim(regexp_replace(padded, pattern, ' ' || chr(1) || ' \\0 ' || chr(2) || ' ', 'g')), ' +') AS tokens
  FROM tried WHERE regexp_matches(padded, pattern)
), places AS (
  SELECT row, rule, label, priority, base,
         list_filter(list_transform(range(1, len(tokens) + 1), lambda i: CASE WHEN tokens[i] IN (chr(1), chr(2)) THEN i - 1 END),
                     lambda i: i IS NOT NULL) AS cuts
  FROM marked
), hits AS MATERIALIZED (
  SELECT row, rule, label, priority, base, cuts[2 * k + 1] - 2 * k AS first, cuts[2 * k + 2] - 2 * k - 2 AS last
  FROM (SELECT *, unnest(range(len(cuts) // 2)) AS k FROM places)
), judged AS (
  SELECT h.*, NOT EXISTS (
    SELECT 1 FROM hits c
    WHERE c.row = h.row AND c.first <= h.first AND c.last >= h.last
      AND (c.priority > h.priority
           OR (c.priority = h.priority AND c.last - c.first > h.last - h.first)
           OR (c.priority = h.priority AND c.last - c.first = h.last - h.first AND c.rule < h.rule))
  ) AS stands
  FROM hits h
), summed AS (
  SELECT row, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         list_sort(list_distinct(list(label) FILTER (base))) AS base_labels,
         list_sort(list_distinct(list(label) FILTER (base OR stands))) AS labels,
         max(CASE priority {confidence} END) FILTER (stands) AS score
  FROM judged GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels, coalesce(array_to_string(labels, ','), '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM read LEFT JOIN summed USING (row)
"""


OP12_SQL = _oracle_sql()
