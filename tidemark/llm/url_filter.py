"""URL filter: rules, and for all other urls a tree of path templates per host.

Paths are read segment by segment. Numbers and hexadecimal names are written as
``{n}`` and ``{x}``. Under the templates found so far, branches whose profiles
are alike merge into a wildcard named after the profile: the shares of what
follows (end, number, hexadecimal, word) and of labels (block, allow, none),
drawn towards the parent's shares by ``pull`` rows and rounded to quarters. A
branch like no other keeps its name. What all paths under a template have in
common is taken over in one step, and a path that is alone is done, so that the
steps follow the branchings and not the length of the paths. No path is cut: one
that has branched ``branchings`` times goes on as it is, as its own template.

A template is rejected when the share of blocked urls among its labelled ones,
smoothed towards that of all hosts, reaches ``reject``. Nothing speaks against
a template without labelled urls: it is allowed. Labels are what the rules say.

The host lies after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path then up to ``?``, ``#`` or the end; null urls and urls
without ``://`` have neither. Rows that repeat a page_id are judged each. An
empty table gives no rows. Only DataFrame functions are used, and all sums are
combined before they are shuffled; pages meet their template in one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import land, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (verdict, host, path); a rule fits its host, all subdomains, and paths that begin with its own.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
NUMBER = r"^[0-9]+(\.[A-Za-z]+)?$"
HEXADECIMAL = r"^[0-9a-fA-F-]*[0-9][0-9a-fA-F-]*$"
KINDS = ("ends", "numbers", "hexes", "words", "blocked", "allowed", "open")
PULL, REJECT = 4, 0.8
# Levels of the tree at which a path may branch: the number of steps, whatever the length of the paths.
BRANCHINGS = 24


def host_and_path(url: str) -> tuple[Column, Column]:
    whole = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.substring(whole, F.instr(whole, "://") + 3, F.length(whole))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(rules) -> Column:
    """The fitting rule of the longest host and path as ``struct<rule, verdict>``, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in reversed(ordered):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape(segment: Column) -> Column:
    extension = F.regexp_extract(segment, NUMBER, 1)
    return (
        F.when(segment.rlike(NUMBER), F.concat(F.lit("{n}"), extension))
        .when(segment.rlike(HEXADECIMAL) & (F.length(segment) >= 8), "{x}")
        .otherwise(segment)
    )


def segments(path: str) -> Column:
    """Shapes of the segments behind the first slash."""
    parts = F.split(path, "/")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), shape)


def next_kind(ahead: Column) -> list[Column]:
    """Indicators in the order of the first four KINDS."""
    number, hexa = F.startswith(ahead, F.lit("{n}")), ahead == "{x}"
    return [ahead.isNull(), number, hexa, ~(number | hexa)]


def common_length(one: str, other: str) -> Column:
    """How many elements two arrays have in common from their start, if they differ at all."""
    differ = F.zip_with(one, other, lambda a, b: F.coalesce(a != b, F.lit(True)))
    return (F.array_position(differ, True) - 1).cast("int")


def templates(paths: DataFrame, pull: int, branchings: int) -> DataFrame:
    """``host, segs, template, blocked, allowed`` of ``host, segs, n, blocked, allowed`` rows.

    A path that has branched ``branchings`` times goes on as it is.
    """
    now = paths.select("*", F.col("segs").alias("rest"), F.array().cast("array<string>").alias("prefix"))
    done: list[DataFrame] = []
    while True:
        # Least and greatest path under a template: what they share, all between them share as well.
        ends = now.groupBy("host", "prefix").agg(F.min("rest").alias("least"), F.max("rest").alias("most"))
        ends = ends.withColumn("shared", F.when(F.col("least") == F.col("most"), F.size("least")).otherwise(common_length("least", "most")))
        ends = land(ends.select("host", "prefix", "shared"), "url-shared")
        length = F.greatest(F.size("rest"), F.lit(1))
        moved = now.join(ends, ["host", "prefix"]).select(
            *paths.columns,
            F.slice("rest", F.col("shared") + 1, length).alias("rest"),
            F.concat("prefix", F.slice("rest", F.lit(1), F.col("shared"))).alias("prefix"),
        )
        moved = land(moved, "url-moved")
        here = moved.filter(F.size("rest") > 0).withColumn("seg", F.col("rest")[0])
        last = len(done) == branchings or here.isEmpty()
        done.append(moved.withColumn("prefix", F.concat("prefix", "rest")) if last else moved.filter(F.size("rest") == 0))
        if last:
            found = done[0]
            for part in done[1:]:
                found = found.unionByName(part)
            return found.withColumn("template", F.concat(F.lit("/"), F.array_join("prefix", "/")))
        named = land(branch_names(here, pull), "url-names")
        now = here.join(named, ["host", "prefix", "seg"]).select(
            *paths.columns,
            F.slice("rest", 2, length).alias("rest"),
            F.concat("prefix", F.array("name")).alias("prefix"),
        )
        now = land(now, "url-templates")


def branch_names(here: DataFrame, pull: int) -> DataFrame:
    """``host, prefix, seg, name``: the branch's own name, or its profile where others have it too."""
    kinds = next_kind(F.get("rest", F.lit(1)))
    sums = [F.sum(F.when(k, F.col("n")).otherwise(0)).alias(c) for k, c in zip(kinds, KINDS)]
    labels = [
        F.sum("blocked").alias("blocked"),
        F.sum("allowed").alias("allowed"),
        F.sum(F.col("n") - F.col("blocked") - F.col("allowed")).alias("open"),
    ]
    children = here.groupBy("host", "prefix", "seg").agg(F.sum("n").alias("n"), *sums, *labels)
    children = land(children, "url-children")
    parents = children.groupBy("host", "prefix").agg(
        F.sum("n").alias("n_all"), *[F.sum(c).alias(f"{c}_all") for c in KINDS]
    )
    both = children.join(parents, ["host", "prefix"])
    quarters = [
        F.floor(4 * (F.col(c) + F.lit(float(pull)) * F.col(f"{c}_all") / F.col("n_all")) / (F.col("n") + pull) + 0.5)
        for c in KINDS
    ]
    profile = F.concat(F.lit("{"), *[q.cast("string") for q in quarters], F.lit("}"))
    judged = land(both.select("host", "prefix", "seg", profile.alias("profile")), "url-profiles")
    alike = judged.groupBy("host", "prefix", "profile").agg(F.count("*").alias("alike"))
    name = F.when(F.col("alike") > 1, F.col("profile")).otherwise(F.col("seg"))
    return judged.join(alike, ["host", "prefix", "profile"]).select("host", "prefix", "seg", name.alias("name"))


def judge_urls(
    pages: DataFrame,
    rules=RULES,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    pull: int = PULL,
    branchings: int = BRANCHINGS,
    reject: float = REJECT,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, template``."""
    host, path = host_and_path(url_col)
    read = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    told = read.withColumn("told", longest_rule(rules)).withColumn("segs", segments("path"))
    paths = told.groupBy("host", "segs").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("told.verdict") == "block").alias("blocked"),
        F.count_if(F.col("told.verdict") == "allow").alias("allowed"),
    )
    found = templates(land(paths, "url-paths"), pull, branchings)
    nodes = found.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    total = nodes.agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")).first()
    labelled = (total.blocked or 0) + (total.allowed or 0)
    prior = total.blocked / labelled if labelled else 0.0
    purity = (F.col("blocked") + F.lit(pull * prior)) / (F.col("blocked") + F.col("allowed") + pull)
    told_of = F.col("blocked") + F.col("allowed") > 0
    judged = nodes.select("host", "template", F.when(told_of & (purity >= reject), "block").otherwise("allow").alias("judged"))
    known = land(found.select("host", "segs", "template").join(judged, ["host", "template"]), "url-verdicts")
    return told.join(known, ["host", "segs"]).select(
        "page_id",
        "host",
        "path",
        F.col("told.rule").alias("rule"),
        F.coalesce(F.col("told.verdict"), F.col("judged")).alias("verdict"),
        "template",
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return judge_urls(table(spark, sf_dir, "pages"))


# Levels that the SQL branches at; beyond them it takes paths over as they are.
SQL_LEVELS = 8


def _level_sql(level: int) -> str:
    """The tree's next level in SQL: from table p{level} to p{level + 1}."""
    p, ahead = f"p{level}", f"segs[{level + 2}]"
    kinds = (
        f"{ahead} IS NULL",
        f"coalesce(starts_with({ahead}, '{{n}}'), false)",
        f"coalesce({ahead} = '{{x}}', false)",
        f"coalesce(NOT starts_with({ahead}, '{{n}}') AND {ahead} <> '{{x}}', false)",
    )
    sums = ", ".join(f"sum(CASE WHEN {k} THEN n ELSE 0 END) AS {c}" for k, c in zip(kinds, KINDS))
    totals = ", ".join(f"sum({c}) OVER parent AS {c}_all" for c in KINDS)
    parts = " || ".join(
        f"CAST(CAST(floor(4 * ({c} + {PULL}::DOUBLE * {c}_all / n_all) / (n + {PULL}) + 0.5) AS BIGINT) AS VARCHAR)" for c in KINDS
    )
    return f"""
c{level} AS MATERIALIZED (
  SELECT host, prefix, segs[{level + 1}] AS seg, sum(n) AS n, {sums},
         sum(blocked) AS blocked, sum(allowed) AS allowed, sum(n - blocked - allowed) AS open
  FROM {p} WHERE len(segs) > {level} GROUP BY ALL
), a{level} AS MATERIALIZED (
  SELECT *, sum(n) OVER parent AS n_all, {totals}
  FROM c{level} WINDOW parent AS (PARTITION BY host, prefix)
), j{level} AS MATERIALIZED (
  SELECT host, prefix, seg, '{{' || {parts} || '}}' AS profile
  FROM a{level}
), m{level} AS MATERIALIZED (
  SELECT host, prefix, seg,
         CASE WHEN count(*) OVER (PARTITION BY host, prefix, profile) > 1 THEN profile ELSE seg END AS name
  FROM j{level}
), p{level + 1} AS MATERIALIZED (
  SELECT x.host, x.segs, x.n, x.blocked, x.allowed,
         CASE WHEN m.name IS NULL THEN x.prefix ELSE list_append(x.prefix, m.name) END AS prefix
  FROM {p} x LEFT JOIN m{level} m ON m.host = x.host AND m.prefix = x.prefix AND m.seg = x.segs[{level + 1}]
)"""


def _oracle_sql() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ordered]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ordered))
    said = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ordered))
    shaped = (
        f"list_transform(parts[2:], lambda s: CASE WHEN regexp_matches(s, '{NUMBER}') "
        f"THEN '{{n}}' || regexp_extract(s, '{NUMBER}', 1) "
        f"WHEN regexp_matches(s, '{HEXADECIMAL}') AND length(s) >= 8 THEN '{{x}}' ELSE s END)"
    )
    levels = ",".join(_level_sql(i) for i in range(SQL_LEVELS))
    return f"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), read AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), cut AS (
  SELECT *, CASE {rule} END AS rule, CASE {said} END AS said, string_split(path, '/') AS parts FROM read
), told AS MATERIALIZED (
  SELECT *, {shaped} AS segs FROM cut
), p0 AS MATERIALIZED (
  SELECT host, segs, count(*) AS n, sum(CASE WHEN said = 'block' THEN 1 ELSE 0 END) AS blocked,
         sum(CASE WHEN said = 'allow' THEN 1 ELSE 0 END) AS allowed,
         CAST([] AS VARCHAR[]) AS prefix
  FROM told GROUP BY host, segs
),{levels}, found AS MATERIALIZED (
  SELECT host, segs, blocked, allowed, '/' || array_to_string(list_concat(prefix, segs[{SQL_LEVELS + 1}:]), '/') AS template
  FROM p{SQL_LEVELS}
), nodes AS MATERIALIZED (
  SELECT host, template, sum(blocked) AS blocked, sum(allowed) AS allowed FROM found GROUP BY host, template
), prior AS (
  SELECT coalesce(sum(blocked)::DOUBLE / nullif(sum(blocked) + sum(allowed), 0), 0) AS prior FROM nodes
), judged AS (
  SELECT host, template,
         CASE WHEN blocked + allowed > 0 AND (blocked + {PULL} * prior) / (blocked + allowed + {PULL}) >= {REJECT}::DOUBLE THEN 'block' ELSE 'allow' END AS judged
  FROM nodes, prior
)
SELECT t.page_id, t.host, t.path, t.rule, coalesce(t.said, j.judged) AS verdict, f.template
FROM told t
JOIN found f ON f.host = t.host AND f.segs = t.segs
JOIN judged j ON j.host = f.host AND j.template = f.template
"""


OP3_SQL = _oracle_sql()
