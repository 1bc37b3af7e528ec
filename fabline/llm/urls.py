"""URL filter: host and path rules first, then a path-template tree judged by labelled pages.

Per host, paths grow a tree segment by segment: children with at least ``MIN_SUPPORT`` pages stay literal, whatever the size
of their host, and all others (the variable segments) become one wildcard. The tree grows until no node with that
many pages has further segments. Templates of one shape whose labelled bad rate can't be told apart statistically from
the rest of their siblings are merged into one branch; the others stand alone. A branch is rejected when its smoothed
labelled purity (share of bad pages) reaches ``reject``. Each level is one partial count and one join on
(host, prefix, segment), so a host with a third of all pages is counted map-side and its join may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: Verdict of each rule, host and path run together.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MIN_SUPPORT = 5
Z2 = 3.84  # squared z of the two-proportion test at 5 %
ALPHA, PRIOR_BAD, REJECT = 5, 1, 0.5  # smoothing: 5 pseudo-pages, 1 of them bad


def parse(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url_col, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (pages.withColumn("host", ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)))
            .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def rule_columns(rules=RULES):
    """(rule, verdict) of the longest rule that fits host and path, null where none does. ``rules`` is a short list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):  # longer ones override
        host, path = text[:text.index("/")], text[text.index("/"):]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def with_templates(rows: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """Add ``template`` to rows with host and path: the path with a ``*`` for each segment that is not kept literally.

    Nodes with fewer pages than ``min_support`` have no literal children, so their rows are finished at once; the
    rounds are as many as segments on the longest path that ``min_support`` pages share.
    """
    rows = rows.withColumn("rest", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    done = []
    while True:
        rows = cut(rows)
        per = rows.where(F.size("rest") > 0).groupBy("host", "template").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_support)
        grows = rows.join(per.drop("pages"), ["host", "template"], "left_semi").where(F.size("rest") > 0)
        over = rows.where(F.size("rest") == 0).unionByName(
            rows.where(F.size("rest") > 0).join(per.drop("pages"), ["host", "template"], "left_anti"))
        done.append(over.withColumn("template", F.concat("template", F.repeat(F.lit("/*"), F.size("rest")))).drop("rest"))
        if per.isEmpty():
            break
        grows = grows.withColumn("seg", F.element_at("rest", 1))
        stays = (grows.groupBy("host", "template", "seg").agg(F.count("*").alias("n")).where(F.col("n") >= min_support)
                 .select("host", "template", "seg", F.col("seg").alias("literal")))
        rows = (grows.join(stays, ["host", "template", "seg"], "left")
                .withColumn("template", F.concat("template", F.lit("/"), F.coalesce("literal", F.lit("*"))))
                .withColumn("rest", F.slice("rest", F.lit(2), F.size("rest"))).drop("seg", "literal"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return cut(out)


def purity(labelled: DataFrame) -> DataFrame:
    """Smoothed bad share of each (host, template) with labels, from rows (host, template, bad 0/1).

    A template whose rate differs significantly from that of all other templates of its shape on its host is judged alone,
    all others of the shape together. Sums per shape are joined back, so a host with very many templates stays spread.
    """
    t = (labelled.groupBy("host", "template").agg(F.count("*").alias("n"), F.sum("bad").alias("b"))
         .withColumn("shape", F.regexp_replace("template", "[^/*]+", "{}")))
    shapes = t.groupBy("host", "shape").agg(F.sum("n").alias("n_all"), F.sum("b").alias("b_all"))
    t = t.join(shapes, ["host", "shape"])
    n0, b0 = F.col("n_all") - F.col("n"), F.col("b_all") - F.col("b")
    share = F.col("b_all") / F.col("n_all")
    apart = F.when(n0 > 0, F.pow(F.col("b") / F.col("n") - b0 / n0, F.lit(2)) > Z2 * share * (1 - share) * (1 / F.col("n") + 1 / n0)).otherwise(False)
    t = t.withColumn("apart", apart).select("host", "shape", "template", "n", "b", "apart")
    pools = t.where("NOT apart").groupBy("host", "shape").agg(F.sum("n").alias("n_pool"), F.sum("b").alias("b_pool"))
    t = t.join(pools, ["host", "shape"], "left")
    bad, n = (F.when(F.col("apart"), F.col(c)).otherwise(F.col(f"{c}_pool")) for c in ("b", "n"))
    return t.select("host", "template", ((bad + PRIOR_BAD) / (n + ALPHA)).alias("purity"))


def judge(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template.

    Labelled pages are those that a rule decides and, where ``labels`` (doc_id, toxic) is given, those whose path
    ends in the number of a labelled document. A template without labels is allowed, also if ``labels`` is empty. Null urls
    and urls without ``://`` have empty host and path; null ids and repeated rows are kept; other columns, whatever their
    names, are not read.
    """
    rows = parse(pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url")))
    rule, verdict = rule_columns(rules)
    rows = rows.withColumn("rule", rule).withColumn("says", verdict).drop("url")
    rows = with_templates(rows)
    bad = F.when(F.col("says").isNotNull(), (F.col("says") == "block").cast("int"))
    known = rows.withColumn("bad", bad)
    if labels is not None:
        marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)(?:[.]html)?/?$', 1) AS bigint)")
        known = known.withColumn("number", number).join(marks, F.col("number") == F.col("doc_id"), "left").withColumn("bad", F.coalesce("bad", "toxic"))
    judged = purity(known.where("bad IS NOT NULL").select("host", "template", "bad"))
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return (rows.join(judged, ["host", "template"], "left")
            .select(F.col("page").alias(id_col), "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "template"))


ORACLE_DEPTH = 16


def oracle() -> str:
    """DuckDB SQL of ``judge`` on tables pages and labels (SQL has one step a level: 16 of them)."""
    fits = {t: f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{t[t.index('/'):]}')"
            for t, _ in RULES for h in [t[:t.index("/")]]}
    longest = sorted(RULES, key=lambda r: -len(r[0]))
    case = lambda out: "CASE " + " ".join(f"WHEN {fits[t]} THEN '{out(t, v)}'" for t, v in longest) + " END"
    sql = [r"""WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
""" + f"""r0 AS (SELECT *, {case(lambda t, v: t)} AS rule, {case(lambda t, v: v)} AS says,
              list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template FROM h)"""]
    for d in range(ORACLE_DEPTH):
        sql.append(f"""n{d} AS (SELECT host, template, segments[{d + 1}] AS seg, count(*) AS n FROM r{d} WHERE len(segments) > {d} GROUP BY ALL),
l{d} AS (SELECT * FROM n{d} WHERE n >= {MIN_SUPPORT}),
r{d + 1} AS (SELECT a.page_id, a.host, a.path, a.rule, a.says, a.segments, CASE WHEN len(a.segments) > {d}
                    THEN a.template || '/' || coalesce(l.seg, '*') ELSE a.template END AS template
             FROM r{d} a LEFT JOIN l{d} l ON a.host = l.host AND a.template = l.template AND a.segments[{d + 1}] = l.seg)""")
    sql.append(rf"""t AS (SELECT page_id, host, path, rule, says, template || repeat('/*', greatest(len(segments) - {ORACLE_DEPTH}, 0)) AS template FROM r{ORACLE_DEPTH}),
m AS (SELECT doc_id, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
k AS (SELECT host, template, coalesce((says = 'block')::INT, toxic) AS bad FROM t
      LEFT JOIN m ON try_cast(regexp_extract(path, '/([0-9]+)(?:[.]html)?/?$', 1) AS BIGINT) = doc_id),
c AS (SELECT host, template, count(*) AS n, sum(bad) AS b, regexp_replace(template, '[^/*]+', '{{}}', 'g') AS shape
      FROM k WHERE bad IS NOT NULL GROUP BY host, template),
g AS (SELECT *, sum(n) OVER w AS n1, sum(b) OVER w AS b1 FROM c WINDOW w AS (PARTITION BY host, shape)),
s AS (SELECT *, CASE WHEN n1 > n THEN (b / n - (b1 - b) / (n1 - n)) ** 2 > {Z2} * (b1 / n1) * (1 - b1 / n1) * (1 / n + 1 / (n1 - n)) ELSE false END AS apart FROM g),
u AS (SELECT host, template, CASE WHEN apart THEN (b + {PRIOR_BAD}) / (n + {ALPHA})
             ELSE (sum(b) FILTER (NOT apart) OVER w + {PRIOR_BAD}) / (sum(n) FILTER (NOT apart) OVER w + {ALPHA}) END AS purity
      FROM s WINDOW w AS (PARTITION BY host, shape))
SELECT page_id, t.host, path, rule, coalesce(says, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM t LEFT JOIN u ON t.host = u.host AND t.template = u.template""")
    return ",\n".join(sql)
