"""URL filters: host and path rules, and trust that spreads over the links between hosts.

A rule decides the pages it fits. The others follow their host: allowed pages make a host a
trusted seed and blocked pages a distrusted one, in proportion to their share of its pages.
Trust runs along host edges and distrust against them, as personalised PageRank in whole
numbers, so the result depends on no order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored

_CAPS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""

#: What a host with nothing but seed pages gets before links: 0.15 of this.
UNIT = 1_000_000_000


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else ''."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _CAPS, _SMALL)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct pairs ``src, dst`` of different hosts with a link from a page of one to the other."""
    linked = F.regexp_extract_all("html", F.lit(_LINK), 1)
    return (
        pages.select(url_host(F.col("url")).alias("src"), F.explode_outer(F.array_distinct(linked)).alias("dst"))
        .select("src", F.translate("dst", _CAPS, _SMALL).alias("dst"))
        .filter("src <> dst and src <> ''")
        .distinct()
    )


def _ruled(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` with the longest fitting rule of each page, if any."""
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    known = pages.sparkSession.createDataFrame(
        [(h, p, v, len(h) + len(p)) for v, h, p in rules], "suffix string, prefix string, rule_verdict string, size int"
    )
    by_host = (
        urls.select("host").distinct().select("host", F.explode(suffixes).alias("suffix"))
        .join(known, "suffix")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("size", "suffix", "prefix", "rule_verdict")), asc=False).alias("fit"))
    )
    best = F.get(F.filter("fit", lambda r: F.startswith("path", r["prefix"])), F.lit(0))
    return urls.join(by_host, "host", "left").select(
        "page_id", "host", "path", F.concat(best["suffix"], best["prefix"]).alias("rule"), best["rule_verdict"].alias("verdict")
    )


def spread(seeds: DataFrame, edges: DataFrame, rounds: int, damping: int) -> DataFrame:
    """``host, trust, distrust`` after ``rounds`` rounds over ``edges``; ``damping`` in hundredths.

    ``seeds``: ``host, trusted, distrusted``, each up to ``UNIT``. A host's rank is its own
    share of the seed plus what the hosts before it hand on in equal parts.
    """
    arcs = edges.select(F.lit(True).alias("trust"), F.col("src").alias("host"), F.col("dst").alias("to")).unionByName(
        edges.select(F.lit(False).alias("trust"), F.col("dst").alias("host"), F.col("src").alias("to"))
    )
    arcs = stored(arcs.join(arcs.groupBy("trust", "host").agg(F.count("*").alias("ways")), ["trust", "host"]), "arcs")
    nodes = seeds.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    both = F.array(
        F.struct(F.lit(True).alias("trust"), F.coalesce("trusted", F.lit(0)).alias("seed")),
        F.struct(F.lit(False).alias("trust"), F.coalesce("distrusted", F.lit(0)).alias("seed")),
    )
    start = stored(nodes.join(seeds, "host", "left").select("host", F.explode(both).alias("s")).select("host", "s.*"), "seeds")
    own = f"cast(seed as bigint) * {100 - damping} div 100"
    rank = start.selectExpr("trust", "host", f"{own} as rank")
    for n in range(rounds):
        given = (
            rank.filter("rank > 0").join(arcs, ["trust", "host"])
            .groupBy("trust", F.col("to").alias("host")).agg(F.expr("sum(rank div ways) as given"))
        )
        rank = start.join(given, ["trust", "host"], "left").selectExpr(
            "trust", "host", f"{own} + coalesce(given, 0) * {damping} div 100 as rank"
        )
        if n % 3 == 2:  # else the plan grows with the rounds
            rank = stored(rank, "ranks")
    return rank.groupBy("host").agg(
        F.sum(F.when(F.col("trust"), F.col("rank")).otherwise(0)).alias("trust"),
        F.sum(F.when(~F.col("trust"), F.col("rank")).otherwise(0)).alias("distrust"),
    )


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], rounds: int = 9, damping: int = 85, least: int = UNIT // 20
) -> DataFrame:
    """Verdict of each page: of its longest fitting rule, else of its host.

    ``rules``: verdict (``allow`` or ``block``), host, path. A rule fits its host and all
    subdomains where the url's path starts with the rule's. A host is blocked whose distrust
    is above its trust and at least ``least``, of a ``UNIT``; all others are allowed. A url
    that is null or has no ``://`` has empty host and path and is allowed, as is a page
    without links or html. Other columns are ignored; repeated rows each get their verdict.

    Returns ``page_id, host, path, rule, verdict, trust, distrust``.
    """
    ruled = stored(_ruled(pages, rules), "ruled")
    shares = ruled.groupBy("host").agg(
        *(
            F.expr(f"count_if(verdict = '{v}') * {UNIT} div count(*)").alias(name)
            for v, name in (("allow", "trusted"), ("block", "distrusted"))
        )
    )
    ranks = spread(shares.filter("host <> ''"), stored(host_edges(pages), "edges"), rounds, damping)
    bad = F.coalesce((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least), F.lit(False))
    return ruled.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def sql(rounds: int = 9, damping: int = 85, least: int = UNIT // 20) -> str:
    link = _LINK.replace("'", "''")
    known = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    text = f"""
WITH urls AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), '{_CAPS}', '{_SMALL}') AS host,
         regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path
  FROM pages
), rules(v, h, p) AS (VALUES {known}), ruled AS (
  SELECT page_id, host, path, (
    SELECT arg_max(h || p || ' ' || v, length(h) + length(p)) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS fit
  FROM urls
), edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{_CAPS}', '{_SMALL}') AS dst FROM urls)
  WHERE src <> dst AND src <> ''
), seeds AS (
  SELECT host, count(*) FILTER (fit LIKE '% allow') * {UNIT} // count(*) AS trusted,
         count(*) FILTER (fit LIKE '% block') * {UNIT} // count(*) AS distrusted
  FROM ruled WHERE host <> '' GROUP BY host
), arcs AS (
  SELECT *, count(*) OVER (PARTITION BY trust, host) AS ways FROM (
    SELECT true AS trust, src AS host, dst AS nxt FROM edges UNION ALL SELECT false, dst, src FROM edges)
), start AS (
  SELECT host, trust, coalesce(CASE WHEN trust THEN trusted ELSE distrusted END, 0) AS seed
  FROM (SELECT host FROM seeds UNION SELECT src FROM edges UNION SELECT dst FROM edges)
  LEFT JOIN seeds USING (host), (VALUES (true), (false)) AS k(trust)
), r0 AS (SELECT trust, host, seed * {100 - damping} // 100 AS rank FROM start)"""
    for n in range(1, rounds + 1):
        text += f""", r{n} AS (
  SELECT s.trust, s.host, seed * {100 - damping} // 100 + coalesce(given, 0) * {damping} // 100 AS rank
  FROM start s LEFT JOIN (
    SELECT a.trust, nxt AS host, CAST(sum(rank // ways) AS BIGINT) AS given
    FROM arcs a JOIN r{n - 1} r ON a.trust = r.trust AND a.host = r.host GROUP BY ALL) g
  ON s.trust = g.trust AND s.host = g.host)"""
    return text + f"""
SELECT u.page_id, u.host, u.path, split_part(fit, ' ', 1) AS rule,
       coalesce(split_part(fit, ' ', 2),
                CASE WHEN d.rank > t.rank AND d.rank >= {least} THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(t.rank, 0) AS BIGINT) AS trust, CAST(coalesce(d.rank, 0) AS BIGINT) AS distrust
FROM ruled u LEFT JOIN (SELECT * FROM r{rounds} WHERE trust) t ON u.host = t.host
LEFT JOIN (SELECT * FROM r{rounds} WHERE NOT trust) d ON u.host = d.host
"""
