"""URL filters: explicit rules first, then a tree of path templates per host.

A URL's host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; its path goes on from
there up to ``?``, ``#`` or the end.  A rule (host, path) fits its host and all subdomains where the path starts
with the rule's; the longest fitting rule decides.

Other URLs are judged by the template of their path.  Segments lose their numbers first (``page12.html`` is
``page{n}.html``).  Then, level by level from the root of each host:

* a child whose share of bad labels differs significantly from its node's keeps a branch of its own, however many
  children the node has;
* all other children, statistically alike, are merged into one wildcard branch (an only child keeps its name).

A template is blocked if its share of bad labels, smoothed towards the share of all, reaches a threshold; one
without labels is allowed.

All work is on counts per (host, segments); pages are grouped before they are shuffled, so a host with a third
of all pages is no hot spot, and no host is handled by one task.

Defined cases: a null URL, or one without ``://``, has an empty host and path and is judged as the template of these;
empty segments do not count; from the last level on the rest of a path is one segment; repeated rows are
judged alike; labels without a page and null labels count for nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import pick, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = 4


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class TreeOptions(NamedTuple):
    least: int = 5  # labels a branch of its own needs
    z: float = 3.0  # how far its share must differ, in standard errors
    weight: float = 8.0  # labels that the share of all counts for in smoothing
    threshold: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def shapes(path: Column, levels: int = LEVELS) -> list[Column]:
    """The path's segments without their numbers, one column per level; the last one holds the rest."""
    plain = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/", -1), lambda s: s != "")
    each = [F.coalesce(F.get(plain, F.lit(i)), F.lit("")) for i in range(levels - 1)]
    return [*each, F.array_join(F.slice(plain, levels, F.greatest(F.size(plain), F.lit(1))), "/")]


def template_verdicts(counts: DataFrame, options: TreeOptions = TreeOptions(), levels: int = LEVELS) -> DataFrame:
    """(host, s1.., template, purity, verdict) for ``counts(host, s1.., n, labelled, bad)``."""
    names = [f"s{d}" for d in range(1, levels + 1)]
    rows = counts
    total = counts.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    prior = (total["bad"] / total["labelled"]) if total["labelled"] else 0.0
    for d, name in enumerate(names, 1):
        node = ["host", *[f"b{i}" for i in range(1, d)]]
        kids = rows.groupBy(*node, name).agg(*[F.sum(c).alias(f"c_{c}") for c in ("labelled", "bad")])
        nodes = kids.groupBy(*node).agg(
            F.count("*").alias("kids"), *[F.sum(f"c_{c}").alias(f"t_{c}") for c in ("labelled", "bad")]
        )
        share = F.col("t_bad") / F.greatest(F.col("t_labelled"), F.lit(1))
        error = F.sqrt(share * (1 - share) / F.greatest(F.col("c_labelled"), F.lit(1)))
        apart = (F.col("c_labelled") >= options.least) & (
            F.abs(F.col("c_bad") / F.greatest(F.col("c_labelled"), F.lit(1)) - share) > options.z * error
        )
        branch = (
            F.when(F.col(name) == "", "")
            .when((F.col("kids") == 1) | apart, F.col(name))
            .otherwise("*")
        )
        chosen = kids.join(nodes, node).select(*node, name, branch.alias(f"b{d}"))
        # every level reads the one before several times: written, it is worked out once
        rows = stored(rows.join(chosen, [*node, name]), "url-level")
    branches = [f"b{d}" for d in range(1, levels + 1)]
    purity = (F.sum("bad") + options.weight * prior) / (F.sum("labelled") + options.weight)
    judged = rows.groupBy("host", *branches).agg(purity.alias("purity"), F.sum("labelled").alias("known"))
    template = F.array_join(F.filter(F.array(*branches), lambda b: b != ""), "/")
    return rows.join(judged, ["host", *branches]).select(
        "host",
        *names,
        F.concat(F.lit("/"), template).alias("template"),
        "purity",
        F.when((F.col("known") > 0) & (F.col("purity") >= options.threshold), "block").otherwise("allow").alias("verdict"),
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    bad_pages: DataFrame,
    options: TreeOptions = TreeOptions(),
    levels: int = LEVELS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of ``pages(page_id, url)``.

    ``bad_pages(key, bad)`` holds labels (1: bad) by the last number in a path.
    """
    names = [f"s{d}" for d in range(1, levels + 1)]
    host, path = host_and_path(F.col("url"))
    placed = pick(pages, page_id="long", url="string").select("page_id", host.alias("host"), path.alias("path"))
    placed = placed.select("*", *[s.alias(n) for s, n in zip(shapes(F.col("path"), levels), names, strict=True)])
    number = F.regexp_extract("path", r"(?<![0-9])([0-9]++)[^0-9]*+\z", 1).try_cast("long")
    labels = pick(bad_pages, key="long", bad="int").where("key is not null and bad is not null")
    labels = labels.groupBy("key").agg(F.max("bad").alias("bad"))
    known = placed.withColumn("key", number).join(labels, "key", "left")
    counts = known.groupBy("host", *names).agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    verdicts = template_verdicts(stored(counts, "url-counts"), options, levels)
    rule, by_rule = matching_rule(F.col("host"), F.col("path"), rules)
    joined = placed.join(verdicts, ["host", *names])
    return joined.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, "verdict").alias("verdict"), "template", "purity"
    )


def oracle(rules: Sequence[Rule], labels: str, options: TreeOptions = TreeOptions(), levels: int = LEVELS) -> str:
    """The SQL counterpart; ``labels`` is a query with the columns ``key`` and ``bad``."""
    o, names = options, [f"s{d}" for d in range(1, levels + 1)]
    cases = lambda what: "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{what(r)}'"
        for r in sorted(rules, key=lambda r: -len(r.name))
    )
    segments = ", ".join(f"coalesce(seg[{d}], '') AS s{d}" for d in range(1, levels))
    sql = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
g AS (SELECT *, list_filter(string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/'), lambda s: s <> '') AS seg FROM h),
p AS (SELECT page_id, host, path, {segments}, array_to_string(seg[{levels}:], '/') AS s{levels},
             try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT) AS key FROM g),
l AS (SELECT key, max(bad) AS bad FROM ({labels}) WHERE key IS NOT NULL AND bad IS NOT NULL GROUP BY key),
r0 AS (SELECT host, {', '.join(names)}, count(*) AS n, count(bad) AS labelled, CAST(coalesce(sum(bad), 0) AS BIGINT) AS bad
       FROM p LEFT JOIN l USING (key) GROUP BY ALL),
t AS (SELECT coalesce(sum(bad) / nullif(sum(labelled), 0), 0) AS prior FROM r0)"""
    for d, name in enumerate(names, 1):
        node = ", ".join(["host", *[f"b{i}" for i in range(1, d)]])
        sql += f""",
k{d} AS (SELECT {node}, {name}, sum(labelled) AS c_l, sum(bad) AS c_b FROM r{d - 1} GROUP BY ALL),
n{d} AS (SELECT {node}, count(*) AS kids, sum(c_b) / greatest(sum(c_l), 1) AS share
        FROM k{d} GROUP BY ALL),
d{d} AS (SELECT {node}, {name}, CASE WHEN {name} = '' THEN ''
        WHEN kids = 1 OR (c_l >= {o.least} AND abs(c_b / greatest(c_l, 1) - share) > {o.z} * sqrt(share * (1 - share) / greatest(c_l, 1)))
        THEN {name} ELSE '*' END AS b{d} FROM k{d} JOIN n{d} USING ({node})),
r{d} AS (SELECT * FROM r{d - 1} JOIN d{d} USING ({node}, {name}))"""
    branches = ", ".join(f"b{d}" for d in range(1, levels + 1))
    return f"""{sql},
j AS (SELECT host, {branches}, (sum(bad) + {o.weight} * any_value(prior)) / (sum(labelled) + {o.weight}) AS purity,
             sum(labelled) AS known FROM r{levels}, t GROUP BY ALL)
SELECT page_id, host, path, {cases(lambda r: r.name)} END AS rule,
       coalesce({cases(lambda r: r.verdict)} END, CASE WHEN known > 0 AND purity >= {o.threshold} THEN 'block' ELSE 'allow' END) AS verdict,
       '/' || array_to_string(list_filter([{branches}], lambda b: b <> ''), '/') AS template, purity
FROM p JOIN r{levels} USING (host, {', '.join(names)}) JOIN j USING (host, {branches})
"""
