"""URL filter by a tree of path templates, in DataFrame operations only.

Distinct paths of a host grow a tree, level by level. A segment is written with its digits
levelled; where a node has many different ones of which few recur, they become one wildcard.
Sibling branches are put in the order of their labelled share of bad pages, and neighbours whose shares do not
differ by more than chance are merged; those with too few labels to tell are one branch. What is left are
templates; their share of bad labels, smoothed, decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import ascii_lower

#: A node's segments are variable from this many different ones, seen less than RECUR times each on average.
VARIED, RECUR = 8, 4.0
#: Labelled pages that a branch needs before it can differ from its siblings, and the normal score at which it does.
LEAST_LABELS, DIFFERS = 5, 1.96
#: The smoothing counts as so many labels, half of them bad: a template without labels is at 0.5.
STRENGTH = 10.0
REJECT = 0.5
#: Branches of variable segments, similar labelled ones, and those of too few labels.
WILD, MERGED, UNKNOWN = "*", "~", "~?"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` with A-Z lower-cased, then the path up to ``?`` or ``#``; empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule ``host/path`` that fits: its host or a subdomain of it, and a path that begins like the rule's; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _rest(path: Column, level: int) -> Column:
    """Segments from ``level`` on, digits levelled; empty where the path has none."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.transform(F.slice(parts, level + 1, F.greatest(F.size(parts) - level, F.lit(0))), lambda p: F.regexp_replace(p, "[0-9]+", "#"))


def _merged(told: DataFrame) -> DataFrame:
    """(host, template, seg, branch, alone) of siblings with enough labels: runs of similar neighbours by share are one branch.

    Two neighbours are similar if the normal score of the difference of their shares, pooled, is at most ``DIFFERS``.
    """
    order = Window.partitionBy("host", "template").orderBy("share", "seg")
    own = told.withColumn("share", F.col("bad") / F.col("labels"))
    b0, n0 = F.lag("bad").over(order), F.lag("labels").over(order)
    pooled = (F.col("bad") + b0) / (F.col("labels") + n0)
    score = F.abs(F.col("share") - b0 / n0) / F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-4)) * (1 / F.col("labels") + 1 / n0))
    own = own.withColumn("new", F.coalesce((score > DIFFERS).cast("int"), F.lit(0)))
    own = own.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    alone = F.count(F.lit(1)).over(Window.partitionBy("host", "template", "run")) == 1
    return own.select("host", "template", "seg", F.when(alone, F.col("seg")).otherwise(F.concat(F.lit(MERGED), F.col("run").cast("string"))).alias("branch"), "alone")


def templates(pages: DataFrame) -> DataFrame:
    """(host, path, template, purity): every distinct path of ``pages`` (host, path, bad, good) with its template.

    ``bad`` and ``good`` are 1 for pages labelled so, else 0. ``purity`` is the smoothed share of bad
    labels below the template; 0.5 is the middle of all, as without any label. The tree grows until no path
    has a further segment; a path that is alone below a node has no siblings and is written out at once.
    """
    paths = pages.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    paths = scratch.save(paths.withColumns({"template": F.lit(""), "whole": F.lit(False)}), "paths")
    level = 0
    while True:
        own = paths.withColumn("seg", F.when(~F.col("whole"), F.get(_rest(F.col("path"), level), F.lit(0))))
        nodes = own.where("seg is not null").groupBy("host", "template", "seg").agg(F.count(F.lit(1)).alias("paths"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        nodes = scratch.save(nodes, "nodes")
        if nodes.isEmpty():
            scratch.drop(nodes)
            break
        node = nodes.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kinds"), F.sum("paths").alias("all_paths"), F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.sum("good").alias("all_good"))
        joined = nodes.join(node, ["host", "template"])
        variable = (F.col("kinds") >= VARIED) & (F.col("all_n") < RECUR * F.col("kinds"))
        labels = F.col("bad") + F.col("good")
        kind = F.when(variable, WILD).when(F.col("kinds") == 1, F.col("seg")).when(labels < LEAST_LABELS, UNKNOWN)
        told = joined.select("host", "template", "seg", "bad", labels.alias("labels"), kind.alias("branch"), (F.col("all_paths") == 1).alias("alone"))
        branch = told.where("branch is not null").select("host", "template", "seg", "branch", "alone").unionByName(_merged(told.where("branch is null")))
        grown = own.join(branch, ["host", "template", "seg"], "left")
        ahead = F.when(F.col("alone"), F.array_join(_rest(F.col("path"), level), "/")).otherwise(F.col("branch"))
        whole = F.col("branch").isNull() | F.col("alone")
        grown = grown.withColumn("template", F.when(F.col("branch").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), ahead)))
        nxt = scratch.save(grown.select("host", "path", "n", "bad", "good", "template", whole.alias("whole")), "paths")
        scratch.drop(paths)
        scratch.drop(nodes)
        paths = nxt
        level += 1
    sums = paths.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    purity = sums.select("host", "template", ((F.col("bad") + STRENGTH / 2) / (F.col("bad") + F.col("good") + STRENGTH)).alias("purity"))
    return paths.select("host", "path", "template").join(purity, ["host", "template"])


def judge(pages: DataFrame, rules: dict[str, str], labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", reject: float = REJECT) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), a row per page.

    ``labels`` (page_id, bad: 1 or 0) tells which pages are known; without it, pages that a rule
    decides are the known ones. Ids labelled more than once count as bad if any label says so. Null
    urls have empty host and path. Rows go one by one; other columns are left out.
    """
    host, path = host_and_path(F.col(url_col))
    own = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), list(rules)))
    blocked = F.col("rule").isin([r for r, v in rules.items() if v == "block"])
    if labels is None:
        known = own.withColumns({"bad": F.coalesce(blocked.cast("int"), F.lit(0)), "good": F.coalesce((~blocked).cast("int"), F.lit(0))})
    else:
        told = labels.where("page_id is not null and bad is not null").groupBy(F.col("page_id").alias("__id")).agg(F.max(F.col("bad").cast("int")).alias("__bad"))
        known = own.join(told, F.col("page_id") == F.col("__id"), "left").withColumns({"bad": F.coalesce("__bad", F.lit(0)), "good": F.coalesce(1 - F.col("__bad"), F.lit(0))})
    tree = templates(known.select("host", "path", "bad", "good"))
    verdict = F.when(F.col("rule").isNotNull(), F.when(blocked, "block").otherwise("allow")).when(F.col("purity") > reject, "block").otherwise("allow")
    return own.join(tree, ["host", "path"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def oracle(rules: dict[str, str], levels: int = 8) -> str:
    """The rows of :func:`judge` without labels in DuckDB SQL, a group of tables for each of the tree's first ``levels`` levels."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    fits = ""
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        h, _, p = rule.partition("/")
        fits += f" when (host = {quoted(h)} or ends_with(host, {quoted('.' + h)})) and starts_with(path, {quoted('/' + p)}) then {quoted(rule)}"
    block = ", ".join(quoted(r) for r, v in rules.items() if v == "block")
    out = f"""
with u as (select page_id, coalesce(url, '') as u from pages),
r as (select page_id, case when instr(u, '://') > 0 then substr(u, instr(u, '://') + 3) else '' end as rest from u),
o as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
own as (select *, case{fits} end as rule from o),
p0 as materialized (select host, path, list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda x: regexp_replace(x, '[0-9]+', '#', 'g')) as segs, count(*) as n,
  count(case when rule in ({block}) then 1 end) as bad, count(case when rule not in ({block}) then 1 end) as good, '' as template, false as whole from own group by host, path)"""
    for k in range(levels):
        out += f""",
s{k} as (select *, case when not whole then segs[{k + 1}] end as seg from p{k}),
n{k} as (select host, template, seg, count(*) as paths, sum(n) as n, sum(bad) as bad, sum(good) as good from s{k} where seg is not null group by 1, 2, 3),
m{k} as (select host, template, count(*) as kinds, sum(paths) as all_paths, sum(n) as all_n from n{k} group by 1, 2),
t{k} as (select n{k}.*, all_paths = 1 as alone, bad + good as labels, case when kinds >= {VARIED} and all_n < {RECUR} * kinds then '{WILD}' when kinds = 1 then seg when bad + good < {LEAST_LABELS} then '{UNKNOWN}' end as branch from n{k} join m{k} using (host, template)),
q{k} as (select *, bad / labels as share, lag(bad) over w as b0, lag(labels) over w as n0 from t{k} where branch is null window w as (partition by host, template order by bad / labels, seg)),
v{k} as (select *, (bad + b0) / (labels + n0) as pooled from q{k}),
x{k} as (select *, case when abs(share - b0 / n0) / sqrt(greatest(pooled * (1 - pooled), 1e-4) * (1 / labels + 1 / n0)) > {DIFFERS} then 1 else 0 end as new from v{k}),
y{k} as (select host, template, seg, sum(new) over (partition by host, template order by share, seg) as run from x{k}),
z{k} as (select host, template, seg, case when count(*) over (partition by host, template, run) = 1 then seg else '{MERGED}' || cast(run as varchar) end as merged from y{k}),
p{k + 1} as materialized (select s.host, s.path, s.segs, s.n, s.bad, s.good,
  case when t.host is null then s.template when alone then s.template || '/' || array_to_string(segs[{k + 1}:], '/') else s.template || '/' || coalesce(branch, merged) end as template, t.host is null or alone as whole
  from s{k} s left join t{k} t on t.host = s.host and t.template = s.template and t.seg = s.seg left join z{k} z on z.host = s.host and z.template = s.template and z.seg = s.seg)"""
    return out + f""",
f as (select host, template, (sum(bad) + {STRENGTH / 2}e0) / (sum(bad) + sum(good) + {STRENGTH}e0) as purity from p{levels} group by 1, 2)
select page_id, host, path, rule, case when rule in ({block}) then 'block' when rule is not null then 'allow' when purity > {REJECT}e0 then 'block' else 'allow' end as verdict, template, purity
from own join p{levels} using (host, path) join f using (host, template)
"""
