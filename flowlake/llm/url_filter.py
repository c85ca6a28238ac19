"""URL filters: fixed host and path rules, and a tree of path templates that learns from labelled pages.

Per host, paths grow into a tree, one level of segments at a time. Digits inside a segment are a variable at once. Among
the children of a node those that hold at least ``MIN_SHARE`` of its pages (and ``MIN_PAGES``) stay as they are. The others
are one wildcard child, but for those whose labels tell them apart: a segment with ``MIN_PAGES`` labels or more whose share of bad
ones differs from the rest of the wildcard stays as it is, however small its share of the pages. As any number of segments is
tested, the limit of that test grows with their number; and a segment leaves the wildcard only if its own smoothed share then lies
on the side that its labels point to (a small bad segment is not judged milder for being alone). A child whose labelled pages
are not statistically different from the pool it comes from (two-proportion z test) is merged with that pool and judged by it.
Children that differ from it are merged with each other: in the order of their smoothed shares, neighbours that the same test
cannot tell apart are one branch for judgement (their subtrees stay apart), with the labels of all of them. A template is rejected when its smoothed share of bad labels,
``(bad + STRENGTH * prior) / (labelled + STRENGTH)``, reaches ``REJECT``; the prior is the share over all labelled pages.

Pages are folded to (host, path) before anything else, and each level to (node, segment). Literal children are joined back by (node,
segment), the wildcard by node, so no node's children are gathered in one row; hosts and nodes with a large share of all paths are looked up in
a broadcast table of counted size. At every level a branch is followed as long as its node has ``MIN_PAGES`` labels; what is left of a path
where the labels end is one ``**``, judged as its node. The number of levels follows the deepest branch with that many labels.

Defined results: a null url, or one without ``://``, has an empty host and path; a page without label counts as a page only;
several labels of a page all count; repeated rows count each; without any label nothing is rejected by the tree; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import looked_up, materialise

# Fixed values: (host, path prefix, verdict). A rule holds for its host and all subdomains.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SHARE = 0.01
MIN_PAGES = 5
Z = 2.576
STRENGTH = 20.0
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null if none does."""
    rules = RULES if rules is None else rules
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _segments(path: Column) -> Column:
    """Path segments with runs of digits as ``#``; a star is written as a code, since ``*`` and ``**`` are wildcards."""
    plain = F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#")
    return F.split(F.replace(plain, F.lit("*"), F.lit("%2A")), "/", -1)


def _differs(bad: Column, n: Column, pool_bad: Column, pool_n: Column, z: Column | float = Z) -> Column:
    """Whether a part's share of bad labels differs from that of the rest of its pool (two-proportion z test)."""
    rest_bad, rest_n = pool_bad - bad, pool_n - n
    share = F.try_divide(pool_bad, pool_n)
    gap = F.try_divide(bad, n) - F.try_divide(rest_bad, rest_n)
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), rest_n)))
    return F.coalesce(F.abs(gap) > z * error, F.lit(False))


def _purity(bad: Column, n: Column, prior: float) -> Column:
    return (bad + STRENGTH * prior) / (n + STRENGTH)


def _children(tree: DataFrame, seg: Column, prior: float) -> tuple[DataFrame, DataFrame]:
    """The literal children (host, template, seg, n, branch) and the wildcards (host, template, n, branch) of all nodes.

    ``branch``: (name, n, bad) of the siblings that the child is judged with; null if it does not differ from its node's pool.
    """
    node, col = ["host", "template"], F.col
    counts = tree.withColumn("seg", seg).groupBy(*node, "seg").agg(
        F.sum("pages").alias("pages"), F.sum("labelled").alias("n"), F.sum("bad").alias("bad"),
        F.first("pool_n").alias("pool_n"), F.first("pool_bad").alias("pool_bad"))
    counts = materialise(counts, "segments")
    all_pages = counts.groupBy(*node).agg(F.sum("pages").alias("all"))
    sized = counts.join(all_pages, node).withColumn("large", (col("pages") >= MIN_PAGES) & (col("pages") >= MIN_SHARE * col("all")))
    tested = col("n") >= MIN_PAGES
    rest = sized.filter(~col("large")).groupBy(*node).agg(
        F.sum("n").alias("rest_n"), F.sum("bad").alias("rest_bad"), F.count_if(tested).alias("tests"))
    limit = F.sqrt(Z * Z + 2 * F.log(F.greatest(col("tests"), F.lit(1))))
    worse = col("bad") * col("rest_n") > col("rest_bad") * col("n")
    judged_worse = _purity(col("bad"), col("n"), prior) > _purity(col("rest_bad"), col("rest_n"), prior)
    apart = tested & _differs(col("bad"), col("n"), col("rest_bad"), col("rest_n"), limit) & (worse == judged_worse)
    own = _differs(col("bad"), col("n"), col("pool_bad"), col("pool_n")).alias("own")
    parted = materialise(sized.join(rest, node, "left").withColumn("literal", col("large") | F.coalesce(apart, F.lit(False))), "children")
    wild = parted.filter(~col("literal")).groupBy(*node).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.first("pool_n").alias("pool_n"), F.first("pool_bad").alias("pool_bad"))
    both = parted.filter("literal").select(*node, "seg", "n", "bad", own).union(wild.select(*node, F.lit(None).cast("string"), "n", "bad", own))
    branched = materialise(_branches(both, prior), "branches")
    return branched.filter("seg is not null"), branched.filter("seg is null").drop("seg")


def _branches(children: DataFrame, prior: float) -> DataFrame:
    """``children`` (host, template, seg, n, bad, own) with the branch of similar siblings that each of its own is in."""
    node, col = ["host", "template"], F.col
    by_share = Window.partitionBy(*node).orderBy(_purity(col("bad"), col("n"), prior), "n", "seg")
    own = children.filter("own").withColumns({"_pn": F.lag("n").over(by_share), "_pb": F.lag("bad").over(by_share)})
    cut = F.coalesce(_differs(col("bad"), col("n"), col("bad") + col("_pb"), col("n") + col("_pn")), F.lit(False))
    numbered = own.withColumn("_cut", cut.cast("int")).withColumn("_branch", F.sum("_cut").over(by_share.rowsBetween(Window.unboundedPreceding, 0)))
    sums = numbered.groupBy(*node, "_branch").agg(
        F.struct(F.concat_ws("|+", F.min(F.coalesce("seg", F.lit("*"))), F.nullif(F.count(F.lit(1)) - 1, F.lit(0))).alias("name"),
                 F.sum("n").alias("n"), F.sum("bad").alias("bad")).alias("branch"))
    judged = numbered.join(sums, [*node, "_branch"]).select(*node, "seg", "n", "branch")
    return judged.union(children.filter("not own").select(*node, "seg", "n", F.lit(None).cast(judged.schema["branch"].dataType).alias("branch")))


def templates(paths: DataFrame) -> DataFrame:
    """(host, path, pages, labelled, bad) -> host, path, template, pool, purity.

    ``pool`` names the merged branch that judges the path.
    """
    total = paths.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("bad")).first()
    n_all, bad_all = float(total["n"] or 0), float(total["bad"] or 0)
    prior = bad_all / n_all if n_all else 0.0
    tree = paths.withColumn("segs", _segments(F.col("path"))).withColumn("template", F.lit(""))
    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("hn"), F.sum("bad").alias("hb"))
    own = _differs(F.col("hb"), F.col("hn"), F.lit(bad_all), F.lit(n_all))
    hosts = hosts.select("host", F.col("hn").alias("node_n"), F.when(own, F.col("host")).otherwise(F.lit("*")).alias("pool"),
                         F.when(own, F.col("hn").cast("double")).otherwise(F.lit(n_all)).alias("pool_n"),
                         F.when(own, F.col("hb").cast("double")).otherwise(F.lit(bad_all)).alias("pool_bad"))
    tree = materialise(looked_up(materialise(tree, "paths"), ["host"], hosts), "tree")
    keep = ["host", "path", "pages", "labelled", "bad", "segs"]
    node, ended, level = ["host", "template"], [], 0
    while True:
        seg = F.get("segs", F.lit(level))
        ends = seg.isNull() | (F.col("node_n") < MIN_PAGES)
        ended.append(tree.filter(ends).select(
            "host", "path", F.when(seg.isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", F.lit("**"))).alias("template"),
            "pool", "pool_n", "pool_bad"))
        tree = materialise(tree.filter(~ends).withColumn("seg", seg), "level")
        if tree.isEmpty():
            break
        literal, wild = _children(tree, F.col("seg"), prior)
        literal = literal.select(*node, "seg", F.struct(F.col("seg").alias("name"), "n", "branch").alias("exact"))
        wild = wild.select(*node, F.struct(F.lit("*").alias("name"), "n", "branch").alias("other"))
        joined = looked_up(materialise(looked_up(tree, [*node, "seg"], literal), "level"), node, wild)
        joined = joined.withColumn("child", F.coalesce("exact", "other"))
        name, branch = F.concat_ws("/", "template", "child.name"), F.col("child.branch")
        tree = materialise(joined.select(
            *keep, name.alias("template"), F.col("child.n").alias("node_n"),
            F.when(branch.isNotNull(), F.concat("host", F.concat_ws("/", "template", branch["name"]))).otherwise(F.col("pool")).alias("pool"),
            F.when(branch.isNotNull(), branch["n"].cast("double")).otherwise(F.col("pool_n")).alias("pool_n"),
            F.when(branch.isNotNull(), branch["bad"].cast("double")).otherwise(F.col("pool_bad")).alias("pool_bad")), "tree")
        level += 1
    found = functools.reduce(DataFrame.union, ended)
    return found.select("host", "path", "template", "pool", _purity(F.col("pool_bad"), F.col("pool_n"), prior).alias("purity"))


def judge(pages: DataFrame, labels: DataFrame, rules=None, reject: float = REJECT) -> DataFrame:
    """``pages`` (page_id, url) and ``labels`` (page_id, bad) -> page_id, host, path, rule, verdict, template, purity."""
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    marked = labels.filter("page_id is not null and bad is not null").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("labelled"), F.sum(F.col("bad").cast("long")).alias("bad"))
    folded = split.join(marked, "page_id", "left").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.coalesce("labelled", F.lit(0))).alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
    found = materialise(templates(materialise(folded, "paths")), "templates")
    rule, fixed = rule_of(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return looked_up(materialise(split, "addresses"), ["host", "path"], found).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(fixed, learnt).alias("verdict"), F.concat("host", "template").alias("template"), "purity")
