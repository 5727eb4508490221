"""URL filter: given rules first, then a tree of path templates per host.

A path becomes a template: digits and long hexadecimal runs of a segment become wildcards, then, from
branch to branch, segments that are rare among many siblings, and siblings whose labelled share of bad urls
was compared with that of the rest below the same parent and does not differ significantly, become ``*``. A
branch that cannot be compared, for want of labels on either side or as all labels are equal, keeps its
name. What all paths of a branch have in common is taken at once, whatever its length, so that the tree is
as deep as its paths part, and there is a round of jobs for each such depth.

A template is rejected if its share of bad urls, smoothed towards its host's and the host's towards the
global one, is at least one half. Labels are the verdicts of the rules, or those that the caller hands in.
The global share may speak for a host but not against it: it counts as one half at most. A template without
a label of its own takes its host's share, if the host has good and bad labels, so that its branches could
be compared. Else, as where rules name some branches of a host and only block, the others are not judged:
their share is NULL and they are allowed.

Urls are counted by (host, shape) before anything is compared, so that a host with a third of all urls is
some rows of counts; branches with very many of these are split where they meet what is known of them.

Defined results: a NULL url or one without ``://`` has an empty host and path, which form a host of
their own. A NULL page_id stays NULL. Of equally long rules the first listed wins. Repeated urls are
judged alike. Without labels nothing is rejected. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldcat.staging import cut

# A segment is variable if its parent has more children than this and it has less than its even share,
# or just that share and no significantly different one of bad urls.
FANOUT = 20
# Two shares differ if the statistic of their difference is beyond this.
Z = 1.96
STRENGTH = 5.0
REJECT = 0.5
# Into how many parts the rows of one branch are split.
_PARTS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, NULL if none does. Rules are (``host/path``, verdict)."""
    found = F.lit(None).cast("string")
    # What is added last is tested first: the longest, and of equals the first listed.
    for rule, _ in sorted(reversed(rules), key=lambda r: len(r[0])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The path with the variable parts of its segments as wildcards."""
    hexadecimal = F.regexp_replace(path, r"(?<![A-Za-z0-9])(?=[a-f0-9]*[0-9])[0-9a-f]{8,}(?:-[0-9a-f]{4,})*(?![A-Za-z0-9])", "<h>")
    return F.regexp_replace(hexadecimal, r"[0-9]+", "<n>")


def _share(bad: Column, labelled: Column, prior: Column) -> Column:
    return (bad + F.lit(STRENGTH) * prior) / (labelled + F.lit(STRENGTH))


def _lookup(rows: DataFrame, facts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """An inner join on ``keys``, of which ``facts`` has one row each and ``rows`` any number."""
    split = rows.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(_PARTS)).cast("int"))
    found = split.select(*keys, "_part").distinct().join(facts, keys)
    return split.join(found, [*keys, "_part"]).drop("_part")


_COUNTS = ["n", "labelled", "bad"]
_BRANCH = ["host", "template"]


def _in_common(low: Column, high: Column) -> Column:
    """How many segments the least and the greatest of some paths begin with alike, and so all of them."""
    places = F.sequence(F.lit(1), F.greatest(F.least(F.size(low), F.size(high)), F.lit(1)))
    apart = F.array_position(F.transform(places, lambda i: ~F.get(low, i - 1).eqNullSafe(F.get(high, i - 1))), True)
    return F.when(apart == 0, F.least(F.size(low), F.size(high))).otherwise(apart - 1).cast("int")


def _joined(template: Column, parts: Column) -> Column:
    return F.concat(template, F.array_join(F.transform(parts, lambda p: F.concat(F.lit("/"), p)), ""))


def _named(children: DataFrame) -> DataFrame:
    """(host, template, segment, called) of the children (host, template, segment, counts) of branches."""
    sums = [F.sum(c).alias(f"all_{c}") for c in _COUNTS]
    parents = children.groupBy(*_BRANCH).agg(F.count(F.lit(1)).alias("children"), *sums)
    beside = F.col("all_labelled") - F.col("labelled")
    pooled = F.try_divide(F.col("all_bad"), F.col("all_labelled"))
    apart = F.abs(F.try_divide(F.col("bad"), F.col("labelled")) - F.try_divide(F.col("all_bad") - F.col("bad"), beside))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("labelled")) + F.try_divide(F.lit(1), beside)))
    comparable = F.coalesce((F.col("labelled") > 0) & (beside > 0) & (pooled > 0) & (pooled < 1), F.lit(False))
    differs = F.coalesce(F.when(comparable, apart > Z * error), F.lit(False))
    over = F.col("n") * F.col("children") - F.col("all_n")
    rare = (F.col("children") > FANOUT) & ((over < 0) | (over == 0) & ~differs)
    called = F.when(rare | (comparable & ~differs), "*").otherwise(F.col("segment"))
    return _lookup(children, parents, _BRANCH, "segment").select(*_BRANCH, "segment", called.alias("called"))


def path_templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, n, labelled, bad) of the different paths, from (host, shape, bad); bad may be NULL."""
    counted = urls.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("bad").alias("labelled"),
        F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"),
    )
    parts = F.when(F.length("shape") > 1, F.split(F.expr("substring(shape, 2)"), "/"))
    parts = F.coalesce(parts, F.array().cast("array<string>"))
    open_rows = cut(counted.withColumn("template", F.lit("")).withColumn("rest", parts))
    kept = ["host", "shape", "template", *_COUNTS]
    done = open_rows.where("false").select(*kept)
    while not open_rows.isEmpty():
        both = open_rows.groupBy(*_BRANCH).agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        common = _in_common(F.col("low"), F.col("high"))
        both = both.select(*_BRANCH, common.alias("common"))
        rows = _lookup(open_rows, both, _BRANCH, "shape")
        ahead = F.slice("rest", F.lit(1), F.col("common"))
        left = F.slice("rest", F.col("common") + 1, F.greatest(F.size("rest"), F.lit(1)))
        rows = rows.select("host", "shape", _joined(F.col("template"), ahead).alias("template"), *_COUNTS, left.alias("rest"))
        rows = cut(rows.withColumn("segment", F.get("rest", F.lit(0))))
        done = done.unionByName(rows.where("segment IS NULL").select(*kept))
        here = rows.where("segment IS NOT NULL")
        children = here.groupBy(*_BRANCH, "segment").agg(*[F.sum(c).alias(c) for c in _COUNTS])
        moved = _lookup(here, _named(children), [*_BRANCH, "segment"], "shape")
        rest = F.slice("rest", F.lit(2), F.greatest(F.size("rest"), F.lit(1)))
        moved = moved.withColumn("rest", rest).withColumn("template", F.concat("template", F.lit("/"), "called"))
        open_rows = cut(moved.select(*kept, "rest"))
    return done


def templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, n, labelled, bad, bad_share); counts and share are those of the template."""
    tree = cut(path_templates(urls))
    # How often the rules block says nothing against a host.
    world = tree.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    world_share = F.lit(min(world.bad / world.labelled if world.labelled else 0.0, REJECT))
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    host_share = _share(F.sum("bad"), F.sum("labelled"), world_share).alias("host_share")
    mixed = (F.sum("bad") > 0) & (F.sum("bad") < F.sum("labelled"))
    hosts = tree.groupBy("host").agg(host_share, mixed.alias("mixed"))
    share = _share(F.col("bad"), F.col("labelled"), F.col("host_share"))
    judged = _lookup(tree.groupBy(*_BRANCH).agg(*sums), hosts, ["host"], "template").select(
        *_BRANCH, *_COUNTS, F.when((F.col("labelled") > 0) | F.col("mixed"), share).alias("bad_share")
    )
    return _lookup(tree.select("host", "shape", "template"), judged, _BRANCH, "shape")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, bad_share.

    ``labels`` may add (page_id, bad) for pages without a rule, one row a page.
    """
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    said = F.lit(None).cast("string")
    for rule, verdict in rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    parsed = parsed.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    parsed = parsed.withColumn("said", said).withColumn("shape", shape_of(F.col("path")))
    bad = F.col("said") == "block"
    known = parsed
    if labels is not None:
        known = parsed.join(labels.select("page_id", F.col("bad").alias("label")), "page_id", "left")
        bad = F.coalesce(bad, F.col("label").cast("boolean"))
    tree = templates(known.select("host", "shape", bad.alias("bad")))
    tree = tree.select("host", "shape", "template", "bad_share")
    joined = _lookup(parsed, tree, ["host", "shape"], "page_id")
    verdict = F.coalesce("said", F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "bad_share")
