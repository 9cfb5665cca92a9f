"""URL filters: domain rules, and a tree of path templates that learns from what the rules decide.

The paths of each host form a tree. Level by level, segments that vary (many values, none with a share of its own)
become a wildcard; those with a share, or with labels unlike their parent's, stay as they are. Sibling branches are merged if what stands below them is distributed
alike and no labels contradict it. Pages that a rule decides are labels: a template is rejected when their blocked share,
smoothed towards its parent's and that towards its host's, is high; without labels of its own it has its parent's share.

Everything is a DataFrame of built-in functions. Work is done on distinct paths with counts, so a host or a path with very
many pages is one row with a large count wherever a step could be uneven.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import drop, stored

# Verdict, domain and beginning of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A segment stays literal with this share of its parent's pages; so at most 1 / SHARE children of a node can be merged.
SHARE = 0.02
LEAST_PAGES = 3
#: Total variation up to which two branches are alike, and standard errors up to which their labels agree.
ALIKE = 0.15
AGREE = 2.0
#: Weight of the parent in labels, and the share of blocked labels from which a template is rejected.
SMOOTHING = 5.0
REJECT = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty for null and where ``://`` is missing."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null where none does."""
    name = verdict = None
    for kind, domain, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        name = F.when(fits, domain + start) if name is None else name.when(fits, domain + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def _segments(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "^/", ""), "/")


_KINDS = 6


def _kind(segment: Column) -> Column:
    """The kind of a segment: none, empty, number, word, with an extension, other."""
    return (
        F.when(segment.isNull(), 0)
        .when(segment == "", 1)
        .when(segment.rlike("^[0-9]+$"), 2)
        .when(segment.rlike("^[^0-9./]+$"), 3)
        .when(segment.rlike(r"^[^./]+\.[^./]+$"), 4)
        .otherwise(5)
    )


def _level(paths: DataFrame) -> DataFrame:
    """The paths one segment further: literal, merged into an alike sibling, or a wildcard. All have a segment at ``at``."""
    segment, following = F.get("segments", F.col("at")), F.get("segments", F.col("at") + 1)
    here = paths.withColumn("segment", segment)
    below = [F.sum(F.when(_kind(following) == k, F.col("n")).otherwise(0)).alias(f"kind{k}") for k in range(_KINDS)]
    nodes = here.groupBy("host", "template", "segment").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"), *below
    )
    sums = [F.sum(x).alias(f"parent_{x}") for x in ("n", "blocked", "allowed")]
    parents = nodes.groupBy("host", "template").agg(*sums)
    large = (F.col("n") >= LEAST_PAGES) & (F.col("n") >= SHARE * F.col("parent_n"))
    seen, parent_seen = F.col("blocked") + F.col("allowed"), F.col("parent_blocked") + F.col("parent_allowed")
    share = (F.col("parent_blocked") + 1) / (parent_seen + 2)
    unlike = F.abs(F.col("blocked") / F.greatest(seen, F.lit(1)) - share) > AGREE * F.sqrt(share * (1 - share) / F.greatest(seen, F.lit(1)))
    pure = (seen >= LEAST_PAGES) & unlike
    literal = nodes.join(parents, ["host", "template"]).select("*", large.alias("large")).where(F.col("large") | pure)
    literal = stored(literal.drop(*(f"parent_{x}" for x in ("n", "blocked", "allowed"))), "url-literals")

    # Only segments with a share of the pages are compared; labelled ones are never merged into one without labels.
    a, b = literal.where("large").alias("a"), literal.where("large").alias("b")
    larger = F.struct(F.expr("b.blocked + b.allowed > 0"), "b.n", "b.segment") > F.struct(F.expr("a.blocked + a.allowed > 0"), "a.n", "a.segment")
    variation = sum(F.abs(F.col(f"a.kind{k}") / F.col("a.n") - F.col(f"b.kind{k}") / F.col("b.n")) for k in range(_KINDS)) / 2
    seen_a, seen_b = (F.col(f"{x}.blocked") + F.col(f"{x}.allowed") for x in "ab")
    pooled = (F.col("a.blocked") + F.col("b.blocked") + 1) / (seen_a + seen_b + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(seen_a, F.lit(1)) + 1 / F.greatest(seen_b, F.lit(1))))
    apart = F.abs(F.col("a.blocked") / F.greatest(seen_a, F.lit(1)) - F.col("b.blocked") / F.greatest(seen_b, F.lit(1)))
    agree = (seen_a == 0) | (seen_b == 0) | (apart <= AGREE * error)
    same_parent = (F.col("a.host") == F.col("b.host")) & (F.col("a.template") == F.col("b.template"))
    alike = stored(
        a.join(b, same_parent & larger & (variation <= ALIKE) & agree).select(
            "a.host",
            "a.template",
            "a.segment",
            F.col("b.segment").alias("into"),
            F.struct(seen_b > 0, "b.n").alias("into_n"),
            F.when((seen_a == 0) & (seen_b > 0), F.col("b.blocked") / seen_b >= REJECT).alias("side"),
        ),
        "url-alike",
    )
    moved = alike.select("host", "template", F.col("segment").alias("into")).distinct()
    target = (
        alike.join(moved, ["host", "template", "into"], "left_anti")
        .groupBy("host", "template", "segment")
        .agg(F.max(F.struct("into_n", "into"))["into"].alias("into"), F.min("side").alias("low"), F.max("side").alias("high"))
        .where(F.col("low").eqNullSafe(F.col("high")))  # siblings with contradicting labels decide nothing
        .drop("low", "high")
    )
    names = literal.join(target, ["host", "template", "segment"], "left").select(
        "host", "template", "segment", F.coalesce("into", "segment").alias("name")
    )
    grown = here.join(names, ["host", "template", "segment"], "left")
    step = F.concat("template", F.lit("/"), F.coalesce("name", F.lit("*")))
    return grown.select(
        "host", "path", "segments", "n", "blocked", "allowed", (F.col("at") + 1).alias("at"), step.alias("template"), F.col("template").alias("parent")
    )


def _ahead(paths: DataFrame) -> DataFrame:
    """The paths with what is certain ahead of them: a node of few pages has wildcards only, and segments that all paths of a
    node share stay literal, since nothing stands beside them. So a long path takes no more rounds than it has forks."""
    rest = F.expr("slice(segments, at + 1, size(segments))")
    open_paths = paths.where("size(segments) > at")
    nodes = open_paths.groupBy("host", "template").agg(F.sum("n").alias("pages"), F.min(rest).alias("low"), F.max(rest).alias("high"))
    # the first and the last in order share what all share
    equal = F.expr("zip_with(slice(low, 1, least(size(low), size(high))), slice(high, 1, least(size(low), size(high))), (a, b) -> a = b)")
    same = F.when(F.forall(equal, lambda x: x), F.size(equal)).otherwise(F.array_position(equal, False) - 1).cast("int")
    nodes = nodes.select("host", "template", (F.col("pages") < LEAST_PAGES).alias("few"), same.alias("same"))
    moved = paths.join(nodes, ["host", "template"], "left")
    going = F.expr("size(segments) > at")
    taken = F.when(~going, 0).when(F.col("few"), F.size("segments") - F.col("at")).otherwise(F.col("same"))
    moved = moved.withColumn("taken", taken)
    added = F.when(F.col("few"), F.expr("array_repeat('*', taken)")).otherwise(F.expr("slice(segments, at + 1, taken)"))
    moved = moved.withColumn("added", added)
    joined = lambda parts: F.concat(F.col("template"), F.expr(f"array_join(transform({parts}, s -> '/' || s), '')"))
    return moved.select(
        "host",
        "path",
        "segments",
        "n",
        "blocked",
        "allowed",
        (F.col("at") + F.col("taken")).alias("at"),
        F.when(F.col("taken") > 0, joined("added")).otherwise(F.col("template")).alias("template"),
        F.when(F.col("taken") > 0, joined("slice(added, 1, taken - 1)")).otherwise(F.col("parent")).alias("parent"),
    )


def _tree(paths: DataFrame) -> DataFrame:
    """The paths with their whole templates and those of their parents. Only paths with segments ahead are carried on."""
    done, current = [], paths
    while True:
        following = stored(_ahead(current), "url-templates")
        if current is not paths:
            drop(current)
        done.append(following.where("size(segments) = at").drop("at", "segments"))
        rest = following.where("size(segments) > at")
        if rest.isEmpty():
            return reduce(DataFrame.union, done)
        current = stored(_level(rest), "url-level")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and the smoothed share of blocked labels of every row of ``pages``.

    The verdict is the rule's where one fits, else block where the smoothed share of a template reaches ``REJECT``, else allow. A
    null url, and one without ``://``, has an empty host and path. Repeated rows each get a row and count as often as
    they occur; null ids are kept; other columns are not read. Without any labelled page everything is allowed.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    known = stored(split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled")), "url-rules")
    paths = known.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
    )
    paths = paths.select("*", _segments(F.col("path")).alias("segments"), F.lit("").alias("template"), F.lit("").alias("parent"))
    tree = _tree(stored(paths.withColumn("at", F.lit(0)), "url-paths"))

    seen, blocked = (F.sum("blocked") + F.sum("allowed")).alias("seen"), F.sum("blocked").alias("blocked")
    every = tree.agg(seen, blocked).first()  # two numbers
    overall = ((every["blocked"] or 0) + 1) / ((every["seen"] or 0) + 2)

    def smoothed(prior) -> Column:
        return (F.col("blocked") + SMOOTHING * prior) / (F.col("seen") + SMOOTHING)

    hosts = tree.groupBy("host").agg(seen, blocked).select("host", smoothed(F.lit(overall)).alias("host_share"))
    parents = tree.groupBy("host", "parent").agg(seen, blocked).join(hosts, "host")
    parents = parents.select("host", "parent", smoothed(F.col("host_share")).alias("parent_share"))
    templates = tree.groupBy("host", "parent", "template").agg(seen, blocked).join(parents, ["host", "parent"])
    templates = templates.select("host", "parent", "template", smoothed(F.col("parent_share")).alias("blocked_share"))
    by_path = tree.join(templates, ["host", "parent", "template"]).select("host", "path", "template", "blocked_share")
    method = F.when(F.col("blocked_share") >= REJECT, "block").otherwise("allow")
    return known.join(by_path, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "blocked_share"
    )
