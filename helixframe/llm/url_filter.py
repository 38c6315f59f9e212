"""URL filter: listed rules first, then a path-template tree per host.

Rules are (host, path beginning, verdict): a rule fits its host and all subdomains if the path
starts with its own; the longest rule wins. Paths that a rule judges are the labelled examples, each
different path one.

All other urls are judged by the tree of their host. A path is a way through segments from the root;
numbers and long hexadecimal runs are wildcards from the start. A node whose examples agree, or that
has none, is a template as it is, with all that follows. A node with examples of both verdicts is
split by its next segment, after the segments that all its ways share:

* children met on one path only are one wildcard, `{any}`: a segment that is never met again is none
  to judge by;
* children whose share of blocked examples does not differ from the node's by a two-proportion test
  are merged, `{alike}`, if at least two children have examples;
* all others keep their segment.

The purity of a template is the share of blocked examples on it, drawn to its parent's purity by
`PRIOR` examples' weight; the root of a host is drawn to one half, which is the rule of succession. A
child without an example has its parent's purity, and so that of the nearest ancestor that has one. A
template with a purity of `REJECT` or more is blocked with all its urls: a host needs three examples,
all of them blocked, or about four blocked of each five. Hosts without an example are allowed.

Urls are counted by host and path before anything else is shuffled, so a host with a third of all
rows is spread over its different paths, and a node of a tree is one row with counts. There is a step
of a few narrow joins for each level at which some host is split; nothing is cut off at a depth.

Cases: a url that is null or has no `://` has an empty host and path, fits no rule, is no example and
is allowed; of two rules of equal length that fit, the one that sorts last by host, path and verdict
wins; rows with a null id and repeated rows are judged as often as they occur; very long urls are
judged whole; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import small_side
from helixframe.storage import scratch

PRIOR, REJECT, Z = 2.0, 0.8, 1.96


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substr(url, F.instr(url, "://") + 3), "#", 1))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    path = F.substr(rest, F.length(host) + 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """Numbers and long hexadecimal runs become wildcards; what surrounds them stays."""
    numbers = F.regexp_replace(segment, "[0-9]+", "{n}")
    return F.when(segment.rlike("^[0-9a-f]{16,}$"), F.lit("{x}")).otherwise(numbers)


def _drawn(blocked: Column, examples: Column, parent: Column) -> Column:
    return F.when(examples > 0, (blocked + PRIOR * parent) / (examples + PRIOR)).otherwise(parent)


def ways_of(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, shapes, paths, blocked, allowed) over rows (host, path): the different paths of a way
    of segment shapes, and how many of them a rule judges either way."""
    paths = urls.filter("host <> ''").groupBy("host", "path").agg(F.lit(1).alias("one"))
    _, says = rule_verdict(F.col("host"), F.col("path"), rules)
    counted = paths.select("host", shapes_of(F.col("path")).alias("shapes"), says.alias("says")).groupBy("host", "shapes")
    return counted.agg(F.count(F.lit(1)).alias("paths"), F.count(F.when(F.col("says") == "block", 1)).alias("blocked"), F.count(F.when(F.col("says") == "allow", 1)).alias("allowed"))


def shapes_of(path: Column) -> Column:
    return F.transform(F.split(F.substr(path, F.lit(2)), "/"), _shape)


def template_purity(ways: DataFrame) -> DataFrame:
    """(host, shapes, template, purity) of the ways of all hosts that have an example."""
    ways = scratch(ways, "url-ways")
    seen, size = F.col("blocked") + F.col("allowed"), F.size("shapes")
    hosts = ways.groupBy("host").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a")).filter("b + a > 0")
    root = _drawn(F.col("b"), F.col("b") + F.col("a"), F.lit(0.5))
    now = ways.join(hosts, "host").select(
        "host", "shapes", "paths", "blocked", "allowed", F.lit("").alias("node"), F.lit(0).alias("at"), root.alias("purity"), ((F.col("b") > 0) & (F.col("a") > 0)).alias("open")
    )
    now, done = scratch(now, "url-level"), []
    while True:
        done.append(now.filter(~F.col("open")))
        if (level := scratch(now.filter("open").drop("open"), "url-open")).isEmpty():
            break
        # What all ways of a node share comes first: as much as the least and the greatest of them do.
        rest = F.slice("shapes", F.col("at") + 1, F.greatest(size - F.col("at"), F.lit(1)))
        ends = level.groupBy("host", "node").agg(F.min(rest).alias("low"), F.max(rest).alias("high"))
        differ = F.array_position(F.zip_with("low", "high", lambda x, y: x.eqNullSafe(y)), False)
        shared = F.when(differ > 0, differ - 1).otherwise(F.size("low")).cast("int")
        level = level.join(ends.select("host", "node", shared.alias("shared"), F.slice("low", F.lit(1), shared).alias("begin")), ["host", "node"])
        level = level.select("host", "shapes", "paths", "blocked", "allowed", "node", "purity", F.concat("node", F.array_join(F.transform("begin", lambda x: F.concat(F.lit("/"), x)), "")).alias("stem"), (F.col("at") + F.col("shared")).alias("at"))
        level = level.withColumn("segment", F.coalesce(F.concat(F.lit("/"), F.get("shapes", F.col("at"))), F.lit("")))  # an ended way has none
        children = level.groupBy("host", "node", "segment").agg(F.sum("paths").alias("paths"), F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"), F.first("purity").alias("purity"))
        children = scratch(children, "url-children")
        parents = children.groupBy("host", "node").agg(F.count(F.when(seen > 0, 1)).alias("examined"), F.sum("blocked").alias("all_blocked"), F.sum(seen).alias("all_seen"))
        share = F.col("all_blocked") / F.col("all_seen")
        alike = (seen > 0) & (F.abs(F.col("blocked") / F.nullif(seen, F.lit(0)) - share) <= Z * F.sqrt(share * (1 - share) / F.nullif(seen, F.lit(0))))
        name = F.when(F.col("segment") == "", "").when(F.col("paths") == 1, "/{any}").when(alike & (F.col("examined") > 1), "/{alike}").otherwise(F.col("segment"))
        named = children.join(parents, ["host", "node"]).withColumn("name", name)
        groups = named.groupBy("host", "node", "name").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"), F.first("purity").alias("parent"))
        judged = named.select("host", "node", "segment", "name").join(groups, ["host", "node", "name"])
        judged = judged.select("host", "node", "segment", "name", _drawn(F.col("b"), F.col("b") + F.col("a"), F.col("parent")).alias("drawn"), ((F.col("b") > 0) & (F.col("a") > 0)).alias("mixed"))
        after = level.join(judged, ["host", "node", "segment"]).select(
            "host", "shapes", "paths", "blocked", "allowed", F.concat("stem", "name").alias("node"), F.least(F.col("at") + 1, size).cast("int").alias("at"), F.col("drawn").alias("purity"),
            (F.col("mixed") & (F.col("at") + 1 < size)).alias("open"),
        )
        now = scratch(after, "url-level")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select("host", "shapes", F.concat("node", F.when(F.col("at") < size, "/{rest}").otherwise("")).alias("template"), "purity")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), one row per page; purity is null for
    a host without an example."""
    host, path = split_url(F.coalesce(F.col(f"`{url_col}`"), F.lit("")))
    split = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, says = rule_verdict(F.col("host"), F.col("path"), rules)
    ruled = split.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"), shapes_of(F.col("path")).alias("shapes"))
    purity = scratch(template_purity(ways_of(split, rules)), "url-purity")
    joined = ruled.join(small_side(purity), ["host", "shapes"], "left")
    method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), F.coalesce("template", F.lit("/{rest}")).alias("template"), "purity")
