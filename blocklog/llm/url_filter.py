"""URL filter by rules and, where no rule fits, by a path-template tree for each host (operator 5).

Distinct paths of a host, digit runs written as `#`, are the leaves. The tree is generalised level by level: a
segment of a node with many different ones becomes the wildcard `*` unless it holds a fair share of the node's
urls, and the branches that are left are merged where neither their labels (block against allow, among labelled urls
only) nor what follows them differ significantly; so a branch without labels joins a like one that has some.

Purity, the share of blocked among labelled urls, is smoothed down the tree: a node's labels are added to `PRIOR`
labels with the purity of its parent, the root's parent having the share of all urls. A template without labels of its
own thus has the purity of its nearest labelled ancestor. A template of high purity is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.llm.urls import host_of, path_of
from blocklog.session import Staging

#: A node with more different segments than this turns the rare ones into a wildcard.
FAN_OUT = 16
#: A segment with this share of a node's urls stays as it is.
SHARE = 0.05
#: Two branches whose counts differ by more than so many standard deviations of chi-squared above its mean are not merged.
UNLIKE = 3.0
#: Labels that a parent's purity counts for in each node.
PRIOR = 4.0
REJECT = 0.8
#: Bins of what follows a branch.
_BINS = 32


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits the host or a domain above it and begins the path, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _merge(nodes: pd.DataFrame) -> pd.DataFrame:
    """Names for the branches of one node: each joins the first earlier group that it does not differ from."""
    nodes = nodes.sort_values(["n", "seg"], ascending=[False, True], kind="stable")
    groups: list[tuple[list[str], np.ndarray, np.ndarray]] = []
    for row in nodes.itertuples():
        labels, follows = np.array([row.block, row.allow], float), np.array(row.follows, float)
        for names, of_labels, of_follows in groups:
            if row.seg != "*" and names != ["*"] and max(_unlike(labels, of_labels), _unlike(follows, of_follows)) <= UNLIKE:
                names.append(row.seg)
                of_labels += labels
                of_follows += follows
                break
        else:
            groups.append(([row.seg], labels, follows))
    named = {seg: "|".join(sorted(names)) for names, *_ in groups for seg in names}
    return nodes[["prefix", "seg"]].assign(name=nodes["seg"].map(named))


def _unlike(a: np.ndarray, b: np.ndarray) -> float:
    """Standard deviations by which chi-squared of two rows of counts is above its mean; half a count is added to each used cell.

    Rows of which one is empty do not differ.
    """
    used = a + b > 0
    if used.sum() < 2 or not a.any() or not b.any():
        return 0.0
    table = np.stack([a[used], b[used]]) + 0.5
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    freedom = used.sum() - 1
    return float((((table - expected) ** 2 / expected).sum() - freedom) / np.sqrt(2 * freedom))


def path_templates(leaves: DataFrame, stage: Staging) -> DataFrame:
    """`leaves` (host, shape, n, block, allow) with their template, an array of segments, and the level they were cut at.

    A leaf that is alone in its node has no more branches; its other segments go on as they are.

    All levels work on counts of distinct shapes. A node's branches are brought together only after the rare ones have
    become a wildcard, at most FAN_OUT or 1 / SHARE of them, so no host or node is too large for a task.
    """
    parts = F.split(F.regexp_replace("shape", "^/", ""), "/", -1)
    key = F.array_join("template", "/")
    now = stage.table(leaves.select("*", parts.alias("parts"), F.array().cast("array<string>").alias("template")).withColumn("prefix", F.xxhash64("host", key)), "leaves")
    done, level = None, 0
    while True:
        several = now.groupBy("prefix").agg(F.count("*").alias("leaves")).where("leaves > 1").select("prefix")
        several = stage.table(several, f"nodes-{level}")
        ended = F.size("parts") <= level
        last = now.join(several, "prefix", "left_anti").unionByName(now.join(several, "prefix", "left_semi").where(ended))
        rest = F.slice("parts", level + 1, F.greatest(F.size("parts") - level, F.lit(0)))
        last = stage.table(last.withColumn("template", F.concat("template", rest)), f"done-{level}")
        done = last if done is None else done.unionByName(last)
        now = stage.table(now.join(several, "prefix", "left_semi").where(~ended), f"open-{level}")
        if now.isEmpty():
            return done.select("host", "shape", "n", "block", "allow", "template")
        here = now.withColumn("seg", F.get("parts", F.lit(level)))
        follow = F.pmod(F.xxhash64(F.coalesce(F.get("parts", F.lit(level + 1)), F.lit("/"))), F.lit(_BINS))
        sums = [F.sum(c).alias(c) for c in ("n", "block", "allow")]
        segments = stage.table(here.groupBy("prefix", "seg").agg(*sums, *[F.sum(F.when(follow == k, F.col("n")).otherwise(0)).alias(f"f{k}") for k in range(_BINS)]), f"segments-{level}")
        nodes = segments.groupBy("prefix").agg(F.count("*").alias("different"), F.sum("n").alias("total"))
        rare = (F.col("different") > FAN_OUT) & (F.col("n") < SHARE * F.col("total"))
        general = segments.join(nodes, "prefix").select("prefix", "seg", F.when(rare, "*").otherwise(F.col("seg")).alias("as"), "n", "block", "allow", *[f"f{k}" for k in range(_BINS)])
        general = stage.table(general, f"general-{level}")
        branches = general.groupBy("prefix", F.col("as").alias("seg")).agg(*sums, *[F.sum(f"f{k}").alias(f"f{k}") for k in range(_BINS)])
        branches = branches.select("prefix", "seg", "n", "block", "allow", F.array(*[f"f{k}" for k in range(_BINS)]).alias("follows"))
        named = branches.groupBy("prefix").applyInPandas(_merge, "prefix bigint, seg string, name string")
        names = stage.table(general.select("prefix", "seg", F.col("as")).join(named.withColumnRenamed("seg", "as"), ["prefix", "as"]).select("prefix", "seg", "name"), f"names-{level}")
        stepped = here.join(names, ["prefix", "seg"])
        now = stepped.select("host", "shape", "n", "block", "allow", "parts", F.array_append("template", F.col("name")).alias("template"))
        now = stage.table(now.withColumn("prefix", F.xxhash64("host", key)), f"level-{level}")
        level += 1


def template_purity(tree: DataFrame, usual: float) -> DataFrame:
    """(host, template, purity) of the templates of `path_templates`, smoothed from the root of each host down."""
    node = F.posexplode(F.transform(F.sequence(F.lit(0), F.size("template")), lambda k: F.slice("template", F.lit(1), k)))
    counted = tree.groupBy("host", "template").agg(F.sum("block").alias("block"), F.sum(F.col("block") + F.col("allow")).alias("known"))
    nodes = counted.select("host", node.alias("depth", "node"), "block", "known").groupBy("host", "depth", "node").agg(F.sum("block").alias("block"), F.sum("known").alias("known"))
    placed = counted.select("host", "template", node.alias("depth", "node")).join(nodes, ["host", "depth", "node"])
    path = placed.groupBy("host", "template").agg(F.sort_array(F.collect_list(F.struct("depth", "block", "known"))).alias("path"))
    purity = F.aggregate("path", F.lit(usual), lambda above, x: (x["block"] + F.lit(PRIOR) * above) / (x["known"] + F.lit(PRIOR)))
    return path.select("host", "template", purity.alias("purity"))


def filter_urls(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for each row.

    The verdict is the rule's, else block for templates whose smoothed purity of blocked labels reaches REJECT and
    allow otherwise; urls under a rule are the labels. `template` and `purity` are also given where a rule decides.

    A null url, or one without `://`, has an empty host and path and the empty template; a null id stays null; repeated
    rows are judged alike and each counts; an empty table gives no rows; other columns are not read.
    """
    stage = Staging(pages.sparkSession)
    url = F.col(url_col)
    split = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    shaped = split.select("*", rule.alias("rule"), verdict.alias("ruled"), F.regexp_replace("path", "[0-9]+", "#").alias("shape"))
    judged = stage.table(shaped, "urls")
    leaves = judged.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("block"), F.count_if(F.col("ruled") == "allow").alias("allow")
    )
    tree = stage.table(path_templates(leaves, stage), "templates")
    total = tree.agg(F.sum("block").alias("block"), F.sum(F.col("block") + F.col("allow")).alias("known")).first()
    usual = ((total.block or 0) + 1) / ((total.known or 0) + 2)
    purity = stage.table(template_purity(tree, usual), "purity")
    written = F.when(F.size("template") == 0, "").otherwise(F.concat(F.lit("/"), F.array_join("template", "/")))
    verdicts = stage.table(tree.join(purity, ["host", "template"]).select("host", "shape", written.alias("template"), "purity"), "verdicts")
    return judged.join(verdicts, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"), "template", "purity"
    )
