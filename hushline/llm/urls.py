"""URL filters: a rule list first, then a path-template tree for each host.

Urls without a rule are judged by their template, in one tree a host over all its urls. Level
by level, the children of a node (host and template so far) are looked at together. Those
which differ significantly from their node, by the number of their urls, are branches of
their own: in their labels, or in what is below them (whether paths end there, go on with a
number, a word or anything else). Those which are alike are merged into one wildcard. What
stays is a small number of templates a host; one is rejected if it has enough labelled urls
of its own and its share of bad ones, smoothed by the host's and the corpus's, is high enough.

A url's label is that of its own page: whether the visible text fails the current quality
policy. A url which a rule judges has the rule's verdict as its label, which
shapes the tree but rejects no template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hushline.llm import quality
from hushline.llm.storage import free_name, written

#: Fixed list of the task: verdict, host with path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Unlabelled segments without a finding of their own share the wildcard in a node with MANY children.
MANY = 8
#: Chance, over all children of a node, that one which is like the node is taken for different.
CHANCE = 0.05
#: Weight of the prior in labelled urls, the purity from which a template is rejected, and the
#: labelled urls of its own that it needs for that.
PRIOR, REJECTED, LEAST = 4.0, 0.8, 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or end, A-Z lower-cased; path up to ? or #; both empty without ://."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of rule and verdict of the longest rule that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, tail = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


#: What is below a child: how a path may go on.
BELOW = ("ends", "number", "word", "other")


def _below(segment: Column) -> Column:
    """The kind of a next segment; a number or word may have an extension."""
    return (
        F.when(segment.isNull(), "ends").when(segment.rlike(r"\A[0-9]+(?:\.\w{1,5})?\z"), "number")
        .when(segment.rlike(r"\A\p{L}+(?:\.\w{1,5})?\z"), "word").otherwise("other")
    )


def _apart(own: Column, rate: Column, n: Column) -> Column:
    """How unlikely a share `own` of n is at `rate`: Chernoff's bound of the binomial tail, which also holds for small counts."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / y)).otherwise(0.0)

    return n * (part(own, rate) + part(1 - own, 1 - rate))


def _different() -> Column:
    """Whether a child differs from its node more than chance among its siblings allows.

    A labelled child is judged by its share of bad labels, one without labels by having none,
    and each by the shares of what is below it.
    """
    rate = (F.col("all_bad") + 1) / (F.col("all_labelled") + 2)
    by_bad = _apart(F.col("n_bad") / F.col("labelled"), rate, F.col("labelled"))
    by_none = -F.col("n") * F.ln(1 - F.col("all_labelled") / (F.col("all") + 1))
    tests = [F.when(F.col("labelled") > 0, by_bad).otherwise(by_none)]
    for kind in BELOW:
        rate = (F.col(f"all_{kind}") + 1) / (F.col("all") + 2)
        tests.append(_apart(F.col(f"n_{kind}") / F.col("n"), rate, F.col("n")))
    return F.greatest(*tests) > F.ln(2 * len(tests) * F.col("width") / CHANCE)


def templates(urls: DataFrame) -> DataFrame:
    """Adds column template to rows of (host, tree, path, bad): bad is 1, 0 or null for unlabelled.

    Each (host, tree) has a tree of its own, which grows until no node has children left. A
    node with fewer than LEAST labelled urls cannot have a rejected template below it, so all
    its deeper segments are wildcards at once; levels are as many as the labels need.
    Statistics are sums by (host, tree, template so far, segment), so a host with very many
    urls is few rows; the way back to the urls is a join which adaptive execution splits.
    """
    node = ["host", "tree", "template"]
    rows = written(urls.withColumn("segments", _segments(F.col("path"))).withColumn("template", F.lit("")), "urls")
    out, level = None, 0
    while True:
        depth = F.size("segments")
        below = _below(F.get("segments", F.lit(level + 1)))
        children = rows.where(depth > level).groupBy(*node, F.get("segments", F.lit(level)).alias("segment")).agg(
            F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad"),
            *(F.count_if(below == kind).alias(f"n_{kind}") for kind in BELOW),
        )
        # A node's totals by sums, not by a window: it may have very many children.
        totals = children.groupBy(*node).agg(
            F.count(F.lit(1)).alias("width"), F.sum("n").alias("all"), F.sum("labelled").alias("all_labelled"), F.sum("n_bad").alias("all_bad"),
            *(F.sum(f"n_{kind}").alias(f"all_{kind}") for kind in BELOW),
        ).where(F.col("all_labelled") >= LEAST)
        # Branches like the whole node share one wildcard, and so do unlabelled ones of a wide node.
        general = ~_different() & ((F.col("labelled") > 0) | (F.col("width") >= MANY))
        named = children.join(totals, node).select(
            *node, "segment", F.when(general, "*").otherwise(F.col("segment")).alias("name")
        )
        named = written(named, "names")  # so that the urls of one host can be split
        rows = rows.withColumn("segment", F.get("segments", F.lit(level))).join(named, [*node, "segment"], "left")
        rest = F.array_repeat(F.lit("*"), F.greatest(depth - level, F.lit(0)))
        rows = rows.withColumn("open", F.col("name").isNotNull() & (depth > level + 1)).withColumn(
            "template", F.when(F.col("name").isNotNull(), F.concat_ws("/", "template", "name")).when(
                depth > level, F.concat_ws("/", F.col("template"), rest)
            ).otherwise(F.col("template"))
        ).drop("segment", "name")
        rows = written(rows, "urls")
        done = rows.where("not open").drop("open", "segments")
        out = done if out is None else out.unionByName(done)
        rows, level = rows.where("open").drop("open"), level + 1
        if rows.isEmpty():
            return out


def purities(rows: DataFrame) -> DataFrame:
    """(host, tree, template, n, labelled, purity): the smoothed share of bad labels.

    Labels which are a rule's verdict (column ruled) shape the tree, but say nothing of other
    urls of a template, so they do not count here. The prior of a template is its (host, tree)'s share, whose own prior is the share of all hosts.
    """
    own = F.when(~F.col("ruled"), F.col("bad"))
    found = rows.groupBy("host", "tree", "template").agg(
        F.count(F.lit(1)).alias("n"), F.count(own).alias("labelled"), F.coalesce(F.sum(own), F.lit(0)).alias("n_bad")
    )
    hosts = found.groupBy("host", "tree").agg(F.sum("labelled").alias("host_labelled"), F.sum("n_bad").alias("host_bad"))
    whole = hosts.agg(
        ((F.coalesce(F.sum("host_bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("host_labelled"), F.lit(0)) + 2)).alias("corpus")
    )
    corpus = whole.first()["corpus"]
    hosts = hosts.withColumn("corpus", F.lit(corpus))
    prior = (F.col("host_bad") + PRIOR * F.col("corpus")) / (F.col("host_labelled") + PRIOR)
    return found.join(hosts.select("host", "tree", prior.alias("prior")), ["host", "tree"]).select(
        "host", "tree", "template", "n", "labelled",
        ((F.col("n_bad") + PRIOR * F.col("prior")) / (F.col("labelled") + PRIOR)).alias("purity"),
    )


def visible_text(html: Column) -> Column:
    """What a page shows, roughly: without scripts, styles, comments and tags; blocks are lines."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*+>|\z)|<!--.*?(?:-->|\z)", " ")
    lines = F.regexp_replace(bare, r"(?i)</?(?:p|div|li|ul|ol|br|tr|table|h[1-6]|article|section|nav|title|header|footer|main)\b[^>]*+>", "\n")
    text = F.regexp_replace(lines, "<[^>]*+>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def with_page_labels(pages: DataFrame, html: str, name: str) -> DataFrame:
    """Adds the label of each row's own page: 1 if its visible text fails the quality policy, 0 if not, null without a page."""
    text = free_name(pages, "visible")
    rows, names = quality.with_measures(pages.withColumn(text, visible_text(F.col(html))), text, keep=[c for c in pages.columns if c != html] + [html])
    failed = free_name(rows, "failed_rules")
    rows = quality.with_failures(rows, names, failed)
    bad = quality.fails(F.col(failed), quality.POLICIES[quality.CURRENT])
    return rows.withColumn(name, F.when(F.col(html).isNotNull(), bad.cast("int"))).drop(failed, *names.values())


def judged(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, label: str | None = None, html: str | None = None,
) -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) for each row.

    Labels are the column `label`, or those of the pages in column `html` (``with_page_labels``),
    or there are none but the rules'; where a rule judges a url, its verdict is the url's label
    unless a column is named. A template is rejected on labelled urls of its own only, so no
    rule's verdict and no host's share alone reaches another path.

    Null urls and those without :// have empty host and path and fit no rule; they are judged as
    a host of their own. Null or empty pages: a null one has no label, an empty one fails as too
    short. Urls and pages of any length are looked at whole. Repeated rows count as often as they
    come; null keys stay. Other columns, whatever their names (host, path, template, tree), are not
    looked at. An empty table gives no rows.
    """
    host, path = host_and_path(F.col(url))
    base = pages.select(
        F.col(key).alias("key"), host.alias("host"), path.alias("path"), F.lit("").alias("tree"),
        (F.col(label).cast("int") if label else F.lit(None).cast("int")).alias("bad"), *([F.col(html).alias("html")] if html else []),
    )
    base = base.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    if html and not label:
        base = with_page_labels(base.drop("bad"), "html", "bad").drop("html")
    if not label:
        by_rule = F.when(F.col("found.verdict").isNotNull(), (F.col("found.verdict") == "block").cast("int"))
        base = base.withColumn("bad", F.coalesce(by_rule, "bad"))
    base = base.withColumn("ruled", F.lit(False) if label else F.col("found.verdict").isNotNull())
    rows = templates(base)
    pure = written(purities(rows).select("host", "tree", "template", "labelled", "purity"), "purities")
    rows = rows.join(pure, ["host", "tree", "template"], "left")
    method = F.when((F.col("labelled") >= LEAST) & (F.col("purity") >= REJECTED), "block").otherwise("allow")
    return rows.select(
        F.col("key").alias(key), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", method).alias("verdict"), "template", "purity",
    )
