"""URL filters by path-template trees, in DataFrame functions only.

1. Each url is cut into host and path. A list of rules decides what it covers; its decisions are also the labels.
2. Distinct paths are counted by host as chains of segments, where numbers and hexadecimal names are classes.
3. Level by level, a segment becomes a wildcard where a node has very many children and this one has few rows; of the
   others, siblings with the same prevailing label are merged where a chi-squared test finds what follows them (next
   segment and label) no different from their group's.
4. A template is rejected if its labelled rows are most of its rows and their smoothed share of blocks is high.

The tree is as deep as the longest path. Everything after the first count works on templates, not on urls, and the tables
of each level are written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import common

#: From this level on the rest of a path is one segment, so that a path of thousands of segments isn't as many levels.
DEEPEST = 16
#: Children from which a node is wide, and the share of its rows below which a child of a wide node is a wildcard.
WIDE, SMALL_SHARE = 16, 0.05
#: Rows from which a branch can be merged, and the normal quantile of the test's level (1 %).
LEAST_ROWS, QUANTILE = 5, 2.326
#: A template is rejected from this smoothed share of blocks on, with so many rows' worth of prior, if so many of its rows are labelled.
PURITY, PRIOR, STRENGTH, COVERAGE = 0.8, 0.5, 4.0, 0.5
#: Rules up to which they are tested in place; more are joined by host.
INLINE_RULES = 200
_END = "\u0000"  # no more segments


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; then up to ``? #`` or the end.

    Null, or no ``://``: both empty.
    """
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def parse_rule(rule: str) -> tuple[str, str]:
    """``net/es/`` as ('net', '/es/')."""
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def judged(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """urls (host, path, ...) with ``rule`` and ``ruled``: the longest rule that fits, and its verdict; null if none does.

    rules: (rule, allow or block). A rule fits its host and all subdomains, for paths that start with its own. Of two
    fitting rules of one length the one with the longer host counts.
    """
    if len(rules) <= INLINE_RULES:
        fits = []
        for rule, verdict in rules:
            host, path = parse_rule(rule)
            fit = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("n"), F.lit(len(host)).alias("h"), F.lit(rule).alias("rule"), F.lit(verdict).alias("ruled"))))
        none = F.lit(None).cast("struct<n:int,h:int,rule:string,ruled:string>")
        best = F.array_max(F.array(*fits, none))
        return urls.withColumn("best", best).withColumns({"rule": F.col("best.rule"), "ruled": F.col("best.ruled")}).drop("best")
    table = urls.sparkSession.createDataFrame([(*parse_rule(r), r, v) for r, v in rules], "rule_host string, rule_path string, rule string, ruled string")
    known = urls.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    found = known.withColumn("rule_host", F.explode(suffixes)).join(table, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = found.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), "rule", "ruled")).alias("best"))
    return urls.join(best.select("host", "path", "best.rule", "best.ruled"), ["host", "path"], "left")


def _class(segment: Column) -> Column:
    """Numbers (with or without a file ending), long hexadecimal names and dates as classes; others as they are."""
    number = segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$")
    return (
        F.when(number, F.concat(F.lit("<n>"), F.regexp_extract(segment, r"\.[A-Za-z0-9]{1,5}$", 0)))
        .when(segment.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.lit("<date>"))
        .when(segment.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), F.lit("<hex>"))
        .otherwise(segment)
    )


def _segments() -> Column:
    return F.transform(F.filter(F.split("path", "/", -1), lambda _, i: i > 0), lambda s: _class(s))


def _chains(urls: DataFrame, depth: int) -> DataFrame:
    """urls with t1, t2, ...: the classes of their segments; the last one holds all that is left of the path."""
    urls = urls.withColumn("segments", _segments())
    for i in range(depth):
        own = F.get("segments", F.lit(i))
        if i + 1 == depth:
            own = F.when(F.size("segments") > i, F.array_join(F.slice("segments", depth, 1 << 30), "/"))
        urls = urls.withColumn(f"t{i + 1}", F.coalesce(own, F.lit(_END)))
    return urls.drop("segments")


def _critical(df: Column) -> Column:
    """The chi-squared quantile, by Wilson and Hilferty."""
    a = 2.0 / (9.0 * df)
    return df * F.pow(1 - a + QUANTILE * F.sqrt(a), 3)


def templates(chains: DataFrame, depth: int) -> DataFrame:
    """chains (host, t1.., n, blocked, allowed) with their ``template``."""
    tree = chains.withColumn("prefix", F.lit(""))
    for level in range(1, depth + 1):
        own = f"t{level}"
        tree = common.written(tree.withColumn("following", F.col(f"t{level + 1}") if level < depth else F.lit(_END)))
        child = tree.groupBy("host", "prefix", own).agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
        literal = ~F.col(own).startswith("<") & ~F.col(own).isin("", _END)
        node = child.groupBy("host", "prefix").agg(F.sum("n").alias("rows"), F.count_if(literal).alias("wide"))
        state = F.when((F.col("blocked") > F.col("allowed")) & (F.col("blocked") * 2 >= F.col("n")), F.lit("block")).when(
            (F.col("allowed") > F.col("blocked")) & (F.col("allowed") * 2 >= F.col("n")), F.lit("allow")
        )
        child = child.join(node, ["host", "prefix"]).select(
            "host", "prefix", own, "n", F.coalesce(state, F.lit("open")).alias("state"), literal.alias("literal"),
            (literal & (F.col("wide") >= WIDE) & (F.col("n") < F.col("rows") * SMALL_SHARE)).alias("variable"),
        )
        child = common.written(child)
        # What follows each branch, against what follows its group: sum of (seen - expected)^2 / expected = sum of seen^2 / expected - n.
        able = child.where(F.col("literal") & ~F.col("variable") & (F.col("n") >= LEAST_ROWS)).select("host", "prefix", own, "state", F.col("n").alias("of"))
        # Literal names that follow count as one kind: each alone is too rare for the test.
        kind = F.when(F.col("following").startswith("<") | F.col("following").isin("", _END), F.col("following")).otherwise(F.lit("<s>"))
        seen = tree.join(able, ["host", "prefix", own]).withColumn("next", kind)
        seen = seen.withColumn(
            "x", F.explode(F.array(F.struct(F.lit("block").alias("l"), F.col("blocked").alias("k")), F.struct(F.lit("allow").alias("l"), F.col("allowed").alias("k")), F.struct(F.lit("none").alias("l"), (F.col("n") - F.col("blocked") - F.col("allowed")).alias("k"))))
        )
        seen = seen.where("x.k > 0").groupBy("host", "prefix", "state", own, "of", "next", F.col("x.l").alias("l")).agg(F.sum("x.k").alias("k"))
        pooled = seen.groupBy("host", "prefix", "state", "next", "l").agg(F.sum("k").alias("pk"))
        group = able.groupBy("host", "prefix", "state").agg(F.sum("of").alias("pn"), F.count("*").alias("branches"))
        group = group.join(pooled.groupBy("host", "prefix", "state").agg(F.count("*").alias("cells")), ["host", "prefix", "state"])
        chi = seen.join(pooled, ["host", "prefix", "state", "next", "l"]).groupBy("host", "prefix", "state", own, "of").agg(F.sum(F.col("k") * F.col("k") / F.col("pk")).alias("s"))
        chi = chi.join(group.where("branches > 1"), ["host", "prefix", "state"])
        similar = F.col("s") * F.col("pn") / F.col("of") - F.col("of") <= _critical(F.greatest(F.col("cells") - 1, F.lit(1)))
        merged = chi.where(similar).select("host", "prefix", own, F.concat(F.lit("<"), "state", F.lit(">")).alias("merged"))
        moves = child.join(merged, ["host", "prefix", own], "left").select("host", "prefix", own, F.when(F.col("variable"), F.lit("*")).otherwise(F.coalesce("merged", own)).alias("now"))
        tree = tree.join(common.written(moves), ["host", "prefix", own])
        tree = tree.withColumn("prefix", F.when(F.col(own) == _END, F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "now"))).drop("now")
    return tree.withColumnRenamed("prefix", "template").drop("following")


def filtered(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for each row of pages (page_id, url) and any other columns.

    verdict: the rule's, or, for urls that no rule fits, ``block`` if the url's template is rejected and else
    ``allow``. purity: the template's smoothed share of blocked rows among the labelled ones; 0.5 if none is labelled.
    Null urls and those without ``://`` have an empty host and path; repeated rows and null page_ids are rows like any
    other. Empty table: no rows. Other columns are not looked at.
    """
    host, path = split_url(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = judged(rows, rules)
    depth = min(DEEPEST, max(1, rows.agg(F.max(F.size(F.split("path", "/", -1)))).first()[0] or 1))
    rows = _chains(rows, depth)
    keys = ["host", *(f"t{i + 1}" for i in range(depth))]
    chains = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("blocked"), F.count_if(F.col("ruled") == "allow").alias("allowed"))
    of_chain = common.written(templates(chains, depth))
    whole = of_chain.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    labelled = F.col("a") + F.col("b")
    purity = (F.col("b") + PRIOR * STRENGTH) / (labelled + STRENGTH)
    whole = whole.select("host", "template", purity.alias("purity"), ((purity >= PURITY) & (labelled >= F.col("n") * COVERAGE)).alias("rejected"))
    decided = of_chain.join(whole, ["host", "template"]).select(*keys, "template", "purity", "rejected")
    out = rows.join(decided, keys, "left")
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")), F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
