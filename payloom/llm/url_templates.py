"""URL filters: host and path rules, and a tree of path templates per host, in DataFrame operations only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import ascii_lower, written

SALTS = 16


class UrlRule(NamedTuple):
    """Fits the host and all subdomains where the path starts with the rule's; the longest rule wins."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Tree(NamedTuple):
    """Parameters of the template tree.

    A segment is variable where a node has at least
    `children` of them with no more than `pages` pages each on average.
    similar: z value under which a branch's labelled share, and what lies below
    it, is not told apart from that of its like siblings. A template is rejected where (blocked +
    weight * prior) / (labelled + weight) reaches `purity`.
    """

    children: int = 16
    pages: float = 2.0
    similar: float = 1.96
    weight: float = 5.0
    purity: float = 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)


def _rule_of(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """Place of the longest rule that fits, as text and action."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    found = F.lit(None).cast("struct<rule: string, action: string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def _shape(path: Column) -> Column:
    """The path with runs of digits, and long hexadecimal names, as wildcards."""
    hexed = F.regexp_replace(path, r"(?<=/)[0-9a-fA-F-]*[0-9][0-9a-fA-F-]{7,}(?=$|[/.])", "{h}")
    return F.regexp_replace(hexed, r"[0-9]+", "{n}")


def _open_depth(leaves: DataFrame, least: int = 0, below: int | None = None) -> int | None:
    """The first depth from `least` on, or the last one under `below`, at which a node has two children: others can't change, however long their paths are."""
    last = F.size("segments") - 1
    at = F.explode(F.sequence(F.lit(least), last if below is None else F.least(last, F.lit(below - 1))))
    places = leaves.filter((last >= least) & F.lit(below is None or below > least)).select("host", "segments", at.alias("depth"))
    nodes = places.groupBy("host", "depth", F.xxhash64(F.slice("segments", F.lit(1), F.col("depth"))).alias("parent")).agg(
        F.min(F.get("segments", F.col("depth"))).alias("low"), F.max(F.get("segments", F.col("depth"))).alias("high"))
    return nodes.filter("low <> high").agg((F.min if below is None else F.max)("depth")).first()[0]


def _level(leaves: DataFrame, depth: int, tree: Tree) -> DataFrame:
    """Leaves with the segment at this depth generalised, where its node asks for it."""
    node = ["host", "parent"]
    tail = F.when(F.size("segments") > depth + 1, F.concat(F.lit("/"), F.array_join(F.slice("segments", depth + 2, 1 << 20), "/"))).otherwise("")
    rows = leaves.withColumn("parent", F.array_join(F.slice("segments", 1, depth), "/")).withColumn("segment", F.get("segments", F.lit(depth)))
    kinds = rows.filter("segment IS NOT NULL").groupBy(*node, "segment", tail.alias("tail")).agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
    branches = kinds.groupBy(*node, "segment").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.max(F.struct("n", "tail"))["tail"].alias("mode"))
    nodes = branches.groupBy(*node).agg(F.count("*").alias("children"), F.sum("n").alias("node_n"))

    # Branches with the same most frequent tail; of these, the ones whose pages are over all tails as in the group.
    group = [*node, "mode"]
    tails = kinds.join(branches.select(*node, "segment", "mode", F.col("n").alias("branch_n")), [*node, "segment"])
    pooled = tails.groupBy(*group, "tail").agg(F.sum("n").alias("tail_n"))
    pool = pooled.groupBy(*group).agg(F.sum("tail_n").alias("pool_n"), (F.count("*") - 1).alias("free"))
    seen = tails.join(pooled, [*group, "tail"]).groupBy(*node, "segment").agg(F.sum(F.col("n") * F.col("n") / F.col("tail_n")).alias("squares"))
    distance = F.col("squares") * F.col("pool_n") / F.col("n") - F.col("n")  # chi square
    alike = branches.join(pool, group).join(seen, [*node, "segment"]).filter(distance <= F.col("free") + tree.similar * F.sqrt(2 * F.col("free")) + 1e-6)
    alike = alike.filter("labelled > 0 OR mode <> ''").select(*group, "segment", "labelled", "blocked")

    # Then those whose labelled share doesn't differ: from the whole group's, or from that of all above or below it.
    def fits(df: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
        sums = df.groupBy(*keys).agg(F.sum("labelled").alias("of"), F.sum("blocked").alias("bad"), F.count_if(F.col("labelled") > 0).alias("like"))
        mean = F.col("bad") / F.col("of")
        apart = F.col("blocked") / F.col("labelled") - mean
        return df.join(sums, keys), F.when(F.abs(apart) > tree.similar * F.sqrt(mean * (1 - mean) / F.col("labelled")), F.signum(apart)).otherwise(0).cast("int")

    whole, side = fits(alike.withColumn("labelled", F.nullif("labelled", F.lit(0))), group)
    sided, off = fits(whole.withColumn("side", side).drop("of", "bad", "like"), [*group, "side"])
    mark = F.when(F.col("side") > 0, "*+").when(F.col("side") < 0, "*-").otherwise("*")
    merged = sided.filter((off == 0) & (F.col("like") > 1)).select(*node, "segment", mark.alias("mark"))

    variable = (F.col("children") >= tree.children) & (F.col("node_n") <= tree.pages * F.col("children"))
    stars = branches.join(nodes, node).join(merged, [*node, "segment"], "left").select(
        *node, "segment", F.when(variable, F.lit("*")).otherwise(F.col("mark")).alias("star")).filter("star IS NOT NULL")
    general = F.when(F.col("star").isNotNull(), F.concat(F.slice("segments", 1, depth), F.array("star"), F.slice("segments", depth + 2, 1 << 20))).otherwise(F.col("segments"))
    return rows.join(stars, [*node, "segment"], "left").withColumn("segments", general).select(*leaves.columns)


def judge_urls(pages: DataFrame, rules: list[UrlRule], tree: Tree = Tree(), *, page_id: str = "page_id", url: str = "url",
               blocked: str | None = None) -> DataFrame:
    """Verdicts on urls: (id, host, path, rule, template, purity, verdict).

    A url that rules fit gets the verdict of the longest one. All others are
    judged by the template of their path: per host, paths form a tree of
    segments. Digits and hexadecimal names are wildcards from the start; then,
    level by level, at all depths, segments are generalised to * where a node has many
    children of few pages each, and where sibling branches are alike: with the
    same most frequent generalised path below, pages over all of these paths
    as in all such branches together (chi square), and a share of blocked pages
    that doesn't differ significantly. Branches with clearly more or less
    blocked than all such branches are compared among themselves and become
    *+ and *-. Unlabelled ones join where something lies below them and two
    labelled ones or more agree: one labelled branch says nothing of others.
    Levels go from the deepest up, then once more down. A template is rejected by the share of blocked among its
    labelled pages, smoothed towards the share among all labelled pages.

    Labels are the column `blocked` (1, 0 or null for unlabelled), or the
    verdicts of rules where none is given. A template without labels has the
    smoothed share of all and isn't told from clean ones: it is allowed.

    Pages are grouped by (host, shape of path) before anything else, with
    sums on the map side; only rejected shapes are joined to pages, dealt over
    SALTS parts, so no host or template is one task. Null urls and those
    without :// have empty host and path. Null ids and repeated rows are judged
    row by row. Other columns are not read.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page"), host.alias("host"), path.alias("path"),
                        *([F.col(f"`{blocked}`").cast("int").alias("label")] if blocked else []))
    rows = rows.withColumn("found", _rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", _shape(F.col("path")))
    if not blocked:
        rows = rows.withColumn("label", F.when(F.col("found.action").isNotNull(), (F.col("found.action") == "block").cast("int")))

    leaves = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
    parts = F.split(F.regexp_replace("shape", "^/", ""), "/")
    leaves = written(leaves.withColumn("segments", parts), "url-leaves")
    depth = _open_depth(leaves, below=1 << 30)
    while depth is not None:
        leaves = written(_level(leaves, depth, tree), "url-tree")
        depth = _open_depth(leaves, below=depth) if depth else None
    depth = _open_depth(leaves)  # once more from the top: merged branches bring children together
    while depth is not None:
        leaves = written(_level(leaves, depth, tree), "url-tree")
        depth = _open_depth(leaves, depth + 1)
    totals = leaves.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = (totals[1] or 0) / totals[0] if totals[0] else 0.0

    template = F.array_join("segments", "/")
    purity = (F.sum("blocked") + tree.weight * prior) / (F.sum("labelled") + tree.weight)
    rejected = leaves.groupBy("host", template.alias("template")).agg(F.sum("labelled").alias("seen"), purity.alias("purity"))
    rejected = rejected.filter((F.col("seen") > 0) & (F.col("purity") >= tree.purity))
    shapes = leaves.withColumn("template", template).join(rejected, ["host", "template"]).select(
        "host", "shape", "template", "purity", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    shapes = written(shapes, "url-rejected")
    # Dealt by id and path, so that rows without id part as far as their paths differ.
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page", "path"), F.lit(SALTS)).cast("int"))
    verdict = F.coalesce("found.action", F.when(F.col("template").isNotNull(), "block").otherwise("allow"))
    return dealt.join(shapes, ["host", "shape", "salt"], "left").select(
        F.col("page").alias(page_id), "host", "path", F.col("found.rule").alias("rule"), "template", "purity", verdict.alias("verdict"))
