"""URL judgement: host/path rules first, else a path-template tree per host.

The tree is learnt with DataFrame operations over distinct typed paths, which
are counted before anything else is shuffled, so a host with a third of all
pages costs a few rows per task.

1. Typed segments: numbers, long hex strings and UUIDs become wildcards.
2. Variable segments: level by level, under each (host, prefix) node with many
   mostly-unique children, the rare children become ``*``.
3. Similar branches: templates that differ in one segment are merged when a
   chi-square test finds no difference between their labelled rates.  Each
   branch is first tested alone against the rate of its siblings, so one that
   differs stays a template of its own however many siblings there are, and
   does not stop the others from merging.
4. Purity: (good + a * prior) / (labelled + a), the prior being the host's own
   smoothed rate; templates below ``min_purity`` are blocked.

Defined results: a null URL, or one without ``://``, has an empty host and
path and no rule; it is judged by the template of the empty host.  All segments
of a path count; there is a round for each place at which nodes fan out or
templates differ in that segment alone, none for runs of segments that do not
branch, so long equal paths cost none.  Unlabelled templates take the
host's prior.  Equal rules: one of them decides, the longest text wins otherwise.
Repeated rows are judged alike.  An empty table gives no rows.  (The SQL twin is
the same tree, unrolled for paths of up to ten segments.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optlake.llm.common import Scratch

#: A node is variable when it has this many children, half of them seen once.
MIN_FAN_OUT, RARE_SHARE, RARE_COUNT = 12, 0.5, 2
#: Weight of the prior in labelled pages, and the least good share to allow.
PRIOR_WEIGHT, MIN_PURITY = 10.0, 0.5
#: Squared deviations (in variances) at which a branch differs from its siblings; most labels it has in their rate.
BRANCH_FIT, BRANCH_WEIGHT = 16.0, 10
GLUE = "\x1f"

# The rules of the contract as (verdict, host, path).
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(after, F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, act).otherwise(verdict)
    return rule, verdict


def typed_segments(path: Column) -> Column:
    """Path segments with numbers, hex strings and UUIDs as wildcards."""
    def typed(s: Column) -> Column:
        ext = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})?$", 1)
        return (F.when(s.rlike(r"^[0-9]+(\.[A-Za-z]{1,5})?$"), F.concat(F.lit("{n}"), ext))
                .when(s.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit("{uuid}"))
                .when(s.rlike(r"^[0-9a-fA-F]{12,}(\.[A-Za-z]{1,5})?$"), F.concat(F.lit("{x}"), ext))
                .otherwise(s))

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), typed)


def _put(segs: str, d: int, value: Column) -> Column:
    return F.transform(segs, lambda s, i: F.when(i == d, value).otherwise(s))


def _places(tree: DataFrame, d: int) -> DataFrame:
    """A row for each segment at place ``d`` or later (column at) of the templates."""
    rest = F.sequence(F.lit(d), F.size("segs") - 1)
    return tree.where(F.size("segs") > d).select("host", "segs", F.explode(rest).alias("at"), "lab").withColumn("seg", F.get("segs", F.col("at")))


def _next_fan(tree: DataFrame, d: int) -> int | None:
    """The first place from ``d`` on at which some node has MIN_FAN_OUT children; elsewhere no segment is variable."""
    node = F.xxhash64(F.slice("segs", F.lit(1), F.col("at")))
    child = _places(tree, d).where("seg not like '{%'").select("host", "at", node.alias("node"), "seg").distinct()
    return child.groupBy("host", "at", "node").count().where(F.col("count") >= MIN_FAN_OUT).agg(F.min("at")).first()[0]


def _next_branch(tree: DataFrame, d: int) -> int | None:
    """The first place from ``d`` on at which some templates differ in that segment alone and have labels; elsewhere none merge."""
    shape = F.xxhash64(F.transform("segs", lambda s, i: F.when(i == F.col("at"), F.lit("*")).otherwise(s)))
    some = _places(tree.where("lab > 0"), d).select("host", "at", shape.alias("shape"), "seg").distinct()
    return some.groupBy("host", "at", "shape").count().where("count > 1").agg(F.min("at")).first()[0]


def learn_templates(labelled: DataFrame, scratch: Scratch, min_purity: float = MIN_PURITY) -> DataFrame:
    """Templates of (host, typed): template, labelled, purity, allow.

    ``labelled`` has host, typed (array) and good (1, 0 or null: no label).
    """
    tree = scratch.keep(
        labelled.groupBy("host", "typed").agg(F.count("*").alias("n"), F.count("good").alias("lab"),
                                              F.sum(F.coalesce("good", F.lit(0))).alias("good"))
        .withColumn("segs", F.col("typed")), "url-paths")
    d = -1
    while (d := _next_fan(tree, d + 1)) is not None:  # 2: a node's rare children become one wildcard
        before = tree
        here = F.get("segs", F.lit(d))
        tree = tree.withColumn("node", F.array_join(F.slice("segs", 1, d), GLUE)).withColumn("seg", here)
        child = tree.where("seg is not null and seg not like '{%'").groupBy("host", "node", "seg").agg(F.sum("n").alias("child_n"))
        fan = (child.groupBy("host", "node")
               .agg(F.count("*").alias("fan"), F.sum((F.col("child_n") == 1).cast("int")).alias("once"))
               .where((F.col("fan") >= MIN_FAN_OUT) & (F.col("once") >= RARE_SHARE * F.col("fan"))))
        rare = (child.where(F.col("child_n") <= RARE_COUNT).join(fan, ["host", "node"])
                .select("host", "node", "seg", F.lit(True).alias("rare")))
        tree = scratch.keep(
            tree.join(rare, ["host", "node", "seg"], "left")
            .withColumn("segs", F.when(F.col("rare"), _put("segs", d, F.lit("*"))).otherwise(F.col("segs")))
            .drop("node", "seg", "rare"), f"url-level-{d}")
        scratch.drop(before)
    d = -1
    while (d := _next_branch(tree, d + 1)) is not None:  # 3: merge branches whose labelled rates do not differ
        before = tree
        key = F.array_join(_put("segs", d, F.lit("*")), GLUE)
        tree = tree.withColumn("shape", key).withColumn("seg", F.get("segs", F.lit(d)))
        branch = (tree.where("seg is not null").groupBy("host", "shape", "seg")
                  .agg(F.sum("lab").alias("lab"), F.sum("good").alias("good")))
        weight = F.least("lab", F.lit(BRANCH_WEIGHT))
        rates = branch.where("lab > 0").groupBy("host", "shape").agg(
            (F.sum(weight * F.col("good") / F.col("lab")) / F.sum(weight)).alias("usual"))
        off = F.greatest(F.abs(F.col("good") - F.col("lab") * F.col("usual")) - 0.5, F.lit(0.0))
        odd = (branch.where("lab > 0").join(rates, ["host", "shape"])
               .withColumn("odd", off * off > BRANCH_FIT * F.col("lab") * F.col("usual") * (1 - F.col("usual")))
               .select("host", "shape", "seg", "lab", "good", "odd"))
        sums = odd.where("not odd").groupBy("host", "shape").agg(
            F.count("*").alias("k"), F.sum("lab").alias("l"), F.sum("good").alias("g"),
            F.sum(F.col("good") * F.col("good") / F.col("lab")).alias("gg"))
        rate = F.col("g") / F.col("l")
        # sum (good_i - lab_i p)^2 / (lab_i p (1 - p)) = (sum good_i^2 / lab_i - l p^2) / (p (1 - p))
        spread = F.when((rate > 0) & (rate < 1), (F.col("gg") - F.col("l") * rate * rate) / (rate * (1 - rate))).otherwise(0.0)
        free = F.col("k") - 1
        alike = (sums.where(F.col("k") >= 2).where(spread <= free + 2 * F.sqrt(2.0 * free))
                 .select("host", "shape", F.lit(True).alias("alike")))
        tree = scratch.keep(
            tree.join(alike, ["host", "shape"], "left")
            .join(odd.where("odd").select("host", "shape", "seg", "odd"), ["host", "shape", "seg"], "left")
            .withColumn("segs", F.when(F.col("alike") & F.col("odd").isNull() & F.col("seg").isNotNull(), _put("segs", d, F.lit("*")))
                        .otherwise(F.col("segs")))
            .drop("shape", "seg", "alike", "odd"), f"url-branch-{d}")
        scratch.drop(before)
    tree = tree.withColumn("template", F.concat(F.lit("/"), F.array_join("segs", "/")))
    total = tree.agg(F.sum("lab").alias("lab"), F.sum("good").alias("good")).first()  # one row
    hosts = tree.groupBy("host").agg(F.sum("lab").alias("host_lab"), F.sum("good").alias("host_good"))
    leaf = tree.groupBy("host", "template").agg(F.sum("lab").alias("labelled"), F.sum("good").alias("good"))
    base = F.lit(((total.good or 0) + 1) / ((total.lab or 0) + 2))
    prior = (F.col("host_good") + PRIOR_WEIGHT * base) / (F.col("host_lab") + PRIOR_WEIGHT)
    purity = (F.col("good") + PRIOR_WEIGHT * prior) / (F.col("labelled") + PRIOR_WEIGHT)
    judged = (leaf.join(hosts, "host")
              .select("host", "template", "labelled", purity.alias("purity")))
    return (tree.select("host", "typed", "template").join(judged, ["host", "template"])
            .withColumn("allow", F.col("purity") >= min_purity))


def judge_urls(pages: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "page_id", url_col: str = "url",
               rules=RULES, min_purity: float = MIN_PURITY) -> DataFrame:
    """Verdict of every page.  ``labels`` has ``id`` (once) and ``good`` (1 or 0)."""
    rows = pages.select(F.col(id_col).alias(id_col), url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path")).withColumn("typed", typed_segments(F.col("path")))
    known = rows.join(labels.select(F.col("id").alias(id_col), "good"), id_col, "left")
    templates = learn_templates(known.select("host", "typed", "good"), scratch, min_purity)
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    return rows.join(templates, ["host", "typed"], "left").select(
        id_col, "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("allow"), "allow").otherwise("block")).alias("verdict"),
        "template", F.col("labelled").cast("long").alias("n_labelled"), "purity")


def page_labels(labels: DataFrame) -> DataFrame:
    """A page is bad when its document is labelled toxic or of low quality; labels of one document are joined."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    return (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id"))
            .agg((1 - F.max(bad.cast("int"))).alias("good")))
