"""URL verdicts from a path-template tree, in DataFrame functions only.

Per host, paths become templates level by level. A segment that carries an id (a long number, a digest, a number with an ending)
is variable at once. Of the others, a segment stays literal when it is one of few and frequent among its siblings; rare siblings of a
crowded node become a wildcard. Then branches that are statistically alike are merged: literal siblings whose pages go on in the same
way and are blocked equally often, both to a ``STEPS``-th, share one node. All segments enter the template: the levels go on to the
longest path. A stem that is alone under its node keeps its other segments as they are, so levels end where stems stop sharing nodes.

Pages that a rule decides are the labels. A template's purity is its share of blocked pages, smoothed by its parent's purity, down
from the whole table over host suffixes, the host and each node above it; a template whose purity reaches ``threshold`` is rejected with all its pages that no rule decides.

All statistics are sums over groups, so a host with a third of all pages is combined before it is shuffled; nothing is collected
per host. Rules are few and fixed; they are matched by their own length, longest first.

Rows: one row out per row in. A null url, or one without ``://``, has an empty host and path; such pages share the empty host. Urls are
taken whole, repeated ones are judged alike; without a rule for any page the verdict is the prior's. Other columns are left out, so
their names cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from gradeloom.sources.workdir import new_path, stored

MAX_LITERALS = 16
MIN_LITERAL_SHARE = 0.02
STEPS = 4
SMOOTHING = 5.0
THRESHOLD = 0.5

#: Segments that are variable by their form: numbers, numbers with an ending, long hexadecimal strings, dates, words with a number.
_VARIABLE = r"^([0-9]+([.][A-Za-z0-9]{1,5})?|[0-9a-fA-F-]{8,}|[^0-9]*[0-9]{3,}[^/]*)$"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: The rules of the query, as given.
RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)


def host_of(url: Column) -> Column:
    """Between ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def rule_for(rules: tuple[UrlRule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does. Length counts host and path; on a tie the longer host wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        hit = fits(rule, host, path)
        name, verdict = F.when(hit, F.lit(rule.name)).otherwise(name), F.when(hit, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _stems(pages: DataFrame) -> DataFrame:
    """Distinct hosts and raw segment lists (variable ones starred) with numbers of pages, of labelled and of blocked ones."""
    segments = F.transform(F.split(F.regexp_replace("path", "^/", ""), "/"), lambda s: F.when(s.rlike(_VARIABLE), F.lit("*")).otherwise(s))
    return pages.withColumn("stem", segments)


def _decided(stems: DataFrame, level: int) -> DataFrame:
    """``host, prefix, segment, label, stems``: what each segment of the level is called in the template, and how many stems its node has."""
    following = F.coalesce(F.get("stem", F.lit(level + 1)), F.lit("\0end"))
    shape = F.when(following.isin("*", "\0end", ""), following).otherwise(F.lit("\0word"))
    sums = [F.sum(F.when(shape == s, F.col("n")).otherwise(0)).alias(f"s{k}") for k, s in enumerate(("*", "\0end", "", "\0word"))]
    nodes = stems.groupBy("host", "prefix", F.get("stem", F.lit(level)).alias("segment")).agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.count("*").alias("own_stems"), *sums
    )
    totals = nodes.groupBy("host", "prefix").agg(F.sum("n").alias("total"), F.count("*").alias("width"), F.sum("own_stems").alias("stems"))
    both = nodes.join(totals, ["host", "prefix"])
    frequent = (F.col("n") >= MIN_LITERAL_SHARE * F.col("total")) & ((F.col("width") <= MAX_LITERALS) | (F.col("n") * MAX_LITERALS >= F.col("total")))
    kind = F.when(F.col("segment") == "*", F.lit("*")).when(frequent, F.lit("literal")).otherwise(F.lit("*word"))
    bins = [F.round(STEPS * F.col(f"s{k}") / F.col("n")).cast("int") for k in range(4)]
    purity = F.when(F.col("labelled") < 3, F.lit(-1)).otherwise(F.round(STEPS * (F.col("blocked") + 0.5) / (F.col("labelled") + 1)).cast("int"))
    likeness = F.concat_ws(",", *bins, purity)
    rated = both.select("host", "prefix", "segment", "stems", kind.alias("kind"), likeness.alias("likeness"))
    alike = rated.where("kind = 'literal'").groupBy("host", "prefix", "likeness").agg(F.count("*").alias("branches"))
    label = F.when(F.col("kind") != "literal", F.col("kind")).when(F.col("branches") > 1, F.concat(F.lit("~"), "likeness")).otherwise(F.col("segment"))
    return rated.join(alike, ["host", "prefix", "likeness"], "left").select("host", "prefix", "segment", label.alias("label"), "stems")


def templates(pages: DataFrame) -> DataFrame:
    """``host, stem, template`` with ``n, labelled, blocked`` for each distinct host and stem of ``pages(host, path, verdict)``."""
    counts = _stems(pages).groupBy("host", "stem").agg(F.count("*").alias("n"), F.count("verdict").alias("labelled"), F.count_if(F.col("verdict") == "block").alias("blocked"))
    spark = pages.sparkSession
    alive = stored(counts.withColumn("prefix", F.lit("")), "url-stems")
    columns, schema = alive.columns, StructType([*alive.schema.fields, StructField("ended", BooleanType())])
    paths, level = [], 0
    while not paths or not alive.isEmpty():
        names = _decided(alive, level).withColumnRenamed("segment", "_segment")
        joined = alive.withColumn("_segment", F.get("stem", F.lit(level))).join(names, ["host", "prefix", "_segment"])
        # alone under its node, a segment is a literal or variable by its form, on this level and on all further ones
        rest = F.array_join(F.slice("stem", level + 1, F.size("stem")), "/")
        prefix = F.concat("prefix", F.lit("/"), F.when(F.col("stems") == 1, rest).otherwise(F.col("label")))
        ended = (F.col("stems") == 1) | (F.size("stem") == level + 1)
        path = new_path(spark, "url-templates")
        joined.withColumn("prefix", prefix).withColumn("ended", ended).select(*columns, "ended").write.parquet(path)
        paths.append(path)
        alive = spark.read.schema(schema).parquet(path).where("not ended").drop("ended")
        level += 1
    tree = spark.read.schema(schema).parquet(*paths).where("ended").drop("ended")
    return tree.withColumnRenamed("prefix", "template")


def purities(tree: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``host, template, purity``: share of blocked pages among labelled ones, each level smoothed by the one above."""
    suffix = lambda k: F.array_join(F.slice(F.split("host", "[.]"), F.greatest(F.lit(1), F.size(F.split("host", "[.]")) - (k - 1)), k), ".")
    leaf = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    leaf = leaf.withColumn("first", F.concat_ws("/", F.element_at(F.split("template", "/"), F.least(F.size(F.split("template", "/")), F.lit(2)))))
    leaf = leaf.withColumn("zone", suffix(1)).withColumn("site", suffix(2))
    blocked, labelled = (x or 0 for x in leaf.agg(F.sum("blocked"), F.sum("labelled")).first())
    out = leaf.withColumn("purity", F.lit((blocked + 0.5) / (labelled + 1.0)))
    smoothed = lambda p, b, n: (b + smoothing * p) / (n + smoothing)
    for keys in (["zone"], ["zone", "first"], ["site", "first"], ["host"], ["host", "first"]):
        sums = leaf.groupBy(*keys).agg(F.sum("blocked").alias("_b"), F.sum("labelled").alias("_l"))
        out = out.join(sums, keys).withColumn("purity", smoothed(F.col("purity"), F.col("_b"), F.col("_l"))).drop("_b", "_l")
    # nodes between the first level and the template itself, folded in their order
    parts = F.split("template", "/")
    between = F.when(F.size(parts) > 3, F.sequence(F.lit(2), F.size(parts) - 2)).otherwise(F.array().cast("array<int>"))
    above = leaf.select("host", "template", "blocked", "labelled", F.explode(between).alias("level")).withColumn("node", F.array_join(F.slice(parts, F.lit(1), F.col("level") + 1), "/"))
    nodes = above.groupBy("host", "node").agg(F.sum("blocked").alias("_b"), F.sum("labelled").alias("_l"))
    chains = above.join(nodes, ["host", "node"]).groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("level", "_b", "_l"))).alias("chain"))
    folded = F.aggregate(F.coalesce("chain", F.array().cast("array<struct<level: int, _b: bigint, _l: bigint>>")), F.col("purity"), lambda p, x: smoothed(p, x["_b"], x["_l"]))
    out = out.join(chains, ["host", "template"], "left").withColumn("purity", smoothed(folded, F.col("blocked"), F.col("labelled")))
    return out.select("host", "template", "purity")


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every page."""
    url = F.col(url_col).cast("string")
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = rule_for(rules, F.col("host"), F.col("path"))
    own = own.withColumn("rule", name).withColumn("verdict", verdict)
    tree = templates(own)
    rated = tree.join(purities(tree), ["host", "template"]).select("host", "stem", "template", "purity")
    joined = _stems(own).join(rated, ["host", "stem"], "left")
    learned = F.when(F.col("purity") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", learned).alias("verdict"), "template", F.round("purity", 9).alias("purity"))
