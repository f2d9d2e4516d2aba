"""URL filters: rules for hosts and paths, and trust that spreads over links between hosts.

Rules judge the pages that they fit. For the rest, each host counts as a seed by the share
of its pages that rules allow or block. Trust of the allowed spreads along links
(personalised PageRank as a power series), distrust of the blocked against them: a host
that links to blocked ones is distrusted itself. Both are whole numbers of 1/UNIT of one
seed, shares are cut down to whole units, and sums do not depend on their order, so a score
is the same on any number of machines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_dir, written

# 85 % of the mass of 8 * 10^8 seeds still fits into a long times 100
UNIT = 10**9
DAMPING_PERCENT = 85
ROUNDS = 30
# A host is blocked from the distrust that a host has of itself with half of its pages blocked
THRESHOLD = UNIT * (100 - DAMPING_PERCENT) // 100 // 2
# Pieces of a host's links, and copies of a small side for a large one that may have a hot key
PIECES = 256
SALTS = 8

LINK = r"""(?i)<(?:a|area)\s(?:[^<>]*?\s)?href\s*+=\s*+["']?\s*+(?:https?:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case;
    empty without ``://`` or for null."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host's ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``places`` (host, path and more, no pair twice) with ``rule`` and ``action`` of the longest
    rule that fits, null where none does.

    ``rules`` has action, host and path. A rule fits its host and all below it, where the
    path starts with the rule's. Rules of equal length go by their text, then action. Each
    host is compared with the lengths of the rules' paths above it, so the work follows those and
    not the number of rules.
    """
    deepest = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(1))).first()[0]
    # a long name is only looked at as far from its end as a rule's can reach
    lowest = F.greatest(F.lit(1), F.size("labels") - F.lit(deepest - 1))
    above = F.transform(F.sequence(lowest, F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.lit(deepest)), "."))
    named = places.select("host").distinct().withColumn("labels", F.split("host", r"\."))
    named = named.select("host", F.explode(F.array_distinct(above)).alias("rule_host"))
    lengths = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_set(F.length("path")).alias("sizes"))
    checks = named.join(lengths, "rule_host").groupBy("host").agg(F.collect_list(F.struct("rule_host", "sizes")).alias("checks"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    checks = checks.select("host", "checks", copies.alias("salt"))
    asked = places.select("host", "path", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("salt"))
    asked = asked.join(checks, ["host", "salt"]).select("host", "path", F.explode("checks").alias("c"))
    asked = asked.select("host", "path", "c.rule_host", F.explode("c.sizes").alias("size"))
    asked = asked.where(F.length("path") >= F.col("size")).select(
        "host", "path", "rule_host", F.expr("substring(path, 1, size)").alias("rule_path"),
        F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    known = rules.select(F.col("action"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), copies.alias("salt"))
    text = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(text).alias("size"), text.alias("rule"), "action")).alias("best")
    fits = asked.join(known, ["rule_host", "rule_path", "salt"]).groupBy("host", "path").agg(best)
    fits = fits.select(F.col("host").alias("h"), F.col("path").alias("p"), "best.rule", "best.action")
    return places.join(fits, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").drop("h", "p")


def links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(src, dst): absolute links of ``a`` and ``area`` elements to another host, a pair once a
    page. Relative links stay on their host and make no edge."""
    found = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1))
    pairs = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.array_distinct(found)).alias("dst"))
    lower = F.translate("dst", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pairs.select("src", lower.alias("dst")).where("src <> '' AND src <> dst")


def spread(seeds: DataFrame, edges: DataFrame, damping: int = DAMPING_PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """(side, host, mass): what the ``seeds`` (side, host, mass) keep and hand on along the
    ``edges`` (side, src, dst), within ``rounds`` steps, in whole units.

    A host keeps 100 - damping percent of its seed and hands on damping percent of all that
    comes to it in equal shares; what a host without links would hand on is lost. A host's
    links are kept in up to PIECES rows, so that one with very many is spread over tasks.
    """
    spark = seeds.sparkSession
    piece = F.pmod(F.xxhash64("dst"), F.lit(PIECES)).alias("piece")
    outlets = written(edges.groupBy("side", "src", piece).agg(F.collect_set("dst").alias("dsts")), "host-links")
    degrees = written(
        outlets.groupBy("side", "src").agg(F.sum(F.size("dsts")).alias("degree"), F.collect_list("piece").alias("pieces")),
        "host-degrees",
    )
    folder, schema = scratch_dir(spark, "host-mass"), "side string, host string, mass long"
    kept = F.expr(f"mass * {100 - damping} div 100")
    seeds.select("side", "host", kept.alias("mass")).where("mass > 0").write.parquet(f"{folder}/round-0")
    for i in range(1, rounds + 1):
        moving = spark.read.schema(schema).parquet(f"{folder}/round-{i - 1}").withColumnRenamed("host", "src")
        shared = moving.join(degrees, ["side", "src"]).withColumn("share", F.expr(f"(mass * {damping} div 100) div degree"))
        shared = shared.where("share > 0").select("side", "src", "share", F.explode("pieces").alias("piece"))
        handed = shared.join(outlets, ["side", "src", "piece"]).select("side", F.explode("dsts").alias("host"), "share")
        handed.groupBy("side", "host").agg(F.sum("share").alias("mass")).write.parquet(f"{folder}/round-{i}")
        if spark.read.schema(schema).parquet(f"{folder}/round-{i}").isEmpty():
            break
    return spark.read.schema(schema).parquet(f"{folder}/round-*").groupBy("side", "host").agg(F.sum("mass").alias("mass"))


def _judged(pages: DataFrame, rules: DataFrame, url_col: str, html_col: str, threshold: int, damping: int, rounds: int) -> DataFrame:
    """(host, path, rule, verdict, trust, distrust) of each host and path of ``pages``."""
    url = F.col(url_col)
    places = pages.select(host_of(url).alias("host"), path_of(url).alias("path")).groupBy("host", "path").agg(F.count("*").alias("n"))
    places = written(matched(places, rules), "host-places")

    sums = [F.sum(F.when(F.col("action") == a, F.col("n")).otherwise(0)).alias(a) for a in ("allow", "block")]
    shares = places.groupBy("host").agg(F.sum("n").alias("n"), *sums)
    sides = F.explode(F.create_map(F.lit("trust"), F.col("allow"), F.lit("distrust"), F.col("block"))).alias("side", "part")
    seeds = shares.select("host", "n", sides).select("side", "host", F.expr(f"part * {UNIT} div n").alias("mass")).where("mass > 0")
    found = links(pages, url_col, html_col)
    ways = F.array(
        F.struct(F.lit("trust").alias("side"), "src", "dst"),
        F.struct(F.lit("distrust").alias("side"), F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    scores = spread(seeds, found.select(F.explode(ways).alias("e")).select("e.*"), damping, rounds)

    def of(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("mass")).otherwise(0)).alias(side)

    hosts = scores.groupBy("host").agg(of("trust"), of("distrust"))
    hosts = hosts.select(F.col("host").alias("h"), "trust", "distrust", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salted = places.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    judged = salted.join(hosts, (F.col("host") == F.col("h")) & (F.col("salt") == F.col("s")), "left")
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    method = F.when((distrust >= threshold) & (distrust > trust), "block").otherwise("allow")
    return judged.select("host", "path", "rule", F.coalesce("action", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def _attached(pages: DataFrame, given: list[Column], judged: DataFrame, url_col: str) -> DataFrame:
    """The ``given`` columns as struct ``row``, beside what was judged of their url."""
    url = F.col(url_col)
    # any copy is as good, so the salt need not be the same when a task is run again
    rows = pages.select(
        F.struct(*given).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
    )
    return rows.join(judged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "path", "salt"])


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: int = THRESHOLD,
    damping: int = DAMPING_PERCENT,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id_col, host, path, rule, verdict, trust, distrust) of every row of ``pages``.

    ``rules`` has the columns action (allow or block), host and path. ``verdict`` is the
    rule's; without a rule, a host is blocked whose distrust reaches ``threshold`` and is
    over its trust, and all else is allowed.

    A null url, or one without ``://``, has an empty host and path, which no link and no score
    concerns; a null page has no links; null ids stay null, repeated rows are reported each
    and count as pages of their host each; an empty table gives no row, and an empty
    ``rules`` allows all; very long pages are searched once; further columns are not read.
    Links in comments and scripts count like others.
    """
    judged = _judged(pages, rules, url_col, html_col, threshold, damping, rounds)
    found = _attached(pages, [F.col(id_col)], judged, url_col)
    return found.select(F.col("row").getField(id_col).alias(id_col), "host", "path", "rule", "verdict", "trust", "distrust")


def keep_allowed(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    threshold: int = THRESHOLD,
    damping: int = DAMPING_PERCENT,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The rows of ``pages`` whose url is allowed, with all their columns as they are; cases as
    for ``url_verdicts``."""
    judged = _judged(pages, rules, url_col, html_col, threshold, damping, rounds)
    found = _attached(pages, [F.col(f"`{c}`") for c in pages.columns], judged, url_col)
    return found.where("verdict = 'allow'").select("row.*")
