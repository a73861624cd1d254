"""URL filters: host-suffix and path-prefix expressions, hash prefixes, rule precedence.

Each URL is expanded into every suffix of its host (at label borders) joined with the
prefixes of its path. The prefix lengths are those that rules have, so no rule can be
missed. Expressions and rules meet in an equi-join on the first bytes of their digests;
the full digests are then compared, and the longest rule wins.

URLs are judged once per distinct URL: the hot ones combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, pick

HASH_PREFIX_HEX = 8
#: A rule table of at most so many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_RULES = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def digest(host: Column, path: Column) -> Column:
    """SHA-256 of an expression; the space keeps host and path apart."""
    return F.sha2(F.concat(host, F.lit(" "), path).cast("binary"), 256)


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """(url, digest) of every host suffix with every path prefix of the given lengths."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    hosts = urls.select("url", "path", F.explode(suffixes).alias("host"), fitting.alias("fitting"))
    both = hosts.select("url", "host", "path", F.explode("fitting").alias("n"))
    return both.select("url", digest(F.col("host"), F.substring(F.col("path"), F.lit(1), F.col("n"))).alias("digest"))


def judged(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """(page_id, url, host, path, rule, verdict), one row per input row.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits its host and
    all subdomains if the path starts with the rule's path. Of the rules that fit, the
    longest (host and path together) wins; then the longer host; then ``block``. Without
    one, ``rule`` is null and the verdict is ``default``.

    Null urls and urls without ``://`` have an empty host and path and fit no rule with a
    host. Rules with a null host, path or verdict are left out; repeated rules count once.
    """
    rows = pick(pages, page_id=id_col, url=url_col)
    table = (
        pick(rules, host="host", path="path", verdict="verdict").dropna()
        .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").distinct()
        .select("host", "path", "verdict", digest(F.col("host"), F.col("path")).alias("rule_digest"))
        .withColumn("key", F.substring("rule_digest", 1, HASH_PREFIX_HEX))
    )
    # Distinct path lengths: no more than the longest rule path has characters.
    lengths = sorted(r[0] for r in table.select(F.length("path")).distinct().collect())
    n_rules = table.limit(BROADCAST_RULES + 1).count()
    side = F.broadcast(table) if n_rules <= BROADCAST_RULES else table
    host, path = host_and_path(F.col("url"))
    urls = rows.select("url").where(F.col("url").isNotNull()).distinct().select("url", host.alias("host"), path.alias("path"))
    found = expressions(urls.where("host <> ''"), lengths or [0]).withColumn("key", F.substring("digest", 1, HASH_PREFIX_HEX))
    fits = found.join(side, "key").where(F.col("digest") == F.col("rule_digest"))
    order = F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        (F.col("verdict") == "block").alias("block"), F.concat("host", "path").alias("rule"), "verdict",
    )
    best = fits.groupBy("url").agg(F.max(order).alias("best"))
    whole = rows.join(best, "url", "left")
    return whole.select(
        "page_id", "url", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
