"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` together with the
literal tokens that any fitting URL must hold (host labels, whole path
segments). Token frequencies over the given URLs choose each rule's rarest
token; a URL's own tokens fetch the rules filed under them, and only those run
their expression. DataFrame functions only.

Skew: tokens are counted with partial aggregates, a token as frequent as a
top-level domain is used only by rules that have no rarer one, and the join on
it is a plain equi-join that Spark broadcasts or splits. Verdicts are grouped
by (row key, url), so a repeated row gets the same verdict as its twin.

Cases: a null url, or one without ``://``, has empty host and path; a rule
whose path is ``/...`` does not fit an empty path; a rule without a host fits
every host. Repeated rows come back repeated. No rules: every verdict is the
default. Columns of the input other than the key and the url are not used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "rule string, verdict string, regex string, tokens array<string>"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        host = rf"(?:[^/]*\.)?{_quote(self.host)}" if self.host else "[^/]*"
        return rf"^{host}{_quote(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Tokens of every URL that fits: an unfinished last segment is none."""
        labels = [f".{x}" for x in self.host.split(".") if x]
        return labels + [f"/{x}" for x in self.path.split("/")[1:-1] if x] or [""]


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", text)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: ``.label`` of the host, ``/segment`` of the path, and
    the empty token under which rules without any literal are filed."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("."), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("/"), x))
    return F.array_distinct(F.concat(F.array(F.lit("")), labels, segments))


def filter_urls(spark: SparkSession, pages: DataFrame, rules: list[Rule], key: str = "page_id",
                url: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: key, host, path, rule (null without one), verdict.
    The longest fitting rule decides; of equally long ones the first by name."""
    urls = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"),
                        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    table = spark.createDataFrame([(r.name, r.verdict, r.regex, r.tokens) for r in rules], RULE_SCHEMA)

    filed = table.select("*", F.explode("tokens").alias("token")).drop("tokens")
    spread = urls.select("__key", "__url", "host", "path",
                         F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))
    counts = (spread.select("token").join(filed.select("token").distinct(), "token", "left_semi")
              .groupBy("token").agg(F.count(F.lit(1)).alias("uses")))
    index = (filed.join(counts, "token", "left")
             .groupBy("rule", "verdict", "regex")
             .agg(F.min(F.struct(F.coalesce("uses", F.lit(0)), "token")).alias("rarest"))
             .select("rule", "verdict", "regex", F.col("rarest.token").alias("token")))

    fits = (spread.join(index, "token")
            .where(F.rlike(F.concat("host", "path"), F.col("regex")))
            .groupBy("__key", "__url")
            .agg(F.min(F.struct((-F.length("rule")).alias("n"), "rule", "verdict")).alias("best")))
    best = fits.select(F.col("__key").alias("__k"), F.col("__url").alias("__u"), "best")
    return (urls.join(best, F.col("__key").eqNullSafe(F.col("__k")) & F.col("__url").eqNullSafe(F.col("__u")), "left")
            .select(F.col("__key").alias(key), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
