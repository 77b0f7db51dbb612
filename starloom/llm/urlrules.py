"""URL filters: rules are fetched by their rarest literal token, and only fetched rules run their regular expression.

Every rule has a regular expression over host and path, and literal tokens that any URL it fits must hold whole. It is
indexed under the one of them that the URLs at hand hold least often. A URL's tokens fetch the rules indexed under them
by a join; the expressions of these few are run, and the longest fitting rule decides. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Name, literal tokens any of which a host must hold, expression over host and path: hosts the filter refuses by itself.
UNWANTED = (
    ("gambling", ("casino", "casinos", "bet", "bets", "betting", "poker", "jackpot", "slots")),
    ("pharmacy", ("pills", "viagra", "cialis", "pharmacy", "meds")),
    ("adult", ("porn", "xxx", "sex", "escort", "camgirls")),
    ("advertising", ("ads", "adserver", "doubleclick", "banner", "popunder")),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, from the first :// to the next slash, question mark or hash, and the path from there to a
    question mark or hash. Both are empty for a null URL and one without ://."""
    form = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, form, 1), UPPER, LOWER), F.regexp_extract(text, form, 2)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0)))


def listed(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) for a host with all subdomains and paths that begin with the rule's.

    A token is literal if the rule bounds it on both sides: a path may go on after the rule's last character.
    """
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    rule = F.concat("host", "path")
    quoted = lambda c: F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))
    bounded = F.when(F.col("path") == "", F.concat("host", F.lit("/"))).otherwise(rule)
    literals = F.regexp_extract_all(F.translate(bounded, UPPER, LOWER), F.lit("[a-z0-9]+(?=[^a-z0-9])"), F.lit(0))
    end = F.when(F.col("path") == "", F.lit("(?:/.*)?$")).otherwise(F.lit(""))
    expression = F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), quoted(rule), end)
    return given.select(
        rule.alias("rule"), "verdict", F.length(rule).alias("weight"), F.lit(1).alias("level"), expression.alias("expression"), F.array_distinct(literals).alias("literals")
    )


def unwanted(spark: SparkSession) -> DataFrame:
    """The filter's own rules, one per name and token: hosts that hold the token between dots or dashes, before the last dot."""
    rows = [(f"{name}:{t}", "block", len(t), 0, rf"^(?:[^/]*[.-])?{t}[.-]", [t]) for name, tokens in UNWANTED for t in tokens]
    return spark.createDataFrame(rows, "rule string, verdict string, weight int, level int, expression string, literals array<string>")


def judged(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id as given, host, path, rule (the longest listed rule that fits, else null), own_rule (the filter's own
    rule that fits, else null) and verdict: the listed rule's, else block if an own rule fits, else allow.

    ``rules`` has the columns of ``listed``; level 0 marks the filter's own ones. Of equally long rules the one that blocks
    wins, then the larger name. A rule without a literal token is run on every URL. A null or empty URL, and one without
    ://, has an empty host and path, and only such rules can fit it. Rows that repeat are judged each; other columns are not looked at.
    """
    host, path = host_and_path(F.col(url_col))
    given = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    given = materialize(given, "urls")
    target = F.concat("host", "path")
    # The empty token stands for rules without one; every URL has it.
    tokens = given.select("row", target.alias("target"), F.explode(F.concat(_tokens(target), F.array(F.lit("")))).alias("token"))
    choices = rules.select("*", F.explode(F.when(F.size("literals") > 0, F.col("literals")).otherwise(F.array(F.lit("")))).alias("token"))
    # Stored, so that Spark knows how few they are and URL tokens that no rule has are dropped where they are read.
    wanted = materialize(choices.select("token").distinct(), "rule-tokens")
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("rule", "level").orderBy(F.coalesce("n", F.lit(0)), "token")
    # An own rule's name holds its token, so each rule has one entry in the index.
    index = choices.join(counts, "token", "left").withColumn("place", F.row_number().over(rarest)).where("place = 1")
    index = materialize(index.drop("place", "n", "literals"), "rule-index")
    fits = tokens.join(index, "token").where(F.expr("target rlike expression"))
    order = F.struct("weight", F.when(F.col("verdict") == "block", 1).otherwise(0).alias("blocks"), "rule")
    best = fits.groupBy("row").agg(
        F.max_by(F.struct("rule", "verdict"), F.when(F.col("level") == 1, order)).alias("own"), F.min(F.when(F.col("level") == 0, F.col("rule"))).alias("method")
    )
    found = given.join(best, "row", "left")
    verdict = F.coalesce(F.col("own.verdict"), F.when(F.col("method").isNotNull(), F.lit("block")), F.lit("allow"))
    return found.select(F.col("id").alias(id_col), "host", "path", F.col("own.rule").alias("rule"), F.col("method").alias("own_rule"), verdict.alias("verdict"))
