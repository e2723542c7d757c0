"""URL filters: hashed host-suffix and path-prefix expressions against rules.

Each distinct URL is expanded into expressions (a suffix of its host in labels,
a prefix of its path in folders). An expression's SHA-256 starts with a short
prefix, on which expressions and rules are joined; the full digest, and the rest
of the rule's path, are confirmed on the joined rows. Of the rules that fit, the
longest decides.

Only shapes (labels, folders) that some rule has are expanded, so that a URL of
many labels and folders gives no more expressions than the rules can meet.

Defined results: a null URL, or one without `://`, has empty host and path and
no rule. A null rule host or action is no rule; a null rule path is empty. Of
rules of one length, that with the longer host wins, then the greater text, then
block before allow. Repeated rows are judged alike; an input column named like
an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import fresh, lower_ascii, replacing

PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _folders(path: Column) -> Column:
    """Number of slashes."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _rules(rules: DataFrame) -> DataFrame:
    host = lower_ascii(F.col("host"))
    path = F.coalesce(F.col("path"), F.lit(""))
    depth = _folders(path)
    # The part of the path up to its last slash is hashed; the rest is compared after the join.
    folder = F.regexp_extract(path, r"(?s)^.*/", 0)
    digest = F.sha2(F.concat(host, folder), 256)
    return rules.where(host.isNotNull() & F.col("action").isNotNull()).select(
        F.concat(host, path).alias("_rule"),
        host.alias("_rule_host"),
        path.alias("_rule_path"),
        F.col("action").alias("_action"),
        digest.alias("_digest"),
        digest.substr(1, PREFIX_DIGITS).alias("_prefix"),
        F.size(F.split(host, r"\.")).alias("_labels"),
        depth.alias("_depth"),
    )


def _expressions(shapes: list[tuple[int, int]]) -> Column:
    labels = F.split(F.col("_host"), r"\.")
    depth = _folders(F.col("_path"))
    of = []
    for n, d in shapes:
        suffix = F.array_join(F.slice(labels, F.size(labels) - n + 1, F.lit(n)), ".")
        folder = F.concat(F.substring_index(F.col("_path"), "/", d), F.lit("/")) if d else F.lit("")
        of.append(F.when((F.size(labels) >= n) & (depth >= d), F.concat(suffix, folder)))
    return F.array_compact(F.array(*of))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows with `host`, `path`, `rule` and `verdict`.

    `rules` has host, path and action (allow or block); a URL that no rule fits
    gets `default`. Two shuffles of the distinct URLs and one of the rows by URL;
    a URL that fills much of the table is counted once, and its rows are split by
    adaptive execution when the verdict is joined back.
    """
    rules = _rules(rules)
    # One row for each shape; bounded by labels times folders of the longest rules.
    shapes = rules.groupBy("_labels", "_depth").count().collect()
    key, won = fresh(df, "_url"), fresh(df, "_best")
    verdict = {"rule": F.col(f"{won}._rule"), "verdict": F.coalesce(f"{won}._action", F.lit(default))}
    own = F.col(f"`{url}`")
    if not shapes:
        return replacing(df, host=F.coalesce(host_of(own), F.lit("")), path=F.coalesce(path_of(own), F.lit("")),
                         rule=F.lit(None).cast("string"), verdict=F.lit(default))
    near = rules.drop("_labels", "_depth")
    asked = (
        df.select(own.alias("_url")).where(F.col("_url").isNotNull()).distinct()
        .select("_url", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
        .where(F.col("_host") != "")
    )
    found = (
        asked.select("_url", "_path", F.explode(_expressions(sorted((r[0], r[1]) for r in shapes))).alias("_expr"))
        .select("_url", "_path", F.sha2("_expr", 256).alias("_full"))
        .withColumn("_prefix", F.col("_full").substr(1, PREFIX_DIGITS))
        .join(near, "_prefix")
        .where((F.col("_full") == F.col("_digest")) & F.col("_path").startswith(F.col("_rule_path")))
    )
    best = found.groupBy("_url").agg(
        F.max(F.struct(F.length("_rule").alias("n"), F.length("_rule_host").alias("h"), "_rule", "_action")).alias(won)
    )
    # On the URL and its hash: so the verdicts get a shuffle of their own, and the rows can be split.
    mark = fresh(df, "_mark")
    judged = best.withColumnRenamed("_url", key).withColumn(mark, F.xxhash64(key))
    joined = df.join(judged, (own == F.col(key)) & (F.xxhash64(own) == F.col(mark)), "left")
    out = replacing(
        joined,
        host=F.coalesce(host_of(own), F.lit("")),
        path=F.coalesce(path_of(own), F.lit("")),
        **verdict,
    )
    return out.drop(key, won, mark)
