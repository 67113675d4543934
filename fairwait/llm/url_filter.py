"""URL filters: host and path rules, and association rules mined from labelled URLs.

``fit`` labels URLs by given rules (or takes labels), mines token combinations with Spark's
FP-growth and keeps the rules that are sure enough and not implied by a shorter one. Tokens that
occur in exactly the same labelled URLs (the constant parts of a site's paths) are mined as one, so
that they don't double the item sets each, and are alternatives to each other in the rules. ``judge``
finds the rules of a URL through an inverted index: each rule is listed under its rarest tokens,
a URL's tokens look it up, and the rest of the rule is verified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"
_VERDICT = "verdict="


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null if none fits.

    A rule is ``(verdict, "host/path")`` and fits the host and its subdomains where the URL's
    path starts with the rule's. Among rules of one length the first given wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.coalesce(found, F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return found


def tokens_of(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels with their level from the right, path segments with the
    digits masked, their endings, and the names of query fields."""
    labels = F.transform(F.reverse(F.split(host, r"\.")), lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    segments = F.transform(F.split(path, "/"), lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), F.regexp_replace(x, r"\d+", "0")))
    ending = F.regexp_extract(path, r"(\.[^./]*)$", 1)
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    fields = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, r"^[^=]*", 0)))
    scheme = F.concat(F.lit("s:"), F.regexp_extract(url, r"(?s)\A(.*?)://", 1))
    every = F.concat(F.array(scheme), labels, segments, F.array(F.concat(F.lit("e:"), ending)), fields)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.filter(every, lambda t: ~t.rlike("^[a-z][0-9]*:$")))
    )


def equal_tokens(baskets: DataFrame, tokens: str, min_support: float) -> DataFrame:
    """(token, members): tokens of at least the support that occur in the same baskets, for sets of two or more, under the first.

    Two hashes of a basket's content, combined by exclusive or over the distinct baskets of a token, tell its set of baskets
    (128 bits). There are at most (mean tokens of a basket / ``min_support``) tokens with the support, however many baskets.
    """
    distinct = baskets.groupBy(F.array_sort(tokens).alias("_set")).agg(F.count("*").alias("_n"))
    one = distinct.select(F.explode("_set").alias("token"), "_n", F.xxhash64("_set").alias("_a"), F.xxhash64(F.lit(1), "_set").alias("_b"))
    least = baskets.count() * min_support
    signed = one.groupBy("token").agg(F.sum("_n").alias("_n"), F.bit_xor("_a").alias("_a"), F.bit_xor("_b").alias("_b")).filter(F.col("_n") >= least)
    return (
        signed.groupBy("_n", "_a", "_b")
        .agg(F.array_sort(F.collect_list("token")).alias("members"))
        .filter(F.size("members") > 1)
        .select(F.col("members")[0].alias("token"), "members")
    )


def fit(labelled: DataFrame, tokens: str, verdict: str, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (rule_id, tokens, members, verdict, confidence, support) from token sets with a verdict.

    ``members`` holds for each of ``tokens`` itself and the tokens that occur in the same labelled rows: any of them will do.
    Rules with a shorter antecedent for the same verdict and at least the same confidence are
    dropped as implied. Rows without tokens or verdict take no part; none left means no rules.
    """
    known = labelled.filter(F.col(verdict).isNotNull() & (F.size(F.col(tokens)) > 0))
    equal = stored(equal_tokens(known, tokens, min_support), "equal_tokens")
    # Bounded by the support, as equal_tokens says.
    others = [t for row in equal.collect() for t in row["members"][1:]]
    single = F.filter(F.col(tokens), lambda t: ~t.isin(others)) if others else F.col(tokens)
    baskets = known.select(F.concat(single, F.array(F.concat(F.lit(_VERDICT), F.col(verdict)))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (
        model.associationRules.filter(F.col("consequent")[0].startswith(_VERDICT))
        .filter(~F.exists("antecedent", lambda t: t.startswith(_VERDICT)))
        .select(
            F.array_sort("antecedent").alias("tokens"),
            F.expr(f"substring(consequent[0], {len(_VERDICT) + 1})").alias("verdict"),
            "confidence",
            "support",
        )
    )
    rules = minimal(rules).withColumn("rule_id", F.xxhash64("tokens", "verdict"))
    spread = (
        rules.select("rule_id", F.posexplode("tokens").alias("at", "token"))
        .join(equal, "token", "left")
        .groupBy("rule_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("members", F.array("token")).alias("members")))).alias("members"))
    )
    return rules.join(spread.select("rule_id", F.col("members.members").alias("members")), "rule_id")


def minimal(rules: DataFrame) -> DataFrame:
    """Drops a rule if one token less gives the same verdict with at least the same confidence.

    Checked by looking up every antecedent less one token, so by an equi-join, not by pairs.
    Since a dropped rule's shorter form is itself covered by a still shorter one or kept, one
    step suffices.
    """
    shorter = rules.select(
        "tokens", "verdict", "confidence", F.explode("tokens").alias("left_out")
    ).select("tokens", "verdict", "confidence", F.array_remove("tokens", F.col("left_out")).alias("shorter"))
    known = rules.select(F.col("tokens").alias("shorter"), "verdict", F.col("confidence").alias("known"))
    implied = shorter.join(known, ["shorter", "verdict"]).filter("known >= confidence").select("tokens", "verdict").distinct()
    return rules.join(implied, ["tokens", "verdict"], "left_anti")


def match(urls: DataFrame, key: str, tokens: str, rules: DataFrame) -> DataFrame:
    """(key, learned) for the keys that some rule matches: the surest rule's verdict, then the best
    supported, then the longest antecedent, then the order of its text."""
    listed = urls.select(key, tokens, F.explode(tokens).alias("token"))
    used = rules.select("rule_id", F.posexplode("members").alias("at", "any"))
    counts = used.select(F.explode("any").alias("token")).distinct().join(listed.groupBy("token").count(), "token")
    rarest = (
        used.select("*", F.explode("any").alias("token"))
        .join(counts, "token")
        .groupBy("rule_id", "at")
        .agg(F.sum("count").alias("count"), F.first("any").alias("any"))
        .groupBy("rule_id")
        .agg(F.min_by("any", F.struct("count", "at")).alias("any"), F.count("*").alias("present"))
    )
    index = rules.join(rarest, "rule_id").filter(F.col("present") == F.size("members")).select("*", F.explode("any").alias("token"))
    # Of alternatives that a URL has, the last in order stands in the rule's text.
    text = F.array_join(F.array_sort(F.transform("members", lambda m: F.array_max(F.array_intersect(m, F.col(tokens))))), " ")
    best = F.struct("confidence", "support", F.size("members").alias("size"), text.alias("text"), "verdict")
    own = index.select("token", "members", "verdict", "confidence", "support")
    return (
        listed.join(own, "token")
        .filter(F.forall("members", lambda m: F.arrays_overlap(m, F.col(tokens))))
        .groupBy(key)
        .agg(F.max(best)["verdict"].alias("learned"))
    )


def judge(
    pages: DataFrame,
    url: str,
    rules: Sequence[tuple[str, str]],
    default: str = DEFAULT,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """The rows with ``host``, ``path``, ``rule`` and ``verdict``.

    URLs that a given rule decides are the labels from which the mined rules learn; the others
    get the mined verdict, or ``default`` where nothing matches. Equal URLs get equal verdicts;
    null and malformed URLs have empty host and path and the default. Columns of ``pages`` with the
    names of results are replaced.
    """
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url])
    distinct = pages.select(F.col(url).alias("_url")).filter("_url IS NOT NULL").distinct()
    parsed = distinct.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    urls = parsed.select(
        "_url", longest_rule(F.col("_host"), F.col("_path"), rules)["verdict"].alias("_given"), tokens_of(F.col("_host"), F.col("_path"), F.col("_url")).alias("_tokens")
    )
    mined = fit(urls, "_tokens", "_given", min_support, min_confidence)
    learned = match(urls.filter("_given IS NULL"), "_url", "_tokens", mined)
    found, verdict = unused(pages, "found", "learned")
    out = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    out = out.withColumn(found, longest_rule(F.col("host"), F.col("path"), rules))
    out = out.join(learned.select(F.col("_url"), F.col("learned").alias(verdict)), F.col(url) == F.col("_url"), "left")
    return out.withColumns(
        {"rule": F.col(found)["rule"], "verdict": F.coalesce(F.col(found)["verdict"], F.col(verdict), F.lit(default))}
    ).drop("_url", found, verdict)
