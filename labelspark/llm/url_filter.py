"""URL filters: host and path rules, and a character language-model ratio where no rule fits.

The urls that rules decide, whole and as often as they occur, are the training text. Two variable-order Markov models, one of allowed and one of blocked
urls, count every character after its 0 to ``ORDER`` characters of context. A model's probability backs off from the
longest context to shorter ones with Witten-Bell weights: a context that was followed by many different characters
leaves more to the shorter one. A url is blocked when the mean log-likelihood ratio of its characters is above a cut that
is calibrated on a held-out part of the decided urls.

All of it is DataFrame work: a window (context and character) is scored once for the whole corpus and joined back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import let

ORDER = 5
SALTS = 16
ALPHABET = 256  # characters that the model without context spreads its rest over
_PAD = "\x02"

# Fixed values: (verdict, host, path), the longest fitting one wins.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next of ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does.

    A rule fits its host and every subdomain, and paths that start with its own. Of equally long ones the first wins.
    """
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def windows(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls`` (id, text and what else it has) with one row per character: ``w``, the character and its context."""
    padded = F.concat(F.lit(_PAD * order), F.lower("text"), F.lit(_PAD))
    rows = let(padded, lambda t: F.transform(
        F.sequence(F.lit(1), F.length(t) - order), lambda i: F.substr(t, i, F.lit(order + 1))))
    return urls.select(*[c for c in urls.columns if c != "text"], F.explode(rows).alias("w"))


@dataclass
class UrlModel:
    """Counts of characters by context and kind, totals by context, and the cut on the mean log-likelihood ratio."""

    counts: DataFrame
    totals: DataFrame
    cut: float
    order: int


def _grams(rows: DataFrame, order: int) -> DataFrame:
    """``blocked, context, c, n``: how often a character follows each context of 0 to ``order`` characters.

    A row counts ``times`` times. Windows are counted before they fan out to their shorter contexts, so a hot host is one
    row per task and window.
    """
    seen = rows.groupBy("blocked", "w").agg(F.sum("times").alias("n"))
    shorter = F.explode(F.transform(F.sequence(F.lit(0), F.lit(order)), lambda k: F.substr("w", k + 1, F.lit(order) - k)))
    return seen.select("blocked", shorter.alias("context"), F.substr("w", F.lit(order + 1), F.lit(1)).alias("c"), "n").groupBy(
        "blocked", "context", "c").agg(F.sum("n").alias("n"))


def fit(decided: DataFrame, *, order: int = ORDER) -> UrlModel:
    """From ``id, text, blocked`` of decided urls: counts of four fifths of them, the cut from the last fifth.

    Where there is a column ``times``, a url counts that often, else once. The cut is where the share of blocked urls caught less the share of allowed ones lost is largest. Without urls of both kinds there is nothing to compare, and the cut is infinite: nothing is blocked.
    """
    times = F.col("times") if "times" in decided.columns else F.lit(1).cast("long")
    rows = decided.select("id", "text", "blocked", times.alias("times")).withColumn("held", F.pmod(F.xxhash64("text", F.lit(11)), F.lit(5)) == 0)
    counts = stage(_grams(windows(rows.filter("not held").select("text", "blocked", "times"), order), order), "url-grams")
    totals = stage(counts.groupBy("blocked", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")), "url-contexts")
    model = UrlModel(counts, totals, math.inf, order)
    held = score(rows.filter("held").select("id", "text", "blocked", "times"), model)
    cells = held.groupBy(F.floor(F.col("score") * 200).alias("cell")).agg(
        *(F.sum(F.when(F.col("blocked") == b, F.col("times")).otherwise(0)).alias(kind)
          for b, kind in ((True, "bad"), (False, "good")))).collect()  # a few thousand at most
    cells = sorted((r["cell"], r["bad"], r["good"]) for r in cells if r["cell"] is not None)
    bad, good = sum(c[1] for c in cells), sum(c[2] for c in cells)
    if not bad or not good:
        return model
    best, caught, lost = (0.0, math.inf), 0, 0
    for cell, b, g in reversed(cells):
        caught, lost = caught + b, lost + g
        if caught / bad - lost / good > best[0] + 1e-12:
            best = (caught / bad - lost / good, cell / 200)
    model.cut = best[1]
    return model


def _scored_windows(seen: DataFrame, model: UrlModel) -> DataFrame:
    """``w, llr`` of distinct windows: from no context to the longest, one join of the two tables per order and class."""
    k = model.order
    out = seen.select("w", F.substr("w", F.lit(k + 1), F.lit(1)).alias("c"),
                      F.lit(1.0 / ALPHABET).alias("p_true"), F.lit(1.0 / ALPHABET).alias("p_false"))
    both = model.counts.groupBy("context", "c").agg(*(F.sum(F.when(F.col("blocked") == b, F.col("n"))).alias(f"n_{b}".lower())
                                                      for b in (True, False)))
    seen_in = model.totals.groupBy("context").agg(*(F.sum(F.when(F.col("blocked") == b, F.col(x))).alias(f"{x}_{b}".lower())
                                                    for b in (True, False) for x in ("total", "kinds")))
    contexts, grams = stage(seen_in, "url-contexts"), stage(both, "url-grams")
    for length in range(k + 1):
        context = F.substr("w", F.lit(k + 1 - length), F.lit(length))
        g = grams.filter(F.length("context") == length).withColumnRenamed("c", "g_c").withColumnRenamed("context", "g_context")
        t = contexts.filter(F.length("context") == length).withColumnRenamed("context", "t_context")
        joined = (out.withColumn("x", context).join(t, F.col("x") == F.col("t_context"), "left")
                  .join(g, (F.col("x") == F.col("g_context")) & (F.col("c") == F.col("g_c")), "left"))
        new = {}
        for b in ("true", "false"):
            total, kinds, n = F.col(f"total_{b}"), F.col(f"kinds_{b}"), F.coalesce(f"n_{b}", F.lit(0))
            new[b] = F.when(total.isNull(), F.col(f"p_{b}")).otherwise((n + kinds * F.col(f"p_{b}")) / (total + kinds))
        out = joined.select("w", "c", new["true"].alias("p_true"), new["false"].alias("p_false"))
    return out.select("w", (F.log("p_true") - F.log("p_false")).alias("llr"))


def score(urls: DataFrame, model: UrlModel) -> DataFrame:
    """``urls`` (id, text, ...) with ``score``, the mean ratio of a url's characters.

    The table of scored windows is repeated per salt, so that a window that every url has is spread over tasks.
    """
    rest = [c for c in urls.columns if c != "text"]
    rows = windows(urls, model.order).groupBy(*rest, "w").agg(F.count("*").alias("k"))
    llr = stage(_scored_windows(rows.select("w").distinct(), model), "url-windows")
    salted = llr.select("w", "llr", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["w", "salt"])
            .groupBy(*rest).agg((F.sum(F.round(F.col("llr") * F.col("k"), 9).cast("decimal(28,9)")).cast("double")
                                 / F.sum("k")).alias("score")))


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row: the rule's verdict, else the model's.

    Equal urls are judged once, and train the model as often as they occur. Rules see host and path, the model the whole
    url. One without ``://`` has an empty host and path, fits no rule and is the model's to judge; a null or empty url has
    no characters and is allowed. Ids may be null or repeat.
    """
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("text"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "text", "host", "path", "r.rule", F.col("r.verdict").alias("by_rule"))
    texts = stage(rows.groupBy("text").agg(F.first("by_rule").alias("by_rule"), F.count("*").alias("times")).withColumn(
        "id", F.xxhash64("text")), "urls")
    model = fit(texts.filter("by_rule is not null").select("id", "text", "times", (F.col("by_rule") == "block").alias("blocked")),
                order=order)
    open_urls = score(texts.filter("by_rule is null and text <> ''").select("id", "text"), model)
    return rows.join(open_urls.withColumnRenamed("id", "_id"), F.xxhash64("text") == F.col("_id"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("score") >= model.cut, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("by_rule").isNull(), F.col("score")).alias("score"))
