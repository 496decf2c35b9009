"""Product names -> drug codes: exact, then normalised, then approximate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DOSAGE_WORDS, _col, words
from ..session import stage

GRAM = 3


def _one_code(dictionary: DataFrame, key: Column) -> DataFrame:
    """One code per key (the greatest one)."""
    return (
        dictionary.select(key.alias("key"), "concept_code")
        .where("key is not null and key != ''")
        .groupBy("key").agg(F.max("concept_code").alias("rxcui"))
    )


def normal_form(name: Column | str) -> Column:
    """Lower case, symbols and dosage words dropped, words sorted."""
    plain = F.regexp_replace(F.lower(_col(name)), r"[^\p{L}\p{N}]+", " ")
    bare = F.regexp_replace(plain, rf"(?i)\b({DOSAGE_WORDS})\b", " ")
    return F.array_join(F.array_sort(words(bare)), " ")


def rank_terms(names: DataFrame, terms: str = "terms") -> DataFrame:
    """(code, rank, term): the non-null terms of each label in order of preference."""
    return names.select(
        "code", F.posexplode(F.array_compact(terms)).alias("rank", "term")
    )


def _best(hits: DataFrame) -> DataFrame:
    """The hit of the best-ranked term per label."""
    return hits.groupBy("code").agg(F.min(F.struct("rank", "rxcui")).alias("_b")).select(
        "code", F.col("_b.rxcui").alias("rxcui")
    )


def match_exact(ranked: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Names equal to a dictionary term, ignoring case."""
    keyed = ranked.withColumn("key", F.lower("term"))
    return keyed.join(_one_code(dictionary, F.lower("term")), "key")


def match_normalized(ranked: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Names with the same normal form as a dictionary term."""
    keyed = ranked.withColumn("key", normal_form("term"))
    return keyed.join(_one_code(dictionary, normal_form("term")), "key")


def grams(name: Column | str) -> Column:
    """The set of character trigrams of a padded name."""
    padded = F.concat(F.lit("  "), _col(name), F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(padded) - F.lit(GRAM - 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(GRAM))))


def _by_rarity(names: DataFrame, weights: DataFrame) -> DataFrame:
    """(name, n, grams) of distinct names, the rarest gram first; written, as a pair reads it more than once."""
    names = names.select("name").where("name is not null and name != ''").distinct()
    long = names.select("name", F.explode(grams("name")).alias("gram"))
    ordered = long.join(weights, "gram", "left").groupBy("name").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("weight", F.lit(0)).alias("w"), "gram"))).alias("_g"))
    return stage(ordered.select("name", F.size("_g").alias("n"), F.col("_g.gram").alias("grams")), "grams")


def _bound(share: float, size: Column) -> Column:
    """Smallest whole number of at least ``share * size``."""
    return F.ceil(F.lit(share) * size - F.lit(1e-9)).cast("int")


def similar_names(left: DataFrame, right: DataFrame, min_sim: float) -> DataFrame:
    """All (name, other, sim) with trigram Jaccard similarity of at least ``min_sim``.

    Exact. Each name stands under its rarest grams, so many that two names of the wanted similarity share one; pairs are
    counted by how many they share there. What they can have in common beyond that lies in the rest of one of them, so
    pairs whose count cannot be enough go before any gram sets meet. Both inputs are distinct names, so repeated names
    cost nothing. A gram is a key only where a name has too few rarer ones.
    """
    weights = right.select("name").where("name is not null and name != ''").distinct().select(
        F.explode(grams("name")).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("weight"))
    a, b = _by_rarity(left, weights), _by_rarity(right, weights)

    def heads(sets: DataFrame) -> DataFrame:
        keep = F.col("n") - _bound(min_sim, F.col("n")) + 1
        return sets.select("name", "n", F.explode(F.slice("grams", F.lit(1), keep)).alias("gram"))

    other = heads(b).select(F.col("name").alias("other"), F.col("n").alias("m"), "gram")
    close = (F.col("m") >= F.col("n") * min_sim) & (F.col("n") >= F.col("m") * min_sim)
    shared = heads(a).join(other, "gram").where(close).groupBy("name", "other", "n", "m").agg(F.count(F.lit(1)).alias("shared"))
    need = _bound(min_sim / (1 + min_sim), F.col("n") + F.col("m"))
    able = shared.where(F.col("shared") >= need - _bound(min_sim, F.greatest("n", "m")) + 1)
    pairs = able.join(a.select("name", "grams"), "name").join(
        b.select(F.col("name").alias("other"), F.col("grams").alias("grams_b")), "other")
    common = F.size(F.array_intersect("grams", "grams_b"))
    return pairs.select("name", "other", (common / (F.col("n") + F.col("m") - common)).alias("sim")).where(
        F.col("sim") >= min_sim
    )


def match_approximate(ranked: DataFrame, dictionary: DataFrame, min_sim: float = 0.6) -> DataFrame:
    """The most similar dictionary name per term, if similar enough."""
    keys = _one_code(dictionary, normal_form("term"))
    terms = ranked.withColumn("name", normal_form("term"))
    similar = similar_names(terms.select("name"), keys.select(F.col("key").alias("name")), min_sim)
    best = similar.join(keys.select(F.col("key").alias("other"), "rxcui"), "other").groupBy("name").agg(
        F.max(F.struct("sim", "other", "rxcui")).alias("_b")
    )
    return terms.join(best, "name").select(
        "code", "rank", "term", F.col("_b.rxcui").alias("rxcui"), F.col("_b.sim").alias("sim")
    )


def match_names(
    names: DataFrame, dictionary: DataFrame, min_sim: float | None = 0.6
) -> DataFrame:
    """(code, rxcui, match_type) for every label; NULLs where no tier matches.

    ``names`` has ``code`` and ``terms`` (array in order of preference). A tier only sees labels
    the tiers before it left open; ``min_sim=None`` leaves out the approximate tier. What a tier found and left is
    written, so no tier runs twice.
    """
    ranked = stage(rank_terms(names), "terms")
    tiers = [("exact", match_exact), ("normalized", match_normalized)]
    if min_sim is not None:
        tiers.append(("approximate", lambda r, d: match_approximate(r, d, min_sim)))
    open_terms, found = ranked, None
    for kind, tier in tiers:
        hit = stage(_best(tier(open_terms, dictionary)).withColumn("match_type", F.lit(kind)), "tier")
        found = hit if found is None else found.unionByName(hit)
        open_terms = stage(open_terms.join(hit.select("code"), "code", "left_anti"), "open-terms")
    return names.select("code").distinct().join(found, "code", "left").select(
        "code", "rxcui", "match_type"
    )
