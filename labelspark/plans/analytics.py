"""Analytical queries on the published tables.

Many-to-many joins multiply rows, so each query first reduces both sides of a join to the
distinct pairs it needs: (label, ingredient) and (label, effect). A label or an effect that
holds a large share of all rows is then collapsed before anything is shuffled. Where pairs of
ingredient and effect are counted, ingredients are numbered and 64 of them are one word of bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..operators.aggregates import count_stats, source_combinations, top_k
from ..operators.joins import null_safe_join
from ..operators.ordered import number_rows
from ..operators.relational import semi
from ..schemas import SOURCES, Release
from ..session import stage


def label_ingredients(rel: Release, known_product: bool = False) -> DataFrame:
    """Distinct (label_id, ingredient_id)."""
    product = F.col("rxnorm_product_id").alias("product_id")
    mapped = rel.product_to_rxnorm.select("label_id", product)
    if known_product:
        mapped = semi(mapped, rel.vocab_rxnorm_product, "product_id", "rxnorm_id")
    return mapped.join(
        rel.vocab_rxnorm_ingredient_to_product, "product_id"
    ).select("label_id", "ingredient_id").distinct()


def label_effects(rel: Release) -> DataFrame:
    """Distinct (label_id, effect_meddra_id)."""
    return rel.product_adverse_effect.select(
        F.col("product_label_id").alias("label_id"), "effect_meddra_id"
    ).where("label_id is not null and effect_meddra_id is not null").distinct()


def _names(rel: Release) -> DataFrame:
    return rel.vocab_meddra_adverse_effect.select(
        F.col("meddra_id").alias("effect_meddra_id"), "meddra_name"
    )


def _effect_rows(rel: Release, effect: str) -> DataFrame:
    """Effect rows with one name; the filtered vocabulary is the small side."""
    ids = _names(rel).where(F.col("meddra_name") == effect).select("effect_meddra_id")
    return rel.product_adverse_effect.join(ids, "effect_meddra_id", "left_semi")


def _numbered(ids: DataFrame, key: str) -> DataFrame:
    """(key, _word, _place, _bit): distinct keys (NULL is one) numbered densely, 64 to a word of bits."""
    placed = number_rows(ids.select(key).distinct(), [key], "_no", start=0)
    return placed.select(key, F.shiftright("_no", 6).alias("_word"), F.expr("cast(_no % 64 as int)").alias("_place"),
                         F.expr("shiftleft(1L, cast(_no % 64 as int))").alias("_bit"))


def _label_bits(rel: Release, members: DataFrame, known_product: bool = False) -> DataFrame:
    """(label_id, _word, _bits): the ``members`` (ingredient_id, _word, _bit) of each label, 64 to a row."""
    links = null_safe_join(rel.vocab_rxnorm_ingredient_to_product, members.select("ingredient_id", "_word", "_bit"), ["ingredient_id"])
    products = links.groupBy("product_id", "_word").agg(F.bit_or("_bit").alias("_bits"))
    mapped = rel.product_to_rxnorm.select("label_id", F.col("rxnorm_product_id").alias("product_id"))
    if known_product:
        mapped = semi(mapped, rel.vocab_rxnorm_product, "product_id", "rxnorm_id")
    return mapped.join(products, "product_id").groupBy("label_id", "_word").agg(F.bit_or("_bits").alias("_bits"))


def _effect_bits(rel: Release, members: DataFrame) -> DataFrame:
    """(effect_meddra_id, _word, _bits): the ``members`` met with each effect on labels that exist.

    Pairs of ingredient and effect are bits here: a pair is never a row that is shuffled.
    """
    bits = _label_bits(rel, members).join(rel.product_label.select("label_id"), "label_id", "left_semi")
    return label_effects(rel).join(bits, "label_id").groupBy("effect_meddra_id", "_word").agg(F.bit_or("_bits").alias("_bits"))


def ingredients_for_effect(rel: Release, effect: str) -> DataFrame:
    labels = _effect_rows(rel, effect).select(F.col("product_label_id").alias("label_id")).distinct()
    known = labels.join(rel.product_label.select("label_id"), "label_id", "left_semi")
    # the effect's labels first, then their products, then ingredients: nothing is listed for other labels
    products = rel.product_to_rxnorm.join(known, "label_id", "left_semi").select(F.col("rxnorm_product_id").alias("product_id"))
    ids = semi(rel.vocab_rxnorm_ingredient_to_product, products, "product_id").select("ingredient_id").distinct()
    return rel.vocab_rxnorm_ingredient.join(
        ids, F.col("rxnorm_id") == F.col("ingredient_id"), "left_semi"
    ).distinct()


def _labels_with(rel: Release, source: str, effect: str | None) -> DataFrame:
    names = _names(rel) if effect is None else _names(rel).where(F.col("meddra_name") == effect)
    rows = rel.product_adverse_effect.join(
        names.select("effect_meddra_id").distinct(), "effect_meddra_id", "left_semi"
    ).select(F.col("product_label_id").alias("label_id")).distinct()
    return rows.join(
        rel.product_label.where(F.col("source") == source).select("label_id"), "label_id", "left_semi"
    )


def effect_fraction(rel: Release, effect: str, source: str = "US") -> DataFrame:
    """Share of a source's products with effects that list this effect."""
    some = _labels_with(rel, source, effect).agg(F.count(F.lit(1)).alias("n"))
    every = _labels_with(rel, source, None).agg(F.count(F.lit(1)).alias("n"))
    return some.select(ratio("n", every.scalar()).alias("fraction"))


def top_effects_by_ingredients(rel: Release, k: int = 10) -> DataFrame:
    known = rel.vocab_rxnorm_ingredient.select(F.col("rxnorm_id").alias("ingredient_id"))
    members = _numbered(rel.vocab_rxnorm_ingredient_to_product.join(known, "ingredient_id", "left_semi"), "ingredient_id")
    named = _effect_bits(rel, members).join(_names(rel), "effect_meddra_id")
    words = named.groupBy("meddra_name", "_word").agg(F.bit_or("_bits").alias("_bits"))
    counts = words.groupBy("meddra_name").agg(F.sum(F.bit_count("_bits")).alias("n_ingredients"))
    return top_k(counts, "n_ingredients", k, "meddra_name")


def _top_effects(rel: Release, rows: DataFrame, labels: DataFrame, k: int, name: str) -> DataFrame:
    pairs = rows.select(F.col("product_label_id").alias("label_id"), "effect_meddra_id").distinct()
    kept = pairs.join(labels.select("label_id"), "label_id", "left_semi")
    counts = kept.join(_names(rel), "effect_meddra_id").groupBy("meddra_name").agg(
        F.countDistinct("label_id").alias(name)
    )
    return top_k(counts, name, k, "meddra_name")


def top_effects_in_source(rel: Release, source: str = "UK", k: int = 10) -> DataFrame:
    labels = rel.product_label.where(F.col("source") == source)
    return _top_effects(rel, rel.product_adverse_effect, labels, k, "n_products")


def top_effects_in_section(rel: Release, section: str = "WP", k: int = 15) -> DataFrame:
    rows = rel.product_adverse_effect.where(F.col("label_section") == section)
    return _top_effects(rel, rows, rel.product_label, k, "occurrence_count")


def top_ingredients_by_effects(rel: Release, k: int = 10) -> DataFrame:
    names = rel.vocab_rxnorm_ingredient.select(F.col("rxnorm_id").alias("ingredient_id"), "rxnorm_name")
    numbered = _numbered(names, "rxnorm_name")
    members = null_safe_join(names.where("ingredient_id is not null"), numbered, ["rxnorm_name"])
    known = semi(_effect_bits(rel, members), rel.vocab_meddra_adverse_effect, "effect_meddra_id", "meddra_id")
    per_bit = known.select("_word", "_bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_place")).where(
        _is_set("_bits")).groupBy("_word", "_place").agg(F.count(F.lit(1)).alias("n_adverse_effects"))
    counts = per_bit.join(numbered, ["_word", "_place"]).select("rxnorm_name", "n_adverse_effects")
    return top_k(counts, "n_adverse_effects", k, "rxnorm_name")


def products_with_ingredient(rel: Release, ingredient: str) -> DataFrame:
    ids = rel.vocab_rxnorm_ingredient.where(F.col("rxnorm_name") == ingredient).select(
        F.col("rxnorm_id").alias("ingredient_id")
    )
    labels = label_ingredients(rel).join(ids, "ingredient_id", "left_semi").select("label_id").distinct()
    return rel.product_label.join(labels, "label_id", "left_semi").select(
        "source_product_name", "source_label_url"
    ).distinct()


def prevalence_by_source(rel: Release, effect: str, sources: tuple[str, ...] = ("US", "UK")) -> DataFrame:
    """Products with an effect against all products, per source."""
    labels = rel.product_label.where(F.col("source").isin(*sources)).select("label_id", "source")
    total = labels.groupBy("source").agg(F.countDistinct("label_id").alias("total_products"))
    with_effect = _effect_rows(rel, effect).select(
        F.col("product_label_id").alias("label_id")
    ).distinct()
    hits = labels.join(with_effect, "label_id", "left_semi").groupBy("source").agg(
        F.countDistinct("label_id").alias("products_with_effect")
    )
    return hits.join(total, "source").withColumn(
        "fraction", ratio("products_with_effect", "total_products")
    )


def best_products_for_effect(rel: Release, effect: str, k: int = 20) -> DataFrame:
    rows = _effect_rows(rel, effect).select(
        F.col("product_label_id").alias("label_id"), F.col("pred1").alias("confidence_score")
    )
    out = rel.product_label.join(rows, "label_id").select(
        "source_product_name", "confidence_score", "source_label_url"
    )
    return out.orderBy(
        F.desc_nulls_last("confidence_score"), "source_product_name",
        F.asc_nulls_first("source_label_url"),
    ).limit(k)


def _is_set(bits: str) -> Column:
    return F.expr(f"shiftright({bits}, _place) & 1 = 1")


def _source_words(rel: Release) -> tuple[DataFrame, DataFrame]:
    """Numbered ingredients, and (effect_meddra_id, _word) with the bits of each of the known sources.

    ``_all`` holds the bits of any label, ``_named`` those of labels with a source, ``_others`` (else NULL) those of
    each source that is not among the known ones.
    """
    numbered = _numbered(rel.vocab_rxnorm_ingredient_to_product, "ingredient_id")
    labels = rel.product_label.select("label_id", "source")
    bits = _label_bits(rel, numbered, known_product=True).join(labels, "label_id")
    met = stage(label_effects(rel).join(bits, "label_id").groupBy("source", "effect_meddra_id", "_word").agg(
        F.bit_or("_bits").alias("_bits")), "source_bits")
    some = lambda test: F.coalesce(F.bit_or(F.when(test, F.col("_bits"))), F.lit(0).cast("bigint"))
    keys = ["effect_meddra_id", "_word"]
    words = met.groupBy(*keys).agg(
        *[some(F.col("source") == s).alias(s) for s in SOURCES],
        some(F.col("source").isNotNull()).alias("_named"), F.bit_or("_bits").alias("_all"))
    others = met.where(~F.col("source").isin(*SOURCES)).groupBy(*keys).agg(F.collect_list("_bits").alias("_others"))
    return numbered, words.join(others, keys, "left")


def source_intersection(rel: Release) -> DataFrame:
    """Pairs of ingredient and effect, a 0/1 column per source and how many sources a pair appears in."""
    numbered, words = _source_words(rel)
    members = numbered.groupBy("_word").agg(F.collect_list(F.struct("_place", "ingredient_id")).alias("_members"))
    pairs = words.join(members, "_word").select("*", F.explode("_members").alias("_m")).select(
        "*", F.col("_m._place").alias("_place"), F.col("_m.ingredient_id").alias("ingredient_id")).where(_is_set("_all"))
    flags = {s: F.when(_is_set("_named"), F.expr(f"cast(shiftright({s}, _place) & 1 as int)")) for s in SOURCES}
    more = F.coalesce(F.size(F.filter("_others", lambda o: F.call_function("shiftright", o, F.col("_place")).bitwiseAND(F.lit(1)) == 1)), F.lit(0))
    listed = sum((F.expr(f"shiftright({s}, _place) & 1") for s in SOURCES), F.lit(0).cast("bigint"))
    return pairs.select(
        "ingredient_id", "effect_meddra_id", (listed + F.when(F.col("_others").isNull(), 0).otherwise(more)).alias("num_sources"),
        *[c.alias(s) for s, c in flags.items()])


def combination_counts(rel: Release) -> DataFrame:
    """Pairs, ingredients and effects found in each combination of sources, counted as bits."""
    numbered, words = _source_words(rel)
    # NULL takes part in pairs but is no ingredient
    ids = numbered.groupBy("_word").agg(F.coalesce(F.bit_or(F.when(F.col("ingredient_id").isNotNull(), F.col("_bit"))), F.lit(0)).alias("_ids"))
    combos = F.array(*[
        F.struct(F.lit("-".join(c)).alias("source_combo"), reduce(lambda a, b: a.bitwiseAND(b), map(F.col, c)).alias("_bits"))
        for c in source_combinations()])
    member = words.join(ids, "_word").select("effect_meddra_id", "_word", "_ids", F.explode(combos).alias("_c")).select(
        "effect_meddra_id", "_word", "_ids", "_c.*").where("_bits != 0")
    effects = member.groupBy("source_combo", "effect_meddra_id").agg(F.sum(F.bit_count("_bits")).alias("_n")).groupBy(
        "source_combo").agg(F.sum("_n").alias("num_ades"), F.count(F.lit(1)).alias("num_effects"))
    ingredients = member.groupBy("source_combo", "_word").agg(
        F.bit_or(F.col("_bits").bitwiseAND(F.col("_ids"))).alias("_bits")).groupBy("source_combo").agg(
        F.sum(F.bit_count("_bits")).alias("num_ingredients"))
    return effects.join(ingredients, "source_combo").select("source_combo", "num_ades", "num_ingredients", "num_effects")


def high_confidence(rel: Release, n: int = 4) -> DataFrame:
    """Pairs found in all n sources."""
    return source_intersection(rel).where(F.col("num_sources") == n).select("ingredient_id", "effect_meddra_id")


def share_with_ingredients(rel: Release) -> DataFrame:
    """A label counts when one of its products has an ingredient; its ingredients are not listed for that."""
    links = rel.vocab_rxnorm_ingredient_to_product.where("ingredient_id is not null")
    mapped = semi(rel.product_to_rxnorm, links, "rxnorm_product_id", "product_id")
    labels = rel.product_label.select("label_id").distinct()
    having = semi(labels, mapped, "label_id").agg(F.count(F.lit(1)).alias("n"))
    total = rel.product_label.agg(F.count(F.lit(1)).alias("n")).scalar()
    return having.select(
        F.col("n").alias("products_with_ingredients"), total.alias("total_products"),
        ratio("n", total).alias("fraction_products_with_ingredients"),
    )


def products_by_source(rel: Release) -> DataFrame:
    return rel.product_label.groupBy("source").agg(
        F.count(F.lit(1)).alias("product_count")
    ).orderBy(F.desc("product_count"), "source")


def ingredient_count_stats(rel: Release) -> DataFrame:
    return count_stats(rel.product_label, label_ingredients(rel), "label_id", "label_id", "ingredients")


def effect_count_stats(rel: Release) -> DataFrame:
    rows = rel.product_adverse_effect.where("effect_id is not null")
    return count_stats(rel.product_label, rows, "label_id", "product_label_id", "effects")


def share_mapped(rel: Release) -> DataFrame:
    mapped = rel.product_to_rxnorm.agg(F.countDistinct("label_id").alias("n"))
    total = rel.product_label.agg(F.count(F.lit(1)).alias("n")).scalar()
    return mapped.select(
        F.col("n").alias("product_labels_with_rxnorm_mapping"), total.alias("total_product_labels"),
        (ratio("n", total) * 100).alias("percent_with_rxnorm_mapping"),
    )


def share_effects_in_vocab(rel: Release) -> DataFrame:
    per_effect = rel.product_adverse_effect.groupBy("effect_meddra_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    known = rel.vocab_meddra_adverse_effect.groupBy(
        F.col("meddra_id").alias("effect_meddra_id")
    ).agg(F.count(F.lit(1)).alias("k"))
    counts = per_effect.join(known, "effect_meddra_id", "left").agg(
        F.coalesce(F.sum(F.col("n") * F.col("k")), F.lit(0)).alias("mapped_adverse_effects"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_adverse_events"),
    )
    return counts.withColumn(
        "percent_with_meddra_condition_mapping",
        ratio("mapped_adverse_effects", "total_adverse_events") * 100,
    )
