"""Integrity checks of a release: one row (test, result) each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import n_folded
from ..operators.relational import anti
from ..schemas import Release


def _report(bad: DataFrame, test: str, what: str) -> DataFrame:
    n = bad.agg(n_folded(bad).alias("n"))
    return n.select(
        F.lit(test).alias("test"),
        F.when(F.col("n") == 0, "PASS")
        .otherwise(F.concat(F.lit("FAIL ("), F.col("n").cast("string"), F.lit(f" {what})")))
        .alias("result"),
    )


def check_1a(r: Release) -> DataFrame:
    bad = anti(r.product_to_rxnorm, r.vocab_rxnorm_product, "rxnorm_product_id", "rxnorm_id")
    return _report(bad, "1a: mapped products are in the product vocabulary", "missing vocab_rxnorm_product entries")


def check_1b(r: Release) -> DataFrame:
    bad = anti(r.product_adverse_effect, r.vocab_meddra_adverse_effect, "effect_meddra_id", "meddra_id")
    return _report(bad, "1b: effects are in the effect vocabulary", "missing vocab_meddra_adverse_effect entries")


def check_2a(r: Release) -> DataFrame:
    bad = anti(r.product_to_rxnorm, r.product_label, "label_id")
    return _report(bad, "2a: mapping rows reference a label", "orphaned product_label references in product_to_rxnorm")


def check_2b(r: Release) -> DataFrame:
    bad = anti(r.product_adverse_effect, r.product_label, "product_label_id", "label_id")
    return _report(bad, "2b: effect rows reference a label", "orphaned product_label references in product_adverse_effect")


def check_3a(r: Release) -> DataFrame:
    bad = anti(r.vocab_rxnorm_ingredient_to_product, r.vocab_rxnorm_ingredient, "ingredient_id", "rxnorm_id")
    return _report(bad, "3a: ingredients are in the ingredient vocabulary", "missing vocab_rxnorm_ingredient entries")


def check_3b(r: Release) -> DataFrame:
    products = r.vocab_rxnorm_ingredient_to_product.where("ingredient_id is not null").select(
        F.col("product_id").alias("rxnorm_product_id")
    ).distinct()
    covered = r.product_to_rxnorm.join(products, "rxnorm_product_id", "left_semi")
    bad = anti(r.product_label.select("label_id").distinct(), covered, "label_id")
    return _report(bad, "3b: every label has an ingredient", "product_label entries missing an ingredient mapping")


def check_4a(r: Release) -> DataFrame:
    bad = anti(r.vocab_rxnorm_product, r.product_to_rxnorm, "rxnorm_id", "rxnorm_product_id")
    return _report(bad, "4a: product vocabulary is used", "vocab_rxnorm_product entries not linked")


def check_4b(r: Release) -> DataFrame:
    bad = anti(r.vocab_rxnorm_ingredient, r.vocab_rxnorm_ingredient_to_product, "rxnorm_id", "ingredient_id")
    return _report(bad, "4b: ingredient vocabulary is used", "vocab_rxnorm_ingredient entries not linked")


def check_4c(r: Release) -> DataFrame:
    bad = anti(r.vocab_meddra_adverse_effect, r.product_adverse_effect, "meddra_id", "effect_meddra_id")
    return _report(bad, "4c: effect vocabulary is used", "vocab_meddra_adverse_effect entries not linked")


def check_5a(r: Release) -> DataFrame:
    bad = r.product_label.where(
        "source is null or source_product_name is null or source_product_id is null"
    )
    return _report(bad, "5a: required label fields are set", "product_label rows with missing required fields")


def check_5b(r: Release) -> DataFrame:
    bad = r.vocab_rxnorm_product.where("rxnorm_name is null or rxnorm_term_type is null")
    return _report(bad, "5b: required product fields are set", "vocab_rxnorm_product rows with missing required fields")


CHECKS = {
    "1a": check_1a, "1b": check_1b, "2a": check_2a, "2b": check_2b, "3a": check_3a, "3b": check_3b,
    "4a": check_4a, "4b": check_4b, "4c": check_4c, "5a": check_5a, "5b": check_5b,
}


def check_all(r: Release) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [check(r) for check in CHECKS.values()])
