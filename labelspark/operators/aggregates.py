"""Aggregations. Every one combines map-side, so a hot key reaches the shuffle as few rows."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import n_chars, n_words, ratio, shuffle_key, valid_id
from ..schemas import SOURCES
from .joins import null_safe_join


def count_by(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), key)


def count_distinct_by(df: DataFrame, key: str, value: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(value).alias(name))


def multi_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row count and several distinct counts in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.countDistinct(c).alias(f"n_{c}") for c in cols],
    )


def having_distinct(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Keys with exactly n distinct values."""
    counted = df.groupBy(*keys).agg(F.countDistinct(value).alias("_n"))
    return counted.where(F.col("_n") == n).select(*keys)


def count_stats(parent: DataFrame, child: DataFrame, pk: str, ck: str, name: str) -> DataFrame:
    """Average, least and most children per parent; a parent without children counts 0."""
    per_key = child.groupBy(F.col(ck).alias(pk)).agg(F.count(F.lit(1)).alias("_n"))
    counts = (
        parent.select(pk).distinct().join(per_key, pk, "left")
        .select(F.coalesce("_n", F.lit(0)).alias("_n"))
    )
    return counts.agg(
        F.avg("_n").alias(f"avg_{name}"), F.min("_n").alias(f"min_{name}"),
        F.max("_n").alias(f"max_{name}"), F.count(F.lit(1)).alias("total_products"),
    )


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def source_flags(rel: DataFrame, keys: list[str], source: str = "source") -> DataFrame:
    """One 0/1 column per source and how many sources a key appears in."""
    return rel.groupBy(*keys).agg(
        F.countDistinct(source).alias("num_sources"),
        *[F.max((F.col(source) == s).cast("int")).alias(s) for s in SOURCES],
    )


def source_combinations() -> list[tuple[str, ...]]:
    """The subsets of two or more sources."""
    order = ["US", "EU", "UK", "JP"]
    return [c for k in range(2, 5) for c in combinations(order, k)]


def combination_counts(flags: DataFrame) -> DataFrame:
    """Pairs, ingredients and effects found in each combination of sources.

    One pass: every pair is expanded to the combinations it belongs to (at most 11).
    """
    combos = F.array(*[
        F.when(reduce(lambda a, b: a & b, [F.col(s) == 1 for s in c]), F.lit("-".join(c)))
        for c in source_combinations()
    ])
    member = flags.select(
        "ingredient_id", "effect_meddra_id",
        F.explode(F.array_compact(combos)).alias("source_combo"),
    )
    return member.groupBy("source_combo").agg(
        F.count(F.lit(1)).alias("num_ades"),
        F.countDistinct("ingredient_id").alias("num_ingredients"),
        F.countDistinct("effect_meddra_id").alias("num_effects"),
    )


def with_group_count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Each row with the size of its group.

    Counting first and joining back keeps a hot group spread over tasks; a window would
    pull it into one.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return null_safe_join(df, counts, keys, "left")


def flag1(events: DataFrame, keys: list[str], pt: str = "pt_id") -> DataFrame:
    """Adds ``flag1``: unmapped, duplicate (the code repeats within the keys) or clean."""
    from ..functions import id_string

    coded = events.withColumn("_pt", id_string(pt))
    counts = (
        coded.where(F.col("_pt").isNotNull()).groupBy(*keys, "_pt")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    flagged = coded.join(counts, [*keys, "_pt"], "left").withColumn(
        "flag1",
        F.when(~valid_id(pt), "unmapped").when(F.col("_n") > 1, "duplicate").otherwise("clean"),
    )
    return flagged.select(*events.columns, "flag1")


def share_in_group(df: DataFrame, group: str, value: str, by: str) -> DataFrame:
    """Distinct values per (group, by) with the group's total and the share."""
    hits = df.groupBy(group, by).agg(F.countDistinct(value).alias("n"))
    total = df.groupBy(group).agg(F.countDistinct(value).alias("total"))
    return null_safe_join(hits, total, [group]).withColumn("fraction", ratio("n", "total"))


def code_sets(events: DataFrame, keys: list[str], codes: list[str]) -> DataFrame:
    """Distinct annotated codes per record, as an array."""
    from ..functions import id_string

    long = events.select(*keys, F.explode(F.array(*[id_string(c) for c in codes])).alias("code"))
    return (
        long.where(F.col("code").isNotNull()).distinct()
        .groupBy(*keys).agg(F.sort_array(F.collect_list("code")).alias("codes"))
    )


def profile_by_section(records: DataFrame, by: list[str] = ["section_name"]) -> DataFrame:
    """Records, events, mapped events and rates of an annotation table.

    ``records`` holds ``section_text`` and ``adverse_events`` (array of string arrays).
    """
    n_events = F.coalesce(F.size("adverse_events"), F.lit(0))
    mapped = F.size(F.filter("adverse_events", lambda e: valid_id(e[2])))
    facts = records.select(
        *by, n_events.alias("_e"), F.when(n_events > 0, mapped).otherwise(0).alias("_m"),
        n_words("section_text").alias("_w"),
    )
    out = facts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("_e") > 0).alias("records_with_events"),
        F.sum("_e").alias("total_events"),
        F.sum("_m").alias("mapped_events"),
        F.avg("_w").alias("avg_words"),
    )
    return out.withColumns({
        "events_per_record": ratio("total_events", "records"),
        "mapped_pct": F.coalesce(ratio("mapped_events", "total_events") * 100, F.lit(0.0)),
    })


def profile_all(records: DataFrame, dataset: str = "dataset") -> DataFrame:
    """One line per dataset and a TOTAL line."""
    n_events = F.coalesce(F.size("adverse_events"), F.lit(0))
    mapped = F.size(F.filter("adverse_events", lambda e: valid_id(e[2])))
    facts = records.select(
        F.col(dataset), n_events.alias("_e"), F.when(n_events > 0, mapped).otherwise(0).alias("_m"),
        n_words("section_text").alias("_w"),
    )
    out = facts.rollup(dataset).agg(
        F.count(F.lit(1)).alias("records"), F.sum("_e").alias("events"),
        F.sum("_m").alias("mapped"), F.avg("_w").alias("avg_words"),
    )
    return out.select(
        F.coalesce(dataset, F.lit("TOTAL")).alias("dataset"), "records", "events",
        ratio("events", "records").alias("events_per_record"), "avg_words",
        F.coalesce(ratio("mapped", "events") * 100, F.lit(0.0)).alias("mapped_pct"),
    )


def length_stats(df: DataFrame, by: list[str], measure: Column, name: str) -> DataFrame:
    """Mean, median, quartiles (linear interpolation), least and most of a measure.

    Equal values are counted first; the exact percentile then works on (value, count), so its
    state is as large as the number of different lengths and not the number of rows.
    """
    counted = df.select(*by, measure.alias("_v")).groupBy(*by, "_v").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counted.groupBy(*by).agg(
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias(f"mean_{name}"),
        F.expr("percentile(_v, 0.5D, _n)").alias(f"median_{name}"),
        F.expr("percentile(_v, 0.25D, _n)").alias(f"p25_{name}"),
        F.expr("percentile(_v, 0.75D, _n)").alias(f"p75_{name}"),
        F.min("_v").alias(f"min_{name}"), F.max("_v").alias(f"max_{name}"),
    )


def text_length_stats(records: DataFrame, by: list[str], text: str = "section_text") -> DataFrame:
    words = length_stats(records, by, n_words(text), "words")
    chars = length_stats(records, by, n_chars(text), "chars")
    return null_safe_join(words, chars, by)


def class_balance(refset: DataFrame, keys: list[str] = ["drug", "section"]) -> DataFrame:
    """Positive and negative examples per record and overall (the row with NULL keys)."""
    sets = [keys, []]
    out = refset.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.count_if(F.col("class") == "is_event").alias("n_pos"),
        F.count_if(F.col("class") != "is_event").alias("n_neg"),
    )
    return out


def flag_distribution(events: DataFrame, flag: str = "flag2") -> DataFrame:
    """Events and percentage per flag value."""
    counts = events.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))
    total = events.agg(F.count(F.lit(1)).alias("t"))
    return counts.withColumn("pct", ratio("n", total.scalar()) * 100)


def annotation_counts(docs: DataFrame) -> DataFrame:
    """Annotations per tool document."""
    total = F.aggregate(
        F.map_values("sections"), F.lit(0), lambda acc, anns: acc + F.size(anns)
    )
    return docs.select("annotator", "label_id", "label_title", "status", "updated_at",
                       F.coalesce(total, F.lit(0)).alias("annotation_count"))


def label_status(docs: DataFrame) -> DataFrame:
    """Per label, the status each annotator left it in."""
    latest = docs.groupBy("label_id", "annotator").agg(
        F.max_by(F.coalesce("status", F.lit("in_progress")),
                 F.struct("updated_at", "status")).alias("status")
    )
    return latest.groupBy("label_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("annotator", "status")))).alias("statuses")
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table and whether it is non-empty."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts).withColumn("ok", F.col("n_rows") > 0)


# --- keep-one and limits -----------------------------------------------------------------


def first_by_priority(df: DataFrame, key: str, priority: str, values: list[str]) -> DataFrame:
    """One row per key: the lowest priority number, then the smallest values.

    A minimum over a struct combines map-side where a row number would sort every row.
    """
    best = df.groupBy(key).agg(F.min(F.struct(F.col(priority), *values)).alias("_b"))
    return best.select(key, *[F.col(f"_b.{v}").alias(v) for v in values])


def top_k(df: DataFrame, metric: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(metric), tie).limit(k)


def top_rows(df: DataFrame, score: str, k: int, ties: list[str]) -> DataFrame:
    """The k best rows; rows without a score come last."""
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(k)


def page(df: DataFrame, order: list, number: int, size: int) -> DataFrame:
    """One page of rows with the total and the page count on each row."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size)
    return rows.withColumns({
        "total": total, "pages": F.ceil(total / F.lit(size)).cast("bigint"),
    })


def seeded_order(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A stable shuffled order, NULL keys first."""
    return df.orderBy(shuffle_key(key, seed), key)


def effects_in_all(rel: DataFrame, sources: list[str]) -> DataFrame:
    """Effects that appear in every one of the sources."""
    inside = rel.where(F.col("source").isin(*sources))
    return having_distinct(inside, ["effect_meddra_id"], "source", len(sources))
