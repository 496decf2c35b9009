"""Label listing and label detail as the annotation work uses them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import drug_name, shuffle_key, squeeze, strip
from ..operators.aggregates import page
from ..operators.match import match_preferred, resolve_overlaps
from ..operators.relational import min_length
from ..schemas import US_SECTIONS


def with_available_sections(labels: DataFrame, sections: list[str] = US_SECTIONS) -> DataFrame:
    """Adds ``sections_available``: codes of the sections that hold text, in fixed order."""
    flags = [F.when(F.length(strip(F.coalesce(s, F.lit("")))) > 0, F.lit(s)) for s in sections]
    return labels.withColumn("sections_available", F.array_compact(F.array(*flags)))


def label_index(labels: DataFrame) -> DataFrame:
    """One row per label: title, drug name, available sections."""
    return with_available_sections(labels).select(
        "set_id", squeeze(F.coalesce("title", F.lit(""))).alias("title"),
        drug_name("title").alias("drug_name"), "sections_available",
    )


def having_sections(index: DataFrame, required: list[str]) -> DataFrame:
    """Labels with at least one required section; their list is cut to the required ones."""
    wanted = F.array(*[F.lit(s) for s in required])
    return index.where(F.arrays_overlap("sections_available", wanted)).withColumn(
        "sections_available", F.array_intersect("sections_available", wanted)
    )


def search_labels(index: DataFrame, query: str = "", pool: list[str] | None = None) -> DataFrame:
    """Labels whose title or drug name contains the query, ignoring case."""
    out = index.where("title != ''")
    if pool:
        out = out.where(F.col("set_id").isin(*pool))
    if query:
        q = F.lit(query.lower())
        out = out.where(F.contains(F.lower("title"), q) | F.contains(F.lower("drug_name"), q))
    return out


def list_labels(
    labels: DataFrame, required: list[str], query: str = "", number: int = 1, size: int = 50,
    pool: list[str] | None = None, seed: int = 42,
) -> DataFrame:
    """One page of labels with totals: by title when searching, else in a seeded order."""
    rows = search_labels(having_sections(label_index(labels), required), query, pool)
    order = [F.lower("title"), "set_id"] if query else [shuffle_key("set_id", seed), "set_id"]
    return page(rows, order, number, size)


def search_vocab(vocab: DataFrame, preferred: DataFrame, query: str, limit: int = 50) -> DataFrame:
    """Vocabulary terms containing the query, with their preferred term where one exists."""
    found = vocab.where(F.contains(F.lower("text"), F.lit(query.lower()))).select(
        F.col("text_id").alias("code"), F.col("text").alias("term")
    ).orderBy("term", "code").limit(limit)
    one = preferred.groupBy(F.col("llt_code").alias("code")).agg(
        F.max(F.struct("pt_code", "pt_name")).alias("_p")
    )
    return found.join(one, "code", "left").select(
        "term", "code", F.col("_p.pt_code").alias("pt_code"), F.col("_p.pt_name").alias("pt_name")
    )


def label_detail(
    labels: DataFrame, vocab: DataFrame, preferred: DataFrame, sections: list[str],
    set_ids: DataFrame | None = None, min_len: int = 4,
) -> DataFrame:
    """Per label and section the chosen, non-overlapping vocabulary matches."""
    rows = labels if set_ids is None else labels.join(set_ids, "set_id", "left_semi")
    texts = rows.select("set_id", *sections).unpivot(["set_id"], sections, "section", "text").where(
        F.length(strip("text")) > 0
    ).select("set_id", "section", F.concat_ws("|", "set_id", "section").alias("text_id"), "text")
    hits = min_length(match_preferred(texts, vocab, preferred, case=False), min_len)
    return resolve_overlaps(hits)


