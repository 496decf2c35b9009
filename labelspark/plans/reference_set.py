"""Labelled examples from annotated label sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import id_string, let, valid_id
from ..operators.match import match_examples
from ..operators.dictionary import preferred_terms
from ..operators.relational import resolve_sections
from ..schemas import REFERENCE_SET

# Section names of the annotation files.
SECTION_CODES = {
    "adverse reactions": "AR",
    "boxed warnings": "BW",
    "warnings and precautions": "WP",
}


def annotated_codes(
    events: Column, exclude_flag1: tuple[str, ...] = (), exclude_flag2: tuple[str, ...] = ()
) -> Column:
    """Distinct preferred and lower-level codes of a record's events that pass both flags."""
    def quality(e: Column, pts: Column) -> Column:
        pt = id_string(F.get(e, F.lit(2)))
        return (
            F.when(~valid_id(F.get(e, F.lit(2))), "unmapped")
            .when(F.size(F.filter(pts, lambda p: p == pt)) > 1, "duplicate").otherwise("clean")
        )

    kept = events
    if exclude_flag1:
        codes_of = F.transform(events, lambda e: id_string(F.get(e, F.lit(2))))
        kept = let(codes_of, lambda pts: F.filter(
            events, lambda e: ~quality(e, pts).isin(*exclude_flag1)
        ))
    if exclude_flag2:
        kept = F.filter(
            kept, lambda e: ~F.coalesce(F.get(e, F.lit(7)), F.lit("human")).isin(*exclude_flag2)
        )
    codes = F.flatten(F.transform(
        kept, lambda e: F.array(id_string(F.get(e, F.lit(2))), id_string(F.get(e, F.lit(4))))
    ))
    return F.array_sort(F.array_distinct(F.array_compact(codes)))


def annotation_records(
    annotations: DataFrame, group: str = "ALL", exclude_flag1: tuple[str, ...] = (),
    exclude_flag2: tuple[str, ...] = (),
) -> DataFrame:
    """(drug, section, tac, text, codes) of the requested sections.

    ``annotations`` has the annotation-file columns and ``tac``.
    """
    table = F.create_map(*[F.lit(v) for pair in SECTION_CODES.items() for v in pair])
    code = F.try_element_at(table, F.lower("section_name"))
    return annotations.withColumn("section", code).where(
        F.col("section").isin(*resolve_sections(group))
    ).select(
        F.upper("label_id").alias("drug"), "section", "tac",
        F.coalesce("section_text", F.lit("")).alias("text"),
        annotated_codes(
            F.coalesce("adverse_events", F.array().cast("array<array<string>>")),
            exclude_flag1, exclude_flag2,
        ).alias("codes"),
    )


def tool_records(docs: DataFrame, labels: DataFrame, group: str = "ALL") -> DataFrame:
    """Records of the annotation tool with the label text; always the test part."""
    sections = resolve_sections(group)
    texts = labels.select("set_id", *sections).unpivot(["set_id"], sections, "section", "text").where(
        "trim(text) != ''"
    ).withColumnRenamed("set_id", "label_id")
    anns = docs.select("annotator", "label_id", F.explode("sections").alias("section", "_a")).where(
        F.size("_a") > 0
    )
    non_blank = lambda c: F.nullif(c, F.lit(""))
    codes = F.flatten(F.transform(
        "_a", lambda a: F.array(non_blank(a["pt_code"]), non_blank(a["term_code"]))
    ))
    return anns.join(texts, ["label_id", "section"]).select(
        F.upper("label_id").alias("drug"), "section", F.lit("test").alias("tac"), "text",
        F.array_sort(F.array_distinct(F.array_compact(codes))).alias("codes"),
    )


def label_matches(matches: DataFrame, codes: str = "codes") -> DataFrame:
    """Adds ``class``: the term or its preferred term is among the record's codes."""
    hit = F.array_contains(codes, F.col("term_id")) | F.array_contains(codes, F.col("pt_code"))
    return matches.withColumn("class", F.when(hit, "is_event").otherwise("not_event"))


def reference_set(
    records: DataFrame, vocab: DataFrame, preferred: DataFrame, method: int = 14, nwords: int = 125
) -> DataFrame:
    """Labelled examples of records (drug, section, tac, text, codes).

    A record's codes travel in its own row and preferred terms in the dictionary, so matches need no join.
    """
    keyed = records.withColumn("_key", F.concat_ws("|", "drug", "section", "tac"))
    hits = match_examples(keyed, preferred_terms(vocab, preferred), method, nwords, key="_key", normalize=True,
                          carry=("pt_code", "pt_name", "code_name"))
    examples = label_matches(hits.withColumns({
        "pt_code": F.coalesce("pt_code", "term_id"), "pt_name": F.coalesce("pt_name", "code_name")}))
    return examples.select(
        "section", "drug", "tac", F.col("term_id").alias("meddra_id"),
        F.col("pt_code").alias("pt_meddra_id"), F.lit("exact").alias("source_method"), "class",
        F.col("pt_name").alias("pt_meddra_term"), F.col("term").alias("found_term"), "string",
    ).select(*REFERENCE_SET.fieldNames())


def build_reference_set(
    annotations: DataFrame, vocab: DataFrame, preferred: DataFrame, method: int = 14,
    nwords: int = 125, group: str = "AR", exclude_flag1: tuple[str, ...] = (),
    exclude_flag2: tuple[str, ...] = (),
) -> DataFrame:
    records = annotation_records(annotations, group, exclude_flag1, exclude_flag2)
    return reference_set(records, vocab, preferred, method, nwords)


def build_reference_set_tool(
    docs: DataFrame, labels: DataFrame, vocab: DataFrame, preferred: DataFrame,
    method: int = 14, nwords: int = 125, group: str = "AR",
) -> DataFrame:
    return reference_set(tool_records(docs, labels, group), vocab, preferred, method, nwords)
