"""Paragraphs of a section text and the kind of evidence each one reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import let, matches_any

# Phrases that mark class-wide and animal evidence.
DRUG_CLASS_PATTERNS = [
    r"\bclass\s+effect\b",
    r"\bclass\s+of\s+drug",
    r"\bdrug\s*class\b",
    r"\bclass[\s-]+related\b",
    r"\bdrugs\s+in\s+this\s+class\b",
    r"\bother\s+drugs\s+in\s+the\s+same\s+class\b",
    r"\bclass\s+of\s+(antidepressant|antipsychotic|opioid|nsaid|ace\s+inhibitor|statin|beta|laba|corticosteroid|fluoroquinolone|thiazolidinedione)",
    r"\b(?:drugs|agents|compounds)\s+(?:of|in)\s+this\s+(?:class|type|category)\b",
]
ANIMAL_PATTERNS = [
    r"\bin\s+animal\s+(?:studies|experiments|models|toxicology|reproductive)",
    r"\bnonclinical\s+toxicology\b",
    r"\bcarcinogenesis\b",
    r"\bmutagenesis\b",
    r"\breproductive\s+toxicology\b",
    r"\bteratogenic(?:ity)?\s+(?:effects?|studies?)\b",
    r"\banimal\s+(?:data|reproduction)\b",
    r"\bin\s+(?:rats?|mice|rabbits?|dogs?|monkeys?|primates?|cynomolgus)\b",
    r"\b(?:embryo|fetal)\s*[-–]?\s*(?:lethality|toxicity|death)\b",
    r"\bprenatal\s+and\s+postnatal\b",
]
# Fixed value: a blank line, or a line break in front of a numbered heading; blanks are those of Unicode.
PARAGRAPH_BREAK = r"\n\s*\n|\n(?=\s*\d+\.\d+\s)"


def classify_evidence(text: Column | str) -> Column:
    """drug_class, else animal, else human."""
    return (
        F.when(matches_any(text, DRUG_CLASS_PATTERNS), "drug_class")
        .when(matches_any(text, ANIMAL_PATTERNS), "animal")
        .otherwise("human")
    )


def paragraph_array(text: Column | str) -> Column:
    """Paragraphs as (start, stop, text); a paragraph begins at its break.

    Breaks are marked with two control characters and the text is split on them. A first such character of the
    text itself is followed by another second one meanwhile, so every character stays in its piece.
    """
    nul, own, mark = "\x00", "\x00\x01", "\x00\x02"
    col = F.replace(F.col(text) if isinstance(text, str) else text, F.lit(nul), F.lit(own))
    marked = F.regexp_replace(col, f"(?U)({PARAGRAPH_BREAK})", f"{mark}$1")
    pieces = F.transform(F.split(marked, mark), lambda p: F.replace(p, F.lit(own), F.lit(nul)))
    return F.aggregate(
        pieces,
        F.array().cast("array<struct<start:int,stop:int,paragraph:string>>"),
        lambda acc, p: F.array_append(
            acc,
            F.struct(
                F.coalesce(F.try_element_at(acc, F.lit(-1))["stop"], F.lit(0)).alias("start"),
                (F.coalesce(F.try_element_at(acc, F.lit(-1))["stop"], F.lit(0)) + F.length(p)).alias("stop"),
                p.alias("paragraph"),
            ),
        ),
    )


def paragraphs(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per paragraph with its offsets [start, stop)."""
    others = [c for c in texts.columns if c != text]
    return texts.select(*others, F.posexplode(paragraph_array(text)).alias("paragraph_no", "_p")).select(
        *others, "paragraph_no", "_p.start", "_p.stop", "_p.paragraph"
    )


def point_in_interval(point: Column, spans: Column, value: str, default: str) -> Column:
    """The value of the first span [start, stop) that holds the point."""
    inside = F.filter(spans, lambda s: (s["start"] <= point) & (point < s["stop"]))
    return F.coalesce(F.try_element_at(inside, F.lit(1))[value], F.lit(default))


def _classified(text: Column) -> Column:
    return F.transform(
        paragraph_array(text),
        lambda p: F.struct(
            p["start"].alias("start"), p["stop"].alias("stop"),
            classify_evidence(p["paragraph"]).alias("flag2"),
        ),
    )


def add_evidence_flag(records: DataFrame) -> DataFrame:
    """Annotation records whose events carry the evidence kind as their eighth element."""
    def flagged(spans: Column) -> Column:
        return F.transform(
            "adverse_events",
            lambda e: F.array_append(
                F.slice(e, 1, 7),
                point_in_interval(
                    F.coalesce(e[5].cast("double").cast("int"), F.lit(0)), spans, "flag2", "human"
                ),
            ),
        )

    spans = _classified(F.coalesce("section_text", F.lit("")))
    return records.withColumn("adverse_events", let(spans, flagged))


def flatten_events(records: DataFrame, keep: list[str]) -> DataFrame:
    """One row per annotated event; a missing evidence kind reads as human."""
    exploded = records.select(*keep, F.posexplode("adverse_events").alias("event_no", "_e"))
    at = lambda i: F.get("_e", F.lit(i))
    return exploded.select(
        *keep, "event_no", at(0).alias("term"), at(1).alias("pt_name"), at(2).alias("pt_id"),
        at(3).alias("llt_name"), at(4).alias("llt_id"), at(5).alias("start"), at(6).alias("length"),
        F.coalesce(at(7), F.lit("human")).alias("flag2"),
    )
