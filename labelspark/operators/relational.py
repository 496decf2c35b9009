"""Filters, projections, joins and set operations shared by the build stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import concat_skip_null, valid_id
from ..schemas import EFFECT_SECTIONS

# --- projections and filters -------------------------------------------------------------


def vocab_filter(atoms: DataFrame, lang: str, source: str, types: tuple[str, ...] = ("PT", "LLT")) -> DataFrame:
    """Atoms of one language, one source vocabulary and some term types."""
    return atoms.where(
        (F.col("LAT") == lang) & (F.col("SAB") == source) & F.col("TTY").isin(*types)
    )


def distinct_terms(atoms: DataFrame) -> DataFrame:
    """Distinct (text_id, text) of a filtered atom table."""
    return atoms.select(F.col("CODE").alias("text_id"), F.col("STR").alias("text")).distinct()


def _present(text: str = "text") -> Column:
    return F.col(text).isNotNull() & (F.col(text) != "")


def unpivot_sections(labels: DataFrame, sections: list[str] = EFFECT_SECTIONS) -> DataFrame:
    """One row per non-empty label section, keyed ``set_id.label_id.version.section.US``."""
    ids = ["set_id", "label_id", "spl_version"]
    long = labels.select(*ids, *sections).unpivot(ids, sections, "section", "text")
    return long.where(_present()).select(
        F.concat(concat_skip_null(ids[0]), F.lit("."), concat_skip_null(ids[1]), F.lit("."),
                 concat_skip_null(ids[2]), F.lit("."), "section", F.lit(".US")).alias("text_id"),
        "text",
    )


def region_texts(labels: DataFrame, region: str) -> DataFrame:
    """Keyed texts of a region that has one adverse-reaction text per label."""
    return labels.where(_present()).select(
        F.concat(concat_skip_null("code"), F.lit(f".AR.{region}")).alias("text_id"), "text"
    )


def split_text_id(df: DataFrame, region: str) -> DataFrame:
    """Rows of one region with the parts of the dotted key as columns."""
    rows = df.where(F.endswith("text_id", F.lit(region)))
    piece = lambda i: F.split_part("text_id", F.lit("."), F.lit(i))
    if region == "US":
        return rows.withColumns(
            {"setid": piece(1), "spl_version": piece(3), "label_section": piece(4)}
        )
    return rows.withColumns({"source_product_id": piece(1), "label_section": F.lit("NA")})


def unnest(df: DataFrame, col: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[c for c in df.columns if c != col], f"{col}.*")


def drop_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def where_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose listed string columns are neither NULL nor empty."""
    return df.where(reduce(lambda a, b: a & b, [_present(c) for c in cols]))


def where_valid_id(df: DataFrame, col: str) -> DataFrame:
    return df.where(valid_id(col))


def score_above(df: DataFrame, threshold: float, score: str = "pred1") -> DataFrame:
    """Score cut-off; rows that were never scored stay."""
    return df.where(F.col(score).isNull() | (F.col(score) > threshold))


def score_above_by_section(
    df: DataFrame, thresholds: dict[str, float], section: str = "label_section", score: str = "pred1"
) -> DataFrame:
    """Score cut-off with one threshold per section.

    A section without a threshold keeps only its unscored rows.
    """
    table = F.create_map(*[F.lit(v) for pair in thresholds.items() for v in pair])
    limit = F.try_element_at(table, F.col(section))
    return df.where(F.col(score).isNull() | (F.col(score) > limit))


# Which sections a section group stands for.
SECTION_GROUPS = {
    "AR": ["AR"], "BW": ["BW"], "WP": ["WP"], "ALL": ["AR", "BW", "WP"], "ARBW": ["AR", "BW"],
}


def resolve_sections(group: str) -> list[str]:
    if group not in SECTION_GROUPS:
        raise ValueError(f"Unknown section: {group}")
    return SECTION_GROUPS[group]


def sections_in(df: DataFrame, group: str, section: str = "section") -> DataFrame:
    return df.where(F.col(section).isin(*resolve_sections(group)))


def by_source(refset: DataFrame, source: str = "all") -> DataFrame:
    """Reference-set rows found by one method, after checking the required columns."""
    missing = {"class", "string", "drug"} - set(refset.columns)
    if missing:
        raise ValueError(f"Reference data is missing required columns: {sorted(missing)}")
    if "source_method" not in refset.columns:
        if source != "exact":
            raise ValueError(f"Invalid source '{source}' for a table without source_method")
        return refset
    if source == "all":
        return refset
    if source not in ("exact", "deepcadrme"):
        raise ValueError(f"Unexpected source: {source}")
    return refset.where(F.col("source_method") == source)


def exclude_flags(
    events: DataFrame, flag1: tuple[str, ...] = (), flag2: tuple[str, ...] = ()
) -> DataFrame:
    out = events
    if flag1:
        out = out.where(~F.col("flag1").isin(*flag1))
    if flag2:
        out = out.where(~F.coalesce("flag2", F.lit("human")).isin(*flag2))
    return out


def min_length(matches: DataFrame, n: int = 4, term: str = "term") -> DataFrame:
    return matches.where(F.length(term) >= n)


# --- joins -------------------------------------------------------------------------------


def us_join(scores: DataFrame, idmap: DataFrame, meta: DataFrame) -> DataFrame:
    """Scores with their mapped ids and product names, on set id and version (as text)."""
    keys = ["setid", "spl_version"]
    ids = idmap.select("setid", F.col("spl_version").cast("string"), "rxcui")
    names = meta.where(F.col("title") != "NOT A DRUG LABEL").select(
        "setid", F.col("spl_version").cast("string"), F.col("title").alias("source_product_name")
    )
    return (
        scores.withColumn("spl_version", F.col("spl_version").cast("string"))
        .join(ids, keys).join(names, keys)
        .withColumn("source_product_id", F.concat("setid", F.lit("."), "spl_version"))
    )


def region_join(scores: DataFrame, meta: DataFrame, idmap: DataFrame) -> DataFrame:
    """Scores of one region with label facts and mapped ids."""
    return scores.join(meta, "source_product_id").join(idmap, "source_product_id")


def join_keys(left: DataFrame, right: DataFrame, lk: str, rk: str) -> DataFrame:
    """Inner join on differently named keys; both key columns are kept."""
    return left.join(right, left[lk] == right[rk])


def left_default(left: DataFrame, right: DataFrame, lk: str, rk: str, default: str) -> DataFrame:
    """Left join; the right-hand text columns fall back to a default."""
    others = [c for c in right.columns if c != rk]
    keyed = right.withColumnRenamed(rk, lk) if rk != lk else right
    return left.join(keyed, lk, "left").withColumns(
        {c: F.coalesce(c, F.lit(default)) for c in others}
    )


def left_on_filtered(
    left: DataFrame, right: DataFrame, lk: str, rk: str, predicate: Column
) -> DataFrame:
    """Left join whose ON clause also filters the right side."""
    kept = right.where(predicate)
    keyed = kept.withColumnRenamed(rk, lk) if rk != lk else kept
    return left.join(keyed, lk, "left")


def _distinct_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    # partial aggregation collapses a hot key before it is shuffled
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias(name)).distinct()


def anti(left: DataFrame, right: DataFrame, lk: str, rk: str | None = None) -> DataFrame:
    """Left rows without a partner (NULL keys have none)."""
    return left.join(_distinct_keys(right, rk or lk, lk), lk, "left_anti").select(*left.columns)


orphans = anti


def semi(left: DataFrame, right: DataFrame, lk: str, rk: str | None = None) -> DataFrame:
    """Left rows with at least one partner."""
    return left.join(_distinct_keys(right, rk or lk, lk), lk, "left_semi").select(*left.columns)


keep_parents = semi
in_keys = semi


def keep_if_both(
    left: DataFrame, first: tuple[str, DataFrame, str], second: tuple[str, DataFrame, str]
) -> DataFrame:
    """Left rows whose two keys both exist; each argument is (left key, parent, parent key)."""
    return semi(semi(left, first[1], first[0], first[2]), second[1], second[0], second[2])


def not_in(left: DataFrame, lk: str, right: DataFrame, rk: str) -> DataFrame:
    """SQL ``NOT IN``: a NULL on the right empties the result.

    The plain SQL form would broadcast the right side whatever its size. Here the match is an
    ordinary anti join and the NULL rule reads two counts.
    """
    facts = right.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(rk).isNull()).alias("n_null")
    )
    kept = anti(left, right, lk, rk)
    rows = facts.select("n").scalar()
    nulls = facts.select("n_null").scalar()
    return kept.where((nulls == 0) & (F.col(lk).isNotNull() | (rows == 0)))


def keep_after_not_in(df: DataFrame, key: str, users: DataFrame, user_key: str) -> DataFrame:
    """What ``DELETE WHERE key NOT IN (users)`` leaves.

    Nothing is deleted when a user key is NULL, everything when there are no users; a NULL key
    is deleted only in the second case.
    """
    facts = users.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(user_key).isNull()).alias("n_null")
    )
    used = _distinct_keys(users, user_key, key).withColumn("_used", F.lit(True))
    nulls, rows = facts.select("n_null").scalar(), facts.select("n").scalar()
    return df.join(used, key, "left").where(
        (rows > 0) & ((nulls > 0) | F.col(key).isNull() | F.col("_used").isNotNull())
    ).select(*df.columns)


def delete_using(left: DataFrame, victims: DataFrame, keys: list[str]) -> DataFrame:
    """Rows left after deleting those whose keys appear among the victims."""
    return left.join(victims.select(*keys).distinct(), keys, "left_anti").select(*left.columns)


def attach_scores(matches: DataFrame, scores: DataFrame, key: str = "match_id") -> DataFrame:
    """Matches with their two scores, joined on the match key."""
    return matches.join(scores.select(key, "pred0", "pred1"), key)


# --- set operations ----------------------------------------------------------------------


def union_texts(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_priority(*dfs: DataFrame) -> DataFrame:
    """UNION ALL with the position of the source as ``source_priority`` (from 1)."""
    return union_all(*[d.withColumn("source_priority", F.lit(i)) for i, d in enumerate(dfs, 1)])


def union_names(mapped: DataFrame, direct: DataFrame) -> DataFrame:
    return union_texts(mapped.select("term", "concept_code"), direct.select("term", "concept_code"))


def append_rows(
    table: DataFrame, rows: DataFrame, id_col: str | None = None, order: list[str] | None = None
) -> DataFrame:
    """The table with more rows; missing columns become NULL, a generated key continues."""
    if id_col is None:
        return table.unionByName(rows, allowMissingColumns=True).select(*table.columns)
    from .ordered import with_surrogate_id

    last = table.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m"))
    numbered = with_surrogate_id(rows, order or rows.columns, id_col)
    shifted = numbered.withColumn(id_col, F.col(id_col) + last.scalar())
    return table.unionByName(shifted, allowMissingColumns=True).select(*table.columns)
