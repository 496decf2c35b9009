"""The drug ontology: nodes, labelled edges, hops and allowed class paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strip_tokens
from ..session import stage

DRUG_VOCABULARIES = ["RxNorm", "RxNorm Extension"]

# The concept classes behind each term type of a path.
CLASSES_OF_TYPE = {
    "BN": ["Brand Name"],
    "PIN": ["Precise Ingredient"],
    "DF": ["Dose Form"],
    "SBDC": ["Branded Drug Comp"],
    "SCD": ["Clinical Drug", "Quant Clinical Drug"],
    "BPCK": ["Branded Pack"],
    "IN": ["Ingredient"],
    "SCDF": ["Clinical Drug Form"],
    "SCDC": ["Clinical Drug Comp"],
    "SBD": ["Branded Drug", "Quant Branded Drug"],
    "DFG": ["Dose Form Group"],
    "MIN": ["Multiple Ingredients"],
    "SBDG": ["Branded Dose Group"],
    "GPCK": ["Clinical Pack"],
    "SBDF": ["Branded Drug Form"],
    "SCDG": ["Clinical Dose Group"],
}
# The published forward table names one class differently from its reverse table, so paths
# through it find nothing; strict_parity keeps that.
STRICT_SCDF = ["Clinical Dose Form"]
START_CLASSES = [
    "Clinical Drug", "Branded Drug", "Quant Clinical Drug", "Quant Branded Drug", "Brand Name",
    "Branded Pack", "Clinical Pack", "Ingredient", "Clinical Drug Comp", "Branded Drug Form",
    "Branded Drug Comp", "Clinical Drug Form", "Multiple Ingredients", "Precise Ingredient",
    "Branded Dose Group",
]


def class_table(strict_parity: bool = False) -> dict[str, list[str]]:
    return {**CLASSES_OF_TYPE, "SCDF": STRICT_SCDF} if strict_parity else CLASSES_OF_TYPE


def one_hop(
    nodes: DataFrame, edges: DataFrame, relationship: str, to_vocabularies: list[str],
    from_vocabularies: list[str] | None = None,
) -> DataFrame:
    """Node -> edge -> node, with the edge label and the vocabularies filtered before joining."""
    start = nodes if from_vocabularies is None else nodes.where(
        F.col("vocabulary_id").isin(*from_vocabularies)
    )
    frm = start.select(
        F.col("concept_id").alias("concept_id_1"), F.col("concept_code").alias("from_code"),
        F.col("concept_name").alias("from_name"),
    )
    to = nodes.where(F.col("vocabulary_id").isin(*to_vocabularies)).select(
        F.col("concept_id").alias("concept_id_2"), F.col("concept_code").alias("to_code"),
        F.col("concept_name").alias("to_name"),
    )
    via = edges.where(F.col("relationship_id") == relationship).select("concept_id_1", "concept_id_2")
    return frm.join(via, "concept_id_1").join(to, "concept_id_2").select(
        "from_code", "from_name", "to_code", "to_name"
    )


def preferred_map(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lower-level term code -> preferred term code and name ('Is a' edges that are valid)."""
    terms = nodes.where(
        (F.col("vocabulary_id") == "MedDRA") & F.col("concept_class_id").isin("PT", "LLT")
        & F.col("invalid_reason").isNull()
    )
    llt = terms.where("concept_class_id = 'LLT'").select(
        F.col("concept_id").alias("concept_id_1"), F.col("concept_code").alias("llt_code")
    )
    pt = terms.where("concept_class_id = 'PT'").select(
        F.col("concept_id").alias("concept_id_2"), F.col("concept_code").alias("pt_code"),
        F.col("concept_name").alias("pt_name"),
    )
    via = edges.where(
        (F.col("relationship_id") == "Is a") & F.col("invalid_reason").isNull()
    ).select("concept_id_1", "concept_id_2")
    return llt.join(via, "concept_id_1").join(pt, "concept_id_2").select(
        "llt_code", "pt_code", "pt_name"
    )


def to_preferred(matches: DataFrame, preferred: DataFrame, code: str = "term_id",
                 name: str = "term") -> DataFrame:
    """Adds pt_code and pt_name; a term without a parent is its own preferred term."""
    one = preferred.groupBy(F.col("llt_code").alias(code)).agg(
        F.max(F.struct("pt_code", "pt_name")).alias("_p")
    )
    return matches.join(one, code, "left").withColumns({
        "pt_code": F.coalesce("_p.pt_code", F.col(code)),
        "pt_name": F.coalesce("_p.pt_name", F.col(name)),
    }).drop("_p")


def bilingual_map(en: DataFrame, ja: DataFrame) -> DataFrame:
    """English and Japanese names of the same code."""
    left = en.select(F.col("CODE").alias("code"), F.col("TTY").alias("tty"), F.col("STR").alias("eng_str"))
    right = ja.select(F.col("CODE").alias("code"), F.col("STR").alias("jpn_str"))
    return left.join(right, "code")


def drug_name_dictionary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Names usable for a drug code: names mapped to it and its own name."""
    from .relational import union_names

    mapped = one_hop(nodes, edges, "Maps to", DRUG_VOCABULARIES).select(
        F.col("from_name").alias("term"), F.col("to_code").alias("concept_code")
    )
    own = nodes.where(F.col("vocabulary_id").isin(*DRUG_VOCABULARIES)).select(
        F.col("concept_name").alias("term"), "concept_code"
    )
    return union_names(mapped, own)


def ndc_to_drug(kegg: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """KEGG drug id -> drug code over the package code (8 digits are padded to 9)."""
    ndc = strip_tokens("ndc_id", "ndc:", "-")
    ids = kegg.select(
        strip_tokens("kegg_id", "dr:").alias("kegg_id"),
        F.when(F.length(ndc) == 8, F.concat(F.lit("0"), ndc)).otherwise(ndc).alias("from_code"),
    )
    drugs = one_hop(nodes, edges, "Maps to", DRUG_VOCABULARIES, from_vocabularies=["NDC"])
    return ids.join(drugs.select("from_code", "to_code"), "from_code").select(
        "kegg_id", F.col("to_code").alias("rxnorm_code")
    )


def usable_paths(
    paths: list[list[str]], starts: list[str] = START_CLASSES, end: str = "IN",
    strict_parity: bool = False,
) -> list[list[str]]:
    """Distinct paths that begin in an allowed class and end in the ingredient class."""
    classes = CLASSES_OF_TYPE
    start_types = {t for t, names in classes.items() if set(names) & set(starts)}
    kept = {tuple(p) for p in paths if p and p[-1] == end and p[0] in start_types}
    return [list(p) for p in sorted(kept)]


def usable_paths_df(paths: DataFrame, starts: list[str] = START_CLASSES, end: str = "IN") -> DataFrame:
    """The same rule on a table of paths (``path`` array<string>)."""
    start_types = [t for t, names in CLASSES_OF_TYPE.items() if set(names) & set(starts)]
    return paths.where(
        (F.size("path") > 0) & (F.element_at("path", -1) == end)
        & F.element_at("path", 1).isin(*start_types)
    ).distinct()


def ingredient_paths(
    mapped: DataFrame, nodes: DataFrame, edges: DataFrame, paths: list[list[str]],
    product: str = "rxnorm_product_id", strict_parity: bool = False,
) -> DataFrame:
    """Distinct (product_id, ingredient_id) reachable over the allowed class paths.

    The paths form a prefix tree whose nodes are states. All of them are walked together, level by level: a frontier
    of distinct (product, node, state) rows meets the edges once and the small table of transitions once, so the
    number of joins grows with the longest path, not with the number of paths.
    """
    classes = class_table(strict_parity)
    wanted = usable_paths(paths)
    drugs = nodes.where(F.col("vocabulary_id").isin(*DRUG_VOCABULARIES))
    spark = nodes.sparkSession
    states = {(): 0}
    moves = []
    for path in wanted:
        for depth in range(1, len(path) + 1):
            head = tuple(path[:depth])
            if head not in states:
                states[head] = len(states)
                moves += [(states[head[:-1]], c, states[head], list(head) in wanted) for c in classes[head[-1]]]
    # fixed by the declared paths: some rows per step
    step = F.broadcast(spark.createDataFrame(moves, "_state int, _class string, _next int, _ends boolean"))
    # every edge between drug nodes, with the class it leads to
    hops = stage(
        edges.select("concept_id_1", "concept_id_2").distinct()
        .join(drugs.select(F.col("concept_id").alias("concept_id_2"),
                           F.col("concept_class_id").alias("_class"),
                           F.col("concept_code").alias("_code")), "concept_id_2"), "hops")
    at = mapped.select(F.col(product).alias("product_id")).distinct().join(
        drugs.select(F.col("concept_code").alias("product_id"), "concept_id",
                     F.col("concept_class_id").alias("_class"),
                     F.col("concept_code").alias("_code")), "product_id"
    ).withColumn("_state", F.lit(0))
    found = None
    for level in range(max(map(len, wanted), default=0)):
        if level:
            at = at.withColumnRenamed("concept_id", "concept_id_1").join(hops, "concept_id_1").select(
                "product_id", F.col("concept_id_2").alias("concept_id"), "_class", "_code", "_state")
        reached = at.join(step, ["_state", "_class"]).select(
            "product_id", "concept_id", "_code", F.col("_next").alias("_state"), "_ends").distinct()
        reached = stage(reached, "frontier")
        done = reached.where("_ends").select("product_id", F.col("_code").alias("ingredient_id"))
        found = done if found is None else found.unionByName(done)
        at = reached.select("product_id", "concept_id", "_state")
    if found is None:
        return at.select("product_id", F.col("_code").alias("ingredient_id")).limit(0)
    return found.distinct()
