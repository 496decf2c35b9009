"""The product's tables, derived from the driver's tables so that work grows with them.

Every derivation has an SQL twin in ``checks/common.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import ATOM_COLUMNS, Release

PATHS = [
    ["SBD", "SCDC", "IN"],
    ["SCD", "SCDC", "IN"],
    ["SCDC", "IN"],
    ["IN"],
    ["SBD", "SCDC"],
    ["DF", "SCDC", "IN"],
]


class Testbed:
    """Views over one folder of driver tables."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # --- published model -----------------------------------------------------------------

    def labels(self) -> DataFrame:
        names = F.array(*[F.lit(s) for s in ("US", "UK", "EU", "JP")])
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.alias("label_id"), F.get(names, (key % 4).cast("int")).alias("source"),
            F.col("o_orderpriority").alias("source_product_name"),
            key.cast("string").alias("source_product_id"),
            F.when(key % 10 != 0, F.concat(F.lit("https://labels.example/"), key.cast("string")))
            .alias("source_label_url"),
        )

    def effects(self) -> DataFrame:
        order = F.col("l_orderkey")
        return self.table("lineitem").select(
            order.alias("product_label_id"),
            (order * 10 + F.col("l_linenumber")).alias("effect_id"),
            F.when(F.col("l_returnflag") == "A", "AR").when(F.col("l_returnflag") == "N", "WP")
            .otherwise("BW").alias("label_section"),
            (F.col("l_suppkey") * 10 + F.col("l_quantity").cast("int") % 10).alias("effect_meddra_id"),
            F.when(order % 4 == 3, "SM").otherwise("PMB").alias("match_method"),
            F.col("l_discount").alias("pred0"),
            F.when(order % 4 != 3, F.col("l_extendedprice") / 10000).alias("pred1"),
        )

    def product_map(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("label_id"),
            F.col("l_partkey").cast("string").alias("rxnorm_product_id"),
        ).distinct()

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("rxnorm_id"), F.col("p_name").alias("rxnorm_name"),
            F.col("p_type").alias("rxnorm_term_type"),
        )

    def ingredient_links(self) -> DataFrame:
        word = F.explode(F.split("p_name", " "))
        return self.table("part").select("p_partkey", "p_size", word.alias("w")).select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.concat("w", F.lit("-"), F.col("p_size").cast("string")).alias("ingredient_id"),
        ).distinct()

    def ingredients(self) -> DataFrame:
        ids = self.ingredient_links().select("ingredient_id").distinct()
        return ids.select(
            F.col("ingredient_id").alias("rxnorm_id"), F.col("ingredient_id").alias("rxnorm_name"),
            F.split_part("ingredient_id", F.lit("-"), F.lit(1)).alias("rxnorm_term_type"),
        )

    def effect_vocab(self) -> DataFrame:
        ids = self.effects().select(F.col("effect_meddra_id").alias("meddra_id")).distinct()
        key = F.floor(F.col("meddra_id") / 10).cast("bigint")
        return ids.withColumn("s_suppkey", key).join(
            self.table("supplier").select("s_suppkey", "s_name"), "s_suppkey"
        ).select(
            "meddra_id",
            F.concat("s_name", F.lit("-"), (F.col("meddra_id") % 10).cast("string")).alias("meddra_name"),
            F.when(F.col("meddra_id") % 2 == 0, "PT").otherwise("LLT").alias("meddra_term_type"),
        )

    def release(self, threshold: float | None = 3.258) -> Release:
        from .operators.relational import score_above

        effects = self.effects()
        return Release(
            product_label=self.labels(),
            product_adverse_effect=effects if threshold is None else score_above(effects, threshold),
            product_to_rxnorm=self.product_map(),
            vocab_rxnorm_product=self.products(),
            vocab_rxnorm_ingredient=self.ingredients(),
            vocab_rxnorm_ingredient_to_product=self.ingredient_links(),
            vocab_meddra_adverse_effect=self.effect_vocab(),
        )

    def damaged(self) -> Release:
        """The unthresholded release with rows missing from every parent table."""
        rel = self.release(threshold=None)
        key = lambda c: F.col(c).cast("bigint")
        return rel.with_tables(
            product_label=rel.product_label.where(key("label_id") % 17 != 0),
            vocab_rxnorm_product=rel.vocab_rxnorm_product.where(key("rxnorm_id") % 13 != 0),
            vocab_meddra_adverse_effect=rel.vocab_meddra_adverse_effect.where(key("meddra_id") % 19 != 0),
            vocab_rxnorm_ingredient_to_product=rel.vocab_rxnorm_ingredient_to_product.where(
                key("product_id") % 3 != 0),
            vocab_rxnorm_ingredient=rel.vocab_rxnorm_ingredient.where(
                ~F.endswith("rxnorm_id", F.lit("-7"))),
        )

    # --- texts and vocabulary ------------------------------------------------------------

    def documents(self) -> DataFrame:
        return self.table("documents")

    def texts(self) -> DataFrame:
        return self.documents().select(F.col("doc_id").cast("string").alias("text_id"), "text")

    def vocabulary(self) -> DataFrame:
        """Phrases of two and three words from the benchmark items, and the last of them alone."""
        from .functions import words

        w = self.table("benchmark").select("item_id", words("text").alias("w")).where(F.size("w") >= 3)
        item = F.col("item_id")
        kinds = [
            (item * 10 + 1, F.array_join(F.slice("w", 1, 2), " ")),
            (item * 10 + 2, F.array_join(F.slice("w", 1, 3), " ")),
            (item * 10 + 3, F.array_join(F.slice("w", 2, 2), " ")),
            (item * 10 + 4, F.get("w", F.lit(2))),
        ]
        pairs = F.explode(F.array(*[F.struct(k.cast("string").alias("text_id"), t.alias("text")) for k, t in kinds]))
        return w.select(pairs.alias("p")).select("p.*").where(F.length("text") >= 4)

    def phrases(self) -> DataFrame:
        """Every run of two to five words of every benchmark item, of eight characters at least."""
        from .functions import words

        n = F.explode(F.sequence(F.lit(2), F.lit(5))).alias("n")
        runs = self.table("benchmark").select("item_id", words("text").alias("w"), n).where("size(w) >= n").select(
            "item_id", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
        return runs.select(F.concat_ws(".", "item_id", "n", "i").alias("text_id"),
                           F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("text")).where(F.length("text") >= 8)

    def us_labels(self) -> DataFrame:
        doc = F.col("doc_id")
        return self.documents().select(
            F.concat(F.lit("set"), doc.cast("string")).alias("set_id"),
            F.concat(F.lit("lab"), doc.cast("string")).alias("label_id"),
            (doc % 5).cast("string").alias("spl_version"),
            F.concat(
                F.lit("These highlights do not include all the information needed to use "),
                F.upper(F.substring("source", 1, 5)), F.lit(" tablets safely. "), F.col("lang"),
            ).alias("title"),
            F.col("text").alias("AR"),
            F.when(doc % 3 == 0, F.col("text")).when(doc % 3 == 1, F.lit("")).alias("BW"),
            F.when(doc % 8 == 0, F.reverse("text")).alias("WP"),
            F.lit("").alias("WA"), F.lit(None).cast("string").alias("PR"),
            F.when(doc % 12 == 0, F.lit(" ")).alias("SP"), F.col("lang").alias("OV"),
        )

    def region_labels(self, region: str) -> DataFrame:
        doc = F.col("doc_id")
        cols = [
            F.concat(F.col("source"), F.lit(" "), F.col("lang")).alias("name"),
            F.concat(F.lit(region), doc.cast("string")).alias("code"),
            F.when(doc % 11 != 0, F.concat(F.lit("D"), (doc % 100).cast("string"))).alias("kegg_id"),
            F.concat(F.lit("https://labels.example/"), doc.cast("string")).alias("page_url"),
            F.when(doc % 7 != 0, F.col("text")).otherwise("").alias("text"),
        ]
        if region != "JP":
            cols.pop(2)
        return self.documents().select(*cols)

    def scores(self) -> DataFrame:
        """Matches with scores as the scoring stage writes them (US, UK and EU keys)."""
        order = F.col("l_orderkey")
        text_id = (
            F.when(order % 4 == 0, F.concat(
                F.lit("set"), order.cast("string"), F.lit(".lab"), order.cast("string"), F.lit("."),
                (order % 5).cast("string"), F.lit("."),
                F.when(F.col("l_returnflag") == "A", "AR").when(F.col("l_returnflag") == "N", "WP").otherwise("BW"),
                F.lit(".US")))
            .when(order % 4 == 1, F.concat(F.lit("UK"), order.cast("string"), F.lit(".AR.UK")))
            .when(order % 4 == 2, F.concat(F.lit("EU"), order.cast("string"), F.lit(".AR.EU")))
        )
        return self.table("lineitem").select(
            text_id.alias("text_id"),
            (F.col("l_suppkey") * 10 + F.col("l_quantity").cast("int") % 10).cast("string").alias("term_id"),
            F.col("l_discount").alias("pred0"), (F.col("l_extendedprice") / 10000).alias("pred1"),
        ).where("text_id is not null")

    def jp_matches(self) -> DataFrame:
        order = F.col("l_orderkey")
        return self.table("lineitem").where(order % 4 == 3).select(
            F.concat(F.lit("JP"), order.cast("string"), F.lit(".AR.JP")).alias("text_id"),
            (F.col("l_suppkey") * 10 + F.col("l_quantity").cast("int") % 10).cast("string").alias("term_id"),
        )

    def us_map(self) -> DataFrame:
        order = F.col("o_orderkey")
        base = self.table("orders").where(order % 4 == 0).select(
            F.concat(F.lit("set"), order.cast("string")).alias("setid"),
            (order % 5).cast("int").alias("spl_version"), "o_custkey",
        )
        codes = F.explode(F.array(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
            F.concat(F.lit("S"), (F.col("o_custkey") % 10).cast("string")),
        ))
        return base.select("setid", "spl_version", codes.alias("rxcui"))

    def us_meta(self) -> DataFrame:
        order = F.col("o_orderkey")
        return self.table("orders").where(order % 4 == 0).select(
            F.concat(F.lit("set"), order.cast("string")).alias("setid"),
            (order % 5).cast("int").alias("spl_version"),
            F.when(order % 40 == 0, "NOT A DRUG LABEL").when(order % 36 == 0, F.lit(None))
            .otherwise(F.col("o_orderpriority")).alias("title"),
        )

    def order_labels(self, region: str) -> DataFrame:
        """Label facts (name, code, kegg_id, page_url) that belong to :meth:`scores`."""
        at = {"UK": 1, "EU": 2, "JP": 3}[region]
        order = F.col("o_orderkey")
        return self.table("orders").where(order % 4 == at).select(
            F.col("o_orderpriority").alias("name"),
            F.concat(F.lit(region), order.cast("string")).alias("code"),
            F.when(order % 11 != 0, F.concat(F.lit("D"), F.col("o_custkey").cast("string"))).alias("kegg_id"),
            F.when(order % 10 != 0, F.concat(F.lit("https://labels.example/"), order.cast("string"))).alias("page_url"),
        )

    def order_codes(self, region: str) -> DataFrame:
        at = {"UK": 1, "EU": 2}[region]
        order = F.col("o_orderkey")
        return self.table("orders").where(order % 4 == at).select(
            F.concat(F.lit(region), order.cast("string")).alias("code"),
            F.when(order % 9 == 0, F.lit(None)).when(order % 7 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("rxcui"),
        )

    # --- ontology ------------------------------------------------------------------------

    def nodes(self) -> DataFrame:
        """Concepts from the dimension tables, and the effect terms."""
        def node(table, key, kind, vocab, cls, code, name):
            k = F.col(key).cast("bigint")
            return self.table(table).select(
                (k * 10 + kind).alias("concept_id"), F.col(name).alias("concept_name"),
                F.lit(vocab).alias("vocabulary_id"), F.lit(cls).alias("concept_class_id"),
                code(k).alias("concept_code"),
                F.when(k % 17 == 0, F.lit("D")).alias("invalid_reason"),
            )

        tag = lambda t: lambda k: F.concat(F.lit(t), k.cast("string"))
        terms = self.effects().select(F.col("effect_meddra_id").alias("k")).distinct().select(
            (F.col("k") * 10 + 6).alias("concept_id"),
            F.concat(F.lit("Term "), F.col("k").cast("string")).alias("concept_name"),
            F.lit("MedDRA").alias("vocabulary_id"),
            F.when(F.col("k") % 2 == 0, "PT").otherwise("LLT").alias("concept_class_id"),
            F.col("k").cast("string").alias("concept_code"),
            F.when(F.col("k") % 17 == 0, F.lit("D")).alias("invalid_reason"),
        )
        parts = [
            node("customer", "c_custkey", 1, "RxNorm", "Branded Drug", tag("C"), "c_name"),
            node("nation", "n_nationkey", 2, "RxNorm", "Clinical Drug Comp", tag("N"), "n_name"),
            node("region", "r_regionkey", 3, "RxNorm", "Ingredient", tag("R"), "r_name"),
            node("supplier", "s_suppkey", 4, "RxNorm Extension", "Clinical Drug", tag("S"), "s_name"),
            node("part", "p_partkey", 5, "NDC", "9-digit NDC",
                 lambda k: F.lpad(k.cast("string"), 9, "0"), "p_name"),
        ]
        out = terms
        for p in parts:
            out = out.unionByName(p)
        return out

    def edges(self) -> DataFrame:
        def edge(df, one, k1, two, k2, rel):
            return df.select(
                (F.col(one).cast("bigint") * 10 + k1).alias("concept_id_1"),
                (F.col(two).cast("bigint") * 10 + k2).alias("concept_id_2"),
                F.lit(rel).alias("relationship_id"),
            )

        term = self.effects().select(F.col("effect_meddra_id").alias("k")).distinct().where("k % 2 = 1")
        parts = [
            edge(self.table("customer"), "c_custkey", 1, "c_nationkey", 2, "Consists of"),
            edge(self.table("supplier"), "s_suppkey", 4, "s_nationkey", 2, "Consists of"),
            edge(self.table("nation"), "n_nationkey", 2, "n_regionkey", 3, "Has ingredient"),
            edge(self.table("lineitem").select("l_partkey", "l_suppkey").distinct(),
                 "l_partkey", 5, "l_suppkey", 4, "Maps to"),
            term.select((F.col("k") * 10 + 6).alias("concept_id_1"),
                        ((F.col("k") - 1) * 10 + 6).alias("concept_id_2"), F.lit("Is a").alias("relationship_id")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn(
            "invalid_reason", F.when(F.col("concept_id_1") % 23 == 0, F.lit("D"))
        )

    def kegg(self) -> DataFrame:
        key = F.col("p_partkey")
        nine = F.lpad(key.cast("string"), 9, "0")
        eight = F.lpad(key.cast("string"), 8, "0")
        return self.table("part").select(
            F.concat(F.lit("dr:D"), key.cast("string")).alias("kegg_id"),
            F.when(key % 3 == 0, F.concat(F.lit("ndc:"), F.substring(nine, 1, 5), F.lit("-"), F.substring(nine, 6, 4)))
            .otherwise(F.concat(F.lit("ndc:"), F.substring(eight, 1, 4), F.lit("-"), F.substring(eight, 5, 4)))
            .alias("ndc_id"),
        )

    def atoms(self) -> DataFrame:
        """Vocabulary atoms in the layout of the pipe-delimited file."""
        k = F.col("c_custkey")
        values = {
            "CUI": F.concat(F.lit("C"), F.lpad(k.cast("string"), 7, "0")),
            "LAT": F.when(k % 3 == 0, "JPN").otherwise("ENG"),
            "SAB": F.when(k % 3 == 0, "MDRJPN").when(k % 5 == 0, "RXNORM").otherwise("MDR"),
            "TTY": F.when(k % 4 == 0, "PT").when(k % 4 == 3, "OL").otherwise("LLT"),
            "CODE": F.when((k % 5 == 0) & (k % 3 != 0), F.concat(F.lit("C"), k.cast("string")))
            .otherwise((F.floor(k / 6) * 3).cast("string")),
            "STR": F.concat(F.col("c_mktsegment"), F.lit(' "'), (k % 50).cast("string"), F.lit('"')),
            "SUPPRESS": F.lit("N"),
        }
        return self.table("customer").select(
            *[values.get(c, F.lit("")).alias(c) for c in ATOM_COLUMNS]
        )

    def name_terms(self) -> DataFrame:
        """(code, terms): product names to look up, in order of preference."""
        k = F.col("p_partkey")
        own = F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))
        return self.table("part").select(
            F.concat(F.lit("L"), k.cast("string")).alias("code"),
            F.array(
                F.when(k % 4 != 0, F.upper(F.col("p_name"))),
                F.when(k % 4 == 0, F.concat(F.lit("TABLETS, "), own)),
                F.when(k % 5 == 0, own),
            ).alias("terms"),
        )

    def name_dictionary(self) -> DataFrame:
        """(term, concept_code): part names with brand, and some bare names."""
        k = F.col("p_partkey")
        return self.table("part").select(
            F.when(k % 3 == 0, F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")))
            .otherwise(F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))).alias("term"),
            F.col("p_partkey").cast("string").alias("concept_code"),
        ).unionByName(
            self.table("part").where("p_partkey % 7 = 0").select(
                F.col("p_name").alias("term"), F.concat(F.lit("N"), F.col("p_size").cast("string")).alias("concept_code"))
        )

    # --- annotations ---------------------------------------------------------------------

    def annotated_events(self) -> DataFrame:
        """Flat annotated events: one per line item."""
        q = F.col("l_quantity").cast("int")
        order = F.col("l_orderkey")
        return self.table("lineitem").select(
            F.concat(F.lit("drug"), (F.floor(order / 8)).cast("string")).alias("drug"),
            F.when(order % 3 == 0, "AR").when(order % 3 == 1, "BW").otherwise("WP").alias("section"),
            F.when(order % 5 == 0, "test").otherwise("train").alias("tac"),
            F.when(q % 7 != 0, F.concat((F.col("l_suppkey") % 50).cast("string"), F.lit(".0"))).alias("pt_id"),
            F.when(q % 5 == 0, F.lit("")).when(q % 5 == 1, F.lit("NaN"))
            .otherwise(F.col("l_suppkey").cast("string")).alias("llt_id"),
            F.when(q % 11 == 0, "animal").when(q % 11 == 1, "drug_class").otherwise("human").alias("flag2"),
        )

    def annotation_files(self) -> DataFrame:
        """Annotation records over the documents: events are the vocabulary's first-word hits."""
        doc = F.col("doc_id")
        n = (doc % 6).cast("int")
        events = F.transform(
            F.sequence(F.lit(1), F.lit(6)),
            lambda i: F.array(
                F.concat(F.lit("term "), i.cast("string")), F.concat(F.lit("Term "), (i % 3).cast("string")),
                F.when(i % 5 != 0, F.concat(((doc + i % 3) % 40 * 10 + 1).cast("string"), F.lit(".0"))),
                F.concat(F.lit("term "), i.cast("string")), ((doc + i) % 40 * 10 + 2).cast("string"),
                F.when(i != 4, (i * 60).cast("string")), F.lit("4"),
            ),
        )
        return self.documents().select(
            F.concat(F.lit("drug"), doc.cast("string")).alias("label_id"),
            F.when(doc % 3 == 0, "Adverse Reactions").when(doc % 3 == 1, "boxed warnings")
            .otherwise("warnings and precautions").alias("section_name"),
            self.evidence_text().alias("section_text"),
            F.slice(events, F.lit(1), n).alias("adverse_events"),
            F.when(doc % 5 == 0, "test").otherwise("train").alias("tac"),
            F.concat(F.lit("set-"), F.col("lang")).alias("dataset"),
        )

    def evidence_text(self):
        """Document text with blank lines and, in some documents, evidence phrases."""
        doc = F.col("doc_id")
        return F.concat(
            F.when(doc % 7 == 0, "Seen in animal studies only.\n\n").otherwise(""),
            F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")),
            F.when(doc % 5 == 0, "\n\nA Class  Effect is likely.").otherwise(""),
        )

    # --- scores for evaluation -----------------------------------------------------------

    def scored_classes(self) -> DataFrame:
        """(drug, section, label, score): one row per line item."""
        return self.table("lineitem").select(
            F.concat(F.lit("drug"), (F.col("l_orderkey") % 500).cast("string")).alias("drug"),
            F.when(F.col("l_returnflag") == "A", "AR").when(F.col("l_returnflag") == "N", "WP")
            .otherwise("BW").alias("section"),
            F.when(F.col("l_extendedprice") + F.col("l_suppkey") * 500 % 50000 > 65000, 1).otherwise(0).alias("label"),
            F.floor(F.col("l_extendedprice") / 100).cast("double").alias("score"),
        )
