"""Column layouts of every input, intermediate and published table."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_STRING, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_SIMPLE = {"string": _STRING, "bigint": _LONG, "int": _INT, "double": _DOUBLE}


def _struct(spec: str, **nested: T.DataType) -> T.StructType:
    """A struct from "name type, ..." with simple types, nested fields appended."""
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _SIMPLE[kind]))
    return T.StructType(fields + [T.StructField(n, t) for n, t in nested.items()])


US_SECTIONS = ["AR", "BW", "WP", "WA", "PR", "SP", "OV"]
EFFECT_SECTIONS = ["AR", "BW", "WP"]
SOURCES = ["US", "UK", "EU", "JP"]

US_LABEL = _struct(
    "set_id string, label_id string, spl_version string, title string, "
    + ", ".join(f"{s} string" for s in US_SECTIONS)
)
US_LABEL_JSON = _struct(
    "set_id string, label_id string, spl_version string, title string",
    sections=_struct(", ".join(f"{s} string" for s in US_SECTIONS)),
)
UK_LABEL = EU_LABEL = _struct("name string, code string, page_url string, text string")
JP_LABEL = _struct("name string, code string, kegg_id string, page_url string, text string")
LABEL_META = _struct("name string, code string, kegg_id string, page_url string")
INDEXED_TEXT = _struct("text_id string, text string")

US_ID_MAP = _struct("setid string, spl_version string, rxcui string, rxstring string, rxtty string")
US_META = _struct("setid string, zip_file_name string, upload_date string, spl_version string, title string")
KEGG_NDC = _struct("kegg_id string, ndc_id string")
NAME_MAP = _struct("code string, rxcui string, match_type string")

# The column order of the vocabulary's pipe-delimited atom file.
ATOM_COLUMNS = [
    "CUI", "LAT", "TS", "LUI", "STT", "SUI", "ISPREF", "AUI", "SAUI",
    "SCUI", "SDUI", "SAB", "TTY", "CODE", "STR", "SRL", "SUPPRESS", "CVF",
]
ATOMS = _struct(", ".join(f"{c} string" for c in ATOM_COLUMNS))

CONCEPT = _struct(
    "concept_id bigint, concept_name string, domain_id string, vocabulary_id string, "
    "concept_class_id string, standard_concept string, concept_code string, "
    "valid_start_date string, valid_end_date string, invalid_reason string"
)
CONCEPT_RELATIONSHIP = _struct(
    "concept_id_1 bigint, concept_id_2 bigint, relationship_id string, "
    "valid_start_date string, valid_end_date string, invalid_reason string"
)

MATCH = _struct("match_id bigint, text_id string, term_id string, term string, context string")
SCORE = _struct(
    "match_id bigint, text_id string, term_id string, term string, context string, "
    "pred0 double, pred1 double"
)

ANNOTATION_FILE = _struct(
    "label_id string, section_name string, section_text string",
    adverse_events=T.ArrayType(T.ArrayType(_STRING)),
)
TOOL_SPAN = _struct(
    "id string, entity_type string, term_text string, term_code string, pt_code string, "
    "pt_name string, start bigint, end bigint, section_code string, source string",
    extra_fields=T.MapType(_STRING, _STRING),
)
TOOL_ANNOTATION = _struct(
    "task_id string, label_id string, label_title string, annotator string, status string, "
    "created_at string, updated_at string, notes string",
    sections=T.MapType(_STRING, T.ArrayType(TOOL_SPAN)),
)
ARRIVAL = _struct("source string, product_id string, version string, section string, text string, delivery bigint")
REFERENCE_SET = _struct(
    "section string, drug string, tac string, meddra_id string, pt_meddra_id string, "
    "source_method string, class string, pt_meddra_term string, found_term string, string string"
)

PRODUCT_LABEL = _struct(
    "label_id bigint, source string, source_product_name string, source_product_id string, "
    "source_label_url string"
)
PRODUCT_ADVERSE_EFFECT = _struct(
    "product_label_id bigint, effect_id bigint, label_section string, effect_meddra_id bigint, "
    "match_method string, pred0 double, pred1 double"
)
PRODUCT_TO_RXNORM = _struct("label_id bigint, rxnorm_product_id string")
VOCAB_RXNORM = _struct("rxnorm_id string, rxnorm_name string, rxnorm_term_type string")
INGREDIENT_TO_PRODUCT = _struct("product_id string, ingredient_id string")
VOCAB_MEDDRA = _struct("meddra_id bigint, meddra_name string, meddra_term_type string")

RELEASE_SCHEMAS = {
    "product_label": PRODUCT_LABEL,
    "product_adverse_effect": PRODUCT_ADVERSE_EFFECT,
    "product_to_rxnorm": PRODUCT_TO_RXNORM,
    "vocab_rxnorm_product": VOCAB_RXNORM,
    "vocab_rxnorm_ingredient": VOCAB_RXNORM,
    "vocab_rxnorm_ingredient_to_product": INGREDIENT_TO_PRODUCT,
    "vocab_meddra_adverse_effect": VOCAB_MEDDRA,
}


@dataclass(frozen=True)
class Release:
    """The seven published tables; stages map one Release to the next."""

    product_label: DataFrame
    product_adverse_effect: DataFrame
    product_to_rxnorm: DataFrame
    vocab_rxnorm_product: DataFrame
    vocab_rxnorm_ingredient: DataFrame
    vocab_rxnorm_ingredient_to_product: DataFrame
    vocab_meddra_adverse_effect: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def with_tables(self, **tables: DataFrame) -> "Release":
        return replace(self, **tables)

    def register(self) -> None:
        """Expose the tables to ``spark.sql``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
