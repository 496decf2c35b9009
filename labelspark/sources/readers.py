"""Readers with fixed schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.text import strip
from ..session import stage

LABEL_SCHEMAS = {"US": S.US_LABEL, "UK": S.UK_LABEL, "EU": S.EU_LABEL, "JP": S.JP_LABEL}


def read_labels(spark: SparkSession, path: str, region: str) -> DataFrame:
    return spark.read.schema(LABEL_SCHEMAS[region]).parquet(path)


def read_cols(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Only the named columns are read from the files."""
    return spark.read.parquet(path).select(*cols)


def read_rrf(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited atoms without header: 18 named columns, a trailing one dropped.

    Rows with missing fields are skipped. That is only noticed while every column is parsed,
    so column pruning is switched off for this reader.
    """
    layout = T.StructType([*S.ATOMS.fields, T.StructField("_x", T.StringType())])
    rows = (
        spark.read.schema(layout).option("sep", "|").option("quote", "")
        .option("mode", "DROPMALFORMED").option("columnPruning", False).csv(path)
    )
    return rows.drop("_x")


def _tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    return (
        spark.read.schema(schema).option("sep", "\t").option("header", header)
        .option("quote", "").option("enforceSchema", True).csv(path)
    )


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, S.CONCEPT, header=True)


def read_relationships(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, S.CONCEPT_RELATIONSHIP, header=True)


def read_kegg_ndc(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, S.KEGG_NDC, header=False)


def _piped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("sep", "|").option("header", True).csv(path)


def read_us_map(spark: SparkSession, path: str) -> DataFrame:
    return _piped(spark, path, S.US_ID_MAP)


def read_us_meta(spark: SparkSession, path: str) -> DataFrame:
    return _piped(spark, path, S.US_META)


def read_label_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """US label objects, one per file, sections as columns."""
    rows = spark.read.schema(S.US_LABEL_JSON).option("multiLine", multi_line).json(path)
    return rows.select("set_id", "label_id", "spl_version", "title", "sections.*")


def few_tasks(files: DataFrame) -> DataFrame:
    """A table read from many small files, in a few tasks for each core instead of one for every few files.

    Spark counts 4 MB for opening a file, so a task gets 4 to 32 files, and scheduling takes longer than reading. No row is moved.
    """
    return files.coalesce(4 * files.sparkSession.sparkContext.defaultParallelism)


def read_label_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """US labels of a folder of multi-line JSON files with the fields of their file names, and the files rejected.

    A file that is no JSON object is one rejected row (file_name, content), never a row of NULLs among the labels.
    Small files are packed into few tasks; each is parsed once, into a table that both results read. ``path``
    is a folder: a glob would be expanded to as many listing tasks as files.
    """
    layout = T.StructType([*S.US_LABEL_JSON.fields, T.StructField("_broken", T.StringType())])
    rows = stage(few_tasks(
        spark.read.schema(layout).option("multiLine", True).option("columnNameOfCorruptRecord", "_broken").json(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))), "label_files")
    good = with_path_fields(rows.where("_broken is null"), "file_name").select(
        "file_date", "file_set_id", "set_id", "label_id", "spl_version", "title", "sections.*")
    return good, rows.where("_broken is not null").select("file_name", F.col("_broken").alias("content"))


def read_label_meta(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Side-car facts of downloaded labels."""
    return spark.read.schema(S.LABEL_META).option("multiLine", multi_line).json(path)


def file_stem(column: str = "_metadata.file_name") -> Column:
    """File name up to its first dot."""
    return F.split_part(F.col(column), F.lit("."), F.lit(1))


def with_path_fields(df: DataFrame, name: str = "_metadata.file_name") -> DataFrame:
    """``date`` and ``set_id`` from file names ``date_setid.json``; no date without underscore."""
    stem = file_stem(name)
    split = F.instr(stem, "_")
    return df.select(
        "*",
        F.when(split > 0, F.substring(stem, F.lit(1), split - 1)).otherwise("").alias("file_date"),
        F.when(split > 0, F.substring(stem, split + 1, F.length(stem))).otherwise(stem).alias("file_set_id"),
    )


def join_text_with_meta(texts: DataFrame, meta: DataFrame, stem: str = "stem") -> DataFrame:
    """Texts (stripped, blank ones dropped) with the side-car facts of the same file stem."""
    full = texts.select(stem, strip("text").alias("text")).where("text != ''")
    return meta.join(full, stem).drop(stem)


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every file. The text reader copies its whole configuration for each file, so it only reads compressed ones."""
    packed = ("gz", "bz2", "zst", "lz4", "snappy", "deflate")
    name = F.col("_metadata.file_name")
    plain = spark.read.format("binaryFile").load(path).where(~F.split_part(name, F.lit("."), F.lit(-1)).isin(*packed))
    unpacked = spark.read.option("pathGlobFilter", "*.{%s}" % ",".join(packed)).text(path, wholetext=True)
    return plain.select(F.col("content").cast("string").alias("text"), F.struct(name.alias("file_name")).alias("_metadata")).unionByName(
        unpacked.select(F.col("value").alias("text"), F.struct(name.alias("file_name")).alias("_metadata")))


def read_text_with_meta(
    spark: SparkSession, text_glob: str, meta_glob: str, multi_line: bool = True
) -> DataFrame:
    """Whole text files joined with the JSON side-car of the same stem."""
    texts = few_tasks(read_whole_texts(spark, text_glob).select(file_stem().alias("stem"), "text"))
    meta = few_tasks(spark.read.schema(S.LABEL_META).option("multiLine", multi_line).json(meta_glob).select(
        "*", file_stem().alias("stem")
    ))
    return join_text_with_meta(texts, meta)


def read_annotations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested annotation records; every value of an event is read as text."""
    return spark.read.schema(S.ANNOTATION_FILE).option("multiLine", multi_line).json(path)


def read_tool_annotations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Documents of the annotation tool from a tree of folders."""
    return (
        spark.read.schema(S.TOOL_ANNOTATION).option("multiLine", multi_line)
        .option("recursiveFileLookup", True).json(path)
    )


def explode_tool_annotations(docs: DataFrame) -> DataFrame:
    """One row per annotation of a tool document."""
    by_section = docs.select(
        "annotator", "label_id", "status", F.explode("sections").alias("section", "_anns")
    )
    return by_section.select(
        "annotator", "label_id", "status", "section", F.explode("_anns").alias("_a")
    ).select("annotator", "label_id", "status", "section", "_a.*")


def label_manifest(df: DataFrame) -> DataFrame:
    """Human medicines of a regulator's product list as (name, code, page_url)."""
    return df.where(F.col("Category") == "Human").select(
        F.col("Name of medicine").alias("name"),
        F.col("EMA product number").alias("code"),
        F.col("Medicine URL").alias("page_url"),
    )


def load_release(spark: SparkSession, directory: str) -> S.Release:
    """The seven exported CSV tables with their types, also registered as views."""
    tables = {
        name: spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{directory}/{name}")
        for name, schema in S.RELEASE_SCHEMAS.items()
    }
    release = S.Release(**tables)
    release.register()
    return release
