"""Article tables: tab-separated files, entity columns and the driver's documents."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_COLUMNS = [
    "id",
    "category",
    "subcategory",
    "title",
    "abstract",
    "url",
    "title_entities",
    "abstract_entities",
]
ARTICLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS])

ENTITY_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("Label", T.StringType()),
            T.StructField("Type", T.StringType()),
            T.StructField("WikidataId", T.StringType()),
            T.StructField("Confidence", T.DoubleType()),
            T.StructField("OccurrenceOffsets", T.ArrayType(T.IntegerType())),
            T.StructField("SurfaceForms", T.ArrayType(T.StringType())),
        ]
    )
)

# The strings that pandas reads as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_if_na(col: Column) -> Column:
    return F.when(~col.isin(NA_TOKENS), col)


def _tsv_options(multi_line: bool) -> dict:
    return {"sep": "\t", "quote": '"', "escape": '"', "multiLine": multi_line, "mode": "FAILFAST"}


def nullify(df: DataFrame) -> DataFrame:
    """Missing-value strings become NULL in every string column."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[null_if_na(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])


def read_articles(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """Headerless tab-separated articles with a fixed schema; a row of other width stops the job.

    ``multi_line`` honours line breaks inside quotes, which makes every file one split: for
    large inputs write many files, or read once and keep the table as Parquet.
    """
    return nullify(spark.read.schema(ARTICLE_SCHEMA).options(**_tsv_options(multi_line)).csv(path))


def stream_articles(
    spark: SparkSession, path: str, multi_line: bool = True, max_files: int | None = None
) -> DataFrame:
    """The same table as a file stream; new files in ``path`` are picked up once each."""
    reader = spark.readStream.schema(ARTICLE_SCHEMA).options(**_tsv_options(multi_line))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return nullify(reader.csv(path))


def write_articles(df: DataFrame, path: str) -> None:
    """Write articles in the layout that ``read_articles`` reads."""
    (
        df.select(*[F.col(c).cast("string").alias(c) for c in ARTICLE_COLUMNS])
        .write.options(sep="\t", quote='"', escape='"', emptyValue="")
        .csv(path)
    )


# The two splits and two sizes that a data folder may hold.
SPLITS = ["train", "validation"]
SIZES = ["small", "large"]
# Folders of the two splits where no size is named.
PLAIN_FOLDERS = ["train", "test"]


def split_path(root: str, split: str, use_small: bool = True) -> str:
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}, expected one of {SPLITS}")
    return f"{root.rstrip('/')}/{split}_{SIZES[0] if use_small else SIZES[1]}/news.tsv"


def load_splits(
    spark: SparkSession, root: str, use_small: bool = True, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Train and validation tables of the chosen size.

    A folder that was unpacked for one size only may hold them as ``train`` and ``test``.
    """
    frames = []
    for split, plain in zip(SPLITS, PLAIN_FOLDERS, strict=True):
        paths = [split_path(root, split, use_small), f"{root.rstrip('/')}/{plain}/news.tsv"]
        for path in paths:
            try:
                frames.append(read_articles(spark, path, multi_line))
                break
            except AnalysisException:
                continue
        else:
            raise FileNotFoundError(f"no {split} articles at {' or '.join(paths)}")
    return frames[0], frames[1]


def entity_rows(articles: DataFrame, column: str = "title_entities") -> DataFrame:
    """One row per entity; articles without entities keep one row of NULLs."""
    entity = F.explode_outer(F.from_json(F.col(column), ENTITY_SCHEMA)).alias("entity")
    return articles.select("id", entity).select(
        "id",
        F.col("entity.Label").alias("label"),
        F.col("entity.Type").alias("type"),
        F.col("entity.WikidataId").alias("wikidata_id"),
        F.col("entity.Confidence").alias("confidence"),
        F.col("entity.OccurrenceOffsets").alias("occurrence_offsets"),
        F.col("entity.SurfaceForms").alias("surface_forms"),
    )


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """The driver's ``documents`` in the article schema: first line as title, rest as abstract."""
    text = F.col("text")
    cut = F.instr(text, "\n")
    return documents.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("category"),
        F.col("source").alias("subcategory"),
        null_if_na(F.substring_index(text, "\n", 1)).alias("title"),
        null_if_na(F.when(cut > 0, F.substr(text, cut + 1))).alias("abstract"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("title_entities"),
        F.lit(None).cast("string").alias("abstract_entities"),
    )
