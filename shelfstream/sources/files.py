"""Delimited and JSON-lines files, in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from shelfstream import schemas

CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", **options: str
) -> DataFrame:
    """A file with a header line whose names are ignored in favour of ``schema``'s. Spark's
    CSV options apply: files that double a quote inside quotes need ``escape='"'``."""
    reader = spark.read.options(**options)
    return reader.csv(path, schema=schema, sep=sep, header=True, enforceSchema=True)


def read_inferred(
    spark: SparkSession, path: str, sep: str = ",", text_columns: tuple[str, ...] = (),
    sampling: float = 1.0, **options: str,
) -> DataFrame:
    """A file with a header line and inferred types. Keys named in ``text_columns`` stay
    text: inference would turn a column of digits into numbers and lose leading zeros.
    Inference reads the ``sampling`` share of the rows once more; the rows read are all."""
    reader = spark.read.options(**options)
    inferred = reader.csv(
        path, sep=sep, header=True, inferSchema=True, samplingRatio=sampling
    )
    if not text_columns:
        return inferred
    fields = [
        T.StructField(f.name, T.StringType() if f.name in text_columns else f.dataType)
        for f in inferred.schema.fields
    ]
    return reader.csv(path, schema=T.StructType(fields), sep=sep, header=True)


def read_json_text(
    spark: SparkSession, path: str, schema: T.StructType = schemas.RICH_BOOK
) -> DataFrame:
    """JSON lines under an all-string schema: nested values stay JSON text."""
    return spark.read.schema(schema).json(path)


def read_triplets(spark: SparkSession, path: str) -> DataFrame:
    """Comma text to (user, item, rating); a line that does not fit keeps its text in
    ``_corrupt_record``."""
    schema = T.StructType(schemas.TRIPLET.fields + [T.StructField(CORRUPT, T.StringType())])
    return spark.read.csv(
        path, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )


def write_quoted(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header and every value quoted. One file means one writing task: for small
    exports only, the default keeps the partitions."""
    rows = df.repartition(1) if one_file else df
    rows.write.csv(path, header=True, quoteAll=True, escape='"')
