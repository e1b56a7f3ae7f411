"""Reference data: the category-name translation table (a small two-column CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from basketry.operators.quality import Gates
from basketry.sources.csv import read_raw

TRANSLATION_SCHEMA = StructType(
    [
        StructField("product_category_name", StringType()),
        StructField("product_category_name_english", StringType()),
    ]
)

TRANSLATION_GATES = Gates(
    not_null=("product_category_name", "product_category_name_english"),
    unique=(("product_category_name",),),
)


def read_translation(spark: SparkSession, path: str) -> DataFrame:
    """Read the translation CSV (UTF-8 BOM and CRLF line ends are accepted)."""
    return read_raw(spark, path, schema=TRANSLATION_SCHEMA)
