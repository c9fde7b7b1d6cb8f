"""Compact dump for mobile apps: seven columns of the food dataset as gzipped TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.facets import main_text
from larder.sources.files import require_path, write_tsv


def mobile_columns(products: DataFrame, names_as_json: bool = False) -> DataFrame:
    """Project and rename.  A language-list name becomes its main text, or JSON."""
    name = F.col("product_name")
    if isinstance(products.schema["product_name"].dataType, T.ArrayType):
        name = F.to_json("product_name") if names_as_json else F.expr(main_text("product_name"))
    return products.select(
        "code",
        name.alias("product_name"),
        "quantity",
        "brands",
        F.col("nutriscore_grade").alias("nutrition_grade_fr"),
        "nova_group",
        "environmental_score_grade",
    )


def export_mobile(spark: SparkSession, source: str, target: str, names_as_json: bool = False) -> None:
    require_path(spark, source)
    write_tsv(mobile_columns(spark.read.parquet(source), names_as_json), target)
