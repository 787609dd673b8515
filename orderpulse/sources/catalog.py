"""Named tables read from CSV or Parquet files with declared types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderpulse.functions import expressions as ex

# Column names and types of the nine raw tables.
RAW_TABLES: dict[str, str] = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "reviews": """review_id string, order_id string, review_score int,
        review_comment_title string, review_comment_message string,
        review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz""",
    "items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price double, freight_value double""",
    "payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "customers": """customer_id string, customer_unique_id string,
        customer_zip_code_prefix string, customer_city string, customer_state string""",
    "products": """product_id string, product_category_name string,
        product_name_lenght double, product_description_lenght double,
        product_photos_qty double, product_weight_g double, product_length_cm double,
        product_height_cm double, product_width_cm double""",
    "sellers": """seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string""",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double,
        geolocation_lng double, geolocation_city string, geolocation_state string""",
    "translation": "product_category_name string, product_category_name_english string",
}


# Tables whose quoted text may span lines.  Such files cannot be split between
# tasks, so the other tables are read line by line.
MULTILINE_TABLES = ("reviews",)


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """Read a CSV with a header.

    With a schema, columns are matched to the header by name and cast
    leniently: text that is not a number or date becomes missing.  Columns the
    schema does not name stay text, columns the file lacks are left out.
    Set ``multiline`` when quoted fields span lines.
    """
    text = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("inferSchema", False)
        .csv(path)
    )
    if schema is None:
        return text
    types = {f.name: f.dataType for f in _struct(schema).fields}
    return text.select(
        *[
            F.col(c) if isinstance(types.get(c, T.StringType()), T.StringType)
            else F.col(c).try_cast(types[c]).alias(c)
            for c in text.columns
        ]
    )


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: str | T.StructType | None = None,
    required: bool = True,
    multiline: bool = False,
) -> DataFrame | None:
    """One table; a missing path raises when required and gives None otherwise."""
    try:
        if fmt == "csv":
            return read_csv(spark, path, schema, multiline)
        return spark.read.format(fmt).load(path)
    except AnalysisException as err:
        if required or "PATH_NOT_FOUND" not in str(err):
            raise
        return None


def load_catalog(
    spark: SparkSession,
    folder: str,
    tables: Mapping[str, str | T.StructType | None] | Iterable[str] = RAW_TABLES,
    fmt: str = "csv",
    files: Mapping[str, str] | None = None,
    required: bool = True,
    views: bool = False,
    multiline: Iterable[str] = MULTILINE_TABLES,
) -> dict[str, DataFrame]:
    """Every named table found under a folder, optionally as temp views too."""
    schemas = tables if isinstance(tables, Mapping) else {name: None for name in tables}
    names = files or {}
    found: dict[str, DataFrame] = {}
    for name, schema in schemas.items():
        path = f"{folder.rstrip('/')}/{names.get(name, f'{name}.{fmt}')}"
        table = read_table(spark, path, fmt, schema, required, name in multiline)
        if table is not None:
            found[name] = table
            if views:
                table.createOrReplaceTempView(name)
    return found


def coerce_types(
    df: DataFrame,
    dates: Iterable[str] = (),
    numbers: Iterable[str] = (),
    whole: Iterable[str] = (),
    text: Iterable[str] = (),
) -> DataFrame:
    """Lenient casts by column list; names the frame lacks are skipped."""
    changes = {c: ex.try_timestamp(F.col(c)) for c in dates if c in df.columns}
    changes |= {c: ex.try_number(F.col(c)) for c in numbers if c in df.columns}
    changes |= {c: ex.whole_or_zero(F.col(c)) for c in whole if c in df.columns}
    changes |= {c: F.col(c).cast("string") for c in text if c in df.columns}
    return df.withColumns(changes) if changes else df
