"""Change records to flat change rows.

A record is ``op``, ``before`` and ``after`` images and ``txn``; a flat row is the
business columns of the chosen image plus the metadata columns. Images are either structs
or, for encoded records, arrays of binary values in schema order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import wire
from tidemark.functions.buckets import with_bucket
from tidemark.names import COLLECTION_ORDER, DELETE, INSERT_OPS, META, OP, TOTAL_ORDER, TXN_ID, UPDATE


def image_column(op: Column, before: Column, after: Column) -> Column:
    """The image that carries the row: after, except before for deletes.

    An update without an after image falls back to before; unknown operations have none.
    """
    return (
        F.when(op.isin(*INSERT_OPS), after).when(op == UPDATE, F.coalesce(after, before)).when(op == DELETE, before)
    )


def select_image(records: DataFrame, name: str = "image") -> DataFrame:
    """Add the chosen image as a column, dropping records that have none."""
    chosen = image_column(F.col("op"), F.col("before"), F.col("after"))
    return records.withColumn(name, chosen).where(F.col(name).isNotNull())


def _metadata() -> list[Column]:
    return [
        F.col("op").alias(OP),
        F.col("txn.id").alias(TXN_ID),
        F.col("txn.total_order").cast("bigint").alias(TOTAL_ORDER),
        F.col("txn.collection_order").cast("bigint").alias(COLLECTION_ORDER),
    ]


def flatten_changes(
    records: DataFrame, keys: Sequence[str] = (), buckets: int = 0, bucket_fn: str = "xxhash64"
) -> DataFrame:
    """Struct-image records to flat rows, with ``_bucket`` when a bucket count is given.

    Metadata is NULL for records without a transaction.
    """
    flat = select_image(records).select("image.*", *_metadata())
    return with_bucket(flat, keys, buckets, bucket_fn) if buckets > 0 else flat


def decode_image(df: DataFrame, image: str, schema: T.StructType) -> DataFrame:
    """Replace an image column by the columns it encodes.

    Empty bytes are NULL for every type, and so are missing trailing values.
    """
    kept = [f for f in df.schema.fields if f.name != image]
    output = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + kept)
    return df.mapInArrow(wire.decoder(image, schema, output), output)


def encode_image(df: DataFrame, schema: T.StructType, name: str = "image") -> DataFrame:
    """Add the image of the columns of ``schema``; NULL becomes empty bytes."""
    output = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.BinaryType()))])
    return df.mapInArrow(wire.encoder(schema, output, name), output)


def decode_changes(
    records: DataFrame,
    schema: T.StructType,
    keys: Sequence[str] = (),
    buckets: int = 0,
    bucket_fn: str = "xxhash64",
) -> DataFrame:
    """Encoded records to flat rows."""
    flat = decode_image(select_image(records).select("image", *_metadata()), "image", schema)
    return with_bucket(flat, keys, buckets, bucket_fn) if buckets > 0 else flat


def business_columns(changes: DataFrame) -> DataFrame:
    """Drop the change-metadata columns."""
    return changes.drop(*META)
