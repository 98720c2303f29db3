"""Sources: tables, file listings, image metadata, annotation JSON, report files."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.digests import tree_digest
from ..functions.text import let

# Suffixes of the files that are listed.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff")
JSON_SUFFIX = ".json"
PIXEL_BYTES = 1 << 20  # that are widened and hashed at once


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir``, which driver and executors share, and read it back.

    For tables that several steps read: plans of later steps start here, instead of repeating all
    before it, lost executors cost nothing, and the planner knows the size. Only a local session may
    leave the folder unset; it gets a temporary one.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir`` (see settle)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path, relative path, suffix, role (image or json), length, modificationTime of files
    under ``root``. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    role = F.when(suffix.isin(*IMAGE_SUFFIXES), "image").when(suffix == JSON_SUFFIX, "json")
    plain = root.rstrip("/").split("://")[-1]
    return files.select(
        "path",
        F.substring_index("path", plain + "/", -1).alias("relative"),
        suffix.alias("suffix"),
        role.alias("role"),
        "length",
        "modificationTime",
    ).where("role is not null")


def file_digests(spark: SparkSession, root: str) -> DataFrame:
    """path, relative path, length and sha256 of the bytes of every file under ``root`` that is not empty; the same at a source and
    at its sink tells whether a copy holds. Spark leaves empty files out of its listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    plain = root.rstrip("/").split("://")[-1]
    return files.select("path", F.substring_index("path", plain + "/", -1).alias("relative"), "length", F.sha2("content", 256).alias("sha256"))


def image_metadata(spark: SparkSession, root: str) -> DataFrame:
    """path, width, height, content_hash, corrupt. One-channel pixels are widened to three
    before hashing, so a grey and a colour file of the same picture are equal."""
    images = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)
    size = F.concat_ws("x", F.col("image.width").cast("string"), F.col("image.height").cast("string"))

    @F.pandas_udf("string")
    def pixel_digest(sizes: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        def one(size: str | None, n: int, pixels: bytes | None) -> str | None:
            if size is None or pixels is None:
                return None
            digest = hashlib.sha1(f"{size}|".encode())
            for k in range(0, len(pixels), PIXEL_BYTES):
                part = pixels[k : k + PIXEL_BYTES]
                digest.update(np.repeat(np.frombuffer(part, np.uint8), 3).tobytes() if n == 1 else part)
            return digest.hexdigest()

        return pd.Series([one(*x) for x in zip(sizes, channels, data, strict=True)], dtype=object)

    corrupt = F.col("image.width") < 0
    return images.select(
        F.col("image.origin").alias("path"),
        F.when(~corrupt, F.col("image.width")).alias("width"),
        F.when(~corrupt, F.col("image.height")).alias("height"),
        pixel_digest(F.when(~corrupt, size), F.coalesce("image.nChannels", F.lit(0)), "image.data").alias("content_hash"),
        corrupt.alias("corrupt"),
    )


def parse_json(text: Column | str) -> Column:
    """VARIANT of a JSON object, NULL for anything else; a leading byte order mark is dropped."""
    c = F.col(text) if isinstance(text, str) else text
    return let(F.try_parse_json(F.regexp_replace(c, "^﻿", "")), lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v))


def read_annotations(spark: SparkSession, root: str) -> DataFrame:
    """path and payload (VARIANT, NULL if the file is not a JSON object)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root)
    return files.select("path", parse_json(F.decode("content", "UTF-8")).alias("payload"))


def raw_group_counts(items: DataFrame) -> DataFrame:
    """Files per kind and group before any validation."""
    return items.groupBy("kind", "group_id").agg(F.count(F.lit(1)).alias("n_files"))


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def files_fingerprint(files: DataFrame, path: str = "relative", length: str = "length", digest: str = "sha256") -> DataFrame:
    """One row, ``fingerprint``: a digest over the lines path, size, digest (see tree_digest)."""
    line = F.concat_ws("\t", F.col(path), F.col(length).cast("string"), F.col(digest))
    return tree_digest(files, F.col(path), line, "fingerprint")


def items_of_manifest(manifest: DataFrame, schema: str) -> DataFrame:
    """Items rebuilt from the text columns of a stored manifest: those of ``schema``, cast back. A value
    that does not fit its type is an error; columns that ``schema`` does not name are left out."""
    wanted = manifest.sparkSession.createDataFrame([], schema).schema
    return manifest.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])
