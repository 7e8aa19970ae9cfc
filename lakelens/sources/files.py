"""Image folders as DataFrames: one-shot scan (batch) and watched folder (stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions.paths import IMAGE_EXTENSIONS, file_name, is_image_name
from lakelens.schemas import IMAGE_FILE
from lakelens.session import file_system


def _glob_superset() -> str:
    # Case-insensitive superset of the accepted suffixes; the exact test runs after.
    return "*.[jJpPgGbBtTwW]*"


def image_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Files directly inside ``folder`` with an image suffix (no recursion).

    A missing folder gives an empty DataFrame with the file schema.  Order by
    ``path`` where the scan order matters (name order of the original batch scan).
    """
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], IMAGE_FILE)
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", _glob_superset())
             .option("recursiveFileLookup", "false")
             .load(folder))
    return files.filter(is_image_name(file_name(F.col("path"))))


def image_folder_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Watched folder: each new file is read once; the seen-file set lives in the query checkpoint.

    Files must be moved into the folder atomically (a file being copied can be read half-written).
    """
    reader = (spark.readStream.format("binaryFile").schema(IMAGE_FILE)
              .option("pathGlobFilter", _glob_superset())
              .option("recursiveFileLookup", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(folder).filter(is_image_name(file_name(F.col("path"))))


__all__ = ["image_folder", "image_folder_stream", "IMAGE_EXTENSIONS"]
