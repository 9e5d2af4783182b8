"""Image files to captions, captions to style prompts, and the jobs of an image generator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prompts import base_name, chat_prompt, output_name, style_prompt
from ..functions.text import completion_text
from ..operators.apply_model import Predict, apply_model
from ..operators.pairing import pair_by_key

BATCH_SIZE = 10  # fixed value: images per model call


def read_images(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """(path, image_name, content). Content is read only by a query that uses it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", base_name(F.col("path")).alias("image_name"), "content")


def caption_images(
    images: DataFrame, load: Callable[[], Predict], instruction: str, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """(image_name, generated_caption, prompt). The model gets prompt and content and returns its
    raw completion; the echoed prompt and special markers are taken off here."""
    asked = images.select("image_name", "content", chat_prompt(F.lit(instruction)).alias("prompt"))
    made = apply_model(
        asked, load, ["image_name", "prompt"], ["prompt", "content"], "completion STRING", batch_size
    )
    return made.select(
        "image_name", completion_text(F.col("completion"), F.col("prompt")).alias("generated_caption"), "prompt"
    )


def drawing_jobs(captions: DataFrame, folder: str, suffix: str = "_diff3.jpg") -> DataFrame:
    """Text-to-image jobs: (image_name, prompt, output) of each caption."""
    return captions.select(
        "image_name",
        style_prompt(F.col("generated_caption")).alias("prompt"),
        output_name(F.lit(folder), F.col("image_name"), suffix).alias("output"),
    )


def styling_jobs(
    images: DataFrame, captions: DataFrame, folder: str, suffix: str = "_styled.png"
) -> DataFrame:
    """Image-to-image jobs: each image with the prompt of its own caption, joined by name."""
    jobs = drawing_jobs(captions, folder, suffix)
    return pair_by_key(images.select("image_name", "path"), jobs, "image_name")
