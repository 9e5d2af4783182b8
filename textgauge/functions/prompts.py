"""Prompts and output names, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tags of the chat format.
USER_TAG = "<|user|>"
IMAGE_TAG = "<|image_1|>"
END_TAG = "<|end|>"
ASSISTANT_TAG = "<|assistant|>"
# The instructions and texts put around captions and questions.
CAPTION_INSTRUCTION = "Caption the image in one sentence."
STYLE_PREFIX = "Peanuts comic style illustration of:\n\n"
GROUNDING_TEXT = (
    "Use the given context to answer the question. "
    "If you don't know the answer, say you don't know. "
    "Use three sentences maximum and keep the answer concise. "
    "Context: {context}"
)


def chat_prompt(instruction: Column, with_image: bool = True) -> Column:
    """Role tags and, if wanted, the image tag around an instruction."""
    opening = USER_TAG + (IMAGE_TAG if with_image else "")
    return F.concat(F.lit(opening), instruction, F.lit(END_TAG + ASSISTANT_TAG))


def style_prompt(caption: Column) -> Column:
    return F.concat(F.lit(STYLE_PREFIX), caption)


def grounded_prompt(context: Column, question: Column) -> Column:
    """The system text filled with the context, then the question."""
    before, after = GROUNDING_TEXT.split("{context}")
    return F.concat(
        F.lit("System: " + before), context, F.lit(after + "\nHuman: "), question
    )


def url_path(url: Column) -> Column:
    """A URL without its query and fragment."""
    return F.regexp_replace(url, r"[?#].*$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem_name(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def output_name(folder: Column, path: Column, suffix: str, hidden: bool = False) -> Column:
    """`folder/name-without-extension` + suffix, for a result made from the file at `path`.

    With `hidden`, dots at the start of a name open no extension, so `.jpg` keeps its name.
    """
    name = base_name(path)
    stem = F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "") if hidden else stem_name(name)
    return F.concat(folder, F.lit("/"), stem, F.lit(suffix))


def numbered_name(number: Column, extension: str = ".jpg") -> Column:
    """000001.jpg and so on; numbers with more digits keep all of them."""
    return F.format_string("%06d" + extension, number)
