"""Instruction prompts from text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prompt template, in the order its parts are joined.
INSTRUCTION_PREFIX = (
    "Below is an instruction that describes a task, paired with an input that provides "
    "further context. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n"
)
INPUT_PREFIX = "\n\n### Input:\n"
RESPONSE_PREFIX = "\n\n### Response:\n"


def prompt_text(instruction: Column, context: Column, response: Column) -> Column:
    def filled(text: Column) -> Column:
        return F.coalesce(text, F.lit(""))

    return F.concat(
        F.lit(INSTRUCTION_PREFIX),
        filled(instruction),
        F.lit(INPUT_PREFIX),
        filled(context),
        F.lit(RESPONSE_PREFIX),
        filled(response),
    )


def prompt_format(examples: DataFrame, end_token: str) -> DataFrame:
    """Adds ``text``, the filled template closed by the tokenizer's end token."""
    text = prompt_text(F.col("instruction"), F.col("input"), F.col("output"))
    return examples.withColumn("text", F.concat(text, F.lit(end_token)))


def prompt_format_inference(examples: DataFrame) -> DataFrame:
    """Adds ``text``, the template left open after the response heading."""
    return examples.withColumn(
        "text", prompt_text(F.col("instruction"), F.col("input"), F.lit(""))
    )
