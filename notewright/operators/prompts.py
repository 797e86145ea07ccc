"""Prompts of notes, and their size under several tokenizers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.functions.fields import RecordSchema
from notewright.functions.text import line_count
from notewright.operators.generate import chat_prompt


def prompt_variants(
    notes: DataFrame, schema: RecordSchema, counters: dict[str, Callable[[Column], Column]],
    layouts: dict[str, Callable] | None = None,
) -> DataFrame:
    """One row per note and tokenizer: the size of the prompt as that tokenizer lays it out and counts it.

    The tokenizers are a list the caller writes down, so each note simply becomes that many rows.
    """
    layouts = layouts or {}
    used = {name: layouts.get(name) for name in counters}
    kinds = list(dict.fromkeys(used.values()))
    prompts = {
        f"_prompt{at}": chat_prompt(F.col("note"), schema, kind) for at, kind in enumerate(kinds)
    }
    sizes = {}
    for name in prompts:
        sizes[f"{name}_chars"] = F.length(name).cast("bigint")
        sizes[f"{name}_lines"] = line_count(F.col(name)).cast("bigint")
    sized = []
    for name, count in counters.items():
        prompt = f"_prompt{kinds.index(used[name])}"
        sized.append(
            F.struct(
                F.lit(name).alias("tokenizer"),
                F.col(f"{prompt}_chars").alias("n_chars"),
                F.col(f"{prompt}_lines").alias("n_lines"),
                count(F.col(prompt)).cast("bigint").alias("n_tokens"),
            )
        )
    full = notes.select("ord", "note").withColumns(prompts).withColumns(sizes)
    return full.select("ord", F.inline(F.array(*sized)))
