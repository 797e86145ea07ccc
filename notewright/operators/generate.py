"""Batch text generation with a generator that the user supplies, and the two optional text hooks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.functions.fields import RecordSchema
from notewright.functions.prompts import plain_prompt, system_prompt, user_prompt

BATCH_SIZE = 32

# What one prompt of a batch came back with. ``head`` is 1 on the first prompt of each batch, so its
# sum is the number of batches; ``gen_ms`` is the prompt's share of the time its batch took.
CALL = "struct<text: string, tokens: bigint, gen_ms: double, head: int>"


def with_replies(
    df: DataFrame, make_generator: Callable, prompt: str = "prompt", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Add ``call``: the generator's answer to each prompt.

    ``make_generator()`` is called once per partition and returns a function from a list of prompts to a
    list of answers in the same order; an answer is a text, or a pair of text and its token count. It is
    called with ``batch_size`` prompts at a time, across Arrow batches, and once with the rest. Only the
    prompt column travels to Python.
    """

    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import time

        generate = make_generator()

        def run(prompts: list) -> list:
            begin = time.perf_counter()
            answers = list(generate(prompts))
            share = (time.perf_counter() - begin) * 1000.0 / len(prompts)
            if len(answers) != len(prompts):
                raise ValueError(f"{len(answers)} answers for {len(prompts)} prompts")
            rows = []
            for at, reply in enumerate(answers):
                text, tokens = reply if isinstance(reply, tuple) else (reply, None)
                rows.append((text, tokens, share, int(at == 0)))
            return rows

        def frame(rows: list) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["text", "tokens", "gen_ms", "head"])
            return out.astype({"tokens": "Int64", "gen_ms": "float64", "head": "int32"})

        waiting: list = []
        for series in batches:
            waiting.extend(series.tolist())
            whole = len(waiting) - len(waiting) % batch_size
            done = []
            for start in range(0, whole, batch_size):
                done.extend(run(waiting[start:start + batch_size]))
            waiting = waiting[whole:]
            yield frame(done)
        if waiting:
            yield frame(run(waiting))

    # The answer must not be computed twice for one prompt, not even where two columns read it.
    call = F.pandas_udf(answer, CALL).asNondeterministic()
    return df.withColumn("call", call(F.col(prompt)))


def chat_prompt(
    note: Column, schema: RecordSchema, make_layout: Callable | None = None, extra: dict | None = None
) -> Column:
    """The prompt of a note: plain, or laid out by a model's own chat template.

    ``make_layout()`` is called once per partition and returns a function from ``(system, user)`` to the
    prompt. ``extra`` are further named arguments for it; a layout that does not know them is called again
    without. Where it raises, for one note or at all, the plain layout is used.
    """
    plain = plain_prompt(note, schema)
    if make_layout is None:
        return plain
    system = system_prompt(schema)

    def lay_out(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            layout = make_layout()
        except Exception:  # noqa: BLE001  a model without a template is no error
            layout = None

        def call(user: str) -> str:
            try:
                return layout(system, user, **(extra or {}))
            except TypeError:
                if not extra:
                    raise
                return layout(system, user)

        def one(user: str) -> str | None:
            try:
                return call(user) if layout else None
            except Exception:  # noqa: BLE001
                return None

        for users in batches:
            yield users.map(one)

    return F.coalesce(F.pandas_udf(lay_out, "string")(user_prompt(note, schema)), plain)


def token_counter(make_encode: Callable | None = None) -> Callable[[Column], Column]:
    """A function that counts the tokens of a text column: 0 where the tokenizer is missing or fails.

    Without ``make_encode`` it counts white-space separated words, which is only a rough stand-in.
    """
    if make_encode is None:
        from notewright.functions.text import word_count

        return lambda text: F.coalesce(word_count(text), F.lit(0)).cast("bigint")

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            encode = make_encode()
        except Exception:  # noqa: BLE001
            encode = None

        def one(text: str | None) -> int:
            try:
                return len(encode(text))
            except Exception:  # noqa: BLE001
                return 0

        for texts in batches:
            yield texts.map(one).astype("int64")

    return F.pandas_udf(count, "bigint")
