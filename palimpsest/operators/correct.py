"""Correction requests to a language model, with an audit row for each line."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The prompt and its fields.
LEAD = (
    "You are correcting OCR output from a seventeenth-century Spanish printed source.\n"
    "Preserve all historical spellings, glyph variants, and orthographic conventions.\n"
    "Do NOT modernise spelling or punctuation.\n\n"
)
FIELD, ALTERNATIVES = "OCR output: ", "Alternative readings: "
TAIL = "Return only the corrected text, nothing else."
NONE, PENDING, MODEL = "(none)", "pending", "gpt-4o-mini"
AUDIT = "line_id string, input_text string, candidate_text string, decision string, decision_reason string, model string, prompt string"


class Client(Protocol):
    """Anything with this method that can be sent to the executors."""

    def complete(self, prompt: str) -> str: ...


class EchoClient:
    """Answers with the line's own text: the first line of the prompt that begins with the field."""

    def complete(self, prompt: str) -> str:
        found = re.search(f"^{FIELD}(.*)$", prompt, re.MULTILINE)
        return found[1] if found else ""


def prompt(text: Column, nbest: Column) -> Column:
    """The prompt for a line; readings after the first are listed as alternatives."""
    others = F.when(F.size(nbest) > 1, F.array_join(F.slice(nbest, F.lit(2), F.greatest(F.size(nbest) - 1, F.lit(0))), " | ")).otherwise(NONE)
    return F.concat(F.lit(LEAD + FIELD), text, F.lit("\n" + ALTERNATIVES), others, F.lit("\n\n" + TAIL))


def echoed(prompt_text: Column) -> Column:
    """What ``EchoClient`` answers, as a column."""
    return F.regexp_extract(prompt_text, f"(?m)^{FIELD}(.*)$", 1)


def request(lines: DataFrame, client: Client, model: str = MODEL) -> DataFrame:
    """Audit rows of ``(line_id, text, nbest)``, decision pending.

    The client is called where the rows are. Should it raise, the line's own
    text is the candidate, so one failure costs neither the row nor the job.
    """
    rows = lines.select(F.col("line_id").cast("string").alias("line_id"), "text", prompt(F.col("text"), F.col("nbest")).alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, prompts = (c.to_pylist() for c in b.columns)
            answers = []
            for text, p in zip(texts, prompts, strict=True):
                try:
                    answers.append(client.complete(p).strip())
                except Exception:  # noqa: BLE001  any failure of a client
                    answers.append(text)
            n = len(ids)
            cols = (ids, texts, answers, [PENDING] * n, [""] * n, [model] * n, prompts)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=[x.split(" ")[0] for x in AUDIT.split(", ")])

    return rows.mapInArrow(run, AUDIT)
