"""Page texts, settings and run information."""

from __future__ import annotations

import os
import platform
from collections.abc import Mapping
from dataclasses import dataclass, fields

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import strip


def page_texts(lines: DataFrame, page: str = "page", order: str = "line_id") -> DataFrame:
    """``(page, text, confidence, n_lines)``: texts of a page's lines in order, joined by a space; confidence is the mean of the lines'."""
    rows = lines.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(order, "text"))).alias("s"), F.coalesce(F.avg("sequence_confidence"), F.lit(0.0)).alias("confidence"))
    return rows.select(page, strip(F.array_join(F.transform("s", lambda x: x["text"]), " ")).alias("text"), "confidence", F.size("s").cast("long").alias("n_lines"))


PREFIX = "PALIMPSEST_"


@dataclass(frozen=True)
class Settings:
    """Defaults of all stages; a variable ``PALIMPSEST_<NAME>`` of the environment overrides one."""

    dpi: int = 300
    beam_width: int = 10
    threshold: float = 0.7
    max_length_ratio: float = 2.0
    rare_char_min_freq: int = 5
    top_confusions: int = 20

    @classmethod
    def from_environment(cls, environment: Mapping[str, str] = os.environ) -> Settings:
        """A value that isn't a number of the field's kind is an error that names the variable."""
        given = {}
        for f in fields(cls):
            raw = environment.get(PREFIX + f.name.upper())
            if raw is None:
                continue
            try:
                given[f.name] = type(f.default)(raw)
            except ValueError:
                raise ValueError(f"{PREFIX}{f.name.upper()} is {raw!r}, not a number") from None
        return cls(**given)


def runtime(spark: SparkSession) -> DataFrame:
    row = (pyspark.__version__, platform.python_version(), platform.platform(), spark.sparkContext.master)
    return spark.createDataFrame([row], "spark string, python string, os string, master string")
