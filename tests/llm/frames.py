"""Small documents with the awkward cases: null and empty texts, null columns, repeated rows, long texts, other columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label string"
_SYLLABLES = {"en": ["th", "er", "an", "ing", "ou", "re"], "fr": ["eau", "é", "que", "ai", "è", "ment"]}


def sentence(draw: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(draw.choices(_SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(n)) + "."


def rows(n: int = 40) -> list[tuple]:
    draw = random.Random(5)
    found = []
    for i in range(n):
        lang = "en" if i % 2 else "fr"
        text = "\n".join(sentence(draw, lang, draw.randint(5, 40)) for _ in range(draw.randint(1, 4)))
        found.append((i, text, lang, f"src{i % 3}", len(text), 0.5, "x"))
    found.append((n, None, None, None, None, None, None))
    found.append((n + 1, "", "en", "src0", 0, None, "x"))
    found.append((n + 2, found[3][1], "en", "src1", None, None, None))  # an exact copy
    found.append(found[4])  # a repeated row
    found.append((n + 3, " \t\n 12 !! ", None, "src9", 9, None, None))
    found.append((n + 4, " ".join(sentence(draw, "en", 30) for _ in range(300)), "en", "src0", None, None, None))
    found.append((None, "a row without id", "en", None, None, None, None))
    return found


def documents(spark: SparkSession, data: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
