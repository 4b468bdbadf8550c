"""Rows that the operators' tests share."""

import random

import pytest
from pyspark.sql import types as T

#: Extra columns named like columns that operators make or use inside.
CLASH = ["score", "lang_pred", "ids", "decoded", "row", "size", "norm", "digest", "keep_id", "key", "root", "node", "c0", "p_copies", "_fa_bits", "component_id", "a.b"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASH]
)
WORDS = {
    "en": "the of and that with from which their there would about these other water people through".split(),
    "de": "der die und nicht mit sich auf eine werden durch über können müssen schön straße zwischen".split(),
}


def prose(lang: str, n: int, seed: int) -> str:
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(WORDS[lang]) + ("." if r.random() < 0.1 else "") for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    rows = []
    for k in range(40):
        lang = "en" if k % 2 else "de"
        rows.append((k, prose(lang, 60 + k, k), lang, f"s{k % 3}"))
    rows += [(100, prose("en", 61, 1), "en", "s1"), (101, prose("en", 61, 1).upper(), "en", None)]  # copies of 1
    rows += [(102, prose("en", 61, 1) + " end", "en", "s0"), (103, prose("de", 400, 7), None, "s0"), (104, prose("de", 400, 7) + " ab cd", "de", "s0")]
    rows += [(110, None, "en", "s0"), (111, "", "en", "s0"), (112, " \n\t ", None, None), (113, "12 34 !", "en", "s1"), (None, "no id here at all", "en", "s1"), (None, None, None, None)]
    rows += [(120, prose("en", 30_000, 5), "en", "s2"), (121, "x" * 200_000, "en", "s2"), (122, "a", "en", "s2"), (123, "é🙂 ñ", "de", "s2")]
    rows += [rows[3], rows[3]]  # a repeated row
    return [(*r, None if r[1] is None else len(r[1]), *["x"] * (len(CLASH) - 1), None) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
