import random

import pytest

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def prose():
    """Texts of two invented languages."""
    rng = random.Random(3)
    words = {"aa": ["the", "and", "thering", "onshe", "wherth", "sting", "of"],
             "bb": ["der", "und", "einschaft", "lich", "gekeit", "zupf", "das"]}

    def text(lang, n):
        return " ".join(rng.choice(words[lang]) + rng.choice(["", "", ",", "."]) for _ in range(n))
    return text


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls in every column, empty and long texts, repeated rows and ids, and
    extra columns whose names the operators use inside."""
    same = prose("aa", 60)
    rows = [(1, same, "aa", "s", 1), (1, same, "aa", "s", 1), (2, same + " more", "aa", "s", 1),
            (3, None, None, None, None), (4, "", "aa", None, 0), (None, same, "aa", "s", 1),
            (5, " \t\n ", "bb", "s", 1), (6, "one two", None, "t", 7), (7, "1 2 3 4", "bb", "t", 7),
            (8, prose("bb", 30000), "bb", "u", 1), (9, "x" * 50000, "aa", "u", 1),
            (2, prose("bb", 40), "bb", "s", 1), (10, "é\U0001f600 <|endoftext|> ▁ a\x0bb", "bb", "v", 1)]
    rows += [(20 + i, prose("aa" if i % 2 else "bb", 30 + i), "aa" if i % 2 else "bb", f"s{i % 4}", i)
             for i in range(40)]
    df = spark.createDataFrame(rows, DDL)
    for name in ("score", "size", "n", "class", "h", "row", "t", "words", "component", "held_out", "bucket"):
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)
