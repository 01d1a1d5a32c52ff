from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def plain(tokenizer_path):
    """Ids of one text by one plain call of the library."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


#: Texts with the cases every operator has to take.
TEXTS = [
    None,
    "",
    "   \n\t ",
    "The quick brown fox, the lazy dog. It's 3.14% of 1,000!",
    "The quick brown fox, the lazy dog. It's 3.14% of 1,000!",
    "Éric's naïve café… œuvre ÿÿ ÀÉÎ ß ½ 42nd éä İstanbul ΟΔΟΣ",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>",
    "x\x1cy\x1dz\x85w\xa0v u　t​s",
    "你好 世界 こんにちは 안녕 😀😀 👩‍👩‍👧",
    "nospace" * 3000,
    "",
    "12345 67890 ... ,,, --- ''' \"",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, repeated rows, empty and long texts, columns named like results."""
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 else "src", i) for i, t in enumerate(TEXTS)]
    rows += [(None, "no key", "en", "src", 1), (3, TEXTS[3], "en", "src", 3), (3, TEXTS[3], "en", "src", 3), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens long").withColumn("key", F_lit("clash")).withColumn("row", F_lit(7)).withColumn("score", F_lit("s"))


def F_lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)


@pytest.fixture()
def table(spark, tmp_path):
    """Writes a DataFrame as a table of its own and reads it back."""
    counter = iter(range(10_000))

    def write(df, name="documents"):
        path = str(tmp_path / f"t{next(counter)}" / f"{name}.parquet")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write
