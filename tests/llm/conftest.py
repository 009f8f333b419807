import random

import pytest
from pyspark.sql import types as T


def words(r: random.Random, n: int) -> str:
    return " ".join(r.choice(["alpha", "beta", "Gamma", "delta", "épsilon", "zeta!", "eta", "Theta", "iota", "kappa", "漢字", "mu", "nu#"]) + str(r.randint(0, 60)) for _ in range(n))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, licence lines, junk, and every odd case: nulls, empties, blanks, ties, a long text."""
    r = random.Random(5)
    shared = words(r, 60)
    texts = [words(r, r.randint(5, 200)) for _ in range(24)]
    base = words(r, 200)
    texts += [base, base, base + " tail", base.replace("mu", "mv", 1), " ".join(base.split(" ")[:150])]
    texts += [words(r, 30) + "\n" + shared + "\n" + words(r, 30) for _ in range(4)]
    texts += [shared, "line one is here\n" * 30, "x" * 900, "x" * 500 + "y" + "x" * 500, "ab" * 400, words(r, 8000)]
    texts += ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0. See the GNU General Public License", "cc-by CC BY cc", words(r, 60) + "\nReleased under the MIT License."]
    texts += [" ".join(w + "%%%" for w in words(r, 80).split()), "", " \n\t ", None, None, "one", "one two", "ONE TWO", "a b c d e", "don't  stop\n\n now  <|endoftext|> 12 34"]
    rows = [(i, t, r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s3", None])) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[0], "en", "s1"), (None, None, None, None), (7, texts[8] + " other", "en", "s2")]
    r.shuffle(rows)
    return rows


SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    # columns that clash with names the operators use inside or give out
    ("kept", T.StringType()), ("n_words", T.IntegerType()), ("tk", T.BinaryType()), ("node", T.StringType()), ("h", T.DoubleType()), ("n", T.StringType()), ("size", T.StringType()), ("key", T.LongType()),
)])


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame([(*r, "x", 1, b"1", "n", 1.0, "n", "s", 1) for r in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
