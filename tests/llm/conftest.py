import os
from pathlib import Path

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")])

COLUMNS = "doc_id long, text string, kept boolean, n_words string, digest int"  # three names that operators use themselves


@pytest.fixture(scope="session", autouse=True)
def folder(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def words(a, n):
    return " ".join(f"w{(a * 7919 + i * i * 31 + i) % 4001}" for i in range(n))


ROWS = [
    (1, words(1, 80)),
    (2, words(1, 80)),  # an exact copy
    (3, words(1, 80) + " more"),  # a near copy
    (4, words(2, 30) + "\n" + words(3, 30) + "\n\t A common line of text \n" + words(2, 30)),  # repeats itself
    (5, " a COMMON line of TEXT\nshort\nshort"),
    (6, ""),
    (7, None),
    (8, "one two"),
    (9, words(4, 20_000)),  # very long
    (10, "x" * 50_000),  # one word
    (11, "é ß 漢字 <|endoftext|> it's  we'll　² aaaa"),
    (11, "é ß 漢字 <|endoftext|> it's  we'll　² aaaa"),  # a repeated row
    (None, words(5, 60)),
    (12, "A b, C d! " * 3 + words(6, 40)),
    (13, words(7, 25) + " " + words(6, 40)),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(*r, True, "x", 1) for r in ROWS], COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
