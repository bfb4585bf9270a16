import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from stepforge.session import local_session  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, n_tokens long, copies int"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, partitions=4)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    base = " ".join(f"word{i % 97} and Text{i % 13}" for i in range(400))
    long = " ".join(f"w{i * i % 7919}" for i in range(60_000))
    texts = [(1, base), (2, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None), (7, long),
             (8, "one"), (9, "one two"), (10, "a line here\nanother line of some words\n\n" + base), (11, "another line of some words\nlast"),
             (12, "<|endoftext|> x  y 中文 café"), (13, "x" * 5000), (14, "one")]
    rows = [(i, t, None if k % 3 else "en", None if k % 5 == 0 else f"s{k % 2}", None, 7, None, None, 3) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)
