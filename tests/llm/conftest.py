import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
# Python workers of a session that an earlier test has started need the path as well.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))
os.environ["TOKENIZERS_PARALLELISM"] = "false"

DOC = "doc_id long, text string"


@pytest.fixture(scope="session")
def llm(spark):
    from histwise.llm.common import ready
    return ready(spark)


@pytest.fixture(scope="session")
def rows():
    """Rows of documents with every odd case: nulls, empty and long texts, repeated rows, ties."""
    line = "the same line\n"
    return [
        (1, None), (2, ""), (3, "a"), (4, " \t\n"), (5, "one two three four five"), (6, "one two three four five"),
        (6, "one two three four five"), (None, "no id here 12345"), (None, None), (7, "lang " * 30_000), (8, "x" * 50_000),
        (9, "<|endoftext|> a <|endoftext|>\n <|endoftext|>"), (10, "é日😀 \x85 a  b\r\n\tc "),
        *[(20 + i, f"{line}own {i}\n  THE SAME LINE\n\n") for i in range(12)],
        *[(40 + i, f"twin\nbody {i}") for i in range(9)],
    ]


@pytest.fixture(scope="session")
def docs(llm, rows):
    """The rows with further columns, whose names clash with those of the operators' results."""
    from pyspark.sql import functions as F
    df = llm.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit(0) for c in ("score", "component_id", "fp", "id", "key", "digest", "spans", "lang", "n_lines", "ids", "row", "t")})


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], DOC)
