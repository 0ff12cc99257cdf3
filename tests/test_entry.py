"""The entry keeps the core queries where the corpus operators cannot be imported."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])


def test_core_queries_without_the_corpus_operators():
    code = ("import sys; sys.modules['public_tokenizers'] = None; sys.modules['histwise.llm'] = None\n"
            "import __spark_entry__ as E\n"
            "assert not E.LLM and len(E.queries()) >= 36 and set(E.oracle_sql()) <= set(E.queries())\n"
            "assert not [k for k in E.queries() if k == 'pipeline' or k.startswith('op')]")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_core_queries_without_a_package_of_theirs():
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as E\n"
            "assert not E.LLM and len(E.queries()) >= 36")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
