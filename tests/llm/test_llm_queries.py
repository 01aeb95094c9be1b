"""Queries of this package against their SQL; the package stands alone."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import difference, duck

from themelake.llm.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_names():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))


def test_nothing_else_imports_it():
    for path in (ROOT / "themelake").rglob("*.py"):
        if "llm" not in path.parts:
            assert ".llm" not in path.read_text() and "import llm" not in path.read_text(), path


def test_entry_works_without_it():
    code = (
        "import sys; sys.modules['themelake.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'themelake.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "for n in ('themelake.llm', 'corpus_pipeline'): del sys.modules[n]\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [n for n in e.queries() if n.startswith('op') and n[2].isdigit() or n == 'pipeline']"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
