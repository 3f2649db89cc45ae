"""Queries of this kind next to their SQL, and the entry points without them."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from oracle_check import differences, duck

from starloom.llm.oracles import ORACLES
from starloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLES[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_this_package():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.path.insert(0, '.')\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'starloom.llm' or name.startswith('starloom.llm.'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 80 and not [q for q in e.queries() if q.startswith('op') and q[2].isdigit()]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
