"""The driver's entry loads without the subpackage for corpora, its pipeline or its libraries."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = """
import sys
{before}
import __spark_entry__ as entry
names = entry.queries()
assert set(entry.oracle_sql()) <= set(names)
print(sum(not n.startswith("op") and n != "pipeline" for n in names), sum(n.startswith("op") for n in names), "pipeline" in names)
"""
HIDE = "sys.modules['public_tokenizers'] = None"


def _counts(root, before=""):
    told = subprocess.run([sys.executable, "-c", NAMES.format(before=before)], cwd=root, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert told.returncode == 0, told.stderr
    core, numbered, pipeline = told.stdout.split()
    return int(core), int(numbered), pipeline == "True"


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    def make(*without):
        root = tmp_path_factory.mktemp("copy") / "repo"
        shutil.copytree(ROOT, root, ignore=lambda at, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(at, n), ROOT) in without])
        return root

    return make


def test_core_queries_load_without_the_corpus_folders(copy):
    everything = _counts(ROOT)
    without = ("newsflow/llm", "tests/llm")
    # With the pipeline file still there, and with it gone as well.
    assert _counts(copy(*without)) == (everything[0], 0, False)
    assert _counts(copy(*without, "corpus_pipeline.py")) == (everything[0], 0, False)


def test_only_the_pipeline_goes_with_its_library(copy):
    core, numbered, _ = _counts(ROOT)
    assert _counts(ROOT, HIDE) == (core, numbered, False)
