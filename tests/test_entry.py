"""The entry points, with the operators of training data and without them."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"


@pytest.mark.parametrize("without", [["tidemark/llm"], ["tidemark/llm", "corpus_pipeline.py"]])
def test_the_rest_is_whole_without_the_subpackage(tmp_path, without):
    from crosscheck.oracles import ORACLES
    from crosscheck.queries import QUERIES

    copy = tmp_path / "copy"
    left_out = {os.path.join(REPO, p) for p in [*without, "tests", ".git"]}

    def ignore(folder, names):
        return [n for n in names if os.path.join(folder, n) in left_out or n == "__pycache__"]

    shutil.copytree(REPO, copy, ignore=ignore)
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"]


def test_every_statement_has_its_query():
    sys.path.insert(0, REPO)
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
