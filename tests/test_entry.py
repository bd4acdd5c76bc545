"""The driver's entry points work without the training-data subpackage."""
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from blotter import catalog
from tests.conftest import ROOT


def test_library_queries_are_listed():
    assert set(catalog.REGISTRY) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_training_data_subpackage(tmp_path, with_pipeline):
    shutil.copytree(os.path.join(ROOT, "blotter"), tmp_path / "blotter", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if with_pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    code = "import __spark_entry__ as e; from blotter import catalog; assert set(e.queries()) == set(catalog.REGISTRY); e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path), *[p for p in sys.path if p and p != ROOT]])}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True)
