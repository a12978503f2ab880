"""The entry module works without the corpus operators, and does not hide their errors."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') or k == 'pipeline' for k in e.queries()))"


def copied(tmp_path, with_corpus):
    shutil.copytree(f"{ROOT}/annuity", tmp_path / "annuity", ignore=shutil.ignore_patterns(
        "__pycache__", *([] if with_corpus else ["llm"])))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if with_corpus:
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)


def run(tmp_path):
    return subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=120)


def test_entry_without_corpus_operators(tmp_path):
    copied(tmp_path, with_corpus=False)
    (tmp_path / "annuity" / "llm").mkdir()  # an empty folder may stay behind
    out = run(tmp_path)
    settled, sql, corpus = out.stdout.split()
    assert settled == sql and int(settled) >= 48 and corpus == "False", out.stderr


def test_errors_inside_corpus_operators_are_not_hidden(tmp_path):
    if not os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        return
    copied(tmp_path, with_corpus=True)
    with open(tmp_path / "annuity" / "llm" / "queries.py", "a") as f:
        f.write("\nimport a_dependency_that_is_missing\n")
    out = run(tmp_path)
    assert out.returncode and "a_dependency_that_is_missing" in out.stderr
