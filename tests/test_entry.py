"""The entry module works without the training-data operators and without the packages that only they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["veilpost.llm", "corpus_pipeline", "zstandard", "public_tokenizers"])
def test_queries_without(missing):
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + '.'):
            raise ModuleNotFoundError('gone', name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = set(entry.queries())
assert 'screen_mail' in names and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in names)
assert set(entry.oracle_sql()) <= names
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_a_missing_module_of_the_library_is_an_error():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == 'veilpost.operators.tfidf':
            raise ModuleNotFoundError('gone', name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=120).returncode != 0
