"""The driver's entry works with and without the optional training-data folder."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

WITHOUT = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name == "millrace.llm" or name.startswith("millrace.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
queries, sql = entry.queries(), entry.oracle_sql()
assert len(queries) >= 115 and set(sql) <= set(queries)
assert not [q for q in queries if q.startswith("op") or q == "pipeline"]
"""


def test_entry_without_the_training_data_folder():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_every_other_import_error_is_raised():
    broken = WITHOUT.replace('name=name)', 'name="numpy")').split("import __spark_entry__")[0]
    code = broken + "\ntry:\n    import __spark_entry__\nexcept ImportError:\n    print('raised')\n"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "raised" in done.stdout, done.stderr
