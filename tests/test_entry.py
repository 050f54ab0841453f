"""The entry module without the corpus subpackage, or without what it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys, warnings
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r}:
            raise ModuleNotFoundError("hidden", name=name)
sys.meta_path.insert(0, Hide())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as e
    print(len(e.queries()), sorted(n for n in e.queries() if n.startswith("op")), set(e.oracle_sql()) <= set(e.queries()),
          sum("left out" in str(w.message) for w in said) > 0)
"""


@pytest.mark.parametrize("hidden, said", [
    ({"corpus_pipeline"}, "False"), ({"tillroll.llm"}, "False"), ({"pyarrow"}, "True")])
def test_other_queries_stay(hidden, said):
    from tillroll.plans.queries import all_queries
    if not os.path.isdir(os.path.join(ROOT, "tillroll", "llm")):
        said = "False"      # nothing is left out then
    out = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == f"{len(all_queries())} [] True {said}", out.stderr
