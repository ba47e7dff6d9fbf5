"""The entry module works where the optional subpackage is not installed."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.split(".")[:2] == ["immolens", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
assert "price_evolution" in e.queries() and "pipeline" not in e.queries()
assert not [q for q in e.queries() if q.startswith("op")]
assert set(e.oracle_sql()) == set(e.queries())
"""


def test_entry_without_the_optional_subpackage():
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=REPO, check=True)


def test_no_other_module_imports_the_optional_subpackage():
    for folder, _, names in os.walk(os.path.join(REPO, "immolens")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as fh:
                        assert "immolens.llm" not in fh.read(), name
