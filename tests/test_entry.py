"""The entry file without the parts that an installation may leave out."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LEFT_OUT = """
import sys, importlib.abc

class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name in {blocked} or name.startswith("evenkeel.llm"):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
assert len(entry.queries()) >= 62 and all(n.startswith("q_") for n in entry.queries())
"""


@pytest.mark.parametrize("blocked", [["evenkeel.llm"], ["evenkeel.llm", "corpus_pipeline"]])
def test_entry_without_corpus_operators(blocked):
    code = LEFT_OUT.format(blocked=blocked)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_other_missing_modules_are_errors(tmp_path, monkeypatch):
    import __spark_entry__ as entry

    (tmp_path / "needs_more.py").write_text("import no_such_module_at_all")
    monkeypatch.syspath_prepend(tmp_path)
    with pytest.raises(ModuleNotFoundError):
        entry._register("needs_more", needs=("evenkeel.llm",))
    entry._register("needs_more", needs=("no_such_module_at_all",))
    entry._register("not_installed.queries")
