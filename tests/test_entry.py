"""The entry module works with and without the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_imports_without_llm(tmp_path):
    code = (
        "import sys\n"
        "class Block:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('tidemark.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name)\n"
        f"sys.meta_path.insert(0, Block()); sys.path.insert(0, {str(ROOT)!r})\n"
        "import __spark_entry__ as e\n"
        "q = e.queries(); assert 'e7_repo_recent_mix' in q and not any(k.startswith('op') for k in q), list(q)\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
