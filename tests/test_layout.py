"""The rest works without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rest_works_without_the_subpackage(tmp_path):
    root = tmp_path / "repo"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "*.json", "*.md"))
    shutil.rmtree(root / "casita" / "llm", ignore_errors=True)
    for pipeline_is_there in (True, False):
        if not pipeline_is_there:
            (root / "corpus_pipeline.py").unlink(missing_ok=True)
        code = "import __spark_entry__ as e, bench; q = e.queries(); print(len(q), len(e.oracle_sql()), any(k.startswith('op1') or k == 'pipeline' for k in q))"
        env = {**os.environ, "PYTHONPATH": str(root), "PYTHONDONTWRITEBYTECODE": "1"}
        said = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=120)
        assert said.returncode == 0, said.stderr[-800:]
        n, n_sql, has = said.stdout.split()
        assert int(n) >= int(n_sql) > 60 and has == "False"


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "casita")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "casita.llm" not in f.read(), name
