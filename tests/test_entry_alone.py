"""The library without its language-model folder."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_folder(tmp_path):
    shutil.copytree(f"{REPO}/visitry", tmp_path / "visitry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 200 and not any(k.startswith('op1_') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
