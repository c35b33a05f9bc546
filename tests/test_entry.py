import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_registry_without_the_training_data_subpackage(tmp_path):
    """The rest imports and registers its queries when the subpackage is gone."""
    (tmp_path / "chunksink").mkdir()
    for p in (ROOT / "chunksink").iterdir():
        if p.name != "llm":
            (tmp_path / "chunksink" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'chunk_plan' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["height", "ts", "user_id", "value", "_chunk"] and df.count() > 0


def test_nothing_imports_the_subpackage():
    for p in (ROOT / "chunksink").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "chunksink.llm" not in p.read_text(), p
