import pytest
import subprocess
import sys
import textwrap

from conftest import ROOT


def test_cluster_folder_is_used(tmp_path):
    """A named checkpoint folder holds everything that is written on the way."""
    code = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession, functions as F
        from lacuna import session
        from lacuna.functions.joins import settle
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
        assert session.checkpoint_dir(spark) == {str(tmp_path)!r}
        assert session.work_dir(spark, "x").startswith({str(tmp_path)!r})
        assert settle(spark.range(5).agg(F.sum("id").alias("s"))).first()["s"] == 10
        assert {str(tmp_path)!r} in spark.sparkContext.getCheckpointDir()
    """)
    subprocess.run([sys.executable, "-c", code], check=True, cwd="/", timeout=120, capture_output=True)
    assert any(tmp_path.rglob("part-*"))


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from lacuna.session import checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077")
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)
