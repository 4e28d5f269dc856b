import importlib
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from alloyframe.sources import scratch as place


def test_queries_without_the_corpus_operators(monkeypatch):
    """What can't be imported is left out, and nothing else."""
    real = importlib.import_module

    def broken(name, *more):
        if name.startswith(("alloyframe.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, *more)

    monkeypatch.setattr(importlib, "import_module", broken)
    names = entry.queries()
    assert "search_material_property" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
    assert set(entry.oracle_sql()) == set(names)


def test_sql_names_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_scratch_folder_of_one_machine_on_a_cluster():
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        place.scratch(spark, "x")


def test_temporary_folders(spark, tmp_path):
    outside = place.scratch(spark, "kept")
    with place.temporary(spark):
        inside = place.scratch(spark, "gone")
        for path in (outside, inside):
            spark.range(3).write.parquet(path)
    assert spark.read.parquet(outside).count() == 3
    there = spark._jvm.org.apache.hadoop.fs.Path(inside)
    assert not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)
