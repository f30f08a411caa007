import os

import pytest

from glyphatlas.sources.tagged import lay_texts, scan_tagged

TEXTS = {"tagged/A000/a000001.seq": "%I A000001 #1\r\n%N A000001 é", "tagged/A000/a000002.seq": "", "a b+c%/x.seq": "%I A3\n\n", "loose.seq": "%I A4", None: "%I A5"}
FOLDERS = {"tagged%2FA000", "a%20b%2Bc%25", "__HIVE_DEFAULT_PARTITION__"}


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([*TEXTS.items()], "path string, text string").repartition(3)


def found(spark, root):
    return sorted(r["text"] for r in scan_tagged(spark, root, "*.txt").collect())


def test_tasks_make_one_file_a_text(spark, texts, tmp_path):
    for _ in range(2):  # a task that runs again leaves nothing twice
        lay_texts(texts, f"file:{tmp_path}/laid")
    assert set(os.listdir(tmp_path / "laid")) == {f"folder={f}" for f in FOLDERS}
    assert sum(len(names) for _, _, names in os.walk(tmp_path / "laid")) == len(TEXTS)  # no checksums beside them
    assert found(spark, str(tmp_path / "laid")) == sorted(f"{t}\n" for t in TEXTS.values())


def test_nothing_to_lay(spark, texts, tmp_path):
    lay_texts(texts.where("false"), str(tmp_path / "laid"))
    assert found(spark, str(tmp_path / "laid")) == []


def test_files_in_a_store_that_tasks_do_not_reach(spark, texts, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.laid.link./in", f"file://{tmp_path}")
    lay_texts(texts, "viewfs://laid/in/x")
    assert found(spark, "viewfs://laid/in/x") == sorted(f"{t}\n" for t in TEXTS.values())
