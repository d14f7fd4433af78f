"""Array files in ranges of rows, and whole files written by tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainfold.sources import files, readers


def test_arrays_in_ranges(spark, tmp_path):
    a, b, c = np.arange(30, dtype=np.float32).reshape(10, 3), np.arange(5), np.zeros((0, 3))
    (tmp_path / "deep").mkdir()
    for name, x in (("a", a), ("deep/b", b), ("c", c)):
        np.save(tmp_path / f"{name}.npy", x)
    (tmp_path / "notes.txt").write_text("no array")
    found = files.read_arrays(spark, str(tmp_path), range_bytes=24)
    assert found.rdd.getNumPartitions() == 5 + 2
    rows = {(r.file, r.row): r["values"] for r in found.collect()}
    assert rows == {**{("a.npy", i): a[i].tolist() for i in range(10)}, **{("b.npy", i): [float(i)] for i in range(5)}}
    one = files.read_arrays(spark, str(tmp_path / "a.npy"))
    assert one.count() == 10 and one.rdd.getNumPartitions() == 1


def test_other_layouts_are_refused(spark, tmp_path):
    np.save(tmp_path / "f.npy", np.asfortranarray(np.ones((3, 2))))
    with pytest.raises(Exception, match="Fortran"):
        files.read_arrays(spark, str(tmp_path)).count()


def test_no_files(spark, tmp_path):
    assert files.read_arrays(spark, str(tmp_path / "nothing")).count() == 0


def test_arrays_there_and_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_BYTES", 4000)
    df = spark.range(500).select(F.array(F.col("id").cast("double"), F.col("id") / 3).alias("v")).repartition(3)
    files.write_arrays(df, "v", str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix != ".npy") == []
    back = files.read_arrays(spark, str(tmp_path / "out")).select(F.col("values").alias("v"))
    assert back.exceptAll(df).count() == 0 and back.count() == 500


def test_a_failed_job_names_no_file(spark, tmp_path):
    @F.udf("binary")
    def content(i):
        if i == 7:
            raise ValueError("seven")
        return b"x"

    rows = spark.range(10).select(F.concat(F.col("id").cast("string"), F.lit(".bin")).alias("name"), content("id").alias("content"))
    with pytest.raises(Exception, match="seven"):
        files.write_files(rows, str(tmp_path))
    assert list(tmp_path.glob("*.bin")) == []
    files.write_files(rows.where("id <> 7"), str(tmp_path))
    assert len(list(tmp_path.glob("*.bin"))) == 9
    assert readers.list_files(spark, str(tmp_path), ".bin").count() == 9
