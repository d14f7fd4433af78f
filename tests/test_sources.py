import json

import pytest

from grainfold import session
from grainfold.sources import readers, writers


def test_csv_with_nulls_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;x;s\n1;?;"a;b"\n2;2.5;"say ""hi"""\n')
    df = readers.scan_csv(spark, str(tmp_path / "a.csv"), "id int, x double, s string", sep=";", null="?")
    assert [tuple(r) for r in df.collect()] == [(1, None, "a;b"), (2, 2.5, 'say "hi"')]


def test_headerless_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,y,z,NCE,q,43.6,7.2,12\n")
    df = readers.scan_headerless(spark, str(tmp_path / "a.csv"), 9, {4: "iata_code", 6: "lat", 7: "lon", 8: "alt"})
    assert df.columns == ["iata_code", "lat", "lon", "alt"] and df.first().iata_code == "NCE"


def test_latin1(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,t\n1,été\n".encode("latin-1"))
    assert readers.scan_csv(spark, str(tmp_path), "id int, t string", encoding="ISO-8859-1").first().t == "été"


def test_lines_keep_file_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(f"  {i} " if i % 3 else "  " for i in range(100)))
    got = readers.scan_lines(spark, str(tmp_path)).orderBy("file", "block", "row").collect()
    assert [int(r.line) for r in got] == [i for i in range(100) if i % 3]


def test_lines_across_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(f"{i:06d}" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        df = readers.scan_lines(spark, str(tmp_path))
        assert df.select("block").distinct().count() > 3
        assert [int(r.line) for r in df.orderBy("file", "block", "row").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tokens_skip_empty_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text('1  10 20   30 40 mot"s\nshort line\n')
    (tmp_path / "b.txt").write_text("")
    assert [tuple(r)[3:] for r in readers.scan_tokens(spark, str(tmp_path)).collect()] == [(1.0, 10.0, 20.0, 30.0, 40.0, 'mot"s')]


def test_corpus(spark, tmp_path):
    for label, texts in {"CIV": ["un\ntexte", "deux"], "SOC": ["trois"]}.items():
        (tmp_path / f"{label}.txt").write_text(f"\n{readers.CORPUS_MARK}\n".join(texts))
    got = sorted(tuple(r) for r in readers.split_corpus(spark, str(tmp_path)).collect())
    assert got == [("CIV", "deux"), ("CIV", "un\ntexte"), ("SOC", "trois")]


def test_segments_and_listing(spark, tmp_path):
    for n in (1, 2):
        doc = {"speech_segments": [{"start_time": 0.5 * n, "end_time": 1.5}, {"start_time": 2, "end_time": 3}]}
        (tmp_path / f"{n}.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "1.wav").write_bytes(b"x")
    got = sorted(tuple(r) for r in readers.json_segments(spark, str(tmp_path) + "/*.json").collect())
    assert got == [("1", 0.5, 1.5), ("1", 2.0, 3.0), ("2", 1.0, 1.5), ("2", 2.0, 3.0)]
    assert [r.stem for r in readers.list_files(spark, str(tmp_path), ".wav").collect()] == ["1"]


def test_written_layout(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.25)], "id int, p double").coalesce(1)
    writers.write_csv(df, str(tmp_path / "out"), {"id": "id", "p": "output"}, sep=";")
    part = next((tmp_path / "out").glob("*.csv"))
    assert part.read_text() == "id;output\n1;0.25\n"


def test_images(spark, tmp_path):
    from grainfold.jobs.images import training_images

    # the smallest valid bitmap: one white pixel
    pixel = bytes.fromhex("424d3a000000000000003600000028000000010000000100000001001800000000000400000000000000000000000000000000000000ffffff00")
    for label, n in {"cup": 3, "hat": 2}.items():
        (tmp_path / label).mkdir()
        for i in range(n):
            (tmp_path / label / f"{i}.bmp").write_bytes(pixel)
    (tmp_path / "cup" / "broken.bmp").write_bytes(b"no image")
    out = training_images(spark, str(tmp_path), limit=2, minimum=2)
    assert sorted(r.label for r in out.select("label").collect()) == ["cup", "cup", "hat", "hat"]
    with pytest.raises(ValueError, match="hat"):
        training_images(spark, str(tmp_path), minimum=3)


def test_settle_uses_the_session_folder(spark):
    out = session.settle(spark.range(5))
    assert out.count() == 5
    assert spark.sparkContext.getCheckpointDir().split(":")[-1].lstrip("/").startswith(session.shared_folder(spark).lstrip("/"))
