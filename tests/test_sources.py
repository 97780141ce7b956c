from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from acequia.plans import pipeline
from acequia.sources import html, readers, writers
from acequia.streaming import incremental


def test_parquet(spark, tmp_path):
    a = str(tmp_path / "a.parquet")
    spark.createDataFrame([(1, "x")], "id int, text string").write.parquet(a)
    with pytest.warns(UserWarning):
        assert readers.parquet(spark, [a, str(tmp_path / "none.parquet")], ["id"]).columns == ["id"]
    with pytest.raises(FileNotFoundError):
        readers.parquet(spark, [str(tmp_path / "none.parquet")])
    assert readers.parquet_tree(spark, str(tmp_path), ["text"]).count() == 1


def test_jsonl(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('﻿{"prompt": "a", "n": 1}\n\n{"prompt": "b"\n{"prompt": null, "n": 3}\n', encoding="utf-8")
    out = readers.jsonl_captured(spark, str(p), "prompt string, n int").orderBy("_source_line").collect()
    assert [(r.prompt, r.n, r._invalid_json, r._source_line) for r in out] == [("a", 1, False, 1), (None, None, True, 3), (None, 3, False, 4)]
    assert {r._source_file for r in out} == {"x.jsonl"}
    assert readers.jsonl(spark, str(p), "prompt string, n int", bad="drop").count() == 2
    with pytest.raises(Exception):
        readers.jsonl(spark, str(p), "prompt string, n int").collect()
    with gzip.open(tmp_path / "y.jsonl.gz", "wt") as f:
        f.write('{"a": 1}\n{"a": 2}\n')
    assert readers.jsonl(spark, str(tmp_path / "y.jsonl.gz")).count() == 2


def test_csv_and_years(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("id;texto\n1;año\n2;\"dos\nlíneas\"\n".encode("latin-1"))
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "t.csv"), ";", "ISO-8859-1").collect()] == [("1", "año"), ("2", "dos\nlíneas")]
    for name, schema in (("2023_x", "a int"), ("2024_y", "a int, b int")):
        spark.createDataFrame([(1,) if schema == "a int" else (1, 2)], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    out = readers.year_union(spark, [str(tmp_path / "2023_x.parquet"), str(tmp_path / "2024_y.parquet")], prefix=True)
    assert sorted(tuple(r) for r in out.select("a", "year").collect()) == [(1, "2023"), (1, "2024")]


def test_headers(spark):
    wide = spark.createDataFrame([("i1", "sí", None)], "item string, `Anotador 1` string, `Anotador 2` string")
    assert [tuple(r) for r in readers.wide_answers(wide, "item", r"Anotador (\d)").collect()] == [("i1", "1", "sí")]
    with pytest.raises(ValueError):
        readers.wide_answers(wide, "item", "zzz")
    a = spark.createDataFrame([("l14_2021-03-05_n12",)], "viejo string")
    r = readers.consolidate([a], {"viejo": "id"}).head()
    assert (str(r.date), r.number, r.legislature) == ("2021-03-05", "12", "14")


def test_html(spark):
    page = "<html><head><title>t</title></head><body><h3>S</h3><ul><li>uno <b>dos</b></li></ul><h4>T</h4><li>tres</li><script>x</script></body></html>"
    assert html.html_text(page) == "S uno dos T tres" and html.html_text(None) is None
    out = html.section_records(spark.createDataFrame([(1, page), (2, None)], "id int, h string"), "id", "h").collect()
    assert [tuple(r) for r in out] == [(1, "S", "", "", "uno dos"), (1, "S", "T", "", "tres")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", ["r"] if i % 2 else []) for i in range(10)], "id int, text string, reasons array<string>")
    path = str(tmp_path / "twin")
    assert writers.write_twin(df, path) and not writers.write_twin(df, path) and writers.write_twin(df, path, force=True)
    assert spark.read.json(f"{path}.jsonl").count() == 10
    writers.write_parts(df, str(tmp_path / "parts"), ["id"], 3)
    assert dict(spark.read.parquet(str(tmp_path / "parts")).groupBy("part").count().collect()) == {0: 3, 1: 3, 2: 4}
    writers.write_rejected(df, str(tmp_path / "rejected"))
    assert os.listdir(tmp_path / "rejected").count("reason=r") == 1
    writers.write_csv(df, str(tmp_path / "csv"), ["id", "reasons"], ["reasons"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["id", "reasons"]
    assert writers.task_path("/x/", "tokens_per_source", ["A B"], 5) == "/x/tokens-per-source--a_b--5"
    assert writers.tagged({"x": df, "y": df}).count() == 20
    assert writers.append_distinct(df.select("id"), df.select("id")).count() == 10


def test_pipeline(spark, tmp_path):
    texts = [f"El taller número {i} empleó la cantería en los encargos que se conocen de la villa. Y la torre {i * 7} es de la época de los caños y de las fuentes del lugar." for i in range(6)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts + [texts[0]])], "id int, text string").write.parquet(str(tmp_path / "d.parquet"))
    context = pipeline.Context(spark, str(tmp_path / "corpus"), {"initial": {"datasets": {"D": str(tmp_path / "d.parquet")}}, "sample": {"task": "documents-general-equitative", "each": 4}})
    out = pipeline.run(context)
    assert out.count() == 4 and set(out.columns) == {"source_id", "id", "text", "tokens"}
    assert spark.read.parquet(str(tmp_path / "corpus/curate.parquet")).count() == 6
    assert pipeline.chosen_steps(start="clean", end="curate") == ["clean", "curate"]
    for wrong in ({"single": "x"}, {"start": "curate", "end": "clean"}):
        with pytest.raises(ValueError):
            pipeline.chosen_steps(**wrong)


def test_stream(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "doc_id bigint, text string, loaded_at timestamp, source string"
    first = spark.createDataFrame([(1, "# uno", "s"), (2, "# uno", "s"), (3, None, "s")], "doc_id bigint, text string, source string").withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp"))
    first.select("doc_id", "text", "loaded_at", "source").write.parquet(source)
    stream = incremental.clean_stream(spark, source, schema)
    incremental.write_parquet(incremental.once_by_text(stream, "loaded_at"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    seen: list[int] = []
    for _ in range(2):
        incremental.write_batches(incremental.clean_stream(spark, source, schema), str(tmp_path / "c2"), lambda df, _: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 2


def test_line_numbers_over_splits(spark, tmp_path):
    p = tmp_path / "long.jsonl"
    p.write_text("".join(f'{{"n": {i}}}\n' if i % 5 else "bad\n" for i in range(1, 3001)), encoding="utf-8")
    size, cost = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = readers.jsonl_captured(spark, str(p), "n int").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert len(out) == 3000 and all(r._source_line == r.n if not r._invalid_json else r.n is None and r._source_line % 5 == 0 for r in out)
