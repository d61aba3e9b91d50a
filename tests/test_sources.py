import json

import pytest
from pyspark.sql import functions as F

from saferow.sources import files as SRC
from saferow.sources import synth
from saferow.session import scratch_path
from saferow.spec import FOOD_SAFETY


def test_format_dispatch():
    assert SRC.detect_format("a/b.CSV") == "csv"
    assert SRC.detect_format("a/b", ".parquet") == "parquet"
    with pytest.raises(ValueError, match="known formats"):
        SRC.detect_format("a/b.xlsx")


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        SRC.read_table(spark, "/nonexistent/x.csv")


def test_round_trips(spark, samples):
    schema = FOOD_SAFETY.spark_schema(with_key=True)
    for ext in ("csv", "json", "parquet"):
        path = scratch_path(spark, "rt") + "." + ext
        SRC.write_table(samples, path)
        back = SRC.read_table(spark, path, schema=schema if ext != "parquet" else None)
        assert back.select(*samples.columns).exceptAll(samples).count() == 0
        assert back.count() == samples.count()


def test_json_array_file(spark, tmp_path):
    p = tmp_path / "rows.json"
    p.write_text('[{"temperature": 4.0, "food_type": "dairy"}, {"temperature": null, "food_type": "meat"}]')
    df = SRC.read_table(spark, str(p))
    assert df.count() == 2 and df.where(F.col("temperature").isNull()).count() == 1


def test_csv_nan_and_na_tokens(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("temperature,food_type\nNaN,dairy\n,NA\n3.5,meat\n")
    df = SRC.read_table(spark, str(p), schema="temperature double, food_type string")
    rows = df.collect()
    assert rows[0]["temperature"] is None and rows[1]["temperature"] is None and rows[1]["food_type"] is None


def test_multi_file_skips_failures(spark, samples):
    a = scratch_path(spark, "m") + ".parquet"
    SRC.write_table(samples.limit(10), a)
    out = SRC.read_many(spark, [a, "/nonexistent/b.parquet"])
    assert out.count() == 10
    assert SRC.read_many(spark, ["/nonexistent/c.parquet"]) == []


def test_generator_distribution(spark):
    df = synth.generate(spark, n=2000, seed=42, contamination_ratio=0.3).cache()
    assert df.count() == 2000
    assert set(df.columns) == {"sample_key", *FOOD_SAFETY.required_columns}
    share = df.agg(F.avg((F.col("safety_status") == "unsafe").cast("double"))).first()[0]
    assert 0.2 <= share <= 0.4
    miss = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in FOOD_SAFETY.numeric_features]).first()
    assert all(0.005 <= miss[c] <= 0.08 for c in FOOD_SAFETY.numeric_features)
    again = synth.generate(spark, n=2000, seed=42).repartition(7)
    assert again.exceptAll(df).count() == 0


def test_load_or_generate(spark):
    path = scratch_path(spark, "gen") + ".parquet"
    a = SRC.load_or_generate(spark, path, n_samples=300)
    b = SRC.load_or_generate(spark, path, n_samples=300)
    assert a.count() == 300 and b.exceptAll(a).count() == 0


def test_csv_by_name_with_quotes_and_bad_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n"he said ""hi"", ok",2.0\nabc,abc\n')
    (tmp_path / "b.csv").write_text("y,x\n5.0,q\nn/a,r\n")
    schema = "x string, y double"
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    got = {tuple(r) for r in SRC.read_many(spark, paths, schema=schema).collect()}
    assert got == {('he said "hi", ok', 2.0), ("abc", None), ("q", 5.0), ("r", None)}
    bad = {r["column_name"]: r["bad_cells"] for r in SRC.csv_bad_cells(spark, paths[0], schema).collect()}
    assert bad == {"x": 0, "y": 1}
    out = scratch_path(spark, "quoted") + ".csv"
    SRC.write_table(SRC.read_table(spark, paths[0], schema=schema), out)
    import csv
    import glob
    cells = [row for f in glob.glob(out + "/part-*") for row in csv.reader(open(f))]
    assert ['he said "hi", ok', "2.0"] in cells


def test_json_folder_of_arrays_and_lines(spark, tmp_path):
    d = tmp_path / "mixed.json"
    d.mkdir()
    (d / "a.json").write_text('[\n {"a": 1, "b": "x"},\n {"a": 2, "b": "y"}\n]')
    (d / "b.json").write_text('{"a": 3, "b": "z"}\n{"a": 4, "b": "u"}\n{"a": 5, "b": null}\n')
    for schema in (None, "a long, b string"):
        assert sorted(r["a"] for r in SRC.read_table(spark, str(d), schema=schema).collect()) == [1, 2, 3, 4, 5]


HARD = [{"a": 1, "b": 'brace } and "quote" and \\\\ end \\\\', "c": {"d": [{"e": "}{]["}, {"e": "1"}]}}, {"a": 2, "b": "", "c": None},
        {"a": 3, "b": "é\\ \\u007d ,[", "c": {"d": []}}, {"a": 4, "b": "x" * 700, "c": {"d": [{"e": "\\"}]}}]
HARD_SCHEMA = "a long, b string, c struct<d array<struct<e string>>>"


def _array_text(rows, indent=None):
    import json
    return json.dumps(rows, indent=indent, ensure_ascii=False)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("limit", ["64", "300", "1000000"])
def test_one_array_read_by_many_tasks(spark, tmp_path, indent, limit):
    """Any byte ranges give what one task reads."""
    rows = [{**r, "a": r["a"] + 10 * k} for k in range(40) for r in HARD]
    (tmp_path / "big.json").write_text(_array_text(rows, indent), encoding="utf-8")
    (tmp_path / "one.json").write_text(_array_text(rows[:1], indent), encoding="utf-8")
    whole = spark.read.schema(HARD_SCHEMA).option("multiLine", True)
    options = {"spark.sql.files.maxPartitionBytes": limit, "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in options}
    for name in ("big.json", "one.json"):
        want = sorted(whole.json(str(tmp_path / name)).collect())
        try:
            for k, v in options.items():
                spark.conf.set(k, v)
            got = SRC.read_json(spark, str(tmp_path / name), HARD_SCHEMA)
            tasks = spark.read.option("lineSep", "}").text(str(tmp_path / name)).rdd.getNumPartitions()
            assert sorted(got.collect()) == want
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert tasks > 1 or limit == "1000000" or name == "one.json"


def test_json_compressed_nested_and_hidden(spark, tmp_path):
    import gzip
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(_array_text([{"a": 1}, {"a": 2}]).encode()))
    (tmp_path / "sub" / "lines.json.gz").write_bytes(gzip.compress(b'{"a": 3}\n{"a": 4}\n'))
    (tmp_path / "sub" / "deep" / "b.json").write_text("\ufeff [ ]")
    (tmp_path / "sub" / "deep" / "c.json").write_text(_array_text([{"a": 5, "n": "new"}]))
    (tmp_path / "_temporary" / "d.json").write_text(_array_text([{"a": 99}]))
    (tmp_path / "empty.json").write_text("")
    for schema in (None, "a long, n string"):
        df = SRC.read_json(spark, str(tmp_path), schema)
        assert sorted((r["a"], r["n"]) for r in df.collect()) == [(1, None), (2, None), (3, None), (4, None), (5, "new")]


def test_json_array_cut_short_is_an_error(spark, tmp_path):
    for text in ('[{"a": 1}, {"a": 2', '[{"a": 1}, {"a": "x}]', '[{"a": 1}'):
        (tmp_path / "cut.json").write_text(text)
        with pytest.raises(ValueError, match="cut.json is not one whole"):
            SRC.read_json(spark, str(tmp_path / "cut.json"), "a long")


def test_a_file_that_breaks_while_read_is_skipped_whole(spark, tmp_path):
    import gzip
    good = tmp_path / "good.csv"
    good.write_text("x,y\n1,a\n2,b\n")
    whole = gzip.compress("\n".join(["x,y"] + [f"{i},{i * 7919 % 10007}" for i in range(20000)]).encode())
    (tmp_path / "cut.csv.gz").write_bytes(whole[:len(whole) // 2])  # thousands of rows, then the end
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 no parquet PAR1")
    (tmp_path / "short.json").write_text('[{"x": 1}, {"x"')
    paths = [str(tmp_path / n) for n in ("good.csv", "cut.csv.gz", "bad.parquet", "absent.csv", "short.json")]
    with pytest.raises(ValueError):
        SRC.detect_format("cut.csv.gz")
    frames, outcomes = SRC.load_each(spark, paths, schema="x long, y string")
    got = [(r["path"].rsplit("/", 1)[1], r["status"], r["n_rows"], bool(r["error"])) for r in outcomes.collect()]
    assert got == [("good.csv", "loaded", 2, False)] + [(p.rsplit("/", 1)[1], "skipped", 0, True) for p in paths[1:]]
    gz = SRC.load_each(spark, [paths[1]], "csv", "x long, y string")[1].first()
    assert gz["status"] == "skipped" and "format" not in gz["error"].split("\n")[0]
    assert SRC.read_many(spark, paths, schema="x long, y string").count() == 2


def test_a_killed_write_is_not_a_table(spark, tmp_path):
    import os
    path = str(tmp_path / "t.parquet")
    full = SRC.load_or_generate(spark, path, n_samples=60).collect()
    assert SRC.is_complete(spark, path) and len(full) == 60
    part = next(p for p in sorted(os.listdir(path)) if p.startswith("part-"))
    os.remove(f"{path}/{part}")  # a file of the manifest is gone
    assert not SRC.is_complete(spark, path)
    assert sorted(SRC.load_or_generate(spark, path, n_samples=60).collect(), key=str) == sorted(full, key=str)
    half = tmp_path / "half.parquet"
    (half / "_temporary").mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"PAR1")
    assert not SRC.is_complete(spark, str(half)) and not SRC.is_complete(spark, str(tmp_path / "none"))
    assert SRC.load_or_generate(spark, str(half), n_samples=20).count() == 20
    spark.range(3).write.parquet(str(tmp_path / "other.parquet"))  # another writer's table
    assert SRC.is_complete(spark, str(tmp_path / "other.parquet"))


def test_array_files_grow_in_number_and_not_in_length(spark, monkeypatch, tmp_path):
    from saferow.plans import catalog as C

    from core_data import SF001

    monkeypatch.setattr(C, "ARRAY_ROWS", 100, raising=False)
    C._as_arrays(spark, SF001, str(tmp_path), 3)
    files = list((tmp_path / "plain").glob("part-*"))
    texts = [f.read_text() for f in files]
    n = C.samples_df(spark, SF001).count()
    assert len(files) == -(-n // 100)  # 3 files however large the table, before
    assert all("\n" not in t for t in texts)
    assert sum(len(json.loads(t)) for t in texts) == n
    once = SRC.read_table(spark, str(tmp_path / "sub"), "json", schema=C.SAMPLES_SCHEMA)
    assert once.count() == C.samples_df(spark, SF001).where(C._EVEN_HASH).count()


def test_array_cut_at_any_byte_reads_whole(spark, tmp_path):
    """Escaped quotes, brackets in strings and nesting, in ranges of 97 bytes."""
    rows = [{"id": i, "s": 'a\\"}{[' + "\\" * (i % 5) + '"' * (i % 3) + "é]}", "n": {"x": [i, {"y": "}"}]}} for i in range(40)]
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "97")
        got = SRC.read_table(spark, str(tmp_path / "a.json"), schema="id int, s string, n string").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r["id"], r["s"]) for r in got) == [(r["id"], r["s"]) for r in rows]
