import pytest
from pyspark.sql import functions as F

from palimpsest.operators import manifest, splits
from palimpsest.sources import files


def images(spark, source, n):
    return spark.createDataFrame([(source, f"/tmp/img_{i:03d}.png") for i in range(n)], "source_id string, image_path string")


def test_build_numbers_pages(spark):
    rows = manifest.build(images(spark, "s", 5)).orderBy("page_id").collect()
    assert [r.page_id for r in rows] == [0, 1, 2, 3, 4] and {(r.dpi, r.split) for r in rows} == {(300, "")}
    with pytest.raises(ValueError):
        manifest.build(images(spark, "s", 1), dpi=0)


def test_numbers_over_many_ranges(spark):
    """One group holds most rows; ties, a null group and a null name; ranges cut anywhere."""
    rows = [("hot", f"img_{i * 7919 % 1000:04d}") for i in range(1000)] + [("b", "x"), ("b", "x"), (None, "y"), (None, "a"), ("b", None)]
    table = spark.createDataFrame(rows, "source_id string, image_path string")
    for parts in (1, 2, 50):
        got = [(r.source_id, r.image_path, r.place) for r in manifest.numbered(table, "source_id", "image_path", "place", parts).collect()]
        assert sorted(x[1:] for x in got if x[0] == "hot") == [(f"img_{i:04d}", i) for i in range(1000)]
        assert sorted((x[1] or "", x[2]) for x in got if x[0] == "b") == [("", 0), ("x", 1), ("x", 2)] and sorted(x[1:] for x in got if x[0] is None) == [("a", 0), ("y", 1)]
    assert manifest.numbered(table.limit(0), "source_id", "image_path", "place").count() == 0


def test_transcripts_by_position(spark):
    pages = manifest.build(images(spark, "s", 3))
    texts = lambda n: spark.createDataFrame([("s", f"/tmp/tr_{i}.txt") for i in range(n)], "source_id string, transcript_path string")
    assert {(r.page_id, r.transcript_path) for r in manifest.zip_transcripts(pages, texts(3)).collect()} == {(i, f"/tmp/tr_{i}.txt") for i in range(3)}
    with pytest.raises(ValueError):
        manifest.zip_transcripts(pages, texts(2))


def test_merge(spark):
    a, b = manifest.build(images(spark, "src_a", 3)), manifest.build(images(spark, "src_b", 2)).withColumn("note", F.lit("x"))
    both = manifest.merge([a, b])
    assert both.count() == 5 and both.where("note is null").count() == 3
    for bad in ([], [a.drop("dpi")]):
        with pytest.raises(ValueError):
            manifest.merge(bad)


def test_csv_round_trip(spark, tmp_path):
    pages = manifest.build(images(spark, "007", 4))
    files.write_manifest(pages, str(tmp_path / "m"))
    back = files.read_manifest(spark, str(tmp_path / "m"))
    assert sorted(back.collect()) == sorted(pages.collect()) and back.first().source_id == "007"
    (tmp_path / "bad.csv").write_text("col_a\n1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        files.read_manifest(spark, str(tmp_path / "bad.csv"))


@pytest.mark.parametrize("n, want", [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (2, 0, 1)), (5, (4, 0, 1)), (6, (4, 1, 1)), (10, (7, 2, 1)), (15, (10, 2, 3)), (20, (14, 3, 3)), (30, (21, 4, 5)), (50, (35, 8, 7)), (100, (70, 15, 15))])
def test_quotas(spark, n, want):
    rows = spark.range(n).select(F.lit("s").alias("source_id"), F.col("id").cast("int").alias("page_id"))
    found = {r.split: r["count"] for r in splits.generate(rows).groupBy("split").count().collect()}
    assert tuple(found.get(k, 0) for k in ("train", "val", "test")) == want


def test_split_is_seeded_and_leaves_its_input(spark):
    pages = manifest.build(images(spark, "s", 30))
    split = lambda seed: sorted((r.page_id, r.split) for r in splits.generate(pages, seed=seed).collect())
    assert split(7) == split(7) != split(1) and {s for _, s in split(7)} == {"train", "val", "test"}
    assert pages.where("split <> ''").count() == 0


def test_split_by_source_keeps_sources_whole(spark):
    pages = manifest.merge([manifest.build(images(spark, s, 3)) for s in ("src_a", "src_b", "src_c")])
    rows = splits.generate(pages, strategy="source").groupBy("source_id").agg(F.count_distinct("split").alias("n")).collect()
    assert [r.n for r in rows] == [1, 1, 1]


def test_split_errors(spark):
    pages = manifest.build(images(spark, "s", 3))
    for kw in ({"train": 0.5, "val": 0.5, "test": 0.5}, {"train": 1.0, "val": 0.0, "test": 0.0}, {"strategy": "random"}):
        with pytest.raises(ValueError):
            splits.generate(pages, **kw)


def test_counts_and_names(spark):
    pages = spark.createDataFrame([("a", "train"), ("a", "train"), (None, "val")], "source_id string, split string")
    got = {(r.split, r.source_id): r.n for r in splits.split_counts(pages).collect()}
    assert got == {("train", "a"): 2, ("val", None): 1, ("train", "(all)"): 2, ("val", "(all)"): 1, ("(all)", "(all)"): 3}
    row = spark.range(1).select(manifest.page_name(F.lit("doc"), F.lit(7)).alias("p"), manifest.line_name(F.lit("s"), F.lit(1), F.lit(2)).alias("l"), manifest.page_range(F.lit(5), 3, 9).alias("r"), manifest.page_range(F.lit(0)).alias("none")).first()
    assert tuple(row) == ("doc_p0007.png", "s_p0001_l0002.png", [3, 4], [])


def test_line_metadata(spark):
    records = spark.createDataFrame([(0, [0, 10, 500, 30], "/tmp/l0.png", "foo"), (1, [0, 45, 500, 30], "/tmp/l1.png", "")], "line_id int, bbox array<int>, image_path string, transcript string")
    rows = manifest.line_metadata(records, F.lit("s"), F.lit(4))
    assert rows.columns == list(manifest.LINE_FIELDS) and {(r.source_id, r.page_id) for r in rows.collect()} == {("s", 4)}
    texts = spark.createDataFrame([("s", 4, 1, "bar")], "source_id string, page_id int, line_id int, transcript string")
    assert {(r.line_id, r.transcript) for r in manifest.attach_transcripts(rows, texts).collect()} == {(0, ""), (1, "bar")}
