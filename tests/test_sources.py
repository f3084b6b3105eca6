from tastegraph.sources import (
    read_ratings, read_samples, read_samples_with_rejects, read_user_item_records, write_embeddings, write_samples,
)


def test_ratings_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,900000000\n")
    row = read_ratings(spark, str(tmp_path / "r.csv")).first()
    assert tuple(row) == (1, 2, 3.5, 900000000)


def test_samples_skip_bad_rows_and_fill_gaps(spark, tmp_path):
    from tastegraph.sources import SAMPLES

    names = [part.split()[0] for part in SAMPLES.split(", ")]
    good = ["1", "2", "4.0", "5", "1"] + [""] * (len(names) - 5)
    bad = ["x", "2", "4.0", "5", "1"] + [""] * (len(names) - 5)
    unlabelled = ["3", "2", "4.0", "5", ""] + [""] * (len(names) - 5)
    lines = [",".join(line) for line in (names, good, bad, unlabelled)]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    rows = read_samples(spark, str(tmp_path / "s.csv"), defaults={"releaseYear": 1990}).collect()
    assert len(rows) == 1
    assert (rows[0].movieId, rows[0].userRatedMovie1, rows[0].userGenre1, rows[0].releaseYear) == (1, 0, "", 1990)
    kept, rejects = read_samples_with_rejects(spark, str(tmp_path / "s.csv"), defaults={"releaseYear": 1990})
    assert kept.collect() == rows
    held = {r.reason: r.line for r in rejects.collect()}
    assert set(held) == {"malformed", "no label"} and held["malformed"] == lines[2] and held["no label"].startswith("3,2,4.0,5,")


def test_single_file_and_embedding_lines(spark, tmp_path):
    df = spark.range(100).repartition(4)
    write_samples(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    vectors = spark.createDataFrame([("a", [0.5, -1.0])], "id string, vector array<float>")
    write_embeddings(vectors, str(tmp_path / "text"), fmt="text")
    assert spark.read.text(str(tmp_path / "text")).first()[0] == "a:0.5 -1.0"
    write_embeddings(vectors, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).first().vector == [0.5, -1.0]


def test_records_from_a_path(spark, tmp_path):
    from tastegraph.sources.readers import RECORD_FIELDS

    (tmp_path / "r.csv").write_text("user_id,more,movie_id,user_rating,user_gender,user_zip_code,user_occupation_text,bucketized_user_age\n7,z,3,4.5,1,00501,x,25\n")
    records = read_user_item_records(spark, str(tmp_path / "r.csv"))
    assert dict(records.dtypes) == RECORD_FIELDS
    assert tuple(records.first()) == ("3", "7", 4.5, 1, "00501", "x", 25)
    plan = records.select("movie_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<movie_id:string>" in plan
    records.withColumn("more", records.movie_id).write.parquet(str(tmp_path / "p"))
    again = read_user_item_records(spark, str(tmp_path / "p"), "parquet")
    assert again.collect() == records.collect() and again.columns == list(RECORD_FIELDS)
