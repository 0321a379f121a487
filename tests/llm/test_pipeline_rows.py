"""The pipeline's stages decide by row: repeated rows, shared and null identifiers."""

import corpus_pipeline as P
from tabfidelity.llm import quality

SCHEMA = "doc_id long, text string"
WORDS = [f"w{i}" for i in range(60)]
A, B, NEAR = " ".join(WORDS), " ".join(reversed(WORDS)), " ".join([*WORDS, "more"])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_exact_stage(spark):
    got = lambda *r: rows(P.exact_duplicates(spark, spark.createDataFrame(r, SCHEMA), ""))
    assert got((5, "a"), (5, "b"), (9, "a")) == [(5, "b"), (9, "a")]
    assert got((1, "a"), (1, "a"), (2, "c")) == [(1, "a"), (2, "c")]
    assert got((None, "a"), (None, "a"), (None, "b"), (3, "b")) == [(3, "b"), (None, "a")]
    assert got((None, None), (4, "")) == [(4, "")]


def test_near_stage(spark):
    got = lambda *r: rows(P.near_duplicates(spark, spark.createDataFrame(r, SCHEMA), ""))
    assert got((3, A), (5, NEAR), (5, B)) == [(3, A), (5, B)]
    assert len(got((5, A), (5, A))) == 1
    assert got((3, A), (None, NEAR), (None, B)) == [(3, A), (None, B)]
    assert got((3, A), (4, NEAR), (6, B)) == [(3, A), (6, B)]


def test_quality_stage(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    judge = quality.quality_sample
    monkeypatch.setattr(quality, "quality_sample", lambda *a, **k: judge(*a, **k).withColumn("selected", P.F.col("version") != P.F.xxhash64(P.F.lit("bad"))))
    docs = spark.createDataFrame([(5, "bad"), (5, "good"), (None, "bad"), (None, "good"), (7, None)], SCHEMA)
    assert rows(P.quality_classifier(spark, docs, str(tmp_path))) == [(5, "good"), (7, None), (None, "good")]


def test_passages_and_packing_stages(spark):
    long = " ".join(f"v{i}" for i in range(120))
    docs = [(1, long), (2, f"{long} {A}"), (2, f"{long} {A}"), (None, long), (3, None), (4, "")]
    out = P.repeated_passages(spark, spark.createDataFrame(docs, SCHEMA), "")
    got = rows(out)
    assert out.columns == ["doc_id", "text"] and len(got) == 6 and {r for r in got if r[0] in (3, 4)} == {(3, ""), (4, "")}
    two = [t for d, t in got if d == 2]
    assert two[0] == two[1] and A[-40:] in two[0] and len(two[0]) < len(docs[1][1])
    packed = P.token_sequences(spark, spark.createDataFrame(docs, SCHEMA), "").collect()
    assert sorted(str(r["doc_id"]) for r in packed) == ["1", "2", "2", "3", "4", "None"] and sum(r["length"] == 1 for r in packed) == 2


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in P.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), str(tmp_path)).count() == 0


def test_extra_columns_with_the_operators_own_names(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, A, 5, "x", 1, 2, 3), (2, B, 6, "y", 1, 2, 3), (2, NEAR, 7, "z", 1, 2, 3)], "doc_id long, text string, version long, gone_id string, kept int, row_id int, starts int")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "version", "gone_id", "kept", "row_id", "starts"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert sorted((r["doc_id"], r["version"], r["gone_id"]) for r in docs.collect()) == [(1, 5, "x"), (2, 6, "y")]


def test_two_runs_of_a_stage_stand_side_by_side(spark):
    """The working tables of one run do not go with those of another."""
    one, two = (P.exact_duplicates(spark, spark.createDataFrame(r, SCHEMA), "") for r in ([(1, "a"), (2, "a")], [(3, "b"), (4, "B")]))
    assert rows(one) == [(2, "a")] and rows(two) == [(4, "B")]
