import brute
from kindred.llm import near_dup


def test_texts_of_one_shingle_meet_longer_ones(spark, tmp_path):
    rows = [(1, "ha ha ha ha"), (2, "ha ha ha ha ha"), (3, "ha ha ha"), (4, "a b c d"), (5, "A b  c d")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "t"))
    out = near_dup.near_duplicates(spark.read.parquet(str(tmp_path / "t")), words=4).collect()
    want = brute.near(rows, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == want and want[2][1] == 1
