"""Every operator and stage: nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ticktide.llm import ann, bpe, chat, linededup, mixing, pii, quality, secrets, simhash

CLASH = ["_row", "_text", "_key", "fp", "kept", "n_words", "covered", "pii", "secrets", "bucket", "key", "size", "taken", "target", "_gone", "_times", "node", "root", "ids", "hi", "lo", "n_lines", "n_removed", "_c"]


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(8_000))
    text = " ".join(f"plain{i}" for i in range(80))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "", 0), (None, text + " more", "en", "b", 2), (4, long, "de", "b", 3), (5, " \n\t ", "de", "b", 3), (6, "é😀 " * 40, "fr", "c", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(i))
    return df.cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


def test_stages_keep_columns_and_values(spark, odd, labels, tmp_path):
    sf = f"file://{tmp_path}"
    labels.write.parquet(f"{sf}/labels.parquet")
    before = {r.asDict()["doc_id"]: r for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns, name
        for r in out.collect():
            assert [r[c] for c in CLASH] == [before[r.doc_id][c] for c in CLASH], name
        assert stage(spark, odd.limit(0), sf).count() == 0
    last = corpus_pipeline.STAGES[4][1]
    assert last(spark, odd, sf).count() == odd.count() and last(spark, odd.limit(0), sf).count() == 0


def test_row_operators(spark, odd, labels):
    n = odd.count()
    assert pii.digest(odd).count() == n and secrets.digest(odd, labels).count() == n and quality.apply(odd, carry=tuple(odd.columns)).count() == n
    assert mixing.digest(odd, labels).count() == n and simhash.digest(odd).count() == n and linededup.apply(odd, counts=True).count() == n
    none = odd.limit(0)
    for df in (pii.digest(none), secrets.digest(none, labels), quality.apply(none), mixing.digest(none, labels), simhash.digest(none), linededup.digest(none)):
        assert df.count() == 0
    import public_tokenizers as P

    assert bpe.apply(none, P.path("byte_bpe_50k.tiktoken"), tuple(bpe.OUTPUTS)).count() == 0
    rows = {r.doc_id: r for r in simhash.digest(odd).collect()}
    assert rows[2].fingerprint == "0" * 16 == rows[3].fingerprint and rows[2].component_id == rows[5].component_id == 2


def test_repeated_rows_share_a_mix(spark, odd, labels):
    rows = [r for r in mixing.digest(odd, labels).collect() if r.doc_id == 1]
    assert len(rows) == 2 and rows[0].size == rows[1].size == 80 and rows[0].target == rows[1].target


def test_chat_nulls_and_clashes(spark):
    rows = [(None, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("example", F.lit(2))
    got = {r.conv_id: r for r in chat.digest(df).collect()}
    assert got[None].n_turns == 1 and got[1].n_turns == 2 and got[1].loss_chars == 0
    assert chat.digest(df.limit(0)).count() == 0


def test_ann_edges(spark):
    kind = "vec_id long, embedding array<float>, part int"
    assert ann.digest(spark.createDataFrame([], kind)).count() == 0
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, None, 1), (100, [5.0, 5.0], 1)]
    got = [tuple(r) for r in ann.digest(spark.createDataFrame(rows, kind)).orderBy("query_id", "rank").collect()]
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 0), (100, 2, 0), (100, 3, 1), (100, 4, 2)]
    assert got[0][3] == 0.0
