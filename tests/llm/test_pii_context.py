"""Account numbers before other words, and context beyond a neighbouring match."""

from ticktide.llm import pii


def test_ibans_before_words_and_numbers_beyond_neighbours(spark):
    texts = [
        ("IBAN DE89370400440532013000 BIC COBADEFFXXX", "iban:5:27"),
        ("DE89 3704 0044 0532 0130 00 EUR 500", "iban:0:27"),
        ("on DE89370400440532013000 2024-05-01", "iban:3:25"),
        ("on DE89370400440532013001 2024-05-01", ""),
        ("SSN: 123-45-6789, 234-56-7890, 345-67-8901", "national_id:5:16,national_id:18:29,national_id:31:42"),
        ("123-45-6789, 234-56-7890, 345-67-8901 ssn", "national_id:0:11,national_id:13:24,national_id:26:37"),
        ("123-45-6789, 234-56-7890", ""),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(df).collect()}
    assert [got[i] for i in range(len(texts))] == [want for _, want in texts]
