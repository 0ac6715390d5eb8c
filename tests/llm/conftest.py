import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

ODD_TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "\n\n a", "a \n b\t c", "x" * 70, "ab" * 57, "don't  we'll 'S", "1234 567 ١٢٣",
    "İstanbul ﬁ Ça é ", "日本語 テキスト 🙂🙂", "<|endoftext|> a<|endoftext|>b", "a\x1c b \x1f c", "tab\t tab", "e ́x", "... !!! ?",
    "The quick brown fox jumps over the lazy dog. " * 30, "ΟΔΟΣ ΣΑΣ Å Å ǆ", "na\u00efve\u00a0 caf\u00e9", "word " * 4000,
]


@pytest.fixture()
def documents(spark):
    """texts -> documents with ids in order (or given ids)."""
    def make(texts, ids=None, lang="en", source="src0"):
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame(
            [(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids, texts)], DOCUMENTS)
    return make


@pytest.fixture()
def odd(documents):
    """Odd texts, nulls, a repeated row and a null id."""
    texts = [*ODD_TEXTS, None, "same text here", "same text here", "lost id"]
    ids = [*range(len(ODD_TEXTS) + 1), 900, 900, None]
    return documents(texts, ids)
