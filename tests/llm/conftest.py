import pytest

from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with an extra column whose name operators use inside."""

    def make(rows, schema=DOCUMENTS + ", score double, fp long, n_tokens long"):
        return spark.createDataFrame(
            [(i, t, "en", "src0", len(t) if t else None, None, None, None) for i, t in rows], schema)

    return make


EDGE_TEXTS = [None, "", " ", "\n\n", "a", "two words", "a  b   c", "tail  ", "\t x \n y", "été naïf 🙂🙂 字",
              "x<|endoftext|>y <|endoftext|>", "don't we'll I'd 123 4567 !!?? ...", " lead", "w " * 3000,
              "ab" * 20000, "a b c 　 d", "a\r\nb\x0bc\x0cd \x1c e\x85f"]


@pytest.fixture
def edge_texts():
    return EDGE_TEXTS
