import public_tokenizers
import pytest

#: Names that operators use inside; extra columns of these names must not disturb them.
CLASHES = "body blob path found content bands bucket component score spans row part at seed start words ids size key member marks _body _found _gone _key _blob _toxic_score _id _label _place"
EXTRA = CLASHES.split()


@pytest.fixture(scope="session")
def pieces_model():
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="session")
def words_model():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(rows):
        schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in EXTRA)
        return spark.createDataFrame([(i, t, *["x"] * len(EXTRA)) for i, t in rows], schema)

    return make


LONG = "lorem ipsum dolor sit amet " * 30_000
ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "one two  three\nfour\n\n five "),
    (4, "one two  three\nfour\n\n five "),
    (5, "Ünï▁cödé 漢字 😀 \t end.\r\n"),
    (None, "text without an id"),
    (None, None),
    (6, LONG),
    (7, "<|endoftext|> <s> ▁▁ 's ſ"),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
