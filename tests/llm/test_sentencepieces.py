import zlib

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from holdfast.llm import sentencepieces


def test_round_trip(documents, odd, pieces_model):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces_model)
    got = sentencepieces.round_trip(documents(odd), pieces_model).collect()
    want = []
    for i, t in odd:
        ids = library.encode(t or "")
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()), True, ids))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_encode_then_decode_keeps_rows(documents, odd, pieces_model):
    frame = documents(odd).withColumn("piece_ids", F.lit(1))
    encoded = sentencepieces.encode_documents(frame, pieces_model)
    assert encoded.columns == [c for c in frame.columns if c != "piece_ids"] + ["piece_ids"]
    back = sentencepieces.decode_documents(encoded.select("doc_id", "piece_ids"), pieces_model)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(((i, (t or "").replace("▁", " ")) for i, t in odd), key=str)


def test_empty_table(documents, pieces_model):
    assert sentencepieces.round_trip(documents([]), pieces_model).count() == 0
    assert sentencepieces.encode_documents(documents([]), pieces_model).count() == 0
