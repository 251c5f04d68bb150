import hashlib

import duckdb
import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path

from tests.llm.test_packing import odd_texts
from txscore.llm import queries
from txscore.llm.merge_pieces import PieceIds, encode_decode

MODEL = path("piece_bpe_32k.model")
ODD = ["▁a", "a ▁b", "a▁", " ▁ ", "<s>", "<0x41> <unk>", "é", "abc " * 40, "x" * 300, "-" * 90]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_are_those_of_the_library(library):
    mine = PieceIds(MODEL)
    mine._lookup._limit = 200  # so that the table is emptied now and then
    texts = [*odd_texts(), *ODD]
    alone = [np.frombuffer(mine.many([text])[0], np.int32).tolist() for text in texts]
    together = [np.frombuffer(ids, np.int32).tolist() for ids in mine.many(texts)]
    for text, one, other in zip(texts, alone, together, strict=True):
        assert one == library.encode(text) and other == one, repr(text)


def test_side_by_side_equals_one_at_a_time():
    agenda = PieceIds(MODEL).agenda
    words = [t.replace(" ", "▁") for t in odd_texts() if 0 < len(t) <= 48]
    assert agenda.many(words) == [agenda.one(word) for word in words]


def test_rows(spark, library):
    texts = [None, "", "Hallo  Welt\n", "same", "same", "naïve 👍🏽 日本"]
    docs = spark.createDataFrame(
        [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", "x", "y")],
        "doc_id long, text string, ids string, decoded string",
    )
    got = {r.doc_id: r for r in encode_decode(docs, MODEL).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        assert (got[i].ids, got[i].decoded) == (ids, library.decode(ids) if ids else "")
    assert encode_decode(docs.limit(0), MODEL).count() == 0


def test_query_equals_the_library_on_whole_texts(spark, sf_dir, library):
    got = {r.doc_id: r for r in queries.op8_merge_pieces(spark, sf_dir).collect()}
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
