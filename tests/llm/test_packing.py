import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from txscore.llm import packing
from txscore.llm.chunks import parts
from txscore.llm.queries import QUERIES
from txscore.llm.token_ids import TokenIds

VOCABULARY = path("byte_bpe_50k.json")


def odd_texts():
    dice = random.Random(4)
    bits = [
        " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", " ", "\x1c", "\x85", ".", ",", "...", "'s",
        "don't", "a", "word", "Word", "naïve", "ß", "12", "²", "½", "日本語", "é", "👍🏽", "​",
        "<|endoftext|>", "x.y", "(a)", "a.", "b,", "'", '"', "\x00", "ﬁ", "Ⅷ",
    ]
    texts = ["".join(dice.choices(bits, k=dice.randrange(1, 30))) for _ in range(1500)]
    return ["", " ", "\n", "a", *texts, "word " * 500, "a" * 3000, " ".join(map(str, range(900)))]


@pytest.mark.parametrize("plain", [False, True])
def test_ids_are_those_of_the_library(plain):
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = plain
    mine = TokenIds(VOCABULARY, plain_specials=plain)
    mine._lookup._limit = 200  # so that the table is emptied now and then
    texts = odd_texts()
    wanted = [library.encode(text, add_special_tokens=False).ids for text in texts]
    alone = [np.frombuffer(mine.many([text])[0], np.uint32).tolist() for text in texts]
    together = [np.frombuffer(ids, np.uint32).tolist() for ids in mine.many(texts)]
    for text, ids, one, other in zip(texts, wanted, alone, together, strict=True):
        assert one == ids and other == ids, repr(text)


def test_long_texts_are_cut_at_safe_places():
    text = "ab cd\nef  gh \n ij " * 40
    cut = list(parts(text, 25))
    assert "".join(cut) == text and len(cut) > 10
    assert list(parts("x" * 100, 10)) == ["x" * 100]


def test_first_piece_takes_what_is_over():
    assert packing.piece_starts(10, 4) == [0, 2, 6]
    assert packing.piece_starts(8, 4) == [0, 4]
    assert packing.piece_starts(1, 4) == [0]


@pytest.mark.parametrize("rule", [packing.NORM, packing.DOT])
@pytest.mark.parametrize(
    "capacity",
    [packing.Capacity(64), packing.Capacity(64, documents=3), packing.Capacity(64, 8, 3000)],
)
def test_every_capacity_holds(rule, capacity):
    longest = capacity.piece()
    lengths = np.sort(np.random.default_rng(9).integers(1, longest + 1, size=700))[::-1]
    chosen = packing.best_fit(lengths, capacity, rule)
    tokens, documents, attention = capacity.limits()
    for number in np.unique(chosen):
        inside = lengths[chosen == number]
        assert inside.sum() <= tokens and len(inside) <= documents
        assert (inside**2).sum() <= attention


def test_small_pieces_fill_the_gaps():
    lengths = np.sort(np.random.default_rng(9).integers(1, 30, size=700))[::-1]
    chosen = packing.best_fit(lengths, packing.Capacity(64))
    assert len(np.unique(chosen)) <= 1.005 * np.ceil(lengths.sum() / 64)


def test_attention_cost_can_bind():
    capacity = packing.Capacity(tokens=10, attention=50)
    assert capacity.piece() == 7
    assert packing.best_fit(np.array([6, 3, 3]), capacity).tolist() == [0, 0, 1]
    assert packing.best_fit(np.array([7, 1, 1]), capacity).tolist() == [0, 0, 1]
    with pytest.raises(ValueError, match="hold a piece"):
        packing.Capacity(tokens=10, attention=9).limits()


def test_rule_must_be_known():
    with pytest.raises(ValueError, match="rule"):
        packing.best_fit(np.array([1]), packing.Capacity(), "first")


def test_documents_come_back_whole(spark):
    dice = random.Random(2)
    texts = [" ".join(dice.choices(["alpha", "be", "c."], k=dice.randrange(0, 60))) for _ in range(90)]
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)]
    rows += [(100, None, "x", 5), (None, "null id", "x", 5), (7, texts[7], "x", 5), (7, texts[7], "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, offset int")
    got = packing.pack_documents(docs, VOCABULARY, capacity=packing.Capacity(16)).toPandas()
    library = Tokenizer.from_file(VOCABULARY)
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        mine = got[got.doc_id.isna()] if doc_id is None else got[got.doc_id == doc_id]
        copies = sum(r[0] == doc_id for r in rows)
        assert mine.length.sum() == copies * len(ids)
        for r in mine.itertuples():
            piece = np.array(ids[r.start : r.start + r.length], "<u4")
            assert zlib.crc32(piece.tobytes()) == r.ids_crc32
            assert r.length == 16 or r.piece == 0
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert sequence.offset.tolist() == [0, *sequence.length.cumsum().tolist()[:-1]]
        assert sequence.length.sum() <= 16
    assert got.sequence_id.nunique() <= 1.1 * np.ceil(got.length.sum() / 16)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, VOCABULARY).count() == 0


def test_query_holds_whole_documents(spark, sf_dir):
    got = QUERIES["op1_best_fit_packing"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    library = Tokenizer.from_file(VOCABULARY)
    pieces = {doc_id: group.sort_values("piece") for doc_id, group in got.groupby("doc_id")}
    assert len(pieces) == len(docs)
    for doc_id, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        mine = pieces[doc_id]
        starts = packing.piece_starts(len(ids), 1024)
        ends = [*starts[1:], len(ids)]
        assert mine.piece.tolist() == list(range(len(starts)))
        assert mine.start.tolist() == starts and (mine.start + mine.length).tolist() == ends
        crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
        assert mine.ids_crc32.tolist() == crcs
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert sequence.offset.tolist() == [0, *sequence.length.cumsum().tolist()[:-1]]
        assert sequence.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.02 * np.ceil(got.length.sum() / 1024) + 1


def test_run_of_pieces_is_dealt_out_by_bytes():
    ids = TokenIds(VOCABULARY)
    pieces = [" naïve", "\nword", " 日本語", " x<|endoftext|>y", " a"] * 300
    assert ids._encode_run(pieces) == ids._encode(pieces)
    with pytest.raises(RuntimeError, match="across"):
        ids._encode_run([" wo", "rd"])


def test_other_residuals_decide_between_equal_ones():
    # two sequences have two tokens left: one of a single piece, one of two
    pieces = np.array([8, 4, 4, 1])
    assert packing.best_fit(pieces, packing.Capacity(10), packing.DOT).tolist() == [0, 1, 1, 1]
    assert packing.best_fit(pieces, packing.Capacity(10), packing.NORM).tolist() == [0, 1, 1, 0]
    # a token's difference outweighs them, unless documents bind: then the sequence that is nearer
    # to its last document costs less (0.049 to 0.102)
    pieces = np.array([8, 4, 3, 1])
    assert packing.best_fit(pieces, packing.Capacity(10)).tolist() == [0, 1, 1, 0]
    assert packing.best_fit(pieces, packing.Capacity(10, documents=4)).tolist() == [0, 1, 1, 1]
