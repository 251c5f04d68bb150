import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.test_simhash import brute_components, brute_fingerprint
from txscore.llm import secrets, toxicity
from txscore.llm.queries import held_out

KEY = "0123456789abcdef" * 2
LAYOUT = "doc_id long, text string, lang string, source string, n_chars long, sequence_id string"


def documents():
    dice = random.Random(6)
    texts = []
    for i in range(300):
        words = dice.choices(["some", "plain", "words", "here.", "now", "and", "then"], k=40)
        if i % 6 == 0:
            words[3:3] = ["you", "badword", "and", "loser!"]
        texts.append(" ".join(words))
    clean = [t for i, t in enumerate(texts) if i % 6]
    texts += [clean[0]] * 5 + [clean[1].upper(), f"{clean[2]} token={KEY} end", "", None, " \n"]
    texts += [f"password: {KEY} " + " ".join(dice.choices("abcdefgh", k=1500))]
    rows = [(i, t, "en", "x", len(t or ""), "y") for i, t in enumerate(texts)]
    # a copy without an id, a text of its own without one, and a repeated row
    return rows + [(None, clean[3], "en", "x", 1, "y"), (None, "only here, " * 9, "en", "x", 1, "y"), rows[7]]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = documents()
    spark.createDataFrame(docs, LAYOUT).write.parquet(f"{folder}/documents.parquet")
    labels = [(d[0], int(d[0] % 6 == 0)) for d in docs[:300]]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """The rows that each stage gives, and the columns."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, tables).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs)
    return found


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_toxic_documents_go_and_others_stay(spark, tables, stages):
    before, after = stages[0], stages[1]
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    chain = toxicity.train(before, labels, ~held_out(F.col("doc_id")))
    scores = [s for _, s, _ in map(tuple, toxicity.score_documents(before, chain).collect())]
    assert after.columns == before.columns
    assert after.count() == sum(s < 0.7 for s in scores)
    gone = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()} - {None}
    assert gone == {i for i in range(300) if i % 6 == 0}


def test_one_document_of_each_component_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    big = 1 << 62
    ids = [r[0] if r[0] is not None else big + i for i, r in enumerate(before)]
    marked = [(d, brute_fingerprint(r[1])) for d, r in zip(ids, before, strict=True)]
    wanted, seen = [], set()
    for (d, _), component, row in zip(marked, brute_components(marked), before, strict=True):
        if d == component and d not in seen:
            seen.add(d)
            wanted.append(row)
    assert after == sorted(wanted, key=repr)
    assert sum(r[0] is None for r in after) == 1


def test_secrets_are_hidden(stages):
    before, after = stages[2], stages[3]
    net = secrets.train(before)
    wanted = []
    for r in before.collect():
        text = r.text and secrets.hide(r.text, secrets.findings(r.text, net), "[SECRET]")
        chars = r.n_chars if text is None else len(text)
        wanted.append((r.doc_id, text, r.lang, r.source, chars, r.sequence_id))
    assert rows(after) == sorted(wanted, key=repr)
    assert not any(KEY in (r.text or "") for r in after.collect())
    assert any("[SECRET]" in (r.text or "") for r in after.collect())


def test_everything_kept_is_packed(spark, tables, stages):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    packed = corpus_pipeline.run(spark, tables).toPandas()
    assert len(packed) == stages[4].count()
    for r in stages[3].filter("doc_id is not null").collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        mine = packed[packed.doc_id == r.doc_id].sort_values("piece")
        assert mine.length.sum() == len(ids)
        for piece in mine.itertuples():
            part = ids[piece.start : piece.start + piece.length]
            assert zlib.crc32(part.tobytes()) == piece.ids_crc32
    assert packed.groupby("sequence_id").length.sum().max() <= 1024


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels"):
        empty = spark.read.parquet(f"{tables}/{name}.parquet").limit(0)
        empty.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_are_registered():
    names = driver.queries()
    assert "pipeline" in names
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 14))
