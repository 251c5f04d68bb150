import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from txscore.llm import queries, toxicity
from txscore.llm.toxicity import Chain


def chain_of(weights, pair, none=0.0):
    """One feature per word w0, w1, ..., and the weight of no feature."""
    names = {f"=w{i}": i for i in range(len(weights))}
    return Chain(names, np.array([*weights, none]), np.array(pair))


def brute_marginals(weights, pair):
    total, toxic = 0.0, np.zeros(len(weights))
    for states in itertools.product((0, 1), repeat=len(weights)):
        score = sum(w * s for w, s in zip(weights, states, strict=True))
        score += sum(pair[a][b] for a, b in zip(states, states[1:], strict=False))
        total += np.exp(score)
        toxic += np.exp(score) * np.array(states)
    return toxic / total


def test_marginals_equal_the_sum_over_all_taggings():
    dice = np.random.default_rng(1)
    weights, pair = dice.normal(size=9) * 2, [[0.3, -1.0], [-0.5, 0.8]]
    chain = chain_of(weights, pair)
    got = chain.marginals(weights, np.array([0, 5, 6]))
    wanted = [brute_marginals(weights[a:b], pair) for a, b in ((0, 5), (5, 6), (6, 9))]
    assert np.allclose(got, np.concatenate(wanted))


def test_gradient_reaches_the_seen_counts():
    dice = np.random.default_rng(2)
    words = dice.integers(0, 4, size=600)
    labels = ((words == 3) & (dice.random(600) < 0.9)).astype(float)
    chain = chain_of(np.zeros(4), np.zeros((2, 2)))
    codes = chain.codes(" ".join(f"w{i}" for i in words))
    starts = np.arange(0, 600, 6)
    toxicity.fit_chain(chain, codes, starts, labels, rounds=300, strength=0.0)
    got = chain.marginals(chain.form_weights()[codes >> 1], starts)
    for word in range(4):
        assert abs(got[words == word].sum() - labels[words == word].sum()) < 3


def test_spans_are_code_points_of_neighbouring_words():
    chain = chain_of([-5.0, 9.0], [[0, 0], [0, 0]], none=-1.0)
    text = "é w1\tw1, w0\n(W1)."
    (marginals,) = chain.read([chain.codes(text)])
    assert [text[a:b] for a, b in chain.spans(text, marginals)] == ["w1\tw1,", "(W1)."]
    assert chain.read([chain.codes(""), chain.codes(text)])[0].size == 0
    assert chain.read([]) == []


def test_long_texts_equal_short_ones(monkeypatch):
    chain = chain_of([-1.0, 2.0], [[0.5, -1], [-1, 1]])
    text = "w0 w1 w1. w0\nw1 " * 50
    (whole,) = chain.read([chain.codes(text)])
    monkeypatch.setattr(toxicity, "parts", lambda t: iter([t[:5], t[5:400], t[400:]]))
    (cut,) = chain.read([chain.codes(text)])
    assert np.allclose(whole, cut)


def test_words_are_found_and_copies_are_not():
    dice = random.Random(3)
    docs, toxic = [], []
    for i in range(600):
        words = dice.choices(["some", "plain", "words", "here", "now"], k=20)
        if i % 4 == 0:
            words += dice.choices(["badword", "vilement", "vileur"], k=3)
        docs.append({name for w in words for name in toxicity.features(w)})
        toxic.append(i % 4 == 0)
    found = toxicity.toxic_features(docs, np.array(toxic))
    assert any("badw" in name for name in found) and any("vile" in name for name in found)
    assert not any("plain" in name for name in found)


def tables(spark):
    dice = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        words = dice.choices(["some", "plain", "words", "here.", "now"], k=25)
        toxic = i % 5 == 0
        if toxic:
            words[3:3] = ["you", "badword", "and", "loser!"]
        docs.append((i, " ".join(words), 0.5, "x"))
        labels.append((i, int(toxic), "x"))
    docs += [(1000, None, 0.1, "x"), (1001, "", 0.1, "x"), (None, "a badword and loser", 0.1, "x")]
    docs += [(1002, "plain " * 60_000 + "badword loser", 0.1, "x"), docs[0]]
    labels += [(0, 0, "x"), (1, None, "x"), (None, 1, "x"), (9999, 1, "x")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score double, spans string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, text string"),
    )


def test_documents_are_scored(spark):
    docs, labels = tables(spark)
    chain = toxicity.train(docs, labels, F.lit(True))
    rows = toxicity.score_documents(docs, chain).collect()
    assert len(rows) == 405
    got = {r.doc_id: r for r in rows}
    for i in range(400):
        assert (got[i].score >= 0.7) == (i % 5 == 0)
    assert got[1000].score == got[1001].score < 0.5 and got[1000].spans == []
    assert got[None].score >= 0.7
    assert got[1002].spans[-1].end == 360_013


@pytest.mark.parametrize("keep", [0, 1, None])
def test_without_both_labels_scores_are_the_share(spark, keep):
    docs, labels = tables(spark)
    labels = labels.filter(F.col("toxic") == keep) if keep is not None else labels.limit(0)
    chain = toxicity.train(docs, labels, F.lit(True))
    scores = {r.score for r in toxicity.score_documents(docs, chain).collect()}
    assert scores == {float(keep or 0)}
    assert toxicity.score_documents(docs.limit(0), chain).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op5_toxic_spans(spark, sf_dir).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{sf_dir}/labels.parquet'").fetchall()
    held = [(got[d].predicted, y) for d, y in labels if got[d].held_out]
    assert len(held) > 80
    assert sum(p == y for p, y in held) / len(held) >= 0.93
