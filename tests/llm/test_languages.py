import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txscore.llm import languages
from txscore.llm.queries import QUERIES, learned_from

TEXTS = {
    "aa": ["banana", "baba", "nabana", "abana", "anab"],
    "bb": ["kiki", "tikki", "ikiti", "kitik", "titi"],
    "cc": ["øyøy", "møyn", "yønøm", "nøyø", "ømyn"],
}


def texts(language, n, seed=1, words=12):
    dice = random.Random(f"{language}{seed}")
    return [" ".join(dice.choices(TEXTS[language], k=dice.randrange(2, words))) for _ in range(n)]


def by_hand(text):
    """Runs of two and three characters with a letter, of the text as words between single spaces."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    kept = f" {' '.join(kept.split())} "
    runs = Counter(kept[i : i + n] for n in (2, 3) for i in range(len(kept) - n + 1))
    return {run: count for run, count in runs.items() if run.strip()}


@pytest.mark.parametrize("part", [1, 2, 5, 1 << 18])
def test_runs_are_counted(monkeypatch, part):
    monkeypatch.setattr(languages, "PART", part)
    dice = random.Random(2)
    for _ in range(120):
        text = "".join(dice.choices("abÉß日 \n.,12é", k=dice.randrange(0, 40)))
        wanted = np.zeros(languages.DIMENSIONS, np.int64)
        for run, count in by_hand(text).items():
            # the slot of a run is where a text that holds no other run of its length has its count
            codes = np.array([0 if c == " " else ord(c) for c in run], np.uint32)
            mixed = np.full(1, len(run), np.uint32)
            for i, code in enumerate(codes):
                mixed = (mixed ^ code) * np.uint32(languages._MIX[i])
                mixed ^= mixed >> np.uint32(15)
            wanted[int(mixed[0]) % languages.DIMENSIONS] += count
        assert languages.slot_counts(text).tolist() == wanted.tolist(), text


def test_nearest_centroid_is_found():
    model = languages.fit(
        np.stack([languages.slot_counts(t) for lang in TEXTS for t in texts(lang, 60)]),
        [lang for lang in TEXTS for _ in range(60)],
    )
    assert {model.languages.count(lang) for lang in TEXTS} == {languages.CLUSTERS}
    for lang in TEXTS:
        new = texts(lang, 40, seed=2)
        counts = np.stack([languages.slot_counts(t) for t in new])
        nearest, score, rejected = model.classify(counts)
        assert (nearest == lang).all() and score.min() > 0 and score.max() <= 1
        assert rejected.mean() < 0.1
        for row, best in zip(counts, score, strict=True):
            weight = [(1 + math.log(n)) * model.idf[i] for i, n in enumerate(row) if n]
            length = math.sqrt(sum(w * w for w in weight))
            slots = [i for i, n in enumerate(row) if n]
            cosine = max(
                sum(w / length * point[i] for w, i in zip(weight, slots, strict=True)) for point in model.points
            )
            assert abs(cosine - best) < 1e-8
    far = np.stack([languages.slot_counts("zzz www qqq vvv xxx")])
    nearest, score, rejected = model.classify(far)
    assert rejected.all() and nearest[0] in TEXTS


def test_clusters_follow_the_points():
    points = np.eye(4)[[0, 0, 1, 1, 2, 2, 2]]
    assert sorted(languages.cluster(points, 3).argmax(axis=1)) == [0, 1, 2]
    assert len(languages.cluster(points, 9)) == 3  # never more than distinct points
    assert np.allclose(np.linalg.norm(languages.cluster(points, 2), axis=1), 1)


def table(spark, n=150):
    rows = [(t, lang) for lang in TEXTS for t in texts(lang, n)]
    random.Random(3).shuffle(rows)
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate(rows)]
    rows += [(1000, None, "aa", "x"), (1001, "", None, "x"), (1002, "12 !?", "bb", "x"), (1003, "é", None, "x")]
    rows += [(None, "banana baba", "cc", "x"), rows[0], (1004, "kiki " * 30_000, None, "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, nearest string")


def test_documents_are_identified(spark):
    rows, docs = table(spark)
    model = languages.train(docs, learned_from(F.col("doc_id")))
    found = languages.identify(docs, model)
    assert found.columns == ["doc_id", "lang", "nearest", "score", "rejected"]
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    truth = {i: lang for i, _, lang, _ in rows if lang and i is not None and i < 1000}
    assert all(r.nearest == lang for i, lang in truth.items() for r in got[i])
    for i in (1000, 1001, 1002):
        assert (got[i][0].nearest, got[i][0].score, got[i][0].rejected) == ("und", 0.0, False)
    assert got[1003][0].nearest in TEXTS and got[1004][0].nearest == "bb" and got[None][0].nearest == "aa"
    assert all((r.lang == "und") == (r.rejected or r.nearest == "und") for v in got.values() for r in v)


def test_labels_that_are_held_out_are_not_learned(spark):
    _, docs = table(spark)
    lies = docs.withColumn("lang", F.when(learned_from(F.col("doc_id")), F.col("lang")).otherwise("lie"))
    one = languages.train(docs, learned_from(F.col("doc_id")))
    other = languages.train(lies, learned_from(F.col("doc_id")))
    assert one.languages == other.languages and np.array_equal(one.points, other.points)


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = languages.train(docs, F.lit(True))
    assert [tuple(r) for r in languages.identify(docs, model).collect()] == [(1, "und", "und", 0.0, False)]
    empty = docs.limit(0)
    assert languages.identify(empty, languages.train(empty, F.lit(True))).count() == 0


def test_held_out_documents_of_the_given_table(spark, sf_dir):
    found = QUERIES["op11_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    both = found.join(docs, "doc_id").toPandas()
    assert len(both) == docs.count()
    held_out = both[both.held_out]
    assert len(held_out) > 20 and (held_out.lang_pred == held_out.lang).mean() >= 0.98
    assert both.score.between(0, 1).all()
