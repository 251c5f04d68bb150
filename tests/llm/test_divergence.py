import random
import re
from collections import Counter

import numpy as np

from tests.oracle import both, connect, normal
from txscore.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_hand(docs, min_docs=10, top=10):
    """Rows of (lang, source, part, item, value, rank) from (lang, source, text)."""
    counts, inside, groups = {}, {}, {}
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall(lower(text or ""))
        groups.setdefault(lang, set()).add(source)
        counts.setdefault((lang, source), Counter()).update(terms)
        inside.setdefault(lang, Counter()).update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in inside[lang].items() if n >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def shares(found, kept=kept):
            n = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pairs = [
                (o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept))
                for o in sources - {s}
            ]
            terms = [
                (t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]))
                for t in kept
                if counts[lang, s][t] and p[s][t] > q[t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(ranked)]
    return sorted(out)


def rows(found):
    names = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r[n] for n in names) for r in found.collect())


def documents(n=400, seed=3):
    dice = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "abé" for b in "日xyz" for c in "qrstuvw"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = []
    for _ in range(n):
        lang, source = dice.choice(["en", "en", "de", None]), dice.choice(["a", "b", "c", "é", None])
        words = dice.choices(vocabulary, weights, k=dice.randrange(0, 60))
        words += dice.choices(["Only-" + str(source), "I'm", "UPPER", "Ünïcode", "x1y"], k=3)
        docs.append((lang, source, dice.choice([" ", "\n", "\x01", "5"]).join(words)))
    docs += [("zz", "one", "rare words"), ("zz", "two", None), ("single", "only", "x"), ("en", "bare", "12 34")]
    return docs + docs[:5]


def test_equals_brute_force(spark):
    docs = documents()
    # columns of the same names as those on the way
    df = spark.createDataFrame(
        [(*d, "t", 1, 2) for d in docs], "lang string, source string, text string, term string, n int, salt int"
    )
    assert rows(divergence.audit(df)) == by_hand(docs)
    assert rows(divergence.audit(df, min_docs=2, top=3)) == by_hand(docs, 2, 3)


def test_many_chunks(spark):
    dice = random.Random(8)
    vocabulary = [f"w{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    docs = [
        ("en", dice.choice("pqr"), " ".join(dice.choices(vocabulary, range(1, 677), k=80)))
        for _ in range(300)
    ]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert rows(divergence.audit(df, min_docs=3)) == by_hand(docs, 3)


def test_levels_are_compared_in_blocks(monkeypatch):
    dice = np.random.default_rng(4)
    counts = dice.integers(0, 9, size=(5, 100)) * (dice.random((5, 100)) < 0.7)
    counts[3] = 0
    levels = [
        (s, int(c), int((counts[s] == c).sum()), np.packbits(np.pad(counts[s] == c, (0, 156)), bitorder="little"))
        for s in range(5)
        for c in np.unique(counts[s])
        if c
    ]
    totals, v = counts.sum(axis=1), 100
    p = np.array([divergence.shares(counts[s].tolist(), int(totals[s]), v) for s in range(5)])
    wanted = {(a, b): divergence.apart(p[a], p[b]).sum() for a in range(5) for b in range(a + 1, 5)}
    share = np.array([divergence.shares([c], int(totals[s]), v)[0] for s, c, _, _ in levels])
    none = np.array([divergence.shares([0], int(n), v)[0] for n in totals])
    for cells in (1, 100, 1 << 20):
        monkeypatch.setattr(divergence, "CELLS", cells)
        found = divergence.pair_sums(
            np.array([n for _, _, n, _ in levels]),
            np.array([bits for *_, bits in levels]).view(np.uint64),
            np.array([s for s, *_ in levels]),
            share,
            none,
            v,
        )
        assert {(a, b): t[b] for a, t in found for b in range(a + 1, 5)} == wanted


def test_many_sources_are_not_broadcast(spark, monkeypatch):
    docs = documents(200)
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    monkeypatch.setattr(divergence, "SIDE_LIMIT", -1)
    assert rows(divergence.audit(df)) == by_hand(docs)


def test_counts_are_passed_on_when_many(spark):
    df = spark.createDataFrame(
        [(a or "", b or "", c or "") for a, b, c in documents(100)], "lang string, source string, text string"
    )
    all_at_once, often = (
        divergence.count_terms(df.coalesce(1), most).groupBy("lang", "source", "term").sum("n", "docs")
        for most in (1 << 20, 20)
    )
    assert sorted(all_at_once.collect()) == sorted(often.collect())
    assert divergence.count_terms(df.coalesce(1), 20).count() > all_at_once.count()


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PART", 7)
    found = list(divergence.words("ab cdefghij k lmnopqrstuvw"))
    assert len(found) > 1 and [w for part in found for w in part] == b"ab cdefghij k lmnopqrstuvw".split()


def test_terms_are_those_of_the_pattern():
    dice = random.Random(1)
    for _ in range(300):
        text = "".join(dice.choices("aZ@[`{~\x7f\x80é日0 _-\n", k=30))
        found = [w.decode() for part in divergence.words(text) for w in part]
        assert found == TERM.findall(lower(text))


def test_shares_do_not_overflow():
    assert divergence.shares([10**12], 10**13, 5)[0] == 1 + 10**9 * (10**12 + 2) // (10**13 + 10)
    assert divergence.apart(np.array([10**9 + 1]), np.array([1]))[0] == 10**18 // (10**9 + 2)


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(df).count() == 0


def test_query_equals_sql_on_odd_documents(spark, tmp_path):
    docs = [(i, *d) for i, d in enumerate(documents(300)) if "\x00" not in (d[2] or "")]
    spark.createDataFrame(docs, "doc_id long, lang string, source string, text string").coalesce(
        1
    ).write.parquet(f"{tmp_path}/documents.parquet")
    connection = connect(str(tmp_path / "nothing"))
    connection.execute(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    name = "op12_source_divergence"
    mine, theirs = both(spark, connection, str(tmp_path), queries.QUERIES[name], queries.ORACLES[name])
    assert normal(mine) == normal(theirs) and len(mine) > 0
