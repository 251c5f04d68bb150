import random
import re

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from txscore.llm import queries, simhash


def brute_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    runs = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits


def brute_components(rows):
    """rows: (id, fingerprint). The least id reachable."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 2:
                parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(top(i)), doc_id) if x is not None]
        least[top(i)] = min(known, default=None)
    return [least[top(i)] for i in range(len(rows))]


TEXTS = [None, "", " \n\t", "one", "One TWO", "ÄÖ ÄÖ x", "a b c", "a\xa0b c d\x1ce f", "x " * 9000]


@pytest.mark.parametrize("part", [1 << 20, 7])
def test_fingerprints(monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    dice = random.Random(1)
    texts = TEXTS + [" ".join(dice.choices("ab cd EF é".split(), k=dice.randrange(1, 40))) for _ in range(60)]
    for text in texts:
        assert simhash.fingerprint(text, 3) % 2**64 == brute_fingerprint(text), text


def signed(bits):
    return bits - 2**64 if bits >= 2**63 else bits


def near_numbers(n, seed):
    dice = random.Random(seed)
    numbers = {0, 2**64 - 1}
    while len(numbers) < n:
        base = dice.choice(sorted(numbers)) if dice.random() < 0.9 else dice.getrandbits(64)
        for _ in range(dice.randrange(4)):
            base ^= 1 << dice.choice([0, 1, 10, 11, 21, 31, 32, 33, 47, 48, 63])
        numbers.add(base)
    return sorted(numbers)


def test_no_link_is_lost_and_none_is_made_up(spark):
    numbers = near_numbers(300, 5)
    nodes = spark.createDataFrame([(signed(x),) for x in numbers], "bits long")
    got = {tuple(sorted((r.a % 2**64, r.b % 2**64))) for r in simhash.links(nodes).collect()}
    pairs = {
        (a, b) for a in numbers for b in numbers if a < b and (a ^ b).bit_count() <= 2
    }
    assert got == pairs and len(pairs) > 300


def test_long_chains_get_one_label(spark):
    n = 70
    nodes = spark.createDataFrame([(i, (i * 37) % n + 1000) for i in range(n)], "node long, label long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1) if i != 40], "a long, b long")
    got = {r.node: r.label for r in simhash.components(nodes, edges).collect()}
    first = min((i * 37) % n + 1000 for i in range(41))
    rest = min((i * 37) % n + 1000 for i in range(41, n))
    assert got == {i: first if i <= 40 else rest for i in range(n)}


def test_rows(spark):
    texts = ["a b c d e", "A B C d e", "a b c d e", None, " ", "other words here now", None]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "other words here now", "x", 1)]
    rows += [(None, "nobody knows its id", "x", 1), (2, "a b c d e", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string, component_id int")
    got = simhash.near_duplicates(docs).collect()
    marked = [(r[0], brute_fingerprint(r[1])) for r in rows]
    wanted = [(d, signed(b), c) for (d, b), c in zip(marked, brute_components(marked), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash_links(spark, sf_dir).collect()}
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    marked = [(d, brute_fingerprint(t)) for d, t in docs]
    wanted = {d: (f"{b:016x}", c) for (d, b), c in zip(marked, brute_components(marked), strict=True)}
    assert got == wanted


def test_hex_of_negative_numbers(spark):
    rows = spark.createDataFrame([(-1,), (10,)], "bits long").select(simhash.as_hex(F.col("bits")))
    assert [r[0] for r in rows.collect()] == ["f" * 16, "000000000000000a"]


def test_one_of_each_tells_texts_of_one_id_apart(spark):
    far = " ".join(f"w{i}" for i in range(60))
    rows = [(5, "a b c d e", 1), (5, far, 2), (3, "a b c d e", 3), (9, far.upper(), 4), (None, far, 5),
            (None, "only here " * 9, 6), (3, "a b c d e", 3), (3, "a b c d e", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_0 int")
    kept = simhash.one_of_each(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted(
        [(3, "a b c d e"), (5, far), (0, "only here " * 9)]
    )
    assert kept[0].asDict().keys() == {"doc_id", "text", "row_0"}
    again = simhash.one_of_each(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, kept))
