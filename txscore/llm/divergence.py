"""How far the words of the sources of a language are apart, by count-level bitmaps.

Terms are runs of Latin letters and of characters beyond ASCII, with A-Z lower-cased. A language
keeps the terms that at least `min_docs` of its documents hold. A group (language, source), and each
language as a whole, gives a kept term the smoothed share
`p = 1 + floor(SCALE * (count + 2) / (N + 2 V))`, and two shares are
`f = floor((p - q)^2 / (p + q))` apart; all of it in whole numbers.

- `pair`: f summed over all kept terms, for every two sources of a language, all ranks.
- `term`: the terms a source uses more than its language does, by f, ranks to `top`.

Occurrences are counted per task before they are shuffled. The kept terms of a language, from
frequent to rare, are cut into chunks of `CHUNK`; a chunk stores, for every source and every
count that occurs in it, the set of its terms with that count, as a bitset. Two sources are then
compared level by level: AND and popcount give how many terms have counts (c, d), times f of
both shares; terms that one of them lacks, or both, are the complement. A chunk holds
terms of like frequency, so it has few levels, and its sums are whole numbers that add up.

Cases: null text, language and source are the empty string. Every row is a document, repeated ones
too. A source without terms is compared like any other; where nothing is kept its pairs have
value 0. A language with one source has no pairs. An empty table gives an empty result; other columns
are ignored. Texts are read whole, in parts of bounded size. The result has a row for each ordered
pair of sources of a language, so it grows with the square of their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.session import shared_folder

SCALE = 1_000_000_000
MIN_DOCS, TOP = 10, 10
CHUNK = 256  # terms of a bitset
WORDS = CHUNK // 64
PART = 1 << 20  # bytes of a very long text that are cut at once
HELD = 200_000  # counts that a task holds before it passes them on
CELLS = 1 << 20  # pairs of levels that are compared at once
SIDE_LIMIT = 8 << 20  # bytes of the sources' totals that may be sent to every executor
SALTS = 64  # beyond that, tasks for the chunks of a language

# every byte that no term holds is a space; A-Z become a-z
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in parts, none of them cut."""
    data = text.encode().translate(_LETTERS)
    start = 0
    while len(data) - start > PART:
        stop = data.find(b" ", start + PART)
        if stop < 0:
            break
        yield data[start:stop].split()
        start = stop
    yield data[start:].split()


def count_terms(docs: DataFrame, most: int = HELD) -> DataFrame:
    """Columns lang, source, term, n (occurrences), docs (with the term), in partial sums.

    A task passes its sums on whenever it holds more than `most`.
    """
    names = ["lang", "source", "term", "n", "docs"]

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (found, inside) in held.items():
            terms = list(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array([term.decode() for term in terms], pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                    pa.array([inside[term] for term in terms], pa.int64()),
                ],
                names,
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, inside = held.setdefault((lang, source), (Counter(), Counter()))
                once: set[bytes] = set()
                size -= len(found)
                for part in words(text):
                    found.update(part)
                    once.update(part)
                inside.update(once)
                size += len(found)
                if size > most:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Columns lang, term, total, counts: an entry (source, n) for each source that has the term."""
    counted = count_terms(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    return (
        counted.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("counts"),
        )
        .filter(F.col("docs") >= min_docs)
        .drop("docs")
    )


def level_bitmaps(kept: DataFrame) -> DataFrame:
    """Chunks: lang, terms, totals, levels (source, count, size, bits); one row per chunk.

    A bit says whether the term at that place of `terms` has the count in the source.
    """
    ordered = kept.repartitionByRange("lang", F.desc("total"), "term").sortWithinPartitions(
        "lang", F.desc("total"), "term"
    )
    level = pa.struct([
        ("source", pa.string()), ("count", pa.int64()), ("size", pa.int64()), ("bits", pa.binary())
    ])

    def chunk(lang: str, rows: list[tuple]) -> pa.RecordBatch:
        sets: dict[tuple[str, int], int] = {}
        for place, (_, _, counts) in enumerate(rows):
            for entry in counts:
                key = (entry["source"], entry["n"])
                sets[key] = sets.get(key, 0) | 1 << place
        levels = [
            {"source": s, "count": n, "size": bits.bit_count(), "bits": bits.to_bytes(CHUNK // 8, "little")}
            for (s, n), bits in sorted(sets.items())
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()),
                pa.array([[term for term, _, _ in rows]], pa.list_(pa.string())),
                pa.array([[total for _, total, _ in rows]], pa.list_(pa.int64())),
                pa.array([levels], pa.list_(level)),
            ],
            ["lang", "terms", "totals", "levels"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = "", []
        for batch in batches:
            for lang, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (lang != at or len(rows) == CHUNK):
                    yield chunk(at, rows)
                    rows = []
                at = lang
                rows.append(tuple(row))
        if rows:
            yield chunk(at, rows)

    return ordered.select("lang", "term", "total", "counts").mapInArrow(
        cut,
        "lang string, terms array<string>, totals array<long>,"
        " levels array<struct<source: string, count: long, size: long, bits: binary>>",
    )


def shares(counts: list[int], n: int, v: int) -> np.ndarray:
    """Whole-numbered shares of counts of a group with n occurrences of v kept terms."""
    return np.array([1 + SCALE * (count + 2) // (n + 2 * v) for count in counts], np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """At most (SCALE + 1)^2 on the way, which 64 bits hold."""
    return (p - q) ** 2 // (p + q)


def pair_sums(
    sizes: np.ndarray, bits: np.ndarray, owner: np.ndarray, share: np.ndarray, none: np.ndarray, n_terms: int
) -> Iterator[tuple[int, np.ndarray]]:
    """For each source, by number, f summed over a chunk's terms against all sources after it.

    Levels come in order of their source (`owner`), with the size and bits of their set and the
    share of their count; `none` has each source's share of a term it lacks.
    """
    n_sources = len(none)
    present = np.bincount(owner, sizes, n_sources).astype(np.int64)
    bounds = np.searchsorted(owner, np.arange(n_sources + 1))
    for a in range(n_sources):
        mine = slice(bounds[a], bounds[a + 1])
        total = np.zeros(n_sources, np.int64)
        both = np.zeros(n_sources, np.int64)
        # terms of a that the other lacks: what no level of the other takes away
        alone = np.repeat(sizes[mine][:, None], n_sources, axis=1)
        step = max(1, CELLS // max(1, WORDS * (mine.stop - mine.start)))
        for low in range(bounds[a + 1], len(owner), step):
            high = min(len(owner), low + step)
            met = bits[mine][:, None, :] & bits[None, low:high]
            cells = np.bitwise_count(met).sum(axis=2, dtype=np.int64)
            i, j = np.nonzero(cells)
            other = owner[low + j]
            joint = cells[i, j]
            np.add.at(total, other, joint * apart(share[mine][i], share[low + j]))
            np.add.at(both, other, joint)
            np.subtract.at(alone, (i, other), joint)
            rest = sizes[low:high] - cells.sum(axis=0)
            np.add.at(total, owner[low:high], rest * apart(none[a], share[low:high]))
        total += (alone * apart(share[mine][:, None], none[None, :])).sum(axis=0)
        neither = n_terms - present[a] - present + both
        total += neither * apart(none[a], none)
        yield a, total


def chunk_values(
    terms: list[str], totals: list[int], levels: list[dict], groups: list[dict], v: int, top: int
) -> Iterator[tuple[str, str, str, int]]:
    """Rows (source, part, item, value) of one chunk: partial sums of pairs, best terms per source."""
    names = [g["source"] for g in groups]
    if not terms:
        yield from ((a, "pair", b, 0) for i, a in enumerate(names) for b in names[i + 1 :])
        return
    number = {name: i for i, name in enumerate(names)}
    levels = sorted(levels, key=lambda one: number[one["source"]])
    owner = np.array([number[one["source"]] for one in levels], np.int64)
    sizes = np.array([one["size"] for one in levels], np.int64)
    raw = np.frombuffer(b"".join(one["bits"] for one in levels), np.uint8).reshape(-1, CHUNK // 8)
    ns = [g["n"] for g in groups]
    share = np.array([shares([one["count"]], ns[o], v)[0] for one, o in zip(levels, owner, strict=True)])
    none = np.array([shares([0], n, v)[0] for n in ns])
    for a, total in pair_sums(sizes, raw.view(np.uint64), owner, share, none, len(terms)):
        yield from ((names[a], "pair", names[b], int(total[b])) for b in range(a + 1, len(names)))
    whole = shares(totals, sum(ns), v)
    order = np.argsort(np.array([term.encode() for term in terms], object), kind="stable")
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    level, place = np.nonzero(np.unpackbits(raw, axis=1, bitorder="little"))
    more = share[level] > whole[place]
    level, place = level[more], place[more]
    value = apart(share[level], whole[place])
    for a in np.unique(owner[level]):
        mine = np.flatnonzero(owner[level] == a)
        best = mine[np.lexsort((rank[place[mine]], -value[mine]))[:top]]
        yield from ((names[a], "term", terms[place[i]], int(value[i])) for i in best)


def with_totals(chunks: DataFrame, groups: DataFrame) -> DataFrame:
    """Chunks, and an empty one per language, with what is known of its sources."""
    sources = (
        chunks.select("lang", F.explode("levels").alias("level"))
        .groupBy("lang", F.col("level.source").alias("source"))
        .agg(F.sum(F.col("level.count") * F.col("level.size")).alias("n"))
    )
    known = groups.join(sources, ["lang", "source"], "left").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("groups")
    )
    sizes = chunks.groupBy("lang").agg(F.sum(F.size("terms")).alias("v"))
    side = known.join(sizes, "lang", "left").select(
        "lang", "groups", F.coalesce("v", F.lit(0)).alias("v")
    ).checkpoint()
    empty = side.select("lang", *[F.array().cast(chunks.schema[c].dataType).alias(c) for c in ("terms", "totals", "levels")])
    rows = chunks.unionByName(empty)
    wide = F.aggregate(
        "groups", F.lit(0).cast("long"), lambda sum, g: sum + F.octet_length(g["source"]) + 32
    )
    if (side.agg(F.sum(wide).alias("b")).first()["b"] or 0) <= SIDE_LIMIT:
        return rows.join(F.broadcast(side), "lang")
    # the chunks of one language spread over tasks of their own
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.pmod(F.xxhash64("terms"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", own).join(salted, ["lang", "salt"]).drop("salt")


def audit(
    docs: DataFrame,
    *,
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """Columns lang, source, part, item, value, rank."""
    shared_folder(docs.sparkSession)  # sets the checkpoint folder where the cluster has not
    rows = docs.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))
        ]
    )
    chunks = level_bitmaps(kept_terms(rows, min_docs)).checkpoint()
    joined = with_totals(chunks, rows.select("lang", "source").distinct())

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lang, terms, totals, levels, groups, v = (c[i].as_py() for c in batch.columns)
                found = list(chunk_values(terms, totals, levels, groups, v, top))
                source, part, item, value = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(found), pa.string()),
                        pa.array(source, pa.string()),
                        pa.array(part, pa.string()),
                        pa.array(item, pa.string()),
                        pa.array(value, pa.int64()),
                    ],
                    ["lang", "source", "part", "item", "value"],
                )

    columns = ["lang", "terms", "totals", "levels", "groups", "v"]
    found = joined.select(*columns).mapInArrow(
        values, "lang string, source string, part string, item string, value long"
    )
    # a term stands in one chunk, so its sum is itself
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).checkpoint()
    pairs = summed.filter(F.col("part") == "pair")
    back = pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [
        rows.withColumn("rank", F.row_number().over(order))
        for rows in (pairs.unionAll(back), summed.filter(F.col("part") == "term"))
    ]
    # every task cuts its terms to `top` of a group before they meet
    return ranked[0].unionAll(ranked[1].filter(F.col("rank") <= top))
