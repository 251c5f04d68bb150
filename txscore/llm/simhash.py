"""Near-duplicates by SimHash: fingerprints, multi-index hashing, connected components.

A text is lower-cased (A-Z), cut into words, and every run of `words` words, repeats included, is
hashed by XXH64. A bit of the 64-bit fingerprint is set if it is set in over half the hashes.
Fingerprints link if at most two bits differ. With the fingerprint cut into two segments of 32 bits,
two bits differ in one of three ways: the upper segments are equal, or differ by one bit, or the
lower segments are equal. So there is one table for each way, keyed by one whole segment and
those parts of the other of which one at least must be equal too; one fingerprint of a pair looks
up the Hamming ball of its segment (radius 0 or 1) and each match is verified on all 64 bits. The
parts keep the lists of a table short where thousands of near copies share a segment.

Equal fingerprints are one node, so copies never meet in pairs. Links are verified inside the
join, and components come from repeated minimum labels with pointer jumps, cut off by checkpoints.

Cases: a null or empty text, or one of white space only, has fingerprint zero and is linked like
any other; a text of fewer than `words` words is one shingle. A row with a null id takes part, but
names no component; one whose ids are all null has a null component_id.
Repeated rows come repeatedly. An empty table gives an empty result; other columns are ignored.
Texts are read whole, in parts of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.session import shared_folder

SEED = 42
PART = 1 << 20  # bytes of a very long text that are cut at once
_SPACE = re.compile(b"[\x20\x09-\x0d]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in parts; bytes split at the same six characters as the words do."""
    start = 0
    while len(data) - start > PART:
        found = _SPACE.search(data, start + PART)
        if found is None:
            break
        yield data[start : found.start()].split()
        start = found.start()
    yield data[start:].split()


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in parts; of the whole sequence if it is shorter than one."""
    held: list[bytes] = []
    long_enough = False
    digest = xxhash.xxh64_intdigest
    for more in _words(text.encode().lower()):  # of bytes, only A-Z are lower-cased
        held += more
        n = len(held) - words + 1
        if n > 0:
            long_enough = True
            runs = zip(*(held[i:] for i in range(words)), strict=False)
            yield np.fromiter((digest(b" ".join(run), SEED) for run in runs), np.uint64, n)
            held = held[n:]
    if held and not long_enough:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit number; zero without words."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or "", words):
        for at in range(0, len(hashes), 4096):
            bits = np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8))
            counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, words: int = 3, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id and bits (the fingerprint as a signed long)."""
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    layout = T.StructType([rows.schema[id_column], T.StructField("bits", T.LongType())])

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = [fingerprint(text, words) for text in batch["text"]]
            yield pd.DataFrame({id_column: batch[id_column], "bits": np.array(bits, np.int64)})

    return rows.mapInPandas(mark, layout)


def _cut(bits: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1))


def _keys(segment: Column, other_low: int, widths: list[int], way: int) -> list[Column]:
    """A segment with each part of the other segment, as struct keys of one table."""
    keys, low = [], other_low
    for i, width in enumerate(widths):
        part = F.lit(way * 8 + i).cast("byte")
        keys.append(F.struct(part.alias("part"), segment.alias("segment"),
                             _cut(F.col("bits"), low, width).alias("rest")))
        low += width
    return keys


THIRDS, HALVES = [11, 11, 10], [16, 16]


def links(nodes: DataFrame) -> DataFrame:
    """Columns a, b: every pair of different fingerprints with one or two differing bits.

    `nodes` has one row per fingerprint, in column bits. A pair may come more than once.
    """
    upper, lower = _cut(F.col("bits"), 32, 32), _cut(F.col("bits"), 0, 32)
    same = _keys(upper, 0, THIRDS, 0) + _keys(lower, 32, THIRDS, 1)
    odd = F.bit_count(upper) % 2 == 1
    # upper segments one bit apart are one odd and one even: the odd ones are the table
    ball = F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda i: upper.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    table = nodes.select(F.col("bits").alias("a"), F.explode(F.array(*same)).alias("key")).unionAll(
        nodes.filter(odd).select(
            F.col("bits").alias("a"), F.explode(F.array(*_keys(upper, 0, HALVES, 2))).alias("key")
        )
    )
    around = (
        nodes.filter(~odd)
        .select("bits", F.explode(ball).alias("near"))
        .select(
            F.col("bits").alias("b"),
            F.explode(F.array(*_keys(F.col("near"), 0, HALVES, 2))).alias("key"),
        )
    )
    probes = nodes.select(
        F.col("bits").alias("b"), F.explode(F.array(*same)).alias("key")
    ).unionAll(around)
    flat = ["key.part", "key.segment", "key.rest"]
    table, probes = table.select("a", *flat), probes.select("b", *flat)
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    ball_table = F.col("part") >= 16  # else both sides hold both, and one order is enough
    met = table.join(probes, ["part", "segment", "rest"]).filter(
        (apart <= 2) & (ball_table | (F.col("a") < F.col("b")))
    )
    return met.select("a", "b")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Columns node, label: the least number reachable over edges (a, b), for nodes with edges.

    `nodes` has columns node and label (its own number). Each round takes the least label of all
    neighbours and then jumps to the label's label, so rounds grow with the logarithm of
    the longest path. Every round's labels are checkpointed.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.distinct().checkpoint()
    touched = both.select(F.col("a").alias("node")).distinct()
    labels = nodes.join(touched, "node", "left_semi").select("node", "label").checkpoint()
    while True:
        offered = (
            both.join(labels.select(F.col("node").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("offer"))
        )
        lowered = labels.join(offered, "node").select(
            "node", "label", F.least("label", "offer").alias("next")
        )
        # labels are ids of nodes' first documents, so the owner of a label says where it points
        owner = lowered.groupBy("label").agg(F.min("next").alias("jump"))
        after = (
            lowered.join(owner.withColumnRenamed("label", "next"), "next", "left")
            .select("node", "label", F.least("next", "jump").alias("next"))
            .checkpoint()
        )
        changed = after.filter(~F.col("next").eqNullSafe(F.col("label"))).limit(1).count()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def near_duplicates(
    docs: DataFrame, words: int = 3, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, bits, component_id: the least id reachable over links, one row per document."""
    shared_folder(docs.sparkSession)  # sets the checkpoint folder where the cluster has not
    marked = fingerprints(
        docs, words, id_column=id_column, text_column=text_column
    ).checkpoint()
    nodes = (
        marked.groupBy("bits").agg(F.min(id_column).alias("first")).checkpoint()
    )
    edges = links(nodes.select("bits"))
    known = nodes.select(F.col("bits").alias("node"), F.col("first").alias("label"))
    found = components(known, edges)
    # cut off, so that the join below reads two plain shuffles, which Spark splits where copies abound
    named = (
        nodes.join(found.withColumnRenamed("node", "bits"), "bits", "left")
        .select("bits", F.coalesce("label", "first").alias("component_id"))
        .checkpoint()
    )
    return marked.join(named, "bits").select(id_column, "bits", "component_id")


def as_hex(bits: Column) -> Column:
    """16 lower-case digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def one_of_each(
    docs: DataFrame, words: int = 3, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents, all columns: of each component the row with the least id.

    A row is named by its id and a hash of its text, so rows that share an id but not the text are
    told apart; a row with a null id stands behind all others. Of rows with the same id and text the
    first by a hash of all columns stays. `docs` has whole numbers of less than 2**62 as ids.
    """
    name = next(n for i in range(len(docs.columns) + 1) if (n := f"row_{i}") not in docs.columns)
    wide = F.lit(str(1 << 64)).cast("decimal(20,0)")
    behind = F.coalesce(F.col(id_column).cast("long"), F.lit(1 << 62)).cast("decimal(19,0)") * wide
    own = F.xxhash64(F.coalesce(text_column, F.lit(""))).cast("decimal(20,0)")
    rows = docs.withColumn(name, (behind + own).cast("decimal(38,0)"))
    found = near_duplicates(rows, words, id_column=name, text_column=text_column)
    ids = (
        found.groupBy(name)
        .agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("n"))
        .filter((F.col(name) != F.col("component")) | (F.col("n") > 1))
        .checkpoint()
    )
    # most documents are neither a copy nor repeated and are only looked up
    alone = rows.join(ids.select(name), name, "left_anti")
    repeated = ids.filter(F.col(name) == F.col("component")).select(name)
    first = Window.partitionBy(name).orderBy(F.xxhash64(*docs.columns))
    once = rows.join(repeated, name, "left_semi").withColumn("_place", F.row_number().over(first))
    return alone.unionByName(once.filter("_place = 1").drop("_place")).drop(name)
