"""Language of a text by the nearest of several centroids of each language.

A text is lower-cased, every run of characters that are no letters becomes one space, and its runs of
`ORDERS` characters are hashed into `DIMENSIONS` slots. A slot weighs by `1 + log(count)` and by the
slot's inverse document frequency, and the vector is scaled to length one. The vectors
of each language are clustered on the sphere into `clusters` centroids; a text takes the language of
the centroid with the largest cosine, and the cosine is its score.

Each centroid also has a radius: the distance (1 - cosine) that all but a few of its own texts keep,
and some slack. A text outside the radius of its nearest centroid is `rejected`; what to do with
it is up to the caller, so `nearest` is given beside `lang`, which is `und` for rejected texts.

The model is fitted on a bounded sample: about `max_docs` labelled rows in all, the same number of
each language, chosen by a hash of the id; fewer distinct texts than that are all taken. Counts of
the labels cover all rows. Sampled texts are read whole, where they lie: only their slots, at most
`DIMENSIONS` each, reach the driver. Every whole text of the table is classified.

Cases: a null text, or one without a letter, is `und` with score 0 and not rejected. Without a labelled
row every text is `und`. Null labels are no labels; repeated rows are classified alike, and
counted once in the fit; a null id is kept, and never fitted on. Ties of cosine go to the smaller
language. An empty table gives an empty result; other columns are ignored. Very long texts
are read in parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.llm.registry import unit_hash

UNKNOWN = "und"
DIMENSIONS = 4096  # a power of two
ORDERS = (2, 3)
MAX_DOCS, CLUSTERS, ROUNDS = 1_600, 4, 20
KEPT_INSIDE, SLACK = 0.995, 0.05  # share of its own texts that a radius holds, and what is added
PART = 1 << 18  # characters that are cut at once
TOGETHER = 256  # texts whose vectors are held at once
# fixed values: odd multipliers that mix the characters of a run
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each other one 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[codes], codes, 0)


def slot_counts(text: str) -> np.ndarray:
    """How often each slot is met; all zero for a text without letters."""
    counts = np.zeros(DIMENSIONS, np.int64)
    held = np.zeros(1, np.uint32)  # a text begins after a space
    for start in range(0, len(text) + 1, PART):
        codes = np.append(held, letter_codes(text[start : start + PART]))
        if start + PART > len(text):
            codes = np.append(codes, np.uint32(0))  # and ends before one
        # of a run of spaces the first is kept; what is carried on was kept before
        keep = (codes != 0) | np.append(True, codes[:-1] != 0)
        codes = codes[keep]
        for n in ORDERS:
            # runs of n that end in the new part; those inside what is carried on were counted before
            ahead = codes[max(0, len(held) - n + 1) :]
            if len(ahead) < n:
                continue
            mixed = np.full(len(ahead) - n + 1, n, np.uint32)
            inside = np.zeros(len(mixed), bool)
            for i in range(n):
                part = ahead[i : i + len(mixed)]
                mixed = (mixed ^ part) * np.uint32(_MIX[i])
                mixed ^= mixed >> np.uint32(15)
                inside |= part != 0
            counts += np.bincount(mixed[inside] & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
        held = codes[-(max(ORDERS) - 1) :]
    return counts


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of slot counts as TF-IDF vectors of length one; rows without slots stay zero."""
    weight = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    length = np.linalg.norm(weight, axis=1, keepdims=True)
    return weight / np.maximum(length, 1e-300)


@dataclass
class Centroids:
    """Unit vectors, the language and the radius of each, and the weight of every slot."""

    languages: list[str]
    points: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def classify(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language, cosine and rejection of each row of slot counts."""
        has_letter = counts.any(axis=1)
        if not self.languages:
            n = len(counts)
            return np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
        cosine = np.round(vectors(counts, self.idf) @ self.points.T, 9).clip(0, 1)
        at = cosine.argmax(axis=1)  # the first, so the smaller language
        best = cosine[np.arange(len(at)), at]
        nearest = np.where(has_letter, np.array(self.languages, object)[at], UNKNOWN)
        return nearest, np.where(has_letter, best, 0.0), has_letter & (1 - best > self.radius[at])


def cluster(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k unit centroids of unit vectors: spherical k-means from a farthest-first start."""
    mean = points.sum(axis=0)
    chosen = [int((points @ mean).argmax())]
    nearest = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, points @ points[far])
    centres = points[chosen]
    own = np.full(len(points), -1)
    for _ in range(rounds):
        now = (points @ centres.T).argmax(axis=1)
        if (now == own).all():
            break
        own = now
        sums = np.array([points[own == i].sum(axis=0) for i in range(len(centres)) if (own == i).any()])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


def fit(counts: np.ndarray, labels: list[str], clusters: int = CLUSTERS) -> Centroids:
    """Slot counts of texts with letters, and their languages."""
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    points = vectors(counts, idf)
    of = np.array(labels, object)
    languages: list[str] = []
    centres = []
    radius: list[float] = []
    for language in sorted(set(labels)):
        mine = points[of == language]
        found = cluster(mine, clusters)
        cosine = mine @ found.T
        own = cosine.argmax(axis=1)
        for i in range(len(found)):
            away = 1 - cosine[own == i, i]
            radius.append(float(np.quantile(away, KEPT_INSIDE)) + SLACK if len(away) else SLACK)
        languages += [language] * len(found)
        centres.append(found)
    if not languages:
        return Centroids([], np.zeros((0, DIMENSIONS)), np.zeros(0), idf)
    return Centroids(languages, np.concatenate(centres), np.array(radius), idf)


def train(
    docs: DataFrame,
    usable: Column,
    *,
    max_docs: int = MAX_DOCS,
    clusters: int = CLUSTERS,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> Centroids:
    """Fit on labelled rows for which `usable` (over the id) holds."""
    known = docs.select(
        F.col(id_column), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col(id_column).isNotNull() & usable)
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    each = max(1, max_docs // max(1, len(counts)))
    share = F.lit(1.0)
    for language, n in counts.items():
        share = F.when(F.col("lang") == language, min(1.0, each / n)).otherwise(share)
    chosen = known.filter(unit_hash(id_column) < share).select("lang", "text")
    layout = "lang string, slots array<int>, counts array<long>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                found = slot_counts(text)
                slots = np.flatnonzero(found)
                if len(slots):
                    out.append((lang, slots.astype(np.int32), found[slots]))
            yield pd.DataFrame(out, columns=["lang", "slots", "counts"])

    # copies would count many times; an order of its own makes the fit repeatable
    rows = sorted({
        (r["lang"], tuple(r["slots"]), tuple(r["counts"]))
        for r in chosen.mapInPandas(read, layout).collect()
    })
    dense = np.zeros((len(rows), DIMENSIONS), np.int64)
    for row, (_, slots, found) in zip(dense, rows, strict=True):
        row[list(slots)] = found
    return fit(dense, [lang for lang, _, _ in rows], clusters)


def identify(
    docs: DataFrame, model: Centroids, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, lang (`und` if rejected), nearest, score, rejected."""
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    layout = T.StructType([
        rows.schema[id_column],
        T.StructField("lang", T.StringType()),
        T.StructField("nearest", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.iloc[at : at + TOGETHER]
                counts = np.stack([slot_counts(text or "") for text in part["text"]])
                nearest, score, rejected = sent.value.classify(counts)
                yield pd.DataFrame({
                    id_column: part[id_column],
                    "lang": np.where(rejected, UNKNOWN, nearest),
                    "nearest": nearest,
                    "score": score,
                    "rejected": rejected,
                })

    return rows.mapInPandas(classify, layout)
