"""Toxic spans and document scores by a linear-chain conditional random field.

The chain runs over the words of a sentence, each word toxic or not. Its potentials are a weight per
feature of the word (itself, and how it begins) and one per pair of neighbouring states; forward and backward messages of two states are
log-odds, so each is one number per word. A document's score is a logistic function of what the
marginals say about it: the expected number of toxic words, its logarithm, the largest marginal and
the expected share. Words whose marginal is at least one half are its offending spans.

Only documents are labelled, so labelled words are derived first: of the features that nearly only
toxic documents hold, those that explain most toxic documents not yet explained are taken one by
one (names that are repeated in a few copies explain little and stay out), and words that have one
are labelled toxic. The model is fitted on a bounded sample of labelled rows, `max_toxic` and
`max_clean` documents of at most `max_chars` characters, chosen by a hash of the id, and of their
sentences on those with a toxic word and `MAX_SENTENCES` others; the shares of both labels are
counted over all labelled rows. Scores are given to every whole text.

Cases: a null text is empty; an empty text has the score of no evidence and no spans. A label that
is null is no label, and of several for a document the toxic one counts. If one label or both have
no row in the sample, every score is the share of toxic rows among the labelled ones (0 without
any). A null id is kept; repeated rows are scored alike; an empty table gives an empty result; other
columns are ignored. Very long texts are read in parts.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.llm.chunks import parts
from txscore.llm.registry import unit_hash

MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1_200, 1_600, 20_000
MAX_SENTENCES = 30_000
STARTS = (4, 5, 6)  # lengths of word beginnings that are features
WAYS = 1 + len(STARTS)  # features of a word at most
KNOWN_FORMS = 200_000  # of words with their punctuation, that one process remembers
_STRIP = re.compile(r"^[\W_]+|[\W_]+$")
_RUN = re.compile(r"\S+")
SENTENCE_ENDS = ".!?"


def normal(form: str) -> str:
    return _STRIP.sub("", form.lower())


def features(word: str) -> list[str]:
    return ["=" + word, *["^" + word[:n] for n in STARTS if len(word) >= n]]


@dataclass
class Chain:
    """Feature weights by number (the last is of no feature) and pair weights [from, to]."""

    vocabulary: dict[str, int]
    weight: np.ndarray
    pair: np.ndarray
    document: np.ndarray | None = None
    constant: float = 0.0
    forms: dict[str, int] = field(default_factory=dict, repr=False)
    numbers: array = field(default_factory=lambda: array("i"), repr=False)  # of features, by form

    def codes(self, text: str) -> np.ndarray:
        """Of each run without white space: twice its form's number, plus one at a sentence's end."""
        found = []
        for part in parts(text):
            forms = part.split()
            known = self.forms
            for form in set(forms).difference(known):
                known[form] = 2 * (len(self.numbers) // WAYS) + (form[-1] in SENTENCE_ENDS)
                self.numbers.extend(self._features_of(form))
            found.append(np.fromiter(map(known.__getitem__, forms), np.int32, len(forms)))
        return np.concatenate(found)

    def _features_of(self, form: str) -> list[int]:
        none = len(self.vocabulary)
        mine = [self.vocabulary.get(name, none) for name in features(normal(form))]
        return mine + [none] * (WAYS - len(mine))

    def form_features(self) -> np.ndarray:
        # a copy, as an array that is looked at cannot grow
        return np.array(self.numbers, np.int32).reshape(-1, WAYS)

    def form_weights(self) -> np.ndarray:
        return self.weight[self.form_features()].sum(axis=1)

    def forget(self) -> None:
        """Between batches, so that what is known of forms stays bounded."""
        if len(self.forms) > KNOWN_FORMS:
            self.forms, self.numbers = {}, array("i")

    def marginals(self, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probability that each word is toxic; `starts` are the sentences' first words."""
        ahead, behind = self.messages(weights, starts)
        return sigmoid(ahead + behind)

    def messages(self, weights: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of the forward messages, with the word's own weight, and of the backward ones."""
        lengths = np.diff(np.append(starts, len(weights)))
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        ahead, behind = np.empty_like(weights), np.zeros_like(weights)
        if not len(starts):
            return ahead, behind
        # how many sentences have more than t words
        alive = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
        (a00, a01), (a10, a11) = self.pair
        ahead[starts] = weights[starts]
        for t in range(1, lengths[0]):
            at = starts[: alive[t]] + t
            before = ahead[at - 1]
            ahead[at] = weights[at] + np.logaddexp(a01, a11 + before) - np.logaddexp(a00, a10 + before)
        for t in range(lengths[0] - 2, -1, -1):
            at = starts[: alive[t + 1]] + t
            after = weights[at + 1] + behind[at + 1]
            behind[at] = np.logaddexp(a10, a11 + after) - np.logaddexp(a00, a01 + after)
        return ahead, behind

    def read(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        """Marginals of the words of each document."""
        sizes = [len(one) for one in codes]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        firsts = np.cumsum([0, *sizes])[:-1]
        weights = self.form_weights()[flat >> 1]
        starts = sentence_starts(flat, firsts[np.array(sizes, int) > 0])
        probability = self.marginals(weights, starts)
        return np.split(probability, firsts[1:]) if codes else []

    def score(self, marginals: list[np.ndarray]) -> np.ndarray:
        if self.document is None:
            return np.full(len(marginals), self.constant)
        return sigmoid(evidence(marginals) @ self.document)

    def spans(self, text: str, marginals: np.ndarray) -> list[tuple[int, int]]:
        """Code points, end exclusive; neighbouring toxic words are one span."""
        toxic = marginals >= 0.5
        if not toxic.any():
            return []
        found: list[tuple[int, int]] = []
        last = -2
        for i, run in enumerate(_RUN.finditer(text)):
            if toxic[i]:
                if i == last + 1:
                    found[-1] = (found[-1][0], run.end())
                else:
                    found.append(run.span())
                last = i
        return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def sentence_starts(codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    begins = np.zeros(len(codes) + 1, bool)
    begins[firsts] = True
    begins[1:] |= (codes & 1).astype(bool)
    return np.flatnonzero(begins[:-1])


def evidence(marginals: list[np.ndarray]) -> np.ndarray:
    """What a document's marginals say, with a constant in front."""
    total = np.array([one.sum() for one in marginals])
    most = np.array([one.max(initial=0) for one in marginals])
    size = np.array([max(1, len(one)) for one in marginals])
    return np.stack(
        [np.ones(len(total)), np.minimum(total, 5), np.log1p(total), most, np.sqrt(total / size)], axis=1
    )


def toxic_features(docs: list[set[str]], toxic: np.ndarray) -> set[str]:
    """Features that nearly only toxic documents hold, one by one those that explain most more.

    `docs` holds the features of each document.
    """
    inside, outside = Counter(), Counter()
    for names, label in zip(docs, toxic, strict=True):
        (inside if label else outside).update(names)
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    least = max(3, n_toxic // 100)
    able = {
        name
        for name, n in inside.items()
        if n >= least and outside[name] / n_clean < 0.05 * n / n_toxic
    }
    left = [names & able for names, label in zip(docs, toxic, strict=True) if label]
    chosen: set[str] = set()
    counts = Counter(name for names in left for name in names)
    while counts:
        # of equals the longest, as it says most
        best = max(counts, key=lambda name: (counts[name], len(name), name))
        if counts[best] < least:
            break
        chosen.add(best)
        for names in left:
            if best in names:
                counts.subtract(names)
        left = [names for names in left if best not in names]
    # one that is in many toxic documents is as toxic, even if others explain those already
    spread = max(least, n_toxic // 20)
    return chosen | {name for name in able if inside[name] >= spread and name != "="}


def fit_chain(
    chain: Chain, codes: np.ndarray, starts: np.ndarray, labels: np.ndarray,
    rounds: int = 60, strength: float = 1e-3,
) -> None:
    """Maximum conditional likelihood with squared weights held small, by adaptive gradient steps."""
    forms, rows = np.unique(codes >> 1, return_inverse=True)
    numbers = chain.form_features()[forms]
    n = len(chain.weight)
    first = np.zeros(len(codes), bool)
    first[starts] = True
    inner = np.flatnonzero(~first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[inner - 1].astype(int), labels[inner].astype(int)), 1)
    mean, square = np.zeros(n + 4), np.zeros(n + 4)
    for step in range(1, rounds + 1):
        weights = chain.weight[numbers].sum(axis=1)[rows]
        ahead, behind = chain.messages(weights, starts)
        wrong = np.bincount(rows, labels - sigmoid(ahead + behind), len(forms))
        joint = np.stack([
            chain.pair[a, b] + a * ahead[inner - 1] + b * (weights[inner] + behind[inner])
            for a in (0, 1)
            for b in (0, 1)
        ])
        joint = np.exp(joint - joint.max(axis=0, initial=-np.inf))
        expected = (joint / joint.sum(axis=0)).sum(axis=1)
        by_feature = np.bincount(numbers.ravel(), np.repeat(wrong, numbers.shape[1]), n)
        gradient = np.concatenate([by_feature, seen.ravel() - expected]) / max(1, labels.sum())
        gradient -= strength * np.concatenate([chain.weight, chain.pair.ravel()])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        chain.weight = chain.weight + move[:n]
        chain.pair = chain.pair + move[n:].reshape(2, 2)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (y - p)) - ridge * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        move = np.linalg.solve(bend, slope)
        beta = beta + move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return beta


def some_sentences(starts: np.ndarray, marked: np.ndarray) -> list[tuple[int, int]]:
    """All sentences with a marked word, and of the others evenly spaced ones."""
    stops = np.append(starts[1:], len(marked))
    toxic = np.add.reduceat(marked.astype(int), starts) > 0
    others = np.flatnonzero(~toxic)
    step = max(1, -(-len(others) // MAX_SENTENCES))
    taken = np.sort(np.concatenate([np.flatnonzero(toxic), others[::step]]))
    return list(zip(starts[taken].tolist(), stops[taken].tolist(), strict=True))


def fit(texts: list[str], toxic: np.ndarray, share: float) -> Chain:
    """`share`: of toxic rows among all labelled ones, to which the sample is weighted."""
    toxic = np.asarray(toxic, bool)
    if not toxic.any() or toxic.all():
        return Chain({}, np.zeros(1), np.zeros((2, 2)), constant=share)
    named: dict[str, list[str]] = {}
    docs: list[set[str]] = []
    for text in texts:
        forms = set(text.split())
        named.update((form, features(normal(form))) for form in forms.difference(named))
        docs.append({name for form in forms for name in named[form]})
    bad = toxic_features(docs, toxic)
    counts = Counter(name for names in docs for name in names)
    kept = sorted(name for name, n in counts.items() if n >= 3 or name in bad)
    vocabulary = {name: i for i, name in enumerate(kept)}
    chain = Chain(vocabulary, np.zeros(len(kept) + 1), np.zeros((2, 2)))
    all_codes = [chain.codes(text) for text in texts]
    bad_form = np.zeros(len(chain.forms), bool)
    for form, code in chain.forms.items():
        bad_form[code >> 1] = not bad.isdisjoint(named[form])
    del named, docs, counts
    chosen = [
        (codes, bad_form[codes >> 1] & label)
        for codes, label in zip(all_codes, toxic, strict=True)
        # left out: empty, or toxic for a reason that no word shows
        if len(codes) and not (label and not bad_form[codes >> 1].any())
    ]
    if not any(marked.any() for _, marked in chosen):
        return Chain({}, np.zeros(1), np.zeros((2, 2)), constant=share)
    codes = np.concatenate([one for one, _ in chosen])
    marked = np.concatenate([one for _, one in chosen])
    firsts = np.cumsum([0, *[len(one) for one, _ in chosen]])[:-1]
    keep = some_sentences(sentence_starts(codes, firsts), marked)
    inside = np.zeros(len(codes), bool)
    first = np.zeros(len(codes), bool)
    for start, stop in keep:
        inside[start:stop] = first[start] = True
    fit_chain(chain, codes[inside], np.flatnonzero(first[inside]), marked[inside].astype(float))
    x = evidence(chain.read(all_codes))
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    chain.document = fit_logistic(x, toxic.astype(float), weight)
    chain.forms, chain.numbers = {}, array("i")
    return chain


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    *,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    max_chars: int = MAX_CHARS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Chain:
    """Fit on labelled rows for which `usable` (over the id) holds."""
    known = (
        labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & usable)
        .groupBy(id_column)
        .agg(F.max(F.col(label_column).cast("int")).alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    # about max_toxic + max_clean ids, so small enough for every executor
    part = F.when(F.col("label") == 1, max_toxic / max(1, counts.get(1, 0))).otherwise(
        max_clean / max(1, counts.get(0, 0))
    )
    chosen = known.filter(unit_hash(id_column) < part)
    rows = (
        docs.select(id_column, F.coalesce(text_column, F.lit("")).alias("text"))
        .filter(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), id_column)
        .groupBy(id_column, "label")
        .agg(F.max("text").alias("text"))
        .select("text", "label")
        .collect()
    )
    # copies would count many times; an order of its own makes the fit repeatable
    unique = sorted({(r["text"], r["label"]) for r in rows})
    return fit([text for text, _ in unique], np.array([label for _, label in unique], bool), share)


def score_documents(
    docs: DataFrame, chain: Chain, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, score, and spans: an array of (start, end), as code points."""
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    layout = T.StructType([
        rows.schema[id_column],
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())
        ]))),
    ])
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            for at in range(0, len(texts), 512):
                part = texts[at : at + 512]
                model.forget()
                marginals = model.read([model.codes(text) for text in part])
                yield pd.DataFrame({
                    id_column: batch[id_column].iloc[at : at + 512],
                    "score": model.score(marginals),
                    "spans": [
                        [{"start": a, "end": b} for a, b in model.spans(text, one)]
                        for text, one in zip(part, marginals, strict=True)
                    ],
                })

    return rows.mapInPandas(score, layout)


def drop_toxic(
    docs: DataFrame, chain: Chain, threshold: float = 0.7, *, text_column: str = "text"
) -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                model.forget()
                codes = [model.codes(text or "") for text in part[text_column]]
                yield part[model.score(model.read(codes)) < threshold]

    return docs.mapInPandas(keep, docs.schema)
