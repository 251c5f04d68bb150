"""Secrets in texts: three fixed patterns, and a character network over every other candidate.

The patterns give kinds assign (the value after a name like `password`), access and hex. Every other
run of at least 12 key characters is a candidate, and of a run that holds findings what is left
beside them, if that is as long. A convolutional network in numpy
reads it with its surroundings: embedded characters, filters of five characters, the largest
answer of each filter, one logistic unit. Long candidates are read window by window and the
highest answer counts. It is fitted on labelled findings, what the patterns find (1) against
other candidates (0): at most 2,000 different windows each of the findings of all documents, and of
the candidates with a digit and without one of about 20,000 documents, chosen by a hash. All findings
and all candidates of the table are then scored and counted in bins of the score. From those counts
the probability is calibrated and the threshold set: the highest at which the asked recall of the
findings holds, or `floor` if that is higher. `Network.recall` is the recall at the threshold.
Candidates above it are added, as kind model.

Cases: a null or empty text has no findings. Equal starts go by kind in the order above. Without
findings, or without other candidates in the sample, nothing is added. A null id is kept; repeated
rows are scanned alike; an empty table gives an empty result; other columns are ignored by
`find_secrets` and kept by `redact`. All texts are scanned whole, each run once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.llm.registry import unit_hash
from txscore.session import shared_folder

# fixed values: pattern, group and least length of each kind
PATTERNS = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        12,
    ),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile("[0-9a-f]+"), 0, 16),
}
KINDS = (*PATTERNS, "model")
# runs of at least the least length are all that can match; shorter ones need no look
_LONG_HEX = re.compile("[0-9a-f]{16,}")
LEAST = 12
_RUN = re.compile(f"[A-Za-z0-9+/_=.-]{{{LEAST},}}")
_DIGIT = re.compile("[0-9]")

MAX_DOCS, MAX_EXAMPLES = 20_000, 2_000  # of the candidates; of each group
BINS, TOP = 64, 64  # bins for each unit of the raw score, which is cut off at -TOP and TOP
BEFORE, INSIDE, AFTER = 24, 64, 8
STEP = 48  # of the windows of a long candidate
WIDTH, EMBEDDED, FILTERS = 5, 10, 24
RECALL = 0.99
_LENGTH = BEFORE + INSIDE + AFTER
_OTHER, _NOTHING = 95, 96  # characters beyond printable ASCII, and beyond the text


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind, by start and then kind."""
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        if kind == "hex":
            pattern = _LONG_HEX
        for match in pattern.finditer(text):
            start, end = match.span(group)
            if end - start >= least:
                found.append((start, order, end, kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs, or what findings leave of them. `taken` is by start."""
    found, at = [], 0
    for match in _RUN.finditer(text):
        start, end = match.span()
        while start < end:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            begins = taken[at][0] if at < len(taken) else end
            if min(end, begins) - start >= LEAST:
                found.append((start, min(end, begins)))
            start = end if begins >= end else taken[at][1]
    return found


def other_candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Only the candidates with a digit."""
    return [(a, b) for a, b in candidates(text, taken) if _DIGIT.search(text, a, b)]


def windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """Before, inside and after, for each window of a candidate."""
    found = []
    for at in range(start, max(start + 1, end - INSIDE + STEP), STEP):
        stop = min(end, at + INSIDE)
        found.append((text[max(0, at - BEFORE) : at], text[at:stop], text[stop : stop + AFTER]))
        if stop == end:
            break
    return found


def coded(parts: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Characters and where the candidate is, one row per window."""
    rows = "".join(
        before.rjust(BEFORE, "\0") + inside.ljust(INSIDE, "\0") + after.ljust(AFTER, "\0")
        for before, inside, after in parts
    )
    codes = np.frombuffer(rows.encode("utf-32-le"), np.uint32).reshape(-1, _LENGTH).astype(np.int64)
    ids = np.where((codes >= 32) & (codes < 127), codes - 32, np.where(codes == 0, _NOTHING, _OTHER))
    at = np.arange(_LENGTH) - BEFORE
    sizes = np.array([len(inside) for _, inside, _ in parts])
    return ids, ((at >= 0) & (at < sizes[:, None])).astype(float)


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float = 0.0
    slope: float = 1.0  # of the calibration
    shift: float = 0.0
    threshold: float = 2.0  # above any probability
    recall: float = 0.0  # of the findings, at the threshold

    def forward(self, ids: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows of the input, the largest answer of each filter, where it is, and the raw score."""
        x = np.concatenate([self.embedding[ids], inside[:, :, None]], axis=2)
        spans = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
        spans = spans.transpose(0, 1, 3, 2).reshape(len(ids), _LENGTH - WIDTH + 1, -1)
        answers = spans @ self.filters + self.bias
        best = answers.argmax(axis=1)
        top = np.maximum(np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0], 0)
        return spans, top, best, top @ self.out + self.offset

    def raw(self, parts: list[tuple[str, str, str]]) -> np.ndarray:
        raw = [
            self.forward(*coded(parts[at : at + 512]))[3] for at in range(0, len(parts), 512)
        ]
        return np.concatenate(raw or [np.zeros(0)])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * raw + self.shift)

    def probability(self, parts: list[tuple[str, str, str]]) -> np.ndarray:
        return self.calibrated(self.raw(parts))

    def of_candidates(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        return self.calibrated(self.raw_of_candidates(text, spans))

    def raw_of_candidates(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        parts, owner = [], []
        for i, (start, end) in enumerate(spans):
            mine = windows(text, start, end)
            parts += mine
            owner += [i] * len(mine)
        best = np.full(len(spans), -np.inf)
        np.maximum.at(best, np.array(owner, int), self.raw(parts))
        return best

    def set_threshold(
        self, raw: np.ndarray, y: np.ndarray, counts: np.ndarray, recall: float, floor: float = 0.0
    ) -> None:
        """Calibrate on counted scores; the highest threshold at which `recall` of the ones holds.

        A score stands for those from it up to the next.
        """
        self.slope, self.shift = calibrate(raw, y, counts)
        self.slope = max(self.slope, 1e-6)  # a higher score is never less likely
        ones = y == 1
        order = np.argsort(-raw[ones])
        reached = np.cumsum(counts[ones][order]) / max(1, counts[ones].sum())
        if len(reached):
            least = raw[ones][order][np.argmax(reached >= min(recall, reached[-1]))]
            self.threshold = max(float(self.calibrated(least)) - 1e-12, floor)
            kept = self.calibrated(raw[ones]) >= self.threshold
            self.recall = float(counts[ones][kept].sum() / counts[ones].sum())


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _slopes(net: Network, ids: np.ndarray, inside: np.ndarray, wrong: np.ndarray) -> list[np.ndarray]:
    """Of the mean log-likelihood, for embedding, filters, bias, out and offset."""
    spans, top, best, _ = net.forward(ids, inside)
    n = len(ids)
    back = wrong[:, None] * net.out * (top > 0) / n  # rows by filters
    met = np.take_along_axis(spans, best[:, :, None], axis=1)  # rows, filters, inputs
    filters = np.einsum("nf,nfi->if", back, met)
    into = (back[:, :, None] * net.filters.T).reshape(n, FILTERS, WIDTH, EMBEDDED + 1)[..., :EMBEDDED]
    embedding = np.zeros_like(net.embedding)
    chars = np.take_along_axis(ids[:, None, :], best[:, :, None] + np.arange(WIDTH), axis=2)
    np.add.at(embedding, chars, into)
    return [embedding, filters, back.sum(axis=0), top.T @ wrong / n, np.array(wrong.mean())]


def fit_network(
    positive: list[tuple[str, str, str]], negative: list[tuple[str, str, str]],
    *, recall: float = RECALL, epochs: int = 20,
) -> Network:
    """Fitted on four fifths, calibrated on the rest; on all if there are fewer than five of a kind.

    Without both kinds it finds nothing.
    """
    dice = np.random.default_rng(11)
    inputs = WIDTH * (EMBEDDED + 1)
    net = Network(
        dice.normal(size=(97, EMBEDDED)) * 0.5,
        dice.normal(size=(inputs, FILTERS)) / np.sqrt(inputs),
        np.zeros(FILTERS),
        dice.normal(size=FILTERS) * 0.3,
    )
    if not positive or not negative:
        return net
    ids, inside = coded(positive + negative)
    y = np.repeat([1.0, 0.0], [len(positive), len(negative)])
    order = dice.permutation(len(y))
    kept = order
    if min(len(positive), len(negative)) >= 5:
        kept, order = order[::5], np.delete(order, slice(None, None, 5))
    names = ["embedding", "filters", "bias", "out", "offset"]
    mean = [np.zeros_like(np.asarray(getattr(net, name), float)) for name in names]
    square = [m.copy() for m in mean]
    step = 0
    for _ in range(epochs):
        order = dice.permutation(order)
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            wrong = y[rows] - _logistic(net.forward(ids[rows], inside[rows])[3])
            step += 1
            for i, slope in enumerate(_slopes(net, ids[rows], inside[rows], wrong)):
                mean[i] = 0.9 * mean[i] + 0.1 * slope
                square[i] = 0.999 * square[i] + 0.001 * slope**2
                move = (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
                setattr(net, names[i], getattr(net, names[i]) + 0.005 * move)
    parts = positive + negative
    raw = net.raw([parts[i] for i in kept])
    net.set_threshold(raw, y[kept], np.ones(len(kept)), recall)
    return net


def calibrate(raw: np.ndarray, y: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with targets drawn in a little where few rows are."""
    ups, downs = (counts * y).sum(), (counts * (1 - y)).sum()
    goal = np.where(y == 1, (ups + 1) / (ups + 2), 1 / (downs + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    for _ in range(100):
        p = _logistic(x @ beta)
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(bend, x.T @ (counts * (goal - p)))
        beta = beta + move * min(1.0, 1 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def examples(
    docs: DataFrame, *, max_docs: int = MAX_DOCS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Windows of the findings of all documents and of other candidates of about `max_docs`.

    Columns label, digit (whether the candidate has one), before, inside, after.
    """
    share = max_docs / max(1, docs.count())
    rows = docs.select(
        F.coalesce(text_column, F.lit("")).alias("text"),
        (F.col(id_column).isNotNull() & (unit_hash(id_column) < share)).alias("chosen"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, chosen in zip(batch["text"], batch["chosen"], strict=True):
                base = base_findings(text)
                spans = [(1, a, b) for a, b, _ in base]
                spans += [(0, a, b) for a, b in candidates(text, base)] if chosen else []
                out += [
                    (label, bool(_DIGIT.search(text, a, b)), *windows(text, a, b)[0])
                    for label, a, b in spans
                ]
            yield pd.DataFrame(out, columns=["label", "digit", "before", "inside", "after"])

    return rows.mapInPandas(
        cut, "label int, digit boolean, before string, inside string, after string"
    )


def score_counts(docs: DataFrame, net: Network, *, text_column: str = "text") -> DataFrame:
    """Columns label, bin and n: all findings (1) and other candidates (0) by their raw score."""
    rows = docs.select(F.coalesce(text_column, F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch["text"]:
                base = base_findings(text)
                spans = [(a, b) for a, b, _ in base]
                others = candidates(text, base)
                if spans or others:
                    raw = sent.value.raw_of_candidates(text, spans + others)
                    bins = np.floor(np.clip(raw, -TOP, TOP) * BINS).astype(int).tolist()
                    counts.update((int(i < len(spans)), at) for i, at in enumerate(bins))
            yield pd.DataFrame(
                [(*key, n) for key, n in counts.items()], columns=["label", "bin", "n"]
            )

    found = rows.mapInPandas(count, "label int, bin int, n long")
    return found.groupBy("label", "bin").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, *, max_docs: int = MAX_DOCS, max_examples: int = MAX_EXAMPLES,
    recall: float = RECALL, floor: float = 0.0, id_column: str = "doc_id", text_column: str = "text",
) -> Network:
    """Fitted on at most `max_examples` windows of each group; threshold and calibration by all rows.

    With a `floor` no candidate less likely than it is added, and the recall may be below the asked
    one; the network's `recall` says how far.
    """
    shared_folder(docs.sparkSession)  # sets the checkpoint folder where the cluster has not
    found = examples(docs, max_docs=max_docs, id_column=id_column, text_column=text_column)
    found = found.distinct().checkpoint()
    order = F.xxhash64("before", "inside", "after"), *found.columns
    groups = [F.col("label") == 1, *((F.col("label") == 0) & (F.col("digit") == d) for d in (True, False))]
    rows = sorted(
        (r.label, r.before, r.inside, r.after)
        for group in groups
        for r in found.filter(group).orderBy(*order).limit(max_examples).collect()
    )
    net = fit_network(
        [r[1:] for r in rows if r[0] == 1], [r[1:] for r in rows if r[0] == 0], recall=recall
    )
    if rows and 0 < sum(r[0] for r in rows) < len(rows):
        scored = score_counts(docs, net, text_column=text_column).orderBy("label", "bin").collect()
        label, at, n = np.array([tuple(r) for r in scored], float).T
        net.set_threshold(at / BINS, label, n, recall, floor)
    return net


def findings(text: str, net: Network) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and calibrated probability of all findings of a text."""
    base = base_findings(text)
    others = candidates(text, base)
    if not base and not others:
        return []
    sure = net.of_candidates(text, [(a, b) for a, b, _ in base] + others)
    found = [(kind, a, b, float(p)) for (a, b, kind), p in zip(base, sure, strict=False)]
    added = zip(others, sure[len(base) :], strict=True)
    found += [("model", a, b, float(p)) for (a, b), p in added if p >= net.threshold]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def find_secrets(
    docs: DataFrame, net: Network, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id and findings: an array of (kind, start, end, score), code points, end exclusive."""
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    finding = T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ])
    layout = T.StructType([rows.schema[id_column], T.StructField("findings", T.ArrayType(finding))])
    sent = docs.sparkSession.sparkContext.broadcast(net)

    names = finding.names
    kinds = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())
    ]))

    # of Arrow columns, as pandas turns whole numbers beside a null into doubles
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(names, one, strict=True)) for one in findings(text or "", sent.value)]
                for text in batch.column("text").to_pylist()
            ]
            columns = [batch.column(id_column), pa.array(found, kinds)]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "findings"])

    return rows.mapInArrow(scan, layout)


def hide(text: str, found: list[tuple[str, int, int, float]], mark: str) -> str:
    """Findings that touch or overlap are hidden together."""
    out, at = [], 0
    for _, start, end, _ in sorted(found, key=lambda f: f[1:3]):
        if start > at or not out:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(
    docs: DataFrame, net: Network, *, text_column: str = "text", mark: str = "[SECRET]"
) -> DataFrame:
    """The documents, with every finding in their texts replaced by `mark`; a null text stays."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            texts = [
                text if text is None else hide(text, findings(text, sent.value), mark)
                for text in batch.column(at).to_pylist()
            ]
            columns = batch.columns
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
