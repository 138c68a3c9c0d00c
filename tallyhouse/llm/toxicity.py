"""Toxicity by a support vector machine with a gap-weighted subsequence string kernel.

The kernel of two strings sums, over all subsequences of three letters, decay to the power
of the stretch each occurrence spans (up to ``SPAN`` letters, so up to two letters may lie in
between). An insult with letters inserted or left out keeps most of its subsequences. Signs
between letters are dropped first, and letters written apart ("i d i o t") are read as
one string.

A sentence is judged by its most toxic string: labels say that a document holds a toxic
string somewhere, not where (multiple-instance learning). Strings that toxic documents of the
sample have far more often become positives, others negatives; in each of ``ROUNDS`` the
machine is fitted, the strings it finds worst in clean documents join the negatives and the landmarks, and
those it finds worst in toxic ones the positives. Clean strings weigh more the more they look like
toxic ones, as they say where the border runs. Texts that share their ``SKETCH`` smallest string hashes are copies and
count once. The Nyström landmarks are strings of both
kinds; the machine is linear in the landmark kernels after whitening with the landmarks' own kernel
matrix. As those kernels are sums over subsequences, the decision function folds into one
weight for each hashed subsequence, and whole texts are scored with array operations.

The fit runs on a bounded sample of labelled rows (``most`` for each label); label counts
come from all rows, string counts from the whole texts of the sample.

Null and empty texts, and texts without letters, have no string and get the lowest score any
text can get. Rows with a null label or text teach nothing; without rows of both labels every score
is 0. Very long texts count whole. Repeated rows get equal scores; input columns are kept
unless they bear a result's name, which is replaced.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.tables import labelled_sample
from tallyhouse.sources.scratch import stage

log = logging.getLogger(__name__)

SAMPLE_ROWS = 3_000
LANDMARKS = 160
ROUNDS = 5
SKETCH = 4  # smallest string hashes that tell copies from other texts
ALARM = -0.5  # from this value on a clean document's worst string becomes a landmark
SURPRISE, LEAST_SURPRISE, MOST_STRINGS = 13.0, 5.0, 300
CUT = 0.5
SPAN, DECAY = 5, 0.7
# The middle and last letter of a subsequence, counted from its first.
PATTERNS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
SLOTS = 1 << 18
STEP_BYTES = 1 << 20

_APART = re.compile(r"(?<!\S)\w(?:[ .\-_*]\w){2,}(?!\S)")
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([b >= 128 or chr(b).isalnum() or _BLANK[b] for b in range(256)])
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_SHIFT = np.uint32(32 - SLOTS.bit_length() + 1)


def plain(text: str) -> bytes:
    """Lower-cased letters and digits with single-letter runs written together."""
    low = text.lower()
    apart = [re.sub(r"[\W_]", "", run) for run in _APART.findall(low)]
    data = np.frombuffer((" ".join([low, *apart]) if apart else low).encode("utf-8", "replace"), np.uint8)
    return data[_KEEP[data]].tobytes()


def _slots(data: np.ndarray, i: int, j: int) -> np.ndarray:
    x = data.astype(np.uint32)
    h = x[: len(x) - j] * _A + x[i : len(x) - j + i] * _B + x[j:] * _C
    return ((h ^ h >> np.uint32(15)) * _A) >> _SHIFT


def profile(string: bytes) -> dict[int, float]:
    """Weights of the string's hashed subsequences, of length 1: the kernel is their inner product."""
    data = np.frombuffer(string, np.uint8)
    out: dict[int, float] = {}
    for i, j in PATTERNS:
        if len(data) > j:
            for slot in _slots(data, i, j).tolist():
                out[slot] = out.get(slot, 0.0) + DECAY ** (j + 1)
    size = np.sqrt(sum(value * value for value in out.values())) or 1.0
    return {slot: value / size for slot, value in out.items()}


def _norm(lengths: np.ndarray) -> np.ndarray:
    """Length of a profile before scaling if all its subsequences differ, else a lower bound."""
    square = sum(DECAY ** (2 * j + 2) * np.maximum(0, lengths - j) for _, j in PATTERNS)
    return np.sqrt(np.maximum(square, 1e-12))


def kernels(strings: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Kernel of every string with every landmark."""
    by_slot: dict[int, list[tuple[int, float]]] = {}
    for column, landmark in enumerate(landmarks):
        for slot, value in profile(landmark).items():
            by_slot.setdefault(slot, []).append((column, value))
    out = np.zeros((len(strings), len(landmarks)))
    for row, string in enumerate(strings):
        for slot, value in profile(string).items():
            for column, other in by_slot.get(slot, ()):
                out[row, column] += value * other
    return out


@dataclass(frozen=True)
class Model:
    table: np.ndarray  # weight of every slot
    bias: float
    threshold: float
    slope: float

    def worst(self, text: str | None) -> tuple[float, bytes]:
        """Decision value of a text's most toxic string, and the string."""
        data = np.frombuffer(plain(text), np.uint8) if text else np.zeros(0, np.uint8)
        best, found, at = self.bias - 1.0, b"", 0
        while at < len(data):
            stop = min(len(data), at + STEP_BYTES)
            if stop < len(data):  # end the step between two strings
                blanks = np.flatnonzero(_BLANK[data[at:stop]])
                while not len(blanks) and stop < len(data):
                    stop = min(len(data), stop + STEP_BYTES)
                    blanks = np.flatnonzero(_BLANK[data[at:stop]])
                if stop < len(data):
                    stop = at + int(blanks[-1]) + 1
            value, string = self._worst(data[at:stop])
            if value > best:
                best, found = value, string
            at = stop
        return best, found

    def _worst(self, data: np.ndarray) -> tuple[float, bytes]:
        letter = ~_BLANK[data]
        edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return -np.inf, b""
        lengths = ends - starts
        left = np.zeros(len(data), np.int64)  # letters from here to the string's end
        left[letter] = np.repeat(ends, lengths) - np.flatnonzero(letter)
        value = np.zeros(len(data) + 1)
        for i, j in PATTERNS:
            if len(data) > j:
                got = self.table[_slots(data, i, j)]
                value[1 : len(data) - j + 1] += np.where(left[: len(data) - j] > j, got * DECAY ** (j + 1), 0.0)
        np.cumsum(value, out=value)
        bound = (value[ends] - value[starts]) / _norm(lengths)
        best, found = -np.inf, b""
        for n in np.argsort(-bound, kind="stable").tolist():
            if bound[n] <= best:  # repeated subsequences only bring a string below its bound
                break
            string = data[starts[n] : ends[n]].tobytes()
            exact = sum(self.table[slot] * v for slot, v in profile(string).items())
            if exact > best:
                best, found = float(exact), string
        return best + self.bias, found

    def score(self, value: float) -> float:
        """0 to 1; the threshold gets exactly CUT."""
        return float(1 / (1 + np.exp(-np.clip(self.slope * (value - self.threshold), -60, 60))))


def _fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1000.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the active rows."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    ridge = np.ones(len(w))
    ridge[-1] = 1e-4
    for _ in range(50):
        active = y * (x @ w) < 1
        a = x[active] * weight[active, None]
        new = np.linalg.solve(np.diag(ridge) + cost * a.T @ x[active], cost * a.T @ y[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def _machine(positives: dict[bytes, int], negatives: list[bytes], landmarks: list[bytes]) -> Model:
    """Fit on strings; a positive counts by the documents that speak for it."""
    own = kernels(landmarks, landmarks)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-3 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    negatives = [n for n in negatives if n not in positives]
    x = kernels([*positives, *negatives], landmarks) @ whiten
    y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
    heavy = np.sqrt(np.array(list(positives.values()), float))
    # a clean string that looks like a toxic one says where the border is
    close = kernels(negatives, landmarks).max(axis=1, initial=0.0) ** 4 * 30 + 1
    weight = np.concatenate([heavy / heavy.sum() / 2, close / close.sum()])
    w, bias = _fit_machine(x, y, weight)
    table = np.zeros(SLOTS)
    for part, landmark in zip(whiten @ w, landmarks, strict=True):
        for slot, value in profile(landmark).items():
            table[slot] += part * value
    return Model(table, bias, 0.0, 1.0)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct strings of every document, with a sketch of its strings that near copies mostly share."""
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = sorted({s for s in plain(text).split() if len(s) > 3})
            kin = crc32(b"".join(sorted(found, key=lambda s: (crc32(s) * 0x9E3779B1 & 0xFFFFFFFF, s))[:SKETCH]))
            columns = [pa.array(found, pa.binary()), pa.array([label] * len(found), pa.int32()), pa.array([kin] * len(found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["string", "label", "kin"])


def _judged(sample: DataFrame, model: Model) -> list[tuple[int, float, bytes]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst = [model.worst(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([v for v, _ in worst], pa.float64()), pa.array([s for _, s in worst], pa.binary())],
                names=["label", "value", "string"],
            )

    rows = sample.mapInArrow(run, "label int, value double, string binary").collect()
    return sorted((r["label"], r["value"], bytes(r["string"])) for r in rows)


def _spread_out(strings: list[bytes], most: int) -> list[bytes]:
    """Up to ``most`` strings that are unlike each other, in the given order of preference."""
    if len(strings) <= most:
        return strings
    alike = kernels(strings, strings)
    near, chosen = np.full(len(strings), -1.0), []
    for _ in range(most):
        pick = int(np.argmin(near))
        chosen.append(pick)
        near = np.maximum(near, alike[:, pick])
        near[pick] = np.inf
    return [strings[i] for i in sorted(chosen)]


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", most: int = SAMPLE_ROWS
) -> Model | None:
    """A model from labelled rows (1 toxic, 0 clean); None unless there are both."""
    sample, counts = labelled_sample(docs, labels, label, most, key, text)
    if len(counts) < 2:
        return None
    # a text that was copied counts once; every round reads the sample, so it is written
    sample = stage(sample.dropDuplicates(["label", "text"]), "toxicity-sample")
    seen = (
        sample.mapInArrow(_strings, "string binary, label int, kin long")
        .distinct()
        .groupBy("string")
        .agg(F.sum("label").cast("long").alias("toxic"), F.sum(1 - F.col("label")).cast("long").alias("clean"))
    )
    # Chernoff bound: that a string is so much more frequent in toxic documents is no chance
    share = min(most, counts[1]) / (min(most, counts[0]) + min(most, counts[1]))
    marked = seen.where("toxic >= 3").withColumn("rate", F.col("toxic") / (F.col("toxic") + F.col("clean")))
    surprise = (F.col("toxic") + F.col("clean")) * (
        F.col("rate") * F.log(F.col("rate") / share)
        + F.when(F.col("rate") < 1, (1 - F.col("rate")) * F.log((1 - F.col("rate")) / (1 - share))).otherwise(0.0)
    )
    marked = marked.where(F.col("rate") > share).withColumn("surprise", surprise).where(F.col("surprise") >= LEAST_SURPRISE)
    likely = marked.orderBy(F.desc("surprise"), "string").limit(MOST_STRINGS).collect()
    sure = [r for r in likely if r["surprise"] >= SURPRISE] or likely  # few labels: the best there are
    top = {bytes(r["string"]): r["toxic"] for r in sure}
    usual = seen.where((F.col("clean") >= 1) & (F.col("toxic") <= 2 + 2 * share / (1 - share) * F.col("clean")))
    frequent = [bytes(r["string"]) for r in usual.orderBy(F.desc("clean"), "string").limit(MOST_STRINGS * 5).collect()]
    rare = [bytes(r["string"]) for r in usual.orderBy(F.xxhash64("string"), "string").limit(MOST_STRINGS * 5).collect()]
    negatives, positives = sorted(set(frequent) | set(rare)), dict(top)
    if not positives or not negatives:
        log.warning("no string tells toxic documents from clean ones: nothing can be learned, all rows will count as clean")
        return None
    landmarks = _spread_out(list(top), LANDMARKS * 3 // 4) + _spread_out(frequent[:400], LANDMARKS // 4)
    model, rows, alarms = None, [], []
    for _ in range(ROUNDS):
        landmarks += [a for a in alarms if a not in landmarks][: LANDMARKS // 4]
        model = _machine(positives, negatives, landmarks)
        rows = _judged(sample, model)
        clean_strings = {s for y, _, s in rows if y == 0}
        worst_first = sorted((-v, s) for y, v, s in rows if y == 0 and v > ALARM)
        alarms = list(dict.fromkeys(s for _, s in worst_first))
        line = max(0.0, float(np.quantile([v for y, v, _ in rows if y == 0], 0.99)))
        negatives = sorted(set(negatives) | clean_strings - set(top))
        positives = top | {s: 1 for y, v, s in rows if y == 1 and v > line and s not in top and s not in clean_strings}
    # the threshold with the fewest errors at the labelled shares; midway between values
    values = np.array([v for _, v, _ in rows])
    truth = np.array([y for y, _, _ in rows])
    share = np.where(truth == 1, counts[1] / max(1, truth.sum()), counts[0] / max(1, (1 - truth).sum()))
    order = np.argsort(-values, kind="stable")
    gain = np.cumsum(np.where(truth[order] == 1, share[order], -share[order]))
    last = int(gain.argmax())
    above, below = values[order[last]], values[order[min(last + 1, len(order) - 1)]]
    return Model(model.table, model.bias, float((above + below) / 2), 4.0)


def rate(
    docs: DataFrame, model: Model | None, text: str = "text", names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """Add a score (0 to 1, higher is more toxic) and a prediction (1 from CUT on) to every row."""
    kept = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(names[0], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column(text).to_pylist()
                score = [0.0 if model is None else model.score(model.worst(t)[0]) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(score, pa.float64())], names=schema.names)

    scored = docs.select(*kept).mapInArrow(run, schema)
    return scored.withColumn(names[1], (F.col(names[0]) >= CUT).cast("int"))
