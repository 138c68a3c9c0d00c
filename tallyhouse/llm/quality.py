"""Quality scores by Bradley-Terry pairwise ranking.

Labelled rows make preference pairs, a better document before a worse one. The strength of a
document is linear in features of its text, and the weights minimise the logistic loss of
the strength differences of the pairs. Strengths turn into decisions by a quantile: the
threshold is the strength below which the labelled share of bad documents lies, placed midway
in the gap around it, and the score is a logistic curve through that threshold.

Every labelled row takes part, in a pair with each row of the other label. The loss of a pair depends on the difference
of two strengths only, and as a function of either strength it is so smooth that its values at a few nodes give it
to ten digits. Sums over all pairs thus come from sums over rows at those nodes: one pass over the features of the labelled rows for
each Newton step, in which the driver adds up at most ``PARTS`` partial sums. Scores depend on the text only.

Null and empty texts have all-zero features and get the score of those. Rows with a null
label or text teach nothing; without rows of both labels every score is 0.5. Very long texts count
whole. Repeated rows get equal scores, input columns are kept unless they bear a result's
name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.scratch import scratch_scope, stage

CUT = 0.3
RIDGE = 1e-3
STEPS = 60
# Tasks of a pass over the labelled rows; each sends its sums to the driver.
PARTS = 64
# Strengths lie in panels two wide, each with so many Chebyshev nodes; the digits a search for a rank settles in a pass.
NODES = 12
DIGITS = (11, 11, 11, 11, 11, 9)

_KIND = np.zeros(256, np.int64)  # 0: other signs and controls
for _b in range(256):
    _c = chr(_b)
    if _b >= 128:
        _KIND[_b] = 1
    elif _c.islower():
        _KIND[_b] = 2
    elif _c.isupper():
        _KIND[_b] = 3
    elif _c.isdigit():
        _KIND[_b] = 4
    elif _c == " ":
        _KIND[_b] = 5
    elif _c == "\n":
        _KIND[_b] = 6
    elif _c in ".,;:":
        _KIND[_b] = 7
    elif _c in "!?":
        _KIND[_b] = 8
FEATURES = (
    "beyond_ascii", "lower", "upper", "digits", "blanks", "line_ends", "stops", "exclaims", "signs",
    "length", "word_length", "distinct_words", "distinct_lines", "commonest_word", "short_line", "words_a_line", "repeated_words",
)


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of characters, and how long, varied and repetitive a whole text is."""
    if not text:
        return np.zeros(len(FEATURES))
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.zeros(9)
    for at in range(0, len(data), 1 << 20):
        kinds += np.bincount(_KIND[data[at : at + (1 << 20)]], minlength=9)
    shares = np.sqrt(kinds / len(data))
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    n = max(1, len(words))
    count: dict[str, int] = {}
    for word in words:
        count[word] = count.get(word, 0) + 1
    return np.array(
        [
            *shares[1:],
            shares[0],
            np.log1p(n) / 10,
            min(len(text) / n, 30) / 10,
            len(count) / n,
            len(set(lines)) / max(1, len(lines)),
            max(count.values(), default=0) / n,
            sum(len(line) < 40 for line in lines) / max(1, len(lines)),
            min(n / max(1, len(lines)), 200) / 100,
            sum(map(eq, words, words[1:])) / n,
        ]
    )


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _expand((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the threshold strength gets exactly the score CUT."""
        z = self.slope * (self.strength(x) - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _expand(z: np.ndarray) -> np.ndarray:
    """Standardised features, held within five deviations, with their squares."""
    z = np.clip(z, -5, 5)
    return np.concatenate([z, z * z], axis=1)


def labelled_features(docs: DataFrame, labels: DataFrame, text: str, label: str, key: str) -> DataFrame:
    """``label, x``: the features of every text with a label. Keys and features are moved, no text."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where("key is not null and label in (0, 1)")
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("key is not null and text is not null")
    schema = T.StructType([texts.schema["key"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                x = [features(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(x, pa.list_(pa.float64()))], names=schema.names)

    return texts.mapInArrow(run, schema).join(known, "key").select("label", "x")


def _summed(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Numbered vectors, added up over all rows; ``part`` makes them from the labels and features of some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            for number, vector in part(batch.column("label").to_numpy(), x).items():
                total[number] = total[number] + vector if number in total else vector
        for number, vector in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([vector.tobytes()])], names=["number", "vector"])

    total: dict[int, np.ndarray] = {}
    for row in rows.coalesce(PARTS).mapInArrow(run, "number long, vector binary").collect():
        total[row["number"]] = total.get(row["number"], 0) + np.frombuffer(row["vector"])
    return total


_NODES = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))
_ORDERS = np.arange(NODES)
_TO_NODES = np.cos(_ORDERS[:, None] * np.arccos(_NODES)) * np.where(_ORDERS == 0, 1, 2)[:, None] / NODES


def _at_nodes(strength: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The panel of every strength, and the shares of its nodes in a smooth function's value there."""
    panel = np.rint(strength / 2).astype(np.int64)
    place = np.clip(strength - 2 * panel, -1, 1)
    return panel, np.cos(np.arccos(place)[:, None] * _ORDERS) @ _TO_NODES


def _node_sums(strength: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]):
    """For each label and panel, the nodes' shares summed: alone, times the features, times their products."""

    def part(y: np.ndarray, x: np.ndarray) -> dict[int, np.ndarray]:
        z, s = strength(x)
        panel, shares = _at_nodes(s)
        group, found = 2 * panel + y, {}
        for number in np.unique(group).tolist():
            own = group == number
            part_z, part_shares = z[own], shares[own]
            products = [(part_z * share[:, None]).T @ part_z for share in part_shares.T]
            found[number] = np.concatenate([part_shares.sum(axis=0), (part_shares.T @ part_z).ravel(), np.ravel(products)])
        return found

    return part


def _newton_step(sums: dict[int, np.ndarray], weights: np.ndarray, pairs: int) -> np.ndarray:
    """The step on the ridge-penalised logistic loss of all pairs, from the sums at the nodes."""
    size = len(weights)

    def of(label: int) -> tuple[np.ndarray, ...]:
        """Strengths of the nodes, and their sums."""
        numbers = [n for n in sorted(sums) if n % 2 == label]
        parts = [np.split(sums[n], [NODES, NODES + NODES * size]) for n in numbers]
        at = np.concatenate([n // 2 * 2 + _NODES for n in numbers])
        once, times, products = (np.concatenate(p) for p in zip(*parts, strict=True))
        return at, once, times.reshape(-1, size), products.reshape(-1, size * size)

    (bad_at, bad, bad_z, bad_zz), (good_at, good, good_z, good_zz) = of(0), of(1)
    p = 1 / (1 + np.exp(np.clip(good_at[:, None] - bad_at, -50, 50)))
    q = p * (1 - p)
    pull = (good_z.T @ (p @ bad) - bad_z.T @ (good @ p)) / pairs - RIDGE * weights
    mixed = good_z.T @ q @ bad_z
    bend = (good_zz.T @ (q @ bad) + bad_zz.T @ (good @ q)).reshape(size, size) - mixed - mixed.T
    return np.linalg.solve(bend / pairs + RIDGE * np.eye(size), pull)


@dataclass
class _Rank:
    """The least strength at which rows, weighted by label, come to a goal; and how many rows are below and at it."""

    weights: tuple[float, float]
    goal: float
    prefix: int = 0
    below: tuple[int, int] = (0, 0)
    at: tuple[int, int] = (0, 0)

    def narrow(self, counts: np.ndarray) -> None:
        """Settle the next digit by the number of rows with each."""
        before = np.cumsum(counts, axis=1)
        reached = sum(w * (b + n) for w, b, n in zip(self.weights, self.below, before, strict=True)) >= self.goal
        digit = int(reached.argmax()) if reached.any() else int(np.flatnonzero(counts.sum(axis=0))[-1])
        self.at = int(counts[0, digit]), int(counts[1, digit])
        self.below = tuple(int(b + n[digit] - a) for b, n, a in zip(self.below, before, self.at, strict=True))
        self.prefix = self.prefix * counts.shape[1] + digit

    @property
    def strength(self) -> float:
        bits = np.array([self.prefix], np.uint64).view(np.int64) ^ np.int64(-(2**63))
        return float((bits ^ (bits >> 63 & np.int64(2**63 - 1))).view(np.float64)[0])


def _find(rows: DataFrame, strength: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], ranks: list[_Rank]) -> None:
    """Settle ranks exactly, some binary digits of the strengths a pass, whatever the number of rows or ties."""
    left = sum(DIGITS)
    for width in DIGITS:
        left -= width
        prefixes, first, shift = [rank.prefix for rank in ranks], left + width == 64, left

        def part(y: np.ndarray, x: np.ndarray, prefixes=prefixes, first=first, shift=shift, width=width) -> dict[int, np.ndarray]:
            bits = (strength(x)[1] + 0.0).view(np.int64)
            key = (bits ^ (bits >> 63 & np.int64(2**63 - 1)) ^ np.int64(-(2**63))).view(np.uint64)
            cell = (key >> np.uint64(shift) & np.uint64(2**width - 1)).astype(np.int64) + (y.astype(np.int64) << width)
            found = {}
            for number, prefix in enumerate(prefixes):
                own = cell if first else cell[key >> np.uint64(shift + width) == np.uint64(prefix)]
                found[number] = np.bincount(own, minlength=2 << width).astype(float)
            return found

        for number, counts in _summed(rows, part).items():
            ranks[number].narrow(counts.reshape(2, -1))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id") -> Model | None:
    """A model from all labelled rows (1 good, 0 bad); None unless there are both."""
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(label).cast("int").alias("label")).count()
    counts = {r["label"]: r["count"] for r in known.where("label in (0, 1)").collect()}
    if len(counts) < 2:
        return None
    with scratch_scope(docs.sparkSession, "quality"):
        return _fitted(stage(labelled_features(docs, labels, text, label, key), "features"), counts)


def _fitted(rows: DataFrame, counts: dict[int, int]) -> Model | None:
    def moments(y: np.ndarray, x: np.ndarray) -> dict[int, np.ndarray]:
        return {0: np.concatenate([[(y == 0).sum(), (y == 1).sum()], x.sum(axis=0), (x * x).sum(axis=0)])}

    sums = _summed(rows, moments).get(0, np.zeros(2 + 2 * len(FEATURES)))
    n_bad, n_good = int(sums[0]), int(sums[1])
    if not n_good or not n_bad:
        return None
    mean, squares = np.split(sums[2:] / (n_bad + n_good), 2)
    scale = np.sqrt(np.maximum(squares - mean * mean, 0)) + 1e-3
    weights = np.zeros(2 * len(FEATURES))

    def strength(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = _expand((x - mean) / scale)
        return z, z @ weights

    for _ in range(STEPS):
        step = _newton_step(_summed(rows, _node_sums(strength)), weights, n_good * n_bad)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    # the quantile that stands for the labelled share of bad rows, should some labelled rows have no text
    each = counts[0] / n_bad, counts[1] / n_good
    goal = counts[0] + 1e-12 * (counts[0] + counts[1])
    line = _Rank(each, goal)
    middles = [_Rank(kind, rank) for kind, n in (((0, 1), n_good), ((1, 0), n_bad)) for rank in ((n + 1) // 2, n // 2 + 1)]
    _find(rows, strength, [line, *middles])
    below = line
    first = each[0] if line.at[0] else each[1]
    if sum(line.below) and each[0] * line.below[0] + each[1] * line.below[1] + first >= goal:
        below = _Rank((1, 1), sum(line.below))
        _find(rows, strength, [below])
    good, bad = (sum(m.strength for m in two) / 2 for two in (middles[:2], middles[2:]))
    return Model(mean, scale, weights, (below.strength + line.strength) / 2, float(8 / max(good - bad, 1e-9)))


def rate(
    docs: DataFrame, model: Model | None, text: str = "text", names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """Add a score (0 to 1, higher is better) and a prediction (1 from CUT on) to every row."""
    kept = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(names[0], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column(text).to_pylist()
                score = np.full(len(texts), 0.5)
                if model is not None and texts:
                    score = model.score(np.stack([features(t) for t in texts]))
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(score)], names=schema.names)

    scored = docs.select(*kept).mapInArrow(run, schema)
    return scored.withColumn(names[1], (F.col(names[0]) >= CUT).cast("int"))
