"""Language identification with error-correcting output codes.

Every language gets a codeword of bits. One binary classifier for each bit, linear in hashed
byte n-grams of the lower-cased letters, tells which languages have the bit set. A text's
bit margins are compared with every codeword by a logistic loss weighted by how well each bit
was learned; the codeword with the least loss is the language. If the runner-up's loss is as
low, the text is flagged as ambiguous.

The classifiers are fitted in the driver on a bounded sample of labelled rows (``most`` rows
for each language); label counts come from all rows. A model holds bits times features
floats, so it does not grow with the data. Only text is ever an input of a prediction.

Null texts and texts without letters get language ``und``, score 0 and are flagged. Rows with
a null language teach nothing; without any labelled row every text is ``und``. Very long texts
count whole. Repeated rows give repeated results, ties go to the language first in
alphabetical order, input columns are kept unless they bear a result's name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


FEATURES = 2048
SAMPLE_ROWS = 600
AMBIGUOUS = 0.05
STEP_BYTES = 1 << 20
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
# Digits, signs and controls of ASCII all count as a blank.
_FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte bigrams and trigrams of a whole text, square-rooted, of length 1."""
    total = np.zeros(FEATURES)
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    for at in range(0, max(1, len(data) - 2), STEP_BYTES):
        x = _FOLD[data[at : at + STEP_BYTES + 2]].astype(np.uint32)
        if len(x) < 3:
            continue
        two = x[:-2] * _MIX[0] + x[1:-1] * _MIX[1]
        three = two + x[2:] * _MIX[2]
        shift = np.uint32(32 - FEATURES.bit_length() + 2)
        total[: FEATURES // 2] += np.bincount((two ^ two >> np.uint32(15)) * _MIX[2] >> shift, minlength=FEATURES // 2)
        total[FEATURES // 2 :] += np.bincount((three ^ three >> np.uint32(15)) * _MIX[2] >> shift, minlength=FEATURES // 2)
    np.sqrt(total, out=total)
    return (total / max(np.linalg.norm(total), 1e-12)).astype(np.float32)


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """Rows of -1 and 1, one a language, far apart; every column tells some languages apart."""
    bits = max(7, 4 * int(np.ceil(np.log2(max(2, languages)))) + 7)
    rng = np.random.default_rng(seed)
    best, reach = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (languages, bits))
        for column in code.T:
            if languages > 1 and abs(column.sum()) == languages:
                column[rng.integers(languages)] *= -1
        apart = (bits - code @ code.T) / 2 + np.eye(languages) * bits
        if apart.min() > reach:
            best, reach = code, apart.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit, adding up to 1

    def margins(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Loss of every language for every row."""
        signed = margins[:, None, :] * self.code[None]
        return (np.logaddexp(0, -signed) * self.trust).sum(axis=2)


def _fit_bits(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, ridge: float = 1e-4):
    """Logistic regressions, all bits at once, by accelerated gradient descent."""
    w, bias = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    ahead, ahead_bias, rate = w.copy(), bias.copy(), 8.0
    for n in range(rounds):
        pull = weight[:, None] * y / (1 + np.exp(np.clip(y * (x @ ahead + ahead_bias), -50, 50)))
        new, new_bias = ahead + rate * (x.T @ pull - ridge * ahead), ahead_bias + rate * 0.2 * pull.sum(axis=0)
        keep = n / (n + 3)
        ahead, ahead_bias = new + keep * (new - w), new_bias + keep * (new_bias - bias)
        w, bias = new, new_bias
    return w, bias


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = SAMPLE_ROWS) -> Model | None:
    """A model from a bounded sample of labelled rows; None if there are none."""
    known = labelled.select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key")
    ).where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return None
    slot = F.pmod(F.xxhash64(F.lit("language"), "key"), F.lit(1 << 40))
    limit = F.create_map(*[F.lit(v) for l in languages for v in (l, int(min(1.0, most / counts[l]) * (1 << 40)))])
    sample = known.where(slot < limit[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [ngram_counts(t).astype(np.float16).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.binary())], names=["lang", "features"])

    rows = sample.mapInArrow(run, "lang string, features binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["features"])))
    if not rows:
        return None
    x = np.stack([np.frombuffer(r["features"], np.float16) for r in rows]).astype(np.float32)
    place = np.array([languages.index(r["lang"]) for r in rows])
    code = codewords(len(languages))
    share = np.bincount(place, minlength=len(languages))
    weight = (1 / np.maximum(share, 1))[place]
    weight = weight / weight.sum()
    w, bias = _fit_bits(x, code[place], weight)
    right = ((x @ w + bias) * code[place] > 0).T @ weight
    trust = np.log(np.clip(right, 0.5, 1 - 1e-3) / (1 - np.clip(right, 0.5, 1 - 1e-3))) + 1e-3
    return Model(languages, code, w.astype(np.float32), bias.astype(np.float32), trust / trust.sum())


def identify(
    docs: DataFrame,
    model: Model | None,
    text: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"),
) -> DataFrame:
    """Add the language, its score (0 to 1) and whether it is ambiguous to every row."""
    kept = [c for c in docs.columns if c not in names]
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                spoken = np.array([model is not None and bool(_LETTER.search(t)) for t in texts])
                lang, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if spoken.any():
                    x = np.stack([ngram_counts(t) for t, s in zip(texts, spoken, strict=True) if s])
                    losses = model.losses(model.margins(x))
                    near = np.exp(-losses * model.code.shape[1])
                    near /= near.sum(axis=1, keepdims=True)
                    first = losses.argmin(axis=1)
                    order = np.sort(losses, axis=1)
                    gap = order[:, 1] - order[:, 0] if losses.shape[1] > 1 else np.full(len(x), 1.0)
                    for i, row in enumerate(np.flatnonzero(spoken)):
                        lang[row] = model.languages[first[i]]
                    score[spoken], unsure[spoken] = near[np.arange(len(x)), first], gap < AMBIGUOUS
                columns = [batch.column(c) for c in kept]
                columns += [pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(unsure)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*kept).mapInArrow(run, schema)
