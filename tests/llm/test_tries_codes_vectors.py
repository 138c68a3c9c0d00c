"""Conversation trie, near-duplicate vectors and vector codes against plain versions."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import codes, embdedup, trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """Nodes as a dict from the sequence of turns, by walking every conversation."""
    own = {}
    token = lambda role, text: sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, token(role or "", text or "")[:32], role or "", text or ""))
    paths = {}
    for conv, turns in own.items():
        head = crc32(str(conv).encode()) % 9
        base = conv - int(np.fmod(conv, 5))
        paths[conv] = [t[3:] for t in sorted(own.get(base, []))[:head] + sorted(turns)[head:]]
    nodes = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(conv)
    children, found = {}, []
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    sums = {}
    for key in sorted(nodes, key=len, reverse=True):
        below = [sums[c] for c in children.get(key, [])]
        leaves = sum(b[0] for b in below) or 1
        weight = (len(nodes[key]) - 1) * len(key[-1][1].encode()) if key else 0
        sums[key] = leaves, weight + sum(b[1] for b in below)
        ends = ",".join(str(c) for c in sorted(nodes[key]) if len(paths[c]) == len(key))
        found.append(
            (min(nodes[key]), len(key), min(nodes[key[:-1]]) if key else None, len(nodes[key]), len(children.get(key, [])),
             *sums[key], sha256(ends.encode()).hexdigest())
        )
    return found


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def conversations():
    rng = random.Random(4)
    rows = []
    for family in range(40):
        shared = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "é" * 5, None, ""])) for _ in range(12)]
        for member in range(rng.choice([1, 3, 5])):
            keep = rng.randint(0, 12)
            turns = shared[:keep] + [("user", f"{family} {member} {n}") for n in range(rng.randint(0, 3))]
            rows += [(family * 5 + member, n if n else None, *t) for n, t in enumerate(turns)]
    rows += [(500, n // 2, "user", f"t{n % 3}") for n in range(60)]  # long, with equal turn numbers
    rows += [(505, n // 2, "user", f"t{n % 3}") for n in range(60)] + rows[:3]
    rows += [(-3, 1, "user", "hi"), (None, 1, "user", "lost"), (601, 1, "user", "short"), (602, 1, "user", "short")]
    return rows


@pytest.mark.parametrize(("segment", "shard"), [(64, 10**6), (64, 20), (3, 25), (2, 10**6)])
def test_trie(spark, segment, shard):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("position", "path", "depth", "n")}).repartition(6)
    turns = trie.share_heads(trie.ordered_turns(df))
    got = trie.prefix_trie(turns, segment, shard).collect()
    assert in_order(got) == in_order(plain_trie(rows))


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.shared_heads_trie(empty).count() == 0
    turnless = [(conv, 1, "user", "x") for conv in range(1, 5) if crc32(str(conv).encode()) % 9]
    got = trie.shared_heads_trie(spark.createDataFrame(turnless, TURNS)).collect()
    assert in_order(got) == in_order(plain_trie(turnless))


def plain_links(rows, threshold=embdedup.THRESHOLD):
    use = [(i, r) for i, r in enumerate(rows) if usable(r)]
    near = {i: [] for i, _ in use}
    for i, (_, label, v) in use:
        for j, (_, other, w) in use:
            if i < j and label == other and len(v) == len(w):
                a, b = np.array(v) / np.abs(v).max(), np.array(w) / np.abs(w).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    near[i].append(j)
                    near[j].append(i)
    out = []
    for i, (vec, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen), default=None) if vec is not None else None
        out.append((vec, len(near.get(i, [])), low, vec is not None and vec == low))
    return out


def usable(row):
    vec, label, v = row
    return vec is not None and label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 4))):
            rows.append((len(rows), int(rng.integers(0, 3)), (base + 0.03 * rng.standard_normal(16)).tolist()))
    crowd = rng.standard_normal(16)
    rows += [(1000 + i, 1, (crowd + 0.12 * rng.standard_normal(16)).tolist()) for i in range(150)]
    rows += [(2000 + i, 2, rows[0][2]) for i in range(5)] + [rows[4], rows[4]]
    rows += [(3000, None, rows[0][2]), (None, 1, rows[0][2]), (3001, 1, None), (3002, 1, []), (3003, 1, [0.0] * 16)]
    rows += [(3004, 1, [float("nan")] * 16), (3005, 1, [1e200] * 16), (3006, 1, [1e-200] * 16), (3007, 1, [None] * 16), (3008, 1, [1.0, 1.0])]
    return rows


@pytest.mark.parametrize("block", [4096, 40])
def test_near_duplicate_vectors(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    df = df.withColumns({c: F.lit(1) for c in ("vector", "point", "weight", "digest", "n_links")}).repartition(4)
    got = embdedup.near_duplicates(df, block=block, least_block=20).collect()
    assert in_order(got) == in_order(plain_links(rows))
    assert embdedup.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    errors = []
    import pyarrow as pa

    for cosine in (0.0, 0.5, 0.9):
        a = rng.standard_normal((400, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.standard_normal((400, 64))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        b = cosine * a + np.sqrt(1 - cosine**2) * b
        names = [f.split()[0] for f in embdedup.FEATURES.split(", ")]
        sides = [embdedup.Side(pa.RecordBatch.from_arrays(embdedup.features(x, np.arange(400)), names=names), 64) for x in (a, b)]
        estimate = (sides[0].signs * sides[1].rough).sum(axis=1) / (8 * sides[0].factor)
        assert abs(estimate.mean() - cosine) < 0.03
        errors.append(np.abs(estimate - cosine) <= sides[0].bound)
    assert np.mean(errors) == 1.0


def plain_codes(rows, entries=codes.ENTRIES, rounds=codes.ROUNDS):
    use = sorted(((vec is None, vec or 0, [int(np.floor(4096 * x)) for x in v]), label) for vec, label, v in rows)
    x = [k[2] for k, _ in use]
    width = len(x[0]) // 8
    parts = [[v[p * width : (p + 1) * width] for v in x] for p in range(8)]
    books = [[list(c) for c in part[:entries]] for part in parts]
    best = lambda part, book: min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(part, book[e])), e))
    for _ in range(rounds):
        for p in range(8):
            taken = {}
            for part in parts[p]:
                taken.setdefault(best(part, books[p]), []).append(part)
            for e, found in taken.items():
                books[p][e] = [sum(c) // len(found) for c in zip(*found)]
    out, by_label = [], {}
    for i, ((no_id, vec, _), label) in enumerate(use):
        code = [best(parts[p][i], books[p]) for p in range(8)]
        error = sum(sum((a - b) ** 2 for a, b in zip(parts[p][i], books[p][code[p]])) for p in range(8))
        by_label[label] = by_label.get(label, 0) + error
        out.append((None if no_id else vec, "".join(f"{c:02x}" for c in code), error, label))
    digest = sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(vec, code, error, by_label[label], digest) for vec, code, error, label in out]


@pytest.mark.parametrize("count", [3, 90])
def test_codes(spark, count):
    rng = np.random.default_rng(count)
    rows = [(1000 - 3 * i, [0, 1, None][i % 3], rng.standard_normal(16).round(2).tolist()) for i in range(count)]
    rows += rows[:2] + [(None, 7, rows[0][2])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    odd = [(5, 1, None), (6, 1, []), (7, 1, [1.0] * 8), (8, 1, [float("inf")] * 16), (9, 1, [None] * 16), (10, 1, [1.0] * 3), (11, 1, [1e30] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, label long, embedding array<double>")
    df = df.withColumns({c: F.lit(1) for c in ("v", "id", "code", "error", "same")}).repartition(4)
    label = {(r[0], r[1]) for r in rows}
    got = codes.compress(df).collect()
    assert len(got) == len(rows) and len(label) <= len(rows)
    plain = [(vec, lab if lab is not None else -1, v) for vec, lab, v in rows]
    assert in_order(got) == in_order(plain_codes(plain))
    assert codes.compress(df.limit(0)).count() == 0


def test_masks_hold_the_nearest_entry():
    rng = np.random.default_rng(2)
    for entries in (1, 5, 64):
        book = rng.integers(-50, 50, (entries, 8))
        parts = rng.integers(-60, 60, (500, 8))
        slices = codes.Slices.of(book)
        code, distance = slices.nearest(parts)
        all_distances = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (code == all_distances.argmin(axis=1)).all() and (distance == all_distances.min(axis=1)).all()
    with pytest.raises(ValueError, match="64"):
        codes.Slices.of(np.zeros((65, 2), np.int64))


def test_decoding_gives_the_entries(spark):
    df = spark.createDataFrame([(i, 0, [i / 8] * 8) for i in range(20)], "vec_id long, label int, embedding array<double>")
    numbers = codes.whole_numbers(df)
    books = codes.train(numbers)
    for row in codes.decode(codes.encode(numbers, books), books).collect():
        entries = [int(row["code"][2 * p : 2 * p + 2], 16) for p in range(8)]
        assert row["decoded"] == [books[p][e][0] / codes.SCALE for p, e in enumerate(entries)]
