"""Operators against plain versions, and the awkward rows: nulls, empties, ties, repeats, clashing columns."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, chat, jaccard, langid, leaks, licenses, lm, neighbours, quality, toxicity
from tallyhouse.llm.queries import tokenizer_path
from tests.llm import brute

AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (None, "a few words here"), (4, "same text"), (4, "same text"), (5, "x" * 3_000_000)]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in ("score", "key", "label", "ids", "words")}) if extra else df


def varied(seed=3, families=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(230)]
    rows = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 4, 5, 6, 8, 11, 15, 30, 60, 120, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = [rng.choice(words) if rng.random() < 0.02 else w for w in base]
            rows.append((len(rows) * 7 % 1000, " ".join(copy[: len(copy) - rng.randint(0, len(copy) // 10)])))
    big = [rng.choice(words) for _ in range(150)]  # one family whose members drift apart
    rows += [(5000 + n, " ".join(rng.choice(words) if rng.random() < 0.03 else w for w in big)) for n in range(80)]
    return rows


def order(row):
    return tuple((v is not None, v) for v in row)


def test_jaccard_components(spark):
    rows = varied() + AWKWARD
    got = [tuple(r) for r in jaccard.jaccard_components(frame(spark, rows)).collect()]
    assert sorted(got, key=order) == sorted(brute.jaccard_components(rows), key=order)
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0


def test_exact_copies_in_several_partitions_link_with_near_copies(spark):
    rng = random.Random(8)
    rows = []
    for family in range(60):
        base = [f"v{rng.randint(0, 5000)}" for _ in range(rng.choice([40, 90, 200]))]
        near = [" ".join(base[:-1] + [f"end{family}_{n}"]) for n in range(1 + family % 2)]
        rows += [" ".join(base)] * 3 + near[:1] * (1 + family % 3) + near[1:]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = frame(spark, rows).repartition(8, "doc_id")
    got = [tuple(r) for r in jaccard.jaccard_components(docs).collect()]
    assert sorted(got) == sorted(brute.jaccard_components(rows))


@pytest.mark.parametrize("level", range(2, 40))
def test_more_parts_than_differences(level):
    parts, most = jaccard.level_parts(level)
    assert parts > most


def test_bpe_is_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = [
        "Hello, World!", "don't they'll X'S", "ÀÉÎ́ İ ΑΣ Σ.", "<|startoftext|>a<|endoftext|> <|x|>", "\x1c\x1d a\x1fb",
        "日本語 123 ²½ \x00", "  ", "é ́", "word " * 500,
    ]
    df = frame(spark, list(enumerate(texts)))
    coded = bpe.decode(bpe.encode(df, tokenizer_path()), tokenizer_path())
    for row in coded.collect():
        want = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == want and row["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.digests(frame(spark, AWKWARD), tokenizer_path()).count() == len(AWKWARD)
    assert bpe.digests(frame(spark, []), tokenizer_path()).count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    points = rng.standard_normal((1500, 16)).round(4)
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    rows += [(2000 + i, rows[50][1]) for i in range(300)]  # a crowd of equal vectors
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [None] * 16), (None, rows[0][1]), (9050, [1.0])]
    df = spark.createDataFrame(rows + odd + rows[:1], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") % 50 == 0, 5).collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = {(r["query_id"], r["rank"]): r["id"] for r in found}
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x @ x[q]).round(12)
        score[q] = -9
        best = ids[np.lexsort((ids, -score))[:5]].tolist()
        mine = [got[int(ids[q]), n] for n in range(1, 6)]
        hits += len(set(best) & set(mine))
        total += 5
    assert hits / total >= 0.9
    assert [got[2000, n] for n in range(1, 6)] == [50, 2001, 2002, 2003, 2004]
    assert neighbours.nearest(df.limit(0), F.col("id") % 50 == 0, 5).count() == 0


def test_nearest_neighbours_in_a_crowd_of_near_copies(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[::3] = x[0] + 0.0045 / 8 * rng.standard_normal((2000, 64))  # cosines of about 0.99998
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") % 150 == 0, 5, curves=24, window=0.1, least_block=64).collect()
    x /= np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, 6000, 150):
        score = x @ x[q]
        score[q] = -9
        hits += len(set(np.argsort(-score)[:5].tolist()) & {r["id"] for r in found if r["query_id"] == q})
    assert hits / 200 >= 0.9, hits / 200


def test_nearest_neighbours_where_windows_select(spark):
    x = np.random.default_rng(7).standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") % 150 == 0, 5, curves=24, window=0.1, least_block=64).collect()
    hits = 0
    for q in range(0, 6000, 150):
        score = x @ x[q]
        score[q] = -9
        hits += len(set(np.argsort(-score)[:5].tolist()) & {r["id"] for r in found if r["query_id"] == q})
    assert hits / 200 >= 0.9, hits / 200


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"),
             (4, 0, "user", None), (4, 0, "user", None), (None, 0, "user", "lost"), (5, None, "user", "lost"), (6, 0, None, "hi")]
    turns += [(7, n, "user", f"t{n}") for n in range(600)] + [(8, n, "user", f"t{n}") for n in range(300)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("position", F.lit(1))
    rows = {(r["conv_id"], r["part"]): r for r in chat.collapse(df).collect()}
    assert sorted(rows) == [(2, 0), (4, 0), (6, 0), (7, 0), (7, 1), (7, 2)]
    assert rows[2, 0]["copies"] == 2 and rows[2, 0]["text"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert chat.collapse(df.limit(0)).count() == 0


def test_scores_of_awkward_texts(spark):
    rows = {r["doc_id"]: r for r in lm.scores(frame(spark, [*AWKWARD, (9, "a b c"), (10, "a b c")])).collect()}
    assert len(rows) == 9 - 1 and rows[1]["n_words"] == 0 and rows[1]["mean_log10"] is None and rows[2]["log10_score"] == 0
    assert rows[9]["log10_score"] == rows[10]["log10_score"] < 0
    assert lm.scores(frame(spark, [])).count() == 0


def test_leaks(spark):
    rng = random.Random(2)
    item = [f"b{i}" for i in range(30)]
    noise = [f"n{rng.randint(0, 500)}" for _ in range(200)]
    changed = [w if i % 9 else "other" for i, w in enumerate(item)]
    half = [w if i % 2 else "other" for i, w in enumerate(item)]
    docs = frame(spark, [(10, " ".join(noise[:50] + item + noise[50:])), (11, " ".join(changed).upper()), (12, " ".join(half)),
                         (13, " ".join(item[:8] + noise)), (14, " ".join(noise)), *AWKWARD])
    bench = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(docs, bench).collect()) == [(10, 1), (11, 1)]
    assert leaks.without_leaks(docs, bench).count() == docs.count() - 2
    assert leaks.leaks(docs, bench.limit(0)).count() == 0 and leaks.leaks(docs.limit(0), bench).count() == 0


def test_leaks_with_substitutions_in_every_place(spark):
    docs, want = [], set()
    items = {n: [f"i{n}x{j}" for j in range(n)] for n in (6, 8, 10, 12, 13, 15, 16, 26)}
    for n, item in items.items():
        for count in range(1, 4):
            for places in combinations(range(n), count):
                if n == 26 and not set(places) <= {12, 16, 20, 25, 0}:
                    continue
                doc = len(docs)
                docs.append((doc, " ".join(["pad", *(f"z{j}" if j in places else w for j, w in enumerate(item)), "pad"])))
                if brute.leaks([w not in docs[-1][1].split() for w in item]):
                    want.add((doc, n))
    bench = spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id long, text string")
    rows = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want


@pytest.mark.parametrize("n", [*range(6, 26)])
def test_masks_meet_every_stretch(n):
    masks = [int(m, 2) for m in (leaks.MASKS if n >= leaks.SHORT else leaks.SHORT_MASKS)]
    words = np.array([(1 << n) - 1 - sum(1 << p for p in places) for places in combinations(range(n), n // 5)])
    met = np.zeros(len(words), bool)
    for mask in masks:
        for at in range(n - mask.bit_length() + 1):
            met |= (words >> at) & mask == mask
    assert met.all()


def test_every_stretch_of_a_diagonal():
    rng = np.random.default_rng(4)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 60)) < rng.choice([0.5, 0.7, 0.8, 0.9])
        need = min(13, len(equal))
        found = leaks.stretches(equal, need, 0.8)
        assert bool(found) == brute.leaks(~equal)
        assert all(b - a >= need and 5 * equal[a:b].sum() >= 4 * (b - a) for a, b in found)
        assert all(b <= c for (_, b), (c, _) in zip(found, found[1:]))
    both = np.array([True] * 20 + [False] * 20 + [True] * 15)
    assert leaks.stretches(both, 13, 0.8) == [(0, 20), (40, 55)]


def test_licenses(spark):
    apache = licenses.TEMPLATES["Apache-2.0"][0]
    docs = frame(spark, [(20, f"x y {apache}. z"), (21, apache.replace("Apache", "the Apache Software").upper()), (22, "Licensed to nobody"), *AWKWARD])
    rows = licenses.scan(docs).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == [(20, "Apache-2.0"), (21, "Apache-2.0")]
    text = f"x y {apache}. z"
    assert [text[r["start_byte"] : r["end_byte"]] for r in rows if r["doc_id"] == 20] == [apache]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licenses_are_told_from_their_relatives(spark):
    cases = {
        "Licensed under CC BY 4.0": ["CC-BY-4.0"],
        "Licensed under CC BY-SA 4.0": ["CC-BY-SA-4.0"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
        "Licensed under CC BY-NC 3.0": [],
        "This work is licensed under the GNU General Public License, version 2": ["GPL-2.0"],
        "This work is licensed under the GNU General Public License, version 3": ["GPL-3.0"],
        "This work is licensed under the GNU Affero General Public License, version 3": ["AGPL-3.0"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": ["CC-BY-SA-4.0"],
        "This work is licensed under a Creative Commons Attribution 4.0 International License": ["CC-BY-4.0"],
        "It was not licensed under the Apache License, Version 2.0": [],
        "SPDX-License-Identifier: MIT": ["MIT"],
        "SPDX-License-Identifier: GPL-2.0-only": ["GPL-2.0"],
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007": ["GPL-3.0"],
        "Released under the MIT License. Licensed under CC BY 4.0": ["MIT", "CC-BY-4.0"],
        "Released under the MIT License\nReleased under the MIT License": ["MIT", "MIT"],
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {n: [] for n in range(len(cases))}
    for row in sorted(licenses.scan(docs).collect(), key=lambda r: (r["doc_id"], r["start_byte"])):
        found[row["doc_id"]].append(row["license"])
    assert dict(zip(cases, found.values(), strict=True)) == cases


def test_short_wordings_match_whole(spark):
    docs = spark.createDataFrame([(1, "public domain"), (2, "a public, domain!"), (3, "public"), (4, "domain public")], "doc_id long, text string")
    rows = licenses.scan(docs, {"PD": "Public Domain", "none": ""}).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2]


def test_alignment_finds_edited_notices():
    rng = np.random.default_rng(9)
    for _ in range(200):
        template = np.arange(100, 120, dtype=np.uint64)
        kept, edited = 0, []
        for place, word in enumerate(template.tolist()):
            edit = rng.choice(["keep", "drop", "replace", "insert"], p=[0.85, 0.05, 0.05, 0.05]) if 3 < place < 16 else "keep"
            kept += edit in ("keep", "insert")
            edited += {"keep": [word], "drop": [], "replace": [7], "insert": [8, word]}[str(edit)]
        before = int(rng.integers(0, 6))
        text = np.array([1] * before + edited + [2] * 5, np.uint64)
        matched, a, b = licenses.align(text, template, before + int(rng.integers(-2, 3)))
        assert (matched, a, b) == (kept, before, before + len(edited))


def test_models_without_rows_and_awkward_texts(spark):
    docs, labels = frame(spark, AWKWARD), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert langid.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert toxicity.fit(docs, labels) is None and quality.fit(docs, labels) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert toxicity.rate(docs, None).count() == quality.rate(docs, None).count() == len(AWKWARD)


def test_language_and_toxicity_learn(spark):
    rng = random.Random(5)
    parts = {"aa": "ka lo mi ta pu".split(), "bb": "str ent ung sch ier".split()}
    word = lambda l: "".join(rng.choice(parts[l]) for _ in range(3))
    rows = []
    for i in range(400):
        lang, bad = rng.choice(["aa", "bb"]), i % 4 == 0
        words = [word(lang) for _ in range(30)]
        if bad:
            words[rng.randrange(30)] = rng.choice(["wretch", "w.r.e.t.c.h", "wrettch"])
        rows.append((i, " ".join(words), lang, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    named = langid.identify(docs.unionByName(docs.select(F.lit(-1).cast("long").alias("doc_id"), F.lit("12 !?").alias("text"), "lang", "toxic").limit(1)), langid.fit(docs.where("doc_id < 300")))
    assert named.where("doc_id >= 0 and lang != lang_pred").count() == 0 and named.where("doc_id = -1").first()["lang_pred"] == "und"
    model = toxicity.fit(docs.select("doc_id", "text"), docs.where("doc_id < 300").select("doc_id", "toxic"))
    rated = toxicity.rate(docs.where("doc_id >= 300"), model)
    assert rated.where("predicted != toxic").count() <= 3
    spaced = toxicity.rate(spark.createDataFrame([(1, f"{word('aa')} w r e t c h {word('aa')}")], "doc_id long, text string"), model)
    assert spaced.first()["predicted"] == 1
