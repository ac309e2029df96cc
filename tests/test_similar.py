"""Best names by bounds: edit distances, bounds that hold, and the same names as scoring every pair."""

import random

import numpy as np
import pytest

from pilotlamp.operators import names, similar


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def word(rng, n, letters="abcä漢𝄞"):
    return "".join(rng.choice(letters) for _ in range(n))


def test_distances_and_bounds():
    rng = random.Random(1)
    for _ in range(20):
        many = [word(rng, rng.choice([0, 1, 5, 20, 70, 100])) for _ in range(30)]
        block = similar.Block([many], [[] for _ in many])
        for m in (0, 1, 7, 63, 64, 65, 90):
            one = word(rng, m, "abcdä𝄞")
            want = [edits(one, x) for x in many]
            assert similar.distances(one, block.codes[0], block.lengths[0]).tolist() == want
            bound = block.bounds([one], [], [])
            assert all(not max(len(one), len(x)) or r >= 1 - d / max(len(one), len(x)) for r, d, x in zip(bound.ratios[0], want, many, strict=True))
            assert all(c or not (x and one and (x in one or one in x)) for c, x in zip(bound.contained[0], many, strict=True))


def ratio(a, b):
    return 1 - edits(a, b) / max(len(a), len(b)) if a or b else 0.0


def directory(a, b):
    shared, union = len(set(a[1]) & set(b[1])), len(set(a[1]) | set(b[1]))
    return ratio(a[0], b[0]) * 0.75 + (shared / union if union else 0.0) * 0.25


@pytest.mark.parametrize("left_rows,right_rows", [(128, 4096), (3, 7)])
def test_best_k_equals_all_pairs(spark, left_rows, right_rows):
    rng = random.Random(2)
    row = lambda i, side: (f"{side}{i:03d}", word(rng, rng.randint(0, 9), "abc"), rng.sample(["x", "y", "z", "w1"], rng.randint(0, 3)))
    a, b = [row(i, "a") for i in range(40)], [row(i, "b") for i in range(60)]
    kind = "name string, key string, words array<string>"
    left, right = spark.createDataFrame([*a, ("null", None, None)], kind), spark.createDataFrame(b, kind)
    found = similar.best_k(left, right, ["key"], "words", names.directory_score, 3, left_rows=left_rows, right_rows=right_rows).collect()
    got = {}
    for r in sorted(found, key=lambda r: r.place):
        got.setdefault(r.name, []).append((r.item, r.score))
    for name, key, words in [*a, ("null", "", [])]:
        want = sorted(((directory((key, words), x[1:]), x[0]) for x in b), key=lambda s: (-s[0], s[1]))[:3]
        assert got[name] == [(n, s) for s, n in want]
    assert similar.best_k(left, right.where("false"), ["key"], "words", names.directory_score, 3).count() == 0
    assert similar.best_k(left.where("false"), right, ["key"], "words", names.directory_score, 3).count() == 0


def test_few_names_are_scored():
    rng = random.Random(3)
    many = [f"{rng.choice(['brand', 'plant', 'tower'])}{rng.randint(1, 40)}{word(rng, 8, 'abcdefgh')}" for _ in range(4000)]
    block = similar.Block([many], [[] for _ in many])
    score = lambda f: f.ratios[0]
    seen = []
    for m in many[:100]:
        one = m[:-1] + "x"
        rows, scores, _, n = similar.best_of(block, [one], [], [], score, 1)
        assert scores[0] == max(ratio(one, x) for x in many if abs(len(x) - len(one)) < 2)
        seen.append(n)
    assert np.mean(seen) < 0.1 * len(many)


def test_token_set_ratio(spark):
    from pilotlamp.functions.similarity import token_set_ratio
    data = [("a b", "b  a a", 1.0), ("a b c", "c", 1.0), ("", "a", 0.0), (" ", " ", 0.0), ("ab", "cd", 0.0), ("x ab", "x ac", 0.75), (None, "a", None)]
    df = spark.createDataFrame(data, "a string, b string, want double")
    assert all(r.got == r.want for r in df.withColumn("got", token_set_ratio(df.a, df.b)).collect())
