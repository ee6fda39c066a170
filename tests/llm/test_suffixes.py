from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_fixtures import collected, frame  # noqa: F401

from salesmart.llm import suffixes


def brute(rows):
    first, place = {}, lambda i, s: (-1 if i is None else i, s)
    for i, t in rows:
        held = (t or "").encode()
        for s in range(len(held) - 99):
            key = held[s : s + 100]
            first[key] = min(first.get(key, place(i, s)), place(i, s))
    out = []
    for i, t in rows:
        held = (t or "").encode()
        gone = np.zeros(len(held), bool)
        for s in range(len(held) - 99):
            if first[held[s : s + 100]] < place(i, s):
                gone[s : s + 100] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(held), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(held, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=repr)


def sample(seed):
    rng = random.Random(seed)
    parts = ["the", "of", "and", "thé", "ingon", "reat", "ßtion", "a", "heon", "x"]
    text = lambda n: " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    passages = [text(k) for k in (15, 18, 22, 40, 90, 200)]
    rows = [(None, None), (None, passages[3]), (1, ""), (2, "short"), (3, "short"), (4, "ab " * 200), (5, "ab " * 90 + text(30) + "ab " * 60),
            (6, "x" * 99), (7, "x" * 100), (8, "x" * 101), (9, "y" * 350), (9, passages[4]), (9, passages[4])]
    i = 10
    for _ in range(60):
        held = text(rng.randrange(0, 60))
        for _ in range(rng.randrange(0, 4)):
            held += " " + rng.choice(passages) + " " + text(rng.randrange(0, 20))
        rows.append((i, held))
        if rng.random() < 0.3:
            rows.append((i + 1, held))
            rows.append((i + 2, held[: len(held) // 2] + "Q" + held[len(held) // 2 :]))
        i += 3
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("batches", "many"), [(4, suffixes.MANY), (1, 3)])
def test_against_all_strings(frame, batches, many):
    rows = sample(batches)
    assert collected(suffixes.repeated_passages(frame(rows), batches=batches, many=many)) == brute(rows)


def test_arrays_merge_like_a_counter(spark, frame):
    family = suffixes.Family(spark, 3)
    ranks = []
    for k in range(5):
        docs = frame([(f"{k} {j} " + "some words in a row " * 8 + str(k * j) * 40,) for j in range(3)], "body string")
        family.add(docs)
        ranks.append([rank for rank, _ in family.levels])
    assert ranks == [[0], [0, 0], [1, 0], [1, 0, 0], [2, 0]]
    assert spark.table(family.levels[0][1]).count() > 0
    family.drop()


def test_no_rows(frame):
    assert suffixes.repeated_passages(frame([])).count() == 0
