from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_fixtures import collected, frame  # noqa: F401

from salesmart.llm import similarity
from salesmart.llm.components import components


def sets_of(rows):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute(rows):
    sets, parent = sets_of(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return sorted(((i, len(sets[k]), low.get(root(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def sample(seed):
    rng = random.Random(seed)
    doc = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]

    def edited(words, times):
        words = list(words)
        for _ in range(times):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = doc(rng.randrange(1, 3))
        return words

    rows = [(None, None), (None, "a b"), (None, "a b"), (5, ""), (6, "  "), (7, "A b"), (8, "one two three four five"), (9, "one two  three\nFOUR five"), (8, "x")]
    passage, i = doc(60), 10
    for _ in range(25):
        base = doc(rng.choice([6, 20, 60, 150, 400]))
        for _ in range(rng.choice([1, 2, 8, 20])):
            rows.append((i, " ".join(edited(base, rng.randrange(0, len(base) // 25 + 2)))))
            i += 1
    for _ in range(30):
        rows.append((i, " ".join(doc(rng.randrange(120)) + passage + doc(rng.randrange(120)))))
        i += 1
    rows.append((i, "very long " + " ".join(doc(20_000))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("frequent", "cell"), [(256, 512), (3, 4)])
def test_groups(frame, frequent, cell):
    rows = sample(frequent)
    found = similarity.jaccard_groups(frame(rows), frequent=frequent, cell=cell)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert collected(found) == brute(rows)


@pytest.mark.parametrize("deal_rows", [1, 7])
def test_groups_whatever_the_deals(frame, monkeypatch, deal_rows):
    """Deals cut into shares of a few rows, whole cells at least, find the same groups."""
    monkeypatch.setattr(similarity, "DEAL_ROWS", deal_rows)
    rows = sample(11)
    assert collected(similarity.jaccard_groups(frame(rows), frequent=8, cell=16)) == brute(rows)


def test_walk_keeps_all_links():
    rng = np.random.default_rng(0)
    for _ in range(20):
        base = [rng.integers(0, 1 << 63, rng.integers(4, 80)).astype(np.uint64) for _ in range(12)]
        sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.05], rng.integers(0, 1 << 63, 2).astype(np.uint64)])) for b in base for _ in range(5)]
        sizes, groups = np.array([len(s) for s in sets]), np.arange(len(sets))
        bits = [similarity.signature(s).tobytes() for s in sets]
        all_places = np.arange(len(sets))
        found = {(min(a, b), max(a, b)) for i, j in similarity.cell_pairs(sizes, bits, groups, all_places, all_places) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
        true = {(a, b) for b in range(len(sets)) for a in range(b) if similarity.enough(len(np.intersect1d(sets[a], sets[b])), sizes[a], sizes[b])}
        assert true <= found
        assert len(found) < len(sets) * (len(sets) - 1) / 4


def test_one_of_each_group_stays(frame):
    rows = [(i, t, f"s{i}") for i, t in sample(4)]
    kept = similarity.keep_one(frame(rows, "doc_id long, text string, component_id string"))
    assert kept.columns == ["doc_id", "text", "component_id"]
    gone = {r[0] for r in brute([r[:2] for r in rows]) if r[0] is not None and r[0] != r[2]}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r[0]) for r in rows if r[0] not in gone)


def test_rows_of_an_id_are_judged_one_by_one(frame):
    copied, alone, third = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(1, copied, 0), (2, copied, 1), (2, alone, 2), (2, "", 3), (3, copied, 4), (4, None, 5),
            (None, copied, 6), (None, third, 7), (None, third + " x", 8), (None, third, 9), (None, None, 10), (None, "", 11)]
    kept = [r.node for r in similarity.keep_one(frame(rows, "doc_id long, text string, node int")).collect()]
    assert sorted(set(kept) - {7, 8, 9}) == [0, 2, 3, 5, 6, 10, 11]
    assert len(kept) == 8


def test_components_of_a_long_chain_and_a_star(frame):
    links = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (3, 2)]
    found = dict(collected(components(frame(links, "a long, b long"))))
    assert {found[k] for k in range(61)} == {0}
    assert {found[k] for k in range(1000, 1100)} == {1000}


def test_no_rows(frame):
    assert similarity.jaccard_groups(frame([])).count() == 0


def test_common_members_of_many_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 900, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    x, y = (k.ravel() for k in np.meshgrid(np.arange(20), np.arange(20, 40)))
    few = np.concatenate([similarity.common_members(sets, x[k : k + 100], y[k : k + 100]) for k in range(0, 400, 100)])
    assert (similarity.common_members(sets, x, y) == few).all()
