from __future__ import annotations

import hashlib
import re

import pytest
from llm_fixtures import collected, frame  # noqa: F401

from salesmart.llm import exact

ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a  b"), (8, "Ab"), (9, "a\u00a0b"), (9, "a\u00a0b"), (10, "é" * 50), (11, "x" * 200_000),
        (None, "ab"), (12, "lone")] + [(100 + k, "many\x0bcopies") for k in range(500)]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), -1 if i is None else i))
    out, seen = [], set()
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[key])[1]
        kept = (-1 if i is None else i) == keep and (key, keep) not in seen
        seen |= {(key, keep)} if kept else set()
        out.append((i, None if keep == -1 else keep, len(groups[key]), kept, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells", [1 << 12, exact.MAX_CELLS])
def test_groups(frame, cells):
    assert collected(exact.exact_groups(frame(ROWS), max_cells=cells)) == brute(ROWS)


def test_kept_rows_have_their_columns(frame):
    rows = [(i, t, f"s{k}", k) for k, (i, t) in enumerate(ROWS)]
    kept = exact.drop_copies(frame(rows, "doc_id long, text string, Text_Digest string, may_repeat int"))
    assert kept.columns == ["doc_id", "text", "Text_Digest", "may_repeat"]
    assert sorted(map(repr, (r[0] for r in kept.collect()))) == sorted(repr(r[0]) for r in brute(ROWS) if r[3])


def test_unrepeated_rows_are_not_shuffled(frame):
    digests = exact.with_digests(frame([(k, f"text {k // 2 if k < 10 else k}") for k in range(400)]).withColumnRenamed("text", "body"), "body", "sha", "points")
    flagged = exact.flag_repeated(digests, "sha", "maybe", exact.repeats_of(digests, "sha"))
    maybe = {r.doc_id for r in flagged.where("maybe").collect()}
    assert set(range(10)) <= maybe
    assert len(maybe) < 40


def test_no_rows(frame):
    assert exact.exact_groups(frame([])).count() == 0
    assert exact.drop_copies(frame([])).count() == 0
