"""Licence notices and texts by template markup.

A template is plain wording with marked regions: ``<<beginOptional>> ... <<endOptional>>`` may be left out (and nested),
``<<var;name="..";words="0-40">>`` stands for any so many words, and ``<<var;name="..";match="one|other">>`` for one of several
wordings. It is compiled to an automaton over words: one position per word of the template, and for each position the
positions that may follow. A place in a text is accepted if the automaton reads it through to the end, that is, if all
mandatory words stand there exactly and in order, with nothing between them but what the regions allow. Case and marks
don't count, as words are compared.

Each template has an anchor, its longest run of mandatory words (four at most). Anchors and fixed phrases are looked up by hash
in whole slices of documents; automata run only from possible beginnings near an anchor, and no further than their
template is long, so a text takes time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm import arrays
from salesmart.llm.decontamination import word_hashes
from salesmart.llm.license_texts import TEMPLATES

#: Phrases whose words are a place of their own, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Score of a text that has a phrase but no accepted template.
PHRASE_SCORE = 0.5
_ANCHOR = 4
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(.*?)>>", re.DOTALL)
_A = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass
class Automaton:
    """Positions in the order of the template. ``word`` is None where any word may stand; ``depth`` counts the mandatory
    words up to a position, ``mandatory`` all of them."""

    label: str
    word: list[bytes | None] = field(default_factory=list)
    follow: list[set[int]] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    first: set[int] = field(default_factory=set)
    last: set[int] = field(default_factory=set)
    mandatory: int = 0
    anchor: list[bytes] = field(default_factory=list)
    anchor_at: int = 0

    def position(self, word: bytes | None, needed: bool) -> int:
        self.mandatory += needed
        self.word.append(word)
        self.follow.append(set())
        self.depth.append(self.mandatory)
        return len(self.word) - 1

    def run(self, words: list[bytes]) -> tuple[int, float]:
        """The length of the longest accepted beginning of ``words`` (0 if none), and how far the mandatory words came, below 1."""
        active, end, depth = {p for p in self.first if self.word[p] == words[0]}, 0, 0
        for n, word in enumerate(words, 1):
            if n > 1:
                active = {q for p in active for q in self.follow[p] if self.word[q] is None or self.word[q] == word}
            if not active:
                break
            depth = max(depth, *(self.depth[p] for p in active))
            if not active.isdisjoint(self.last):
                end = n
        return end, depth / (self.mandatory + 1)


@dataclass
class _Part:
    """What a piece of a template can begin and end with; ``empty``: it may be left out."""

    first: set[int]
    last: set[int]
    empty: bool


def _sequence(found: Automaton, parts: list[_Part]) -> _Part:
    out = _Part(set(), set(), True)
    for part in parts:
        for p in out.last:
            found.follow[p] |= part.first
        out = _Part(out.first | part.first if out.empty else out.first, out.last | part.last if part.empty else part.last, out.empty and part.empty)
    return out


def _wording(found: Automaton, words: list[bytes], needed: bool) -> _Part:
    return _sequence(found, [_Part({p}, {p}, False) for p in (found.position(w, needed) for w in words)])


def _region(found: Automaton, mark: str) -> _Part:
    given = dict(re.findall(r'(\w+)="([^"]*)"', mark))
    if "match" in given:
        ways = [_wording(found, words_of(way), False) for way in given["match"].split("|")]
        return _Part(set().union(*(w.first for w in ways)), set().union(*(w.last for w in ways)), any(w.empty for w in ways))
    least, _, most = given["words"].partition("-")
    chain = [found.position(None, False) for _ in range(int(most or least))]
    for p, q in zip(chain, chain[1:]):
        found.follow[p].add(q)
    return _Part(set(chain[:1]), set(chain[max(0, int(least) - 1) :]), int(least) == 0)


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template, which has to begin with a word and to hold a mandatory one."""
    found = Automaton(label)
    levels: list[list[_Part]] = [[]]
    runs: list[tuple[int, list[bytes]]] = []
    for k, piece in enumerate(_MARK.split(markup)):
        if k % 2 == 0:
            words = words_of(piece)
            if words and len(levels) == 1:
                runs.append((len(found.word), words))
            if words:
                levels[-1].append(_wording(found, words, len(levels) == 1))
        elif piece == "beginOptional":
            levels.append([])
        elif piece == "endOptional":
            if len(levels) == 1:
                raise ValueError(f"{label}: an optional region ends that did not begin")
            inner = _sequence(found, levels.pop())
            levels[-1].append(_Part(inner.first, inner.last, True))
        elif piece.startswith("var;"):
            levels[-1].append(_region(found, piece))
        else:
            raise ValueError(f"{label}: unknown mark {piece!r}")
    if len(levels) > 1:
        raise ValueError(f"{label}: an optional region does not end")
    whole = _sequence(found, levels[0])
    found.first, found.last = whole.first, whole.last
    if not runs or whole.empty or any(found.word[p] is None for p in whole.first):
        raise ValueError(f"{label}: a template begins with a word and has mandatory wording")
    found.anchor_at, longest = max(runs, key=lambda r: min(len(r[1]), _ANCHOR))
    found.anchor = longest[:_ANCHOR]
    return found


def _chained(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` words from each word on."""
    out = hashes[: max(0, len(hashes) - k + 1)].copy()
    for j in range(1, k):
        out = arrays.mix(out * _A + hashes[j : len(hashes) - k + 1 + j])
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    return word_hashes(data, np.array([0, len(data)]))[4]


class Scanner:
    """Compiled templates and phrases; ``scan`` finds them in a slice of texts."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.automata = [compile_template(label, markup) for label, markup in templates]
        self.phrases = [(words_of(phrase), label) for phrase, label in phrases.items()]
        self.sizes = sorted({len(a.anchor) for a in self.automata} | {len(w) for w, _ in self.phrases})
        self.anchors = [_chained(_hashes(a.anchor), len(a.anchor))[0] for a in self.automata]
        self.keys = [_chained(_hashes(w), len(w))[0] for w, _ in self.phrases]
        self.begins = [np.unique(np.concatenate([_hashes([a.word[p]]) for p in sorted(a.first)])) for a in self.automata]

    def scan(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[list[tuple]], list[list[tuple]], np.ndarray]:
        """Words of each row; its phrases as (label, first word); its accepted templates as (label, first word, word after the last); its score."""
        low, starts, ends, rows, hashes = word_hashes(data, at)
        n = arrays.counts(rows, len(at) - 1)
        bounds = np.concatenate([[0], np.cumsum(n)])
        chained = {k: _chained(hashes, k) for k in self.sizes}
        held = low.tobytes()
        words = lambda a, b: [held[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
        phrases: list[list[tuple]] = [[] for _ in n]
        matches: list[list[tuple]] = [[] for _ in n]
        score = np.zeros(len(n))
        for (phrase, label), key in zip(self.phrases, self.keys, strict=True):
            for p in np.flatnonzero(chained[len(phrase)] == key).tolist():
                row = int(rows[p])
                if p + len(phrase) <= bounds[row + 1] and words(p, p + len(phrase)) == phrase:
                    phrases[row].append((label, p - int(bounds[row])))
                    score[row] = max(score[row], PHRASE_SCORE)
        for automaton, key, begins in zip(self.automata, self.anchors, self.begins, strict=True):
            near = np.flatnonzero(chained[len(automaton.anchor)] == key)
            if not len(near):
                continue
            first = np.flatnonzero(np.isin(hashes, begins))
            later = np.searchsorted(near, first)
            first = first[(later < len(near)) & (near[np.minimum(later, len(near) - 1)] <= first + automaton.anchor_at)]
            taken = 0
            for p in first.tolist():
                if p < taken:
                    continue
                row = int(rows[p])
                end, far = automaton.run(words(p, min(p + len(automaton.word), int(bounds[row + 1]))))
                if end:
                    taken = p + end
                    matches[row].append((automaton.label, p - int(bounds[row]), taken - int(bounds[row])))
                score[row] = max(score[row], 1.0 if end else far)
        return n, phrases, matches, score


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")
_MATCH = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
_KINDS = ("long", "long", "long", "long", "array<string>", "array<string>", "double", "array<struct<label:string,first:long,last:long>>")


def scan_licenses(docs: DataFrame, *, text_column: str = "text", keep: list[str], templates: list[tuple[str, str]] | None = None,
                  phrases: dict[str, str] | None = None, names: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Columns ``keep`` of each row with, called ``names``: words, places of phrases, the first words of the first and last place (NULL if
    none), labels of the phrases, labels of phrases and accepted templates (both distinct and sorted), a score, and the accepted places.

    The score is 1 where a template is accepted. Else it is how far the mandatory words of any template came, and at least
    ``PHRASE_SCORE`` where a phrase stands; 0 without either. ``last`` of a place is the word after it; places of one template
    don't overlap, those of different templates may. NULL and word-free texts have no words, no labels and score 0.
    Rows that repeat, and NULL ids, are judged one by one. An empty table gives no rows.
    """
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases))
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in arrays.slices(batches, text_column):
            n, found, matches, score = scanner.value.scan(data, at)
            own = [sorted({label for label, _ in row}) for row in found]
            every = [sorted({*labels, *(m[0] for m in row)}) for labels, row in zip(own, matches, strict=True)]
            out = [
                pa.array(n, pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array([min((p for _, p in x), default=None) for x in found], pa.int64()),
                pa.array([max((p for _, p in x), default=None) for x in found], pa.int64()), pa.array(own, pa.list_(pa.string())), pa.array(every, pa.list_(pa.string())),
                pa.array(score, pa.float64()), pa.array([[dict(zip(("label", "first", "last"), m, strict=True)) for m in sorted(x, key=lambda m: (m[1], m[0]))] for x in matches], pa.list_(_MATCH))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], [*keep, *names])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{n}` {k}" for n, k in zip(names, _KINDS, strict=True))])
    return docs.select(*dict.fromkeys([*keep, text_column])).mapInArrow(run, schema)
