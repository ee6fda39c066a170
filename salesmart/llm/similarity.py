"""Jaccard join of documents on word shingles with signature trees, and the groups that the links form.

Documents with equal shingle sets are one node. Nodes meet in blocks: a node lies in the block of each shingle of its
prefix, its ``n - ceil(0.8 n) + 1`` first shingles in one order for all documents; two sets that reach the threshold
share one of them. The order is by hash, with frequent shingles last, so that a passage that many documents share
brings only documents together that consist of such passages. A block is one shingle's nodes of one band of sizes and the band
below; sizes at a ratio of 0.8 are never further apart.

Inside a block the nodes are leaves of signature trees. A signature is a bitmap of hashed shingles; a tree node holds
the OR of the bitmaps below and the range of set sizes. Two trees are walked together, and a pair of tree nodes is dropped
when no pair of sets below can reach the threshold: they differ too much in size, or their common bits, and what may
hide behind shared bits, are too few. Nodes that keep a partner are compared exactly, on their texts;
the cells of a neighbourhood are dealt to one task, so that it needs each text once.

Links only matter between different groups. First every node is compared with the smallest node of each of its blocks,
and blocks whose nodes are all in one group by then are done; only the others are walked, and only between groups. A
block is walked in cells of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm import arrays
from salesmart.llm.components import components
from salesmart.llm.storage import unused, written
from salesmart.operators.joins import splittable_join

WORDS = 5
#: A shingle of more nodes than this, or than this share of the rows, comes last in the order of the prefixes. The list
#: of such shingles is broadcast; by the share it holds less than (mean set size) / FREQUENT_SHARE numbers.
FREQUENT, FREQUENT_SHARE = 256, 1e-4
#: Nodes on either side of a cell; cells of at most SMALL rows are compared without a tree above the leaves.
CELL, SMALL = 512, 24
CELL_KEY = ("token", "band", "i", "j")
#: Bits of a signature for each member, at least; with fewer, chance and shared bits let most pairs of a cell through.
BITS_PER_MEMBER = 2
#: Rows of cells that are compared with the same texts in hand; a deal of more rows is cut between cells.
DEAL_ROWS = 1 << 12
#: Most active ids that are broadcast (8 bytes each) to fetch their texts; more are joined.
BROADCAST_IDS = 1_000_000
_LEAF, _FAN = 8, 4
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_TASK_TOKENS = 1 << 19
#: Pairs of a deal that are remembered as compared (8 bytes each); others may be compared again, with the same result.
_PAIRS_KEPT = 1 << 20


def enough(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """100 * intersection >= 80 * union, for sets of a and b members."""
    return 9 * common >= 4 * (a + b)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    low = arrays.LOWER[data]
    starts, ends, rows = arrays.words(low, at, arrays.SPACES)
    word = arrays.span_hashes(arrays.running(low), starts, ends)
    n = arrays.counts(rows, len(at) - 1)
    first = np.cumsum(n) - n
    full = max(0, len(word) - WORDS + 1)
    joined = np.zeros(full, np.uint64)
    for j in range(WORDS):
        joined = joined * _FACTOR + word[j : j + full]
    joined = arrays.mix(joined)
    out = []
    for a, k in zip(first.tolist(), n.tolist(), strict=True):
        if k >= WORDS:
            out.append(np.unique(joined[a : a + k - WORDS + 1]))
        elif k:
            h = np.uint64(k)
            for w in word[a : a + k]:
                h = np.array([h]) * _FACTOR + w
                h = h[0]
            out.append(arrays.mix(np.array([h ^ np.uint64(0xA5A5A5A5)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(members: np.ndarray) -> int:
    """A number for the set: with 64 bits, two of a billion different sets share one with odds of 1 in 37."""
    if not len(members):
        return 0
    return int(arrays.mix(np.array([arrays.mix(members * _FACTOR).sum() + np.uint64(len(members))]))[0].astype(np.int64))


def signature(members: np.ndarray) -> np.ndarray:
    """A bitmap of at least ``BITS_PER_MEMBER`` bits per member, in bytes; its width is a power of two."""
    width = 64
    while width < BITS_PER_MEMBER * len(members):
        width *= 2
    bits = np.zeros(width, bool)
    bits[(members & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _sets_and_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, node, n), and rows (token, times) of the shingles that this task saw twice or more."""
    held, size = [], 0

    def repeated() -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(held), return_counts=True)
        tokens, times = tokens[times > 1].view(np.int64), times[times > 1]
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays([none.cast(kind), none, none, pa.array(tokens), pa.array(times.astype(np.int64))], names)

    names, kind = ["id", "node", "n", "token", "times"], pa.int64()
    for rows, data, at in arrays.slices(batches, "body"):
        kind = rows.column("id").type
        sets = shingle_sets(data, at)
        held += sets
        size += sum(map(len, sets))
        none = pa.nulls(len(sets), pa.int64())
        yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), none, none], names)
        if size > _TASK_TOKENS:
            yield repeated()
            held, size = [], 0
    if held:
        yield repeated()


def _prefixes(frequent: np.ndarray):
    """Per set that the task has not seen: node, n, prefix (as signed numbers), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        late = frequent.value
        for _, data, at in arrays.slices(batches, "body"):
            nodes, sizes, prefixes, bitmaps = [], [], [], []
            for members in shingle_sets(data, at):
                if not len(members) or (node := node_of(members)) in seen:
                    continue
                if len(seen) < 1 << 16:
                    seen.add(node)
                n = len(members)
                length = n - -(-4 * n // 5) + 1
                place = np.minimum(np.searchsorted(late, members), len(late) - 1) if len(late) else None
                is_late = late[place] == members if len(late) else np.zeros(n, bool)
                ordered = np.concatenate([members[~is_late], members[is_late]]) if is_late.any() else members
                nodes.append(node)
                sizes.append(n)
                prefixes.append(ordered[:length].view(np.int64))
                bitmaps.append(signature(members).tobytes())
            offsets = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(bitmaps, pa.binary())], ["node", "n", "prefix", "bits"])

    return run


def folded(bits: bytes, width: int) -> np.ndarray:
    """The bitmap at a smaller width (in bytes): its parts are ORed."""
    held = np.frombuffer(bits, np.uint8)
    return held if len(held) == width else np.bitwise_or.reduce(held.reshape(-1, width), axis=0)


class Tree:
    """Levels of tree nodes over sets in order of size: OR of bitmaps, least and most members, most hidden members, group."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray, groups: np.ndarray):
        hidden = sizes - np.bitwise_count(bitmaps).sum(axis=1)
        self.levels = [(bitmaps, sizes, sizes, hidden, groups, groups)]
        step = _LEAF
        while len(self.levels[-1][1]) > 1:
            bits, least, most, behind, low, high = self.levels[-1]
            cuts = np.arange(0, len(least), step)
            self.levels.append((np.bitwise_or.reduceat(bits, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts),
                                np.maximum.reduceat(behind, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))
            step = _FAN


def possible(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray) -> np.ndarray:
    """Whether any set below x[i] can reach the threshold with one of another group below y[j]."""
    least = x[1][i] + y[1][j]
    keep = enough(np.minimum(x[2][i], y[2][j]), x[1][i], y[1][j])
    keep &= ~((x[4][i] == x[5][i]) & (y[4][j] == y[5][j]) & (x[4][i] == y[4][j]))
    at = np.flatnonzero(keep)
    common = np.bitwise_count(x[0][i[at]] & y[0][j[at]]).sum(axis=1).astype(np.int64) + np.minimum(x[3][i[at]], y[3][j[at]])
    keep[at] = 9 * common >= 4 * least[at]
    return keep


def walk(x: Tree, y: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves (places in x and y) that survive the walk over both trees, a level at a time."""
    deep = max(len(x.levels), len(y.levels))
    level = lambda t, k: min(k, len(t.levels) - 1)
    i = np.zeros(1, np.int64)
    j = np.zeros(1, np.int64)
    for k in range(deep - 1, -1, -1):
        a, b = x.levels[level(x, k)], y.levels[level(y, k)]
        found_i, found_j = [], []
        for part in range(0, len(i), 4096):  # so many pairs at once
            pi, pj = i[part : part + 4096], j[part : part + 4096]
            keep = possible(a, pi, b, pj)
            found_i.append(pi[keep])
            found_j.append(pj[keep])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        if not len(i):
            break
        if k:
            i, j = _below(x, k, i, j)
            j, i = _below(y, k, j, i)
    return i, j


def _below(tree: Tree, k: int, own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair with the children of its own side; a tree without that level stays where it is."""
    if k >= len(tree.levels) or not len(own):
        return own, other
    fan, size = (_LEAF if k == 1 else _FAN), len(tree.levels[k - 1][1])
    children = (own[:, None] * fan + np.arange(fan)).ravel()
    inside = children < size
    return children[inside], np.repeat(other, fan)[inside]


def cell_pairs(sizes: np.ndarray, bits: list[bytes], groups: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places, one of ``left`` and one of ``right`` each, whose sets may reach the threshold."""
    width = np.array([len(b) for b in bits])

    def tree(places: np.ndarray, w: int) -> tuple[Tree, np.ndarray]:
        places = places[np.argsort(sizes[places], kind="stable")]
        return Tree(sizes[places], np.array([folded(bits[p], w) for p in places]), groups[places]), places

    # sets that reach the threshold have bitmaps of the same width, or of one twice as wide
    for w in np.unique(width).tolist():
        for a, b in ((w, w), (w, 2 * w), (2 * w, w)):
            mine, other = left[width[left] == a], right[width[right] == b]
            if len(mine) and len(other):
                (x, px), (y, py) = tree(mine, w), tree(other, w)
                i, j = walk(x, y)
                yield px[i], py[j]


def small_cell_pairs(cell: np.ndarray, sizes: np.ndarray, bits: list[bytes], groups: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for many cells of a few nodes each, whose rows stand together: every tree is a single level."""
    width = np.array([len(b) for b in bits])
    for w in np.unique(width).tolist():
        places = np.flatnonzero((width == w) | (width == 2 * w))
        held = np.array([folded(bits[p], w) for p in places])
        hidden = sizes[places] - np.bitwise_count(held).sum(axis=1)
        lag = 1
        while len(near := np.flatnonzero(cell[places[lag:]] == cell[places[:-lag]])):
            a, b = near, near + lag
            x, y = places[a], places[b]
            keep = (left[x] != left[y]) & (groups[x] != groups[y]) & ((width[x] == w) | (width[y] == w)) & enough(np.minimum(sizes[x], sizes[y]), sizes[x], sizes[y])
            a, b, x, y = a[keep], b[keep], x[keep], y[keep]
            common = np.bitwise_count(held[a] & held[b]).sum(axis=1).astype(np.int64) + np.minimum(hidden[a], hidden[b])
            keep = enough(common, sizes[x], sizes[y])
            yield x[keep], y[keep]
            lag += 1


def _pairs_of_cells(table: pa.Table, sizes: np.ndarray, bits: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in whole cells, whose rows stand together."""
    begins = _starts(table, CELL_KEY)
    cell = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, table.num_rows)))
    groups, left = table.column("component").to_numpy(), table.column("left").to_numpy()
    rows = np.bincount(cell)
    small = np.flatnonzero(rows[cell] <= SMALL)
    for x, y in small_cell_pairs(cell[small], sizes[small], [bits[k] for k in small], groups[small], left[small]):
        yield small[x], small[y]
    starts = np.append(begins, table.num_rows)
    for c in np.flatnonzero(rows > SMALL).tolist():
        own = np.arange(starts[c], starts[c + 1])
        for x, y in cell_pairs(sizes, bits, groups, own[left[own]], own[~left[own]]):
            yield x, y


def _with_partners(table: pa.Table) -> list[pa.RecordBatch]:
    """The rows of cells that may link to another one, never more than there are, each with its cell's ``deal``: the smallest node of
    those rows. Cells of the same neighbourhood, one for each shingle that its nodes share, mostly have the same deal."""
    some = np.zeros(table.num_rows, bool)
    for x, y in _pairs_of_cells(table, table.column("n").to_numpy(), table.column("bits").to_pylist()):
        some[x] = some[y] = True
    rows = table.filter(pa.array(some)).select([*CELL_KEY, "node", "component", "left"]).combine_chunks()
    if not rows.num_rows:
        return []
    nodes = rows.column("node").to_numpy()
    new = _starts(rows, CELL_KEY)
    deal = np.repeat(np.minimum.reduceat(nodes, new), np.diff(np.append(new, len(nodes))))
    return rows.append_column("deal", pa.array(deal, pa.int64())).combine_chunks().to_batches(max_chunksize=1 << 30)


def _starts(table: pa.Table, key: tuple[str, ...]) -> np.ndarray:
    """Where a row has another key than the one before."""
    columns = [table.column(c).to_numpy() for c in key]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def common_members(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (x, y) of places."""
    if len(x) < 256:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x.tolist(), y.tolist(), strict=True)], np.int64)
    # many pairs of few sets: products of the incidence matrix, a block of members at a time
    px, own_x = np.unique(x, return_inverse=True)
    py, own_y = np.unique(y, return_inverse=True)
    member = np.concatenate([sets[p] for p in (*px, *py)])
    row = np.repeat(np.arange(len(px) + len(py)), [len(sets[p]) for p in (*px, *py)])
    names, column, times = np.unique(member, return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(px), len(py)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        own = slice(*np.searchsorted(column, (first, first + 4096)))
        has = np.zeros((len(px) + len(py), 4096), np.float32)
        has[row[own], column[own] - first] = 1
        common += has[: len(px)] @ has[len(px) :].T
    return common[own_x, own_y].astype(np.int64)


def _links_of_deal(table: pa.Table) -> list[pa.RecordBatch]:
    """Links inside the cells of a deal that join different groups: as many as join them, not all. The rows without a cell, first, bring
    the texts, one of each node; a pair that several cells hold is compared once."""
    with_text = int(pc.sum(table.column("text").is_valid()).as_py() or 0)
    texts, rows = table.slice(0, with_text), table.slice(with_text).combine_chunks()
    held = []
    for row in range(0, texts.num_rows, 256):
        held += shingle_sets(*arrays.texts(texts.column("text").slice(row, 256).combine_chunks()))
    known = texts.column("node").to_numpy()
    order = np.argsort(known)
    nodes, groups = rows.column("node").to_numpy(), rows.column("component").to_numpy()
    at = order[np.searchsorted(known[order], nodes)]
    group_of = np.zeros(len(held), np.int64)
    group_of[at] = groups
    lengths = np.array([len(s) for s in held], np.int64)
    bitmaps = [signature(s).tobytes() for s in held]
    parent: dict[int, int] = {}

    def root(g: int) -> int:
        while (up := parent.get(g, g)) != g:
            g = up
        return g

    links, done = [], np.zeros(0, np.int64)
    for x, y in _pairs_of_cells(rows, lengths[at], [bitmaps[k] for k in at.tolist()]):
        for part in range(0, len(x), 1 << 16):
            i, j = at[x[part : part + (1 << 16)]], at[y[part : part + (1 << 16)]]
            pairs = np.unique(np.minimum(i, j) * len(held) + np.maximum(i, j))
            pairs = pairs[~np.isin(pairs, done)] if len(done) else pairs
            if len(done) < _PAIRS_KEPT:
                done = np.concatenate([done, pairs])
            i, j = pairs // len(held), pairs % len(held)
            true = enough(common_members(held, i, j), lengths[i], lengths[j])
            for a, b in zip(i[true].tolist(), j[true].tolist(), strict=True):
                ga, gb = root(int(group_of[a])), root(int(group_of[b]))
                if ga != gb:
                    parent[max(ga, gb)] = min(ga, gb)
                    links.append((int(known[a]), int(known[b])))
    return [pa.RecordBatch.from_arrays([pa.array([k[0] for k in links], pa.int64()), pa.array([k[1] for k in links], pa.int64())], ["a", "b"])]


def _by_key(handle, key: tuple[str, ...]):
    """``handle`` over the groups of a partition sorted by ``key``; one that a batch ends in waits for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            last = np.ones(table.num_rows, bool)
            for c in key:
                k = table.column(c).to_numpy()
                last &= k == k[-1:]
            cut = table.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
            held = table.slice(cut)
            if cut:
                yield from handle(table.slice(0, cut))
        if held is not None and held.num_rows:
            yield from handle(held)

    return run


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with sizes and bitmaps, those that the bitmaps allow."""
    for batch in batches:
        a, b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        keep = enough(np.minimum(a, b), a, b)
        for k in np.flatnonzero(keep).tolist():
            x, y = batch.column("bits_a")[k].as_py(), batch.column("bits_b")[k].as_py()
            w = min(len(x), len(y))
            x, y = folded(x, w), folded(y, w)
            hidden = min(a[k] - np.bitwise_count(x).sum(dtype=np.int64), b[k] - np.bitwise_count(y).sum(dtype=np.int64))
            keep[k] = 9 * (np.bitwise_count(x & y).sum(dtype=np.int64) + hidden) >= 4 * (a[k] + b[k])
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those that reach the threshold."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for row in range(0, batch.num_rows, 128):
            part = batch.slice(row, 128)
            sets = [shingle_sets(*arrays.texts(part.column(c))) for c in ("text_a", "text_b")]
            for k, (x, y) in enumerate(zip(*sets, strict=True)):
                keep[row + k] = enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def _with_ends(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with the columns of both ends."""
    for end in ("a", "b"):
        renamed = nodes.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = pairs.join(renamed, end)
    return pairs


def _sizes(a, b):
    """Whether sets of these sizes can reach the threshold at all."""
    return 9 * F.least(a, b) >= 4 * (a + b)


def _texts_of(wanted: DataFrame, base: DataFrame, sets: DataFrame) -> DataFrame:
    """(``node``, ``text``): one text of each wanted node."""
    ids = written(sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")), "wanted")
    held = base.where(F.col("id").isNotNull()).join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id").select("node", "body")
    unnamed = base.where(F.col("id").isNull()).mapInArrow(_with_node, "node long, text string").join(ids.select("node"), "node", "left_semi")
    return written(held.mapInArrow(_of_node, "node long, text string").unionByName(unnamed).dropDuplicates(["node"]), "texts")


def _linked_pairs(pairs: DataFrame, base: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of nodes that reach the threshold; texts are fetched for the nodes of pairs only."""
    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), base, sets)
    return _with_ends(pairs, texts, ["text"]).mapInArrow(_linked, "a long, b long")


def jaccard_groups(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", frequent: int = FREQUENT, cell: int = CELL) -> DataFrame:
    """One row per document: its id, ``n_shingles``, and ``component_id``, the smallest id that links lead to.

    Two documents are linked when their shingle sets' intersection is at least 0.8 of their union. A NULL text or one without words
    has no shingles and no links; one with fewer than five words has one shingle. Rows with equal sets are linked, also
    if they repeat an id. NULL ids come back as they are; a group of NULL ids alone has a NULL ``component_id``. Other
    columns are not read.
    """
    named = _named_groups(docs, id_column, text_column, frequent, cell)
    return named.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("id")).alias("component_id"))


def _named_groups(docs: DataFrame, id_column: str, text_column: str, frequent: int, cell: int) -> DataFrame:
    """Per row of ``docs``: ``id``, ``node`` of its set, ``n`` shingles, the node that names its ``component`` and the ``smallest`` id of that."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    kind = dict(base.dtypes)["id"]
    found = written(base.mapInArrow(_sets_and_frequent, f"id {kind}, node long, n long, token long, times long"), "sets")
    sets = found.where(F.col("node").isNotNull()).select("id", "node", "n")

    limit = max(frequent, int(FREQUENT_SHARE * sets.count()))
    late = found.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") > limit).select("token").toArrow()
    late = spark.sparkContext.broadcast(np.sort(late["token"].to_numpy().astype(np.int64).view(np.uint64)))
    nodes = written(base.select("body").mapInArrow(_prefixes(late), "node long, n long, prefix array<long>, bits binary"), "prefixes")

    # rows of shingles that several nodes have in their prefixes
    tokens = nodes.select("node", "n", F.explode("prefix").alias("token")).repartition("token")
    shared = tokens.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("token")
    rows = tokens.join(shared, "token").distinct().withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(1.25))).cast("int"))
    rows = written(rows, "shared")
    active = rows.select("node").distinct()
    bitmaps = written(nodes.select("node", "n", "bits").join(active, "node", "left_semi").dropDuplicates(["node"]), "bitmaps")

    # each node and the smallest one of its block; in blocks of two that is all
    placed = _in_blocks(rows)
    low = placed.groupBy("token", "band").agg(
        F.min(F.struct("node", "n", "visits")).alias("low"), F.count("*").alias("m"), F.count_if(~F.col("visits")).alias("own")).where("m > 1 and own > 0").drop("m", "own")
    stars = placed.join(low, ["token", "band"]).where((F.col("node") != F.col("low.node")) & ~(F.col("visits") & F.col("low.visits")) & _sizes(F.col("n"), F.col("low.n")))
    stars = stars.select(F.col("low.node").alias("a"), F.col("node").alias("b")).distinct()
    pairs = written(_with_ends(stars, bitmaps, ["n", "bits"]).mapInArrow(_may_link, "a long, b long"), "possible")
    links = written(_linked_pairs(pairs, base, sets), "links")
    groups = components(links)
    partners = _between_groups(rows, groups, bitmaps, cell)
    more = _links_between(partners, _texts_of(partners.select("node").distinct(), base, sets))
    groups = components(links.unionByName(more))

    named = splittable_join(sets, groups, ["node"], "left").select("id", "node", "n", F.coalesce("component", "node").alias("component"))
    named = written(named, "named")
    smallest = named.where("n > 0").groupBy("component").agg(F.min("id").alias("smallest"))
    return splittable_join(named, smallest, ["component"], "left")


def _of_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the node's set: an id may come with several texts."""
    for rows, data, at in arrays.slices(batches, "body"):
        same = [node_of(s) == node for s, node in zip(shingle_sets(data, at), rows.column("node").to_pylist(), strict=True)]
        yield rows.filter(pa.array(same, pa.bool_())).rename_columns(["node", "text"])


def _with_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in arrays.slices(batches, "body"):
        nodes = [node_of(s) for s in shingle_sets(data, at)]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), rows.column("body")], ["node", "text"])


def _in_blocks(rows: DataFrame) -> DataFrame:
    """A block is a shingle and a band of sizes; the nodes of the band below visit it."""
    at = F.explode(F.array(F.struct("band", F.lit(False).alias("visits")), F.struct((F.col("band") + 1).alias("band"), F.lit(True).alias("visits")))).alias("at")
    rest = [c for c in rows.columns if c != "band"]
    return rows.select(*rest, at).select(*rest, "at.band", "at.visits")


def _between_groups(rows: DataFrame, groups: DataFrame, bitmaps: DataFrame, cell: int) -> DataFrame:
    """The rows of cells, nodes by block, that may reach the threshold with another one of the cell and of another group."""
    named = rows.join(groups, "node", "left").select("token", "band", "node", F.coalesce("component", "node").alias("component"))
    placed = _in_blocks(named)
    block, hashed = ["token", "band"], lambda salt: F.bit_xor(F.xxhash64("node", "visits", F.lit(salt)))
    counted = placed.groupBy(*block, "component").agg(F.count("*").alias("m"), F.count_if(~F.col("visits")).alias("own"), hashed(0).alias("x"), hashed(1).alias("y"))
    blocks = counted.groupBy(*block).agg(
        F.count("*").alias("parts"), F.sum("m").alias("m"), F.sum("own").alias("own"), F.max(F.struct("m", "component")).alias("main"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    blocks = blocks.where("parts > 1 and own > 0 and m > 2")
    # shingles with the same nodes are one block
    blocks = blocks.groupBy("band", "m", "x", "y").agg(F.min(F.struct("token", "main")).alias("b")).select(
        F.col("b.token").alias("token"), "band", F.col("b.main.component").alias("main"), "m", (F.col("m") - F.col("b.main.m")).alias("others"))
    cells = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(cell))).cast("int")
    member = placed.join(blocks, block).select(
        *block, "node", "component", (F.col("component") != F.col("main")).alias("other"), cells(F.col("others")).alias("l"), cells(F.col("m")).alias("r"))
    # nodes outside the block's largest group, on the left, meet all nodes, on the right
    spread = lambda n: F.sequence(F.lit(0), n - 1)
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    right = member.select(*block, "node", "component", F.lit(False).alias("left"), F.explode(spread(F.col("l"))).alias("i"), own(F.col("r")).alias("j"))
    left = member.where("other").select(*block, "node", "component", F.lit(True).alias("left"), own(F.col("l")).alias("i"), F.explode(spread(F.col("r"))).alias("j"))
    cell_rows = left.unionByName(right).join(bitmaps, "node")
    cell_rows = cell_rows.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY)
    kinds = dict(cell_rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*CELL_KEY, "node", "component", "left")) + ", deal long"
    return written(cell_rows.mapInArrow(_by_key(_with_partners, CELL_KEY), schema), "partners")


def _links_between(partners: DataFrame, texts: DataFrame) -> DataFrame:
    """The links that join groups. The cells of a deal go to one task, and each text goes there once, not with every cell. A deal
    of more than ``DEAL_ROWS`` rows is cut into shares of whole cells."""
    shares = partners.groupBy("deal").agg(F.ceil(F.count("*") / F.lit(DEAL_ROWS)).alias("shares"))
    share = F.pmod(F.xxhash64(*CELL_KEY), F.col("shares")).cast("int").alias("share")
    rows = splittable_join(partners, shares, ["deal"], "inner").select("deal", share, *CELL_KEY, "node", "component", "left")
    needed = rows.select("deal", "share", "node").distinct().join(texts, "node")
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes if c not in ("deal", "share", "node")]
    both = needed.select("deal", "share", "node", "text", *nothing).unionByName(rows.withColumn("text", F.lit(None).cast("string")))
    dealt = both.repartition("deal", "share").sortWithinPartitions("deal", "share", F.col("text").isNull(), *CELL_KEY)
    return dealt.mapInArrow(_each(_links_of_deal, ("deal", "share")), "a long, b long")


def _each(handle, key: tuple[str, ...]):
    """``handle`` on one group after the other."""

    def groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cuts = np.append(_starts(table, key), table.num_rows)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield from handle(table.slice(a, b - a))

    return _by_key(groups, key)


def _add_node(frame: DataFrame, text_column: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in arrays.slices(batches, text_column):
            yield rows.append_column(name, pa.array([node_of(s) for s in shingle_sets(data, at)], pa.int64()))

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows whose id names their group: one document of each. Rows without shingles all stay.

    Each row is judged by its own text: an id may come with a near copy, which goes, and with another text, which stays.
    Of a group of NULL ids alone one row of its smallest node stays; NULL ids all stay in a group that an id names.
    """
    rows = written(_named_groups(docs, id_column, text_column, FREQUENT, CELL), "judged")
    goes = (F.col("n") > 0) & (F.col("id") != F.col("smallest"))
    ids = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(goes).alias("some"), F.min(goes).alias("all"))
    ids = written(ids.where("some").select(F.col("id").alias(id_column), "all"), "gone")
    kept = docs.join(ids.where("all").select(id_column), id_column, "left_anti").select(docs.columns)
    node = unused(docs, "node")

    mixed = ids.where("not all").select(id_column)
    if not mixed.isEmpty():
        gone = rows.where(goes).select(F.col("id").alias(id_column), F.col("node").alias(node)).distinct()
        own = _add_node(docs.join(mixed, id_column, "left_semi").select(docs.columns), text_column, node)
        own = own.join(gone, [id_column, node], "left_anti").select(docs.columns)
        kept = kept.join(mixed, id_column, "left_anti").select(docs.columns).unionByName(own)

    unnamed = rows.where(F.col("id").isNull() & F.col("smallest").isNull() & (F.col("n") > 0)).groupBy("component").agg(F.min("node").alias("least"), F.count("*").alias("m")).where("m > 1")
    if not unnamed.isEmpty():
        members = rows.where(F.col("id").isNull()).select("node", "component").distinct().join(unnamed, "component")
        members = members.select(F.col("node").alias(node), (F.col("node") == F.col("least")).alias(first := unused(docs, "first")))
        own = splittable_join(_add_node(docs.where(F.col(id_column).isNull()), text_column, node), members, [node], "left")
        one = own.where(F.col(first)).dropDuplicates([node])
        kept = kept.where(F.col(id_column).isNotNull()).unionByName(own.where(F.col(first).isNull()).unionByName(one).select(docs.columns))
    return kept
