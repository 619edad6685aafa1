"""Regression trees on sparse rows whose values are sorted into few levels.

A split asks whether a term stands in a row at a certain level or above; a term that is absent has level 0.
Levels are few, so what a node needs to know is bounded by its distinct terms and levels. Large nodes are split
level by level from sums over all tasks. A node of at most ``local_rows`` rows is sent whole to one task and
finished there, however deep it gets, so depth costs no passes over the data.

Targets are rounded to steps of 2^-20. Sums of them are whole numbers and come out the same in any order:
trees do not depend on how the rows are dealt over tasks.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

from pricebench.models.sparse import Rows, SparseTable, blocks_of

STEP = 2.0**-20
MAX_LEVELS = 16
LOCAL_ROWS = 1 << 16
LEVEL_ENTRIES = 1 << 16  # nodes of at most so many entries are grown level by level, larger ones one at a time
HISTOGRAM = 1 << 22  # numbers of the sums that a pass over large nodes may ask for
ROWS_AT_ONCE, MOST_ROWS_AT_ONCE = 256, 1 << 13
LEAF = -1


@dataclass
class Tree:
    """Nodes by number: the term asked for (or LEAF), the least level that goes right, the children, the value."""

    term: np.ndarray
    level: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.term)

    def packed(self) -> bytes:
        whole = np.stack([self.term, self.level, self.left, self.right]).astype("<i4")
        return whole.tobytes() + self.value.astype("<f8").tobytes()

    @staticmethod
    def unpacked(packed: bytes) -> "Tree":
        size = len(packed) // 24
        whole = np.frombuffer(packed, "<i4", 4 * size).reshape(4, size)
        return Tree(*whole, np.frombuffer(packed, "<f8", size, 16 * size))

    def grafted(self, place: int, branch: "Tree") -> "Tree":
        """This tree with a leaf replaced by another tree, whose root takes its number."""
        numbers = np.concatenate([[place], len(self) + np.arange(len(branch) - 1)])
        out = Tree(*(np.concatenate([a, b[1:]]) for a, b in zip(self._fields(), branch._fields())))
        inner = branch.term != LEAF
        for name in ("term", "level", "value"):
            getattr(out, name)[numbers] = getattr(branch, name)
        for name in ("left", "right"):
            getattr(out, name)[numbers[inner]] = numbers[getattr(branch, name)[inner]]
        return out

    def _fields(self) -> tuple[np.ndarray, ...]:
        return self.term, self.level, self.left, self.right, self.value


def single_leaf() -> Tree:
    return Tree(*(np.array([n]) for n in (LEAF, 0, 0, 0)), np.zeros(1))


class Ensemble:
    """Trees as one table of nodes, and the walk of many rows through all of them at once."""

    def __init__(self, trees: list[Tree]):
        self.roots = np.cumsum([0, *map(len, trees)])[:-1]
        fields = zip(*(tree._fields() for tree in trees)) if trees else [[]] * 5
        self.term, self.level, left, right, self.value = (np.concatenate(f) if f else np.zeros(0, int) for f in map(list, fields))
        shift = np.repeat(self.roots, [len(tree) for tree in trees])
        self.left, self.right = (left + shift).astype(np.int64), (right + shift).astype(np.int64)
        self.asked = np.unique(self.term[self.term != LEAF])  # the terms that any node asks for
        self.place = np.searchsorted(self.asked, self.term)

    def leaves(self, rows: Rows, levels: np.ndarray) -> np.ndarray:
        """The node where each row ends in each tree: (rows, trees)."""
        out = np.tile(self.roots.astype(np.int64), (rows.number, 1))
        if not len(self.asked):
            return out
        places = np.full(rows.size, LEAF)
        places[self.asked] = np.arange(len(self.asked))
        place = places[rows.terms]
        kept = np.flatnonzero(place != LEAF)
        row, place, levels = rows.row[kept], place[kept], levels[kept]
        at_once = max(ROWS_AT_ONCE, min(MOST_ROWS_AT_ONCE, ROWS_AT_ONCE * rows.size // len(self.asked)))
        for first in range(0, rows.number, at_once):
            last = min(first + at_once, rows.number)
            here = slice(*np.searchsorted(row, [first, last]))
            table = np.zeros((last - first, len(self.asked)), np.uint8)
            table[row[here] - first, place[here]] = levels[here]
            node = out[first:last]
            moving, tree = np.nonzero(self.term[node] != LEAF)
            while len(moving):
                at = node[moving, tree]
                above = table[moving, self.place[at]] >= self.level[at]
                at = np.where(above, self.right[at], self.left[at])
                node[moving, tree] = at
                going = self.term[at] != LEAF
                moving, tree = moving[going], tree[going]
        return out


@dataclass
class Growth:
    """What a split must keep, how deep trees may get, and which terms a tree may ask for."""

    least_rows: int = 2
    depth: int | None = None
    term_share: float = 1.0
    shrink: float = 0.0  # added to the rows of a node when its value and gains are worked out

    def allowed(self, tree: int, terms: np.ndarray) -> np.ndarray:
        """Of each tree its own share of the terms, by a hash of both."""
        if self.term_share >= 1:
            return np.ones(len(terms), bool)
        return uniform(terms.astype(np.uint64), tree) < self.term_share


def uniform(keys: np.ndarray, seed: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on key and seed alone."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53


def poisson(keys: np.ndarray, seed: int) -> np.ndarray:
    """How often a row is drawn when as many rows are drawn with replacement from very many."""
    steps = np.cumsum(np.exp(-1) / np.cumprod([1, 1, 2, 3, 4, 5, 6, 7, 8, 9]))
    return np.searchsorted(steps, uniform(keys, seed), side="right")


@dataclass
class Nodes:
    """What is known of some nodes: their rows, the weight of these, and the sum of weight times target."""

    rows: np.ndarray
    weight: np.ndarray
    total: np.ndarray


def falling(terms: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A number per term and level that sorts by term, then by falling level."""
    return terms.astype(np.int64) * MAX_LEVELS + (MAX_LEVELS - 1 - levels)


def best_splits(of, code, sums: Nodes, nodes: Nodes, growth: Growth) -> tuple[np.ndarray, np.ndarray]:
    """Term (or LEAF) and level of the best split of each node.

    ``sums`` are those of rows with exactly one term and level of one node; they come in the order of the
    node's number ``of``, then of ``code`` as ``falling`` makes it. Of equal splits the first one counts.
    """
    term = code // MAX_LEVELS
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1

    def at_or_above(values: np.ndarray) -> np.ndarray:
        running = np.cumsum(values)
        return running - (running[first] - values[first])[group]

    rows = at_or_above(sums.rows)
    fits = np.flatnonzero((rows >= growth.least_rows) & (nodes.rows[of] - rows >= growth.least_rows))
    weight, total, of, term, code = at_or_above(sums.weight)[fits], at_or_above(sums.total)[fits], of[fits], term[fits], code[fits]
    left_weight, left_total = nodes.weight[of] - weight, nodes.total[of] - total
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = total**2 / (weight + growth.shrink) + left_total**2 / (left_weight + growth.shrink)
        gain = parts - (nodes.total**2 / (nodes.weight + growth.shrink))[of]
    gain = np.where(gain > 1e-10 * parts + 0.5, gain, 0.0)
    best = np.zeros(len(nodes.rows))
    np.maximum.at(best, of, gain)
    hits = np.flatnonzero((gain > 0) & (gain == best[of]))
    split, at = np.unique(of[hits], return_index=True)
    terms, levels = np.full(len(best), LEAF), np.zeros(len(best), np.int64)
    terms[split], levels[split] = term[hits[at]], MAX_LEVELS - 1 - code[hits[at]] % MAX_LEVELS
    return terms, levels


def grow_here(row, code, weight, target, tree: int, growth: Growth, depth: int = 0) -> Tree:
    """A whole tree over rows that fit into memory; weights and targets are whole numbers.

    ``row`` and ``code`` are the entries, those of a row together. Of the two parts of a large node only the one with
    fewer entries is summed up; the sums of the other are what is left of the node's own, which is exact with whole
    numbers. So a row is read again only when it falls into the smaller part, however lopsided the splits are.
    """
    kept = growth.allowed(tree, code // MAX_LEVELS)
    row, code = row[kept], code[kept]
    codes = np.flatnonzero(np.bincount(code)) if len(code) else np.zeros(0, np.int64)
    places = np.zeros(int(codes[-1]) + 1 if len(codes) else 0, np.int32)
    places[codes] = np.arange(len(codes))
    place, weighted = places[code], weight * target
    lengths = np.bincount(row, minlength=len(weight))
    starts = np.cumsum(lengths) - lengths
    row_of = row[np.argsort(place, kind="stable")]  # the rows that have each code, one code after the other
    begins = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(codes)))])

    def entries(members: np.ndarray) -> np.ndarray:
        sizes = lengths[members]
        return np.repeat(starts[members] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())

    def summed(members: np.ndarray) -> np.ndarray:
        at = entries(members)
        where, of = place[at], row[at]
        values = (None, weight[of], weighted[of])
        return np.stack([np.bincount(where, v, len(codes)).astype(float) for v in values])

    fields: list[list] = [[LEAF, 0, 0, 0, 0.0]]
    branches: list[tuple[int, Tree]] = []
    everything = np.arange(len(weight))
    stack = [(0, everything, depth, None)]
    while stack:
        number, members, level_of, sums = stack.pop()
        deepest = growth.depth is not None and level_of >= growth.depth
        if deepest or lengths[members].sum() <= LEVEL_ENTRIES:
            at = entries(members) if not deepest else np.zeros(0, np.int64)
            numbers = np.zeros(len(weight), np.int64)
            numbers[members] = np.arange(len(members))
            parts = numbers[row[at]], codes[place[at]], weight[members], target[members]
            branches.append((number, grow_levels(*parts, growth, level_of)))
            continue
        sums = summed(members) if sums is None else sums
        whole = Nodes(*(np.array([float(v)]) for v in (len(members), weight[members].sum(), weighted[members].sum())))
        at = np.flatnonzero(sums[0])
        term, least = best_splits(np.zeros(len(at), np.int64), codes[at], Nodes(*sums[:, at]), whole, growth)
        fields[number][4] = whole.total[0] / max(whole.weight[0] + growth.shrink, 1e-300) * STEP
        if term[0] == LEAF:
            continue
        first, last = np.searchsorted(codes, [term[0] * MAX_LEVELS, falling(term, least)[0] + 1])
        goes = np.zeros(len(weight), bool)
        goes[row_of[begins[first] : begins[last]]] = True
        sides = [members[~goes[members]], members[goes[members]]]
        sizes = [int(lengths[side].sum()) for side in sides]
        fewer, more = (0, 1) if sizes[0] <= sizes[1] else (1, 0)
        found: list = [None, None]
        if sizes[more] > LEVEL_ENTRIES:
            found[fewer] = summed(sides[fewer])
            found[more] = np.subtract(sums, found[fewer], out=sums)
        children = [len(fields), len(fields) + 1]
        fields[number][:4] = int(term[0]), int(least[0]), *children
        fields += [[LEAF, 0, 0, 0, 0.0], [LEAF, 0, 0, 0, 0.0]]
        for side in (more, fewer):  # the one with fewer entries comes first: few sums are held at a time
            stack.append((children[side], sides[side], level_of + 1, found[side]))
    out = Tree(*(np.array(field) for field in zip(*fields)))
    for number, branch in branches:
        out = out.grafted(number, branch)
    return out


def grow_levels(row, code, weight, target, growth: Growth, depth: int = 0) -> Tree:
    """A whole tree, all nodes of a level at once.

    ``row`` and ``code`` are the entries; weights and targets are whole numbers. Entries stay in the order
    of node, term and falling level: children take them over in that order. A term that stands in fewer rows of a
    node than a split must keep is let go there: nothing below the node can ask for it.
    """
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    weighted = weight * target
    node = np.zeros(len(weight), np.int64)  # of each row, among the nodes of the level; -1 once it is in a leaf
    levels: list[tuple[np.ndarray, ...]] = []
    number, below = 1, 1
    while number:
        alive = node >= 0
        nodes = Nodes(*(np.bincount(node[alive], v[alive], number) for v in (np.ones(len(node)), weight, weighted)))
        terms, least = np.full(number, LEAF), np.zeros(number, np.int64)
        if len(row) and (growth.depth is None or depth < growth.depth):
            of = node[row]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (code[1:] != code[:-1])
            first = np.flatnonzero(new)
            counts, of, codes = np.diff(np.append(first, len(of))), of[first], code[first]
            enough = _in_enough_rows(of, codes, counts, growth.least_rows)
            stays = np.repeat(enough, counts)
            row, code, counts, of, codes = row[stays], code[stays], counts[enough], of[enough], codes[enough]
            if len(row):
                first = np.cumsum(counts) - counts
                sums = Nodes(counts.astype(float), *(np.add.reduceat(v[row].astype(float), first) for v in (weight, weighted)))
                terms, least = best_splits(of, codes, sums, nodes, growth)
        split = terms != LEAF
        child = np.where(split, 2 * np.cumsum(split) - 2, LEAF)
        value = nodes.total / np.maximum(nodes.weight + growth.shrink, 1e-300) * STEP
        levels.append((terms, least, np.where(split, below + child, 0), np.where(split, below + child + 1, 0), value))
        if len(row):
            of = node[row]
            right = np.zeros(len(node), bool)
            right[row[(code // MAX_LEVELS == terms[of]) & (MAX_LEVELS - 1 - code % MAX_LEVELS >= least[of])]] = True
        else:
            right = np.zeros(len(node), bool)
        node = np.where(alive & (child[node] >= 0), child[node] + right, LEAF)
        stays = node[row] >= 0
        row, code = row[stays], code[stays]
        number, depth = int(2 * split.sum()), depth + 1
        below += number
        to = node[row].astype(np.int16 if number < 1 << 15 else np.int64)  # short numbers are sorted by radix
        order = np.argsort(to, kind="stable")
        row, code = row[order], code[order]
    return Tree(*(np.concatenate(field) for field in zip(*levels)))


def _in_enough_rows(of: np.ndarray, code: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """Of each node and code, whether its term stands in so many rows of the node."""
    if not len(of):
        return np.zeros(0, bool)
    term = code // MAX_LEVELS
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    return np.repeat(np.add.reduceat(counts, first) >= least, np.diff(np.append(first, len(of))))


def whole_steps(target: np.ndarray) -> np.ndarray:
    return np.round(target / STEP)


@dataclass
class Task:
    """What trees are grown on: levels of values, how often a row counts in a tree, and its target."""

    levels: Callable[[np.ndarray], np.ndarray]
    draw: Callable[[np.ndarray, int], np.ndarray]
    target: Callable[[Rows, np.ndarray], np.ndarray]
    growth: Growth


OPEN = "tree int, leaf int, ends binary, codes binary, weights binary, targets binary"


def grow(table: SparseTable, task: Task, numbers: list[int], local_rows: int = LOCAL_ROWS) -> list[Tree]:
    """One tree per number. Large nodes are split by sums over all tasks, the others in one task each."""
    trees = {t: single_leaf() for t in numbers}
    depths = {(t, 0): 0 for t in numbers}
    sizes = {at: table.number for at in depths}  # rows of a node; those of a root are not drawn yet
    growing = list(depths)
    while growing := [at for at in growing if sizes[at] > local_rows and depths[at] != task.growth.depth]:
        found = _split_large(table, task, trees, growing)
        growing = []
        for (t, leaf), (term, level, value, rows, right) in found:
            if rows <= local_rows:
                continue
            depth = depths.pop((t, leaf))
            trees[t].value[leaf] = value
            if term == LEAF:
                continue
            branch = Tree(*(np.array(f) for f in ([term, LEAF, LEAF], [level, 0, 0], [1, 0, 0], [2, 0, 0], [value, 0.0, 0.0])))
            low = len(trees[t])
            trees[t] = trees[t].grafted(leaf, branch)
            for child, size in ((low, rows - right), (low + 1, right)):
                depths[t, child], sizes[t, child] = depth + 1, size
                growing.append((t, child))
    for t, leaf, branch in _finished(table, task, trees, depths):
        trees[t] = trees[t].grafted(leaf, branch)
    return [trees[t] for t in numbers]


def _codes(table: SparseTable, task: Task) -> np.ndarray:
    """The codes that any row has, found once for a table."""
    if task.levels not in table.facts:
        width = table.size * MAX_LEVELS

        def part(rows: Rows, _) -> np.ndarray:
            return np.bincount(falling(rows.terms, task.levels(rows.values)), minlength=width).astype(float)

        table.facts[task.levels] = np.flatnonzero(table.sum_over(part, np.zeros(0), (width,)))
    return table.facts[task.levels]


def _split_large(table: SparseTable, task: Task, trees: dict[int, Tree], nodes: list[tuple[int, int]]) -> Iterator[tuple]:
    """Each node with its term, level, value, rows and those of them that go right.

    One pass gives sums per node, term and level, and the node's own behind them, for as many nodes as there is room for.
    """
    every = _codes(table, task)
    start = 0
    while start < len(nodes):
        allowed = np.zeros(len(every), bool)
        for stop in range(start, len(nodes)):
            if stop == start or nodes[stop][0] != nodes[stop - 1][0]:
                more = allowed | task.growth.allowed(nodes[stop][0], every // MAX_LEVELS)
                if stop > start and 3 * (stop + 1 - start) * (more.sum() + 1) > HISTOGRAM:
                    break
                allowed = more
            elif 3 * (stop + 1 - start) * (allowed.sum() + 1) > HISTOGRAM:
                break
        else:
            stop = len(nodes)
        yield from zip(nodes[start:stop], _split(table, task, trees, nodes[start:stop], every[allowed]))
        start = stop


def _split(table: SparseTable, task: Task, trees: dict[int, Tree], nodes: list[tuple[int, int]], codes: np.ndarray) -> list[tuple]:
    wanted = sorted({t for t, _ in nodes})
    walk = Ensemble([trees[t] for t in wanted])
    width = len(codes)
    rank = np.full(table.size * MAX_LEVELS, -1, np.int32)
    rank[codes] = np.arange(width)

    def part(rows: Rows, _) -> np.ndarray:
        levels = task.levels(rows.values)
        ends = walk.leaves(rows, levels)
        target = whole_steps(task.target(rows, levels))
        place = rank[falling(rows.terms, levels)]
        draws = {t: task.draw(rows.keys, t) for t in wanted}
        out = np.zeros((len(nodes), 3, width + 1))
        for i, (t, leaf) in enumerate(nodes):
            weight = draws[t] * (ends[:, wanted.index(t)] == walk.roots[wanted.index(t)] + leaf)
            at = np.flatnonzero((weight > 0)[rows.row] & (place >= 0))
            of, at = rows.row[at], place[at]
            out[i, 0, :width] = np.bincount(at, minlength=width)
            out[i, 1, :width] = np.bincount(at, weight[of], width) if weight.max(initial=0) > 1 else out[i, 0, :width]
            out[i, 2, :width] = np.bincount(at, (weight * target)[of], width)
            out[i, :, width] = np.count_nonzero(weight), weight.sum(), (weight * target).sum()
        return out

    sums = table.sum_over(part, np.zeros(0), (len(nodes), 3, width + 1))
    found = []
    for (t, _), of_node in zip(nodes, sums):
        at = np.flatnonzero((of_node[0, :width] > 0) & task.growth.allowed(t, codes // MAX_LEVELS))
        whole = Nodes(*of_node[:, width:])
        term, level = best_splits(np.zeros(len(at), np.int64), codes[at], Nodes(*of_node[:, at]), whole, task.growth)
        value = whole.total[0] / max(whole.weight[0] + task.growth.shrink, 1e-300) * STEP
        first, last = np.searchsorted(codes, [term[0] * MAX_LEVELS, falling(term, level)[0] + 1])
        right = of_node[0, first:last].sum() if term[0] != LEAF else 0
        found.append((int(term[0]), int(level[0]), float(value), int(whole.rows[0]), int(right)))
    return found


def _finished(table: SparseTable, task: Task, trees: dict[int, Tree], depths: dict) -> Iterator[tuple[int, int, Tree]]:
    """The rest of each open leaf, grown by the one task that gets all of its rows."""
    wanted = sorted({t for t, _ in depths})
    walk = Ensemble([trees[t] for t in wanted])
    size, growth = table.size, task.growth
    open_leaves = {t: [leaf for u, leaf in depths if u == t] for t in wanted}
    kind = "<i4" if size * MAX_LEVELS < 1 << 31 else "<i8"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch):
                rows = Rows.of(block, size)
                levels = task.levels(rows.values)
                ends, target = walk.leaves(rows, levels), whole_steps(task.target(rows, levels))
                code = falling(rows.terms, levels).astype(kind)
                for i, t in enumerate(wanted):
                    leaves = np.array(open_leaves[t])
                    numbers = np.full(len(trees[t]), LEAF)
                    numbers[leaves] = np.arange(len(leaves))
                    weight = task.draw(rows.keys, t)
                    of = np.where(weight > 0, numbers[ends[:, i] - walk.roots[i]], LEAF)
                    of = of.astype(np.int16 if len(leaves) < 1 << 15 else np.int64)  # short numbers are sorted by radix
                    members = np.argsort(of, kind="stable")[np.count_nonzero(of == LEAF) :]
                    kept = np.flatnonzero((of != LEAF)[rows.row] & growth.allowed(t, np.arange(size))[rows.terms])
                    kept = kept[np.argsort(of[rows.row[kept]], kind="stable")]
                    lengths = np.bincount(rows.row[kept], minlength=rows.number)[members]
                    cuts = np.searchsorted(of[members], np.arange(len(leaves) + 1))
                    before = np.concatenate([[0], np.cumsum(lengths)])
                    for leaf, first, last in zip(leaves.tolist(), cuts[:-1], cuts[1:]):
                        if first == last:
                            continue
                        here, entries = members[first:last], kept[before[first] : before[last]]
                        parts = (np.cumsum(lengths[first:last]), code[entries], weight[here].astype("<i8"), target[here])
                        packed = [pa.array([part.tobytes()], pa.binary()) for part in parts]
                        yield pa.record_batch(
                            [pa.array([t], pa.int32()), pa.array([leaf], pa.int32()), *packed],
                            ["tree", "leaf", "ends", "codes", "weights", "targets"],
                        )

    def grown(parts: pd.DataFrame) -> pd.DataFrame:
        t, leaf = int(parts["tree"].iloc[0]), int(parts["leaf"].iloc[0])
        ends = [np.frombuffer(p, "<i8") for p in parts["ends"]]
        rows = [np.repeat(np.arange(len(e)), np.diff(e, prepend=0)) for e in ends]
        before = np.cumsum([0, *map(len, ends)])
        row = np.concatenate([(r + b).astype(np.int32) for r, b in zip(rows, before)])
        code = np.frombuffer(b"".join(parts["codes"]), kind)
        weight = np.frombuffer(b"".join(parts["weights"]), "<i8")
        target = np.frombuffer(b"".join(parts["targets"]), "<f8")
        tree = grow_here(row, code, weight, target, t, growth, depths[t, leaf])
        return pd.DataFrame({"tree": [t], "leaf": [leaf], "packed": [tree.packed()]})

    dealt_rows = table.blocks.mapInArrow(dealt, OPEN)
    found = dealt_rows.groupBy("tree", "leaf").applyInPandas(grown, "tree int, leaf int, packed binary").toArrow()
    for t, leaf, packed in zip(*(found.column(c).to_pylist() for c in ("tree", "leaf", "packed"))):
        yield t, leaf, Tree.unpacked(packed)
