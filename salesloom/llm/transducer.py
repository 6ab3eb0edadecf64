"""Weighted acyclic automata over phrases: language, then words, to a count.

A transducer is handled as ``Paths``, its paths by length in order, and kept as
``packed`` bytes, its minimal form: states with equal weight and equal arcs are one,
which joins the many phrases that end alike.  Union sums the weights of equal
paths, composition looks the paths of one transducer up in another, and ``cut``
divides one by ranges of prefixes.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import zstandard

DEPTH = 4  # a language and up to three words

Level = tuple[np.ndarray, np.ndarray, np.ndarray]  # parent (one level up), label, weight


@dataclass
class Paths:
    """All paths, level by level; in a level by parent, then label.  Labels are in byte order."""

    langs: list[bytes]
    words: list[bytes]
    levels: list[Level]

    def labels(self, level: int) -> list[bytes]:
        return self.words if level else self.langs

    def __len__(self) -> int:
        return sum(len(w) for _, _, w in self.levels)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where a new one starts in that order, and the group of each key."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def counted(langs: list[bytes], words: list[bytes], lang: np.ndarray, word: np.ndarray,
            left: np.ndarray) -> Paths:
    """The phrases that start at each place of a running text.

    ``lang`` and ``word`` index the labels, which may be in any order; ``left`` is the
    number of words from a place to the end of its piece.
    """
    lang_order = sorted(range(len(langs)), key=langs.__getitem__)
    word_order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), np.int64)
    rank[word_order] = np.arange(len(words))
    lang_rank = np.empty(len(langs), np.int64)
    lang_rank[lang_order] = np.arange(len(langs))
    word = rank[word]
    levels: list[Level] = []
    at = np.arange(len(word))
    above = np.zeros(len(word), np.int64)
    for level in range(DEPTH):
        if level > 1:
            reach = left[at] >= level
            at, above = at[reach], above[reach]
        size = len(words) if level else len(langs)
        keys = above * size + (word[at + level - 1] if level else lang_rank[lang[at]])
        order, starts, group = _grouped(keys)
        unique = keys[order][starts]
        weight = np.diff(np.append(starts, len(keys)))
        levels.append((unique // max(size, 1), unique % max(size, 1), weight))
        above = group
    return Paths([langs[i] for i in lang_order], [words[i] for i in word_order], levels)


def terminal(like: Paths, rows: Sequence[tuple[np.ndarray, ...]], weights: Sequence[np.ndarray]) -> Paths:
    """Rows of labels of ``like``, an array for each label; paths weigh the most that ends there, others 0."""
    levels: list[Level] = []
    above = [np.zeros(len(r[0]), np.int64) for r in rows]
    for level in range(DEPTH):
        size = len(like.labels(level))
        deep = [k for k, r in enumerate(rows) if len(r) > level]
        keys = np.concatenate([above[k] * size + rows[k][level] for k in deep] or [np.empty(0, np.int64)])
        ends = np.concatenate([weights[k] if len(rows[k]) == level + 1 else np.zeros(len(weights[k]), np.int64)
                               for k in deep] or [np.empty(0, np.int64)])
        order, starts, group = _grouped(keys)
        unique = keys[order][starts]
        weight = np.maximum.reduceat(ends[order], starts) if len(keys) else ends
        levels.append((unique // max(size, 1), unique % max(size, 1), weight))
        for k, part in zip(deep, np.split(group, np.cumsum([len(above[k]) for k in deep])[:-1]) if deep else []):
            above[k] = part
    return Paths(like.langs, like.words, levels)


def union(parts: Sequence[Paths], most: bool = False) -> Paths:
    """Paths of any part; weights of equal paths are summed, or the largest is taken."""
    if len(parts) == 1:
        return parts[0]
    labels, ranks = [], []
    for level in (0, 1):
        every = sorted(set().union(*[p.labels(level) for p in parts]))
        rank = {label: k for k, label in enumerate(every)}
        labels.append(every)
        ranks.append([np.fromiter(map(rank.__getitem__, p.labels(level)), np.int64) for p in parts])
    levels: list[Level] = []
    above = [np.zeros(1, np.int64) for _ in parts]
    for level in range(DEPTH):
        size = max(len(labels[min(level, 1)]), 1)
        keys = [a[p.levels[level][0]] * size + r[p.levels[level][1]]
                for a, p, r in zip(above, parts, ranks[min(level, 1)])]
        weights = np.concatenate([p.levels[level][2] for p in parts])
        joined = np.concatenate(keys)
        order, starts, group = _grouped(joined)
        unique = joined[order][starts]
        if len(joined):
            weights = (np.maximum if most else np.add).reduceat(weights[order], starts)
        levels.append((unique // size, unique % size, weights))
        above = np.split(group, np.cumsum([len(k) for k in keys])[:-1])
    return Paths(labels[0], labels[1], levels)


def pruned(paths: Paths, least: int) -> Paths:
    """Paths of at least ``least``, and what leads to them."""
    levels: list[Level] = []
    needed = np.empty(0, np.int64)
    keeps = []
    for parent, _, weight in reversed(paths.levels):
        keep = weight >= least
        keep[needed] = True
        keeps.append(keep)
        needed = parent[keep]
    place = np.zeros(1, np.int64)
    for (parent, label, weight), keep in zip(paths.levels, reversed(keeps)):
        levels.append((place[parent[keep]], label[keep], weight[keep]))
        place = np.cumsum(keep) - 1
    return Paths(paths.langs, paths.words, levels)


def _first_child(paths: Paths, level: int) -> np.ndarray:
    """Where the children of each path of a level start one level down, and the end."""
    n = len(paths.levels[level][2])
    below = paths.levels[level + 1][0] if level + 1 < DEPTH else np.empty(0, np.int64)
    return np.concatenate(([0], np.cumsum(np.bincount(below, minlength=n)))) if n else np.zeros(1, np.int64)


def preorder(paths: Paths) -> list[np.ndarray]:
    """The place of every path among all paths in order, level by level."""
    sizes, first = [np.empty(0)] * DEPTH, [np.empty(0)] * DEPTH
    below = np.empty(0, np.int64)
    for level in reversed(range(DEPTH)):
        first[level] = _first_child(paths, level)
        total = np.concatenate(([0], np.cumsum(below)))
        sizes[level] = below = 1 + np.diff(total[first[level]])
    places: list[np.ndarray] = []
    start = np.zeros(1, np.int64)  # of the first child of a path
    heads = np.zeros(1, np.int64)
    for level in range(DEPTH):
        parent = paths.levels[level][0]
        before = np.concatenate(([0], np.cumsum(sizes[level])))
        places.append(start[parent] + before[:-1] - before[heads[parent]])
        start, heads = places[-1] + 1, first[level][:-1]
    return places


def cut(paths: Paths, bounds: Sequence[tuple[bytes, ...]]) -> list[tuple[int, Paths]]:
    """The parts of ``paths`` between the bounds, by number; a bound belongs to what follows it.

    What leads to a part without belonging to it weighs nothing in it.
    """
    if not len(paths):
        return []
    places = preorder(paths)
    total = len(paths)
    ranks = np.array([_place(paths, places, total, b) for b in bounds], np.int64)
    edges = np.concatenate(([0], np.maximum.accumulate(ranks), [total])) if len(ranks) else np.array([0, total])
    marks = [np.searchsorted(p, edges) for p in places]
    out = []
    for k in range(len(edges) - 1):
        if edges[k] == edges[k + 1]:
            continue
        spans, low, high = [(0, 0)] * DEPTH, 0, 0
        for level in reversed(range(DEPTH)):
            own_low, own_high = int(marks[level][k]), int(marks[level][k + 1])
            if high > low:  # parents of what was taken one level down
                parent = paths.levels[level + 1][0]
                up_low, up_high = int(parent[low]), int(parent[high - 1]) + 1
                low = min(own_low, up_low) if own_high > own_low else up_low
                high = max(own_high, up_high)
            else:
                low, high = own_low, own_high
            spans[level] = (low, high)
        levels: list[Level] = []
        above = 0
        for level, (low, high) in enumerate(spans):
            parent, label, weight = (a[low:high] for a in paths.levels[level])
            weight = weight.copy()
            weight[:max(0, min(high, int(marks[level][k])) - low)] = 0
            levels.append((parent - above, label, weight))
            above = low
        out.append((k, Paths(paths.langs, paths.words, levels)))
    return out


def _place(paths: Paths, places: list[np.ndarray], total: int, bound: tuple[bytes, ...]) -> int:
    """How many paths come before ``bound``."""
    low, high, after = 0, len(paths.levels[0][1]), total
    place = 0
    for level, label in enumerate(bound):
        known = paths.labels(level)
        rank = bisect_left(known, label)
        at = low + int(np.searchsorted(paths.levels[level][1][low:high], rank))
        if at == high:
            return after
        place = int(places[level][at])
        if rank == len(known) or known[rank] != label or paths.levels[level][1][at] != rank:
            return place
        if at + 1 < high:
            after = int(places[level][at + 1])
        if level + 1 < DEPTH:
            low, high = (int(x) for x in np.searchsorted(paths.levels[level + 1][0], [at, at + 1]))
    return place


def every(paths: Paths, step: int) -> list[tuple[bytes, ...]]:
    """Each ``step``-th path in order."""
    out = []
    for level, places in enumerate(preorder(paths)):
        for at in np.flatnonzero(places % step == step - 1):
            out.append(phrase(paths, level, int(at)))
    return sorted(out)


def phrase(paths: Paths, level: int, at: int) -> tuple[bytes, ...]:
    labels: list[bytes] = []
    for k in range(level, -1, -1):
        parent, label, _ = paths.levels[k]
        labels.append(paths.labels(k)[label[at]])
        at = int(parent[at])
    return tuple(reversed(labels))


def columns(paths: Paths, level: int) -> tuple[np.ndarray, ...]:
    """The labels of all paths of a level, an array for each place."""
    at = np.arange(len(paths.levels[level][2]))
    out = []
    for k in range(level, -1, -1):
        parent, label, _ = paths.levels[k]
        out.append(label[at])
        at = parent[at]
    return tuple(reversed(out))


def _known(asked: list[bytes], labels: list[bytes]) -> np.ndarray:
    rank = {label: k for k, label in enumerate(labels)}
    return np.fromiter((rank.get(a, -1) for a in asked), np.int64, len(asked))


def _step(paths: Paths, level: int, above: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The paths that ``label`` leads to from ``above``; -1 for none."""
    size = max(len(paths.labels(level)), 1)
    parent, known, _ = paths.levels[level]
    keys = parent * size + known
    asked = np.where((above < 0) | (label < 0), -1, above * size + label)
    at = np.searchsorted(keys, asked)
    at[at == len(keys)] = 0
    return np.where((asked >= 0) & (keys[at] == asked), at, -1) if len(keys) else np.full(len(asked), -1)


def composed(asked: Paths, counts: Paths) -> Paths:
    """The paths of ``asked``, those it gives a weight, with their weights in ``counts``."""
    ranks = [_known(asked.langs, counts.langs), _known(asked.words, counts.words)]
    levels: list[Level] = []
    above = np.zeros(1, np.int64)
    for level, (parent, label, weight) in enumerate(asked.levels):
        above = _step(counts, level, above[parent], ranks[min(level, 1)][label])
        held = counts.levels[level][2]
        found = np.where(above >= 0, held[above], 0) if len(held) else np.zeros(len(above), np.int64)
        levels.append((parent, label, np.where(weight > 0, found, 0)))
    return Paths(asked.langs, asked.words, levels)


def weights(counts: Paths, like: Paths, row: tuple[np.ndarray, ...]) -> np.ndarray:
    """Weights in ``counts`` of rows of labels of ``like``; 0 for those it lacks."""
    above = np.zeros(len(row[0]), np.int64)
    for level, label in enumerate(row):
        known = _known(like.labels(level), counts.labels(level))
        above = _step(counts, level, above, known[label] if len(known) else label)
    held = counts.levels[len(row) - 1][2]
    return np.where(above >= 0, held[above], 0) if len(held) else np.zeros(len(above), np.int64)


# --- the minimal form ---------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def _used(labels: list[bytes], columns: Sequence[np.ndarray]) -> tuple[list[bytes], list[np.ndarray]]:
    """The labels that occur, in order, and the columns with their new places; small columns look at no other label."""
    if sum(map(len, columns)) * 4 < len(labels):
        held, place = np.unique(np.concatenate(columns), return_inverse=True)
        return [labels[i] for i in held.tolist()], np.split(place, np.cumsum([len(c) for c in columns])[:-1])
    used = np.zeros(len(labels), bool)
    for c in columns:
        used[c] = True
    place = np.cumsum(used) - 1
    return [labels[i] for i in np.flatnonzero(used).tolist()], [place[c] for c in columns]


def packed(paths: Paths) -> bytes:
    """The minimal transducer, as bytes."""
    langs, (lang_place,) = _used(paths.langs, [paths.levels[0][1]])
    words, word_places = _used(paths.words, [c for _, c, _ in paths.levels[1:]])
    states = np.empty(0, np.int64)  # of the paths one level down
    out = []
    for level in reversed(range(DEPTH)):
        weight = paths.levels[level][2]
        first = _first_child(paths, level)
        n_arcs = np.diff(first)
        label = word_places[level] if level + 1 < DEPTH else np.empty(0, np.int64)
        arcs = _mixed(_mixed(label) + states.astype(np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(arcs)))
        order, starts, group = _grouped(_mixed(weight) + total[first[1:]] - total[first[:-1]])
        like = order[starts]  # a path that stands for each state
        # a state is shared only where weight and arcs are equal indeed
        model = like[group]
        same = (weight == weight[model]) & (n_arcs == n_arcs[model])
        owner = np.repeat(np.arange(len(weight)), n_arcs)
        fits = same[owner]
        mine = np.arange(len(label))[fits]
        its = (first[model[owner]] + np.arange(len(label)) - first[owner])[fits]
        bad = np.concatenate((np.flatnonzero(~same),
                              owner[fits][(label[mine] != label[its]) | (states[mine] != states[its])]))
        if len(bad):
            bad = np.unique(bad)
            group[bad] = len(like) + np.arange(len(bad))
            like = np.concatenate((like, bad))
        counts = n_arcs[like]
        kept = np.repeat(first[like] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        out.append((_small(weight[like]), _small(counts), _small(label[kept]), _small(states[kept])))
        states = group
    root = (_small(lang_place), _small(states))
    blob = pickle.dumps((langs, b"\n".join(words), len(words), out[::-1], root), protocol=5)
    return zstandard.ZstdCompressor(level=1).compress(blob)


def unpacked(blob: bytes) -> Paths:
    """The paths of a minimal transducer or of ``plain`` bytes."""
    langs, words, n_words, states, *root = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
    labels = words.split(b"\n") if n_words else []
    levels: list[Level] = []
    if not root:
        return Paths(langs, labels, [(np.repeat(np.arange(len(n_arcs)), n_arcs), label.astype(np.int64),
                                      weight.astype(np.int64)) for n_arcs, label, weight in states])
    (label, state), = root
    parent = np.zeros(len(label), np.int64)
    label, state = label.astype(np.int64), state.astype(np.int64)
    for weight, n_arcs, arc_label, arc_state in states:
        levels.append((parent, label, weight.astype(np.int64)[state]))
        n = n_arcs.astype(np.int64)[state]
        first = np.concatenate(([0], np.cumsum(n_arcs, dtype=np.int64)))[state]
        parent = np.repeat(np.arange(len(state)), n)
        arc = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        label, state = arc_label.astype(np.int64)[arc], arc_state.astype(np.int64)[arc]
    return Paths(langs, labels, levels)


def plain(paths: Paths) -> bytes:
    """All paths as bytes, level by level, without joining equal states."""
    langs, (lang,) = _used(paths.langs, [paths.levels[0][1]])
    words, labels = _used(paths.words, [c for _, c, _ in paths.levels[1:]])
    rows, above = [], 1
    for (parent, _, weight), label in zip(paths.levels, (lang, *labels)):
        rows.append((_small(np.bincount(parent, minlength=above)), _small(label), _small(weight)))
        above = len(label)
    blob = pickle.dumps((langs, b"\n".join(words), len(words), rows), protocol=5)
    return zstandard.ZstdCompressor(level=1).compress(blob)
