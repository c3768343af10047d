"""Substring dedup by seed and extend, over words (runs of ``[^\\x20\\x09-\\x0D]``, unchanged).

Documents are joined on winnowed anchors (see ``repeats``). All reaches of a seed are extended together, word by word, to both
sides of it: those that agree up to a depth are a group, which the next word parts further. A window of ``length`` words is
repeated when another reach agrees with it as far to the left and as far to the right; maximal repeats are what such windows
cover. Every word under a repeat is removed, in all its places.

Defined cases: null and blank texts have no words; texts shorter than ``length`` words keep all; equal rows are copies of one
another like other equal texts; null and repeated doc_ids are allowed; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from scriva.llm import repeats
from scriva.llm.hashing import Rolling

LENGTH, GRAM = 35, 10


def seed_places(words: np.ndarray, base: np.ndarray, length: int) -> np.ndarray:
    """Where the seed of each content lies: it is the smallest k-gram of its first window."""
    roll = Rolling(words)
    at = base[:-1, None] + np.arange(length - GRAM + 1)
    return base[:-1] + (roll.of(at.ravel(), at.ravel() + GRAM).reshape(at.shape) >> np.uint64(32)).argmin(1)


def extended(words: np.ndarray, first: np.ndarray, room: np.ndarray, step: int, groups: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each depth from 0, the group of contents that agree so far in one direction; -1 where none other does.

    first: the place next to the seed; room: how many words there are.
    """
    out = [groups]
    for d in range(depth):
        now = np.full(len(groups), -1, np.int64)
        going = np.flatnonzero((out[-1] >= 0) & (room > d))
        if len(going):
            key = out[-1][going] * (int(words.max()) + 1) + words[first[going] + step * d]
            _, name, times = np.unique(key, return_inverse=True, return_counts=True)
            now[going] = np.where(times[name] > 1, name, -1)
        out.append(now)
    return out


def extend(contents: list[np.ndarray], groups: np.ndarray, length: int) -> repeats.Classes:
    """Classes of the windows of contents that are sorted by group (seed)."""
    base = np.cumsum([0, *map(len, contents)])
    flat = np.concatenate(contents)
    seed = seed_places(flat, base, length)
    words = np.unique(flat, return_inverse=True)[1].astype(np.int64)
    groups = np.cumsum(np.concatenate(([0], groups[1:] != groups[:-1])))
    depth, behind = length - GRAM, seed + GRAM
    left = extended(words, seed - 1, seed - base[:-1], -1, groups, depth)
    right = extended(words, behind, base[1:] - behind, 1, groups, depth)
    found, named = [], 0
    for d in range(depth + 1):  # windows with d words to the left of the seed
        here = np.flatnonzero((seed - d >= base[:-1]) & (seed - d + length <= base[1:]))
        a, b = left[d][here], right[depth - d][here]
        _, same = np.unique(np.where((a >= 0) & (b >= 0), a * (len(groups) + 1) + b, -1 - here), return_inverse=True)
        found.append((here, seed[here] - d - base[here], same + named))
        named += len(here)
    owner, start, kind = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((start, owner))
    return owner[order], start[order], kind[order]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept: the words left, joined by one space, as UTF-8), one row per row of docs."""
    return repeats.cut(docs, True, length, GRAM, extend, id_col, text_col).drop("n_passage_words")
