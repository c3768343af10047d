"""Suffix-array dedup over UTF-8 bytes.

Every byte under a string of ``length`` bytes that also starts anywhere else is removed. Tasks get the stretches of text that
share a winnowed anchor with others (see ``repeats``) and cut them into tokens of a few words, which end where two bytes say so,
named in the order of their bytes. A suffix array of the token sequence is built by linear grouping (see ``suffixes``); its
order is that of the bytes, as no token is the beginning of another. What two neighbours in it have in common is counted on the bytes
themselves. So the suffixes that share a given number of bytes lie side by side, and two strings are equal if the suffixes at
their first token starts share all that is left of the string and the bytes before those starts are equal too. Strings that
show no token start, or none for more than WIDE bytes, are sorted by a hash of those bytes and then compared.

Defined cases: a null text is empty; texts shorter than ``length`` keep all; matches never cross documents; equal rows are
copies of one another like other equal texts; null and repeated doc_ids are allowed; an empty table gives an empty result;
further columns are not read. Kept bytes may cut a character, so they are binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from scriva.llm import repeats, substrings
from scriva.llm.hashing import BYTE_VALUE, Rolling
from scriva.llm.suffixes import suffix_array

LENGTH, GRAM = 400, 64
#: Bytes of one suffix array.
ARRAY_BYTES = 1 << 20
#: Suffixes whose bytes are compared at a time.
COMPARED = 16_384

#: Up to so many bytes before a token start are compared without a hash.
WIDE = 96

#: Bytes that may end a token: all but letters, digits and bytes from 128 on, of which every fourth continuation byte may.
MAY_END = np.ones(256, bool)
MAY_END[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
MAY_END[128:192:4] = True
#: Bytes after which they do: every fourth of the others.
BEFORE_END = ~MAY_END & (np.arange(256) % 4 == 0)


def token_starts(raw: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Places where a token starts, other than the places `base` where a content does. Two bytes before a place decide it."""
    ends = MAY_END[raw]
    ends[1:] &= BEFORE_END[raw[:-1]]
    ends[base[:-1]] = False
    starts = np.flatnonzero(ends) + 1
    return starts[~np.isin(starts, base)]


def ordered_symbols(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_last: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the tokens raw[start:end], in the order of their bytes.

    The last token of a content has no known end: its number is of its own, and smaller than that of an equal token before an end.
    """
    sizes = ends - starts
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    place = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    tokens = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[place])])
    coded = tokens.dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[np.asarray(pc.array_sort_indices(coded.dictionary))] = np.arange(len(rank))
    name = 2 * rank[np.asarray(coded.indices)] + ~is_last
    order = np.argsort(name, kind="stable")
    new = np.append(True, (name[order][1:] != name[order][:-1]) | is_last[order][1:])
    out = np.empty(len(name), np.int64)
    out[order] = np.cumsum(new)
    return out


def common_bytes(raw: np.ndarray, at: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to `most`, the text at each of the places `at` has in common with that at the place before in the list."""
    rows = np.lib.stride_tricks.sliding_window_view(np.append(raw, np.zeros(most, np.uint8)), most)
    out = np.zeros(len(at), np.int64)
    for a in range(1, len(at), COMPARED):
        b = min(a + COMPARED, len(at))
        differ = rows[at[a:b]] != rows[at[a - 1 : b - 1]]
        out[a:b] = np.where(differ.any(1), differ.argmax(1), most)
    out[1:] = np.minimum(out[1:], np.minimum(room[1:], room[:-1]))
    return out


def eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros behind the end."""
    padded, out = np.concatenate((raw, np.zeros(8, np.uint8))), np.zeros(len(raw), np.uint64)
    for k in range(8):
        out |= padded[k : k + len(raw)].astype(np.uint64) << np.uint64(8 * k)
    return out


def numbered(words: np.ndarray, roll: Rolling, first: np.ndarray, width: int) -> np.ndarray:
    """A number for each of the strings of that width, equal for equal ones and no others. words: eights of the bytes.

    Wide strings are sorted by a hash and then compared, byte by byte, with the first of their hash."""
    if width < 8:
        return np.unique(words[first] & np.uint64((1 << 8 * width) - 1), return_inverse=True)[1]
    steps = np.array([*range(0, width - 7, 8), width - 8])
    if width > WIDE:
        _, one, out = np.unique(roll.of(first, first + width), return_index=True, return_inverse=True)
        like = first[one][out]
        rest, many = np.flatnonzero(like != first), COMPARED // 8
        parts = (rest[k : k + many, None] for k in range(0, len(rest), many))
        if all(np.array_equal(words[first[p] + steps], words[like[p] + steps]) for p in parts):
            return out
    out = np.zeros(len(first), np.int64)
    for k in steps:
        step = np.unique(words[first + k], return_inverse=True)[1]
        out = np.unique(out * (step.max() + 1) + step, return_inverse=True)[1]
    return out


def window_classes(contents: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(content, start, class) of every window: equal windows have equal classes. All contents go into one suffix array."""
    base = np.cumsum([0, *map(len, contents)])
    raw = np.concatenate(contents)
    starts = token_starts(raw, base)
    of = np.searchsorted(base, starts, side="right") - 1
    is_last = np.append(of[1:] != of[:-1], True) if len(starts) else np.empty(0, bool)
    ends = np.where(is_last, base[of + 1], np.append(starts[1:], 0)) if len(starts) else starts
    symbols = ordered_symbols(raw, starts, ends, is_last) if len(starts) else np.empty(0, np.int64)
    order = np.array(suffix_array([*symbols.tolist(), 0])[1:], np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    common = common_bytes(raw, starts[order], (base[of + 1] - starts)[order], length)

    # Numbers of windows and places are narrow, as there is one of each for every byte.
    many = np.diff(base) - length + 1
    owner = np.repeat(np.arange(len(contents), dtype=np.int32), many)
    first = np.arange(len(owner), dtype=np.int32) + np.repeat((base[:-1] - np.cumsum(many) + many).astype(np.int32), many)
    token = np.cumsum(np.bincount(starts, minlength=len(raw) + 1), dtype=np.int32)[first + 1]  # the first token start that the window itself shows
    lead = np.append(starts, np.iinfo(np.int32).max).astype(np.int32)[token] - first  # bytes before it
    lead = np.minimum(lead, length).astype(np.min_scalar_type(length))  # at or past its end: it shows none
    kind = np.arange(len(first), dtype=np.int32)  # at first, a class of its own for every window
    by_lead = np.argsort(lead, kind="stable")
    cuts = np.flatnonzero(np.diff(lead[by_lead])) + 1
    roll, words = Rolling(BYTE_VALUE[raw]), eights(raw)
    for some in np.split(by_lead, cuts) if len(first) else ():
        width = int(lead[some[0]])
        if width < length:
            group = np.cumsum(common < length - width)[rank[token[some]]]
            shared = np.bincount(group)[group] > 1
            some, group = some[shared], group[shared]
        else:
            group = np.zeros(len(some), np.int64)
        if len(some):
            before = numbered(words, roll, first[some], width)
            _, one, same = np.unique(group * (before.max() + 1) + before, return_index=True, return_inverse=True)
            kind[some] = some[one][same]  # the class is named by one of its windows
    return owner, first - base[:-1].astype(np.int32)[owner], kind


def match(contents: list[np.ndarray], groups: np.ndarray, length: int) -> repeats.Classes:
    """Classes of the windows of contents that are sorted by group; a group goes into one suffix array."""
    sizes = np.array([len(c) for c in contents])
    part = (np.cumsum(sizes) - sizes) // ARRAY_BYTES
    edges = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    part = np.repeat(part[edges], np.diff(np.append(edges, len(groups))))
    found, named = [], 0
    for p in np.unique(part):
        chosen = np.flatnonzero(part == p)
        owner, start, kind = window_classes([contents[i] for i in chosen], length)
        found.append((chosen[owner], start, kind + named))
        named += len(kind)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", passage_words: int | None = None) -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept: the bytes left, n_passage_words), one row per row of docs.

    With passage_words, n_passage_words counts the words of a text under passages of so many words that also start elsewhere.
    Such a passage may have fewer bytes than `length`: it is reported, not removed.
    """
    passages = None
    if passage_words:
        _, passages = repeats.stretches(docs, True, passage_words, substrings.GRAM, substrings.extend, id_col, text_col)
    return repeats.cut(docs, False, length, GRAM, match, id_col, text_col, passages)
