"""BPE encoding and decoding with a public tokenizer file, as the tokenizers library does it.

The file is a word-level BPE (byte alphabet, end-of-word mark, lower case, white space dropped). Its bytes are broadcast (a
fixed file of a few MB), so executors need no copy of it. A batch of texts is cut at white space; the distinct chunks of the
batch are normalised and cut into pieces together, as one flat array of code points with a table of their kinds. Distinct
pieces are merged in rounds: the symbols of all pieces lie in one flat array, the ranks of neighbouring pairs are found by
binary search over the sorted pair keys, and each round merges the leftmost pair of lowest rank of every piece; later rounds
look up only the pairs that a merge has made. Very long pieces, of which each would need many rounds, are merged one by one
with a heap. Ids and decoded texts are gathered from chunks to documents by Arrow. A worker remembers pieces, not texts, as an
Arrow array that the pieces of a batch are looked up in at once, up to REMEMBERED of them until its task ends.

Defined cases: a null text counts as empty and has no tokens; special-token strings inside a text are special tokens, as in
the library; bytes that are no UTF-8 count as U+FFFD; texts of any length are encoded whole; further columns are carried along
unchanged unless they are named ``ids`` or ``decoded``, which the result replaces; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scriva.llm.common import bounded_batches

#: White space of Unicode beyond ASCII, as RE2 writes it.
WIDE_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Code points from here on are neither letters nor numbers and have no lower case.
KNOWN_POINTS = 0x34000
#: Letters and numbers of the library's tables that Unicode 15.1 does not have (first, last).
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
LATER_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Capitals that Unicode 15.1 does not have (first, last, lower case of the first).
LATER_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]
#: Marks that the library's composition doesn't know, as its tables are of an older Unicode (first, last). They
#: stay where they are, and nothing is composed or reordered across them.
UNKNOWN_MARKS = [
    (0x07FD, 0x07FD), (0x0898, 0x089F), (0x08CA, 0x08D3), (0x09FE, 0x09FE), (0x0C3C, 0x0C3C), (0x0D3B, 0x0D3C), (0x0EBA, 0x0EBA), (0x1715, 0x1715),
    (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85),
    (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0),
    (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1),
    (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
]
AT_MARKS = re.compile("([" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNKNOWN_MARKS) + "])")

#: Pieces that a worker remembers at most between batches: those of the first ones. A batch of invented words may have 50,000.
REMEMBERED = 150_000
LONG_PIECE = 300
BATCH_BYTES = 1_000_000
NO_RANK = np.iinfo(np.int64).max


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 bytes for themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


@functools.cache
def point_tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point, its kind (SPACE only for the line feed, which parts chunks) and its lower case."""
    kinds, lower = np.full(0x110000, OTHER, np.uint8), np.arange(0x110000, dtype=np.uint32)
    for k in range(KNOWN_POINTS):
        c = chr(k)
        kinds[k] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)
        low = c.lower()
        if len(low) == 1:
            lower[k] = ord(low)
    for first, last in LATER_LETTERS:
        kinds[first : last + 1] = LETTER
    for first, last in LATER_NUMBERS:
        kinds[first : last + 1] = NUMBER
    for first, last, to in LATER_CAPITALS:
        lower[first : last + 1] = np.arange(to, to + last - first + 1)
    kinds[10] = SPACE
    return kinds, lower


def composed(text: str) -> str:
    """NFC as the library has it."""
    if np.frombuffer(text.encode("utf-32-le"), np.uint32).max() >= UNKNOWN_MARKS[0][0] and AT_MARKS.search(text):
        return "".join(part if k % 2 else unicodedata.normalize("NFC", part) for k, part in enumerate(AT_MARKS.split(text)))
    return unicodedata.normalize("NFC", text)


def pieces_of(text: str, chunks: int) -> tuple[pa.Array, np.ndarray]:
    """The pieces (as bytes) of chunks that are parted by line feeds, and how many each chunk has.

    A piece is a contraction ('s, 't, 're, 've, 'm, 'll, 'd), a run of letters, one number, or a run of anything else.
    """
    if not text.isascii():
        text = composed(text).replace("İ", "i̇")  # the one capital of two lower-case code points
    kinds, lower = point_tables()
    point = lower[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    kind = kinds[point]
    start = np.ones(len(point), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    ahead = np.append(point, np.zeros(3, np.uint32))
    mark = np.flatnonzero((point == ord("'")) & start)
    one, two = ahead[mark + 1], ahead[mark + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[mark[short | long] + 1] = False
    after = np.append(mark[short] + 2, mark[long] + 3)
    start[after[after < len(start)]] = True

    solid = kind != SPACE
    owner = np.cumsum(~solid)[solid]
    begins = np.flatnonzero(start[solid])
    point = point[solid]
    width = 1 + (point >= 0x80).astype(np.int32) + (point >= 0x800) + (point >= 0x10000)
    ends = np.append(np.int32(0), np.cumsum(width, dtype=np.int32))
    raw = point.astype("<u4").tobytes().decode("utf-32-le").encode()
    offsets = np.append(ends[begins], ends[-1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]), np.bincount(owner[begins], minlength=chunks)


class WordBPE:
    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_names, self.special_ids = pa.array(list(special), pa.string()), np.array(list(special.values()), np.int32)
        self.special = "(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")" if special else ""
        self.size = max(*vocab.values(), *special.values(), 0) + 1
        names: list[str | None] = [None] * self.size
        for name, k in (vocab | special).items():
            names[k] = name
        self.names = pa.array(names, pa.string())
        end = model.get("end_of_word_suffix") or ""
        letters = byte_alphabet()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        keys, made = left * self.size + right, np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # The pairs of two bytes, of which the second may end a piece, are looked up once for all.
        pair = np.repeat(self.inner, 256), np.tile(np.append(self.inner, self.last).reshape(2, 256), 256).reshape(2, -1)
        self.of_bytes = [self.look_up(pair[0], second) for second in pair[1]]
        self.forget()

    def forget(self) -> None:
        """Pieces are known by their number; their ids lie one after another."""
        self.known = pa.array([], pa.binary())
        self.held, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (NO_RANK if it has none) and the symbol that it makes."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.made[at]

    @functools.cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist(), strict=True), strict=True))

    def merge_long(self, symbols: list[int]) -> list[int]:
        """One piece with a heap of its pairs."""
        n, pairs, size = len(symbols), self.pairs, self.size
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(hit[0], i, symbols[i], symbols[i + 1], hit[1]) for i in range(n - 1) if (hit := pairs.get(symbols[i] * size + symbols[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = made, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (hit := pairs.get(symbols[x] * size + symbols[y])):
                    heapq.heappush(heap, (hit[0], x, symbols[x], symbols[y], hit[1]))
        return [s for s in symbols if s >= 0]

    def merge_rounds(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of these lengths, one piece after another, and how many each has."""
        ends = np.cumsum(lengths) - 1
        owner, symbol = np.repeat(np.arange(len(lengths)), lengths), self.inner[raw]
        symbol[ends] = self.last[raw[ends]]
        rank, made = np.full(len(raw), NO_RANK), np.zeros(len(raw), np.int64)
        key = raw[:-1].astype(np.int64) * 256 + raw[1:]
        is_last = np.zeros(len(raw), bool)
        is_last[ends] = True
        for second, (ranks, makes) in zip((False, True), self.of_bytes, strict=True):
            at = np.flatnonzero((is_last[1:] == second) & ~is_last[:-1])
            rank[at], made[at] = ranks[key[at]], makes[key[at]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            place = np.arange(len(symbol))
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            # Rank and place in one number: its minimum is the leftmost pair of lowest rank.
            best = np.minimum.reduceat(np.where(rank < NO_RANK, rank << 32 | place, NO_RANK), starts)
            going = best < NO_RANK
            sizes = np.diff(np.append(starts, len(symbol)))
            stays = np.repeat(going, sizes)
            if not going.all():
                done.append((owner[~stays], symbol[~stays]))
            hit = best[going] & 0xFFFFFFFF
            symbol[hit] = made[hit]
            stays[hit + 1] = False
            gone = np.cumsum(~stays)
            hit = hit - gone[hit]
            symbol, owner, rank, made = symbol[stays], owner[stays], rank[stays], made[stays]
            left = hit[hit > 0] - 1
            for at in (left, hit):
                whole = at + 1 < len(symbol)
                at = at[whole]
                new, makes = self.look_up(symbol[at], symbol[at + 1])
                rank[at], made[at] = np.where(owner[at] == owner[at + 1], new, NO_RANK), makes
            if len(rank):
                rank[-1] = NO_RANK
        owner, symbol = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        return symbol[np.argsort(owner, kind="stable")].astype(np.int32), np.bincount(owner, minlength=len(lengths))

    def merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one piece after another, and where each piece's end (a zero first)."""
        lengths = np.asarray(pc.binary_length(pieces)).astype(np.int64)
        long = np.flatnonzero(lengths > LONG_PIECE)
        short = pieces.filter(pa.array(lengths <= LONG_PIECE)) if len(long) else pieces
        ids, counts = np.empty(0, np.int32), np.zeros(len(pieces), np.int64)
        if len(short):
            ends = np.frombuffer(short.buffers()[1], np.int32)[short.offset : short.offset + len(short) + 1]
            ids, counts[lengths <= LONG_PIECE] = self.merge_rounds(np.frombuffer(short.buffers()[2], np.uint8)[ends[0] : ends[-1]], np.diff(ends))
        if not len(long):
            return ids, np.append(0, np.cumsum(counts))
        places, found = np.cumsum(counts)[long], []
        for k in long:
            raw = np.frombuffer(pieces[k].as_buffer(), np.uint8)
            found.append(self.merge_long([*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]))
            counts[k] = len(found[-1])
        return np.insert(ids, np.repeat(places, counts[long]), np.concatenate(found)), np.append(0, np.cumsum(counts))

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, one chunk after another, and how many each has."""
        special = pc.index_in(chunks, value_set=self.special_names)
        at_special = np.flatnonzero(np.asarray(pc.is_valid(special)))
        if len(at_special):
            chunks = pc.if_else(pc.is_null(special), chunks, "")
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), "\n")
        text = str(joined[0].as_buffer(), "utf-8", "replace")
        pieces, per_chunk = pieces_of(text, len(chunks)) if text else (pa.array([], pa.binary()), np.zeros(len(chunks), np.int64))
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        number = np.asarray(pc.fill_null(pc.index_in(distinct, value_set=self.known), -1)).copy()
        new = number < 0
        fresh, ends = self.merged(distinct.filter(pa.array(new)))
        number[new] = np.arange(len(self.known), len(self.known) + len(ends) - 1)
        held, ends = np.append(self.held, fresh), np.append(self.ends, self.ends[-1] + ends[1:])
        if len(ends) <= REMEMBERED:
            self.known, self.held, self.ends = pa.concat_arrays([self.known, distinct.filter(pa.array(new))]), held, ends
        number = number[np.asarray(coded.indices)]
        counts = ends[number + 1] - ends[number]
        before = np.cumsum(counts) - counts
        ids = held[np.repeat(ends[number] - before, counts) + np.arange(int(counts.sum()))]
        upto = np.append(0, np.cumsum(counts))
        cuts = np.append(0, np.cumsum(per_chunk))
        per_chunk = upto[cuts[1:]] - upto[cuts[:-1]]
        if len(at_special):
            ids = np.insert(ids, (np.cumsum(per_chunk) - per_chunk)[at_special], self.special_ids[np.asarray(special.take(pa.array(at_special)))])
            per_chunk[at_special] = 1
        return ids, per_chunk

    def encode_batch(self, texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
        """For each text, its ids and what they decode to."""
        texts = pc.fill_null(texts, "")
        if self.special and pc.any(pc.match_substring_regex(texts, self.special)).as_py():
            texts = pc.replace_substring_regex(texts, self.special, r" \1 ")  # a special token is a chunk of its own
        if pc.any(pc.match_substring_regex(texts, WIDE_SPACE)).as_py():
            texts = pc.replace_substring_regex(texts, WIDE_SPACE, " ")
        words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        coded = words.flatten().dictionary_encode()
        ids, counts = self.chunk_ids(coded.dictionary)
        first = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
        decoded = pc.binary_join(pa.ListArray.from_arrays(first, self.names.take(pa.array(ids))), " ")
        at = np.asarray(coded.indices)
        upto = np.append(0, np.cumsum(counts[at], dtype=np.int32))
        offsets = np.asarray(words.offsets)
        per_word = pa.ListArray.from_arrays(first, pa.array(ids, pa.int32())).take(coded.indices)
        of_text = pa.ListArray.from_arrays(pa.array(upto[offsets].astype(np.int32)), per_word.flatten())
        return of_text, pc.binary_join(pa.ListArray.from_arrays(words.offsets, decoded.take(coded.indices)), " ")


#: The tokenizer that this worker last made, by the length and hash of its file.
_ready: dict[tuple[int, int], WordBPE] = {}


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes each."""
    group = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs (without the text unless keep_text) with ids array<int> and decoded string, the text that the ids decode to."""
    with open(path or default_path(), "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded") and (keep_text or f.name != text_col)]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = len(file.value), hash(file.value)
        if key not in _ready:
            _ready.clear()
            _ready[key] = WordBPE(file.value)
        bpe = _ready[key]
        for batch in batches:
            texts = batch.column(text_col)
            sizes = np.array(pc.fill_null(pc.binary_length(texts), 0), np.int64)
            for a, b in slices(sizes, BATCH_BYTES):
                ids, decoded = bpe.encode_batch(texts.slice(a, b - a))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), ids, decoded], names=[*names, "ids", "decoded"])
        bpe.forget()  # an idle worker holds the tokenizer only
        pa.default_memory_pool().release_unused()

    return bounded_batches(docs.select(*names, *([] if keep_text else [text_col]))).mapInArrow(run, schema)
