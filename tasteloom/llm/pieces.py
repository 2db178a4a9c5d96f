"""SentencePiece encoding and decoding with a public vocabulary, by suffix-array matching.

The distinct segments of a batch of texts are laid end to end and indexed by a suffix array. A binary
search of every vocabulary piece gives the range of its occurrences; the occurrences are edges
(start, length, piece), bucketed by position. The edges are then relaxed in the order that the vocabulary
sets: of two neighbouring edges that join to a third, the one of best score, leftmost first, is taken
until none is left, which is how a byte-pair model of that format encodes.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NONE = np.iinfo(np.int32).max
# Characters of distinct segments indexed at once, and segments remembered by a task.
INDEX_CHARS = 1 << 18
REMEMBERED = 1 << 19
# Characters of texts taken at once: their segments are Python strings.
PORTION_CHARS = 1 << 20
# Longer segments are relaxed with a heap, shorter ones all together.
SHORT = 48


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id; ``order`` ranks them by score, best first. Plain data that tasks can get."""

    pieces: tuple[str, ...]
    order: tuple[int, ...]
    byte_ids: tuple[int, ...]
    usable: tuple[bool, ...]

    @staticmethod
    def load(path: str = MODEL) -> "Vocabulary":
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = tuple(model.id_to_piece(i) for i in range(n))
        by_score = sorted(range(n), key=lambda i: (-model.get_score(i), i))
        order = [0] * n
        for rank, i in enumerate(by_score):
            order[i] = rank
        byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        usable = tuple(
            not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)
        )
        if not all(model.is_byte(i) for i in byte_ids):
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        if any(SPACE in p.lstrip(SPACE) for p, ok in zip(pieces, usable) if ok):
            raise ValueError("a piece spans two words: texts cannot be cut into segments")
        return Vocabulary(pieces, tuple(order), byte_ids, usable)


SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")


def segments(text: str) -> list[str]:
    """A text with spaces as word marks and one more in front, cut before each run of marks.

    A word mark that stands in the text itself counts as a space, as in the public library.
    """
    if SPACE not in text and "  " not in text and text[0] != " ":
        return [SPACE + word for word in text.split(" ")]
    return SEGMENT.findall(SPACE + text.replace(" ", SPACE))


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffix places in order of their first ``depth`` codes, by doubling the compared length."""
    order = np.argsort(codes, kind="stable")
    ranks = np.empty(len(codes), dtype=np.int64)
    sorted_codes = codes[order]
    ranks[order] = np.cumsum(np.r_[0, sorted_codes[1:] != sorted_codes[:-1]])
    compared = 1
    while compared < depth:
        behind = np.zeros(len(codes), dtype=np.int64)
        behind[:-compared] = ranks[compared:] + 1
        keys = ranks * (len(codes) + 1) + behind
        order = np.argsort(keys)
        sorted_keys = keys[order]
        ranks[order] = np.cumsum(np.r_[0, sorted_keys[1:] != sorted_keys[:-1]])
        if ranks[order[-1]] == len(codes) - 1:
            break
        compared *= 2
    return order


class Encoder:
    """Encodes texts; remembers segments seen before, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        own = [i for i, ok in enumerate(vocabulary.usable) if ok]
        own.sort(key=lambda i: vocabulary.pieces[i])
        self.ids = np.array(own, dtype=np.int64)
        self.sizes = np.array([len(vocabulary.pieces[i]) for i in own], dtype=np.int64)
        self.depth = int(self.sizes.max())
        self.codes = np.zeros((len(own), self.depth), dtype=np.int32)
        for n, i in enumerate(own):
            self.codes[n, : self.sizes[n]] = [ord(c) for c in vocabulary.pieces[i]]
        self.order = np.array(vocabulary.order, dtype=np.int32)
        self.by_order = np.argsort(self.order)
        self.forget()

    def matches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, piece numbers) of all occurrences of all pieces."""
        suffixes = suffix_array(codes, self.depth)
        n = len(codes)
        padded = np.r_[codes, np.full(self.depth, -1, dtype=codes.dtype)]
        live = np.arange(len(self.ids))
        low, high = np.zeros(len(live), dtype=np.int64), np.full(len(live), n, dtype=np.int64)
        for d in range(self.depth):
            inner = np.flatnonzero((self.sizes[live] > d))
            want = self.codes[live[inner], d]
            column = padded[suffixes + d] if n < 4 * len(inner) else None

            def bound(lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
                lo, hi = lo.copy(), hi.copy()
                while (open_ := lo < hi).any():
                    mid = (lo + hi) >> 1
                    at = np.minimum(mid, n - 1)
                    seen = column[at] if column is not None else padded[suffixes[at] + d]
                    less = (seen <= want) if after else (seen < want)
                    lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
                return lo

            first = bound(low[inner], high[inner], False)
            last = bound(first, high[inner], True)
            low[inner], high[inner] = first, last
            keep = low < high
            live, low, high = live[keep], low[keep], high[keep]
        counts = high - low
        starts = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts)
        return suffixes[starts + np.arange(counts.sum())], np.repeat(live, counts)

    def learn(self, new: list[str]) -> None:
        """Encode distinct segments and remember them."""
        block: list[str] = []
        size = 0
        for segment in new:
            block.append(segment)
            size += len(segment) + 1
            if size >= INDEX_CHARS:
                self._learn(block)
                block, size = [], 0
        if block:
            self._learn(block)

    def _learn(self, block: list[str]) -> None:
        text = "\n".join(block) + "\n"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<i4").copy()
        sizes = np.array([len(s) for s in block])
        starts = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        codes[starts + sizes] = -2
        places, numbers = self.matches(codes)
        # Edges bucketed by place: the rank of the piece from a place with a length, if any.
        edges = np.full((len(codes), self.depth + 1), NONE, dtype=np.int32)
        edges[places, self.sizes[numbers]] = self.order[self.ids[numbers]]
        chosen = [relax_together(edges, starts, sizes, np.flatnonzero(sizes <= SHORT))]
        for i in np.flatnonzero(sizes > SHORT):
            stop = np.array(relax(edges, int(starts[i]), int(sizes[i])), dtype=np.int64)
            chosen.append((np.full(len(stop), i), np.r_[starts[i], stop[:-1]], stop))
        owner, start, stop = (np.concatenate(x) for x in zip(*chosen))
        by = np.argsort(start)
        owner, start, stop = owner[by], start[by], stop[by]
        rank = edges[start, stop - start]
        covered = rank != NONE
        # A character without a piece becomes one piece per byte.
        raw = [[self.vocabulary.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass")] for i in start[~covered]]
        width = np.ones(len(rank), dtype=np.int64)
        width[~covered] = [len(r) for r in raw]
        ids = np.empty(width.sum(), dtype=np.int32)
        first = np.repeat(covered, width)
        ids[first] = self.by_order[rank[covered]]
        ids[~first] = [i for r in raw for i in r]
        self._remember(block, ids, np.bincount(owner, weights=width, minlength=len(block)).astype(np.int64))

    def _remember(self, segments: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))
        begins = np.r_[0, np.cumsum(sizes)[:-1]] + len(self.flat)
        self.flat = np.concatenate([self.flat, ids])
        self.begins, self.lengths = np.concatenate([self.begins, begins]), np.concatenate([self.lengths, sizes])

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, dtype=np.int32)
        self.begins, self.lengths = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text): null and empty texts have none."""
        cut = [segments(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        self.learn(list({s: None for parts in cut for s in parts if s not in known}))
        counts = np.array([len(parts) for parts in cut], dtype=np.int64)
        where = np.fromiter((known[s] for parts in cut for s in parts), dtype=np.int64, count=counts.sum())
        begins, lengths = self.begins[where], self.lengths[where]
        upto = np.r_[0, np.cumsum(lengths)]
        ids = self.flat[np.repeat(begins - upto[:-1], lengths) + np.arange(upto[-1])]
        ends = upto[np.cumsum(counts)]
        return ids, np.diff(np.r_[0, ends])


def relax_together(
    edges: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, stop) of the pieces of many short segments: one join per segment and round."""
    depth = edges.shape[1] - 1
    owner = np.repeat(which, sizes[which])
    start = np.repeat(starts[which] - np.r_[0, np.cumsum(sizes[which])[:-1]], sizes[which]) + np.arange(len(owner))
    stop = start + 1
    done = [(owner[:0], start[:0], stop[:0])]
    while len(owner):
        new = np.r_[True, owner[1:] != owner[:-1]]
        length = np.r_[stop[1:], 0] - start
        fits = np.r_[~new[1:], False] & (length <= depth)
        rank = np.where(fits, edges[start, np.where(fits, length, 0)], NONE)
        heads = np.flatnonzero(new)
        best = np.minimum.reduceat(rank, heads)
        spread = np.repeat(best, np.diff(np.r_[heads, len(owner)]))
        stay = spread != NONE
        if not stay.all():
            over = ~stay
            done.append((owner[over], start[over], stop[over]))
        # The leftmost pair of best rank per segment.
        hit = np.flatnonzero((rank == spread) & stay)
        if len(hit):
            hit = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]]
            stop[hit] = stop[hit + 1]
            stay[hit + 1] = False
        owner, start, stop = owner[stay], start[stay], stop[stay]
    return tuple(np.concatenate(x) for x in zip(*done))


def relax(edges: np.ndarray, start: int, size: int) -> list[int]:
    """Ends of the pieces of one segment, by an agenda of the best joins."""
    depth = edges.shape[1] - 1
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    stop = list(range(1, size + 1))
    alive = [True] * size
    agenda: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < size and (length := stop[right] - left) <= depth:
            rank = edges[start + left, length]
            if rank != NONE:
                heapq.heappush(agenda, (int(rank), left, stop[right]))

    for i in range(size):
        offer(i)
    while agenda:
        _, left, end = heapq.heappop(agenda)
        if not alive[left] or (right := after[left]) >= size or stop[right] != end:
            continue
        alive[right] = False
        stop[left], after[left] = end, after[right]
        if after[right] < size:
            before[after[right]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [start + stop[i] for i in range(size) if alive[i]]


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.bytes = [p.replace(SPACE, " ").encode("utf-8") if ok else b"" for p, ok in zip(vocabulary.pieces, vocabulary.usable)]
        for value, i in enumerate(vocabulary.byte_ids):
            self.bytes[i] = bytes([value])

    def decode(self, ids) -> str | None:
        """The text of the ids; the word mark in front of a text goes."""
        if ids is None:
            return None
        joined = b"".join(map(self.bytes.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids))
        return joined.decode("utf-8", "surrogatepass").removeprefix(" ")


def portions(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose rows, of the given sizes, add up to about PORTION_CHARS."""
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= PORTION_CHARS or i + 1 == len(sizes):
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0


def with_ids(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "ids", check: str | None = None
) -> DataFrame:
    """``docs`` with the piece ids of each whole text; null for null, an empty array for empty texts.

    The ids are those of the public library for the same model. Characters outside the
    vocabulary are written as byte pieces, so that decoding gives back every text, but for the
    format's own word mark (U+2581), which comes back as a space. Columns called ``name`` are replaced. One pass without a shuffle.

    ``check`` names a boolean column: whether decoding the ids gives back the text.
    """
    kept = docs.select(*[c for c in docs.columns if c not in (name, check)])
    added = [T.StructField(name, T.ArrayType(T.IntegerType()))] + ([T.StructField(check, T.BooleanType())] if check else [])
    schema = T.StructType([*kept.schema.fields, *added])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for whole in batches:
            column = whole.column(whole.schema.get_field_index(text))
            for batch in portions(whole, pc.fill_null(pc.utf8_length(column), 0).to_pylist()):
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                flat, sizes = encoder.encode(texts)
                absent = np.array([t is None for t in texts] + [False])
                ends = np.r_[0, np.cumsum(sizes)]
                offsets = pa.array(ends.astype(np.int32), mask=absent)
                out = [pa.ListArray.from_arrays(offsets, pa.array(flat, type=pa.int32()))]
                if check:
                    pairs = zip(texts, ends[:-1].tolist(), ends[1:].tolist())
                    out.append(pa.array([t is None or decoder.decode(flat[a:b]) == t for t, a, b in pairs], type=pa.bool_()))
                yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *schema.names[-len(out):]])

    return kept.mapInArrow(encode, schema)


def with_text(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null for null."""
    kept = encoded.select(*[c for c in encoded.columns if c != name])
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for whole in batches:
            column = whole.column(whole.schema.get_field_index(ids))
            for batch in portions(whole, pc.fill_null(pc.list_value_length(column), 0).to_pylist()):
                rows = batch.column(batch.schema.get_field_index(ids))
                texts = [decoder.decode(row.values.to_numpy() if row.is_valid else None) for row in rows]
                names = [*batch.schema.names, name]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=names)

    return kept.mapInArrow(decode, schema)
