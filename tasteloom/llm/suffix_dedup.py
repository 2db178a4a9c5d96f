"""Byte strings that repeat across documents, from suffix arrays built column by column.

Every document is cut into pieces: stretches of windows of ``size`` bytes that share the smallest hash of
the ``ANCHOR``-byte strings within the window. Equal windows have equal anchors, so each meets its like
in the bucket of its anchor, and a piece has a bounded length, which bounds the rounds below.

Within a bucket, the pieces that share an anchor with a piece of another document form a
collection. Its Burrows-Wheeler transform and common prefixes are built from the last column to
the first: each round inserts one symbol per piece, with one sequential reading of the external files
to place the new suffixes and one to write them in. Windows equal in ``size`` bytes are neighbours in
the result.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 50
ANCHOR, INNER = 16, 4
# Text bytes cut at once, text bytes whose pieces go to one bucket, and text bytes applied at once.
CUT_BYTES = 6 << 20
BUCKET_BYTES = 6 << 20
APPLY_BYTES = 16 << 20
# Cells that count the places of ANCHOR-byte strings by hash (a power of two), and how many places a cell holds
# at least before its strings are crowded, beside CROWD times the mean of all cells.
CELLS, CROWD, CROWD_LEAST = 1 << 20, 6, 1 << 12
# Ranges of places of an anchor within its window.
PLACES = 6
# Pieces per collection (an anchor is never divided), rows of the external files read at once.
COLLECTION = 1 << 12
ROWS = 1 << 22
# Bytes hashed at once: hashes take eight bytes each, and a step's arrays fit a core's cache.
STEP = 1 << 15
LEVEL, TEXT_LEVEL = 5, 3
END = 255  # no byte of UTF-8
BASE = 0x9E3779B97F4A7C15

U64 = np.uint64
# Packed spans: steps between documents, their checksums, spans of each, then starts and lengths.
SPAN_KINDS = np.int64, np.uint32, np.uint32, np.uint32, np.uint32
NO_SPANS = pd.DataFrame({"doc": [], "crc": [], "start": [], "stop": []}).astype("int64")


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(31))
    h *= U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(29))


def anchor_hashes(data: np.ndarray, crowded: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ANCHOR bytes from each place, by joining halves; ANCHOR and INNER are powers of two.

    Strings whose least INNER-byte string stands at an end have lower hashes than the others: they lie
    further apart, which makes pieces longer. Strings in ``crowded`` cells (a flag each) have the highest
    hashes, so they anchor only windows that hold no other string.
    """
    places = max(0, len(data) - ANCHOR + 1)
    short, h = joined_hashes(data)
    if places:
        inner = _mix(short)
        least, far = _least(inner, ANCHOR - INNER + 1), ANCHOR - INNER
        ends = (least == inner[:places]) | (least == inner[far : far + places])
        h |= (~ends).astype(U64) << U64(62)
        if crowded is not None:
            h |= crowded[cells_of(h)].astype(U64) << U64(63)
    return h


def joined_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of INNER bytes, hashes of ANCHOR bytes below 2**62) from each place."""
    h, factor, width = data.astype(U64) + U64(1), U64(BASE), 1
    with np.errstate(over="ignore"):
        while width < ANCHOR:
            h = h[:-width] * factor + h[width:]
            factor, width = factor * factor, width * 2
            if width == INNER:
                short = h
    return short, _mix(h) >> U64(2)


def cells_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & U64(CELLS - 1)).astype(np.int32)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        values, have = np.minimum(values[:-have], values[have:]), have * 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _stretches(starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[slice, int, int]]:
    """Stretches with rising starts, in groups that span about STEP bytes: (which, first byte, end)."""
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + STEP)))
        yield slice(i, j), int(starts[i]), int(stops[i:j].max())
        i = j


def content_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each stretch (rising starts), from sums of bytes times powers of an odd number."""
    out = np.zeros(len(starts), dtype=U64)
    powers = back = np.ones(1, dtype=U64)
    inverse = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        for which, a, b in _stretches(starts, stops):
            if len(powers) < b - a:
                more = 2 * max(STEP, b - a)
                powers = np.multiply.accumulate(np.r_[U64(1), np.full(more, BASE, dtype=U64)])
                back = np.multiply.accumulate(np.r_[U64(1), np.full(more, inverse, dtype=U64)])
            sums = np.r_[U64(0), np.cumsum((data[a:b].astype(U64) + U64(1)) * powers[: b - a])]
            out[which] = _mix((sums[stops[which] - a] - sums[starts[which] - a]) * back[starts[which] - a])
    return out


def anchors_and_matches(
    data: np.ndarray, starts: np.ndarray, stops: np.ndarray, docs: np.ndarray, size: int, crowded: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Per piece (rising starts) its anchor, the least hash within it, and whether it could share a window
    with a piece of another document.

    The anchor's place within a common window falls into one of PLACES ranges. What the windows of a
    range have in common around the anchor must be common, too; it is known by the hashes of the
    ANCHOR-byte strings that cover it.
    """
    rest = size - ANCHOR
    grid = [rest * i // PLACES for i in range(PLACES + 1)]
    around = [np.append(np.arange(-left, rest - far, ANCHOR), rest - far) for left, far in zip(grid, grid[1:])]
    anchors = np.zeros(len(starts), dtype=U64)
    keys, owners = [np.empty(0, dtype=U64)], [np.empty(0, dtype=np.int64)]
    for which, a, b in _stretches(starts, stops):
        hashes = np.r_[anchor_hashes(data[a:b], crowded), np.zeros(ANCHOR, dtype=U64)]
        first, end = starts[which] - a, stops[which] - a - ANCHOR + 1
        edges = np.empty(2 * len(first), dtype=np.int64)
        edges[0::2], edges[1::2] = first, end
        anchors[which] = np.minimum.reduceat(hashes, edges)[::2]
        owner = np.repeat(np.arange(len(first)), end - first)
        place = _ranges(first, end)
        hit = np.flatnonzero(hashes[place] == anchors[which][owner])
        owner, place = owner[hit], place[hit]
        for number, offsets in enumerate(around):
            inside = (place + offsets.min() >= first[owner]) & (place + offsets.max() < end[owner])
            at, key = place[inside], np.full(int(inside.sum()), number, dtype=U64)
            with np.errstate(over="ignore"):
                for offset in offsets.tolist():
                    key = _mix(key * U64(BASE) + hashes[at + offset])
            keys.append(key)
            owners.append(owner[inside] + which.start)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    possible = np.zeros(len(starts), dtype=bool)
    if len(key):
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        shared = np.minimum.reduceat(docs[owner], head) != np.maximum.reduceat(docs[owner], head)
        possible[owner[np.repeat(shared, np.diff(np.r_[head, len(key)]))]] = True
    return anchors, possible


def cut_pieces(
    data: np.ndarray, bounds: np.ndarray, size: int = SIZE, crowded: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, anchors) of the pieces of texts laid end to end; ``bounds``: text starts and the end.

    Every window of ``size`` bytes within a text lies in exactly one piece.
    """
    found = []
    for a in range(0, len(data), STEP):
        part = data[a : a + STEP + size - 1]
        # The texts that reach into the part, cut off at its ends.
        i, j = np.searchsorted(bounds, a, side="right") - 1, np.searchsorted(bounds, a + len(part))
        starts, stops, anchors = _cut_part(part, np.clip(bounds[i : j + 1] - a, 0, len(part)), size, crowded)
        found.append((starts + a, stops + a, anchors))
    none = np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none, none.astype(U64))


def _cut_part(data: np.ndarray, bounds: np.ndarray, size: int, crowded: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = np.empty(0, dtype=np.int64)
    if len(data) < size:
        return none, none, none.astype(U64)
    width = size - ANCHOR + 1
    least = _least(anchor_hashes(data, crowded), width)
    # Windows that start within size - 1 bytes before a text's end cross it.
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edge, np.maximum(bounds[1:] - (size - 1), bounds[:-1]), 1)
    np.add.at(edge, bounds[1:], -1)
    whole = np.cumsum(edge)[: len(least)] == 0
    new = whole & np.r_[True, (least[1:] != least[:-1]) | ~whole[:-1]]
    # A text start begins a piece even where the windows before it are whole.
    at = bounds[:-1][(bounds[:-1] < len(least))]
    new[at] |= whole[at]
    starts = np.flatnonzero(new)
    if not len(starts):
        return none, none, none.astype(U64)
    upto = np.cumsum(whole)
    counts = np.diff(np.r_[upto[starts] - 1, upto[-1]])
    # Runs of one repeated anchor can be long: cut to the usual greatest length.
    parts = -(-counts // width)
    offset = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * width
    starts, counts = np.repeat(starts, parts) + offset, np.repeat(counts, parts) - offset
    return starts, starts + np.minimum(counts, width) + size - 1, least[starts]


def rows_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, width: int) -> np.ndarray:
    """One row per stretch, filled up with zeros."""
    padded = np.concatenate([data, np.zeros(width, dtype=np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    out[np.arange(width) >= (stops - starts)[:, None]] = 0
    return out


def equal_groups(hashes: np.ndarray, docs: np.ndarray, data: np.ndarray, starts, stops) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): stretches sorted so that equal ones are together, smallest document first.

    Hashes bring candidates together; stretches that differ from the first of their group are put
    into groups of their own content.
    """
    order = np.argsort(hashes)
    h = hashes[order]
    same = h[1:] == h[:-1]
    at = np.flatnonzero(np.r_[False, same] | np.r_[same, False][: len(h)])
    twins = order[at]
    order[at] = twins[np.lexsort((docs[twins], (stops - starts)[twins], hashes[twins]))]
    n = (stops - starts)[order]
    head = np.r_[True, (h[1:] != h[:-1]) | (n[1:] != n[:-1])]
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = np.flatnonzero(~head)
    odd = set()
    for part in np.array_split(again, max(1, len(again) >> 17)):
        if not len(part):
            continue
        width = int(n[part].max())
        a, b = order[part], order[first[part]]
        same = (rows_of(data, starts[a], stops[a], width) == rows_of(data, starts[b], stops[b], width)).all(axis=1)
        odd.update(first[part[~same]].tolist())
    if odd:
        ends = np.r_[np.flatnonzero(head)[1:], len(order)]
        end_of = dict(zip(np.flatnonzero(head).tolist(), ends.tolist()))
        for begin in odd:
            part = order[begin : end_of[begin]]
            part = np.array(sorted(part, key=lambda i: (data[starts[i] : stops[i]].tobytes(), docs[i])))
            order[begin : end_of[begin]] = part
            texts = [data[starts[i] : stops[i]].tobytes() for i in part]
            head[begin : end_of[begin]] = [True] + [x != y for x, y in zip(texts, texts[1:])]
    return order, np.flatnonzero(head)


class ExternalColumns:
    """The growing transform of a collection in files: symbol before, common prefix, piece and length.

    One row per suffix inserted so far, in sorted order. Memory holds a block of rows and a few numbers
    per piece.
    """

    FIELDS = {"symbol": np.uint8, "prefix": np.uint8, "piece": np.int32, "length": np.uint8}

    def __init__(self, folder: str, pieces: int, lengths: type = np.uint8):
        self.FIELDS = self.FIELDS | {"length": lengths}
        self.pieces, self.rows, self.version = pieces, pieces, 0
        self.files = {
            name: [open(os.path.join(folder, f"{name}-{v}"), "w+b", buffering=0) for v in (0, 1)] for name in self.FIELDS
        }
        start = {
            "symbol": np.full(pieces, END), "prefix": np.zeros(pieces), "piece": np.arange(pieces), "length": np.zeros(pieces)
        }
        for name, values in start.items():
            self.files[name][0].write(values.astype(self.FIELDS[name]))

    def close(self) -> None:
        for pair in self.files.values():
            for file in pair:
                file.close()

    def _read(self, name: str, at: int) -> np.ndarray:
        file, kind = self.files[name][self.version], np.dtype(self.FIELDS[name])
        out = np.empty(min(ROWS, self.rows - at), dtype=kind)
        file.seek(at * kind.itemsize)
        if file.readinto(out) != out.nbytes:
            raise OSError(f"{file.name} is shorter than what was written")
        return out

    def insert(self, at: np.ndarray, symbols: np.ndarray, piece: np.ndarray, length: int) -> np.ndarray:
        """Put symbol i before the suffix in row ``at[i]`` (ascending) and insert the longer suffix.

        Returns the rows of the new suffixes. A suffix c·T stands behind as many suffixes with c in front
        as there are c's above the row of T; it shares with its neighbours there one byte more than the
        suffixes behind them do, which is the least common prefix on the way.
        """
        count, low = np.zeros(256, dtype=np.int64), np.full(256, 255, dtype=np.int64)
        seen, pending = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
        found = []
        for a in range(0, self.rows, ROWS):
            symbol, prefix = self._read("symbol", a), self._read("prefix", a)
            i, j = np.searchsorted(at, [a, a + len(symbol)])
            symbol[at[i:j] - a] = symbols[i:j]
            order = np.argsort(symbol, kind="stable")
            counts = np.bincount(symbol, minlength=256)
            first = np.cumsum(counts) - counts
            longer = np.zeros(len(order), dtype=bool)
            longer[at[i:j] - a] = True
            new = np.flatnonzero(longer[order])
            who = np.searchsorted(at, order[new] + a)
            # New suffixes, and the ones after them, whose common prefix with the one above changes.
            touched = np.zeros(len(order), dtype=bool)
            touched[new] = True
            after = new + 1
            touched[after[after < (first + counts)[symbols[who]]]] = True
            touched[first[np.flatnonzero(pending[:END] & (counts[:END] > 0))]] = True
            k = np.flatnonzero(touched)
            if len(k):
                owner = np.full(len(k), -1, dtype=np.int64)
                owner[np.searchsorted(k, new)] = who
                c, stop = symbol[order[k]], order[k] + 1
                lead = k == first[c]
                start = np.where(lead, 0, order[np.maximum(k - 1, 0)] + 1)
                cuts = np.empty(2 * len(k), dtype=np.int64)
                cuts[0::2], cuts[1::2] = start, stop
                least = np.minimum.reduceat(np.append(prefix, np.uint8(255)), cuts)[::2].astype(np.int64)
                shared = 1 + np.where(lead, np.minimum(least, low[c]), least)
                shared[lead & ~seen[c]] = 0
                found.append((c, count[c] + k - first[c], np.minimum(shared, 254), owner))
            count += counts
            if a + ROWS >= self.rows:
                break
            # What the rows of the next block have to know of the ones above.
            tail = np.r_[np.minimum.accumulate(prefix[::-1])[::-1], np.uint8(255)]
            have = np.flatnonzero(counts)
            last = order[first[have] + counts[have] - 1]
            low = np.minimum(low, tail[0])
            low[have] = tail[last + 1]
            pending[have] = longer[last]
            seen[have] = True
        before = self.pieces + np.cumsum(count) - count
        c, rank, shared, owner = (np.concatenate(x) for x in zip(*found))
        row = before[c] + rank
        is_new = owner >= 0
        by = np.argsort(row[is_new])
        new_row, new_shared, who = row[is_new][by], shared[is_new][by], owner[is_new][by]
        old = row[~is_new] - np.searchsorted(new_row, row[~is_new])
        by = np.argsort(old)
        self._merge(at, symbols, old[by], shared[~is_new][by], new_row, new_shared, piece[who], length)
        out = np.empty(len(at), dtype=np.int64)
        out[who] = new_row
        return out

    def _merge(self, at, symbols, old, old_shared, new_row, new_shared, who, length) -> None:
        """Write the next version of the files: old rows with their changes, new rows in between."""
        behind = new_row - np.arange(len(new_row))
        total = self.rows + len(new_row)
        added = {"symbol": np.full(len(who), END), "prefix": new_shared, "piece": who, "length": np.full(len(who), length)}
        files = {name: pair[1 - self.version] for name, pair in self.files.items()}
        for file in files.values():
            file.seek(0)
        for a in range(0, self.rows, ROWS):
            b = min(a + ROWS, self.rows)
            i, j = np.searchsorted(behind, a), len(behind) if b == self.rows else np.searchsorted(behind, b)
            places = behind[i:j] - a + np.arange(j - i)
            stay = np.ones(b - a + j - i, dtype=bool)
            stay[places] = False
            for name, file in files.items():
                values = self._read(name, a)
                if name == "symbol":
                    x, y = np.searchsorted(at, [a, b])
                    values[at[x:y] - a] = symbols[x:y]
                elif name == "prefix":
                    x, y = np.searchsorted(old, [a, b])
                    values[old[x:y] - a] = old_shared[x:y]
                out = np.empty(len(stay), dtype=self.FIELDS[name])
                out[stay], out[places] = values, added[name][i:j]
                file.write(out)
        self.rows, self.version = total, 1 - self.version

    def clusters(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(heads, piece, length) of rows, in runs that share ``size`` bytes; a run is never divided."""
        rest = [np.empty(0, dtype=self.FIELDS[n]) for n in ("prefix", "piece", "length")]
        for a in range(0, self.rows, ROWS):
            block = [np.concatenate([r, self._read(n, a)]) for r, n in zip(rest, ("prefix", "piece", "length"))]
            heads = np.flatnonzero(block[0] < size)
            end = len(block[0]) if a + ROWS >= self.rows else (heads[-1] if len(heads) else 0)
            rest = [x[end:] for x in block]
            heads = heads[heads < end]
            if len(heads):
                yield heads, block[1][:end], block[2][:end]


def covered_windows(rows: np.ndarray, lengths: np.ndarray, docs: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of each window that also starts in a piece of a smaller document."""
    pieces, offsets = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    with tempfile.TemporaryDirectory() as folder:
        files = ExternalColumns(folder, len(rows), length_kind(size))
        at, who = np.arange(len(rows)), np.arange(len(rows))
        for length in range(1, int(lengths.max()) + 1):
            live = lengths[who] >= length
            who, at = who[live], at[live]
            by = np.argsort(at)
            who, at = who[by], at[by]
            at = files.insert(at, rows[who, lengths[who] - length], who, length)
        for heads, piece, length in files.clusters(size):
            own = np.where(length >= size, docs[piece], np.iinfo(np.int64).max)
            least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.r_[heads, len(own)]))
            hit = np.flatnonzero((length >= size) & (own > least))
            pieces.append(piece[hit].astype(np.int64))
            offsets.append(lengths[piece[hit]].astype(np.int64) - length[hit])
        files.close()
    return np.concatenate(pieces), np.concatenate(offsets)


def _pack(*arrays: np.ndarray, level: int = LEVEL) -> bytes:
    """Arrays as one compressed blob: their lengths, then their bytes."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, dtype=np.int64, count=len(kinds) + 1)[1:]
    out, at = [], 8 * (len(kinds) + 1)
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, dtype=kind, count=size, offset=at))
        at += size * np.dtype(kind).itemsize
    return out


def length_kind(size: int) -> type:
    """Type that holds the length of a piece, at most 2 * size - ANCHOR."""
    return np.uint8 if 2 * size - ANCHOR <= 255 else np.uint16


def piece_kinds(size: int) -> tuple[type, ...]:
    return np.int64, np.uint32, np.uint16, length_kind(size), np.uint32, np.uint8


def _gather(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The bytes of stretches, one after the other."""
    view = memoryview(data)
    return np.frombuffer(b"".join([view[a:b] for a, b in zip(starts.tolist(), stops.tolist())]), dtype=np.uint8)


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of each document joined; sorted by document and place."""
    if not len(doc):
        return doc, start, stop
    by = np.lexsort((start, doc))
    doc, start, stop = doc[by], start[by], stop[by]
    # The furthest end so far within a document, by lifting each document above the one before.
    number = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    lift = number * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift) - lift
    head = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])]
    last = np.r_[np.flatnonzero(head)[1:] - 1, len(doc) - 1]
    return doc[head], start[head], reach[last]


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, whether there is an id, bytes of the texts, bounds in them) in portions of about CUT_BYTES.

    The bytes are those of the batch, without a copy.
    """
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        _, offsets, body = column.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(body or b"", dtype=np.uint8)
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column(0).fill_null(0).to_numpy()
        i = 0
        while i < len(ids):
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + CUT_BYTES, side="right")) - 1)
            yield ids[i:j], known[i:j], data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
            i = j


def _checksums(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    view, cuts = memoryview(data), bounds.tolist()
    return np.array([zlib.crc32(view[a:b]) for a, b in zip(cuts, cuts[1:])], dtype=np.uint32)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells with more than twice the places of a task's mean; what the others hold adds up to little."""
    places = np.zeros(CELLS, dtype=np.int64)
    for _, _, data, _ in _portions(batches):
        for begin in range(0, len(data), CUT_BYTES):
            steps = range(begin, min(begin + CUT_BYTES, len(data)), STEP)
            found = [cells_of(joined_hashes(data[a : min(a + STEP, begin + CUT_BYTES) + ANCHOR - 1])[1]) for a in steps]
            places += np.bincount(np.concatenate(found), minlength=CELLS)
    cell = np.flatnonzero(places > 2 * places.mean() + CROWD_LEAST // 256)
    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(places[cell], pa.int64())], names=["cell", "places"])


def crowded_cells(own: DataFrame, total: int) -> np.ndarray | None:
    """Packed flags of the cells whose strings stand in very many places of all texts, or None.

    Pieces that share an anchor meet in one task. A passage in a third of all documents gives each of them
    pieces of its own at the passage's ends, where neighbours vary. If the strings of such passages anchor
    nothing but windows within them, these pieces are dealt by their neighbours, and the ones
    within are equal and merged early. The flags deal pieces only; no result depends on them.
    """
    least = max(CROWD_LEAST, CROWD * total // CELLS)
    counted = own.mapInArrow(_count_task, "cell int, places long").groupBy("cell").agg(F.sum("places").alias("places"))
    # At most a CROWD-th of the cells.
    cells = [r["cell"] for r in counted.where(F.col("places") > least).select("cell").collect()]
    if not cells:
        return None
    flags = np.zeros(CELLS, dtype=bool)
    flags[cells] = True
    return np.packbits(flags)


def _flags(packed: np.ndarray | None) -> np.ndarray | None:
    return None if packed is None else np.unpackbits(packed).astype(bool)


def _cut_task(buckets: int, size: int, packed: np.ndarray | None = None):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = _flags(packed)
        for doc, _, data, bounds in _portions(batches):
            crc = _checksums(data, bounds)
            starts, stops, anchors = cut_pieces(data, bounds, size, crowded)
            if not len(starts):
                continue
            text = np.searchsorted(bounds, starts, side="right") - 1
            by, heads = equal_groups(content_hashes(data, starts, stops), doc[text], data, starts, stops)
            # The smallest document of a portion decides for the others in it.
            first = np.repeat(doc[text[by[heads]]], np.diff(np.r_[heads, len(by)]))
            later = doc[text[by]] > first
            gone, sent = by[later], by[~later]
            rows: list[tuple[int, bytes, bool]] = []
            if len(gone):
                t, a, b = merged(text[gone], starts[gone] - bounds[text[gone]], stops[gone] - bounds[text[gone]])
                rows.append((int(doc[t[0]] % buckets), _pack(doc[t], crc[t], a.astype(np.int64), b.astype(np.int64)), True))
            bucket = (anchors[sent] % U64(buckets)).astype(np.int64)
            sort = np.lexsort((sent, bucket))
            sent, bucket = sent[sort], bucket[sort]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(sent)].tolist()):
                for i in range(a, b, 1 << 16):  # numbers of texts in a blob are 16 bits wide
                    part = sent[i : min(i + (1 << 16), b)]
                    new = np.r_[True, text[part][1:] != text[part][:-1]]
                    used, local = text[part][new], np.cumsum(new) - 1
                    lengths = stops[part] - starts[part]
                    blob = _pack(
                        np.diff(doc[used], prepend=0), crc[used], local.astype(np.uint16), lengths.astype(length_kind(size)),
                        (starts[part] - bounds[text[part]]).astype(np.uint32), _gather(data, starts[part], stops[part]),
                    )
                    rows.append((int(bucket[a]), blob, False))
            yield pa.RecordBatch.from_pylist(
                [{"bucket": k, "blob": blob, "settled": done} for k, blob, done in rows],
                schema=pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("settled", pa.bool_())]),
            )

    return cut


def _frame(doc, crc, start, stop) -> pd.DataFrame:
    return pd.DataFrame({"doc": doc.astype(np.int64), "crc": crc.astype(np.int64), "start": start.astype(np.int64), "stop": stop.astype(np.int64)})


def bucket_spans(blobs: list[bytes], size: int, crowded: np.ndarray | None = None) -> pd.DataFrame:
    """Spans (doc, crc, start, stop) covered by smaller documents, among the pieces of one bucket."""
    docs, crcs, lengths, places, bodies = [], [], [], [], []
    for blob in blobs:
        steps, crc, local, length, place, body = _unpack(blob, *piece_kinds(size))
        docs.append(np.cumsum(steps)[local])
        crcs.append(crc[local])
        lengths.append(length.astype(np.int64))
        places.append(place.astype(np.int64))
        bodies.append(body)
    doc, crc, length, place = (np.concatenate(x) for x in (docs, crcs, lengths, places))
    data = np.concatenate(bodies)
    del bodies
    stops = np.cumsum(length)
    starts = stops - length
    by, heads = equal_groups(content_hashes(data, starts, stops), doc, data, starts, stops)
    sizes = np.diff(np.r_[heads, len(by)])
    group = np.repeat(np.arange(len(heads)), sizes)
    sample = by[heads]
    later = doc[by] > doc[sample][group]
    spans = [_frame(doc[by[later]], crc[by[later]], place[by[later]], (place + length)[by[later]])]
    rising = np.argsort(starts[sample])
    own = sample[rising]
    anchor, possible = np.empty(len(sample), dtype=U64), np.empty(len(sample), dtype=bool)
    anchor[rising], possible[rising] = anchors_and_matches(data, starts[own], stops[own], doc[own], size, crowded)
    sort = np.flatnonzero(possible)
    if not len(sort):
        return pd.concat(spans, ignore_index=True)
    sort = sort[np.lexsort((doc[sample[sort]], anchor[sort]))]
    head = np.r_[True, anchor[sort][1:] != anchor[sort][:-1]]
    first = np.flatnonzero(head)
    end = np.r_[first[1:], len(sort)]
    # Only anchors met in two documents can have something in common.
    several = doc[sample[sort[first]]] != doc[sample[sort[end - 1]]]
    first, end = first[several], end[several]
    eldest = by[~later]
    eldest_group = group[~later]
    i = 0
    while i < len(first):
        j, count = i, 0
        while j < len(first) and (j == i or count + end[j] - first[j] <= COLLECTION):
            count += end[j] - first[j]
            j += 1
        chosen = sort[_ranges(first[i:j], end[i:j])]
        i = j
        own = sample[chosen]
        rows = rows_of(data, starts[own], stops[own], int(length[own].max()))
        piece, offset = covered_windows(rows, length[own], doc[own], size)
        if not len(piece):
            continue
        piece, a, b = merged(chosen[piece], offset, offset + size)
        # Every occurrence in the smallest document of a piece has the same spans.
        low = np.searchsorted(eldest_group, piece)
        n = np.searchsorted(eldest_group, piece, side="right") - low
        where = eldest[_ranges(low, low + n)]
        spans.append(_frame(doc[where], crc[where], place[where] + np.repeat(a, n), place[where] + np.repeat(b, n)))
    return pd.concat(spans, ignore_index=True)


def _ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    sizes = stops - starts
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _portion(doc: np.ndarray, crc: np.ndarray, portions: int) -> np.ndarray:
    mixed = _mix(doc.astype(U64) ^ (crc.astype(U64) << U64(32)))
    return (mixed % U64(portions)).astype(np.int32)


def _bucket_task(size: int, portions: int, packed: np.ndarray | None):
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        spans = [NO_SPANS]
        for blob in rows.loc[rows["settled"], "blob"]:
            spans.append(_frame(*_unpack(blob, np.int64, np.uint32, np.int64, np.int64)))
        blobs = list(rows.loc[~rows["settled"], "blob"])
        if blobs:
            spans.append(bucket_spans(blobs, size, _flags(packed)))
        doc, crc, start, stop = pd.concat(spans, ignore_index=True).to_numpy(dtype=np.int64).T
        portion = _portion(doc, crc, portions)
        order = np.lexsort((start, crc, doc, portion))
        cuts = np.flatnonzero(np.diff(portion[order], prepend=-1))
        out = []
        for part in np.split(order, cuts[1:]) if len(order) else []:
            d, c = doc[part], crc[part]
            head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (c[1:] != c[:-1])])
            counts = np.diff(np.r_[head, len(part)])
            arrays = np.diff(d[head], prepend=0), c[head], counts, start[part], (stop - start)[part]
            out.append((int(portion[part[0]]), _pack(*(a.astype(kind) for a, kind in zip(arrays, SPAN_KINDS)))))
        return pd.DataFrame(out, columns=["portion", "blob"])

    return solve


def _spans_of(blobs: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, crc, start, stop) of the spans that bucket tasks packed."""
    found = [NO_SPANS]
    for blob in blobs:
        steps, crc, counts, start, length = _unpack(blob, *SPAN_KINDS)
        found.append(_frame(np.repeat(np.cumsum(steps), counts), np.repeat(crc, counts), start, start.astype(np.int64) + length))
    return tuple(pd.concat(found, ignore_index=True).to_numpy(dtype=np.int64).T)


def _text_task(portions: int):
    """Texts in compressed portions, by the hash of their document."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, known, data, bounds in _portions(batches):
            crc = _checksums(data, bounds).astype(np.int64)
            view = memoryview(data)
            portion = _portion(doc, crc, portions)
            rows = []
            for k in np.unique(portion):
                own = np.flatnonzero(portion == k)
                sizes = bounds[own + 1] - bounds[own]
                body = np.frombuffer(b"".join([view[bounds[i] : bounds[i + 1]] for i in own]), dtype=np.uint8)
                rows.append({"portion": int(k), "blob": _pack(doc[own], known[own].astype(np.uint8), crc[own], sizes, body, level=TEXT_LEVEL)})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("portion", pa.int32()), ("blob", pa.binary())]))

    return pack


RESULT = "key long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept_sha256 string, kept binary"


def _apply_task(keep: bool):
    def apply(spans: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        doc, crc, start, stop = _spans_of(spans["blob"])
        keys, number = np.unique(np.stack([doc, crc], axis=1), axis=0, return_inverse=True) if len(doc) else (np.empty((0, 2)), doc)
        number, start, stop = merged(number.reshape(-1).astype(np.int64), start, stop)
        place = {(int(d), int(c)): i for i, (d, c) in enumerate(keys.tolist())}
        low = np.searchsorted(number, np.arange(len(keys) + 1))
        out = []
        for blob in texts["blob"]:
            ids, known, crcs, sizes, body = _unpack(blob, np.int64, np.uint8, np.int64, np.int64, np.uint8)
            raw, at = body.tobytes(), 0
            for i, k, c, size in zip(ids.tolist(), known.tolist(), crcs.tolist(), sizes.tolist()):
                text = raw[at : at + size]
                at += size
                n = place.get((i, c)) if k else None
                pairs = [] if n is None else list(zip(start[low[n] : low[n + 1]].tolist(), stop[low[n] : low[n + 1]].tolist()))
                kept, end = [], 0
                for a, b in pairs:
                    kept.append(text[end:a])
                    end = b
                kept.append(text[end:])
                left = b"".join(kept)
                out.append((
                    i if k else None, size, size - len(left), [{"start": a, "stop": b} for a, b in pairs],
                    hashlib.sha256(left).hexdigest(), left if keep else None,
                ))
        frame = pd.DataFrame(out, columns=["key", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])
        frame["key"] = frame["key"].astype("Int64")
        return frame

    return apply


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, keep: bool = False,
) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept_sha256, kept): bytes covered by earlier documents, per row.

    A byte goes if a string of ``size`` bytes that covers it also starts in a document with a smaller key.
    Texts count whole, as UTF-8 bytes; spans are maximal, ends exclusive; ``kept`` holds the bytes
    left if ``keep``, else null. Null texts count as empty. Rows without a key are neither smaller nor
    larger than others and stay whole. Rows of one key are one document; of these, rows are told
    apart by the checksum of their text. Other columns are dropped; an empty table gives no rows.
    """
    if not ANCHOR <= size <= 200:
        raise ValueError("windows of 16 to 200 bytes are served")
    own = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets, portions = total // BUCKET_BYTES + 1, total // APPLY_BYTES + 1
    known = own.where("key is not null")
    crowded = crowded_cells(known, total)
    pieces = known.mapInArrow(_cut_task(buckets, size, crowded), "bucket int, blob binary, settled boolean")
    placed = pieces.groupBy("bucket").applyInPandas(
        _bucket_task(size, portions, crowded), "portion int, blob binary"
    )
    texts = own.mapInArrow(_text_task(portions), "portion int, blob binary")
    return placed.groupBy("portion").cogroup(texts.groupBy("portion")).applyInPandas(_apply_task(keep), RESULT)
