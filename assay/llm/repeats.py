"""Substring dedup: fixed-block anchors, extended to maximal exact repeats."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import arrow_schema, identified, map_batches, space_words, text_bytes, values

#: Words of the shortest repeat that counts.
WINDOW = 13
#: Words of a reference block: 13 words in a row hold a whole block of 7, wherever blocks begin.
BLOCK = 7
#: Text bytes whose windows meet in one cell, and whose rows are one group, about: cells and
#: groups grow with the input.
BYTES_A_CELL = 16 << 20
BYTES_A_GROUP = 4 << 20
#: Windows of a batch that are dealt out together, to bound a task's memory.
WINDOWS_AT_ONCE = 2_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD1B54A32D192ED03)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    digest = xxhash.xxh64_intdigest
    known: dict[bytes, int] = {}
    for w in set(words):
        known[w] = digest(w)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, length: int, multiplier: np.uint64 = _MIX) -> np.ndarray:
    """A hash of each run of `length` words: a polynomial of the words' hashes, then mixed."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        total = total * multiplier + hashes[i : i + n]
    total ^= total >> np.uint64(31)
    total *= _MIX2
    total ^= total >> np.uint64(29)
    return total


def text_size(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


class Windows:
    """Windows of one batch, dealt to cells: one packed row for each cell.

    Of each window: bits of its hash beside the cell, the row that holds it, its position. Rows
    are named once for each cell, positions are steps of one byte. Windows whose fate the batch
    itself tells go in a row without keys, to a cell that only hands them on; of a window that
    very many rows hold, each batch so sends one place to the window's cell.
    """

    def __init__(self) -> None:
        self.rows, self.ids, self.parts, self.size = [], [], [], 0

    def add(self, row: int, doc: object, cell_key: np.ndarray, key: np.ndarray, at: np.ndarray) -> None:
        self.parts.append((cell_key, key, np.full(len(at), len(self.rows), dtype=np.int32), at.astype(np.int32)))
        self.rows.append(row)
        self.ids.append(doc)
        self.size += len(at)

    def dealt(self, cells: int, settle: Callable, out: dict[str, list] | None = None) -> dict[str, list]:
        """Packed rows; settle(windows, key of cell, key, owner, position) tells which windows
        are to be sent, and which are found already."""
        out = out or {"cell": [], "row": [], "doc_id": [], "lengths": [], "keys": [], "at": []}
        if not self.parts:
            return out
        cell_key, key, owner, at = (np.concatenate(x) for x in zip(*self.parts))
        names = np.array(self.rows, dtype=np.int64)

        def put(cell: int, owner: np.ndarray, key: np.ndarray, at: np.ndarray) -> None:
            who, counts = _runs(owner)
            out["cell"].append(cell)
            out["row"].append(names[who].tobytes())
            out["doc_id"].append([self.ids[i] for i in who.tolist()] if len(key) else [])
            out["lengths"].append(counts.astype("<i4").tobytes())
            out["keys"].append(key.tobytes())
            out["at"].append(_steps(at, counts))

        sent, found = settle(self, cell_key, key, owner, at)
        if found.any():
            put(cells + int(names[0] % cells), owner[found], key[:0], at[found])
        cell_key, key, owner, at = cell_key[sent], key[sent], owner[sent], at[sent]
        cell = ((cell_key >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.uint16 if cells < 1 << 16 else np.int64)
        order = np.argsort(cell, kind="stable")
        cell, key, owner, at = cell[order], key[order], owner[order], at[order]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(cell)]):
            put(int(cell[a]), owner[a:b], key[a:b], at[a:b])
        return out


def _met_here(windows: Windows, cell_key: np.ndarray, key: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that two rows of the batch hold are found, and one place of each is sent: a reference
    block if there is one. All others are sent. (Without a block among them the rows' windows are
    candidates that may be for nothing; extend() tells.)"""
    order = np.argsort(cell_key)
    _, n = _runs(cell_key[order])
    first = np.cumsum(n) - n
    row = np.array(windows.rows, dtype=np.int64)[owner[order]]
    shared = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
    place = np.arange(len(at)) + len(at) * (at[order] % BLOCK != 0)
    best = np.minimum.reduceat(place, first) % len(at)
    found = np.zeros(len(at), dtype=bool)
    found[order] = np.repeat(shared, n)
    sent = ~found
    sent[order[best[shared]]] = True
    return sent, found


def _smaller_here(windows: Windows, cell_key: np.ndarray, key: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a smaller id of the batch holds too are found; only the smallest id's are sent."""
    order = np.argsort(key)
    _, n = _runs(key[order])
    ids = pa.array(windows.ids).to_numpy(zero_copy_only=False)
    rank = np.unique(ids, return_inverse=True)[1][owner[order]]
    found = np.zeros(len(at), dtype=bool)
    found[order] = rank > np.repeat(np.minimum.reduceat(rank, np.cumsum(n) - n), n)
    return ~found, found


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the runs of equal values, and the runs' lengths."""
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, dtype=np.int64)
    return x[starts], np.diff(np.r_[starts, len(x)])


def _steps(at: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending positions of each run as bytes: steps, 255 for each 255 that a step goes beyond."""
    steps = np.diff(at, prepend=0)
    starts = np.cumsum(counts)[:-1]
    steps[starts] = at[starts]
    more = steps // 255
    out = np.full(len(steps) + int(more.sum()), 255, dtype=np.uint8)
    out[np.cumsum(more + 1) - 1] = steps % 255
    return out.tobytes()


def _positions(steps: bytes, counts: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(steps, dtype=np.uint8)
    total = np.cumsum(raw, dtype=np.int64)[raw != 255]
    before = np.r_[0, total[np.cumsum(counts)[:-1] - 1]]
    return (total - np.repeat(before, counts)).astype(np.int32)


def _numbers(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in column.to_pylist()]


def _handed_on(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of the windows of a cell that came without keys."""
    counts = _numbers(table["lengths"], "<i4")
    row = np.repeat(np.concatenate(_numbers(table["row"], "<i8")), np.concatenate(counts))
    return row, np.concatenate([_positions(s, n) for s, n in zip(table["at"].to_pylist(), counts)])


def _packed(row: np.ndarray, at: np.ndarray, groups: int) -> pa.Table:
    """(grp, row, lengths, at): positions by row, packed for each group of rows."""
    group = row % groups
    order = np.lexsort((at, row, group))
    group, row, at = group[order], row[order], at[order].astype("<i4")
    out: dict[str, list] = {"grp": [], "row": [], "lengths": [], "at": []}
    names, sizes = _runs(group)
    for name, end, size in zip(names.tolist(), np.cumsum(sizes), sizes):
        rows, counts = _runs(row[end - size : end])
        out["grp"].append(name)
        out["row"].append(rows.tobytes())
        out["lengths"].append(counts.astype("<i4").tobytes())
        out["at"].append(at[end - size : end].tobytes())
    return pa.table(out, schema=pa.schema([("grp", pa.int64()), ("row", pa.binary()), ("lengths", pa.binary()), ("at", pa.binary())]))


_PACKED = "grp bigint, row binary, lengths binary, at binary"


def _unpacked(table: pa.Table) -> dict[int, np.ndarray]:
    """row: its ascending positions, from rows of _packed."""
    if not table.num_rows:
        return {}
    counts = np.concatenate(_numbers(table["lengths"], "<i4"))
    row = np.repeat(np.concatenate(_numbers(table["row"], "<i8")), counts)
    at = np.concatenate(_numbers(table["at"], "<i4"))
    order = np.lexsort((at, row))
    row, at = row[order], at[order].astype(np.int64)
    names, sizes = _runs(row)
    ends = np.cumsum(sizes)
    return {n: at[e - k : e] for n, e, k in zip(names.tolist(), ends, sizes)}


def anchors(docs: DataFrame, cells: int, groups: int) -> DataFrame:
    """Packed (row, at): where block-long windows stand that equal a reference block of another row.

    Each row of docs (row, text) is cut into non-overlapping blocks, the reference; every
    rolling window probes them. Both are one packed list, as a window at a multiple of the
    block length is a reference block. Each cell holds a bounded share of all windows, by hash;
    those that a batch settles by itself don't meet there.
    Windows that agree by chance only add candidates, which extend() doesn't confirm.
    """

    def probes(batch):
        windows, out = Windows(), {}
        for row, text in zip(values(batch, "row"), text_bytes(batch)):
            key = rolling(word_hashes(space_words(text)), BLOCK)
            if len(key):
                windows.add(row, None, key, key.astype(np.uint32), np.arange(len(key)))
            if windows.size > WINDOWS_AT_ONCE:
                windows, out = Windows(), windows.dealt(cells, _met_here, out)
        return windows.dealt(cells, _met_here, out)

    packed = map_batches(docs, probes, "cell int, row binary, lengths binary, keys binary, at binary")

    def meet(table: pa.Table) -> pa.Table:
        if table["cell"][0].as_py() >= cells:
            return _packed(*_handed_on(table), groups)
        counts = _numbers(table["lengths"], "<i4")
        key = np.concatenate(_numbers(table["keys"], "<u4"))
        row = np.repeat(np.concatenate(_numbers(table["row"], "<i8")), np.concatenate(counts))
        at = np.concatenate([_positions(s, n) for s, n in zip(table["at"].to_pylist(), counts)])
        order = np.argsort(key, kind="stable")
        key, row, at = key[order], row[order], at[order]
        _, n = _runs(key)
        first = np.cumsum(n) - n
        shared = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
        shared &= np.logical_or.reduceat(at % BLOCK == 0, first)
        hit = np.repeat(shared, n)
        return _packed(row[hit], at[hit], groups)

    return packed.groupBy("cell").applyInArrow(meet, _PACKED)


def windows_at(anchored: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the WINDOW-long windows that hold an anchor, ascending."""
    n = n_words - WINDOW + 1
    if n <= 0 or not len(anchored):
        return np.zeros(0, dtype=np.int64)
    first, last = np.clip(anchored - (WINDOW - BLOCK), 0, n), np.clip(anchored + 1, 0, n)
    opened = np.bincount(first, minlength=n + 1) - np.bincount(last, minlength=n + 1)
    return np.flatnonzero(np.cumsum(opened[:n]) > 0)


def extend(docs: DataFrame, anchored: DataFrame, cells: int, groups: int, kind: str) -> DataFrame:
    """Packed (row, at): where windows begin that also start in a row with a smaller id.

    Anchors meet their texts by group and extend to the windows around them; windows of equal
    words meet by cell and hash (64 bits beside the cell's). Unions of the windows found are
    the maximal exact repeats.
    """
    schema = f"cell int, row binary, doc_id array<{kind}>, lengths binary, keys binary, at binary"
    arrow = arrow_schema(schema)

    def candidates(texts: pa.Table, found: pa.Table) -> pa.Table:
        windows, known = Windows(), _unpacked(found)
        for row, doc, text in zip(texts["row"].to_pylist(), texts["doc_id"].to_pylist(), text_bytes(texts)):
            if row in known:
                hashes = word_hashes(space_words(text))
                at = windows_at(known[row], len(hashes))
                if len(at):
                    windows.add(row, doc, rolling(hashes, WINDOW)[at], rolling(hashes, WINDOW, _MIX2)[at], at)
        return pa.table(windows.dealt(cells, _smaller_here), schema=arrow)

    packed = docs.groupBy("grp").cogroup(anchored.groupBy("grp")).applyInArrow(candidates, schema)

    def confirm(table: pa.Table) -> pa.Table:
        if table["cell"][0].as_py() >= cells:
            return _packed(*_handed_on(table), groups)
        counts = _numbers(table["lengths"], "<i4")
        every = np.concatenate(counts)
        key = np.concatenate(_numbers(table["keys"], "<u8"))
        row = np.repeat(np.concatenate(_numbers(table["row"], "<i8")), every)
        at = np.concatenate([_positions(s, n) for s, n in zip(table["at"].to_pylist(), counts)])
        ids = table["doc_id"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        rank = np.repeat(np.unique(ids, return_inverse=True)[1], every)
        order = np.argsort(key, kind="stable")
        key, row, at, rank = key[order], row[order], at[order], rank[order]
        _, n = _runs(key)
        least = np.repeat(np.minimum.reduceat(rank, np.cumsum(n) - n), n)
        return _packed(row[rank > least], at[rank > least], groups)

    return packed.groupBy("cell").applyInArrow(confirm, _PACKED)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bytes_a_cell: int = BYTES_A_CELL, bytes_a_group: int = BYTES_A_GROUP) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, repeats (maximal word spans), kept.

    A word goes if a window of 13 words that covers it also starts in a row with a smaller
    id; windows are judged on the input. `kept` is the words left, joined by one space. Null
    and empty texts have no words. A null id is neither smaller nor larger than any: such rows
    keep all words and count for no other row. Rows with equal ids don't affect one another,
    alike or not. An empty table gives an empty result; other columns are ignored.
    """
    frame = identified(docs, id_col, text_col)
    kind = frame.schema["doc_id"].dataType.simpleString()
    frame = frame.withColumn("row", F.xxhash64(F.lit(1), "doc_id", "text"))
    there = frame.where("doc_id IS NOT NULL AND text IS NOT NULL")
    size = text_size(there)
    cells, groups = (max(1, -(-size // n)) for n in (bytes_a_cell, bytes_a_group))
    # Both cogroups below deal the texts alike, so one query deals them once.
    dealt = frame.withColumn("grp", F.pmod("row", F.lit(groups)))
    hits = anchors(there.select("row", "text"), cells, groups)
    starts = extend(dealt, hits, cells, groups, kind)
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, repeats array<struct<start:bigint,end:bigint>>, kept string"
    arrow = arrow_schema(schema)

    def cut(texts: pa.Table, found: pa.Table) -> pa.Table:
        known = _unpacked(found)
        out = {"doc_id": texts["doc_id"], "n_words": [], "n_removed": [], "repeats": [], "kept": []}
        for row, doc, text in zip(texts["row"].to_pylist(), texts["doc_id"].to_pylist(), text_bytes(texts)):
            words = space_words(text)
            gone = np.zeros(len(words), dtype=bool)
            edges = []
            if doc is not None and row in known:
                for shift in range(WINDOW):
                    gone[known[row] + shift] = True
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            out["n_words"].append(len(gone))
            out["n_removed"].append(int(gone.sum()))
            out["repeats"].append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
            out["kept"].append(b" ".join(words).decode())
        return pa.table(out, schema=arrow)

    return dealt.groupBy("grp").cogroup(starts.groupBy("grp")).applyInArrow(cut, schema)
