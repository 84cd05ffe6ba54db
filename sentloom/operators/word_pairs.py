"""Words that occur together, looked at as arrays of numbers in Arrow tasks.

A text is kept as pieces: rows of (kind, i, data), whose data are the bytes of some arrays.
Words are numbers of a book. A slice has the target words whose number leaves the rest k
when divided by n; its task reads all pieces of the text, keeps the parts in which its words
occur, and makes the words that occur together a bounded number at a time. They are never
written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = "kind string, i bigint, data binary"
_PIECE = pa.schema([("kind", pa.string()), ("i", pa.int64()), ("data", pa.binary())])
# Words that occur together made at a time; entries of a piece of a table.
BLOCK, ENTRIES = 250_000, 250_000
# Source words of the parts that a task holds before it looks at them; words of a side in a chunk of text, and in a piece.
HELD_WORDS, CHUNK_WORDS, PIECE_WORDS = 16_000_000, 400_000, 100_000

Batches = Iterator[pa.RecordBatch]


def _packed(*arrays: np.ndarray) -> bytes:
    """How many arrays there are, the bytes of each, and the arrays, each from a multiple of 8."""
    sizes = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    return b"".join([sizes.tobytes(), *(x for a in arrays for x in (a.tobytes(), bytes(-a.nbytes % 8)))])


def _unpacked(data: pa.Buffer) -> list[pa.Buffer]:
    sizes = np.frombuffer(data, np.int64, 1 + int(np.frombuffer(data, np.int64, 1)[0]))[1:].tolist()
    out, at = [], 8 * (len(sizes) + 1)
    for size in sizes:
        out.append(data.slice(at, size))
        at += size + -size % 8
    return out


def _row(kind: str, i: int, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, "i": i, "data": _packed(*arrays)}], _PIECE)


def _rows(batches: Batches) -> Iterator[tuple[str, int, list[pa.Buffer]]]:
    for batch in batches:
        kinds, numbers, data = (batch.column(c) for c in ("kind", "i", "data"))
        for r in range(batch.num_rows):
            yield kinds[r].as_py(), numbers[r].as_py(), _unpacked(data[r].as_buffer())


def _let_go() -> None:
    """Memory that is free goes back: the worker lives on beside others."""
    pa.default_memory_pool().release_unused()


def _gathered(batches: Batches) -> Iterator[pa.Table]:
    """Batches of some ENTRIES rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ENTRIES:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _small(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _counts(data: pa.Buffer, n: int) -> np.ndarray:
    """Counts of :func:`_small`, whose type is told by their size."""
    return np.frombuffer(data, f"u{max(1, data.size // max(n, 1))}")


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


# --- text to pieces ----------------------------------------------------------

def cut(batches: Batches, part_words: int, no_word: str | None, chunk_words: int = CHUNK_WORDS) -> Batches:
    """Rows (line_no, src, tgt) of lowercased text, those of a line together, to chunks of whole lines.

    Arrow takes for whitespace what :data:`sentloom.functions.text.WHITESPACE` has.

    A chunk has its lines with the words their targets have, its words, and as data its
    parts: the line, and distinct words of both sides with counts. Only parts with target
    words count; with ``no_word`` each has that source word as well.
    """
    held, words = [], 0
    for batch in batches:
        batch = pa.RecordBatch.from_arrays([batch.column("line_no"), *(_words(batch.column(c)) for c in ("src", "tgt"))], ["line_no", "s", "t"])
        held.append(batch)
        words += max(len(batch.column(c).flatten()) for c in ("s", "t"))
        if words >= chunk_words:
            rows = pa.Table.from_batches(held).combine_chunks()
            new = _line_starts(rows)
            if last := int(new[-1]) if len(new) else 0:
                yield _chunk(rows.slice(0, last), part_words, no_word)
                held, words = rows.slice(last).combine_chunks().to_batches(), 0
    if held and (rows := pa.Table.from_batches(held).combine_chunks()).num_rows:
        yield _chunk(rows, part_words, no_word)
    _let_go()


def _words(text: pa.Array) -> pa.Array:
    """The words of each text; a NULL text has none."""
    split = pc.utf8_split_whitespace(pc.fill_null(text, "").cast(pa.string()))
    words = split.flatten()
    ends = np.cumsum(pc.not_equal(words, "").to_numpy(zero_copy_only=False))
    offsets = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pc.not_equal(words, "")))


def _line_starts(rows: pa.Table) -> np.ndarray:
    """Where a line other than that of the row before begins, without the first."""
    line = rows.column("line_no")
    changed = pc.not_equal(line.slice(1), line.slice(0, max(0, len(line) - 1)))
    return np.flatnonzero(np.asarray(changed.to_numpy(), bool)) + 1


def _chunk(rows: pa.Table, part_words: int, no_word: str | None) -> pa.RecordBatch:
    firsts = np.concatenate([[0], _line_starts(rows)])
    line = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, rows.num_rows)))
    arrays = {c: rows.column(c).combine_chunks() for c in ("s", "t")}
    lengths = {c: a.value_lengths().to_numpy().astype(np.int64) for c, a in arrays.items()}
    k = np.ceil(np.maximum(np.maximum(lengths["s"], lengths["t"]), 1) / part_words).astype(np.int64)
    coded, known, place = {}, {}, {}
    for c, a in arrays.items():
        found = a.flatten().dictionary_encode()
        coded[c], known[c] = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary
        n = lengths[c]
        pos = np.arange(len(coded[c])) - np.repeat(_starts(n), n)
        place[c] = np.floor(pos * np.repeat(k, n) / np.repeat(n, n)).astype(np.int64)
    high = 1 + max(int(p.max(initial=0)) for p in place.values())
    own = {c: np.repeat(line, lengths[c]) * high + place[c] for c in arrays}
    parts, t_part = np.unique(own["t"], return_inverse=True)
    s_part = np.minimum(np.searchsorted(parts, own["s"]), max(len(parts) - 1, 0))
    met = parts[s_part] == own["s"] if len(parts) else np.zeros(len(s_part), bool)
    s_part, s_code = s_part[met], coded["s"][met]
    if no_word is not None:
        s_part = np.concatenate([s_part, np.arange(len(parts))])
        s_code = np.concatenate([s_code, np.full(len(parts), len(known["s"]))])
        known["s"] = pa.concat_arrays([known["s"], pa.array([no_word], known["s"].type)])
    data, per_part = [(parts // high).astype(np.int32)], []
    for c, part, code in (("s", s_part, s_code), ("t", t_part, coded["t"])):
        width = max(len(known[c]), 1)
        entry, n = np.unique(part * width + code, return_counts=True)
        per_part.append(np.bincount(entry // width, minlength=len(parts)))
        data += [per_part[-1].astype(np.int32), (entry % width).astype(np.int32), _small(n)]
    sizes = np.bincount(line, weights=lengths["t"], minlength=len(firsts)).astype(np.int64)
    lines = rows.column("line_no").combine_chunks().take(pa.array(firsts))
    return pa.RecordBatch.from_arrays([
        *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (lines, pa.array(sizes), known["s"], known["t"])),
        pa.array([int(per_part[0] @ per_part[1])], pa.int64()), pa.array([_packed(*data)], pa.binary()),
    ], ["line_no", "size", "s_words", "t_words", "met", "data"])


def numbered(batches: Batches) -> Batches:
    """Chunks (i, s_codes, t_codes, data) to pieces of some PIECE_WORDS source words, with the numbers that words have in the books.

    Words without one (-1) are left out.
    """
    for batch in batches:
        for r in range(batch.num_rows):
            data = _unpacked(batch.column("data")[r].as_buffer())
            line, sides = np.frombuffer(data[0], np.int32), []
            for c, (lengths, code, n) in (("s_codes", data[1:4]), ("t_codes", data[4:7])):
                book = batch.column(c)[r].values.to_numpy(zero_copy_only=False)
                length, code = np.frombuffer(lengths, np.int32), np.frombuffer(code, np.int32)
                number = book[code] if len(code) else code
                there = number >= 0
                length = np.bincount(np.repeat(np.arange(len(line)), length)[there], minlength=len(line))
                sides.append((length.astype(np.int32), number[there].astype(np.int32), _counts(n, len(code))[there], np.concatenate([[0], np.cumsum(length)])))
            cuts = np.searchsorted(sides[0][3], np.arange(PIECE_WORDS, sides[0][3][-1], PIECE_WORDS))
            bounds = np.unique([0, *cuts, len(line)]).tolist()
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = [x for length, number, n, ends in sides for x in (length[a:b], number[ends[a]:ends[b]], n[ends[a]:ends[b]])]
                yield _row("part", batch.column("i")[r].as_py(), line[a:b], *own)


def packed_words(batches: Batches, kind: str) -> Batches:
    """Rows (word, code) of a book to pieces."""
    for batch in _gathered(batches):
        words = [w.encode() for w in batch.column("word").to_pylist()]
        ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
        yield _row(kind, 0, batch.column("code").to_numpy().astype(np.int32), ends, np.frombuffer(b"".join(words), np.uint8))


def packed_sums(batches: Batches) -> Batches:
    """Rows (code, total) to pieces."""
    for batch in _gathered(batches):
        yield _row("whole", 0, batch.column("code").to_numpy().astype(np.int32), batch.column("total").to_numpy())


def packed_table(batches: Batches, n: int) -> Iterator[pa.RecordBatch]:
    """Rows (t, s, p) of numbers, ordered by the slice of t, t and s, to pieces of the slices."""
    for batch in _gathered(batches):
        t, s, p = (batch.column(c).to_numpy() for c in ("t", "s", "p"))
        for k in np.unique(t % n):
            mine = t % n == k
            yield _table_row(int(k), t[mine] // n, s[mine], p[mine])


def _by_byte(values: np.ndarray) -> np.ndarray:
    """All first bytes, then all second bytes and so on, which take less space when written."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)


def _from_bytes(data: pa.Buffer, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _table_row(k: int, t: np.ndarray, s: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    firsts = _firsts(t)
    return _row("table", k, t[firsts].astype(np.int32), np.diff(np.append(firsts, len(t))).astype(np.int32), _by_byte(s.astype(np.int32)), _by_byte(c))


# --- the sums of source words ------------------------------------------------

def first_sums(batches: Batches) -> Batches:
    """What all target words expect of each source word while all are equally likely: (code, total) for each chunk."""
    for _, _, data in _rows(batches):
        s_len, s, s_n, t_len, t, t_n = _sides(data)
        size, targets = _per_part(s_n, s_len), _per_part(t_n, t_len)
        each = s_n * np.repeat(np.divide(targets, size, out=np.zeros(len(size)), where=size > 0), s_len)
        codes, at = np.unique(s, return_inverse=True)
        yield _sum_rows(codes, np.bincount(at, weights=each, minlength=len(codes)))


def unpacked_sums(batches: Batches) -> Batches:
    for _, _, (codes, totals) in _rows(batches):
        yield _sum_rows(np.frombuffer(codes, np.int32), np.frombuffer(totals, np.float64))


def _sum_rows(codes: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(totals, pa.float64())], ["code", "total"])


def _sides(data: list[pa.Buffer]) -> list[np.ndarray]:
    out = []
    for lengths, code, n in (data[1:4], data[4:7]):
        code = np.frombuffer(code, np.int32)
        out += [np.frombuffer(lengths, np.int32), code, _counts(n, len(code))]
    return out


def _per_part(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of values of so many at a time, none of which are none."""
    return np.add.reduceat(values, _starts(lengths.astype(np.int64)), dtype=np.int64).astype(np.float64) if len(values) else np.zeros(0)


# --- a slice -----------------------------------------------------------------

class _Slice:
    """What the task of a slice holds: what it was sent with, and parts it has not looked at."""

    def __init__(self, k: int, n: int, n_s: int, sent: int, of: int):
        self.k, self.n, self.n_s, self.sent, self.of = k, n, n_s, sent, of
        self.whole, self.tables, self.known, self.text, self.words = np.zeros(n_s), [], None, [], 0

    def read(self, batches: Batches, look: Callable[[bool], None]) -> None:
        """Take in all pieces; ``look`` is called when many parts are held and what was sent with them is there, and with True at the end."""
        for kind, i, data in _rows(batches):
            if kind == "part":
                self._hold(i, data)
            else:
                self.sent -= 1
                if kind == "whole":
                    self.whole[np.frombuffer(data[0], np.int32)] = np.frombuffer(data[1], np.float64)
                elif kind == "table":
                    self.tables.append(self._entries(i, data))
            if self.words >= HELD_WORDS and not self.sent:
                look(False)
        if self.sent:
            raise ValueError(f"{self.sent} pieces of slice {self.k} are missing")
        look(True)

    def _entries(self, k: int, data: list[pa.Buffer]) -> tuple[np.ndarray, np.ndarray]:
        """A piece of the table of slice ``k`` of ``of``: keys (t times the source words, plus s) and counts of those of its entries that belong to this slice."""
        t, n, s, c = *(np.frombuffer(x, np.int32) for x in data[:2]), _from_bytes(data[2], np.int32), _from_bytes(data[3], np.float64)
        t = t.astype(np.int64) * self.of + k
        keys = np.repeat(t // self.n * self.n_s, n) + s
        if self.n == self.of:
            return keys, c
        mine = np.repeat(t % self.n == self.k, n)
        return keys[mine], c[mine]

    def _hold(self, i: int, data: list[pa.Buffer]) -> None:
        s_len, s, s_n, t_len, t, t_n = _sides(data)
        mine = t % self.n == self.k
        part = np.repeat(np.arange(len(t_len)), t_len)[mine]
        there = s_len[part] > 0
        part, t, t_n = part[there], t[mine][there] // self.n, t_n[mine][there]
        if not len(part):
            return
        used = np.zeros(len(t_len), bool)
        used[part] = True
        words = np.repeat(used, s_len)
        self.text.append((i, np.frombuffer(data[0], np.int32)[used], s_len[used], s[words], s_n[words], (np.cumsum(used) - 1)[part], t, t_n))
        self.words += int(words.sum())

    def table(self, least: float | None) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order and probabilities, made of the pieces once."""
        if self.known is None:
            # Pieces are in order within, and mostly among themselves.
            self.tables.sort(key=lambda x: x[0][:1].tolist())
            keys, p = (np.concatenate(x) for x in zip(*(self.tables or [(np.zeros(0, np.int64), np.zeros(0))])))
            self.tables.clear()
            if not (keys[1:] > keys[:-1]).all():
                order = np.argsort(keys)
                keys, p = keys[order], p[order]
            if least is not None:
                whole = self.whole[keys % self.n_s]
                p = np.divide(p, whole, out=np.zeros(len(p)), where=whole > 0)
                keys, p = keys[p >= least], p[p >= least]
            self.known = keys, p
        return self.known

    def entries(self) -> tuple[dict[str, np.ndarray], list[tuple[int, int, int]]]:
        """The parts that are held, which are then let go: entries ordered by target word; of each chunk its number, first slot and lines."""
        if not self.text:
            return {c: np.zeros(0, np.int64) for c in ("t", "n")}, []
        i, line, s_len, s, s_n, part, t, t_n = (list(x) for x in zip(*self.text))
        self.text, self.words = [], 0
        held = {"s": np.concatenate(s)}
        s.clear()
        lines = np.array([x.max() + 1 for x in line], np.int64)
        slots, before = _starts(lengths=lines), _starts(np.array([len(x) for x in s_len]))
        slot = np.concatenate([x[p] + first for x, p, first in zip(line, part, slots)])
        part, t = np.concatenate([p + first for p, first in zip(part, before)]), np.concatenate(t).astype(np.int64)
        order = np.argsort(t, kind="stable")
        lengths, s_n, part = np.concatenate(s_len).astype(np.int64), np.concatenate(s_n), part[order]
        return {
            **held, "slot": slot[order], "s_n": s_n, "size": _per_part(s_n, lengths)[part],
            "first": _starts(lengths)[part], "n": lengths[part], "t": t[order], "t_n": np.concatenate(t_n)[order],
        }, list(zip(i, slots.tolist(), lines.tolist()))


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where values other than those before begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _bounds(n: np.ndarray, first: int, last: int) -> list[tuple[int, int]]:
    """Entries first to last in ranges of at most BLOCK words that occur together, or one entry."""
    ends = np.cumsum(n[first:last])
    cuts = first + np.searchsorted(ends, np.arange(BLOCK, ends[-1], BLOCK)) + 1
    bounds = np.unique([first, *cuts, last]).tolist()
    return list(zip(bounds[:-1], bounds[1:]))


def _blocks(t: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of entries of whole words, of at most BLOCK words that occur together but for a frequent word, which is alone."""
    firsts = _firsts(t)
    ends = np.concatenate([[0], np.cumsum(np.add.reduceat(n, firsts))]) if len(t) else [0]
    firsts, at = np.append(firsts, len(t)), 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, "right")) - 1)
        yield int(firsts[at]), int(firsts[to])
        at = to


def _together(e: dict[str, np.ndarray], a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries a to b: lengths, where each begins, and source words with counts."""
    n = e["n"][a:b]
    starts = _starts(n)
    at = np.arange(n.sum()) + np.repeat(e["first"][a:b] - starts, n)
    return n, starts, e["s"][at], e["s_n"][at]


class _Known:
    """Probabilities of some target words that follow each other, looked up by key."""

    def __init__(self, keys: np.ndarray, p: np.ndarray, low: int, span: int, dense: bool, other: float):
        a, b = np.searchsorted(keys, [low, low + span])
        self.keys, self.p, self.other = keys[a:b] - low, p[a:b], other
        if dense:
            self.all = np.full(span, other)
            self.all[self.keys] = self.p

    def of_sorted(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.other)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.p[at], self.other)


def _expected(e: dict[str, np.ndarray], n_s: int, table: tuple[np.ndarray, np.ndarray] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What the entries expect: (keys, counts), the keys in order; without a table all are equally likely."""
    for first, last in _blocks(e["t"], e["n"]):
        low, span = int(e["t"][first]) * n_s, int(e["t"][last - 1] - e["t"][first] + 1) * n_s
        total = int(e["n"][first:last].sum())
        dense = span <= 2 * total
        known = None if table is None else _Known(*table, low, span, dense, 0.0)
        whole = np.zeros(span) if dense else None
        out = []
        for a, b in _bounds(e["n"], first, last):
            n, starts, s, s_n = _together(e, a, b)
            keys = np.repeat((e["t"][a:b] - e["t"][first]) * n_s, n) + s
            if not dense:
                order = np.argsort(keys)
                ordered = keys[order]
                firsts = _firsts(ordered)
                distinct = ordered[firsts]
            if known is None:
                x = s_n * np.repeat(e["t_n"][a:b] / e["size"][a:b], n)
            else:
                if dense:
                    p = known.all[keys]
                else:
                    p = np.empty(len(keys))
                    p[order] = np.repeat(known.of_sorted(distinct), np.diff(np.append(firsts, len(keys))))
                x = s_n * p
                norm = np.add.reduceat(x, starts)
                x *= np.repeat(np.divide(e["t_n"][a:b], norm, out=np.zeros(b - a), where=norm > 0), n)
            if dense:
                whole += np.bincount(keys, weights=x, minlength=span)
            else:
                out.append((distinct, np.add.reduceat(x[order], firsts)))
        if dense:
            found = np.flatnonzero(whole)
            yield found + low, whole[found]
        else:
            keys, counts = out[0] if len(out) == 1 else _merged(out)
            yield keys[counts > 0] + low, counts[counts > 0]


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(keys)
    keys = keys[order]
    firsts = _firsts(keys)
    return keys[firsts], np.add.reduceat(counts[order], firsts) if len(keys) else counts


def learn(batches: Batches, k: int, n: int, n_s: int, sent: int, least: float, first: bool) -> Batches:
    """A round for the target words of slice ``k``: pieces of what is expected, and of its sums by source word.

    In the first round all are equally likely, ``whole`` is what is expected of a source
    word in this round, and what is less likely than ``least`` is left out at once. In the
    others ``whole`` and the table are those of the round before.
    """
    own, found = _Slice(k, n, n_s, sent, n), []
    sums = np.zeros(0 if first else n_s)

    def look(last: bool) -> None:
        nonlocal found
        new = _expected(own.entries()[0], n_s, None if first else own.table(least))
        # What is unlikely in some parts may be likely in all, so only what is whole is left out.
        found = new if last and not found else [_merged([*found, *new])]

    def likely(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = own.whole[keys % n_s]
        those = np.divide(counts, whole, out=np.zeros(len(counts)), where=whole > 0) >= least
        return keys[those], counts[those]

    own.read(batches, look)
    yield from _written(k, n_s, (likely(*x) for x in found) if first else found, sums)
    _let_go()


def _written(k: int, n_s: int, found: Iterator[tuple[np.ndarray, np.ndarray]], sums: np.ndarray) -> Batches:
    held, size = [], 0
    for keys, counts in found:
        for a in range(0, len(keys), ENTRIES):
            held.append((keys[a:a + ENTRIES], counts[a:a + ENTRIES]))
            size += len(held[-1][0])
            if size >= ENTRIES:
                yield _table_piece(k, n_s, held, sums)
                held, size = [], 0
    if held:
        yield _table_piece(k, n_s, held, sums)
    if len(codes := np.flatnonzero(sums)):
        yield _row("sums", k, codes.astype(np.int32), sums[codes])


def _table_piece(k: int, n_s: int, held: list[tuple[np.ndarray, np.ndarray]], sums: np.ndarray) -> pa.RecordBatch:
    keys, counts = (np.concatenate(x) for x in zip(*held))
    if len(sums):
        sums += np.bincount(keys % n_s, weights=counts, minlength=n_s)
    return _table_row(k, keys // n_s, keys % n_s, counts)


def cover(batches: Batches, k: int, n: int, n_s: int, sent: int, of: int, least: float | None) -> Batches:
    """For each chunk and line, the sum over its target words of slice ``k`` of the best probability that a source word makes it."""
    own, best = _Slice(k, n, n_s, sent, of), []

    def look(last: bool) -> None:
        (e, chunks), table = own.entries(), own.table(least)
        sums = np.zeros(sum(lines for _, _, lines in chunks))
        for first, last in _blocks(e["t"], e["n"]):
            low, span = int(e["t"][first]) * n_s, int(e["t"][last - 1] - e["t"][first] + 1) * n_s
            dense = span <= 2 * int(e["n"][first:last].sum())
            known = _Known(*table, low, span, dense, -np.inf)
            for a, b in _bounds(e["n"], first, last):
                n, starts, s, _ = _together(e, a, b)
                keys = np.repeat((e["t"][a:b] - e["t"][first]) * n_s, n) + s
                if dense:
                    p = known.all[keys]
                else:
                    order = np.argsort(keys)
                    p = np.empty(len(keys))
                    p[order] = known.of_sorted(keys[order])
                top = np.maximum.reduceat(p, starts)
                found = top != -np.inf
                sums += np.bincount(e["slot"][a:b][found], weights=top[found] * e["t_n"][a:b][found], minlength=len(sums))
        best.extend(_row("best", i, sums[first:first + lines]) for i, first, lines in chunks)

    own.read(batches, look)
    yield from best
    _let_go()


def divided(rows: pa.Table, out: str) -> pa.Table:
    """Of a chunk, one row of its lines and rows of sums: the mean over the target words of each line that has any."""
    lines = rows.column("line_no")
    at = next(r for r in range(rows.num_rows) if lines[r].is_valid)
    size = rows.column("size")[at].values.to_numpy()
    sums = np.zeros(len(size))
    for data in rows.column("data"):
        if data.is_valid:
            some = np.frombuffer(_unpacked(data.as_buffer())[0], np.float64)
            sums[: len(some)] += some
    has = np.flatnonzero(size)
    return pa.table({"line_no": lines[at].values.take(pa.array(has)), out: sums[has] / size[has]})


def unpacked_table(batches: Batches, k: int, n: int, n_s: int, least: float) -> Batches:
    """The entries of slice ``k`` of a table as rows of words: (s, t, p)."""
    own, books = _Slice(k, n, n_s, 0, n), {"s": [], "t": []}
    for kind, i, data in _rows(batches):
        if kind == "whole":
            own.whole[np.frombuffer(data[0], np.int32)] = np.frombuffer(data[1], np.float64)
        elif kind == "table":
            own.tables.append(own._entries(i, data))
        else:
            codes = np.frombuffer(data[0], np.int32)
            words = pa.StringArray.from_buffers(len(codes), pa.py_buffer(data[1].to_pybytes()), pa.py_buffer(data[2].to_pybytes()))
            if kind == "t_words":
                mine = codes % n == k
                codes, words = codes[mine] // n, words.filter(pa.array(mine))
            books[kind[0]].append((codes, words))
    keys, p = own.table(least)
    if not len(keys):
        return
    words = {}
    for side, pieces in books.items():
        order = np.argsort(np.concatenate([codes for codes, _ in pieces]))
        words[side] = pa.concat_arrays([x for _, x in pieces]).take(pa.array(order))
    for a in range(0, len(keys), ENTRIES // 10):
        some = keys[a:a + ENTRIES // 10]
        s, t = (words[side].take(pa.array(codes)) for side, codes in (("s", some % n_s), ("t", some // n_s)))
        yield pa.RecordBatch.from_arrays([s, t, pa.array(p[a:a + ENTRIES // 10])], ["s", "t", "p"])
    _let_go()
