"""Token ids of texts by way of pieces that are encoded on their own.

The word tokenizer drops white space and never joins across it, so a text's ids are those of its blank-separated pieces, one
after the other; another tokenizer brings its own way to split. Texts are split and their distinct pieces found by Arrow, a block of
texts at a time; a worker remembers the ids of pieces, and when it has too many, it keeps those that came up most often.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces a worker remembers before it forgets the rarer half.
MEMORY = 300_000
#: Bytes of text whose pieces are resolved together; a longer text is a block of its own.
BLOCK_BYTES = 2_000_000
#: Hits that are told apart.
_MOST_HITS = 65_535

#: From new pieces to their ids.
Resolver = Callable[[list[bytes]], Iterable[list[int]]]
#: From a text to its pieces, in order.
Splitter = Callable[[bytes], list[bytes]]


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Runs of texts with about ``size`` bytes each; null texts are empty."""
    texts = pc.fill_null(texts.cast(pa.binary()) if not pa.types.is_binary(texts.type) else texts, b"")
    reached = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = reached[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(reached, before + size, "right")))
        yield texts.slice(at, until - at)
        at = until
        # What the block took is given back before the next one.
        pa.default_memory_pool().release_unused()


def white_space_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts between ASCII white space, and where each text's pieces begin; some may be empty."""
    # The split looks at ASCII bytes only, so the bytes are taken for text as they are.
    plain = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    lists = pc.ascii_split_whitespace(plain)
    return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


class ChunkTable:
    """A bounded memory of pieces and their ids."""

    def __init__(self, resolve: Resolver, memory: int = MEMORY, split: Splitter | None = None):
        self.resolve, self.memory, self.split = resolve, memory, split
        self.index: dict[bytes, int] = {}
        self.starts, self.sizes, self.hits = (np.zeros(1024, np.int64) for _ in range(3))
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text, in order, as unsigned 32-bit integers."""
        for block in blocks(pa.array(texts, pa.binary())):
            ids, offsets = self.encode_block(block)
            yield from (ids[a:b] for a, b in zip(offsets, offsets[1:]))

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a block one after the other, and where those of each text begin and end."""
        if self.split is None:
            pieces, bounds = white_space_pieces(texts)
        else:
            split = [self.split(t) for t in texts.to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(s) for s in split], dtype=np.int64)))
            pieces = pa.array(chain.from_iterable(split), pa.binary())
        coded = pieces.dictionary_encode()
        slots = self._slots(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        at = slots[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[bounds]

    def _slots(self, pieces: list[bytes]) -> np.ndarray:
        """Where the ids of distinct pieces lie; new pieces are resolved."""
        slots = self._known(pieces)
        fresh = np.flatnonzero(slots < 0)
        if len(self.index) + len(fresh) > self.memory and self.index:
            self._forget()
            slots = self._known(pieces)
            fresh = np.flatnonzero(slots < 0)
        new = [pieces[i] for i in fresh.tolist()]
        first = len(self.index)
        # Ids of pieces are many small lists without cycles, which the collector would look through in vain.
        collecting = gc.isenabled()
        gc.disable()
        try:
            found = list(self.resolve(new))
        finally:
            if collecting:
                gc.enable()
        self.index.update(zip(new, range(first, first + len(new)), strict=True))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._room(first + len(new), self.used + int(sizes.sum()))
        end = first + len(new)
        self.sizes[first:end] = sizes
        self.starts[first:end] = self.used + np.cumsum(sizes) - sizes
        self.hits[first:end] = 0
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        slots[fresh] = np.arange(first, end)
        self.hits[slots] += 1
        return slots

    def _known(self, pieces: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))

    def _room(self, pieces: int, ids: int) -> None:
        def grown(array: np.ndarray, wanted: int) -> np.ndarray:
            if wanted <= len(array):
                return array
            return np.concatenate((array, np.zeros(max(wanted, 2 * len(array)) - len(array), array.dtype)))

        self.starts, self.sizes, self.hits = (grown(a, pieces) for a in (self.starts, self.sizes, self.hits))
        self.ids = grown(self.ids, ids)

    def _forget(self) -> None:
        """Keep the half of the memory that came up in most blocks; older hits count half."""
        hits = self.hits[: len(self.index)]
        # Small numbers are sorted in time linear in their count; slots are in the order of the table.
        rarity = (_MOST_HITS - np.minimum(hits, _MOST_HITS)).astype(np.uint16)
        order = np.sort(np.argsort(rarity, kind="stable")[: self.memory // 2])
        kept = np.zeros(len(hits), bool)
        kept[order] = True
        names = list(compress(self.index, kept.tolist()))
        sizes = self.sizes[order]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[order] - ends + sizes, sizes) + np.arange(total)]
        # The old table goes before the new one is made.
        self.index.clear()
        self.index = {p: i for i, p in enumerate(names)}
        self.hits = hits[order] // 2
        self.sizes, self.starts, self.ids, self.used = sizes, ends - sizes, ids, total


def coded_pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Pieces between white space as numbers of distinct ones, and where each text's pieces begin."""
    pieces, bounds = white_space_pieces(texts)
    return pieces.dictionary_encode(), bounds


class PackedTable:
    """A bounded memory of pieces and their ids in arrays, asked for many blocks at once.

    A piece takes its bytes and some numbers, not an object of Python, so several times as many are remembered as by
    ``ChunkTable``. In return the pieces asked for are found by one pass over the memory, whose time many blocks share.
    """

    #: Bytes of names and ids that are remembered for each of the ``memory`` pieces, on average.
    PIECE_BYTES = 64
    #: Bytes of new pieces that are resolved together.
    RESOLVED = 1 << 19

    def __init__(self, resolve: Resolver | Callable[[list[bytes]], pa.ListArray], memory: int):
        self.resolve, self.memory = resolve, memory
        self.names = pa.array([], pa.binary())
        self.sizes, self.starts, self.hits = (np.zeros(0, np.int32) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)

    def encode(self, codes: list[pa.DictionaryArray]) -> Iterator[np.ndarray]:
        """For each block of ``coded_pieces``, where the ids of its pieces lie in the table; see ``expanded``."""
        same = pa.chunked_array(codes).unify_dictionaries()
        slots = self._slots(same.chunk(0).dictionary.cast(pa.binary()))
        for block in same.chunks:
            yield slots[block.indices.to_numpy()]

    def expanded(self, at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at these places one after the other, and where those of each text begin and end."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[bounds]

    def _slots(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of distinct pieces lie; new pieces are resolved."""
        slots = self._known(pieces)
        fresh = np.flatnonzero(slots < 0)
        new = pieces.take(pa.array(fresh))
        if len(self.names) and self._full(len(new), _text_bytes(new)):
            self._forget()
            slots = self._known(pieces)
            fresh = np.flatnonzero(slots < 0)
            new = pieces.take(pa.array(fresh))
        first = len(self.names)
        sizes, ids = [self.sizes], [self.ids]
        # Ids of pieces are many small lists without cycles, which the collector would look through in vain.
        collecting = gc.isenabled()
        gc.disable()
        try:
            for block in blocks(new, self.RESOLVED):
                part = block.to_numpy(zero_copy_only=False).tolist()
                found = self.resolve(part)
                if not isinstance(found, pa.Array):
                    found = pa.array(found, pa.list_(pa.uint32()))
                if len(found) != len(part):
                    raise ValueError("the resolver gave another number of id lists than of pieces")
                sizes.append(pc.list_value_length(found).to_numpy())
                ids.append(found.flatten().to_numpy())
        finally:
            if collecting:
                gc.enable()
        self.names = pa.concat_arrays([self.names, new])
        self._place(np.concatenate(sizes), np.concatenate(ids))
        self.hits = np.concatenate((self.hits, np.zeros(len(new), np.int32)))
        slots[fresh] = np.arange(first, len(self.names))
        self.hits[slots] += 1
        return slots

    def _known(self, pieces: pa.Array) -> np.ndarray:
        slots = np.full(len(pieces), -1, np.int64)
        # Names are looked up among the pieces, as these are fewer.
        found = pc.index_in(self.names, pieces)
        slots[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        return slots

    def _place(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.sizes, self.ids = sizes, ids
        self.starts = np.cumsum(sizes, dtype=np.int64) - sizes

    def _full(self, more: int, more_bytes: int) -> bool:
        held = _text_bytes(self.names) + self.ids.nbytes + more_bytes
        return len(self.names) + more > self.memory or held > self.memory * self.PIECE_BYTES

    def _forget(self) -> None:
        """Keep half of the memory, by pieces and by bytes, of what came up most often; older hits count half."""
        often = np.argsort(-self.hits, kind="stable")[: self.memory // 2]
        cost = pc.binary_length(self.names).to_numpy() + 4 * self.sizes.astype(np.int64)
        often = often[np.cumsum(cost[often]) <= self.memory * self.PIECE_BYTES // 2]
        kept = np.sort(often)
        sizes, starts = self.sizes[kept], self.starts[kept]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]
        self.names = self.names.take(pa.array(kept))
        self.hits = self.hits[kept] // 2
        self._place(sizes, ids)


def _text_bytes(texts: pa.Array) -> int:
    return pc.sum(pc.binary_length(texts)).as_py() or 0


def joined(ids: np.ndarray, offsets: np.ndarray, texts: pa.Array, between: bytes) -> pa.Array:
    """The texts that ids stand for, one for each stretch of ids, with ``between`` between them; ``texts`` is large_binary."""
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), texts.take(pa.array(ids)))
    return pc.binary_join(lists, pa.scalar(between, pa.large_binary()))
