"""Byte-level BPE: encode texts by a file of merge ranks, and decode ids to bytes.

A pattern cuts a text into pre-tokens; each is merged by itself. A pre-token that is a token stands as
it is. Else the adjacent pair of lowest rank is merged, the leftmost of equals, until no pair is a token.
The pairs wait in a queue of ranks (`RankQueue`): one bucket per merge rank holds positions in a linked
list of the pre-token's parts, a bitmap of 64-bit words with a bitmap of its non-empty words above it
(and so on) says which buckets hold something, and find-first-set walks down to the next rank. A merge
only writes the new pairs of its neighbours; what stands in the queue for parts that are gone is stale
and skipped when it comes up. So a pre-token of n bytes takes O(n) merges and O(log n) steps for each.

A task encodes texts in blocks of about `BLOCK` characters. The distinct pre-tokens of a block share one
queue (`Vocabulary.merge_many`): a bucket gives up all its positions at once, which merges equal pairs of
different pre-tokens in one step. Pre-tokens of more than `LONG` bytes have a queue of their own.

Defined results: null is an empty text; an empty text has no ids; special tokens are ordinary text;
repeated rows get equal ids; an empty table gives no rows. A byte that is no token of its own, or an id
that the file lacks, is an error. Extra columns are ignored unless named in `keep`.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tabloom.llm import kernel

#: Characters of a block; a longer text is a block of its own.
BLOCK = 1 << 23
#: Most bytes of a pre-token in a common queue.
LONG = 2048


class RankQueue:
    """Buckets by rank, and bitmaps over the buckets, 64 to a word."""

    def __init__(self, ranks: int):
        self.bucket: dict[int, list] = {}
        self.levels: list[list[int]] = []
        n = max(ranks, 1)
        while True:
            n = (n + 63) >> 6
            self.levels.append([0] * n)
            if n == 1:
                break

    def mark(self, rank: int) -> None:
        """Note that a bucket holds something now."""
        at = rank
        for level in self.levels:
            word, bit = at >> 6, 1 << (at & 63)
            was = level[word]
            level[word] = was | bit
            if was:
                return  # the words above know of this one
            at = word

    def clear(self, rank: int) -> None:
        """Note that a bucket is empty."""
        at = rank
        for level in self.levels:
            word = at >> 6
            level[word] &= ~(1 << (at & 63))
            if level[word]:
                return
            at = word

    def first(self) -> int:
        """Lowest rank with a position, -1 if there is none."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = (at << 6) | ((word & -word).bit_length() - 1)
        return at

    def push(self, rank: int, position: int) -> None:
        waiting = self.bucket.get(rank)
        if waiting is None:
            self.bucket[rank] = [position]
            self.mark(rank)
        else:
            heapq.heappush(waiting, position)

    def pop(self, rank: int) -> int:
        """Leftmost position of a rank."""
        waiting = self.bucket[rank]
        position = heapq.heappop(waiting)
        if not waiting:
            del self.bucket[rank]
            self.clear(rank)
        return position

    def push_many(self, rank: np.ndarray, position: np.ndarray) -> None:
        """Positions for many buckets, a stretch of an array for each."""
        order = np.argsort(rank, kind="stable")
        rank, position = rank[order], position[order]
        start = np.flatnonzero(np.diff(rank, prepend=-1))
        bucket = self.bucket
        for r, a, b in zip(rank[start].tolist(), start.tolist(), [*start[1:].tolist(), len(rank)]):
            waiting = bucket.get(r)
            if waiting is None:
                bucket[r] = [position[a:b]]
                self.mark(r)
            else:
                waiting.append(position[a:b])

    def pop_all(self, rank: int) -> np.ndarray:
        """All positions of a rank, from the left."""
        waiting = self.bucket.pop(rank)
        self.clear(rank)
        return waiting[0] if len(waiting) == 1 else np.unique(np.concatenate(waiting))


class Vocabulary:
    """Ranks of tokens, their bytes by id, and the rank of each pair of tokens."""

    def __init__(self, lines: bytes, pattern: str):
        self.rank = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines.splitlines() if x)}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank), default=0)
        self.cut = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.token, default=0) + 1)
        self.byte = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], np.int32)
        #: Ranks whose merge can make a pair of lower rank; their positions are taken one by one.
        self.hasty = np.zeros(max(self.token, default=0) + 1, bool)
        self._pairs()

    def _pairs(self) -> None:
        """Table of the pairs of tokens that are a token: open addressing, at most a quarter full."""
        keys, ranks, rank = [], [], self.rank
        for token, r in rank.items():
            for cut in range(1, len(token)):
                a, b = rank.get(token[:cut]), rank.get(token[cut:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    ranks.append(r)
                    if max(a, b) > r:
                        self.hasty[max(a, b)] = True
                        self.hasty[min(a, b)] |= min(a, b) > r
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.pair_key = np.full(1 << bits, -1, np.int64)
        self.pair_rank = np.full(1 << bits, -1, np.int32)
        key, value = np.array(keys, np.int64), np.array(ranks, np.int32)
        at = self._slot(key)
        while len(key):
            free = self.pair_key[at] < 0
            self.pair_key[at[free]] = key[free]  # of several keys for a slot one stays
            done = self.pair_key[at] == key
            self.pair_rank[at[done]] = value[done]
            key, value, at = key[~done], value[~done], (at[~done] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make, -1 if there is none; -1 marks a gap between pieces."""
        out = np.full(len(a), -1, np.int32)
        left = np.flatnonzero((a >= 0) & (b >= 0))
        key = (a[left].astype(np.int64) << 32) | b[left]
        at = self._slot(key)
        while len(left):
            seen = self.pair_key[at]
            hit = seen == key
            out[left[hit]] = self.pair_rank[at[hit]]
            go = ~hit & (seen >= 0)
            left, key, at = left[go], key[go], (at[go] + 1) & self.mask
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Merge the bytes of one pre-token."""
        n, rank, longest, queue = len(piece), self.rank, self.longest, self.queue
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the pair that starts at a part; -1 if it is no token, or the part is gone

        def look(i: int) -> None:
            """Rank of the pair at part i, put into the queue."""
            j = after[i]
            if j < n and after[j] - i <= longest:
                r = rank.get(piece[i:after[j]], -1)
                pair[i] = r
                if r >= 0:
                    queue.push(r, i)
            else:
                pair[i] = -1

        for i in range(n):
            look(i)
        while (r := queue.first()) >= 0:
            i = queue.pop(r)
            if pair[i] != r:
                continue  # stale
            gone = after[i]
            after[i] = after[gone]
            pair[gone] = -1
            if after[i] < n:
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        out, i = [], 0
        while i < n:
            out.append(rank[piece[i:after[i]]])
            i = after[i]
        return out

    def merge_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge many pre-tokens with one queue: ids, and the offsets of the pieces in them.

        The pieces lie in one array with a gap after each. All positions of the lowest rank are merged in
        one step, every second one in a run of overlapping pairs. Where that rank's token can make a pair
        of lower rank, only the leftmost position of each piece is merged and the others wait.
        """
        size = np.array([len(p) for p in pieces], np.int64)
        end = np.cumsum(size + 1)
        data = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
        token = self.byte[data]
        token[end - 1] = -2
        if (token == -1).any():
            raise ValueError("a byte that is no token")
        n = len(token)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), size + 1)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        rank = np.full(n, -1, np.int32)
        rank[:-1] = self.pair(token[:-1], token[1:])
        alive = token >= 0
        queue = self.queue
        some = np.flatnonzero(rank >= 0).astype(np.int32)
        queue.push_many(rank[some], some)
        while (r := queue.first()) >= 0:
            at = queue.pop_all(r)
            at = at[rank[at] == r]  # the others are stale
            if len(at) > 1:
                if self.hasty[r]:
                    first = np.diff(piece[at], prepend=-1) != 0
                    queue.push_many(rank[at[~first]], at[~first])
                    at = at[first]
                else:
                    joined = np.flatnonzero(after[at[:-1]] == at[1:]) + 1
                    if len(joined):
                        head = np.ones(len(at), bool)
                        head[joined] = False
                        place = np.arange(len(at))
                        place -= np.maximum.accumulate(np.where(head, place, 0))
                        at = at[place & 1 == 0]
            if not len(at):
                continue
            gone = after[at]
            token[at] = r
            alive[gone] = False
            rank[gone] = -1
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            both = np.concatenate([at, left[left >= 0]])
            made = self.pair(token[both], token[after[both]])
            rank[both] = made
            new = made >= 0
            if new.any():
                queue.push_many(made[new], both[new])
        kept = np.flatnonzero(alive)
        return token[kept], np.concatenate([[0], np.cumsum(np.bincount(piece[kept], minlength=len(pieces)))])

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, and the offsets of the pieces in them."""
        known = np.array([self.rank.get(p, -1) for p in pieces], np.int32)
        long = [i for i, p in enumerate(pieces) if known[i] < 0 and len(p) > LONG]
        rest = [i for i, p in enumerate(pieces) if known[i] < 0 and len(p) <= LONG]
        parts, places = [known[known >= 0]], [np.flatnonzero(known >= 0)]
        for i in long:
            parts.append(np.array(self.merge(pieces[i]), np.int32))
            places.append(np.full(len(parts[-1]), i))
        ids, offsets = self.merge_many([pieces[i] for i in rest])
        parts.append(ids)
        places.append(np.repeat(np.array(rest, np.int64), np.diff(offsets)))
        place = np.concatenate(places)
        order = np.argsort(place, kind="stable")
        return np.concatenate(parts)[order], np.searchsorted(place[order], np.arange(len(pieces) + 1))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


class _Numbers(dict):
    """Numbers of strings in the order they are first asked for."""

    def __missing__(self, text: str) -> int:
        self[text] = len(self)
        return self[text]


class Block:
    """Texts that are encoded together: each distinct stretch between single spaces is cut once, and each
    distinct pre-token is merged once. Single spaces between other characters start a pre-token, so
    the pattern may be applied to each stretch by itself; a text with a space next to white space is cut
    as a whole."""

    def __init__(self, known: Vocabulary):
        self.known, self.inside, self.whole = known, _Numbers(), _Numbers()
        self.texts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, text: str) -> None:
        self.size += len(text)
        if _CROWDED.search(text):
            head, rest = self.known.cut(text), []
        else:
            first, *rest = text.split(" ")
            head = [first]
        self.texts.append((np.fromiter(map(self.whole.__getitem__, head), np.int32, len(head)),
                           np.fromiter(map(self.inside.__getitem__, rest), np.int32, len(rest))))

    def encoded(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of the texts in them."""
        pieces, cut, upto = _Numbers(), [], [0]
        for stretch in chain((" " + s for s in self.inside), self.whole):
            cut += map(pieces.__getitem__, self.known.cut(stretch))
            upto.append(len(cut))
        spaced = len(self.inside)
        self.inside.clear()
        self.whole.clear()
        flat = _gather(*self.known.encode_pieces([p.encode() for p in pieces]), np.array(cut, np.int32))
        stretches = flat[0], flat[1][np.array(upto)]
        order = np.concatenate([x for head, rest in self.texts for x in (head + np.int32(spaced), rest)])
        ids, offsets = _gather(*stretches, order)
        ends = np.cumsum([len(head) + len(rest) for head, rest in self.texts])
        return ids, np.concatenate([[0], offsets[ends]])


def _gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches `which` of a flat array, one after the other, and their offsets."""
    size = offsets[which + 1] - offsets[which]
    upto = np.concatenate([[0], np.cumsum(size)])
    return flat[np.arange(upto[-1]) + np.repeat(offsets[which] - upto[:-1], size)], upto


_CROWDED = regex.compile(r"\s \s?| \s")


@functools.lru_cache(maxsize=2)
def vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(lines, pattern)


def _shipped(df: DataFrame, path: str):
    """The file of ranks as a broadcast value: its size is fixed and does not grow with the data."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str]) -> DataFrame:
    """Columns `keep` of every row of `docs`, and `ids` (array<int>) of its `text`. `path` is a file of
    lines "base64 token, space, rank" that the driver can read."""
    lines = _shipped(docs, path)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    names = [*keep, "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(lines.value, pattern)
        for batch in kernel.empty_batches(batches):
            texts, block, first = batch.column(len(keep)), Block(known), 0
            for i in range(batch.num_rows):
                block.add(texts[i].as_py() or "")
                if block.size >= BLOCK or i + 1 == batch.num_rows:
                    ids, offsets = block.encoded()
                    column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                    columns = [batch.column(k).slice(first, i + 1 - first) for k in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*columns, column], names=names)
                    block, first = Block(known), i + 1

    return docs.select(*keep, docs["text"].alias("_encoded")).mapInArrow(run, ", ".join([*types, "ids array<int>"]))


def _each_row(encoded: DataFrame, path: str, pattern: str, keep: list[str], fields: dict[str, str], make) -> DataFrame:
    """Columns `keep` and what `make(vocabulary, ids)` gives for the ids of each row."""
    lines = _shipped(encoded, path)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*keep).schema.fields]
    names = [*keep, *fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(lines.value, pattern)
        for batch in kernel.empty_batches(batches):
            column = batch.column(len(keep))
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            rows = [make(known, flat[offsets[i]:offsets[i + 1]]) for i in range(len(column))]
            made = [pa.array([r[k] for r in rows]) for k in range(len(fields))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keep))], *made], names=names)

    schema = ", ".join([*types, *[f"{name} {kind}" for name, kind in fields.items()]])
    return encoded.select(*keep, encoded["ids"].alias("_encoded_ids")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str]) -> DataFrame:
    """Columns `keep` of every row and the bytes of its `ids`."""
    return _each_row(encoded, path, pattern, keep, {"decoded": "binary"}, lambda v, ids: (v.decode(ids),))


def digests(encoded: DataFrame, path: str, pattern: str, keep: list[str]) -> DataFrame:
    """Columns `keep`, the number of ids, and SHA-256 of the ids as little-endian 32-bit numbers and of the
    bytes they decode to. The bytes stay in their task."""

    def make(known: Vocabulary, ids: np.ndarray):
        packed = ids.astype("<u4").tobytes()
        return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(known.decode(ids)).hexdigest()

    fields = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return _each_row(encoded, path, pattern, keep, fields, make)
