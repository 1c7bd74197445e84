"""Byte-level BPE by segment trees, and decoding.

A piece of text starts as its bytes. Leaf ``i`` of the tree holds the rank of the pair that
starts at byte position ``i`` together with that position, so the root is the leftmost pair of
least rank. A merge changes the pair at that position, the one before it and the one that it
swallows: three leaves, each updated along its path to the root. Links to the live neighbours
tell which positions these are.

Pieces of a size class have trees of one shape and are merged in step, one array operation for
all of them; long ones have a tree of their own. Frequent pieces come from a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilecast.llm.common import map_text
from tilecast.llm.repeats import gather, stretches

#: No pair: larger than any rank with its position.
NONE, NONE32 = 2**62, 2**31 - 1

#: Pieces above this many bytes get a tree of their own; pieces kept when the cache holds twice as many,
#: some 200 bytes each; tokens of the longest that are kept.
IN_STEP, CACHE, LONG = 256, 100_000, 16

#: Bytes of text cut into pieces together: each piece is a string of 50 bytes and more.
TEXT_BYTES = 1_000_000

#: Pieces merged in step, and ids or bytes gathered at once, so that their arrays fit a core's cache.
STEP, GATHERED = 4096, 1 << 16

_WIDE = re.compile("[\U00010000-\U0010ffff]")


class Merges:
    """Token bytes, and the rank of every pair of tokens that joins to a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        # Pairs with their ranks in an open table: sorted by home, each at the first free place from there on.
        # Both share 63 bits, enough for a million tokens.
        self.bits = self.size.bit_length()
        keys = np.fromiter(pairs, np.int64, len(pairs))
        self.shift = np.uint64(64 - max(8, (4 * len(pairs)).bit_length()))
        home = self._home(keys)
        order, steps = np.argsort(home, kind="stable"), np.arange(len(keys))
        place = np.maximum.accumulate(home[order] - steps) + steps
        self.table = np.full((1 << (64 - int(self.shift))) + len(keys) + 1, -1, np.int64)
        self.table[place] = (keys << self.bits | np.fromiter(pairs.values(), np.int64, len(pairs)))[order]
        # Ranks of pairs of single bytes, by their ids, which lie below 256 or are remembered apart.
        known = self.byte.max() + 1
        self.first = np.full((known, known), -1, np.int32)
        left, right = self.byte[:, None], self.byte[None, :]
        self.first[left, right] = self.rank((left + 0 * right).ravel(), (right + 0 * left).ravel()).reshape(256, 256)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the joined pairs, or -1."""
        key = left * self.size + right
        at = self._home(key)
        found = self.table[at]
        out = np.where(found >> self.bits == key, found & ((1 << self.bits) - 1), -1)
        rest = np.flatnonzero((found >= 0) & (out < 0))
        while len(rest):
            at[rest] += 1
            found, wanted = self.table[at[rest]], key[rest]
            same = found >> self.bits == wanted
            out[rest[same]] = found[same] & ((1 << self.bits) - 1)
            rest = rest[(found >= 0) & ~same]
        return out

    def encode(self, pieces: Sequence[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        ids, counts = self.flat(pieces)
        ids, ends = ids.tolist(), np.cumsum(counts).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def flat(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces, one after another, and how many each piece has."""
        n = len(pieces)
        whole = np.fromiter(map(self.ranks.get, pieces, itertools.repeat(-1)), np.int64, n)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        data, starts = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths
        counts = (whole >= 0).astype(np.int64)
        parts = [(np.flatnonzero(counts), whole[whole >= 0])]
        for i in np.flatnonzero((whole < 0) & (lengths > IN_STEP)).tolist():
            ids = self._single(pieces[i])
            counts[i] = len(ids)
            parts.append((np.array([i]), np.array(ids, np.int64)))
        power = np.where((whole < 0) & (lengths > 0) & (lengths <= IN_STEP), np.frexp(lengths - 1)[1], -1)
        for k in range(IN_STEP.bit_length()):
            members = np.flatnonzero(power == k)
            for a in range(0, len(members), STEP):
                part = members[a : a + STEP]
                ids, counts[part] = self._in_step(gather(data, starts[part], lengths[part]), lengths[part], 1 << k)
                parts.append((part, ids))
        out, places = np.empty(int(counts.sum()), np.int32), np.cumsum(counts) - counts
        for part, ids in parts:
            out[stretches(places[part], counts[part])] = ids
        return out, counts

    def _in_step(self, data: np.ndarray, lengths: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces with at most ``leaves`` bytes each, and how many each has."""
        n, width = len(lengths), 2 * leaves
        kind = np.int32 if self.size * leaves < NONE32 else np.int64
        none = kind(NONE32 if kind is np.int32 else NONE)
        places = np.arange(leaves)
        inside = places < lengths[:, None]
        # One flat array each; a piece's part of it starts at its row.
        ids = np.full((n, leaves), -1, np.int64)
        ids[inside] = self.byte[data]
        after = np.where(places + 1 < lengths[:, None], places + 1, -1).ravel()
        before = np.tile(places - 1, n)
        rank = np.full((n, leaves), -1, np.int64)
        rank[:, :-1] = self.first[ids[:, :-1], ids[:, 1:]]
        tree = np.full((n, width), none, kind)
        tree[:, leaves:] = np.where((rank >= 0) & inside & (places + 1 < lengths[:, None]), rank * leaves + places, none)
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        ids, tree = ids.ravel(), tree.ravel()

        def put(root: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            """Set leaves, then renew their paths, a level at a time."""
            node = leaf + leaves
            tree[root + node] = value
            step = leaves
            while step > 1:
                node, step = node >> 1, step >> 1
                child = root + 2 * node
                tree[root + node] = np.minimum(tree[child], tree[child + 1])

        rows = np.flatnonzero(tree[1::width] < none)
        while len(rows):
            best = tree[rows * width + 1].astype(np.int64)
            row, at = rows * leaves, best % leaves
            here = row + at
            gone = after[here]
            following = after[row + gone]
            ids[here] = best // leaves
            ids[row + gone] = -1
            after[here] = following
            linked = np.flatnonzero(following >= 0)
            before[row[linked] + following[linked]] = at[linked]
            previous = before[here]
            has = np.flatnonzero(previous >= 0)
            r, p = row[has], previous[has]
            # Pairs that begin at the merged token, where it has a neighbour, and at the one before it.
            base = np.concatenate((row[linked], r))
            left = np.concatenate((at[linked], p))
            rank = self.rank(ids[base + left], ids[base + np.concatenate((following[linked], at[has]))])
            value = np.full(2 * len(row) + len(r), none, kind)
            value[np.concatenate((linked + len(row), np.arange(2 * len(row), len(value))))] = np.where(
                rank >= 0, rank * leaves + left, none
            )
            put(np.concatenate((row, row, r)) * 2, np.concatenate((gone, at, p)), value)
            rows = rows[tree[rows * width + 1] < none]
        live = ids >= 0
        return ids[live], live.reshape(n, leaves).sum(axis=1)

    def _single(self, piece: bytes) -> list[int]:
        n = len(piece)
        leaves, none, size, pairs = 1 << (n - 1).bit_length(), NONE, self.size, self.pairs
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = pairs.get(ids[i] * size + ids[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i, right):
            rank = pairs.get(ids[i] * size + ids[right]) if right >= 0 else None
            node = leaves + i
            tree[node] = none if rank is None else rank * leaves + i
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        while tree[1] < none:
            rank, at = divmod(tree[1], leaves)
            gone = after[at]
            following = after[gone]
            ids[at], ids[gone], after[at] = rank, -1, following
            if following >= 0:
                before[following] = at
            put(gone, -1)
            put(at, following)
            if before[at] >= 0:
                put(before[at], at)
        return [i for i in ids if i >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    """From a file with a base64 token and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for ``re``, for texts without characters above U+FFFF; None if it may differ.

    ``re`` takes half the time of ``regex`` but knows no Unicode properties and has its own white
    space. These classes are therefore spelled out, by the characters that ``regex`` finds.
    """
    basic = "".join(chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000)

    def members(kind: str) -> str:
        code = np.array([*map(ord, regex.findall(kind, basic))])
        first = np.flatnonzero(np.diff(code, prepend=-2) > 1)
        last = np.append(first[1:], len(code)) - 1
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(code[first].tolist(), code[last].tolist()))

    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|\[\^?|\(\?.|.", pattern, re.DOTALL):
        if part in (r"\p{L}", r"\p{N}", r"\s"):
            out.append(members(part) if inside else f"[{members(part)}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{members(part.lower())}]")
        elif part[0] == "\\" or (part[0] == "[" and inside) or (part[:2] == "(?" and part not in ("(?!", "(?:")):
            return None
        else:
            inside = part != "]" if inside else part[0] == "["
            out.append(part)
    return re.compile("".join(out))


class Encoder:
    """Encodes texts with a bounded cache of pieces; one per Python worker.

    A piece has a slot, and the ids of all slots lie one after another in one array.
    """

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pattern, self.plain = merges, regex.compile(pattern), plain_pattern(pattern)
        self.slots: dict[str, int] = {}
        self.held = np.empty(0, np.int32)
        self.counts = self.uses = np.empty(0, np.int64)
        # What every id is written as, followed by a space, and the bytes that it stands for.
        self.written = Spelling([b"%d " % i for i in range(merges.size)])
        self.bytes = Spelling(merges.tokens)

    def pieces(self, text: str) -> list[str]:
        return (self.pattern if self.plain is None or _WIDE.search(text) else self.plain).findall(text)

    def _forget(self) -> None:
        """Keep the pieces asked for most often, of equals the latest and no long ones; older uses weigh less."""
        short = np.flatnonzero(self.counts <= LONG)
        keep = np.sort(short[np.argsort(self.uses[short], kind="stable")[-CACHE:]])
        kept = np.zeros(len(self.uses), bool)
        kept[keep] = True
        self.held = self.held[np.repeat(kept, self.counts)]
        self.counts, self.uses = self.counts[keep], self.uses[keep] // 2
        pieces = itertools.compress(self.slots, kept.tolist())
        self.slots = {p: i for i, p in enumerate(pieces)}

    def _learn(self, pieces: list[str]) -> None:
        ids, counts = self.merges.flat([p.encode() for p in pieces])
        self.slots.update(zip(pieces, range(len(self.slots), len(self.slots) + len(pieces))))
        self.held, self.counts = np.concatenate((self.held, ids)), np.concatenate((self.counts, counts))
        self.uses = np.concatenate((self.uses, np.zeros(len(pieces), np.int64)))

    def ids(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has."""
        if max(len(self.slots), len(self.held) // LONG) > 2 * CACHE:
            self._forget()
        pieces, ends = [], [0]
        for text in texts:
            pieces += self.pieces(text)
            ends.append(len(pieces))
        slots = np.fromiter(map(self.slots.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        holes = np.flatnonzero(slots < 0)
        if len(holes):
            missing = [pieces[i] for i in holes.tolist()]
            self._learn(list(dict.fromkeys(missing)))
            slots[holes] = np.fromiter(map(self.slots.__getitem__, missing), np.int64, len(missing))
        self.uses += np.bincount(slots, minlength=len(self.uses))
        counts = self.counts[slots]
        ids = gather(self.held, (np.cumsum(self.counts) - self.counts)[slots], counts, GATHERED)
        return ids, np.diff(np.concatenate(([0], np.cumsum(counts)))[ends])

    def __call__(self, texts: Sequence[str]) -> list[str]:
        """Decimal ids of each text, joined by one space."""
        return [bytes(x[:-1]).decode() for x in self.written.of(*self.ids(texts))]


class Spelling:
    """What each id stands for."""

    def __init__(self, values: list[bytes]):
        self.lengths = np.fromiter(map(len, values), np.int64, len(values))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(values), np.uint8)

    def of(self, ids: np.ndarray, counts: np.ndarray) -> list[memoryview]:
        """The values of ids joined, for each run of as many ids as given."""
        lengths = self.lengths[ids]
        joined = memoryview(gather(self.data, self.starts[ids], lengths, GATHERED))
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(counts)].tolist()
        return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def decode(ids: Iterable[int], tokens) -> bytes:
    return b"".join([tokens[i] for i in ids])


def encode(docs: DataFrame, path: str, pattern: str, keep: Sequence[str] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Tokens of every document: ``keep``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The digests are those of the decimal ids, joined by a space, and of the bytes decoded from
    these ids. ``with_ids`` adds ``ids`` (array<int>). Special tokens are not recognised. A null
    text counts as empty: no tokens, digests of nothing. No shuffle; the vocabulary, read at
    ``path`` on the driver, is the only thing sent to the executors, and its size is fixed.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": read_ranks(path)})

    def make():
        held = shared.value  # a worker keeps it, and with it the encoder, from task to task
        encoder = held.get("encoder") or held.setdefault("encoder", Encoder(Merges(held["ranks"]), pattern))

        def compute(texts: list[bytes], _) -> list:
            ids, counts = encoder.ids([t.decode("utf-8", "replace") for t in texts])
            written = [hashlib.sha256(x[:-1]).hexdigest() for x in encoder.written.of(ids, counts)]
            decoded = [hashlib.sha256(x).hexdigest() for x in encoder.bytes.of(ids, counts)]
            columns = [pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, ids))
            return columns

        return compute

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_text(docs, keep, "text", schema, make, TEXT_BYTES)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary) to a table with token ids; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in read_ranks(path).items()})
    names = list(encoded.columns)

    def run(batches):
        tokens = shared.value
        for batch in batches:
            out = [None if x is None else decode(x, tokens) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    schema = encoded.select("*", F.lit(None).cast("binary").alias("decoded")).schema
    return encoded.mapInArrow(run, schema)
