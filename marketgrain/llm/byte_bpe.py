"""Byte-level BPE as a finite-state transducer, and streaming decoding by a UTF-8 state machine.

Encoding. Every prefix of a byte string has one BPE encoding, and it extends the encoding of a shorter prefix by one
token: the one whose pair with the token before it is left alone by the merges. So the merges compile into a
left-to-right machine. Its state is the set of positions from which a token may still be running (a place in the trie
of the vocabulary, and the tokens since those that are certain). A token is emitted as soon as all these positions
agree on it, which is after less than one longest token of lookahead.

The machine runs in two ways. The matches of a slice are short and many, and of invented or rare words hardly two reach
the same states; so their positions all run at once, by numpy, and the token that ends at a place judges those that
start there (``WideTransducer``). A long match goes through states that are made when they are first reached and whose
moves are kept (``Transducer``, lazy determinisation); the store of states is emptied when it reaches a fixed size,
which costs time and changes nothing.

Decoding. Tokens may end within a character. The decoder takes ids in blocks, hands out whole characters, and keeps the
bytes of an unfinished one as its state.

Whole texts are cut by the pattern; matches are encoded separately, the distinct ones of a slice once.
Nothing is shuffled, and memory is bounded by one slice of texts and the fixed sizes of the stores.

Defined results: a null text counts as empty (no tokens, digests of nothing); special strings are ordinary text;
repeated rows are coded one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from marketgrain.llm.shipping import ship
from marketgrain.llm.texts import slices, utf8
from marketgrain.llm.workers import released

RANKS = "byte_bpe_50k.tiktoken"
SLICE = 1 << 19
#: bytes of a match beyond which it goes through the determinised machine, whose memory doesn't grow with the match
LONG = 256
#: bytes of distinct matches that are encoded at once
BLOCK = 1 << 17
#: places for verdicts on pairs of tokens, a power of two; nine bytes each
CACHE = 1 << 20
#: entries of the determinised machine's stores, which are emptied beyond them
MAX_STATES = 30_000


class Merges:
    """Ranks of tokens, how each token is merged, and which pairs of tokens stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._edges: tuple[dict, dict] = {}, {}
        self._apart: dict[tuple[int, int], bool] = {}

    def merge(self, text: bytes, below: int) -> list[int]:
        """Merge single bytes by rank, using only ranks under ``below``."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(found)
            if best >= below:
                break
            at = found.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes ``token``; () for a byte; None if no merges make it."""
        if token not in self._parts:
            text = self.bytes[token]
            made = self.merge(text, token) if len(text) > 1 else []
            self._parts[token] = () if len(text) == 1 else tuple(made) if len(made) == 2 else None
        return self._parts[token]

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at one end while ``token`` is made, latest first, each with the rank that ends it."""
        found = self._edges[side].get(token)
        if found is None:
            found, ends, at = [], float("inf"), token
            while True:
                found.append((at, ends))
                pair = self.parts(at)
                if not pair:
                    break
                ends, at = at, pair[side]
            self._edges[side][token] = found
        return found

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges keep ``left`` and ``right`` as they are when one follows the other.

        Merges go by rank, the leftmost first among equals. A merge over the border happens if its rank comes
        before those that use up the tokens on its two sides. Only tokens that stand there at the same time
        matter, so the later made of the two is undone step by step.
        """
        key = (left, right)
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) > MAX_STATES:
                self._apart.clear()
            known = self._apart[key] = self._stay(self._edge(left, 1), self._edge(right, 0))
        return known

    def _stay(self, lefts: list[tuple[int, float]], rights: list[tuple[int, float]]) -> bool:
        i = j = 0
        while True:
            (a, left_end), (b, right_end) = lefts[i], rights[j]
            rank = self.ranks.get(self.bytes[a] + self.bytes[b])
            if rank is not None and rank < left_end and rank <= right_end:
                return False
            # single bytes are there from the start
            more_left, more_right = i + 1 < len(lefts), j + 1 < len(rights)
            if more_left and (a >= b or not more_right):
                i += 1
            elif more_right:
                j += 1
            else:
                return True


class Transducer:
    """Encodes byte strings one byte at a time."""

    def __init__(self, merges: Merges, max_states: int = MAX_STATES):
        self.merges, self.max_states = merges, max_states
        self.next: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for text, rank in merges.ranks.items():
            node = 0
            for byte in text:
                self.inner[node] = True
                child = self.next.setdefault(node << 8 | byte, len(self.token))
                if child == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
                node = child
            self.token[node] = rank
        self._clear()

    def _clear(self) -> None:
        # a state: the last certain token, and for each running position its trie node and uncertain tokens
        self.states: list[tuple] = [(None, ((0, ()),))]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        base, running = self.states[state]
        live, made = [], None
        for node, tail in running:
            child = self.next.get(node << 8 | byte)
            if child is None:
                continue
            if made is None and self.token[child] >= 0 and self.merges.parts(self.token[child]) is not None:
                token = self.token[child]
                before = tail[-1] if tail else base
                if before is None or self.merges.apart(before, token):
                    made = (*tail, token)
            if self.inner[child]:
                live.append((child, tail))
        live.append((0, made))
        sure, first = 0, live[0][1]
        while sure < len(first) and all([t[sure:sure + 1] == first[sure:sure + 1] for _, t in live]):
            sure += 1
        emitted = first[:sure]
        if sure:
            live = [(node, tail[sure:]) for node, tail in live]
            base = emitted[-1]
        key = (None if all([tail for _, tail in live]) else base, tuple(live))
        number = self.number.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        self.moves[state << 8 | byte] = move = number, emitted
        return move

    def stream(self, text: Iterable[int]) -> Iterator[int]:
        """Tokens of one match, each as soon as it is certain."""
        state, moves = 0, self.moves
        for byte in text:
            state, emitted = moves.get(state << 8 | byte) or self._move(state, byte)
            yield from emitted
        yield from self.states[state][1][-1][1]

    def encode(self, text: bytes) -> list[int]:
        """Tokens of one match; a match that is a token of the vocabulary is that token."""
        whole = self.merges.ranks.get(text)
        if whole is not None:
            return [whole]
        tokens, state, moves = [], 0, self.moves
        for byte in text:
            state, emitted = moves.get(state << 8 | byte) or self._move(state, byte)
            if emitted:
                tokens += emitted
        tokens += self.states[state][1][-1][1]
        if len(self.states) > self.max_states:
            self._clear()
        return tokens


class Table:
    """A fixed map from integers to integers over numpy arrays; -1 for keys that it does not have."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = np.uint64(64 - max(1, 2 * len(keys)).bit_length())
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys = np.append(keys[order], -1)
        self.values = np.append(values[order], -1).astype(np.int32)
        count = np.bincount(slot, minlength=1 << 64 - int(self.bits))
        self.first = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
        self.probes = int(count.max(initial=0))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.bits).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        at, end = self.first[slot], self.first[slot + 1]
        # behind the last entry there is one without a key, and an entry of another slot never has the key
        out = np.where(self.keys[at] == keys, self.values[at], -1)
        open_ = np.flatnonzero((out < 0) & (at + 1 < end))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            place = at[open_] + probe
            hit = self.keys[place] == keys[open_]
            out[open_[hit]] = self.values[place[hit]]
            open_ = open_[~hit & (place + 1 < end[open_])]
        return out


class WideTransducer:
    """The same machine run over many short matches at once, without determinisation: memory depends on the vocabulary.

    All positions of all matches run through the trie together. Then, start by start, the tokens that begin there are
    judged by the token that ends there: the one that the merges leave alone is the last token of its prefix.
    """

    def __init__(self, merges: Merges):
        ids = np.array(sorted(merges.bytes), np.int64)
        self.count = int(ids[-1]) + 1 if len(ids) else 0
        self.length = np.zeros(self.count, np.int64)
        self.length[ids] = [len(merges.bytes[i]) for i in ids.tolist()]
        self._trie(merges, ids)
        self._splits(merges)
        self.seen = np.full(CACHE, -1, np.int64)
        self.verdict = np.zeros(CACHE, bool)

    def _trie(self, merges: Merges, ids: np.ndarray) -> None:
        """Nodes level by level; a node is a prefix of a token."""
        data = np.frombuffer(b"".join([merges.bytes[i] for i in ids.tolist()]), np.uint8)
        size = self.length[ids]
        start = np.cumsum(size) - size
        node = np.zeros(len(ids), np.int64)
        keys, total, token = [], 1, [np.full(1, -1, np.int64)]
        for depth in range(int(size.max(initial=0))):
            on = np.flatnonzero(size > depth)
            made, which = np.unique(node[on] << 8 | data[start[on] + depth], return_inverse=True)
            node[on] = total + which
            here = np.full(len(made), -1, np.int64)
            whole = size[on] == depth + 1
            here[which[whole]] = ids[on[whole]]
            keys.append(made)
            token.append(here)
            total += len(made)
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.edges = Table(keys, np.arange(1, total))
        self.token = np.concatenate(token).astype(np.int32)
        self.inner = np.zeros(total, bool)
        self.inner[keys >> 8] = True

    def _splits(self, merges: Merges) -> None:
        """Ranks of pairs that make a token, and the two tokens of each token's last merge (-1: none make it, -2: a byte)."""
        ranks = merges.ranks
        found = [
            (left, right, token) for text, token in ranks.items() for i in range(1, len(text))
            if (left := ranks.get(text[:i])) is not None and (right := ranks.get(text[i:])) is not None
        ]
        left, right, token = np.array(found, np.int64).reshape(-1, 3).T
        self.ranks = Table(left * self.count + right, token)
        self.left = np.full(self.count, -1, np.int32)
        self.left[self.length == 1] = -2
        self.right = self.left.copy()
        early = (left < token) & (right < token)
        left, right, token = left[early], right[early], token[early]
        size = self.length[token]
        # shorter tokens first: the halves must be known
        for n in range(2, int(size.max(initial=0)) + 1):
            at = np.flatnonzero(size == n)
            at = at[(self.left[left[at]] != -1) & (self.left[right[at]] != -1)]
            at = at[self._stay(left[at], right[at], token[at])]
            self.left[token[at]], self.right[token[at]] = left[at], right[at]

    def _stay(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """``Merges.apart`` for many pairs; with ``below`` only merges of lower rank count."""
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        left_end = right_end = np.full(len(a), np.iinfo(np.int32).max, np.int64)
        while len(at):
            rank = self.ranks.find(a * np.int64(self.count) + b)
            merged = (rank >= 0) & (rank < left_end) & (rank <= right_end)
            if below is not None:
                merged &= rank < below
            out[at[merged]] = False
            more_left, more_right = self.left[a] >= 0, self.left[b] >= 0
            go = ~merged & (more_left | more_right)
            lefts = more_left & ((a >= b) | ~more_right)
            left_end, right_end = np.where(lefts, a, left_end)[go], np.where(lefts, right_end, b)[go]
            a, b = np.where(lefts, self.right[a], a)[go], np.where(lefts, b, self.left[b])[go]
            at, below = at[go], None if below is None else below[go]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_stay`` with a store of verdicts of fixed size, in which a new pair takes an old one's place."""
        pair = a * np.int64(self.count) + b
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - CACHE.bit_length() + 1)).astype(np.int64)
        out = self.verdict[slot]
        new = np.flatnonzero(self.seen[slot] != pair)
        if len(new):
            out[new] = made = self._stay(a[new], b[new])
            place = slot[new]
            self.seen[place] = pair[new]
            # of several pairs for one place the last one stays
            kept = self.seen[place] == pair[new]
            self.verdict[place[kept]] = made[kept]
        return out

    def _runs(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where tokens may start in ``data``, and these tokens; ``ends``: where the match of each byte ends."""
        starts, tokens = [], []
        at, node, depth = np.arange(len(data), dtype=np.int32), np.zeros(len(data), np.int32), 0
        while len(at):
            child = self.edges.find(node.astype(np.int64) << 8 | data[at + depth])
            on = child >= 0
            at, node = at[on], child[on]
            depth += 1
            token = self.token[node]
            # a token that no merges make occurs as a whole match only
            made = np.flatnonzero(token >= 0)
            made = made[self.left[token[made]] != -1]
            starts.append(at[made])
            tokens.append(token[made])
            on = self.inner[node] & (at + depth < ends[at])
            at, node = at[on], node[on]
        return np.concatenate(starts), np.concatenate(tokens)

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The token that each match is, or -1."""
        out = np.full(len(offsets) - 1, -1, np.int32)
        at, node, depth = np.arange(len(out)), np.zeros(len(out), np.int32), 0
        size = np.diff(offsets)
        while len(at):
            node = self.edges.find(node.astype(np.int64) << 8 | data[offsets[at] + depth])
            depth += 1
            on = node >= 0
            done = on & (size[at] == depth)
            out[at[done]] = self.token[node[done]]
            on &= size[at] > depth
            at, node = at[on], node[on]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches in a row, and where each match's ids start; no match is empty."""
        whole = self._whole(data, offsets)
        left = np.flatnonzero(whole < 0)
        size = np.diff(offsets)[left]
        made, sizes = [], np.ones(len(whole), np.int64)
        block = np.cumsum(size) // BLOCK
        for begin, end in itertools.pairwise([0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(left)]):
            which = left[begin:end]
            ids, sizes[which] = self._encode(data[gather(offsets[:-1][which], size[begin:end])], size[begin:end])
            made.append(ids)
        ids = np.concatenate(made)
        out = np.empty(sizes.sum(), np.uint32)
        at = np.concatenate(([0], np.cumsum(sizes)))
        out[gather(at[left], sizes[left])] = ids
        out[at[:-1][whole >= 0]] = whole[whole >= 0]
        return out, at

    def _encode(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches in a row, and how many each has."""
        if not len(size):
            return np.zeros(0, np.int32), size
        first = np.cumsum(size) - size
        starts, tokens = self._runs(data, np.repeat(first + size, size))
        # by place in the match: what ends at a place is known before what starts there is judged
        place = (starts - np.repeat(first, size)[starts]).astype(np.uint16)
        order = np.argsort(place, kind="stable")
        starts, tokens = starts[order], tokens[order]
        cut = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=1))))
        # the last token of the prefix that ends with each byte
        last = np.full(len(data), -1, np.int32)
        for i, (begin, end) in enumerate(itertools.pairwise(cut.tolist())):
            at, token = starts[begin:end], tokens[begin:end]
            if i:
                stays = self.apart(last[at - 1], token)
                at, token = at[stays], token[stays]
            last[at + self.length[token] - 1] = token
        # back from the ends
        ends = np.zeros(len(data), bool)
        at = first + size - 1
        while len(at):
            ends[at] = True
            at = at - self.length[last[at]]
            going = at >= first
            at, first = at[going], first[going]
        return last[ends], np.add.reduceat(ends, np.cumsum(size) - size, dtype=np.int64)


class Utf8Decoder:
    """Bytes of token ids, handed out in whole characters, block by block."""

    def __init__(self, token_bytes: dict[int, bytes]):
        tokens = [token_bytes.get(i, b"") for i in range(max(token_bytes, default=-1) + 1)]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pending = b""

    @staticmethod
    def unfinished(text: bytes) -> int:
        """Number of bytes at the end that begin a character which is not complete."""
        for back in range(1, min(3, len(text)) + 1):
            byte = text[-back]
            if byte >= 0xC0:
                width = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < width else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, ids: np.ndarray) -> bytes:
        """The characters that these ids complete; unfinished bytes stay for the next block."""
        text = self.pending + self.data[gather(self.start[ids], self.size[ids])].tobytes()
        left = self.unfinished(text)
        self.pending = text[len(text) - left:]
        return text[:len(text) - left]

    def close(self) -> bytes:
        """What is left at the end of the ids."""
        text, self.pending = self.pending, b""
        return text

    def decode(self, ids: np.ndarray, block: int = 1 << 16) -> bytes:
        return b"".join([self.feed(ids[i:i + block]) for i in range(0, len(ids), block)] + [self.close()])


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``start``, one after the other."""
    ends = np.cumsum(size)
    if not len(ends):
        return ends
    return np.repeat(start - ends + size, size) + np.arange(ends[-1])


#: kinds of characters in the pattern
LETTER, NUMBER, SPACE, OTHER = range(4)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    text = "".join(every)
    for kind, expression in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        table[[ord(c) for c in regex.findall(expression, text)]] = kind
    return table


CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def match_starts(points: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Where matches of public_tokenizers.PATTERN start; they tile each text. ``border``: where texts start.

    Runs of one kind are matches. Of a run of white space before something else the last character is a match of its
    own, or belongs to what follows if it is a space. An apostrophe that starts a match takes s, t, re, ... with it.
    """
    count = len(points)
    kind = kinds()[points]
    start = border.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before other characters of the same text
    last = np.zeros(count, bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~border[1:]
    at = np.flatnonzero(last)
    start[at] = True
    start[at[points[at] == 32] + 1] = False
    # an apostrophe that stands alone in its run, with no space in front, and letters after it
    quote = np.flatnonzero((points == 39) & start)
    quote = quote[quote + 1 < count]
    quote = quote[start[quote + 1] & ~border[quote + 1]]
    taken = np.zeros(len(quote), bool)
    room = np.concatenate((points, np.zeros(2, points.dtype)))
    edge = np.concatenate((border, np.ones(2, bool)))
    for letters in CONTRACTIONS:
        fits = ~taken
        for i, letter in enumerate(letters, 1):
            fits &= (room[quote + i] == ord(letter)) & ~edge[np.minimum(quote + i, count)]
        found = quote[fits]
        taken |= fits
        start[found + 1] = False
        after = found + 1 + len(letters)
        start[after[after < count]] = True
    return start


class Codec:
    """Encodes whole texts: the distinct matches of a slice at once, long ones by the determinised machine."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.wide = WideTransducer(self.merges)
        self.decoder = Utf8Decoder(self.merges.bytes)

    @cached_property
    def machine(self) -> Transducer:
        return Transducer(self.merges)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches (``offsets``: where they start in ``data``, and its end), and where each one's ids start."""
        long = np.diff(offsets) > LONG
        if not long.any():
            return self.wide.encode(data, offsets)
        made = [self.machine.encode(data[offsets[i]:offsets[i + 1]].tobytes()) for i in np.flatnonzero(long)]
        size = np.diff(offsets)[~long]
        ids, ends = self.wide.encode(data[gather(offsets[:-1][~long], size)], np.concatenate(([0], np.cumsum(size))))
        sizes = np.empty(len(long), np.int64)
        sizes[long] = [len(m) for m in made]
        sizes[~long] = np.diff(ends)
        out = np.empty(sizes.sum(), np.uint32)
        slow = np.repeat(long, sizes)
        out[slow] = [i for m in made for i in m]
        out[~slow] = ids
        return out, np.concatenate(([0], np.cumsum(sizes)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of the texts in them."""
        data, offsets = utf8(column)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        if not len(points):
            return points, np.zeros(len(offsets), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        begins = lead[match_starts(points, border[lead])]
        del points, lead, border
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)]
        ).dictionary_encode()
        code = words.indices.to_numpy()
        flat, starts = self.matches(*utf8(words.dictionary))
        sizes = np.diff(starts)[code]
        ids = flat[gather(starts[code], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return ids, ends[np.searchsorted(begins, offsets)]


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return Codec(ranks)


def round_trip(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document, and on demand the ids as ``ids`` (binary)."""
    ship(docs.sparkSession)
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        coder = codec(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, ends = coder.encode(part.column("text"))
                packed = ids.astype("<u4").view(np.uint8)
                spans = list(zip(ends[:-1], ends[1:], strict=True))
                ids_digest = [hashlib.sha256(packed[4 * a:4 * b]).hexdigest() for a, b in spans]
                text_digest = [hashlib.sha256(coder.decoder.decode(ids[a:b])).hexdigest() for a, b in spans]
                columns = [part.column("doc_id"), pa.array(np.diff(ends)), pa.array(ids_digest, pa.string()),
                           pa.array(text_digest, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array([packed[4 * a:4 * b].tobytes() for a, b in spans], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(released(run), schema)
