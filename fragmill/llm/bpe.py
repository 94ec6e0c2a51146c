"""Byte-level BPE: encoding by a finite-state transducer, decoding by an incremental UTF-8 machine."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

#: States and boundaries that are remembered at a time; each is emptied when full.
MAX_STATES = 100_000
MAX_HELD = 400_000
#: Pieces of a generation: when it is full it becomes the old one, in which pieces are still found.
MAX_PIECES = 400_000
#: Marks, by hash, of pieces that were met once; all are taken away when half are set.
MARKS = 1 << 21
#: Longer pieces are encoded without being remembered.
LONG_PIECE = 64
#: Characters of a text that are matched at once, and of texts in one batch of results.
AT_ONCE = 1 << 20
BATCH_CHARS = 1 << 22

Entry = tuple[int, int]


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file of lines "base64 rank"."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Merges:
    """What a rank file says about boundaries between tokens.

    A boundary between two tokens holds if undoing their merges, the latest
    first, never shows a pair across it that an earlier merge would have joined.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.parts = {rank: self._parts(token, rank) for token, rank in ranks.items() if len(token) > 1}
        #: Tokens that merging their own bytes does not give; a piece is such a token only as a whole.
        self.apart = {rank for rank, parts in self.parts.items() if len(parts) != 2}

    def _parts(self, token: bytes, limit: int) -> tuple[int, ...]:
        """What merges below the limit make of the bytes of a token."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
            if best >= limit:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts)

    def holds(self, left: int, right: int) -> bool:
        """Whether a boundary between two tokens stays when all merges are done."""
        limit = 1 << 62
        while True:
            joined = self.ranks.get(self.bytes[left] + self.bytes[right])
            if joined is not None and joined < limit:
                return False
            of_left, of_right = self.parts.get(left), self.parts.get(right)
            if of_left and (not of_right or left > right):
                # The joined pair would be right of this merge: only an earlier rank comes first.
                limit, left = left, of_left[-1]
            elif of_right:
                # It would be left of this merge, so an equal rank comes first too.
                limit, right = right + 1, of_right[0]
            else:
                return True


class Transducer:
    """Merges as a transducer from bytes to tokens, determinised as texts need it.

    A nondeterministic state is a place in the trie of tokens and the token before
    it; exactly one token ends at each byte, the last of what the bytes so far
    would be. A deterministic state is the set of those alive. Its step on a byte
    gives the next set and the token that ends there. What all that are alive
    agree on is emitted: everything once a single one is left, and, where a piece
    is long, the common beginning after each window. No alive state is older than
    the longest token, so the lookahead is bounded.
    """

    #: Bytes of a long piece after which the common beginning is emitted.
    WINDOW = 4096
    #: Bytes up to which a piece is read by remembered steps.
    SHORT = 48

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.child: dict[int, int] = {}
        self.token: list[int | None] = [None]
        self.depth = [0]
        self.leaf = [True]
        for token, rank in merges.ranks.items():
            if rank not in merges.apart:
                node = 0
                for byte in token:
                    key, above = node << 8 | byte, node
                    node = self.child.get(key, 0)
                    if not node:
                        self.leaf[above] = False
                        node = self.child[key] = len(self.token)
                        self.token.append(None)
                        self.depth.append(self.depth[above] + 1)
                        self.leaf.append(True)
                self.token[node] = rank
        self.length = {rank: len(token) for token, rank in merges.ranks.items()}
        self.held: dict[int, bool] = {}
        self._empty()

    def _empty(self) -> None:
        start: tuple[Entry, ...] = ((0, -1),)
        self.states = [start]
        self.number = {start: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def _step(self, state: tuple[Entry, ...], byte: int) -> tuple[tuple[Entry, ...], int]:
        """The state after a byte, and the token that ends with it."""
        alive: list[Entry] = []
        ended = -1
        for node, before in state:
            node = self.child.get(node << 8 | byte, 0)
            if node:
                token = self.token[node]
                if ended < 0 and token is not None and (before < 0 or self._holds(before, token)):
                    ended = token
                if not self.leaf[node]:
                    alive.append((node, before))
        assert ended >= 0, "a rank file has a token for every byte"
        alive.append((0, ended))
        return tuple(alive), ended

    def _holds(self, before: int, token: int) -> bool:
        key = before << 32 | token
        found = self.held.get(key)
        if found is None:
            if len(self.held) >= MAX_HELD:
                self.held.clear()
            found = self.held[key] = self.merges.holds(before, token)
        return found

    def _keep(self, at: int, byte: int, state: tuple[Entry, ...], token: int) -> None:
        """Remembers a step, after forgetting all if memory is full."""
        if len(self.states) >= MAX_STATES:
            self._empty()
            return
        to = self.number.setdefault(state, len(self.states))
        if to == len(self.states):
            self.states.append(state)
        self.steps[at << 8 | byte] = (to, token)

    def _back(self, last: list[int], end: int) -> list[int]:
        """The tokens of the first bytes, by the token that ends with each."""
        out = []
        while end:
            token = last[end - 1]
            out.append(token)
            end -= self.length[token]
        return out[::-1]

    def tokens(self, data: bytes) -> list[int]:
        """The tokens of a piece."""
        if len(data) > self.SHORT:
            return [token for part in self.stream(data) for token in part]
        at, last, steps = 0, [], self.steps
        for n, byte in enumerate(data):
            found = steps.get(at << 8 | byte)
            if found is None:
                # One new step is remembered for each piece: what follows is likely a rare ending.
                self._keep(at, byte, *self._step(self.states[at], byte))
                self._finish(data, n, last)
                break
            at, token = found
            last.append(token)
        return self._back(last, len(last))

    def _finish(self, data: bytes, begun: int, last: list[int]) -> None:
        """Adds the token that ends with each byte from the given one on, by the nondeterministic machine.

        It is the only token that ends there and whose boundary with the one that
        ends where it begins holds.
        """
        rank, held, apart = self.merges.ranks.get, self.held.get, self.merges.apart
        for end in range(begun + 1, len(data) + 1):
            for start in range(end - 1, -1, -1):
                token = rank(data[start:end])
                if token is not None and token not in apart:
                    if not start:
                        break
                    before = last[start - 1]
                    found = held(before << 32 | token)
                    if self._holds(before, token) if found is None else found:
                        break
            last.append(token)

    def stream(self, data: Iterable[int]) -> Iterator[list[int]]:
        """The tokens of bytes, as far as they are certain after each window; then the rest."""
        state, last = self.states[0], []
        for byte in data:
            state, token = self._step(state, byte)
            last.append(token)
            if len(last) >= self.WINDOW:
                ways = [self._back(last, len(last) - self.depth[node]) for node, _ in state]
                sure = 0
                while all(len(w) > sure and w[sure] == ways[0][sure] for w in ways):
                    sure += 1
                if sure:
                    yield ways[0][:sure]
                    last = last[sum(self.length[t] for t in ways[0][:sure]) :]
        yield self._back(last, len(last))


class Utf8:
    """An incremental UTF-8 machine: bytes in, characters out as soon as they are whole.

    What is malformed gives U+FFFD, once for each longest part that could begin a
    character. A state is (bytes to come, bits so far, bounds of the next byte).
    """

    START = (0, 0, 0x80, 0xBF)

    @classmethod
    def feed(cls, state: tuple[int, int, int, int], data: bytes) -> tuple[str, tuple[int, int, int, int]]:
        out = []
        left, bits, low, high = state
        for byte in data:
            if left:
                if low <= byte <= high:
                    left, bits, low, high = left - 1, bits << 6 | byte & 0x3F, 0x80, 0xBF
                    if not left:
                        out.append(chr(bits))
                    continue
                out.append("�")
                left, low, high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xDF:
                left, bits = 1, byte & 0x1F
            elif 0xE0 <= byte <= 0xEF:
                left, bits = 2, byte & 0x0F
                low, high = 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
            elif 0xF0 <= byte <= 0xF4:
                left, bits = 3, byte & 0x07
                low, high = 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
            else:
                out.append("�")
        return "".join(out), (left, bits, low, high) if left else cls.START

    @classmethod
    def end(cls, state: tuple[int, int, int, int]) -> str:
        return "�" if state[0] else ""


class Codec:
    """Texts to packed tokens (unsigned 32-bit, little-endian) and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.transducer = Transducer(Merges(ranks))
        self.pattern = regex.compile(pattern)
        self.pieces = _Pieces(self)
        self.bytes = self.transducer.merges.bytes
        #: Of a state of the UTF-8 machine, what tokens give there and the state after.
        self.turns: dict[tuple, dict[int, tuple[str, tuple]]] = {}
        fed = ((rank, Utf8.feed(Utf8.START, token)) for token, rank in ranks.items())
        self.whole = {rank: text for rank, (text, state) in fed if state == Utf8.START}
        #: Whether a token begins or ends within a character.
        self.broken = np.ones(max(ranks.values(), default=-1) + 1, bool)
        self.broken[list(self.whole)] = False

    def piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        return array("I", self.transducer.tokens(data) if whole is None else [whole]).tobytes()

    def encode(self, text: str) -> bytes:
        get = self.pieces.__getitem__
        if len(text) <= AT_ONCE:
            return b"".join(map(get, self.pattern.findall(text)))
        found = batched((m[0] for m in self.pattern.finditer(text)), 1 << 16)
        return b"".join(b"".join(map(get, part)) for part in found)

    def decode(self, packed: bytes) -> str:
        return "".join(self.stream([array("I", packed)]))

    def _turn(self, state: tuple[int, int, int, int], token: int) -> tuple[str, tuple[int, int, int, int]]:
        """What a token gives in a state of the UTF-8 machine, and the state after."""
        turns = self.turns.setdefault(state, {})
        if token not in turns:
            text, after = Utf8.feed(state, self.bytes[token])
            turns[token] = text, Utf8.START if after == Utf8.START else after
        return turns[token]

    def stream(self, chunks: Iterable[Iterable[int]]) -> Iterator[str]:
        """The text of tokens that come in chunks; a character may lie across tokens and chunks."""
        state = Utf8.START
        for chunk in chunks:
            at = np.asarray(chunk, np.int64)
            broken = np.flatnonzero(self.broken[at]).tolist()
            tokens, end = at.tolist(), 0
            texts = list(map(self.whole.get, tokens))
            # Where a character is cut, the machine reads on until it is whole.
            for begun in broken if state is Utf8.START else [0, *broken]:
                if begun >= end:
                    end = begun
                    while end < len(tokens):
                        texts[end], state = self._turn(state, tokens[end])
                        end += 1
                        if state is Utf8.START:
                            break
            yield "".join(texts)
        yield Utf8.end(state)


class _Pieces(dict):
    """Packed tokens of pieces met at least twice; what the last two generations do not use is forgotten.

    Most different pieces of a corpus stand in it once, and would fill a worker's
    memory. A first meeting leaves a mark only; two pieces with one mark are
    remembered too early, which changes no result.
    """

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec
        self.old: dict[str, bytes] = {}
        self.marks, self.marked = bytearray(MARKS), 0

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        again = packed is not None
        if not again:
            packed = self.codec.piece(piece)
        if len(piece) <= LONG_PIECE and (again or self._met(piece)):
            if len(self) >= MAX_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def _met(self, piece: str) -> bool:
        """Whether the piece was met before; it is from now on."""
        at = hash(piece) % MARKS
        if self.marks[at]:
            return True
        if self.marked >= MARKS // 2:
            self.marks, self.marked = bytearray(MARKS), 0
        self.marks[at] = 1
        self.marked += 1
        return False


def _codec(data: bytes, pattern: str) -> Codec:
    """One codec in each Python worker."""
    return kept(("codec", hash(data), pattern), lambda: Codec(parse_ranks(data), pattern))


def _mapped(df: DataFrame, id_col: str, value_col: str, kind: str, ranks: bytes, pattern: str, work, fields: pa.Schema, ddl: str) -> DataFrame:
    """work(codec, value) of every row, in batches of bounded size."""
    held = df.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary file, whose size does not grow with the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value, pattern)
        ids, rows, size = [], [], 0

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip([ids, *zip(*rows)], fields)]
            return pa.RecordBatch.from_arrays(columns, schema=fields)

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                value = value.as_py()
                ids.append(key.as_py())
                rows.append(work(codec, value))
                size += len(value or "")
                if size >= BATCH_CHARS:
                    yield made()
                    ids, rows, size = [], [], 0
        if ids:
            yield made()

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(value_col).cast(kind).alias("value")).mapInArrow(run, ddl)


def read_ranks(path: str) -> bytes:
    """The rank file, read where the driver runs."""
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens array<int>) of every whole text, one row for each row.

    Each match of the pattern is encoded alone, without special tokens. Null and
    empty texts have no tokens; ids may be null or repeated. Other columns are not
    read.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("tokens", pa.list_(pa.int32()))])
    work = lambda codec, text: (np.frombuffer(codec.encode(text or ""), "<i4"),)
    return _mapped(df, id_col, text_col, "string", ranks, pattern, work, fields, "doc_id long, tokens array<int>")


def decode(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(doc_id, text) of every row of tokens; no tokens, or null, give the empty text."""
    fields = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    work = lambda codec, tokens: ("".join(codec.stream([tokens or []])),)
    return _mapped(df, id_col, tokens_col, "array<int>", ranks, pattern, work, fields, "doc_id long, text string")


def round_trip(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, packed binary, decoded string): tokens as unsigned 32-bit little-endian integers, and what they decode to."""
    fields = pa.schema([("doc_id", pa.int64()), ("packed", pa.binary()), ("decoded", pa.string())])

    def work(codec: Codec, text: str | None) -> tuple[bytes, str]:
        packed = codec.encode(text or "")
        return packed, codec.decode(packed)

    return _mapped(df, id_col, text_col, "string", ranks, pattern, work, fields, "doc_id long, packed binary, decoded string")
