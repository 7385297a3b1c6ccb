"""Byte-level BPE as a lazily determinised finite-state transducer.

Merging by rank has one result for each piece, and a sequence of tokens is that
result exactly if each adjacent pair is what merging the pair's own bytes
gives.  So a nondeterministic transducer has for states (last whole token, node
of the vocabulary's trie), reads a byte at a time and may close a token where
the pair with the last one holds.  Its subset construction is done on demand: a
deterministic state is the set of open hypotheses with the tokens that are not
yet common to all of them; a token is emitted as soon as every hypothesis has
it, which is after a bounded lookahead.  States are kept up to a limit and then
built anew.

Decoding looks ids up in one table of bytes and runs an incremental UTF-8 state
machine, so a stream can be cut between any two ids.

Null texts count as empty and give no ids.  Repeated and tied rows are encoded
alike.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm.pieces import PieceEncoder
from graphloom.llm.store import ship
from graphloom.llm.texts import chunks, only, take_columns

_ROOT = 0
#: Bytes of a piece after which states are not kept: few pieces share more.
DEPTH = 6


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from the two-column base64 file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most_states: int = 200_000):
        self.ranks, self.most_states = ranks, most_states
        self.words = {v: k for k, v in ranks.items()}
        self.pairs: dict[int, bool] = {}
        # the last merge of each token: its halves, and the token of two halves
        self.left, self.right, self.joined = {}, {}, {}
        # the trie: (node << 8 | byte) -> node, and node -> token
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        for word, rank in ranks.items():
            if len(word) > 1:
                halves = self.merge(word, 2)
                if len(halves) != 2 or self.merge(word) != [rank]:
                    continue  # no merge leads to it: only a piece equal to it gives it
                self.left[rank], self.right[rank] = halves
                self.joined[halves[0], halves[1]] = rank
            node = _ROOT
            for byte in word:
                edge = node << 8 | byte
                if edge not in self.child:
                    self.child[edge] = len(self.token)
                    self.token.append(-1)
                node = self.child[edge]
            self.token[node] = rank
        self._reset()

    def _reset(self) -> None:
        begin = ((-1, _ROOT, ()),)
        self.state_of = {begin: 0}
        self.states = [begin]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.final: dict[int, tuple[int, ...]] = {}

    def merge(self, piece: bytes, down_to: int = 1) -> list[int]:
        """The definition: join the adjacent pair of lowest rank, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > down_to:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[x] for x in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both gives both.

        Merges are undone from the latest: while the touching parts exist, a
        merge of them with an earlier rank would have come first.
        """
        if len(self.pairs) > 400_000:
            self.pairs.clear()
        x, y, until, good = a, b, 1 << 60, True
        while a >= 0:  # a piece's first token has no left neighbour
            z = self.joined.get((x, y))
            if z is not None and z < until:
                good = False
                break
            # the later of the two outer merges goes; of equal ones, the right
            part_x, part_y = self.right.get(x), self.left.get(y)
            if part_x is None and part_y is None:
                break
            if part_y is None or (part_x is not None and x > y):
                until, x = x, part_x
            else:
                until, y = y + 1, part_y
        self.pairs[a << 24 | b] = good
        return good

    def _step(self, held: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """From the open readings of a piece: those after one more byte, and the tokens now certain."""
        child, token, pairs = self.child.get, self.token, self.pairs.get
        reached = []
        for last, node, kept in held:
            node = child(node << 8 | byte)
            if node is None:
                continue
            reached.append((last, node, kept))
            t = token[node]
            if t >= 0:
                good = pairs(last << 24 | t)
                if good or (good is None and self.fits(last, t)):
                    reached.append((t, _ROOT, (*kept, t)))
        shortest = min([h[2] for h in reached], key=len)
        shared = 0
        while shared < len(shortest) and all([h[2][shared] == shortest[shared] for h in reached]):
            shared += 1
        emitted = shortest[:shared]
        return tuple([(last, node, kept[shared:]) for last, node, kept in reached] if shared else reached), emitted

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Build one transition: (next state, tokens now certain)."""
        key, emitted = self._step(self.states[state], byte)
        to = self.state_of.get(key)
        if to is None:
            to = self.state_of[key] = len(self.states)
            self.states.append(key)
        self.moves[state << 8 | byte] = out = (to, emitted)
        return out

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.most_states:
            self._reset()
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in piece[:DEPTH]:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        if len(piece) > DEPTH:
            held = self.states[state]
            for byte in piece[DEPTH:]:
                held, emitted = self._step(held, byte)
                out += emitted
            return out + list(next((kept for _, node, kept in held if node == _ROOT), ()))
        rest = self.final.get(state)
        if rest is None:
            rest = self.final[state] = next((kept for _, node, kept in self.states[state] if node == _ROOT), ())
        out += rest
        return out


# -- decoding ---------------------------------------------------------------

#: State 0 accepts; 1 to 7 wait for continuation bytes; 8 rejects.  Rows are
#: states, and each names the range of the next byte and the state after it.
_WAITS = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0xA0, 0xBF, 1), 4: (0x80, 0x9F, 1), 5: (0x80, 0xBF, 2), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}


def _lead(byte: int) -> int:
    if byte < 0x80:
        return 0
    if 0xC2 <= byte <= 0xDF:
        return 1
    if byte in (0xE0, 0xED):
        return 3 if byte == 0xE0 else 4
    if 0xE1 <= byte <= 0xEF:
        return 2
    if 0xF0 <= byte <= 0xF4:
        return {0xF0: 6, 0xF4: 7}.get(byte, 5)
    return 8


class Utf8Stream:
    """Feeds of bytes to text; what an unfinished character has so far waits
    for the next feed.  Ill-formed input raises ``ValueError``."""

    def __init__(self) -> None:
        self.state, self.waiting, self.runs = 0, b"", {}

    def _run(self, state: int, run: bytes) -> tuple[int, int]:
        """(state after, bytes up to the last whole character)."""
        whole = 0
        for i, byte in enumerate(run):
            if state:
                low, high, after = _WAITS[state]
                state = after if low <= byte <= high else 8
            else:
                state = _lead(byte)
            if state == 8:
                raise ValueError(f"ill-formed UTF-8 at {run[i : i + 4]!r}")
            if not state:
                whole = i + 1
        return state, whole

    def feed(self, data: bytes) -> str:
        """The characters that are whole by now."""
        data = self.waiting + data
        self.state, self.waiting = 0, b""
        if data.isascii():
            return data.decode("ascii")
        high = np.frombuffer(data, np.uint8) >= 0x80
        edge = np.flatnonzero(np.diff(np.concatenate([[False], high, [False]]).astype(np.int8)))
        cut = len(data)
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            run = data[a:b]
            known = self.runs.get(run)
            if known is None:
                known = self._run(0, run)
                if len(run) < 64 and len(self.runs) < 65536:
                    self.runs[run] = known
            if known[0]:
                if b < len(data):
                    raise ValueError(f"ill-formed UTF-8: {run[known[1] : known[1] + 4]!r} is not ended")
                self.state, cut = known[0], a + known[1]
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8")

    def close(self) -> None:
        if self.waiting:
            raise ValueError("the text ends within a character")


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        words = [b""] * size
        for word, rank in ranks.items():
            words[rank] = word
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        self.size = np.fromiter(map(len, words), np.int64, size)
        self.base = np.cumsum(self.size) - self.size

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        until = np.cumsum(size)
        if not len(until):
            return np.zeros(0, np.uint8)
        return self.flat[np.arange(until[-1]) + np.repeat(self.base[ids] - until + size, size)]

    def texts(self, ids: np.ndarray, block: int = 65536) -> Iterator[str]:
        """The text of a stream of ids, in parts."""
        stream = Utf8Stream()
        for k in range(0, len(ids), block):
            yield stream.feed(self.bytes_of(ids[k : k + block]).tobytes())
        stream.close()


_CODECS: dict[str, tuple[PieceEncoder, Decoder]] = {}


def codec(path: str) -> tuple[PieceEncoder, Decoder]:
    """Encoder and decoder of a rank file, built once in each Python process."""
    only("bpe", _CODECS.clear)
    if path not in _CODECS:
        ranks = load_ranks(path)
        _CODECS[path] = PieceEncoder(Transducer(ranks).encode), Decoder(ranks)
    return _CODECS[path]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with an array column of ids instead of any column of that name."""
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c != ids]
    kept = docs.select(*names)

    def run(batches):
        encoder, _ = codec(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch, text, 2 << 20):
                flat, first = encoder(data, offsets)
                yield pa.RecordBatch.from_arrays([*take_columns(batch, names, lo, hi), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(flat.astype(np.int32)))], names=[*names, ids])

    return kept.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", `{ids}` array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """Ids back to text; an empty or null array gives the empty text."""
    ship(encoded.sparkSession)
    names = [c for c in encoded.columns if c not in (ids, text)]
    kept = encoded.select(*names, ids)

    def run(batches):
        _, decoder = codec(path)
        for batch in batches:
            rows = batch.column(len(names)).to_pylist()
            out = ["".join(decoder.texts(np.array(x or [], np.int64))) for x in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(out, pa.string())], names=[*names, text])

    return kept.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]) + f", `{text}` string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, number of ids, SHA-256 of the ids and of the decoded bytes."""
    ship(docs.sparkSession)
    kept = docs.select(key, text)

    def run(batches):
        encoder, decoder = codec(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch, text, 2 << 20):
                flat, first = encoder(data, offsets)
                count, of_ids, of_text = [], [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    own = flat[a:b]
                    count.append(b - a)
                    of_ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    sha = hashlib.sha256()
                    for part in decoder.texts(own):
                        sha.update(part.encode("utf-8"))
                    of_text.append(sha.hexdigest())
                yield pa.RecordBatch.from_arrays([*take_columns(batch, [key], lo, hi), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return kept.mapInArrow(run, f"`{key}` {kept.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
