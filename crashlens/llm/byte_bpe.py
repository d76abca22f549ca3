"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation: the texts of a batch become one array of code points, each
mapped to a symbol (its class, with the little lookahead that the pattern
needs). A symbol is a transition function on the states of a small automaton;
functions compose associatively, so a blocked scan finds the state before each
character, and the state and symbol tell whether a piece begins there. Pieces
are then merged pair by pair (cached), and the token offsets within the
vocabulary's bytes serve decoding.

The pieces are those of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
import zlib
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from crashlens.llm.common import per_texts

# classes of code points
LETTER, NUMBER, OTHER, BLANK, WHITE = range(5)
#: Characters with the Unicode property White_Space, beside U+0020.
WHITE_SPACE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
# symbols: the first three are the classes; A1 and A2 are an apostrophe before
# one or two contraction letters; IN is white space inside a run (or at the end
# of a text), BLANK_LAST and WHITE_LAST stand before a visible character
A1, A2, IN, BLANK_LAST, WHITE_LAST, END, PAD = range(3, 10)
SYMBOLS = 10
# states: what was read last; ONE and TWO wait for contraction letters
START, IN_L, IN_N, IN_O, SPACED, APART, ONE, TWO, DONE, RUN = range(10)
STATES = 10
BLOCK = 64
#: Characters that are scanned at once, and cached pieces.
BATCH_CHARS = 1 << 19
#: Bytes from which a piece is merged with a heap, and is not cached.
LONG = 128
CACHE = 400_000


def code_point_classes() -> bytes:
    """Class of every code point, compressed; made once on the driver."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)],
                     np.uint8)
    table[WHITE_SPACE] = WHITE
    table[0x20] = BLANK
    return zlib.compress(table.tobytes())


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by symbol and state before it."""
    to = np.empty((SYMBOLS, STATES), np.uint8)
    begins = np.zeros((SYMBOLS, STATES), bool)
    for s in range(STATES):
        inside = s in (ONE, TWO)
        to[LETTER, s] = {TWO: ONE, ONE: DONE}.get(s, IN_L)
        begins[LETTER, s] = not inside and s not in (IN_L, SPACED)
        to[NUMBER, s], begins[NUMBER, s] = IN_N, s not in (IN_N, SPACED)
        to[OTHER, s], begins[OTHER, s] = IN_O, s not in (IN_O, SPACED)
        for a, waits in ((A1, ONE), (A2, TWO)):
            goes_on = s in (IN_O, SPACED)
            to[a, s], begins[a, s] = (IN_O if goes_on else waits), not goes_on
        to[IN, s], begins[IN, s] = RUN, s != RUN
        to[BLANK_LAST, s], begins[BLANK_LAST, s] = SPACED, True
        to[WHITE_LAST, s], begins[WHITE_LAST, s] = APART, True
        to[END, s], begins[END, s] = START, True
        to[PAD, s] = s
    return to, begins


def scan_states(symbols: np.ndarray, to: np.ndarray) -> np.ndarray:
    """State before each symbol, from START, by a blocked scan of functions."""
    n = len(symbols)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, PAD, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T).astype(np.intp) * STATES
    flat = to.ravel()
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for row in grid:  # the function of each block
        whole = flat[row[:, None] + whole]
    step = 1
    while step < blocks:  # compose the blocks' functions, doubling the reach
        later = np.take_along_axis(whole[step:], whole[:-step].astype(np.intp), 1)
        whole = np.concatenate([whole[:step], later])
        step *= 2
    state = np.concatenate([[START], whole[:-1, START]]).astype(np.uint8)
    before = np.empty((BLOCK, blocks), np.uint8)
    for k, row in enumerate(grid):
        before[k] = state
        state = flat[row + state]
    return before.T.ravel()[:n]


class PreTokenizer:
    def __init__(self, classes: bytes):
        self.classes = np.frombuffer(zlib.decompress(classes), np.uint8)
        self.to, self.begins = _automaton()

    def symbols(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Symbols of code points; ``ends`` are the places of text ends."""
        kind = self.classes[points]
        kind[ends] = END
        later = np.append(points[1:], 0)
        last = np.append(points[2:], [0, 0])
        after = np.append(kind[1:], END)
        out = kind.copy()
        quote = np.flatnonzero((points == 0x27) & (kind == OTHER))
        one, two = later[quote], last[quote]
        out[quote[np.isin(one, [ord(c) for c in "stmd"])]] = A1
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) \
            | (one == ord("l")) & (two == ord("l"))
        out[quote[pair]] = A2
        gap = (kind == BLANK) | (kind == WHITE)
        ahead = gap & (after <= OTHER)  # before a visible character
        out[gap] = IN
        out[ahead & (kind == BLANK)] = BLANK_LAST
        out[ahead & (kind == WHITE)] = WHITE_LAST
        out[ends] = END
        return out

    def pieces(self, texts: list[str]) -> list[list[bytes]]:
        """UTF-8 pieces of each text."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        symbols = self.symbols(points, ends)
        starts = np.flatnonzero(self.begins[symbols, scan_states(symbols, self.to)])
        width = 1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[starts].tolist()
        data = joined.encode()
        found = [data[a:b] for a, b in zip(at, at[1:], strict=False)]  # and the last text end
        closing = np.searchsorted(starts, ends).tolist()
        out, first = [], 0
        for c in closing:
            out.append(found[first:c])
            first = c + 1
        return out

    def cut(self, text: str, size: int = BATCH_CHARS):
        """A long text in parts that begin at a space between visible
        characters, where a piece always begins."""
        visible = lambda c: self.classes[ord(c)] <= OTHER
        at = 0
        while len(text) - at > size:
            end = text.find(" ", at + size)
            while 0 < end < len(text) - 1 and not (visible(text[end - 1]) and visible(text[end + 1])):
                end = text.find(" ", end + 1)
            if not 0 < end < len(text) - 1:
                break
            yield text[at:end]
            at = end
        yield text[at:]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    def __init__(self, ranks: dict[bytes, int], classes: bytes):
        self.ranks, self.splitter = ranks, PreTokenizer(classes)
        self.cache: dict[bytes, tuple[bytes, str]] = {}
        vocabulary = sorted(ranks, key=ranks.get)
        self.data = np.frombuffer(b"".join(vocabulary), np.uint8)
        ids = np.array([ranks[v] for v in vocabulary], np.int64)
        sizes = np.array([len(v) for v in vocabulary], np.int64)
        self.first = np.zeros(ids.max() + 1, np.int64)
        self.size = np.zeros(ids.max() + 1, np.int64)
        self.first[ids], self.size[ids] = np.cumsum(sizes) - sizes, sizes

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the pair of lowest rank is joined, leftmost first."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > LONG:
            return self.merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = len(ranks) + 1 << 20
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap of pairs over linked parts, for long pieces."""
        ranks, n = self.ranks, len(piece)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def pair(i: int):
            j = ends[i]
            if j < n and (rank := ranks.get(piece[i:ends[j]])) is not None:
                heappush(heap, (rank, i, j, ends[j]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            pair(i)
        while heap:
            _, i, j, end = heappop(heap)
            if not alive[i] or ends[i] != j or not alive[j] or ends[j] != end:
                continue  # one of the two has been merged since
            ends[i], alive[j] = end, False
            if end < n:
                before[end] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:ends[i]]])
            i = ends[i]
        return out

    def encoded(self, piece: bytes) -> tuple[bytes, str]:
        """Ids of a piece as four bytes each, and as decimal digits; kept."""
        if len(self.cache) >= CACHE:
            self.cache.clear()
        ids = self.merge(piece)
        found = (np.array(ids, np.uint32).tobytes(), ",".join(map(str, ids)))
        if len(piece) <= LONG:
            self.cache[piece] = found
        return found

    def encode(self, texts: list[str]):
        """For each text its ids, and the same as decimal strings a piece.
        Short texts are scanned together, long ones in parts."""
        group: list[str] = []
        held = 0
        for text in [*texts, None]:
            if text is None or held + len(text) > BATCH_CHARS:
                for pieces in self.splitter.pieces(group) if group else ():
                    yield self._joined([pieces])
                group, held = [], 0
            if text is not None and len(text) > BATCH_CHARS:
                yield self._joined(self.splitter.pieces([part])[0] for part in self.splitter.cut(text))
            elif text is not None:
                group.append(text)
                held += len(text)

    def _joined(self, parts) -> tuple[np.ndarray, list[str]]:
        known, made = self.cache.get, self.encoded
        found = [known(piece) or made(piece) for pieces in parts for piece in pieces]
        ids = np.frombuffer(b"".join([x[0] for x in found]), np.uint32)
        return ids, [x[1] for x in found]

    def decode(self, ids) -> bytes:
        """Bytes of ids, gathered from the vocabulary's bytes by their offsets."""
        ids = np.asarray(ids, np.int64)
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.first[ids] - (ends - sizes), sizes)
        return self.data[shift + np.arange(len(shift))].tobytes()


RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"
WITH_IDS = RESULT + ", ids array<int>"


def _codec(path: str):
    ranks, classes = read_ranks(path), code_point_classes()
    return ranks, classes


def bpe_digests(text: Column, path: str, with_ids: bool = False) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256 (and ids) of a text column.

    ``path`` names the rank file; its ranks (a fixed vocabulary) and the code
    point classes are read on the driver and shipped with the task. Null and
    empty texts have no tokens; the digests are then those of empty strings.
    """
    ranks, classes = _codec(path)

    def make():
        codec = Codec(ranks, classes)

        def digests(texts: list[str]):
            for ids, shown in codec.encode(texts):
                row = (len(ids), hashlib.sha256(",".join(shown).encode()).hexdigest(),
                       hashlib.sha256(codec.decode(ids)).hexdigest())
                yield (*row, ids.astype(np.int32)) if with_ids else row
        return digests

    return per_texts(make, WITH_IDS if with_ids else RESULT)(text)


def bpe_encode(text: Column, path: str) -> Column:
    """Ids (array of int) of a text column; null and empty texts have none."""
    ranks, classes = _codec(path)

    def make():
        codec = Codec(ranks, classes)
        return lambda texts: ((ids.astype(np.int32),) for ids, _ in codec.encode(texts))

    return per_texts(make, "ids array<int>")(text)["ids"]


def bpe_decode(ids: Column, path: str) -> Column:
    """Bytes of an array of ids; null and empty arrays give empty bytes."""
    vocabulary = {i: v for v, i in read_ranks(path).items()}

    @F.udf("binary", useArrow=True)
    def decode(row):
        return b"".join(vocabulary[i] for i in (row if row is not None else ()))

    return decode(ids)
