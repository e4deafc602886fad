"""SentencePiece encoding and decoding on the pieces and scores of a model file.

An Aho-Corasick automaton over the pieces reads each text once. At every
position the output links give all pieces that end there, and each relaxes the
best score of its end position (Viterbi over the unigram lattice). Characters
no piece covers become byte pieces.

No piece crosses from a character into a following space mark, so a text falls
apart into chunks at these places and the best segmentation is that of its
chunks. All new chunks of a batch walk the automaton side by side, one position
at a time, with numpy; chunks already seen in the task are looked up.

A model file of any type is read for its pieces, scores and normaliser flags.
For a unigram model the ids equal those of its library; for a BPE model, whose
scores are ranks, they are the best-scoring segmentation under these scores,
which is not always the one that merging finds.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

SPACE = "▁"
#: Kinds of piece in a model file (fixed values of its format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What an uncovered character costs beyond the worst piece, as the format defines it.
UNKNOWN_PENALTY = 10.0
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]*")
#: Chunks remembered by a task.
_MEMORY = 60_000


class Model:
    """Pieces of a model file as an automaton and as decoding tables."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normaliser and space marks before words are supported")
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.kind = np.array([p.type for p in model.pieces])
        pieces = [p.piece for p in model.pieces]
        usable = [i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER_DEFINED)]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in usable):
            raise ValueError("pieces that cross words are not supported")
        self.score = np.array([p.score for p in model.pieces], dtype=np.float64)
        worst = min((self.score[i] for i in usable), default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        # A user-defined piece always wins: it scores above any sum of others.
        best = max((self.score[i] for i in usable), default=0.0)
        for i in usable:
            if self.kind[i] == USER_DEFINED:
                self.score[i] = len(pieces[i]) * best - 0.1
        self.unknown = next((i for i, k in enumerate(self.kind) if k == UNKNOWN), 0)
        self.byte_id = np.full(256, self.unknown, dtype=np.int32)
        shown: list[bytes] = []
        for i, k in enumerate(self.kind):
            if k == BYTE:
                self.byte_id[int(pieces[i][3:5], 16)] = i
                shown.append(bytes([int(pieces[i][3:5], 16)]))
            elif k == CONTROL:
                shown.append(b"")
            else:
                shown.append(" ⁇ ".encode() if k == UNKNOWN else pieces[i].replace(SPACE, " ").encode())
        self.has_bytes = bool((self.kind == BYTE).any())
        self.shown_ends = np.cumsum([0, *map(len, shown)])
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self._automaton([(pieces[i], i) for i in usable])
        self.seen: dict[str, int] = {}
        self.flat, self.ends = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _automaton(self, pieces: list[tuple[str, int]]) -> None:
        """Trie with failure links, and output links to the next shorter piece
        that ends in a state (letter 0: a character of no piece)."""
        letters = {c: i + 1 for i, c in enumerate(sorted({c for p, _ in pieces for c in p}))}
        self.column = np.zeros(0x110000, dtype=np.int32)
        for c, i in letters.items():
            self.column[ord(c)] = i
        children: list[dict[int, int]] = [{}]
        piece, length = [-1], [0]
        for p, i in pieces:
            at = 0
            for c in p:
                at = children[at].setdefault(letters[c], len(children))
                if at == len(children):
                    children.append({})
                    piece.append(-1)
                    length.append(length[0])
            piece[at], length[at] = i, len(p)
        fail, link, order = [0] * len(children), [-1] * len(children), deque([0])
        while order:
            at = order.popleft()
            for c, to in children[at].items():
                f = fail[at]
                while at and f and c not in children[f]:
                    f = fail[f]
                fail[to] = children[f].get(c, 0) if at else 0
                link[to] = fail[to] if piece[fail[to]] >= 0 else link[fail[to]]
                order.append(to)
        self.fail, self.link = np.array(fail, dtype=np.int32), np.array(link, dtype=np.int32)
        self.piece, self.length = np.array(piece, dtype=np.int32), np.array(length, dtype=np.int32)
        # Transitions as one sorted list of (state, character); a missing one follows the failure link.
        edges = sorted((s * len(letters) + c - 1, t) for s, kids in enumerate(children) for c, t in kids.items())
        self.width = len(letters)
        self.edge, self.to = (np.array(x, dtype=np.int64) for x in zip(*edges)) if edges else (np.empty(0, np.int64),) * 2

    def _step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next states; follows failure links until a transition exists."""
        out = np.zeros(len(state), dtype=np.int32)
        todo = np.flatnonzero(char > 0)
        at, c = state[todo], char[todo].astype(np.int64) - 1
        while len(todo):
            want = at.astype(np.int64) * self.width + c
            i = np.minimum(np.searchsorted(self.edge, want), len(self.edge) - 1)
            hit = self.edge[i] == want
            out[todo[hit]] = self.to[i[hit]]
            on = ~hit & (at > 0)
            todo, at, c = todo[on], self.fail[at[on]], c[on]
        return out

    def _viterbi(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk, one after the other, and where they end."""
        sizes = np.array([len(c) for c in chunks])
        order = np.argsort(-sizes, kind="stable")
        sizes, longest = sizes[order], int(sizes.max())
        chars = np.zeros((len(chunks), longest), dtype=np.uint32)
        for row, i in enumerate(order):
            chars[row, :sizes[row]] = np.frombuffer(chunks[i].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        score = np.full((longest + 1, len(chunks)), -np.inf)
        came, by = (np.zeros((longest + 1, len(chunks)), dtype=np.int32) for _ in range(2))
        score[0] = 0
        state = np.zeros(len(chunks), dtype=np.int32)
        for end in range(1, longest + 1):
            n = int(np.searchsorted(-sizes, -end, side="right"))  # chunks this long stand first
            state = self._step(state[:n], self.column[chars[:n, end - 1]])
            best, start, piece = score[end, :n], came[end, :n], by[end, :n]
            rows, out, single = np.arange(n), state, np.zeros(n, dtype=bool)
            out = np.where(self.piece[out] >= 0, out, self.link[out])
            rows, out = rows[out > 0], out[out > 0]
            while len(rows):  # the longest piece first, so it wins a tie
                begin = end - self.length[out]
                sums = score[begin, rows] + self.score[self.piece[out]]
                better = sums > best[rows]
                hit = rows[better]
                best[hit], start[hit], piece[hit] = sums[better], begin[better], self.piece[out[better]]
                single[rows[begin == end - 1]] = True
                out = self.link[out]
                rows, out = rows[out > 0], out[out > 0]
            sums = score[end - 1, :n] + self.unknown_score
            worse = ~single & (sums > best)
            best[worse], start[worse], piece[worse] = sums[worse], end - 1, self.unknown
        # Walk back from each end; ids come out in reverse.
        back: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        rows, at, step = np.arange(len(chunks)), sizes.copy(), 0
        while len(rows):
            live = at > 0
            rows, at = rows[live], at[live]
            if not len(rows):
                break
            begin = came[at, rows]
            back.append((rows, by[at, rows], begin, np.full(len(rows), step)))
            at, step = begin, step + 1
        if not back:
            return np.empty(0, np.int32), np.zeros(len(chunks), np.int64)
        row, ids, begin, step = (np.concatenate(x) for x in zip(*back))
        sort = np.lexsort((-step, order[row]))
        row, ids, begin = row[sort], ids[sort], begin[sort]
        counts = np.ones(len(ids), dtype=np.int64)
        if self.has_bytes and (unknown := np.flatnonzero(ids == self.unknown)).size:
            spelled = [chr(chars[row[i], begin[i]]).encode("utf-8", "replace") for i in unknown]
            counts[unknown] = [len(b) for b in spelled]
            ids = np.repeat(ids, counts)
            ids[ids == self.unknown] = self.byte_id[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        per_chunk = np.bincount(order[row], weights=counts, minlength=len(chunks)).astype(np.int64)
        return ids, np.cumsum(per_chunk)

    def _learn(self, chunks: list[str]) -> None:
        """Adds chunks, in groups of like length so that the tables stay small."""
        chunks.sort(key=len)
        start = 0
        while start < len(chunks):
            stop = start + 1
            while stop < len(chunks) and len(chunks[stop]) * (stop - start + 1) <= 400_000:
                stop += 1
            ids, ends = self._viterbi(chunks[start:stop])
            for i, c in enumerate(chunks[start:stop]):
                self.seen[c] = len(self.ends) - 1 + i
            self.flat = np.concatenate([self.flat, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
            start = stop

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", SPACE)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the ends of each text."""
        split = [_CHUNK.findall(self.normalise(t))[:-1] if t else [] for t in texts]
        if len(self.seen) > _MEMORY:
            self.seen.clear()
            self.flat, self.ends = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        seen = self.seen
        new = {c for chunks in split for c in chunks if c not in seen}
        if new:
            self._learn(list(new))
        which = np.fromiter((seen[c] for chunks in split for c in chunks), np.int64, sum(map(len, split)))
        ids, ends = gather(self.flat, self.ends, which)
        chunk_ends = np.cumsum([0, *map(len, split)])
        return ids, ends[chunk_ends]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of id sequences; bytes that are no UTF-8 become U+FFFD."""
        data, at = gather(self.shown, self.shown_ends, ids)
        data, at = data.tobytes(), at[ends]
        texts = [_as_text(data[a:b]) for a, b in zip(at[:-1], at[1:])]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in texts]


def _as_text(data: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that is none."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "\ufffd", data.decode("utf-8", "surrogateescape"))


def gather(flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates ``flat[ends[i]:ends[i + 1]]`` for i in ``which``; also its ends."""
    sizes = ends[which + 1] - ends[which]
    out_ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    places = np.arange(out_ends[-1]) + np.repeat(ends[which] - out_ends[:-1], sizes)
    return flat[places], out_ends


@lru_cache(maxsize=2)
def load(proto: bytes) -> Model:
    """The model of a task's process; built once per worker."""
    return Model(proto)


def encode_documents(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (the whole text's pieces), ``decoded`` (the text
    those ids give back) and ``round_trip`` (whether that is the normalised
    text). One pass, no shuffle.

    The model file is read on the driver (about 1 MB) and travels with the
    tasks. Defined cases: a null or empty text has no ids and decodes to the
    empty text; repeated rows come out equal; input columns named like an added
    one are replaced by it.
    """
    with open(model_file, "rb") as f:
        proto = f.read()

    @F.arrow_udf("ids array<int>, decoded string, round_trip boolean")
    def encode(texts: pa.Array) -> pa.Array:
        model, given = load(proto), texts.to_pylist()
        ids, ends = model.encode(given)
        back = model.decode(ids, ends)
        same = [(" " if model.prefix and b else "") + b == model.normalise(t or "").replace(SPACE, " ")
                for t, b in zip(given, back)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        return pa.StructArray.from_arrays([lists, pa.array(back, pa.string()), pa.array(same)],
                                          ["ids", "decoded", "round_trip"])

    added = ("ids", "decoded", "round_trip")
    out = docs.select(packed(docs), encode(F.col(f"`{text}`")).alias("new"))
    return out.select(*unpacked(out, docs.columns, added), "new.*")
