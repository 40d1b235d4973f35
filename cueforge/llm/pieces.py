"""N-best SentencePiece segmentation and decoding.

The pieces of a vocabulary span a lattice over a text; a path's score is the sum of its pieces' scores. No piece has a
space mark after another character, so a text's lattice falls apart at the starts of its space runs into units that
share nothing, and the n best paths of the text are the n best sums over the units' own n best paths. Only units whose
second path costs least can differ from their best; what it costs follows from a forward and a backward pass. For these
units a forward Viterbi pass gives the best score from the start to every place, and a search from the end backward
uses these scores as the exact remaining cost of A*, so paths leave the agenda best first and every popped state lies on
one of the n best paths. Characters outside the vocabulary fall back to byte pieces, as one edge. (One A* over a whole text would
pop every place of it for each path, some ten times the time for the same paths.)

No unigram vocabulary is at hand, and tokenizers are not trained here. A byte-pair vocabulary's scores are ranks, whose sums favour
many pieces of low rank, so a score is the logarithm of a Zipf-Mandelbrot probability of the rank, p(r) ~ 1 / (r + SHIFT), rounded to
1/1024 so that sums are exact and ties are ties.

Null and empty texts have the one empty segmentation, score 0. Ties: longer last pieces first. A text's own U+2581, the space mark, goes
to byte pieces, so every text decodes to itself. Repeated rows and rows with null or equal doc_ids each give their row, an empty table
none; other columns are not looked at, whatever their names. A very long text takes time by its length.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, text_frame

MARK = "▁"
#: Stands for a mark of the text's own; no UTF-8 text holds it.
OWN = "\ud800"
#: Ranks are shifted by so much before they divide.
SHIFT = 2.7
BYTE_LOSS = 10.0
#: Units kept with their paths by one worker; later ones are computed each time.
CACHE_UNITS = 500_000
_UNIT = re.compile(r"▁+[^▁]*|[^▁]+")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the vocabulary file is: in the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Lattice:
    """A vocabulary of (piece, id, score); byte ids for what it lacks."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int] | None = None):
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece has a space mark after another character")
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        self.bytes = byte_ids
        self.low = min((s for _, s in pieces.values()), default=0.0) - BYTE_LOSS
        self.back = {i: p.replace(MARK, " ").encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids or [])}
        self.cache: dict[str, tuple[float, bytes, float]] = {}
        self.parts: dict[str, tuple[float, bytes, float]] = {}
        self.inner = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        # nodes: characters to (node, piece that ends here or None, its score)
        self.trie: tuple[dict, int | None, float] = ({}, None, 0.0)
        for p, (i, score) in pieces.items():
            node = self.trie[0]
            for c in p[:-1]:
                node = node.setdefault(c, ({}, None, 0.0))[0]
            kept = node.get(p[-1:], ({},))[0]
            node[p[-1:]] = (kept, i, score)
        self.units = self._units()
        self.asked: dict[tuple[str, int], list] = {}

    def _units(self) -> re.Pattern:
        """What units match: if no piece has a letter beside another character, they end there as well."""
        odd = "".join(sorted({re.escape(c) for p in self.inner for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}))
        letter = re.compile(rf"[^\W\d_{odd}]")
        if any(p[0] != MARK and bool(letter.match(p[0])) != bool(letter.match(p[1])) for p in self.inner):
            return _UNIT
        return re.compile(rf"▁*{letter.pattern}+|▁*[\W\d_{odd}]+?(?=▁|{letter.pattern}|\Z)")

    def edges(self, unit: str, end: int):
        """(start, score, ids) of the pieces that end at end, long ones first."""
        pieces = self.pieces
        for start in range(max(0, end - self.longest), end):
            if (hit := pieces.get(unit[start:end])) is not None:
                yield start, hit[1], hit[0]
        if unit[end - 1] not in pieces:
            yield end - 1, self.low, None

    def ids(self, unit: str, start: int, end: int, piece: int | None) -> list[int]:
        if piece is not None:
            return [piece]
        return [self.bytes[b] if self.bytes else -1 for b in unit[start:end].replace(OWN, MARK).encode()]

    def search(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of unit, best first."""
        size = len(unit)
        forward, into = [0.0] + [-1e300] * size, [()] * (size + 1)
        for end in range(1, size + 1):
            own = into[end] = list(self.edges(unit, end))
            forward[end] = max(forward[s] + score for s, score, _ in own)
        # of equal totals the state nearest to the start comes first, so ties are gone through one path at a time;
        # totals are compared in millionths, as sums in another order differ in their last places
        agenda = [(-round(forward[size], 6), size, 0, 0.0, None)]
        made, out = 1, []
        while agenda and len(out) < n:
            _, at, _, behind, path = heapq.heappop(agenda)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    s, e, piece, path = path
                    ids += self.ids(unit, s, e, piece)
                out.append((behind, ids))
                continue
            for start, score, piece in into[at]:
                heapq.heappush(agenda, (-round(behind + score + forward[start], 6), start, made, behind + score, (start, at, piece, path)))
                made += 1
        return out

    def unit(self, unit: str) -> tuple[float, bytes, float]:
        """Best score of a unit, its ids, and what the second path loses against it (inf: there is none).

        A unit falls apart further where two characters stand side by side in no piece.
        """
        inner, at, parts = self.inner, 0, []
        for k in range(1, len(unit)):
            if unit[k - 1 : k + 1] not in inner:
                parts.append(unit[at:k])
                at = k
        if parts:
            parts.append(unit[at:])
            get = self.parts.get
            done = [get(p) or self.part(p) for p in parts]
            own = sum([d[0] for d in done]), b"".join([d[1] for d in done]), min([d[2] for d in done])
        else:
            own = self.part(unit, False)
        if len(self.cache) < CACHE_UNITS and len(unit) <= 64:
            self.cache[unit] = own
        return own

    def part(self, unit: str, keep: bool = True) -> tuple[float, bytes, float]:
        """As unit, for a stretch that has no such place.

        The second path has a piece that the best one lacks, so it is the best over such pieces of the forward score
        before it, its own, and the backward score after it.
        """
        size, root = len(unit), self.trie
        forward, before, edges = [0.0] + [-1e300] * size, [(0, None)] * (size + 1), []
        for start in range(size):
            base, (node, _, _), own = forward[start], root, []
            for end in range(start, size):
                if (hit := node.get(unit[end])) is None:
                    break
                node, piece, score = hit
                if piece is not None:
                    own.append((end + 1, score))
                    if base + score > forward[end + 1]:
                        forward[end + 1], before[end + 1] = base + score, (start, piece)
            if not own or own[0][0] != start + 1:
                own.append((start + 1, self.low))
                if base + self.low > forward[start + 1]:
                    forward[start + 1], before[start + 1] = base + self.low, (start, None)
            edges.append(own)
        ids, on, at = [], {}, size
        while at:
            start, piece = before[at]
            on[start] = at
            ids.append([piece] if piece is not None else self.ids(unit, start, at, None))
            at = start
        backward, second = [-1e300] * size + [0.0], -1e300
        for start in range(size - 1, -1, -1):
            base, best, best_end = forward[start], -1e300, on.get(start)
            for end, score in edges[start]:
                v = score + backward[end]
                if v > best:
                    best = v
                if end != best_end and base + v > second:
                    second = base + v
            backward[start] = best
        flat = [i for part in reversed(ids) for i in part]
        own = forward[size], array("I", flat).tobytes(), forward[size] - second if second > -1e299 else np.inf
        if keep and len(self.parts) < CACHE_UNITS // 3 and size <= 64:
            self.parts[unit] = own
        return own

    def best_of(self, unit: str, n: int) -> list[tuple[float, bytes]]:
        """search(unit, n), kept for the units that many texts ask for."""
        if (hit := self.asked.get((unit, n))) is None:
            hit = [(s, np.array(i, "<u4").tobytes()) for s, i in self.search(unit, n)]
            if len(self.asked) < CACHE_UNITS // 3 and len(unit) <= 64:
                self.asked[unit, n] = hit
        return hit

    def nbest(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of normalised text, best first, as score and ids (little-endian unsigned 32-bit)."""
        get = self.cache.get
        names = self.units.findall(text)
        units = [get(u) or self.unit(u) for u in names]
        best, whole = sum([u[0] for u in units]), [u[1] for u in units]
        out = [(best, b"".join(whole))]
        if n > 1:
            # only the n - 1 units with the cheapest second path can take part in the n best
            loss = np.array([u[2] for u in units])
            cheap = np.flatnonzero(loss <= np.partition(loss, n - 2)[n - 2]) if len(loss) > n - 1 else np.arange(len(loss))
            cheap = sorted(cheap.tolist(), key=lambda k: (loss[k], k))[: n - 1]
            cheap = [k for k in cheap if loss[k] < np.inf]
            own = [self.best_of(names[k], n) for k in cheap]
            first = (0,) * len(own)
            agenda, seen = [(0.0, first)], {first}
            while agenda and len(out) < n:
                lost, state = heapq.heappop(agenda)
                if any(state):
                    changed = list(whole)
                    for k, r, u in zip(cheap, state, own, strict=True):
                        changed[k] = u[r][1]
                    out.append((best - lost, b"".join(changed)))
                for j, r in enumerate(state):
                    nxt = (*state[:j], r + 1, *state[j + 1 :])
                    if r + 1 < len(own[j]) and nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(agenda, (sum(u[0][0] - u[x][0] for u, x in zip(own, nxt, strict=True)), nxt))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, byte pieces put together, the leading mark taken off."""
        return b"".join(map(self.back.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")


def normalise(text: str) -> str:
    """The vocabulary's own rule: a mark before the text, marks for spaces, nothing else changed but the text's own marks."""
    return MARK + text.replace(MARK, OWN).replace(" ", MARK) if text else ""


@lru_cache(maxsize=2)
def load(path: str) -> Lattice:
    """A lattice from a SentencePiece file: its ordinary pieces with scores by rank, its byte pieces as fallback.

    Ranks go by the file's scores, higher ones first; the filler scores of space runs make these the last.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = {}, [0] * 256
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[1:-1], 16)] = i
        elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
            pieces[p] = (i, sp.get_score(i))
    ranked = sorted(pieces, key=lambda p: (-pieces[p][1], pieces[p][0]))
    total = sum(1 / (r + SHIFT) for r in range(1, len(ranked) + 1))
    return Lattice({p: (pieces[p][0], round(-1024 * math.log((r + SHIFT) * total)) / 1024) for r, p in enumerate(ranked, 1)}, byte_ids)


def segment(df: DataFrame, n: int = 4, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of df: pieces and digest of the best ids, scores and ids' digests of all n, and a decoding check.

    scores are joined by commas, best first, in full: they are multiples of 1/1024.
    """
    path = path or os.environ.get("CUEFORGE_PIECES") or model_path()

    def rows(part: pa.RecordBatch) -> dict:
        lattice = load(path)
        cols: list[list] = [[], [], [], [], [], []]
        for t in part.column(1).to_pylist():
            best = lattice.nbest(normalise(t := t or ""), n)
            ids = best[0][1]
            for col, v in zip(cols, (len(ids) // 4, best[0][0], hashlib.sha256(ids).hexdigest(), ",".join(repr(s) for s, _ in best), ",".join(hashlib.sha256(i).hexdigest()[:16] for _, i in best), lattice.decode(np.frombuffer(ids, "<u4")) == t), strict=True):
                col.append(v)
        types = (pa.int64(), pa.float64(), pa.string(), pa.string(), pa.string(), pa.bool_())
        names = ("n_pieces", "best_score", "best_ids_sha256", "scores", "nbest_ids", "decodes")
        return {"doc_id": part.column(0), **{k: pa.array(c, t) for k, c, t in zip(names, cols, types, strict=True)}}

    return mapped(text_frame(df, key, text), rows, "doc_id long, n_pieces long, best_score double, best_ids_sha256 string, scores string, nbest_ids string, decodes boolean")
