"""SentencePiece encoding and decoding by N-best search over the piece lattice.

The lattice of a text has an edge for every piece of the model that stands in
it; a segmentation's score is the sum of its pieces' scores. Forward Viterbi
gives the best score up to each position; as that score is exact, a backward
A-star search that uses it as its heuristic takes segmentations off its
agenda in order of their scores.

No piece goes on behind a blank mark that follows another character, so a
text falls into chunks, each with a lattice of its own. Viterbi runs over all
new chunks of a slice at once and keeps the two best scores; a worker
remembers chunks (at most :data:`MEMO`). A text's N best segmentations differ
from the best one only in the N - 1 chunks whose second best costs least, so
A-star runs on those, and their lists are merged.

The lattice is that of a unigram model: it adds up scores and takes the best
sum. The query's model is a BPE one, whose scores are the ranks of its merges,
not log-probabilities. So its best segmentation here is the one of least total
rank among all ways through the lattice; the library's ``encode`` merges
greedily and gives other, fewer pieces. ``segmentation`` in the pipeline's last
stage says that its ids are the lattice's. Both decode to the text.

A character without a piece of its own is an edge with the lowest score of
all less 10; it is written as byte pieces if the model has them, else as the
unknown piece. The text gets a blank in front, and blanks become U+2581.

Defined results: null and empty texts have no pieces, score 0 and one empty
segmentation; segmentations with equal scores come in the order in which
A-star finds them, the best one (the longest last piece at each tie) first; a
text with U+2581 of its own decodes to blanks there, and ``round_trip`` is
false. Repeated rows are encoded alike, extra columns ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import map_batches, release, text_columns

MARK = "▁"
MEMO = 100_000
#: New chunks that go through Viterbi together: their lattices are the largest arrays of a worker.
LEARN = 4_000
N_BEST = 4
SLICE = 4 << 20
#: Feature of the model: scores below the lowest one for a character without a piece.
UNKNOWN_PENALTY = 10.0

SCHEMA = ("doc_id long, n_pieces long, score double, ids_crc32 long, round_trip boolean, "
          "segmentations array<struct<score:double,n_pieces:long,ids_crc32:long>>")


class Trie:
    """Pieces by their characters, as an open-addressed table of (state, character) for whole arrays."""

    def __init__(self, pieces: dict[str, int]):
        edges: dict[tuple[int, int], int] = {}
        self.piece = [-1]
        for text, i in pieces.items():
            state = 0
            for c in map(ord, text):
                state = edges.setdefault((state, c), len(edges) + 1)
                if state == len(self.piece):
                    self.piece.append(-1)
            self.piece[state] = i
        self.piece = np.array(self.piece, np.int32)
        self.bits = max(10, len(edges).bit_length() + 3)
        size = 1 << self.bits
        self.key, self.state = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        for (state, c), to in edges.items():
            at = self._place(np.array([state << 21 | c]))[0]
            while self.key[at] >= 0:
                at = (at + 1) % size
            self.key[at], self.state[at] = state << 21 | c, to
        self.longest = max(map(len, pieces), default=0)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(tb.U64) * tb.U64(0x9E3779B97F4A7C15)) >> tb.U64(64 - self.bits)).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next states, 0 where there is none."""
        key = state.astype(np.int64) << 21 | char
        at = self._place(key)
        out = np.zeros(len(key), np.int32)
        found = self.key[at]
        same = found == key
        out[same] = self.state[at[same]]
        open_ = np.flatnonzero(~same & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.key[at[open_]]
            same = found == key[open_]
            out[open_[same]] = self.state[at[open_[same]]]
            open_ = open_[~same & (found >= 0)]
        return out


class Lattice:
    """A model's pieces, and the chunks that this worker has seen."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces: dict[str, int] = {}
        self.score = np.zeros(n + 1)
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_piece: dict[int, int] = {}
        self.unknown = model.unk_id()
        for i in range(n):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_piece[int(text[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(text[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[text] = i
                self.score[i] = model.get_score(i)
                self.bytes_of[i] = text.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("the model has pieces that go on behind a word's end")
        self.score[n] = min((self.score[i] for i in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.off = n  # stands for an unknown character
        self.trie = Trie(self.pieces)
        size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.piece_size, self.piece_at = size, np.cumsum(size) - size
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.name: list[str] = []
        self.size = self.at = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.best = self.loss = np.zeros(0)
        self.lists: dict[int, list[tuple[float, np.ndarray]]] = {}

    # -- forward Viterbi over many chunks at once

    def _edges(self, chars: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, characters, piece) of every piece in the chunks; ``end`` is each position's chunk end."""
        at, state = np.arange(len(chars)), np.zeros(len(chars), np.int32)
        found = []
        single = np.zeros(len(chars), bool)
        for n in range(self.trie.longest):
            inside = at + n < end[at]
            at, state = at[inside], state[inside]
            state = self.trie.step(state, chars[at + n])
            alive = state > 0
            at, state = at[alive], state[alive]
            if not len(at):
                break
            piece = self.trie.piece[state]
            ends = piece >= 0
            found.append((at[ends], np.full(int(ends.sum()), n + 1), piece[ends]))
            if n == 0:
                single[at[ends]] = True
        alone = np.flatnonzero(~single)
        found.append((alone, np.ones(len(alone), np.int64), np.full(len(alone), self.off, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _viterbi(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(best score, what the second best loses, pieces of the best path, how many each chunk has)."""
        chars = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(c) for c in chunks], np.int64)
        start = np.cumsum(size) - size
        at, n, piece = self._edges(chars, np.repeat(start + size, size))
        # Nodes: one more than characters for each chunk.
        chunk = np.repeat(np.arange(len(chunks)), size)[at]
        source = at + chunk
        target = source + n
        depth = at - start[chunk] + n
        order = np.lexsort((-n, target, depth))
        source, target, piece, depth = source[order], target[order], piece[order], depth[order]
        value = self.score[piece]
        n_nodes = len(chars) + len(chunks)
        first, second = np.full(n_nodes, -np.inf), np.full(n_nodes, -np.inf)
        first[start + np.arange(len(chunks))] = 0.0
        back = np.zeros(n_nodes, np.int64)
        bounds = np.searchsorted(depth, np.arange(1, int(size.max()) + 2))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own, goal = source[lo:hi], target[lo:hi]
            one = first[own] + value[lo:hi]
            head = np.flatnonzero(np.concatenate([[True], goal[1:] != goal[:-1]]))
            top = np.maximum.reduceat(one, head)
            run = np.repeat(np.arange(len(head)), np.diff(np.append(head, hi - lo)))
            equal = np.flatnonzero(one == top[run])
            win = equal[np.concatenate([[True], run[equal[1:]] != run[equal[:-1]]])]
            one[win] = -np.inf
            other = np.maximum(np.maximum.reduceat(one, head), np.maximum.reduceat(second[own] + value[lo:hi], head))
            nodes = goal[head]
            first[nodes], second[nodes], back[nodes] = top, other, win + lo
        last = start + size + np.arange(len(chunks))
        root = start + np.arange(len(chunks))
        node, who, steps = last.copy(), np.arange(len(chunks)), []
        while len(who):
            edge = back[node]
            steps.append((who, piece[edge]))
            node = source[edge]
            going = node > root[who]
            who, node = who[going], node[going]
        owner = np.concatenate([w for w, _ in steps[::-1]])
        path = np.concatenate([p for _, p in steps[::-1]])
        order = np.argsort(owner, kind="stable")
        return first[last], first[last] - second[last], path[order], np.bincount(owner, minlength=len(chunks))

    def _learn(self, chunks: list[str]) -> None:
        best, loss, path, count = self._viterbi(chunks)
        ids, size = self._spell(path, count, chunks)
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        self.best, self.loss = np.concatenate([self.best, best]), np.concatenate([self.loss, loss])
        self.code.update(zip(chunks, range(len(self.code), len(self.code) + len(chunks)), strict=True))
        self.name += chunks

    def _spell(self, path: np.ndarray, count: np.ndarray, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids instead of unknown characters."""
        odd = np.flatnonzero(path == self.off)
        if not len(odd):
            return path.astype(np.int32), count
        owner = np.repeat(np.arange(len(chunks)), count)
        parts = np.split(path, np.cumsum(count)[:-1])
        for i in np.unique(owner[odd]):
            parts[i] = self._written(parts[i].tolist(), chunks[i])
        return np.concatenate(parts).astype(np.int32), np.array([len(p) for p in parts], np.int64)

    def _written(self, path: list[int], chunk: str) -> np.ndarray:
        out, at = [], 0
        for p in path:
            if p == self.off:
                raw = chunk[at].replace(MARK, " ").encode("utf-8", "surrogatepass")
                out += [self.byte_piece[b] for b in raw] if len(self.byte_piece) == 256 else [self.unknown]
                at += 1
            else:
                out.append(p)
                at += len(self.bytes_of[p].decode())
        return np.array(out, np.int32)

    # -- backward A-star over one chunk

    def n_best(self, chunk: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a chunk, best first, as (score, path)."""
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(len(chunk) + 1)]
        for i in range(len(chunk)):
            for size in range(min(self.trie.longest, len(chunk) - i), 0, -1):
                p = self.pieces.get(chunk[i:i + size])
                if p is not None:
                    into[i + size].append((i, p, float(self.score[p])))
            if chunk[i] not in self.pieces:
                into[i + 1].append((i, self.off, float(self.score[self.off])))
        forward = [0.0] + [-np.inf] * len(chunk)
        for j in range(1, len(chunk) + 1):
            into[j].sort(key=lambda e: e[0])
            forward[j] = max((forward[i] + s for i, _, s in into[j]), default=-np.inf)
        out: list[tuple[float, list[int]]] = []
        serial = 0
        agenda: list[tuple[float, int, int, float, tuple | None]] = [(-forward[-1], 0, len(chunk), 0.0, None)]
        while agenda and len(out) < n:
            _, _, node, behind, path = heapq.heappop(agenda)
            if node == 0:
                pieces = []
                while path:
                    pieces.append(path[0])
                    path = path[1]
                out.append((behind, pieces))
                continue
            for i, p, s in into[node]:
                if forward[i] > -np.inf:
                    serial += 1
                    heapq.heappush(agenda, (-(forward[i] + s + behind), serial, i, s + behind, (p, path)))
        return out

    def _list(self, code: int, n: int) -> list[tuple[float, np.ndarray]]:
        """A remembered chunk's n best, with the ids that Viterbi chose first: (loss, ids)."""
        if code not in self.lists or len(self.lists[code]) < n:
            chunk, own = self.name[code], self.ids[self.at[code]:self.at[code] + self.size[code]]
            found = [(float(self.best[code]) - s, self._written(path, chunk)) for s, path in self.n_best(chunk, n)]
            rest = [x for x in found if not np.array_equal(x[1], own)]
            self.lists[code] = [(0.0, own), *rest][:n]
        return self.lists[code]

    # -- whole texts

    def chunks(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(codes of all chunks, how many each text has)."""
        column = column.fill_null("").cast(pa.large_string())
        if len(self.code) > MEMO:
            self.clear()
        odd = pc.match_substring_regex(column, f"^ | $|  |{MARK}|^$").to_numpy(zero_copy_only=False)
        if not odd.any():
            split = pc.split_pattern(column, " ")
            words = split.flatten().dictionary_encode()
            counts = np.diff(np.asarray(split.offsets))
            known, codes = [MARK + w for w in words.dictionary.to_pylist()], np.asarray(words.indices)
        else:
            lists = [re.findall(f"{MARK}+[^{MARK}]*", MARK + t.replace(" ", MARK)) if t else []
                     for t in column.to_pylist()]
            counts = np.array([len(x) for x in lists], np.int64)
            order: dict[str, int] = {}
            codes = np.array([order.setdefault(c, len(order)) for x in lists for c in x], np.int64)
            known = list(order)
        missing = [c for c in known if c not in self.code]
        for at in range(0, len(missing), LEARN):
            self._learn(missing[at:at + LEARN])
        own = np.fromiter(map(self.code.__getitem__, known), np.int64, len(known))
        return own[codes] if len(codes) else np.zeros(0, np.int64), counts

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces, blank marks as blanks."""
        return self._bytes(ids)[0].tobytes()

    def _bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.piece_size[ids]
        at = np.repeat(self.piece_at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.piece_bytes[at], size


def _bounds(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def encode_slice(own: Lattice, column: pa.Array, n_best: int) -> Iterator[tuple[int, float, np.ndarray, bool, list]]:
    """For each text: pieces, best score, ids, whether they decode to the text, and the N best as (score, ids)."""
    codes, counts = own.chunks(column)
    bounds = _bounds(counts)
    size = own.size[codes]
    ids_bounds = _bounds(size)
    at = np.repeat(own.at[codes] - ids_bounds[:-1], size) + np.arange(int(size.sum()))
    ids = own.ids[at]
    raw, piece_size = own._bytes(ids)
    raw_bounds = _bounds(piece_size)
    best, loss = own.best[codes], own.loss[codes]
    texts = tb.as_texts(column)
    for i in range(len(counts)):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        a, b = int(ids_bounds[lo]), int(ids_bounds[hi])
        mine = ids[a:b]
        text = texts.data[texts.bounds[i]:texts.bounds[i + 1]]
        back = raw[raw_bounds[a]:raw_bounds[b]]
        same = len(back) == len(text) + (len(text) > 0) and np.array_equal(back[1:], text)
        score = float(best[lo:hi].sum())
        merged: list[tuple[float, tuple]] = [(0.0, ())]
        if n_best > 1 and hi > lo:
            k = min(n_best - 1, hi - lo)
            lost = loss[lo:hi]
            # The smallest losses, the first ones of equals.
            cut = np.partition(lost, k - 1)[k - 1]
            low = np.flatnonzero(lost < cut)
            pick = np.sort(np.concatenate([low, np.flatnonzero(lost == cut)[:k - len(low)]]))
            for p in pick.tolist():
                if np.isfinite(lost[p]):
                    options = own._list(int(codes[lo + p]), n_best)
                    merged = heapq.nsmallest(n_best, ((x + y, (*way, (lo + p, z)))
                                                      for x, way in merged for z, (y, _) in enumerate(options)),
                                             key=lambda m: m[0])
        segmentations = []
        for lose, way in merged:
            parts, last = [], a
            for p, z in way:
                if z:
                    parts += [ids[last:ids_bounds[p]], own._list(int(codes[p]), n_best)[z][1]]
                    last = int(ids_bounds[p + 1])
            segmentations.append((score - lose, np.concatenate([*parts, ids[last:b]]) if parts else mine))
        yield len(mine), score, mine, bool(same), segmentations


_lattices: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    """One for each worker and model; its memory of chunks stays from batch to batch."""
    if path not in _lattices:
        _lattices[path] = Lattice(path)
        release()  # what reading the model took
    return _lattices[path]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def _pieces(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return tb.slices(iter([part]), limit=SLICE)


def encode(docs: DataFrame, model_path: str, n_best: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """One row per document; ``with_ids`` adds the ids of the best segmentation."""
    def run(part: pa.RecordBatch) -> dict:
        out = {"doc_id": part.column("doc_id"), "n_pieces": [], "score": [], "ids_crc32": [], "round_trip": []}
        ways, all_ids, found = [], [], []
        for n, score, ids, same, segmentations in encode_slice(lattice(model_path), part.column("text"), n_best):
            out["n_pieces"].append(n)
            out["score"].append(score)
            out["round_trip"].append(same)
            crc = _crc(ids)
            out["ids_crc32"].append(crc)
            all_ids.append(ids)
            found.append(len(segmentations))
            ways += [(s, len(x), crc if x is ids else _crc(x)) for s, x in segmentations]
        s, n, c = zip(*ways, strict=True)
        fields = pa.StructArray.from_arrays([pa.array(s, pa.float64()), pa.array(n, pa.int64()), pa.array(c, pa.int64())],
                                            ["score", "n_pieces", "ids_crc32"])
        out["segmentations"] = pa.ListArray.from_arrays(pa.array(_bounds(found), pa.int32()), fields)
        if with_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(_bounds(out["n_pieces"]), pa.int32()),
                                                  pa.array(np.concatenate(all_ids), pa.int32()))
        return out

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return map_batches(text_columns(docs, "doc_id", "text"), run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from rows with ``ids``; the blank in front of each text goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model_path)
        for part in batches:
            for k in range(0, part.num_rows, 256):
                rows = part.slice(k, 256)
                texts = [own.decode(np.array(x or [], np.int64))[1:].decode("utf-8", "replace")
                         for x in rows.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string())],
                                                 names=["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids")).mapInArrow(run, "doc_id long, text string")
