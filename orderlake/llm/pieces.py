"""Operator 9: SentencePiece BPE encoding and decoding by vectorised merge rounds.

A slice of documents is cut into segments (a run of spaces and what follows it;
a line break is a segment of its own), since no piece of the vocabulary crosses
those places.  Each distinct segment is encoded once: all symbols of all
segments lie in one flat array; a round looks up the rank of every adjacent
pair, takes the best rank of each segment, merges its leftmost non-overlapping
pairs of that rank at once and compacts the array, until no pair is left.
Characters without a piece become byte pieces.  Decoding is a gather of piece
bytes.  Everything runs inside `mapInArrow` on the scan: no shuffle.

Where a merge could open a better pair than the one just merged (`_reopens`),
only the leftmost pair of the segment is merged in that round, as the library
does, so ids are the library's for every text.

Edge cases: a null or empty text has no ids and decodes to ""; rows with equal
ids and repeated rows are encoded one by one; an empty table gives an empty
result; extra columns are ignored.  A text without any space is one segment.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import IdCache, mix, prepare, ranges, span_hash, text_slices, texts, word_spans

SPACE = "▁"
NO_RANK = np.int32(2**31 - 1)
_ALL = np.ones(256, bool)


class PieceModel:
    """The pieces of a SentencePiece BPE model and both directions."""

    def __init__(self, path: str):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if lib.is_byte(i)}
        if len(byte) != 256:
            raise ValueError("the model needs byte pieces")
        self.byte_ids = np.array([byte[b] for b in range(256)], np.int32)
        normal = {p: i for i, p in enumerate(pieces)
                  if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))}
        for p in normal:
            if SPACE in p.lstrip(SPACE) or " " in p:
                raise ValueError("a piece crosses a space")
        self.line_cut = not any("\n" in p and len(p) > 1 for p in normal)

        # Ranks by score, best first; pieces with equal scores share a rank.
        scores = np.array([lib.get_score(i) for i in range(size)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = normal.get(p[:k]), normal.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * size + right] = i
        self.size = size
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_to = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        self.pair_rank = rank[self.pair_to]
        # Pieces whose merge may open a pair at least as good as their own.
        self._reopens = np.zeros(size, bool)
        for part in (self.pair_key // size, self.pair_key % size):
            self._reopens[part[self.pair_rank <= rank[part]]] = True
        shared = np.bincount(rank[list(normal.values())]) > 1
        self._reopens |= shared[np.minimum(rank, len(shared) - 1)]

        self.char_id = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        out = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in byte.items():
            out[i] = bytes([b])
        self.out_len = np.array([len(x) for x in out], np.int64)
        self.out_off = np.cumsum(self.out_len) - self.out_len
        self.out = np.frombuffer(b"".join(out), np.uint8)
        digits = [b"%d," % i for i in range(size)]
        self.dec_len = np.array([len(x) for x in digits], np.int64)
        self.dec_off = np.cumsum(self.dec_len) - self.dec_len
        self.dec = np.frombuffer(b"".join(digits), np.uint8)
        self.cache = IdCache(np.uint32, 800_000)

    # -- encoding --
    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each document, all ids) of one slice of UTF-8 texts."""
        cut = np.zeros(len(data), bool)
        space = data == 32
        like = space.copy()  # also after the piece for a space written out in the text
        like[2:] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        cut[1:] = space[1:] & ~like[:-1]
        if self.line_cut:
            line = data == 10
            cut |= line
            cut[1:] |= line[:-1]
        start, end, doc = word_spans(data, offsets, _ALL, cut)
        first = np.isin(start, offsets[:-1])  # the library puts a space before a text
        keys = span_hash(data, start, end)
        keys = np.where(first, mix(keys + np.uint64(1)), keys)

        def missing(at):
            return self.merge([(SPACE if f else "") + data[s:e].tobytes().decode().replace(" ", SPACE)
                               for s, e, f in zip(start[at], end[at], first[at])])

        length, ids = self.cache.encode(keys, missing)
        return np.bincount(doc, length, len(offsets) - 1).astype(np.int64), ids

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each segment, all ids): the merge rounds."""
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        seg = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        sym = self.char_id[chars]
        sym = np.where(sym < 0, -1 - chars.astype(np.int64), sym).astype(np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            rank = np.full(len(sym), NO_RANK)
            to = np.full(len(sym), -1, np.int32)
            if len(sym) > 1 and len(self.pair_key):
                ok = np.flatnonzero((seg[1:] == seg[:-1]) & (sym[1:] >= 0) & (sym[:-1] >= 0))
                key = sym[ok] * self.size + sym[ok + 1]
                at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
                hit = self.pair_key[at] == key
                rank[ok[hit]], to[ok[hit]] = self.pair_rank[at[hit]], self.pair_to[at[hit]]
            begin = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            size = np.diff(np.r_[begin, len(seg)])
            best = np.repeat(np.minimum.reduceat(rank, begin), size)
            final = best == NO_RANK
            if final.any():
                done.append((seg[final], sym[final]))
                keep = ~final
                sym, seg, rank, to, best = sym[keep], seg[keep], rank[keep], to[keep], best[keep]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            new_seg = np.r_[True, seg[at[1:]] != seg[at[:-1]]]
            # Leftmost non-overlapping pairs: every second one of a run of neighbours.
            run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            only_first = np.zeros(int(seg[-1]) + 1, bool)
            only_first[seg[at[self._reopens[to[at]]]]] = True
            at = at[np.where(only_first[seg[at]], new_seg, place % 2 == 0)]
            sym[at] = to[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, seg = sym[keep], seg[keep]
        if not done:
            return np.zeros(len(segments), np.int64), np.zeros(0, np.uint32)
        seg, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(seg, kind="stable")
        return self._with_bytes(seg[order], sym[order], len(segments))

    def _with_bytes(self, seg: np.ndarray, sym: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the byte pieces of their UTF-8."""
        lost = np.flatnonzero(sym < 0)
        if not len(lost):
            return np.bincount(seg, minlength=n), sym.astype(np.uint32)
        raw = [chr(-1 - int(c)).encode() for c in sym[lost]]
        size = np.ones(len(sym), np.int64)
        size[lost] = [len(r) for r in raw]
        out = np.repeat(sym, size)
        first = (np.cumsum(size) - size)[lost]
        out[ranges(first, size[lost])] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return np.bincount(np.repeat(seg, size), minlength=n), out.astype(np.uint32)

    # -- decoding --
    def decode(self, n: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """Texts (UTF-8) of documents with n ids each: pieces one after
        another, without the space that encoding put first."""
        size = self.out_len.take(ids)
        raw = self.out.take(ranges(self.out_off.take(ids), size)).tobytes()
        to = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
        return [raw[a + 1 if raw[a:a + 1] == b" " else a:b] for a, b in zip(to[:-1], to[1:])]

    def decimals(self, n: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """Decimal ids joined by commas, for each document."""
        size = self.dec_len.take(ids)
        raw = self.dec.take(ranges(self.dec_off.take(ids), size)).tobytes()
        to = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
        return [raw[a:max(a, b - 1)] for a, b in zip(to[:-1], to[1:])]


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int), decoded (text) of every document."""
    prepare(docs.sparkSession)

    def run(batches):
        m = model(model_path)
        for doc_ids, data, offsets in text_slices(batches):
            n, ids = m.encode(data, offsets)
            at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(list(doc_ids), pa.int64()),
                "ids": pa.ListArray.from_arrays(at, pa.array(ids.astype(np.int32))),
                "decoded": pa.array([x.decode() for x in m.decode(n, ids)], pa.string())})

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: n_tokens and digests of the ids and of the decoded text."""
    prepare(docs.sparkSession)

    def run(batches):
        m = model(model_path)
        for doc_ids, data, offsets in text_slices(batches):
            n, ids = m.encode(data, offsets)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(list(doc_ids), pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in m.decimals(n, ids)],
                "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in m.decode(n, ids)]})

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
