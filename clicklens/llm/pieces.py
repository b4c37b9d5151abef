"""SentencePiece encoding and decoding in batched numpy.

Text is cut before each run of spaces; a cut is a word with its leading spaces
written as the piece file's space mark (a text starts with one extra mark).
The distinct words of a batch are grouped by length and all words of a length
advance together: substring hashes of every piece length probe the sorted piece keys
(those only whose first bits are some piece's), then for each end position the best
total score and its backpointer are kept (Viterbi). Characters without a piece become byte pieces, so decoding
gives back every text exactly, also texts that contain the space mark itself.

The piece file is a parameter (``model_path``); its pieces and scores, a fixed
table, go to the tasks. Pieces never hold a mark after another character, so
cutting before spaces loses no segmentation.

Defined cases: null and empty texts have no pieces; repeated rows encode alike;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import ready

MARK = 0x2581
LITERAL_MARK = 0x110000  # stands for a mark that the text itself holds
FIRST_BITS = np.uint64(18)  # of a hash, looked up before the piece keys are searched
CELLS = 100_000  # words times characters that advance together
KNOWN_WORDS = 500_000


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _char_codes(points: np.ndarray) -> np.ndarray:
    return tb.mix(points.astype(np.uint64) + np.uint64(0x1F123BB5))


def _powers(n: int):
    return tb.radix_powers(n + 1)


class Known:
    """Words segmented so far by one task, at most about ``KNOWN_WORDS``."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.keys, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pieces, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def trim(self):
        if len(self.keys) > KNOWN_WORDS:
            self.clear()

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return self.order[np.searchsorted(self.keys, keys)]

    def add(self, keys: np.ndarray, pieces: np.ndarray, count: np.ndarray):
        every = np.concatenate([self.keys, keys])
        slot = np.concatenate([self.order, len(self.at) - 1 + np.arange(len(keys))])
        by = np.argsort(every, kind="stable")
        self.keys, self.order = every[by], slot[by]
        self.pieces = np.concatenate([self.pieces, pieces])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(count)])


@dataclass(frozen=True)
class Pieces:
    keys: np.ndarray  # sorted hashes of normal pieces
    ids: np.ndarray
    scores: np.ndarray
    seen: np.ndarray  # whether a piece's hash has these first bits
    longest: int
    byte_ids: np.ndarray  # id of the piece of each byte
    unknown: float  # score of a character that falls back to bytes
    text: np.ndarray  # decoded bytes of all pieces, end to end
    text_at: np.ndarray

    @staticmethod
    def load(model_path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        byte_ids, found, decoded = np.zeros(256, np.int32), [], []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                decoded.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                decoded.append(b"")
            else:
                found.append((i, [ord(c) for c in piece], sp.get_score(i)))
                decoded.append(piece.replace(chr(MARK), " ").encode())
        up, _ = _powers(max(len(p) for _, p, _ in found))
        keys = np.array([_finish(np.sum(_char_codes(np.array(p)) * up[: len(p)], dtype=np.uint64), len(p)) for _, p, _ in found],
                        dtype=np.uint64).ravel()
        order = np.argsort(keys)
        scores = np.array([s for _, _, s in found])
        at = np.concatenate([[0], np.cumsum([len(d) for d in decoded])])
        seen = np.zeros(1 << int(FIRST_BITS), bool)
        seen[keys >> (np.uint64(64) - FIRST_BITS)] = True
        return Pieces(keys[order], np.array([i for i, _, _ in found], np.int32)[order], scores[order], seen,
                      max(len(p) for _, p, _ in found), byte_ids, float(scores.min()) - 10.0,
                      np.frombuffer(b"".join(decoded), np.uint8), at)

    def viterbi(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segment words of one length (rows of code points): pieces in order,
        end to end, and pieces per word. A negative piece is ``-1 - point``."""
        n, length = words.shape
        up, down = _powers(length)
        prefix = np.zeros((n, length + 1), np.uint64)
        np.cumsum(_char_codes(words) * up[:length], axis=1, out=prefix[:, 1:])
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        step = np.ones((n, length + 1), np.int32)
        piece = np.zeros((n, length + 1), np.int32)
        found = [self._places(prefix, down, size) for size in range(1, min(length, self.longest) + 1)]
        for j in range(1, length + 1):
            best[:, j] = best[:, j - 1] + self.unknown
            piece[:, j] = -1 - words[:, j - 1]
            for size, (row, at, bounds) in enumerate(found[:j], 1):
                lo, hi = bounds[j - size], bounds[j - size + 1]
                if lo == hi:
                    continue
                r, p = row[lo:hi], at[lo:hi]
                total = best[r, j - size] + self.scores[p]
                better = total > best[r, j]
                r, p = r[better], p[better]
                best[r, j] = total[better]
                step[r, j] = size
                piece[r, j] = self.ids[p]
        out = np.zeros((n, length), np.int32)
        count, pos, rows = np.zeros(n, np.int64), np.full(n, length), np.arange(n)
        while True:
            live = pos > 0
            if not live.any():
                break
            r = rows[live]
            out[r, length - 1 - count[r]] = piece[r, pos[r]]
            pos[r] -= step[r, pos[r]]
            count[r] += 1
        filled = np.arange(length)[None, :] >= length - count[:, None]
        return out[filled], count

    def _places(self, prefix: np.ndarray, down: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Where pieces of ``size`` characters occur: word and piece by start, and the
        bounds of each start."""
        starts = prefix.shape[1] - size
        key = _finish((prefix[:, size:] - prefix[:, :starts]) * down[:starts], size).T
        start, row = np.nonzero(self.seen[key >> (np.uint64(64) - FIRST_BITS)])
        key = key[start, row]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return row[hit], at[hit], np.searchsorted(start[hit], np.arange(starts + 1)).tolist()

    def expand(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace negative pieces by the byte pieces of their characters."""
        point = np.where(flat < 0, -1 - flat, 0)
        point = np.where(point == LITERAL_MARK, MARK, point)
        size = np.where(flat < 0, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), 1)
        at = np.repeat(np.arange(len(flat)), size)
        k = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        p, s = point[at], size[at]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[s] | (p >> (6 * (s - 1)))
        byte = np.where(s == 1, p, np.where(k == 0, lead, 0x80 | ((p >> np.maximum(6 * (s - 1 - k), 0)) & 0x3F)))
        word = np.repeat(np.arange(len(count)), count)
        return (np.where(flat[at] < 0, self.byte_ids[byte & 0xFF], flat[at]).astype(np.int32),
                np.bincount(word, weights=size, minlength=len(count)).astype(np.int64))

    def encode(self, buf: np.ndarray, offsets: np.ndarray, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts of a chunk, end to end, and pieces per text.
        ``known`` keeps the words of earlier chunks."""
        known = known or Known()
        n = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        space = buf == 0x20
        cut = np.zeros(len(buf), bool)
        cut[0] = True
        cut[1:] = space[1:] & ~space[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[heads] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(buf))
        first = np.zeros(len(buf), bool)
        first[heads] = True
        key = tb.RangeHash(buf)(start, end) ^ first[start].astype(np.uint64)
        distinct, one, place = np.unique(key, return_index=True, return_inverse=True)
        new = ~known.has(distinct)
        if new.any():
            at = one[new]
            known.add(distinct[new], *self._words([buf[a:b].tobytes() for a, b in zip(start[at], end[at])], first[start[at]]))
        slot = known.slots(distinct)[place]
        doc = np.searchsorted(offsets, start, side="right") - 1
        total = np.bincount(doc, weights=(known.at[1:] - known.at[:-1])[slot], minlength=n).astype(np.int64)
        ids = _gather(known.pieces, known.at, slot)
        known.trim()
        return ids, total

    def _words(self, raw: list[bytes], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = [np.frombuffer((" " if f else "").encode("utf-32-le") + w.decode("utf-8").encode("utf-32-le"), np.uint32)
                for w, f in zip(raw, first)]
        length = np.array([len(t) for t in text])
        order = np.argsort(length, kind="stable")
        parts, counts = [], []
        at = 0
        while at < len(order):
            size = int(length[order[at]])
            stop = int(np.searchsorted(length[order], size, side="right"))
            stop = min(stop, at + max(1, CELLS // size))
            words = np.stack([text[i] for i in order[at:stop]]).astype(np.int64)
            words[words == MARK] = LITERAL_MARK
            words[words == 0x20] = MARK
            flat, count = self.expand(*self.viterbi(words))
            parts.append(flat)
            counts.append(count)
            at = stop
        count, flat = np.concatenate(counts), np.concatenate(parts)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _gather(flat, np.concatenate([[0], np.cumsum(count)]), back), count[back]

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, end to end, and bytes per text."""
        size = (self.text_at[1:] - self.text_at[:-1])[ids]
        flat = _gather(self.text, self.text_at, ids)
        doc = np.repeat(np.arange(len(count)), count)
        total = np.bincount(doc, weights=size, minlength=len(count)).astype(np.int64)
        lead = (np.cumsum(total) - total)[total > 0]  # the extra mark of each text
        keep = np.ones(len(flat), bool)
        keep[lead] = False
        return flat[keep], total - (total > 0)


def _finish(h, size):
    return tb.mix(np.atleast_1d(np.asarray(h, np.uint64)) + np.uint64(size) * np.uint64(0x9E3779B97F4A7C15 % (1 << 32)))


def _gather(flat: np.ndarray, at: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenate the slices ``flat[at[k]:at[k + 1]]`` for k in ``which``."""
    size = (at[1:] - at[:-1])[which]
    shift = np.repeat(at[which] - (np.cumsum(size) - size), size)
    return flat[np.arange(len(shift)) + shift]


def encode_documents(docs: DataFrame, model_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Per row: ``doc_id, n_pieces, ids_sha256`` (of the ids as 32-bit little
    endian), ``round_trip`` (the ids decode to the text) and the ids."""
    ready(docs.sparkSession)
    pieces = Pieces.load(model_path or default_model())
    schema = "doc_id long, n_pieces long, ids_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids

    def run(batches):
        known = Known()
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                ids, count = pieces.encode(buf, offsets, known)
                back, size = pieces.decode(ids, count)
                stop, b = np.cumsum(count), np.cumsum(size)
                n = len(count)
                same = [buf[offsets[k] : offsets[k + 1]].tobytes() == back[b[k] - size[k] : b[k]].tobytes() for k in range(n)]
                digest = [hashlib.sha256(ids[stop[k] - count[k] : stop[k]].astype("<i4").tobytes()).hexdigest() for k in range(n)]
                columns = [batch.column(0).slice(at, n), pa.array(count), pa.array(digest), pa.array(same)]
                names = ["doc_id", "n_pieces", "ids_sha256", "round_trip"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, stop), pa.int32()), pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
