"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Pieces and scores come from a model file that the driver reads once (``MODEL_FILE``, a
parameter); nothing is trained. The trie is over UTF-8 bytes with the white-space marker as
one byte, in two arrays: the child of state s by byte c is ``base[s] + c + 1`` where
``check`` names s as its parent. The best segmentation has the largest sum of log scores;
a character without a piece of its own costs ``UNKNOWN`` below the worst score and becomes
its bytes' pieces. Marker bytes stand for spaces only, so a literal marker character in a
text also goes through byte pieces and every text decodes to itself.

Pieces hold markers at their start only (checked on load), so a text falls apart at its
spaces without changing the best path: distinct segments of a batch are solved together,
one numpy step per (place, length), and remembered; long ones are solved one by one.

Models whose scores are merge ranks (not log probabilities) get log scores by Zipf's law:
``-ln(rank + 1) - ln(H)`` in order of their scores.

Defined results: null and empty texts have no pieces and decode to the empty text. Of paths
with equal scores the one whose last piece starts first wins, place by place. Rows are
encoded one by one (repeated rows alike); extra columns pass through, columns named like
the results are replaced. Very long texts are cut at spaces, without effect on the result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import column_bytes, slices, table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARKER, UNKNOWN = "▁", 10.0  # fixed values: white-space marker, penalty below the worst score
LONG, CACHE_SEGMENTS, CHUNK_BYTES, BATCH_BYTES = 48, 1_000_000, 1 << 20, 4 << 20
SEGMENT = re.compile(rb" *[^ ]+| +")
#: Bytes of a UTF-8 character by its first byte.
CHAR_BYTES = np.asarray([1 if c < 0xC0 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4 for c in range(256)])


def log_scores(scores: list[float]) -> list[float]:
    """Zipf's law over the order of ``scores`` (largest first, then by place)."""
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))
    total = math.log(sum(1 / (r + 1) for r in range(len(scores))))
    out = [0.0] * len(scores)
    for r, i in enumerate(order):
        out[i] = -math.log(r + 1) - total
    return out


def double_array(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie over distinct byte strings; value is the word's place or -1.

    Places for the children of a state are searched from where single places, or sets of
    places, were last hard to find.
    """
    root: list = [{}, -1]
    for n, word in enumerate(words):
        node = root
        for c in word:
            node = node[0].setdefault(c, [{}, -1])
        node[1] = n
    base, check, value = [0], [-2], [-1]

    def grow(n: int) -> None:
        if n > len(check):
            more = max(n, 2 * len(check)) - len(check)
            base.extend([0] * more), check.extend([-1] * more), value.extend([-1] * more)

    single = many = 0
    queue = [(root, 0)]
    for node, s in queue:
        value[s] = node[1]
        codes = sorted(node[0])
        if not codes:
            continue
        b = max(0, (single if len(codes) == 1 else many) - codes[0])
        tried = 0
        grow(b + 258)
        while any(check[b + c + 1] != -1 for c in codes):
            b += 1
            tried += 1
            grow(b + 258)
        if len(codes) == 1:
            single = b + codes[0]
        elif tried > 64:
            many = b + codes[0]
        base[s] = b
        for c in codes:
            check[b + c + 1] = s
            queue.append((node[0][c], b + c + 1))
    grow(max(base) + 258)
    return tuple(np.asarray(x, np.int32) for x in (base, check, value))


def load_model(path: str = MODEL_FILE, ranks: bool = True) -> dict:
    """Pieces of a model file as plain arrays; ``ranks``: its scores are merge ranks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    normal = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return piece_model([sp.id_to_piece(i) for i in normal], [sp.get_score(i) for i in normal], normal,
                       [sp.piece_to_id(f"<0x{c:02X}>") for c in range(256)], ranks)


def piece_model(pieces: list[str], scores: list[float], ids: list[int], byte_ids: list[int], ranks: bool) -> dict:
    """``ids[i]`` is the token of ``pieces[i]``, ``byte_ids[c]`` that of byte c."""
    if any(MARKER in p.lstrip(MARKER) for p in pieces):
        raise ValueError("pieces may hold the white-space marker at their start only")
    raw = [p.replace(MARKER, " ").encode() for p in pieces]
    base, check, value = double_array(raw)
    scores = log_scores(scores) if ranks else scores
    return {"base": base, "check": check, "value": value, "score": np.asarray(scores, np.float64),
            "ids": np.asarray(ids, np.int32), "byte_ids": np.asarray(byte_ids, np.int32),
            "raw": dict(zip(ids, raw)) | {t: bytes([c]) for c, t in enumerate(byte_ids)}}


class Encoder:
    """Segments -> tokens, with the segments seen so far."""

    def __init__(self, model: dict) -> None:
        self.__dict__.update(model)
        self.unknown = float(self.score.min()) - UNKNOWN
        self.lists = [x.tolist() for x in (self.base, self.check, self.value, self.score)]
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.tokens = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for own, part in _chunks(texts):
            segments: list[bytes] = []
            ends = []
            for t in part:
                segments.extend(SEGMENT.findall(t))
                ends.append(len(segments))
            at = self._places(segments)
            sizes = self.sizes[at]
            shift = np.cumsum(sizes) - sizes
            flat = self.tokens[np.repeat(self.starts[at] - shift, sizes) + np.arange(int(sizes.sum()))]
            cut = np.concatenate(([0], np.cumsum(sizes)))
            begin = 0
            for i, end in zip(own, ends):
                out[i].append(flat[cut[begin]:cut[end]])
                begin = end
        return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]

    def _places(self, segments: list[bytes]) -> np.ndarray:
        if len(self.place) > CACHE_SEGMENTS:
            self.forget()
        at = np.fromiter(map(self.place.get, segments, repeat(-1)), np.int64, len(segments))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list(dict.fromkeys(segments[i] for i in missing))
            by_size: dict[int, list[bytes]] = {}
            for s in new:
                by_size.setdefault(len(s) if len(s) <= LONG else 0, []).append(s)
            for s in by_size.pop(0, ()):
                tokens = self._one(s)
                self._remember([s], tokens, np.asarray([len(tokens)]))
            for group in _neighbours(by_size):
                self._remember(group, *self._together(group))
            for i in missing:
                at[i] = self.place[segments[i]]
        return at

    def _remember(self, segments: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.place)
        if self.used + len(flat) > len(self.tokens):
            self.tokens = np.concatenate([self.tokens, np.zeros(self.used + len(flat), np.int32)])
        if n + len(segments) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(n + len(segments), np.int64)])
                                       for x in (self.starts, self.sizes))
        self.tokens[self.used:self.used + len(flat)] = flat
        self.starts[n:n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + len(sizes)] = sizes
        self.used += len(flat)
        self.place.update(zip(segments, range(n, n + len(segments))))

    def _one(self, s: bytes) -> np.ndarray:
        """Viterbi over one segment."""
        base, check, value, score = self.lists
        size = len(base)
        best, back, piece = [0.0] + [-math.inf] * len(s), [0] * (len(s) + 1), [-1] * (len(s) + 1)
        for i in range(len(s)):
            if best[i] == -math.inf:
                continue
            one, state, own = int(CHAR_BYTES[s[i]]), 0, False
            for j in range(i, len(s)):
                child = base[state] + s[j] + 1
                if child >= size or check[child] != state:
                    break
                state = child
                if value[state] >= 0:
                    own = own or j + 1 - i == one
                    if best[i] + score[value[state]] > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = best[i] + score[value[state]], i, value[state]
            end = min(len(s), i + one)
            if not own and best[i] + self.unknown > best[end]:
                best[end], back[end], piece[end] = best[i] + self.unknown, i, -1
        out: list[int] = []
        i = len(s)
        while i:
            out += [int(self.ids[piece[i]])] if piece[i] >= 0 else [int(self.byte_ids[c]) for c in s[back[i]:i][::-1]]
            i = back[i]
        return np.asarray(out[::-1], np.int32)

    def _together(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over segments of similar sizes at once: their tokens in a row, and how many each has."""
        n, width = len(segments), max(map(len, segments))
        size = np.fromiter(map(len, segments), np.int64, n)
        code = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in segments), np.uint8).reshape(n, width).astype(np.int64)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 1), np.int16)
        piece = np.full((n, width + 1), -1, np.int32)
        for i in range(width):
            live = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
            if not len(live):
                continue
            own, one = np.zeros(n, bool), CHAR_BYTES[code[:, i]]
            rows, state = live, np.zeros(len(live), np.int64)
            for j in range(i, width):
                child = self.base[state] + code[rows, j] + 1
                ok = (self.check[child] == state) & (size[rows] > j)
                rows, state = rows[ok], child[ok]
                if not len(rows):
                    break
                v = self.value[state]
                done = v >= 0
                r, v = rows[done], v[done]
                own[r[one[r] == j + 1 - i]] = True
                s = best[r, i] + self.score[v]
                better = s > best[r, j + 1]
                r, v = r[better], v[better]
                best[r, j + 1], back[r, j + 1], piece[r, j + 1] = s[better], i, v
            lost = live[~own[live]]
            if len(lost):
                end = np.minimum(size[lost], i + one[lost])
                s = best[lost, i] + self.unknown
                better = s > best[lost, end]
                r, end = lost[better], end[better]
                best[r, end], back[r, end], piece[r, end] = s[better], i, -1
        steps, rows, end = [], np.arange(n), size.copy()
        while len(rows):  # from the ends of all segments back to their starts
            begin = back[rows, end].astype(np.int64)
            steps.append((rows, begin, end, piece[rows, end]))
            rows, end = rows[begin > 0], begin[begin > 0]
        row, begin, end, own = (np.concatenate(x[::-1]) for x in zip(*steps))
        order = np.argsort(row, kind="stable")
        row, begin, end, own = row[order], begin[order], end[order], own[order]
        count = np.where(own >= 0, 1, end - begin)
        place = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        row_, own_ = np.repeat(row, count), np.repeat(own, count)
        flat = np.where(own_ >= 0, self.ids[own_], self.byte_ids[code[row_, np.minimum(place, width - 1)]])
        return flat.astype(np.int32), np.bincount(row, count, n).astype(np.int64)

    def decode(self, tokens) -> bytes:
        """Pieces joined, markers as spaces, byte pieces as bytes, without the leading space."""
        return b"".join(map(self.raw.get, tokens, repeat(b"")))[1:]


def _neighbours(by_size: dict[int, list[bytes]], most: int = 1 << 22) -> Iterator[list[bytes]]:
    """Segments of sizes 1-8, 9-12, ... together, in groups of bounded area."""
    group: list[bytes] = []
    for size in sorted(by_size):
        for s in by_size[size]:
            group.append(s)
            if len(group) * size > most:
                yield group
                group = []
        if group and size >= 8 and size % 4 == 0:
            yield group
            group = []
    if group:
        yield group


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts with their leading space, about ``CHUNK_BYTES`` at a time, long ones cut before spaces."""
    own: list[int] = []
    part: list[bytes] = []
    total = 0
    for i, t in enumerate(texts):
        t = b" " + t if t else t
        begin = 0
        while begin < len(t):
            end = len(t)
            if end - begin > CHUNK_BYTES:
                m = re.compile(rb"[^ ](?= )").search(t, begin + CHUNK_BYTES)
                end = m.end() if m else end
            own.append(i)
            part.append(t[begin:end])
            total += end - begin
            begin = end
            if total >= CHUNK_BYTES:
                yield own, part
                own, part, total = [], [], 0
    if part:
        yield own, part


def encoder_of(model: dict) -> Encoder:
    """The encoder of a broadcast model: kept with it, so a worker's later tasks know its segments."""
    if "encoder" not in model:
        model["encoder"] = Encoder(model)
    return model["encoder"]


def encode(docs: DataFrame, model: dict | None = None, verify: bool = True) -> DataFrame:
    """``docs`` plus ``ids`` and ``n_pieces``; with ``verify`` also ``round_trip`` (decodes to the text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model or load_model())
    new = ["ids", "n_pieces", *["round_trip"] * verify]
    keep = [c for c in docs.columns if c not in new]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), *[T.StructField("round_trip", T.BooleanType())] * verify])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder_of(sent.value)
        for b in slices(batches, "text", BATCH_BYTES):
            texts = column_bytes(b.column(b.schema.get_field_index("text")))
            ids = e.encode(texts)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            cut = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            cols = [pa.ListArray.from_arrays(pa.array(cut), pa.array(flat, pa.int32())), pa.array(sizes)]
            if verify:
                cols.append(pa.array([e.decode(x.tolist()) == t for x, t in zip(ids, texts)]))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*keep, *new])

    return docs.select(*keep).mapInArrow(run, schema)


def decode(rows: DataFrame, model: dict | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` plus ``decoded``: the text of the token ids (null ids: the empty text)."""
    sent = rows.sparkSession.sparkContext.broadcast(model or load_model())
    keep = [c for c in rows.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(sent.value)
        for b in batches:
            t = [e.decode(x or ()).decode("utf-8", "replace") for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(t, pa.string())], [*b.schema.names, "decoded"])

    return rows.select(*keep).mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep),
                                                            T.StructField("decoded", T.StringType())]))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_pieces", "round_trip", "ids")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: token ids of every text, checked to decode to it."""
    return encode(docs).select("doc_id", "lang", "source", "n_pieces", "round_trip", "ids")
