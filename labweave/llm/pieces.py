"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

Blanks become the mark U+2581 and a text gets one mark in front, as the model's settings say; a
marked word is a run of marks with what follows it. No piece crosses from one marked word into
the next (checked when the model is read), so words are encoded on their own, each distinct one
of a batch once.

The distinct words are sorted, which makes them a trie in depth-first order, and traversed with
one stack of forward states: a word drops the states behind the prefix it shares with its
predecessor and goes on from there. A state is the last piece of the best segmentation of its
prefix.

For a unigram model that is the highest sum of scores. A pair-merge model (the public vocabulary
at hand is one) has no such sum: its segmentation is the one in which no two neighbours
could have been merged otherwise. There a piece may follow another only if merging the two
alone gives these two back; of the pieces that end at a prefix exactly one fits the state it
starts from, so the same forward pass finds the library's own segmentation. Runs of several
marks, whose merges all have one equal score, are merged directly.

Unknown characters become their UTF-8 byte pieces if the model has them, else the unknown id.
Null text gives null ids, empty text none. Decoding joins pieces, bytes and marks back; it
restores every text but for U+2581, which reads as a blank.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labweave.llm.common import in_arrow

MARK = "▁"
#: Distinct words whose ids a task remembers, and the longest word it remembers.
MEMO_WORDS = 500_000
MEMO_CHARS = 64
#: Piece pairs whose fit a task remembers.
MEMO_PAIRS = 1_500_000
_KEY = 1 << 32
_SINGLE = (1,)

_MARKED = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6  # piece types of the model format


def piece_sizes(pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
    """By their last three or two characters: the sizes that pieces ending there may have, the
    largest first and always 1."""
    ends: dict[str, set[int]] = {}
    for p in pieces:
        for k in (2, 3):
            if len(p) >= k:
                ends.setdefault(p[-k:], {1}).add(len(p))
    for end, sizes in ends.items():
        if len(end) == 3:
            sizes |= {n for n in ends.get(end[1:], ()) if n == 2}
        else:
            ends[end] = sizes & {1, 2}  # longer ones are found by three characters
    return {end: tuple(sorted(sizes, reverse=True)) for end, sizes in ends.items()}


class PieceModel:
    """Pieces, scores and segmentation of one model file."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        self.kind = proto.trainer_spec.model_type
        spec = proto.normalizer_spec
        if self.kind not in (_UNIGRAM, _BPE) or spec.precompiled_charsmap or (
                spec.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only unigram and pair-merge models without normalisation")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.texts = [p.piece if p.type == _NORMAL else "" for p in proto.pieces]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses a word mark")
        self.sizes = piece_sizes(self.ids)
        self._pairs: dict[int, bool] = {}
        self._worst = min(self.score.values(), default=0.0) - 10.0

    def merged(self, word: str) -> list[str]:
        """Pair merging from single characters: best score first, then the leftmost."""
        if len(word) > 24:
            return self._merged_long(word)
        get, none = self.score.get, float("-inf")
        part = list(word)
        gain = [get(x + y, none) for x, y in zip(part, part[1:])]
        while gain and (top := max(gain)) > none:
            i = gain.index(top)
            part[i:i + 2] = [part[i] + part[i + 1]]
            del gain[i]
            if i:
                gain[i - 1] = get(part[i - 1] + part[i], none)
            if i < len(gain):
                gain[i] = get(part[i] + part[i + 1], none)
        return part

    def _merged_long(self, word: str) -> list[str]:
        """The same with a heap, for words of any length."""
        left = list(range(-1, len(word) - 1))
        right = [*range(1, len(word)), -1]
        part = list(word)
        heap: list[tuple[float, int, str, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (s := self.score.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (-s, a, part[a], part[b]))

        for i in range(len(word) - 1):
            offer(i, i + 1)
        while heap:
            _, a, x, y = heapq.heappop(heap)
            b = right[a]
            if part[a] != x or b < 0 or part[b] != y:
                continue
            part[a], part[b] = x + y, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in part if p]

    def _fits(self, first: int, second: int) -> bool:
        """Whether piece ``second`` may follow ``first`` (negative: a word's start or an unknown
        character, which merge with nothing)."""
        pieces = [self.texts[second]] if first < 0 else [self.texts[first], self.texts[second]]
        return self.merged("".join(pieces)) == pieces

    def segment_sorted(self, words: Iterable[str]) -> Iterator[list[str]]:
        """Pieces of each word; ``words`` come in order and share forward states."""
        ids, sizes, pairs, score = self.ids, self.sizes, self._pairs, self.score
        bpe = self.kind == _BPE
        size = [0]      # by prefix length: characters of its last piece
        state = [-1]    # by prefix length: id of its last piece, -1 for none or an unknown one
        best = [0.0]    # by prefix length: score of its segmentation (unigram)
        last = ""
        for word in words:
            if bpe and word.startswith(MARK * 2):
                yield self.merged(word)
                continue
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del size[shared + 1:], state[shared + 1:], best[shared + 1:]
            last = word
            for end in range(shared + 1, len(word) + 1):
                pick, found = 1, -1
                tail = sizes.get(word[end - 3:end]) if end > 2 else None
                if tail is None:
                    tail = sizes.get(word[end - 2:end], _SINGLE) if end > 1 else _SINGLE
                if bpe:
                    for n in tail:
                        if n > end:
                            continue
                        piece = ids.get(word[end - n:end])
                        if piece is None:
                            continue
                        key = state[end - n] * _KEY + piece
                        fits = pairs.get(key)
                        if fits is None:
                            fits = pairs[key] = self._fits(state[end - n], piece)
                        if fits:
                            pick, found = n, piece
                            break
                else:
                    top = best[end - 1] + self._worst
                    for n in reversed(tail):
                        if n > end:
                            break
                        s = score.get(word[end - n:end])
                        if s is not None and (best[end - n] + s > top or n == 1):
                            top, pick = best[end - n] + s, n
                    best.append(top)
                size.append(pick)
                state.append(found)
            pieces, end = [], len(word)
            while end:
                pieces.append(word[end - size[end]:end])
                end -= size[end]
            yield pieces[::-1]
            if len(pairs) > MEMO_PAIRS:
                pairs.clear()

    def piece_ids(self, pieces: Iterable[str]) -> bytes:
        """Ids as 32-bit numbers end to end."""
        out: list[int] = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:  # neighbouring unknowns are one
                out.append(self.unknown)
        return array("i", out).tobytes()

    def marked_words(self, text: str) -> list[str]:
        return _MARKED.findall(self.prefix + text.replace(" ", MARK)) if text else []

    def encode(self, texts: Sequence[str | None], memo: dict[str, bytes]) -> list:
        """Ids of each text. ``memo`` keeps the ids of words seen ahead."""
        split = [None if t is None else self.marked_words(t) for t in texts]
        new = sorted({w for ws in split if ws for w in ws if w not in memo})
        memo.update(zip(new, map(self.piece_ids, self.segment_sorted(new))))
        get = memo.__getitem__
        out = [None if ws is None else np.frombuffer(b"".join(map(get, ws)), np.int32)
               for ws in split]
        if len(memo) > MEMO_WORDS:
            memo.clear()
        else:
            for w in new:
                if len(w) > MEMO_CHARS:
                    del memo[w]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        texts = self.texts
        if self.byte_of and not self.byte_of.keys().isdisjoint(ids):
            raw = b"".join(
                bytes([self.byte_of[i]]) if i in self.byte_of else texts[i].encode() for i in ids)
            out = raw.decode("utf-8", "replace")
        else:
            out = "".join([texts[i] for i in ids])
        out = out.replace(MARK, " ")
        return out[1:] if self.prefix and out.startswith(" ") else out


def model_from(spark, path: str):
    """The model's bytes, read once by the driver (a few hundred kB) and sent to the tasks."""
    if "://" in path:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            data = f.read()
    PieceModel(data)  # refuses what it can't encode
    return spark.sparkContext.broadcast(data)


_models: dict[int, PieceModel] = {}


def _model(data) -> PieceModel:
    """One parsed model per Python worker."""
    key = data.id if hasattr(data, "id") else id(data)
    if key not in _models:
        _models.clear()
        _models[key] = PieceModel(data.value)
    return _models[key]


def encode_texts(docs: DataFrame, model_path: str, *, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``ids`` and ``restored``: whether decoding the ids gives the
    text back (null for null)."""
    data = model_from(docs.sparkSession, model_path)
    src = docs.select(*[F.col(c) for c in keep], F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = _model(data), {}
        for b in batches:
            texts = b.column("_text").to_pylist()
            ids = model.encode(texts, memo)
            sizes = [None if i is None else len(i) for i in ids]
            offsets = np.concatenate([[0], np.cumsum([n or 0 for n in sizes])]).astype(np.int32)
            flat = np.concatenate([i for i in ids if i is not None] or [np.empty(0, np.int32)])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(flat, pa.int32()),
                mask=pa.array([n is None for n in sizes]))
            restored = [None if t is None else model.decode(i.tolist()) == t.replace(MARK, " ")
                        for t, i in zip(texts, ids)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sizes, pa.int64()), lists, pa.array(restored)],
                names=[*b.schema.names[:-1], "n_tokens", "ids", "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1])
    return in_arrow(src, run, f"{fields}, n_tokens long, ids array<int>, restored boolean")


def decode_ids(rows: DataFrame, model_path: str, *, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the ``text`` of ``ids``; null ids give null text."""
    data = model_from(rows.sparkSession, model_path)
    src = rows.select(*[F.col(c) for c in keep], F.col("ids").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data)
        for b in batches:
            texts = [None if i is None else model.decode(i) for i in b.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(texts, pa.string())], names=[*b.schema.names[:-1], "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1])
    return in_arrow(src, run, f"{fields}, text string")
