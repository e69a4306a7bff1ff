"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The symbols of a text start as characters. An agenda holds the adjacent pairs
whose concatenation is a piece, ordered by score and then by position; the best
pair is merged and its new neighbours enter, until the agenda is empty. What is
no piece falls back to bytes. In vocabularies without a piece that has a space
mark after another character, no merge crosses into the next word: words are
encoded one by one and remembered.

Every Arrow batch checks the words that are new to it against the sentencepiece
library; a difference is an error. The model file is read once by the driver and
goes out with the tasks (its size is that of the vocabulary).

Defined results: null and empty texts have no ids and decode to the empty text.
Repeated rows are encoded each; a null id stays null. Further columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
MEMO_WORDS = 450_000
SHORT = 40
codecs.register_error("each", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class PieceCodec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.unknown = sp.unk_id()
        self.piece_of = {pieces[i]: i for i in plain}
        scores = {i: sp.get_score(i) for i in plain}
        places = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {i: places[s] for i, s in scores.items()}
        self.rank[None] = len(places)  # no pair, behind all others
        self.byte_ids = {int(pieces[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.raw = [b""] * size  # control pieces decode to nothing
        for i in plain:
            self.raw[i] = pieces[i].replace(SPACE, " ").encode()
        for value, i in self.byte_ids.items():
            self.raw[i] = bytes([value])
        if self.unknown >= 0:
            self.raw[self.unknown] = " ⁇ ".encode()
        self.specials = set(range(size)) - set(plain) - set(self.byte_ids.values())
        self.bytes_only = set(self.byte_ids.values())
        self.merged = {}  # (left, right) as one number -> merged piece
        for i in plain:
            for cut in range(1, len(pieces[i])):
                left, right = self.piece_of.get(pieces[i][:cut]), self.piece_of.get(pieces[i][cut:])
                if left is not None and right is not None:
                    self.merged[left * size + right] = i
        self.size = size
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.piece_of)
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def agenda(self, word: str) -> tuple[int, ...]:
        """Ids of a word (or of a whole text) whose spaces are marks."""
        whole = self.piece_of.get(word)
        merged, rank, size = self.merged, self.rank, self.size
        symbols = [self.piece_of.get(c, -1) for c in word]
        n = len(symbols)
        if n == 1 and whole is not None:
            return (whole,)
        if n <= SHORT and -1 not in symbols:
            return self.short_agenda(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if symbols[i] >= 0 and (m := merged.get(symbols[i] * size + symbols[i + 1])) is not None and symbols[i + 1] >= 0:
                heap.append((rank[m], i))
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            place, i = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or symbols[i] < 0 or symbols[j] < 0:
                continue
            m = merged.get(symbols[i] * size + symbols[j])
            if m is None or rank[m] != place:
                continue  # one of the two has changed
            symbols[i] = m
            gone[j] = True
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if symbols[k] >= 0 and (x := merged.get(m * size + symbols[k])) is not None:
                    heapq.heappush(heap, (rank[x], i))
            h = before[i]
            if h >= 0 and symbols[h] >= 0 and (x := merged.get(symbols[h] * size + m)) is not None:
                heapq.heappush(heap, (rank[x], h))
        out = []
        for i in range(n):
            if not gone[i]:
                if symbols[i] >= 0:
                    out.append(symbols[i])
                elif self.byte_ids:
                    out.extend(self.byte_ids[b] for b in word[i].encode())
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
        return tuple(out)

    def short_agenda(self, symbols: list[int]) -> tuple[int, ...]:
        """The agenda of a short word as a plain list of the places of its pairs."""
        find, rank, size = self.merged.get, self.rank, self.size
        none = rank[None]
        places = [rank[find(a * size + b)] for a, b in zip(symbols, symbols[1:])]
        while places and (best := min(places)) != none:
            i = places.index(best)
            m = find(symbols[i] * size + symbols[i + 1])
            symbols[i:i + 2] = (m,)
            del places[i]
            if i:
                places[i - 1] = rank[find(symbols[i - 1] * size + m)]
            if i < len(places):
                places[i] = rank[find(m * size + symbols[i + 1])]
        return tuple(symbols)

    def words(self, text: str) -> list[str]:
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        return WORD.findall(marked) if self.by_word else [marked] if marked else []

    def learn(self, words: set[str]) -> None:
        """Encode new words and check them against the library."""
        if len(self.young) > MEMO_WORDS:
            self.old, self.young = self.young, {}
        new = [w for w in words if w not in self.young]
        fresh = []
        for w in new:
            known = self.old.get(w)
            if known is None:
                known = self.agenda(w)
                fresh.append(w)
            self.young[w] = known
        fresh = [w for w in fresh if w != SPACE]
        theirs = self.library.encode([w[1:].replace(SPACE, " ") for w in fresh], num_threads=1)
        for w, ids in zip(fresh, theirs):
            if list(self.young[w]) != ids:
                raise RuntimeError(f"{w!r}: {self.young[w]} differs from the library's {ids}")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.words(t or "") for t in texts]
        self.learn(set(chain.from_iterable(split)))
        look = self.young.__getitem__
        return [np.fromiter(chain.from_iterable(map(look, ws)), dtype=np.int32) for ws in split]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: as the library, bytes that are no UTF-8 become U+FFFD each."""
        if not self.specials.isdisjoint(ids):  # bytes on both sides of one don't join
            cuts = [i for i, x in enumerate(ids) if x in self.specials]
            edges = zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)])
            start = next((i for i, x in enumerate(ids) if x not in self.specials or self.raw[x]), len(ids))
            parts = [self.decode_plain(ids[a:b], a == start) for a, b in edges]
            return "".join(chain.from_iterable(
                zip(parts, [*(self.raw[ids[c]].decode() for c in cuts), ""])))
        return self.decode_plain(ids, True)

    def decode_plain(self, ids: list[int], first: bool) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        if first and ids and raw.startswith(b" ") and ids[0] not in self.bytes_only:
            raw = raw[1:]
        return raw.decode("utf-8", "each")


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    return PieceCodec(model)


def _checked(model_path: str) -> bytes:
    from sentencepiece import sentencepiece_model_pb2

    model = open(model_path, "rb").read()
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    normal, user = spec.normalizer_spec, any(p.type == 4 for p in spec.pieces)
    if (spec.trainer_spec.model_type != 2 or normal.precompiled_charsmap or not normal.add_dummy_prefix
            or normal.remove_extra_whitespaces or user):
        raise ValueError("needs a BPE model with identity normalisation, dummy prefix, kept spaces, no user pieces")
    return model


def encode_and_decode(documents: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text."""
    ship(documents.sparkSession)
    model = _checked(model_path)

    def run(batch: pa.RecordBatch):
        own = codec(model)
        ids = own.encode(batch.column(1).to_pylist())
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
        decoded = [own.decode(i.tolist()) for i in ids]
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(pa.list_(pa.int32())),
             pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    def parts(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 500):
            yield from run(batch.slice(at, 500))

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(chosen, parts, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
