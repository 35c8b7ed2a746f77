"""Encoding with a SentencePiece BPE vocabulary, with seeded merge-dropout, and decoding.

Merges are taken from an agenda, best score first and leftmost among equals, as in the usual
encoder. Each candidate merge is judged once, when it comes up, by a keyed hash of the seed, the
document's id, the word with its place in the document, and the characters it would join; with
probability `dropout` it is skipped for good. So each occurrence of a word has its own
segmentation, the same on every machine and after every lost executor, and with dropout 0 the
usual one.

All words of a batch go through their agendas in step, one merge a word and round, in numpy; very
long words have an agenda of their own. Without dropout, words met before come from a bounded cache.
"""

from __future__ import annotations

import functools
import heapq
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm.text import U, give_back, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Stands for a SPACE character of the text itself, which goes into byte pieces; no text holds it.
_LITERAL = "\ud800"
_UNITS = re.compile("▁*[^▁\n]+|▁+|\n")
CACHE = 200_000
#: Words of more characters have an agenda of their own.
LONG = 100
_NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Pieces, their bytes, and the merges as a sorted table."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte = np.full(256, -1, np.int64)
        self.bytes: list[bytes] = []
        normal = {}
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[1:-1], 16)
                self.byte[value] = i
                self.bytes.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                normal[name] = i
                self.bytes.append(name.replace(SPACE, " ").encode())
        if (self.byte < 0).any():
            raise ValueError("the vocabulary must have a piece for every byte")
        order = sorted(normal.values(), key=lambda i: -model.get_score(i))
        rank = np.zeros(n, np.int64)
        rank[order] = np.arange(len(order))
        self.char = {name: i for name, i in normal.items() if len(name) == 1}
        self.of_code = np.full(0x110000, -1, np.int32)
        self.of_code[[ord(c) for c in self.char]] = list(self.char.values())
        rows = [
            (normal[name[:k]], normal[name[k:]], i)
            for name, i in normal.items()
            for k in range(1, len(name))
            if name[:k] in normal and name[k:] in normal
        ]
        left, right, whole = (np.array(x, np.int64) for x in zip(*rows))
        by = np.lexsort((right, left))
        self.pair, self.whole = left[by] * n + right[by], whole[by]
        self.rank = rank
        self.n = n
        # One pair by slot of its hash; slots of several are looked up in the sorted table.
        slot = _slot(self.pair)
        self.slots = np.zeros(1 << 20, np.int32)
        self.slots[slot] = np.arange(len(slot))
        self.crowded = np.bincount(slot, minlength=1 << 20) > 1

    def char_ids(self, chars: str) -> np.ndarray:
        """Piece of each character, or -1."""
        return self.of_code[np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int64)

    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self.pair.tolist(), self.whole.tolist()))

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that two pieces merge into, or -1; ids of characters outside are negative."""
        key = left * self.n + right
        slot = _slot(key)
        at = self.slots[slot]
        hit = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        out = np.where(hit, self.whole[at], -1)
        more = np.flatnonzero(~hit & self.crowded[slot])
        if len(more):
            key = key[more]
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            ok = (self.pair[at] == key) & (left[more] >= 0) & (right[more] >= 0)
            out[more] = np.where(ok, self.whole[at], -1)
        return out


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.astype(U) * U(0x9E3779B97F4A7C15) >> U(64 - 20)).astype(np.int64)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _word_keys(words: list[str]) -> np.ndarray:
    """Hash of each word; the same on every machine."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(r) for r in raw])
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(U)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    spread = mix((flat + U(1)) * U(0x9E3779B97F4A7C15) + place.astype(U) * U(0xD6E8FEB86659FD93))
    return mix(np.add.reduceat(spread, starts) + sizes.astype(U))


_PLACE, _LEFT = 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F
_MASK = (1 << 64) - 1


def skipped(keys: np.ndarray, codes: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidates with these codes are skipped in the words with these keys."""
    return mix(keys + codes).astype(np.float64) < np.float64(dropout) * 2.0**64


def encode_long(v: Vocabulary, word: str, key: int, dropout: float) -> bytes:
    """Piece ids of one word of any length, by an agenda of candidates; as `encode_words` has them."""
    n, limit = len(word), np.float64(dropout) * 2.0**64
    ids = v.char_ids(word).tolist()
    end, before = list(range(1, n + 1)), list(range(-1, n))
    agenda: list[tuple[int, int, int, int]] = []

    def judge(a: int) -> None:
        b = end[a]
        if b >= n:
            return
        new = v.pairs.get(ids[a] * v.n + ids[b], -1) if ids[a] >= 0 and ids[b] >= 0 else -1
        if new < 0:
            return
        if dropout > 0:
            code = a * _PLACE + (b - a) * _LEFT + end[b] - b & _MASK
            if mix(np.array([key + code & _MASK], U)).astype(np.float64)[0] < limit:
                return
        heapq.heappush(agenda, (int(v.rank[new]), a, end[b], new))

    if dropout > 0 and n > 1:  # the first candidates together, as they are the most
        left = np.array(ids[:-1], np.int64)
        new = v.merged(left, np.array(ids[1:], np.int64))
        codes = np.arange(n - 1).astype(U) * U(_PLACE) + U(_LEFT + 1 & _MASK)
        ok = np.flatnonzero((new >= 0) & ~skipped(np.full(n - 1, key, U), codes, dropout))
        agenda = [(int(v.rank[new[a]]), a, a + 2, int(new[a])) for a in ok.tolist()]
        heapq.heapify(agenda)
    else:
        for a in range(n - 1):
            judge(a)
    while agenda:
        _, a, stop, new = heapq.heappop(agenda)
        b = end[a]
        if b == 0 or b >= n or end[b] != stop:
            continue
        ids[a], end[a], end[b] = new, stop, 0
        if stop < n:
            before[stop] = a
        judge(a)
        if before[a] >= 0:
            judge(before[a])
    out, a = [], 0
    while a < n:
        if ids[a] >= 0:
            out.append(ids[a])
        else:
            out += v.byte[list(word[a].replace(_LITERAL, SPACE).encode())].tolist()
        a = end[a]
    return np.array(out, "<u2" if v.n <= 1 << 16 else "<i4").tobytes()


def encode_words(v: Vocabulary, words: list[str], keys: np.ndarray, dropout: float) -> list[bytes]:
    """Piece ids of each word as little-endian 16- or 32-bit numbers; words must not be empty."""
    sizes = np.array([len(w) for w in words])
    chars = "".join(words)
    ids = v.char_ids(chars)
    n = len(ids)
    seat = np.arange(n)
    word = np.repeat(np.arange(len(words)), sizes)
    place = seat - np.repeat(np.cumsum(sizes) - sizes, sizes)  # first character of a symbol
    size = np.ones(n, np.int64)

    def judge(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and priority of neighbouring symbols, `_NONE` if none or skipped."""
        new = v.merged(ids[left], ids[right])
        if dropout > 0:
            codes = place[left].astype(U) * U(_PLACE) + size[left].astype(U) * U(_LEFT) + size[right].astype(U)
            new = np.where(skipped(keys[word[left]], codes, dropout), -1, new)
        return new, np.where(new >= 0, v.rank[new] * (n + 1) + left, _NONE)

    into, priority = np.full(n, -1, np.int64), np.full(n, _NONE, np.int64)
    if n > 1:
        left = np.flatnonzero(word[:-1] == word[1:])
        into[left], priority[left] = judge(left, left + 1)
    live = seat  # symbols of words with a merge left, in order
    gone = np.zeros(n, bool)
    while len(live):
        w = word[live]
        starts = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        best = np.minimum.reduceat(priority[live], starts)
        active = np.repeat(best < _NONE, np.diff(np.append(starts, len(live))))
        live, w = live[active], w[active]
        best = best[best < _NONE]
        if not len(best):
            break
        at = np.searchsorted(live, best % (n + 1))
        left = live[at]
        right = live[at + 1]
        ids[left] = into[left]
        size[left] += size[right]
        gone[right] = True
        keep = np.ones(len(live), bool)
        keep[at + 1] = False
        live = live[keep]
        w = w[keep]
        at = np.searchsorted(live, left)
        into[left], priority[left] = -1, _NONE
        has = np.flatnonzero((at + 1 < len(live)) & (np.append(w, -1)[np.minimum(at + 1, len(live))] == w[at]))
        if len(has):
            x = live[at[has]]
            into[x], priority[x] = judge(x, live[at[has] + 1])
        has = np.flatnonzero((at > 0) & (w[np.maximum(at - 1, 0)] == w[at]))
        if len(has):
            x = live[at[has] - 1]
            into[x], priority[x] = judge(x, live[at[has]])
    stay = np.flatnonzero(~gone)
    out, counts = ids[stay], np.ones(len(stay), np.int64)
    if (out < 0).any():  # characters outside the vocabulary, as their bytes
        outside = np.flatnonzero(out < 0)
        texts = [chars[i].replace(_LITERAL, SPACE).encode() for i in stay[outside].tolist()]
        counts[outside] = [len(t) for t in texts]
        values = np.repeat(out, counts)
        values[values < 0] = v.byte[np.frombuffer(b"".join(texts), np.uint8)]
        out = values
    ends = np.cumsum(np.bincount(word[stay], weights=counts, minlength=len(words)).astype(np.int64))
    width = "<u2" if v.n <= 1 << 16 else "<i4"
    raw = out.astype(width).tobytes()
    unit = np.dtype(width).itemsize
    return [raw[a * unit : b * unit] for a, b in zip([0, *ends.tolist()], ends.tolist())]


class Encoder:
    """Encodes texts; without dropout it keeps pieces of words met before, up to CACHE of them."""

    def __init__(self, path: str, seed: int, dropout: float, draws: int | None = None):
        self.v, self.dropout, self.draws = vocabulary(path), dropout, draws
        self.seed = seed & (1 << 64) - 1
        self.cache: dict[str, bytes] = {}
        self.width = "<u2" if self.v.n <= 1 << 16 else "<i4"

    @staticmethod
    def words(text: str) -> list[str]:
        return _UNITS.findall((" " + text).replace(SPACE, _LITERAL).replace(" ", SPACE)) if text else []

    def _drawn(self, units: list[list[str] | None], names: list[str]) -> list[bytes]:
        """Pieces of every word of the texts, each place of a word with its own draw."""
        sizes = np.array([len(us or ()) for us in units])
        doc = np.repeat(np.arange(len(units)), sizes)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        salt = U(self.seed * 0x94D049BB133111EB & (1 << 64) - 1)
        named = mix(_word_keys([n + "\n" for n in names]) + salt)
        draw = mix(named[doc] + place.astype(U) * U(0x9E3779B97F4A7C15))
        if self.draws is not None:
            draw = mix(draw % U(self.draws) + salt)
        words = [u for us in units if us for u in us]
        out: list[bytes] = []
        for a in range(0, len(words), 20_000):
            part = words[a : a + 20_000]
            out += self._part(part, mix(_word_keys(part) + draw[a : a + len(part)]))
        return out

    def _part(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Pieces of occurrences of words with their keys."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if sizes.max(initial=0) <= LONG:
            return encode_words(self.v, words, keys, self.dropout)
        out: list[bytes] = [b""] * len(words)
        short = np.flatnonzero(sizes <= LONG)
        if len(short):
            coded = encode_words(self.v, [words[i] for i in short.tolist()], keys[short], self.dropout)
            for i, ids in zip(short.tolist(), coded):
                out[i] = ids
        for i in np.flatnonzero(sizes > LONG).tolist():
            out[i] = encode_long(self.v, words[i], int(keys[i]), self.dropout)
        return out

    def _usual(self, units: list[list[str] | None]) -> list[bytes]:
        """Pieces of every word of the texts without dropout."""
        new = {u for us in units if us for u in us if u not in self.cache}
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = {u for us in units if us for u in us}
        words = sorted(new)
        for a in range(0, len(words), 20_000):
            part = words[a : a + 20_000]
            short = [w for w in part if len(w) <= LONG]
            if short:
                self.cache.update(zip(short, encode_words(self.v, short, np.zeros(len(short), U), 0.0)))
            self.cache.update((w, encode_long(self.v, w, 0, 0.0)) for w in part if len(w) > LONG)
        return [self.cache[u] for us in units if us for u in us]

    def encode(self, texts: list[str | None], names: list[str]) -> list[np.ndarray | None]:
        """Piece ids; the draws of a text follow from its name and the places of its words."""
        if not texts:
            return []
        units = [None if t is None else self.words(t) for t in texts]
        coded = self._drawn(units, names) if self.dropout > 0 else self._usual(units)
        ends = np.cumsum([len(us or ()) for us in units]).tolist()
        return [
            None if us is None else np.frombuffer(b"".join(coded[a:b]), self.width)
            for us, a, b in zip(units, [0, *ends], ends)
        ]


_encoders: dict[tuple, Encoder] = {}


def _encode(key: tuple, check: bool):
    def fn(batches):
        if key not in _encoders:
            _encoders[key] = Encoder(*key)
        encoder = _encoders[key]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            a = 0
            while a < len(texts):  # parts of bounded length, so that long texts come alone
                b, size = a, 0
                while b < len(texts) and (b == a or size < 1_000_000):
                    size += len(texts[b] or "")
                    b += 1
                part = batch.slice(a, b - a)
                names = [x if x is not None else "" for x in part.column(0).to_pylist()]
                ids = encoder.encode(texts[a:b], names)
                sizes = [0 if x is None else len(x) for x in ids]
                flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0)]).astype(np.int32)
                offs = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                mask = pa.array([x is None for x in ids])
                pieces = pa.ListArray.from_arrays(pa.array(offs), pa.array(flat), mask=mask)
                cols, names = [pieces, part.column(2)], ["pieces", "row"]
                if check:  # here, and not in a second Python worker for each task
                    same = [x is None or decode_ids(encoder.v, x) == t for t, x in zip(texts[a:b], ids)]
                    cols, names = [*cols, pa.array(same, pa.bool_())], [*names, "same"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                a = b
        give_back()

    return fn


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = MODEL,
    seed: int = 0,
    dropout: float = 0.1,
    draws: int | None = None,
    lossless: bool = False,
) -> DataFrame:
    """The documents with `pieces`, the piece ids of their texts as array<int>.

    Each word draws by the seed, the document's id and the word's place in it, so a word has as
    many draws as occurrences; `draws` sets a number of different ones instead. A null text has null pieces, an empty one an empty array; a null id
    counts as an empty name. A column called `pieces` is replaced, all others are kept. With
    `lossless`, a column of this name says whether the pieces decode to the text again; it is true
    for null. The model file must be at the same path on every machine.
    """
    if not 0 <= dropout < 1 or (draws is not None and draws < 1):
        raise ValueError("dropout must be in [0, 1) and draws at least 1")
    made = ["pieces", "lossless"] if lossless else ["pieces"]
    cols = [F.col(c) for c in docs.columns if c not in made]
    packed = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.struct(*cols).alias("row")
    )
    schema = "pieces array<int>, row " + packed.schema["row"].dataType.simpleString()
    schema += ", same boolean" if lossless else ""
    coded = packed.mapInArrow(_encode((model, seed, dropout, draws), lossless), schema)
    return coded.select("row.*", "pieces", *([F.col("same").alias("lossless")] if lossless else []))


def decode_ids(v: Vocabulary, ids: np.ndarray) -> str:
    """The text that pieces stand for; byte pieces that form no character become U+FFFD."""
    raw = b"".join(map(v.bytes.__getitem__, ids.tolist()))
    return raw[1:].decode(errors="replace") if raw[:1] == b" " else raw.decode(errors="replace")


def decoded(spark: SparkSession, model: str = MODEL):
    """Column function from piece ids to text; null for null."""

    @F.pandas_udf("string")
    def fn(pieces):
        v = vocabulary(model)
        return pieces.map(lambda ids: None if ids is None else decode_ids(v, np.asarray(ids)))

    return fn


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, **options) -> DataFrame:
    """Per document the number of pieces, a hash of them, and whether they decode to the text."""
    coded = encode(docs, id_col, text_col, model, lossless=True, **options)
    return coded.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.size("pieces"), F.lit(0)).cast("bigint").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        "lossless",
    )
