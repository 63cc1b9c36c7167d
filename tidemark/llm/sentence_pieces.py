"""SentencePiece encoding and decoding by suffix-array matching.

For each batch the distinct segments of its texts are put one behind the other and indexed by a suffix array: the start
positions sorted by the characters that follow. A binary search for every piece of the vocabulary gives its range of
occurrences, thus all edges (start, piece) of the segmentation lattice. Edges are sorted by the position where they end
and relaxed in that order. The model is a byte-pair one: its encoding of a prefix ends with the one piece that may
follow the last piece of the shorter prefix, where two pieces may follow each other if encoding their joined text gives
just these two. So each position keeps one piece, and the pieces read backwards from the end are the encoding.

A segment is what no piece can cross: it starts at a word mark or beside a character that no longer piece contains.
Equal segments of a batch are matched once. Results are those of the sentencepiece library for byte-pair models with
byte fallback, whose file is a parameter; nothing is trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.arrays import CHUNK_BYTES, STEP, U64, mix, ranges, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 0x2581
FOLLOWS_SLOTS = 1 << 22  # remembered answers in each worker; older ones are asked again


class Follows:
    """Whether piece `b` may follow piece `a` (-1: whether `b` may stand first), asked of the model once per pair."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.keys = np.zeros(FOLLOWS_SLOTS, np.int64)
        self.answers = np.zeros(FOLLOWS_SLOTS, bool)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) + 1) * (1 << 31) + b + 1
        slot = (mix(key.view(U64)) & U64(FOLLOWS_SLOTS - 4)).astype(np.int64)
        out, missing = np.zeros(len(key), bool), np.ones(len(key), bool)
        for probe in range(4):
            hit = self.keys[slot + probe] == key
            out[hit] = self.answers[slot[hit] + probe]
            missing &= ~hit
        if missing.any():
            asked, place = np.unique(key[missing], return_inverse=True)
            answer = self._ask(asked)
            out[missing] = answer[place]
            at = (mix(asked.view(U64)) & U64(FOLLOWS_SLOTS - 4)).astype(np.int64)
            for probe in range(4):  # the first free place, else the last one
                free = (self.keys[at + probe] == 0) | (probe == 3)
                self.keys[at[free] + probe], self.answers[at[free] + probe] = asked[free], answer[free]
                asked, answer, at = asked[~free], answer[~free], at[~free]
        return out

    def _ask(self, keys: np.ndarray) -> np.ndarray:
        pieces, base = self.vocabulary.pieces, self.vocabulary.barrier_length
        first, second = (keys >> 31) - 1, (keys & ((1 << 31) - 1)) - 1
        texts = ["\n" + (pieces[a] if a >= 0 else "") + pieces[b] for a, b in zip(first.tolist(), second.tolist(), strict=True)]
        found = self.vocabulary.model.encode(texts, num_threads=1)
        want = ([b] if a < 0 else [a, b] for a, b in zip(first.tolist(), second.tolist(), strict=True))
        return np.fromiter((f[base:] == w for f, w in zip(found, want, strict=True)), bool, len(keys))


class Vocabulary:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        if not all(model.is_byte(int(i)) for i in self.bytes):
            raise ValueError("the model needs byte fallback")
        self.plain = model.normalize("Ａ ﬁ  x\n") == "▁Ａ▁ﬁ▁▁x\n"
        self.barrier_length = len(model.encode("\n"))
        longer = [i for i in range(size) if not special[i] and len(self.pieces[i]) > 1]
        if any("▁" in self.pieces[i].lstrip("▁") for i in longer):
            raise ValueError("pieces of the model cross words")
        # Compact codes of the characters that longer pieces contain; 0 ends a segment, and all others stand alone.
        letters = sorted({ord(c) for i in longer for c in self.pieces[i]} | {MARK})
        self.code = np.zeros(0x110000, np.int64)
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.bits = int(len(letters)).bit_length()
        self.per = 63 // self.bits  # characters in one sort key
        self.single = np.full(0x110000, -1, np.int32)
        for i in range(size):
            if not special[i] and len(self.pieces[i]) == 1:
                self.single[ord(self.pieces[i])] = i
        if (self.single[letters] < 0).any():
            raise ValueError("a character of longer pieces is no piece itself")
        searched = [i for i in range(size) if not special[i] and self.code[[ord(c) for c in self.pieces[i]]].all()]
        codes = [self.code[[ord(c) for c in self.pieces[i]]] for i in searched]
        self.searched = np.array(searched)
        self.lengths = np.array([len(c) for c in codes])
        # Each piece as sort keys of `per` characters each, with the lowest and the highest continuation.
        self.depth = -(-int(self.lengths.max()) // self.per)
        self.low = np.zeros((len(codes), self.depth), np.int64)
        self.high = np.full((len(codes), self.depth), (1 << (self.bits * self.per)) - 1, np.int64)
        for row, c in enumerate(codes):
            for k in range(0, len(c), self.per):
                part = c[k : k + self.per]
                room = self.bits * (self.per - len(part))
                value = 0
                for x in part.tolist():
                    value = value << self.bits | x
                self.low[row, k // self.per] = value << room
                self.high[row, k // self.per] = (value << room) | ((1 << room) - 1)
        self.follows = Follows(self)
        # What each id stands for, for decoding.
        texts = [b"" if special[i] and not model.is_byte(i) else self.pieces[i].replace("▁", " ").encode() for i in range(size)]
        for b, i in enumerate(self.bytes.tolist()):
            texts[i] = bytes([b])
        self.out_at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.out = np.frombuffer(b"".join(texts), np.uint8)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _distinct(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the first of each distinct segment, and for each segment the index of its own among those."""
    step = int(STEP)
    while True:
        base = U64(step | 1)
        power = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(len(codes), base, U64)]))
        back = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(len(codes), U64(pow(int(base), -1, 1 << 64)), U64)]))
        sums = np.concatenate([[U64(0)], np.cumsum(mix(codes.astype(U64)) * power[:-1])])
        key = mix((sums[starts + lengths] - sums[starts]) * back[starts] + lengths.astype(U64))
        _, first, of = np.unique(key, return_index=True, return_inverse=True)
        # Equal keys must mean equal segments; with another base a chance collision goes away.
        ours, theirs = ranges(starts, lengths), ranges(starts[first[of]], lengths)
        if (lengths == lengths[first[of]]).all() and (codes[ours] == codes[theirs]).all():
            return first, of
        step += 2


def match_pieces(v: Vocabulary, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of all pieces in the index text (codes, 0 between segments): start and row of the piece."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(v.per * v.depth, np.int64)])
    key = np.zeros(n + v.per * (v.depth - 1), np.int64)
    ended = np.zeros(len(key), bool)
    for k in range(v.per):  # what lies behind the end of a segment does not count
        here = padded[k : k + len(key)]
        ended |= here == 0
        key = key << v.bits | np.where(ended, 0, here)
    order = np.argsort(key[:n], kind="stable")
    ranked = key[order]
    left = np.searchsorted(ranked, v.low[:, 0], "left")
    right = np.searchsorted(ranked, v.high[:, 0], "right")
    row = np.repeat(np.arange(len(left)), right - left)
    start = order[ranges(left, right - left)]
    for k in range(1, v.depth):  # longer pieces: compare what follows
        far = v.lengths[row] > k * v.per
        at = start[far] + k * v.per
        good = (key[at] >= v.low[row[far], k]) & (key[at] <= v.high[row[far], k])
        keep = np.ones(len(row), bool)
        keep[far] = good
        row, start = row[keep], start[keep]
    return start, row


def _encode_segments(v: Vocabulary, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces of the given segments, one behind the other, and how many each has."""
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.zeros(int(begin[-1] + lengths[-1] + 1), np.int64)
    inner = ranges(begin, lengths)
    text[inner] = codes[ranges(starts, lengths)]
    segment_start = np.zeros(len(text), np.int64)
    segment_start[inner] = np.repeat(begin, lengths)

    start, row = match_pieces(v, text)
    end = start + v.lengths[row]
    wave = end - segment_start[start]
    piece = v.searched[row].astype(np.int32)
    order = np.argsort(np.minimum(wave, 0xFFFF).astype(np.uint16), kind="stable")
    if len(wave) and wave.max() >= 0xFFFF:
        order = np.argsort(wave, kind="stable")
    start, end, piece, wave = start[order], end[order], piece[order], wave[order]
    last = np.full(len(text) + 1, -1, np.int32)  # the piece that ends at each position; -1 at the start of a segment
    size = np.zeros(len(v.pieces), np.int64)
    size[v.searched] = v.lengths
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(wave)) + 1, [len(wave)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        s, p = start[a:b], piece[a:b]
        good = v.follows(last[s], p)
        last[end[a:b][good]] = p[good]

    at = begin + lengths
    alive = np.arange(len(begin))
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    while len(alive):
        p = last[at[alive]]
        if (p < 0).any():
            raise AssertionError("a segment has no encoding")
        seen.append((alive, p))
        at[alive] -= size[p]
        alive = alive[at[alive] > begin[alive]]
    count = np.bincount(np.concatenate([x for x, _ in seen]), minlength=len(begin))
    stop = np.cumsum(count)
    ids = np.zeros(int(stop[-1]), np.int32)
    for back, (which, p) in enumerate(seen):  # the last piece was found first
        ids[stop[which] - 1 - back] = p
    return ids, count


def encode(texts: pa.Array, path: str = MODEL) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one behind the other, and how many each has; null counts as empty."""
    v = vocabulary(path)
    plain = [t or "" for t in texts.to_pylist()]
    if v.plain:
        marked = ["▁" + t.replace(" ", "▁") if t else "" for t in plain]
    else:
        marked = [v.model.normalize(t) for t in plain]
    size = np.array([len(t) for t in marked], np.int64)
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if not len(chars):
        return np.zeros(0, np.int32), np.zeros(len(plain), np.int64)
    code = v.code[chars]
    text_start = np.cumsum(size) - size
    head = np.zeros(len(chars), bool)
    head[text_start[size > 0]] = True
    alone = code == 0
    marks = chars == MARK
    head |= alone | (marks & ~np.concatenate([[False], marks[:-1]]))
    head[1:] |= alone[:-1]
    starts = np.flatnonzero(head)
    lengths = np.diff(np.append(starts, len(chars)))

    # Segments of joining characters are matched; a character that stands alone is one piece or its bytes.
    joined = ~alone[starts]
    pool: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    of = np.zeros(len(starts), np.int64)
    known = 0
    if joined.any():
        first, which = _distinct(code, starts[joined], lengths[joined])
        ids, count = _encode_segments(v, code, starts[joined][first], lengths[joined][first])
        pool.append(ids)
        counts.append(count)
        of[joined] = which
        known = len(count)
    if not joined.all():
        letters, which = np.unique(chars[starts[~joined]], return_inverse=True)
        spelled = [[int(v.single[c])] if v.single[c] >= 0 else v.bytes[list(chr(c).encode("utf-8", "surrogatepass"))].tolist() for c in letters.tolist()]
        pool.append(np.array([i for x in spelled for i in x], np.int32))
        counts.append(np.array([len(x) for x in spelled]))
        of[~joined] = known + which
    ids, count = np.concatenate(pool), np.concatenate(counts)
    begin = np.cumsum(count) - count
    out = ids[ranges(begin[of], count[of])]
    text_of = np.repeat(np.arange(len(plain)), size)[starts]
    return out, np.bincount(text_of, weights=count[of], minlength=len(plain)).astype(np.int64)


def decode(ids: np.ndarray, counts: np.ndarray, path: str = MODEL) -> pa.Array:
    """Texts of encoded ids; the mark put before each text is taken off again."""
    v = vocabulary(path)
    length = (v.out_at[1:] - v.out_at[:-1])[ids]
    data = v.out[ranges(v.out_at[ids], length)]
    ends = np.concatenate([[0], np.cumsum(length)])
    stop = np.cumsum(counts)
    at = np.concatenate([ends[stop - counts], [len(data)]]) if len(counts) else np.zeros(1, np.int64)
    keep = np.ones(len(data), bool)
    heads = at[:-1][at[:-1] < at[1:]]
    keep[heads[data[heads] == 0x20]] = False
    moved = np.concatenate([[0], np.cumsum(keep)])[at]
    whole = data[keep].tobytes()
    try:
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(moved.astype(np.int64)), pa.py_buffer(whole)]).cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no text come from ids that no text encodes to
        return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(moved[:-1].tolist(), moved[1:].tolist(), strict=True)], pa.string())


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids.astype(np.int32)))


def with_pieces(docs: DataFrame, text: str = "text", path: str = MODEL, batch_bytes: int = CHUNK_BYTES, lean: bool = False) -> DataFrame:
    """Add `piece_ids`, `n_pieces` and `decoded` to every row; all other columns stay, and columns of these names go.

    Texts are indexed `batch_bytes` at a time, a longer one by itself; a worker needs about 100 times that, so smaller
    batches take less memory, and more time, since equal segments are matched once a batch. With `lean` workers give back
    after each batch what they no longer need.

    Null and empty texts have no pieces and decode to the empty text. Rows are independent: repeated rows give repeated
    results, an empty table an empty one.
    """
    added = ("piece_ids", "n_pieces", "decoded")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    fields = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()), T.StructField("decoded", T.StringType())]
    schema = T.StructType([*rows.schema.fields, *fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, limit=batch_bytes, lean=lean):
            ids, counts = encode(part.column(text), path)
            extra = [_lists(ids, counts), pa.array(counts, pa.int64()), decode(ids, counts, path)]
            yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, *added])

    return rows.mapInArrow(work, schema)
