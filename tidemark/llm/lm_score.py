"""Language-model scores: the marginal probability of a text over all its segmentations into subword pieces.

The vocabulary is that of a public tokenizer; it is not trained. Its pieces get unigram scores from the training texts:
starting from the order of the vocabulary (the older a piece, the likelier, as Zipf's law has it), one pass of expected
counts over all segmentations of the training words gives smoothed log10 probabilities. A text is its words, each behind
a word mark, and one end. No piece crosses a word, so the marginal of a text is the product over its words and the end,
and a word's marginal comes from a forward recursion over the lattice of its pieces, in logarithms.

A word is worked on once, however often it occurs: batches of texts are counted into rows of a word and its uses, words
into one row each with their count in the training texts, and both scores come back by one join on the word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrays import find_words, hash_spans, lower_ascii, ranges, slices, utf8
from tidemark.llm.sentence_pieces import MARK, MODEL, Vocabulary, match_pieces, vocabulary
from tidemark.session import stored

PIECE_PRIOR = 0.5  # added to each expected count
LN10 = float(np.log(10))


def _count_words(texts: pa.Array, held: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch of texts: each different word, its count in texts not held out, and where its uses end among the
    uses, which are text number and count."""
    data, at = utf8(texts)
    data = lower_ascii(data)
    start, end, text = find_words(data, at)
    # Hashes group the words of one batch; words of equal hash are compared below.
    key = hash_spans(data, start, end)
    order = np.lexsort((text, key))
    grouped, owner = key[order], text[order]
    word_head = np.ones(len(order), bool)
    word_head[1:] = grouped[1:] != grouped[:-1]
    first = np.flatnonzero(word_head)
    if not _equal(data, start, end, order, np.diff(np.append(first, len(order)))):
        return _count_slowly(data, start, end, text, held)
    head = word_head.copy()
    head[1:] |= owner[1:] != owner[:-1]
    use = np.flatnonzero(head)
    n = np.diff(np.append(use, len(order))).astype(np.int64)
    begin = np.flatnonzero(word_head[use])
    stops = np.append(begin[1:], len(use))[: len(begin)]
    train = np.add.reduceat(n * ~held[owner[use]], begin) if len(begin) else np.zeros(0, np.int64)
    length = (end - start)[order[first]]
    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    spelled = data[ranges(start[order[first]], length)].tobytes()
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(spelled)])
    return words.cast(pa.string()), train, stops, owner[use], n


def _equal(data: np.ndarray, start: np.ndarray, end: np.ndarray, order: np.ndarray, n: np.ndarray) -> bool:
    """Whether the words of every group are the same bytes."""
    size = (end - start)[order]
    leader = np.repeat(np.cumsum(n) - n, n)
    if not (size == size[leader]).all():
        return False
    return bool((data[ranges(start[order], size)] == data[ranges(start[order][leader], size)]).all())


def _count_slowly(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, held: np.ndarray):
    """The same by dictionary, for a batch in which two words share a hash."""
    raw = data.tobytes()
    uses: dict[str, Counter] = {}
    for t, a, b in zip(text.tolist(), start.tolist(), end.tolist(), strict=True):
        uses.setdefault(raw[a:b].decode(), Counter())[t] += 1
    train = [sum(n for t, n in u.items() if not held[t]) for u in uses.values()]
    stops = np.cumsum([len(u) for u in uses.values()])
    owner, n = (np.array([x[k] for u in uses.values() for x in u.items()], np.int64) for k in (0, 1))
    return pa.array(list(uses), pa.string()), np.array(train, np.int64), stops, owner, n


class Lattice:
    """All pieces of a list of words, cut into segments that no piece crosses."""

    def __init__(self, v: Vocabulary, words: list[str]) -> None:
        self.v, self.count = v, len(words)
        marked = ["▁" + w for w in words]
        size = np.array([len(w) for w in marked])
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        code = v.code[chars]
        owner = np.repeat(np.arange(len(words)), size)
        alone = code == 0
        # Characters of no longer piece: one piece, or their bytes.
        single = v.single[chars[alone]]
        self.alone_piece, self.alone_word = single[single >= 0], owner[alone][single >= 0]
        spelled = [v.bytes[list(chr(c).encode("utf-8", "surrogatepass"))] for c in chars[alone][single < 0].tolist()]
        self.byte_piece = np.concatenate(spelled) if spelled else np.zeros(0, np.int64)
        self.byte_word = np.repeat(owner[alone][single < 0], [len(x) for x in spelled]) if spelled else np.zeros(0, np.int64)

        head = np.zeros(len(chars), bool)
        head[np.cumsum(size) - size] = True
        head[1:] |= alone[:-1]
        head |= chars == MARK
        head |= alone
        starts = np.flatnonzero(head)
        lengths = np.diff(np.append(starts, len(chars)))
        joined = ~alone[starts]
        starts, lengths = starts[joined], lengths[joined]
        self.segment_word = owner[starts]
        self.begin = np.cumsum(lengths + 1) - (lengths + 1)
        self.stop = self.begin + lengths
        text = np.zeros(int(self.stop[-1]) + 1 if len(starts) else 1, np.int64)
        inner = ranges(self.begin, lengths)
        text[inner] = code[ranges(starts, lengths)]
        self.places = len(text) + 1
        segment = np.zeros(len(text), np.int64)
        segment[inner] = np.repeat(np.arange(len(starts)), lengths)
        self.start, row = match_pieces(v, text)
        self.end = self.start + v.lengths[row]
        self.piece = v.searched[row]
        self.segment = segment[self.start]

    def _waves(self, distance: np.ndarray) -> Iterator[np.ndarray]:
        order = np.argsort(distance, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(distance[order])) + 1, [len(order)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < b:
                yield order[a:b]

    def _relax(self, to: np.ndarray, of: np.ndarray, distance: np.ndarray, ends: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Natural logarithm of the summed probability of all ways from `ends` to each place."""
        value = np.full(self.places, -np.inf)
        value[ends] = 0
        top, total = np.full(self.places, -np.inf), np.zeros(self.places)
        for wave in self._waves(distance):
            place, way = to[wave], value[of[wave]] + score[self.piece[wave]]
            np.maximum.at(top, place, way)
            np.add.at(total, place, np.exp(way - top[place]))
            value[place] = top[place] + np.log(total[place])
        return value

    def forward(self, score: np.ndarray) -> np.ndarray:
        return self._relax(self.end, self.start, self.end - self.begin[self.segment], self.begin, score)

    def marginals(self, score: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        out = np.bincount(self.segment_word, weights=self.forward(score)[self.stop], minlength=self.count)
        out += np.bincount(self.alone_word, weights=score[self.alone_piece], minlength=self.count)
        return out + np.bincount(self.byte_word, weights=score[self.byte_piece], minlength=self.count)

    def expected(self, score: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of words that occur `weight` times."""
        ahead = self.forward(score)
        back = self._relax(self.start, self.end, self.stop[self.segment] - self.start, self.stop, score)
        way = ahead[self.start] + score[self.piece] + back[self.end] - ahead[self.stop[self.segment]]
        size = len(self.v.pieces)
        out = np.bincount(self.piece, weights=np.exp(way) * weight[self.segment_word[self.segment]], minlength=size)
        out += np.bincount(self.alone_piece, weights=weight[self.alone_word], minlength=size)
        return out + np.bincount(self.byte_piece, weights=weight[self.byte_word], minlength=size)


def first_scores(v: Vocabulary) -> np.ndarray:
    """Natural log probabilities by order in the vocabulary."""
    weight = 1.0 / (np.arange(len(v.pieces)) + 10.0)
    return np.log(weight / weight.sum())


def score_words(words: DataFrame, ends: int, path: str) -> tuple[DataFrame, float]:
    """`words` (word, c) with `log_p`, the log10 marginal of each, and the log10 probability of an end.

    Scores are learnt from words with c > 0 by their counts, and from `ends` texts. Per piece one number goes through
    the driver; their number is that of the vocabulary, whatever the corpus.
    """

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        total, score = np.zeros(len(v.pieces)), first_scores(v)
        for part in slices(batches, "word", limit=1 << 20):
            lattice = Lattice(v, part.column("word").to_pylist())
            total += lattice.expected(score, part.column("c").to_numpy(zero_copy_only=False).astype(float))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

    uses = words.where("c > 0").select("word", "c").mapInArrow(expect, "piece long, uses double")
    uses = {r["piece"]: r["uses"] for r in uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()}
    size = len(vocabulary(path).pieces)
    counts = np.array([uses.get(i, 0.0) for i in range(size)] + [float(ends)]) + PIECE_PRIOR  # the end is one more piece
    learnt = np.log(counts / counts.sum())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for part in slices(batches, "word", limit=1 << 20):
            found = Lattice(v, part.column("word").to_pylist()).marginals(learnt) / LN10
            yield pa.RecordBatch.from_arrays([part.column("word"), part.column("c"), pa.array(found)], ["word", "c", "log_p"])

    return words.select("word", "c").mapInArrow(score, "word string, c long, log_p double"), float(learnt[-1]) / LN10


def held_out(doc_id: Column) -> Column:
    """A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def scores(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of `docs` (doc_id, text).

    Scores are log10 probabilities. A null text is empty: it has the end only. Rows that repeat are counted and scored
    each. Without a training row every count is 0 and pieces keep equal scores. Other columns are not looked at.
    """
    held = held_out(F.col("doc_id")).alias("held_out")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held, F.col("text").cast("string").alias("text"))
    names = ["row", "doc_id", "held_out", "word", "n_train", "uses"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            row, doc_id, held = (part.column(c) for c in ("row", "doc_id", "held_out"))
            none = pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([row, doc_id, held, pa.nulls(part.num_rows, pa.string()), *none], names)
            word, train, stops, owner, n = _count_words(part.column("text"), held.to_numpy(zero_copy_only=False))
            numbers = row.to_numpy(zero_copy_only=False)
            # A use is one number: how far its row lies behind the first of the batch, and the count.
            packed = (numbers[owner] - numbers[0]) * (1 << 32) + n
            uses = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), pa.array(packed.astype(np.int64)))
            size = len(train)
            base = pa.array(np.full(size, numbers[0]))
            yield pa.RecordBatch.from_arrays([base, pa.nulls(size, doc_id.type), pa.nulls(size, pa.bool_()), word, pa.array(train), uses], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    # A row without a word is a text; one with a word holds its uses in a batch of texts.
    schema = f"row long, doc_id {kind}, held_out boolean, word string, n_train long, uses array<long>"
    counted = stored(rows.mapInArrow(count, schema), "word-counts")
    texts = counted.where("word is null").select("row", "doc_id", "held_out")
    pairs = counted.where("word is not null")
    words = pairs.groupBy("word").agg(F.sum("n_train").alias("c"))
    words = stored(words, "words")
    known, tokens = words.where("c > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    ends = texts.where("not held_out").count()
    total, distinct = tokens + ends, known + (ends > 0)

    scored, log_end = score_words(words, ends, path)
    scored = stored(scored, "word-scores")
    log10 = lambda c: F.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
    both = pairs.select("row", "word", "uses").join(scored, "word").select("row", "c", "log_p", F.explode("uses").alias("use"))
    row, n = (F.col("row") + F.shiftright("use", 32)).alias("row"), F.col("use").bitwiseAND((1 << 32) - 1).alias("n")
    sums = both.select(row, n, "c", "log_p").groupBy("row").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("n") * log10(F.col("c"))).alias("base"),
        F.sum(F.col("n") * F.col("log_p")).alias("model"),
    )
    zero = F.lit(0).cast("long")
    out = texts.join(sums, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        (F.coalesce("n", zero) + 1).alias("n_tokens"),
        (F.coalesce("k", zero) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.coalesce("base", F.lit(0.0)) + log10(F.lit(ends))).alias("base_score"),
        (F.coalesce("model", F.lit(0.0)) + F.lit(log_end)).alias("score"),
    )
