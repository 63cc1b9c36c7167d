"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

N-grams of a text are its words and, for every word, the pair of its own last two characters and those of the word before
it (none for the first word): words carry what is said, endings the style of a text in any language, also where words are
new. They are hashed into a fixed number of buckets. All texts and the trusted ones each give one multinomial over the buckets. Raw counts are first scaled to the
size of the trusted text, then both get the same pseudo-count, so that a bucket of which the trusted text says little has
ratio 0, however much or little of the corpus is labelled. Texts are dealt into folds by a hash of their bytes, and a
text is scored by the counts of the other folds: a label does not lift the text that carries it, nor its exact copies,
and a rare word does not speak against the text that brought it. The score is the mean log ratio over the n-grams of the
text, and every text below a fixed score is rejected. No draw is involved: the same rows always give the same verdicts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.words import add_word_hashes, window_hashes, words
from tidemark.operators.skew import lookup, measured
from tidemark.session import stored

BUCKETS = 16381  # a prime: the size of both multinomials, whatever the corpus
THRESHOLD = -0.6  # least mean log ratio of a kept text
PSEUDO = 1.0  # added to both counts of a bucket
FOLDS = 4  # a text is scored by the counts of the folds it is not in
MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words in repeated windows
SCALE = 1_000_000  # log ratios are whole millionths, so that their sums do not depend on order
PAIR_STEP, WORD_STEP = 1_000_003, 31


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def _unpacked(docs: DataFrame) -> list[Column]:
    """The columns of `docs` that are not replaced, out of the struct `own`."""
    return [F.col(f"own.`{c}`").alias(c) for c in docs.columns if c.lower() not in ADDED]


def with_buckets(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Add to `text` the columns `words` and `grams`: the buckets of all pairs of endings, then those of all words."""
    out = df.withColumn("words", words(F.col("text")))
    out = out.withColumn("codes", F.transform("words", lambda w: F.crc32(F.substring(w, -2, 2))))

    def pair(code: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col("codes"), i - 1), F.lit(0))
        return ((before * PAIR_STEP + code) % buckets).cast("int")

    whole = F.transform("words", lambda w: ((F.crc32(w) * WORD_STEP) % buckets).cast("int"))
    return out.withColumn("grams", F.concat(F.transform("codes", pair), whole)).drop("codes")


def fold_of(text: Column) -> Column:
    """Fold of a text, by the first digit of its MD5."""
    return (F.conv(F.substring(F.md5(text), 1, 1), 16, 10).cast("int") % FOLDS).cast("int")


def fit_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows (fold, bucket, raw, good) from all rows of `texts` (text, trusted): n-grams of all and of the trusted texts."""
    rows = with_buckets(texts.select("text", "trusted", fold_of(F.col("text")).alias("fold")), buckets)
    # explode() would add a filter on the array's size, and that filter would recompute the array below every step.
    counts = rows.select("fold", F.explode_outer("grams").alias("bucket"), "trusted").where("bucket is not null")
    return counts.groupBy("fold", "bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("good"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For each fold and bucket the log ratio in whole millionths, from the counts of the other folds.

    `counts` has one row for each fold and bucket at most, so what meets on the driver does not grow with the corpus.
    """
    raw, good = ([[0] * buckets for _ in range(FOLDS)] for _ in range(2))
    for r in counts.collect():
        raw[r["fold"]][r["bucket"]], good[r["fold"]][r["bucket"]] = r["raw"], r["good"]
    out = []
    for fold in range(FOLDS):
        others = [f for f in range(FOLDS) if f != fold]
        all_raw, all_good = (sum(sum(x[f]) for f in others) for x in (raw, good))
        share = all_good / max(all_raw, 1)
        for b in range(buckets):
            trusted, expected = sum(good[f][b] for f in others), share * sum(raw[f][b] for f in others)
            out.append(round(SCALE * math.log((trusted + PSEUDO) / (expected + PSEUDO))))
    return out


def _with_ratio_sums(df: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Add `n` and `sum`: the number of n-grams of each text and the sum of their log ratios."""
    # A constant array inside the plan; its size is fixed by the number of folds and buckets.
    table = F.split(F.lit(",".join(map(str, log_ratios(counts, buckets)))), ",").cast("array<bigint>")
    df = df.withColumns({"n": F.size("grams").cast("long"), "offset": fold_of(F.col("text")) * buckets})
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda a, b: a + F.get(table, F.col("offset") + b))
    # A column that is used once moves into the expression that uses it, here into one evaluated for every n-gram. A
    # second use keeps the hash of the text outside.
    return df.withColumn("sum", F.when(F.col("offset") >= 0, total))


def assess(docs: DataFrame, counts: DataFrame, text: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Add the counts, the score and the verdict to every row; all columns of `docs` stay as they are.

    `counts` come from `fit_counts`. Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint),
    base_failed, score, kept; columns of `docs` with these names are replaced. A text with no word (null, empty) has score 0 and fails the base rules. A text of any length is rated as a whole, in
    one row: it needs about 100 bytes of memory for each of its words.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED]
    own = F.struct(*(columns or [F.lit(0).alias("nothing")])).alias("own")
    df = docs.select(own, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    df = with_buckets(df, buckets)
    df = add_word_hashes(df, "words", "hashes").withColumn("coarse", window_hashes("hashes", (0, 2, 4)))
    # A repeated window repeats its first, third and fifth word as well, which most texts never do: only the others
    # need whole windows and the sort that brings equal ones together.
    maybe = F.size(F.array_distinct("coarse")) < F.size("coarse")
    df = df.withColumn("windows", F.when(maybe, window_hashes("hashes")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("ordered", F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def twin(x: Column, i: Column) -> Column:
        other = lambda k: F.get(F.col("ordered"), k)["h"] == x["h"]
        return F.coalesce(other(i - 1), F.lit(False)) | F.coalesce(other(i + 1), F.lit(False))

    df = df.withColumn("twins", F.sort_array(F.transform(F.filter("ordered", twin), lambda x: x["i"])))
    # Windows overlap: one that starts k words before the next repeated one adds at most k words.
    step = F.transform("twins", lambda at, i: F.least(F.lit(5), F.coalesce(F.get(F.col("twins"), i + 1) - at, F.lit(5))))
    repeated = F.coalesce(F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))

    df = df.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = _with_ratio_sums(df, counts, buckets)
    df = df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": repeated,
        }
    )
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    enough = F.col("sum") >= F.lit(round(threshold * SCALE)) * F.col("n")
    df = df.withColumns(
        {
            "score": F.when(F.col("n") > 0, F.col("sum") / F.col("n") / SCALE).otherwise(F.lit(0.0)),
            "kept": ~F.col("base_failed") & enough,
        }
    )
    # A filter on these columns must not move below the steps above, where it would compute all of them again, once per
    # word. An expression that is not deterministic holds it back.
    here = F.monotonically_increasing_id() >= 0
    return df.select(*([F.col("own.*")] if columns else []), *[F.when(here, F.col(c)).alias(c) for c in ADDED])


def rate(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Count over `docs` (doc_id, text), with the rows labelled quality 1 as the trusted text, and assess every row of it.

    A document is trusted if any of its labels says 1. Null ids match no label. Repeated rows are each counted and each
    returned. Empty tables give an empty result; with no trusted text all ratios are 0 and only the base rules reject.
    All columns stay, whatever their names; see `assess`.
    """
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("id")).distinct().withColumn("trusted", F.lit(True))
    good, small = measured(good)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    marked = lookup(docs.select(F.col("doc_id").alias("id"), text), good, "id", spread_by=("text",), small=small)
    counts = stored(fit_counts(marked.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))), "gram-counts")
    rated = assess(docs.select(own, text), counts, "text", threshold)
    return rated.select(*_unpacked(docs), *ADDED)
