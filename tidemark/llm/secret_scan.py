"""Secret scans: patterns, and multipart credentials linked by an interval join.

Three kinds are reported wherever they stand: `assign`, `access` and `hex`. Weaker parts (account names, opaque values,
endpoints) say little alone. Scopes are the paragraphs of a text; parts are joined to the scope whose interval they start
in, and a weak part is reported only if a complementary part starts there too, however far away: an identifier or an
endpoint needs a secret, an opaque value needs an identifier or an endpoint. Base spans take part as secrets (assign,
hex) and identifiers (access).

What is part of another part does not complete it. Taken out first are identifiers that touch an endpoint, and opaque
values that touch an endpoint or an identifier or lie inside an assign or hex span; an assign or hex span that touches an
endpoint stays a span, but is no secret for endpoints.

Positions come from the pieces between matches, since the built-in functions return matched text only: a match starts
where the pieces and matches before it end. All counting is in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.skew import is_small
from tidemark.session import stored

# Fixed patterns of the base kinds.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",  # runs are maximal, so a least length drops the same matches as a filter afterwards
}
# Weak parts, in the order in which equal starts are listed, after the base kinds.
WEAK = {
    "identifier": r"""(?i:access_?key_?id|client_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""",
    "opaque": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}",  # and all of _OPAQUE below
    "endpoint": r"""(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]{4,}""",
}
_OPAQUE = ("[0-9]", "[A-Z]", "[a-z]")
KINDS = [*BASE, *WEAK]
SCOPE = r"\n[\x20\x09\x0D]*\n"
LEAST_VALUE, LEAST_ACCESS = 6, 20
SECRETS, NAMES = ("assign", "hex"), ("access", "identifier")


def _matches(kind: str, pattern: str) -> Column:
    """Matches with the lengths that give their places: array of (gap before, length, value length)."""
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split("text", pattern, -1), lambda p: F.length(p))
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(1)) if kind == "assign" else whole
    if kind == "opaque":
        mixed = lambda m: F.when(m.rlike(_OPAQUE[0]) & m.rlike(_OPAQUE[1]) & m.rlike(_OPAQUE[2]), m)
        value = F.transform(whole, mixed)
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(whole, lambda m: F.length(m)).alias("len"), F.transform(value, lambda m: F.length(m)).alias("value"))
    return F.when(F.regexp_like("text", F.lit(pattern)), zipped)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Spans of every row of `docs`: all columns but `text` stay as they are, and `spans` is added (or replaced).

    `spans` is an array of (start, ord, kind, end) in order, null where there is none; null text counts as empty. The
    result rests on a table in the shared folder that holds lengths and the other columns, never texts. A text of any
    length is matched as a whole; what is shuffled of it is one row for each match.
    """
    kept = [c for c in docs.columns if c != text and c.lower() != "spans"]
    own = F.struct(*([F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("nothing")])).alias("own")
    rows = docs.select(own, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = rows.select("own", "row", *[_matches(k, p).alias(k) for k, p in {**BASE, **WEAK}.items()], _matches("scope", SCOPE).alias("scope"))
    found = stored(found, "matches")

    def places(kind: str) -> DataFrame:
        each = found.select("row", F.posexplode_outer(kind).alias("i", "m")).where("m is not null")
        each = each.select("row", "i", F.col("m.gap").alias("gap"), F.coalesce("m.len", F.lit(0)).alias("len"), F.col("m.value").alias("value"))
        return each.withColumn("kind", F.lit(kind)).withColumn("ord", F.lit(KINDS.index(kind) if kind in KINDS else -1))

    everything = places("scope")
    for kind in KINDS:
        everything = everything.union(places(kind))
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    spans = everything.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).withColumn("start", F.col("end") - F.col("len"))
    good = F.col("value").isNotNull()  # the piece after the last match has none
    good &= (F.col("kind") != "assign") | (F.col("value") >= LEAST_VALUE)
    good &= (F.col("kind") != "access") | (F.col("value") >= LEAST_ACCESS)
    spans = spans.where(good).select("row", "kind", "ord", F.col("start").cast("long"), F.col("end").cast("long"))
    linked = _linked(spans)
    lists = linked.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "ord", "kind", "end"))).alias("spans"))
    return found.select("own", "row").join(lists, "row", "left").select(*[F.col(f"own.`{c}`").alias(c) for c in kept], "spans")


def _linked(spans: DataFrame) -> DataFrame:
    """Of all parts (row, kind, ord, start, end) and boundaries (kind `scope`) the base spans and the completed weak ones."""
    order = Window.partitionBy("row").orderBy("start", "ord", "end")
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    kind = F.col("kind")

    def touches(*kinds: str) -> Column:
        """Whether a part of one of the kinds overlaps this one: one that starts before and ends in it, or starts in it."""
        left = F.max(F.when(kind.isin(*kinds), F.col("end"))).over(before) > F.col("start")
        right = F.min(F.when(kind.isin(*kinds), F.col("start"))).over(behind) < F.col("end")
        return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

    within = F.coalesce(F.max(F.when(kind.isin(*SECRETS), F.col("end"))).over(before) >= F.col("end"), F.lit(False))
    # A boundary opens the scope of everything that starts at or behind it.
    number = F.sum((kind == "scope").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = spans.withColumns({"scope": number, "on_endpoint": touches("endpoint"), "on_name": touches(*NAMES), "within": within})
    out = (kind == "identifier") & F.col("on_endpoint") | (kind == "opaque") & (F.col("on_endpoint") | F.col("on_name") | F.col("within"))
    placed = placed.where((kind != "scope") & ~out)
    scope = Window.partitionBy("row", "scope")
    has = lambda *kinds: F.max(kind.isin(*kinds)).over(scope)
    free_secret = F.max((kind == "opaque") | kind.isin(*SECRETS) & ~F.col("on_endpoint")).over(scope)
    placed = placed.withColumns({"secret": has(*SECRETS, "opaque"), "free_secret": free_secret, "name": has(*NAMES, "endpoint")})
    complete = (kind == "identifier") & F.col("secret") | (kind == "opaque") & F.col("name") | (kind == "endpoint") & F.col("free_secret")
    return placed.where(kind.isin(*BASE) | complete)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summarise(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_linked for every row of `docs` (doc_id, text).

    Every row gives one row, repeated rows and null ids too; a text without a find (null, empty) gives zeros, the hash
    of the empty string and an empty list. Other columns are not looked at.
    """
    found = find_spans(docs.select("doc_id", "text"))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>"))
    found = found.select("doc_id", spans.alias("found"))
    base = F.filter("found", lambda s: s["ord"] < len(BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["ord"] >= len(BASE))).cast("long").alias("n_linked"),
    )


MASK = "[secret]"


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every reported span of text replaced by a mask; all rows and columns stay, whatever their names.

    Overlapping spans give one mask. Texts without a span are left as they are, null ones null; equal texts, repeated
    rows too, are masked alike. Empty tables stay empty.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select(own, "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))
    found = find_spans(rows.select("key", "text")).where("spans is not null")
    spans = stored(found.groupBy("key").agg(F.any_value("spans").alias("spans")), "spans")
    marked = rows.join(F.broadcast(spans) if is_small(spans) else spans, "key", "left")

    def step(done: Column, s: Column) -> Column:
        before = F.substring(F.col("text"), done["at"] + 1, s["start"].cast("int") - done["at"])
        end = F.greatest(done["at"], s["end"].cast("int"))
        out = F.when(s["start"] >= done["at"], F.concat(done["out"], before, F.lit(MASK))).otherwise(done["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", first, step, lambda d: F.concat(d["out"], F.substring(F.col("text"), d["at"] + 1, F.length("text"))))
    masked = F.when(F.col("spans").isNotNull(), clean).otherwise(F.col("text"))
    return marked.select(*[(masked if c == "text" else F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
