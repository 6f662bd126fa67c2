"""Benchmark decontamination by templates.

Texts become tokens: numbers turn into ``#``, units behind a number into ``@``, names
(capitalised words within a sentence) into ``$``, and other words are lower-cased.  Windows of
``SIZE`` tokens are hash-joined with the windows of the benchmark; a window needs ``LITERAL``
ordinary words.  So that verbatim copies are found whatever they hold and in whatever case,
windows of the lower-cased tokens themselves are joined too, of any kind of token and, for an
item of fewer than ``SIZE`` tokens, as long as the item.  Each character of a script without
spaces is a token.  First only the ids of documents with some common window are found; for these
the windows are joined again with their slots, the values behind the placeholders.  Over the
common windows of a document and an item, a slot value of the item should always meet the same
value in the document: a re-parameterised question has other values, but consistently.

A document is contaminated by an item if they share ``LEAST`` different windows, or all of a
shorter item's, and at least ``CONSISTENT`` of the item's slot values are consistent.  This is
judged over the common windows at one distance between their places in the document and in the
item, so several variants, or a template that the item repeats, don't spoil each other; and
over all common windows, so words put into the passage don't hide it.  One judgement that passes
is enough, and exact windows, which have no slots, are judged apart; of several, that with the
largest share of the item's windows is shown.  Items without a token match nothing.  Null and empty texts have no window.  Repeated
documents are each reported, repeated items count once.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.llm.common import table, written

SIZE, LITERAL, LEAST, CONSISTENT = 8, 5, 3, 0.9
#: More benchmark windows than these are not broadcast.
SMALL = 500_000
#: Beginnings of windows that can be told apart before a window is hashed.
GATES = 1 << 16
#: Scripts written without spaces, and their punctuation: each character is a token.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\uFF00-\uFFEF\x{20000}-\x{3FFFF}"
TOKEN = rf"[0-9]+(?:[.,:][0-9]+)*|[^\x00-\x40\x5B-\x60\x7B-\x7F{UNSPACED}]+|[.!?\n]+|[{UNSPACED}]"
# Units that make a slot behind a number.
UNITS = ("cm", "days", "dollars", "euros", "feet", "g", "hours", "inches", "kg", "km", "l", "lb", "m", "mg", "miles", "minutes", "ml", "mm", "mph", "pounds",
         "seconds", "weeks", "years", "day", "dollar", "euro", "foot", "hour", "inch", "mile", "minute", "pound", "second", "week", "year")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def template(raw: str) -> Column:
    """Canonical tokens of the array ``raw``; sentence ends become empty strings.

    Tokens begin with a sentence end, a digit, a letter or a byte beyond ASCII, in this order
    of their first bytes, so comparing whole tokens tells their kind.
    """
    def one(x: Column, i: Column) -> Column:
        before = F.get(F.col(raw), i - 1)
        unit = (before >= "0") & (before < ":") & F.lower(x).isin(*UNITS)
        inside = (before >= "A") | (before >= "0") & (before < ":")
        name = (x >= "A") & (x < "[") & inside
        return F.when((x < "0") | (x >= "?") & (x < "@"), F.lit("")).when(x < ":", F.lit("#")).when(unit, F.lit("@")).when(name, F.lit("$")).otherwise(F.lower(x))

    return F.transform(raw, one)


def tokenised(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key``, canonical tokens ``t`` without sentence ends, and their values ``v``."""
    rows = df.select(key, tokens(F.col(text)).alias("_raw"))
    rows = rows.withColumn("_t", template("_raw"))
    both = F.filter(F.arrays_zip(F.col("_t").alias("t"), F.col("_raw").alias("v")), lambda x: x["t"] != "")
    return rows.select(key, both.alias("_b")).select(key, F.col("_b.t").alias("t"), F.col("_b.v").alias("v"))


def literals(window: Column) -> Column:
    return F.size(F.filter(window, lambda x: ~x.isin("#", "@", "$")))


def places(t: Column, size: int | Column = SIZE) -> Column:
    size = F.lit(size) if isinstance(size, int) else size
    return F.when((F.size(t) >= size) & (size > 0), F.sequence(F.lit(1), F.size(t) - size + 1))


def hashes_of(t: Column, low: Column, sizes: list[int], gates: bytes | None = None) -> Column:
    """Place, kind and hash of every window: kind 0 are those of the templates ``t``, others
    those of as many lower-cased tokens ``low``.  A window's hash is that of its tokens' hashes.
    With ``gates``, only of windows that begin like some window of the benchmark."""
    def windows(of: Column, size: int, kind: int) -> Column:
        at = places(of, size)
        if gates is not None:
            at = F.filter(at, lambda i: F.substring(F.lit(gates), gate(of, i, size) + 1, 1) == F.lit(b"\x01"))
        each = F.transform(at, lambda i: F.struct(i.alias("pos"), F.lit(kind).alias("kind"), hashed(F.slice(of, i, F.lit(size))).alias("hash")))
        return F.coalesce(each, F.array().cast("array<struct<pos:int,kind:int,hash:bigint>>"))

    return F.concat(windows(t, SIZE, 0), *[windows(low, k, k) for k in sizes])


def gate(hashes: Column, at: Column, size: int) -> Column:
    """Which of the gates a window passes: one of its first two tokens, or of its only one."""
    first = F.get(hashes, at - 1)
    return F.pmod(F.xxhash64(first, F.get(hashes, at)) if size > 1 else F.xxhash64(first), F.lit(GATES)).cast("int")


def gates_of(items: DataFrame, sizes: list[int]) -> bytes:
    """A byte for each gate, 1 where a window of the benchmark begins; ``GATES`` bytes, however large the benchmark is."""
    rows = items.select("kind", token_hashes("w").alias("h"))
    parts = [rows.where(F.col("kind") == kind).select(gate(F.col("h"), F.lit(1), kind or SIZE).alias("gate")) for kind in (0, *sizes)]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    out = bytearray(GATES)
    for row in both.distinct().collect():  # at most GATES numbers
        out[row.gate] = 1
    return bytes(out)


def hashed(window: Column) -> Column:
    return F.xxhash64(window, F.size(window))


def token_hashes(t: str) -> Column:
    return F.transform(t, lambda x: F.xxhash64(F.lower(x)))


def window_at(pos: Column) -> tuple[Column, Column]:
    """The template window of the columns ``t`` and ``v`` at a place, and its slots."""
    w, v = F.slice("t", pos, F.lit(SIZE)), F.slice("v", pos, F.lit(SIZE))
    slots = F.filter(F.arrays_zip(w.alias("w"), v.alias("v")), lambda x: x["w"].isin("#", "@", "$"))
    return w, F.transform(slots, lambda x: F.concat(x["w"], F.lower(x["v"])))


def any_window(pos: Column, kind: Column) -> tuple[Column, Column]:
    """The window of a kind at a place; exact windows have no slots."""
    w, slots = window_at(pos)
    low = F.transform(F.slice("v", pos, kind), lambda x: F.lower(x))
    return F.when(kind == 0, w).otherwise(low), F.when(kind == 0, slots).otherwise(F.array().cast("array<string>"))


def token_pairs(raw: Column) -> Column:
    """For each token that is no sentence end, the hashes of its canonical and its lower-cased form."""
    def one(x: Column, i: Column) -> Column:
        before = F.get(raw, i - 1)
        number, capital = (before >= "0") & (before < ":"), (x >= "A") & (x < "[")
        own = F.xxhash64(F.lower(x))
        kind = (F.when(x < ":", "#").when(number, F.when(F.lower(x).isin(*UNITS), "@").when(capital, "$"))
                .when(capital & (before >= "A"), "$"))
        return F.when(~((x < "0") | (x >= "?") & (x < "@")), F.struct(F.when(kind.isNull(), own).otherwise(F.xxhash64(kind)).alias("t"), own.alias("low")))

    return F.array_compact(F.transform(raw, one))


def marked(docs: DataFrame, hashes: DataFrame, small: bool, sizes: list[int], gates: bytes) -> DataFrame:
    """Ids of the documents that share a window's hash with the benchmark; values aren't carried.

    Few windows begin with two tokens that begin one of the benchmark's, and only those are hashed.
    """
    rows = docs.select("doc_id", tokens(F.col("text")).alias("_raw")).select("doc_id", token_pairs(F.col("_raw")).alias("_p"))
    rows = rows.select("doc_id", F.col("_p.t").alias("t"), F.col("_p.low").alias("low"))
    rows = rows.select("doc_id", F.explode(F.transform(hashes_of(F.col("t"), F.col("low"), sizes, gates), lambda x: x["hash"])).alias("hash"))
    hashes = hashes.select("hash").distinct()
    return rows.join(F.broadcast(hashes) if small else hashes, "hash", "left_semi").select("doc_id").distinct()


def accepted(out: DataFrame) -> DataFrame:
    return out.where((F.col("n_windows") >= F.least(F.lit(LEAST), F.col("all"))) & (F.col("consistent") >= CONSISTENT))


def readings(hits: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Shared windows and slot consistency of each group ``keys`` of hits, where they suffice."""
    counts = hits.groupBy(*keys).agg(F.countDistinct("hash").alias("n_windows"))
    pairs = hits.select(*keys, F.explode(F.arrays_zip(F.col("islots").alias("i"), F.col("slots").alias("d"))).alias("p")).select(*keys, "p.i", "p.d").distinct()
    values = pairs.groupBy(*keys, "i").agg(F.count("*").alias("n"), F.max((F.col("i") != F.col("d")).cast("int")).alias("other"))
    slots = values.groupBy(*keys).agg(F.count("*").alias("n_slots"), F.avg((F.col("n") == 1).cast("double")).alias("consistent"), F.max("other").alias("other"))
    out = counts.join(sizes, ["item_id", "exact"]).join(slots, keys, "left")
    return accepted(out.select("doc_id", "item_id", "n_windows", (F.col("n_windows") / F.col("all")).alias("share"), F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
                               F.coalesce("consistent", F.lit(1.0)).alias("consistent"), F.coalesce(F.col("other") == 1, F.lit(False)).alias("changed"), "all"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, n_windows, share, n_slots,
    consistent, changed``; ``changed`` says whether some slot has another value than in the item."""
    docs = docs.select(F.col("doc_id"), "text")
    parts = tokenised(benchmark.select("item_id", "text"), "item_id").withColumn("irow", F.xxhash64("t", "v"))
    short = F.least(F.lit(SIZE), F.size("t"))
    kinds = parts.withColumn("kind", F.explode(F.array(F.lit(0), short)))
    kinds = kinds.withColumn("ipos", F.explode(places(F.col("t"), F.when(F.col("kind") == 0, SIZE).otherwise(F.col("kind")))))
    w, slots = any_window(F.col("ipos"), F.col("kind"))
    items = kinds.select("item_id", "irow", "ipos", "kind", w.alias("w"), slots.alias("slots")).where((F.col("kind") > 0) | (literals(F.col("w")) >= LITERAL))
    items = written(items.withColumn("hash", hashed(token_hashes("w"))).distinct(), "items")
    hashes = items.select("kind", "hash").distinct()
    small = items.count() <= SMALL
    exact = sorted(r.kind for r in items.where("kind > 0").select("kind").distinct().collect())  # at most SIZE numbers
    found = written(marked(docs, hashes, small, exact, gates_of(items, exact)), "marked")

    near = written(tokenised(docs.join(found, "doc_id", "left_semi"), "doc_id").withColumn("_row", F.xxhash64("t", "v")), "tokens")
    met = near.select("doc_id", "_row", token_hashes("t").alias("t"), token_hashes("v").alias("low"))
    met = met.select("doc_id", "_row", F.explode(hashes_of(F.col("t"), F.col("low"), exact)).alias("h")).select("doc_id", "_row", "h.*")
    met = met.join(F.broadcast(hashes) if small else hashes, ["kind", "hash"], "left_semi")
    # The places of a document at which something was met, at most its length for each kind.
    met = met.groupBy("doc_id", "_row").agg(F.collect_set(F.struct("pos", "kind", "hash")).alias("met"))
    both = near.join(met, ["doc_id", "_row"]).select("doc_id", "_row", F.transform("met", lambda m: F.struct(
        m["pos"].alias("pos"), m["kind"].alias("kind"), m["hash"].alias("hash"), any_window(m["pos"], m["kind"])[0].alias("w"), any_window(m["pos"], m["kind"])[1].alias("slots"))).alias("met"))
    both = both.select("doc_id", "_row", F.explode("met").alias("m")).select("doc_id", "_row", "m.*")
    side = items.select("item_id", "irow", "ipos", "kind", "hash", F.col("w").alias("iw"), F.col("slots").alias("islots"))
    hits = both.join(F.broadcast(side) if small else side, ["kind", "hash"]).where("w = iw").withColumn("exact", F.col("kind") > 0)
    hits = written(hits.select("doc_id", "_row", "item_id", "irow", "exact", (F.col("pos") - F.col("ipos")).alias("offset"), "hash", "slots", "islots").distinct(), "hits")
    sizes = items.groupBy("item_id", (F.col("kind") > 0).alias("exact")).agg(F.countDistinct("hash").alias("all"))
    whole = readings(hits, sizes, ["doc_id", "item_id", "exact"])
    aligned = readings(hits.where("NOT exact"), sizes, ["doc_id", "item_id", "exact", "_row", "irow", "offset"])
    best = F.max(F.struct("share", "consistent", (~F.col("changed")).alias("same"), "n_windows", "n_slots")).alias("b")
    out = whole.unionByName(aligned).groupBy("doc_id", "item_id").agg(best)
    return out.select("doc_id", "item_id", "b.n_windows", "b.share", "b.n_slots", "b.consistent", (~F.col("b.same")).alias("changed"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that share a passage."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
