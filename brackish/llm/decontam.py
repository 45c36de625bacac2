"""Benchmark decontamination by templates: numbers, names and units become typed placeholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8  # tokens of a template window
LITERALS = 5  # tokens of a window that must not be placeholders
LEAST_WINDOWS = 6  # windows of an item found in a row: 13 tokens
BROADCAST_WINDOWS = 1_000_000  # benchmark windows (8 bytes each) up to which they are sent to every task

#: Units recognised after a number (fixed values).
UNITS = (
    "km m cm mm mi ft in yd kg g mg lb lbs oz l ml h hr hrs hour hours min mins minute minutes s sec second seconds "
    "day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur gb mb kb mph kmh"
).split()

NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
_NAMED = r"(\p{Lu}(?<=[\p{Ll}\p{N},;\x01] \p{Lu})\p{Ll}+)"  # a capitalised word that does not begin a sentence
_NUMBER = r"(\p{N}+(?:[.,]\p{N}+)*)"
_UNIT = r"(\x02[\p{N}.,]*) +(%|(?:" + "|".join(UNITS) + r")\b)"
_BETWEEN = r"(?:[^\p{L}\p{M}\p{N}\x01\x02\x03.,]|[.,]+(?:[^\p{N}]|$))+"


def _marked(text: Column) -> Column:
    """Placeholders in the text, each followed by its value."""
    text = F.regexp_replace(text, _NAMED, f"{NAME}$1")
    counted = F.regexp_replace(text, _NUMBER, f" {NUMBER}$1 ")
    counted = F.regexp_replace(counted, _UNIT, f"$1 {UNIT}$2")
    return F.when(text.rlike(r"\p{N}"), counted).otherwise(text)


def valued(text: Column) -> Column:
    """The tokens of a text, with the values of the placeholders behind their marks."""
    return F.array_remove(F.split(_marked(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _is_slot(token: Column) -> Column:
    """Whether a token begins with a mark: no other token begins with a character as low."""
    return token < F.lit("\x04")


def _bare(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(_is_slot(t), F.substring(t, 1, 1)).otherwise(F.lower(t)))


def plain(text: Column) -> Column:
    """Lower-case words and numbers of a text, none of them a placeholder."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")


def _spots(tokens: Column, length: int) -> Column:
    """1-based starts of windows; a column of nulls cannot come up here as tokens are never null."""
    last = F.size(tokens) - length + 1
    return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def _token_hashes(tokens: Column) -> Column:
    """One hash a token, so that windows hash numbers and no token is hashed once a window."""
    return F.transform(tokens, lambda t: F.when(_is_slot(t), F.xxhash64(F.substring(t, 1, 1))).otherwise(F.xxhash64(F.lower(t))))


def _hashed_windows(rows: DataFrame, key: str, hashes: str, lengths: list[int]) -> DataFrame:
    """(key, hash) of every window of every length over an array of token hashes.

    Starts are exploded first and windows hashed row by row, which Spark compiles, as it does not for lambdas.
    """

    def whole(n: int) -> Column:
        tokens = [F.get(hashes, F.col("at") + k) for k in range(n)]
        return F.when(F.col("at") + n <= F.size(hashes), F.xxhash64(*tokens))

    last = F.size(hashes) - min(lengths)
    # No filter on the size: it would be pushed below the tokens, which would then be cut twice.
    starts = rows.select(key, hashes, F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at"))
    if len(lengths) == 1:
        return starts.select(key, whole(lengths[0]).alias("hash"))
    return starts.select(key, F.explode(F.array(*map(whole, lengths))).alias("hash")).where("hash is not null")


def _forms(tokens: Column, lengths: list[int]) -> Column:
    """Windows of valued tokens as structs: position, template text, values of the slots."""

    def one(i: Column, n: int) -> Column:
        window = F.slice(tokens, i, n)
        return F.struct(
            i.alias("at"), F.array_join(_bare(window), " ").alias("form"),
            F.transform(F.filter(window, _is_slot), lambda t: F.substring(t, 2, 1 << 30)).alias("slots"),
            F.size(F.filter(window, lambda t: ~_is_slot(t) & ~t.rlike(r"^\p{N}"))).alias("literals"),
        )

    def of(n: int) -> Column:
        return F.transform(_spots(tokens, n), lambda i: one(i, n))

    found = [of(n) for n in lengths]
    return F.concat(*found) if len(found) > 1 else found[0]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item whose template it contains.

    Numbers, units after numbers and capitalised words inside a sentence become typed
    placeholders.  A pair is reported if at least 13 tokens of the item in a row (all of
    a shorter item) occur in the document up to the values of placeholders, and these values
    are consistent: along one alignment a value of the item always stands for the same value
    of the document.  Columns: doc_id, item_id, matched_windows, item_windows,
    changed_slots (values that differ) and exact.

    Items need five tokens that are not placeholders in some window; null, empty and shorter
    items match nothing.  Null and empty texts contain nothing.  Rows that repeat a
    doc_id or an item_id are read as parts of one document or item; rows without an id are left out.

    All hash windows of all documents meet the item windows, which are broadcast up to a
    checked count and joined by shuffle beyond it; only documents with enough hits are read again, exactly.
    """
    return _found(docs, benchmark, valued)


def _found(docs: DataFrame, benchmark: DataFrame, cut, first_as_name: bool = False) -> DataFrame:
    """``contaminated`` over the tokens that ``cut`` makes of a text; the first token of an item may be read as a name too."""
    items = benchmark.where("item_id is not null").select("item_id", cut(F.col("text")).alias("tokens"))
    short = [r[0] for r in items.where(F.size("tokens").between(LITERALS, WINDOW - 1)).select(F.size("tokens")).distinct().collect()]
    own = items.withColumn("length", F.least(F.size("tokens"), F.lit(WINDOW)))
    lengths = sorted({WINDOW, *short})
    per_length = [own.where(F.col("length") == n).select("item_id", F.explode(_forms(F.col("tokens"), [n])).alias("w")) for n in lengths]
    windows = per_length[0]
    for more in per_length[1:]:
        windows = windows.union(more)
    windows = windows.select("item_id", "w.*", F.lit(False).alias("inside")).where(F.col("literals") >= LITERALS)
    sizes = windows.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    if first_as_name:
        # Inside a sentence the first word would be a name; only the item's first window holds it.
        other = benchmark.where("item_id is not null").select(
            "item_id", cut(F.col("text")).alias("alone"), F.slice(cut(F.concat(F.lit("a "), F.ltrim("text"))), 2, 1 << 30).alias("tokens")
        ).where((F.size("tokens") > 0) & (F.get("tokens", F.lit(0)) != F.get("alone", F.lit(0))))
        begun = other.select("item_id", F.slice("tokens", 1, WINDOW).alias("tokens")).where(F.size("tokens") >= LITERALS)
        for n in lengths:
            own_first = begun.where(F.size("tokens") == n).select("item_id", F.explode(_forms(F.col("tokens"), [n])).alias("w")).select("item_id", "w.*", F.lit(True).alias("inside"))
            windows = windows.union(own_first.where(F.col("literals") >= LITERALS))
    known = windows.select(F.xxhash64(F.transform(F.split("form", " "), lambda t: F.xxhash64(t))).alias("hash")).distinct()
    count = known.count()
    fewest = min(LEAST_WINDOWS, sizes.agg(F.min("item_windows")).first()[0] or 1)
    small = F.broadcast if count <= BROADCAST_WINDOWS else (lambda df: df)

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = _hashed_windows(rows.select("doc_id", _token_hashes(cut(F.col("text"))).alias("hashes")), "doc_id", "hashes", lengths)
    hit = hashed.join(small(known), "hash", "left_semi").groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)

    again = rows.join(hit.select("doc_id"), "doc_id", "left_semi").select("doc_id", cut(F.col("text")).alias("tokens"))
    spans = again.select("doc_id", F.explode(_forms(F.col("tokens"), lengths)).alias("w")).select("doc_id", "w.at", "w.form", "w.slots")
    there = windows.select("item_id", F.col("at").alias("item_at"), "form", F.col("slots").alias("item_slots"), "inside")
    met = spans.join(small(there), "form").withColumn("line", F.col("at") - F.col("item_at"))
    pairs = F.array_distinct(F.flatten(F.collect_list(F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc")))))
    if first_as_name:  # the first word as a name must not make inconsistent what is consistent without it
        met = met.withColumn("reading", F.explode(F.when(F.col("inside"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))))
    aligned = met.groupBy("doc_id", "item_id", "line", *(["reading"] if first_as_name else [])).agg(F.collect_set("item_at").alias("spots"), pairs.alias("pairs"))
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    changed = F.size(F.filter("pairs", lambda p: p["item"] != p["doc"]))
    found = aligned.where(consistent).groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).cast("long").alias("matched_windows"),
        F.max(changed).cast("long").alias("changed_slots"),
    )
    return found.join(small(sizes), "item_id").where(F.col("matched_windows") >= F.least(F.lit(LEAST_WINDOWS), "item_windows")).select(
        "doc_id", "item_id", "matched_windows", "item_windows", "changed_slots", (F.col("changed_slots") == 0).alias("exact")
    )


def clean(docs: DataFrame, benchmark: DataFrame, any_case: bool = False) -> DataFrame:
    """The documents that contain no item; rows without a doc_id stay.

    With ``any_case`` items are also found as plain lower-case words, so that copies in other case or inside
    a sentence go, and with values changed where the first word of the item became a name.
    """
    if any_case:
        gone = _found(docs, benchmark, valued, first_as_name=True).select("doc_id").union(_found(docs, benchmark, plain).select("doc_id")).distinct()
    else:
        gone = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
