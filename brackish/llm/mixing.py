"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.operators.ordered import Run, Slices, running
from brackish.session import cut_lineage

WEIGHTS = (3, 1, 2)  # of the sources in order of their names, repeating
SHARE = 1.5  # of all words, that the mix holds
COPIES = 2  # times that a document is taken at most
SLICE_ROWS = 10_000  # rows of an axis, about, that one task orders
MOST_SLICES = 1_000_000
BROADCAST_SOURCES = 100_000  # sources up to which their few numbers are sent to every task
SALTS = 32
_HASH_BITS = 60


def words(text: Column) -> Column:
    """How many runs of characters other than ASCII white space a text has; null has none."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def shuffled(doc_id: Column) -> Column:
    """A place in a shuffled order: the first 60 bits of the md5 of the id; rows without an id come first."""
    digits = F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, _HASH_BITS // 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """source, source_no (from 1), source_size, docs and target of each source of ``sized`` (source, size).

    Targets share ``share`` times all words by weight; none is above ``copies`` times its source, and
    what a source cannot take is shared by the others.  Sources are ranked by what they hold for their
    weight: those below the common level are full, and the level follows from running sums of the full ones.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    named = cut_lineage(sources.withColumn("last", F.col("source").isNull()))
    numbered = running(named, [], ["last", "source"], {"source_no": Run("row_index")}).drop("last")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    rated = numbered.withColumn("weight", weight).withColumn("most", F.col("source_size").cast("double") * copies)
    rated = cut_lineage(rated.withColumn("level", F.col("most") / F.col("weight")))
    total, all_weights = rated.agg(F.sum("source_size"), F.sum("weight")).first()
    upto = running(rated, [], ["level", "source_no"], {"place": Run("row_index"), "full": Run("sum", F.col("most")), "filled": Run("sum", F.col("weight"))})
    left = F.lit(share * (total or 0)) - (F.col("full") - F.col("most"))
    open_weight = F.lit(float(all_weights or 0)) - (F.col("filled") - F.col("weight"))
    first_open = upto.where(left * F.col("weight") <= F.col("most") * open_weight)
    found = first_open.agg(F.min_by(F.struct(left.alias("left"), open_weight.alias("weight")), "place").alias("at")).first()["at"]
    level = found["left"] / found["weight"] if found else float("inf")
    return rated.select("source", "source_no", "source_size", "docs", F.least("most", F.col("weight") * F.lit(level)).alias("target"))


def _with_targets(sized: DataFrame, goals: DataFrame, count: int) -> DataFrame:
    """The rows of ``sized`` with the columns of their source; null is a source."""
    same = sized["source"].eqNullSafe(goals["source"])
    if count <= BROADCAST_SOURCES:
        return sized.join(F.broadcast(goals), same).drop(goals["source"])
    # A source may hold a third of all rows: its numbers are laid out in several places.
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("place", "doc_id"), F.lit(SALTS)).cast("int"))
    laid = goals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = salted["source"].eqNullSafe(laid["source"]) & (salted["salt"] == laid["salt"])
    return salted.join(laid, same).drop(laid["source"]).drop("salt")


def _even(column: str, span: float, rows: int) -> Slices:
    """Slices of an axis that is filled evenly."""
    pieces = min(MOST_SLICES, -(-rows // SLICE_ROWS))
    return Slices(column, span / pieces if pieces > 1 else None)


def stream(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, copies: int = COPIES) -> tuple[DataFrame, DataFrame]:
    """The mix, and every document with its part in it.

    Documents of a source queue in shuffled order, ``copies`` times over.  A copy's virtual finish time is
    the words of its source up to its end, divided by the source's target; copies are ordered by it over all
    sources, slice by slice, and the order ends where the words of the budget are used up.  At that moment
    every source has one document in service at most, of which the words already served are taken.

    The first frame has one row a copy in the mix: doc_id, source_no, before (words of the source ahead of
    the document), copy, words, finish, start (words of the mix ahead of it).  The second has one row a
    document: doc_id, source, size, source_no, source_size, target, before.  Null text has no words, documents
    without words are never taken; null is a source of its own, the last; rows that repeat a doc_id queue each
    (rows alike in doc_id, source and size take either place); an empty table gives no rows.
    """
    sized = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), shuffled(F.col("doc_id")).alias("place")))
    goals = cut_lineage(targets(sized, weights, share, copies))
    total, rows, sources = goals.agg(F.sum("source_size"), F.sum("docs"), F.count(F.lit(1))).first()
    budget = int(share * (total or 0))
    met = _with_targets(sized, goals, sources)
    queued = running(met, ["source_no"], ["place", "doc_id", "size"], {"upto": Run("sum", F.col("size"))}, _even("place", 2.0**_HASH_BITS, rows or 0))
    every = cut_lineage(queued.select("doc_id", "source", "size", "source_no", "source_size", "target", (F.col("upto") - F.col("size")).alias("before")))

    quota = F.floor("target")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    ahead = F.col("copy") * F.col("source_size") + F.col("before")
    served = every.select("*", copy.alias("copy")).withColumn("words", F.least("size", quota - ahead)).where("words > 0")
    timed = served.withColumn("finish", (ahead + F.col("words")) / F.col("target"))
    order = ["finish", "source_no", "before", "copy"]
    placed = running(timed, [], order, {"end": Run("sum", F.col("words"))}, _even("finish", 1.0, copies * (rows or 0)))
    mixed = placed.withColumn("start", F.col("end") - F.col("words")).where(F.col("start") < budget)
    mixed = mixed.withColumn("words", F.least("words", F.lit(budget) - F.col("start")))
    return mixed.select("doc_id", "source_no", "before", "copy", "words", "finish", "start"), every


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """Every document with what the mix takes of it: doc_id, size, source_size, target, taken, first_at.

    ``first_at`` is where its first copy starts in the mix, null if it is not taken.  Cases as for ``stream``.
    """
    mixed, every = stream(docs, weights, share, copies)
    # Documents with words are told apart by their source and what is ahead of them there.
    parts = mixed.select("source_no", "before", "words", "start").union(
        every.where("size > 0").select("source_no", "before", F.lit(0).cast("long"), F.lit(None).cast("long"))
    )
    named = every.where("size > 0").select("source_no", "before", "doc_id", "size", "source_size", "target")
    taken = parts.groupBy("source_no", "before").agg(F.sum("words").alias("taken"), F.min("start").alias("first_at"))
    kept = named.join(taken, ["source_no", "before"]).drop("source_no", "before")
    none = every.where("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_at"))
    return kept.unionByName(none)
