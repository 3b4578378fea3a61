"""Quality rules: counting rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed character n-grams (the first and the last three
characters of every word, into ``buckets`` cells) are compared: the trusted
target's, from documents labelled good, and the raw corpus's, from all
documents.  With t trusted n-grams in a cell and E the number that the raw
corpus lets expect there, the cell's ratio is ``ln (t + 1) / (E + 1)``, shrunk by
``1 - shrink^2 / z^2`` (not below 0), z being how many standard deviations t is
away from E: a cell speaks as far as its counts do, at every table size.  A
document's score is the mean ratio of its n-grams; it is kept when the counting
rules pass and the score is at least the cut.

The cut is the ``CUT_SHARE`` quantile of held-out scores: the trusted documents
(of 50 words or more) are dealt into ``FOLDS`` folds by a hash of their id, and
each is scored by ratios whose trusted counts leave its fold out.  That is one
law for all sizes; with few trusted documents it comes to the least held-out
score.  Every document labelled good is trusted; their ids are broadcast when there
are few of them and joined by a shuffle otherwise.

Every text is cut into words once: its counts and its cells are written as a
table, which the counts of the cells, the cut and the verdicts are read from.

Defined cases: a null or empty text has no words and fails the rules (under 50
words); a text without words scores 0; repeated rows count as often as they
occur; without trusted documents every score and the cut are 0; a document
labelled more than once counts once, and is good if a label says so and none says
toxic; an empty table gives an empty result; extra columns are kept, and one that
is named like a result raises.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import bounded_broadcast, with_row
from ..operators.prefix import exact_quantiles
from .common import SPACES, materialize

BUCKETS = 1 << 14
SHRINK = 3.0  # standard deviations below which a cell says nothing
CUT_SHARE = 0.001  # share of the held-out trusted documents below the cut
FOLDS = 4
SYMBOLS = r"[#*$%&|<>]"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def _repeat_words(hashes: str, ranked: str) -> Column:
    """Words in 3-word windows that occur twice or more: windows sorted by
    (hash, place) have their equals next to them."""
    r = F.col(ranked)
    same = F.transform(r, lambda x, i: F.when(
        (x["h"] == F.get(r, i - 1)["h"]) | (x["h"] == F.get(r, i + 1)["h"]), x["i"]))
    at = F.array_compact(same)
    covered = F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1),
                                        F.transform(at, lambda i: i + 2)))
    return F.when(F.size(hashes) == 0, F.lit(0)).otherwise(F.size(covered)).cast("long")


def measured(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Add the base counts (``RESULTS``) and ``cells``: for every word the hash cells
    of its first and its last three characters, as one number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = F.col("_words")
    out = docs.withColumn("_words", words_of(F.col(text_col)))
    # the windows' hashes; only texts with some window twice need the sort
    h = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
                1, F.greatest(F.size(w) - 2, F.lit(0)))
    out = out.withColumn("_h", h)
    out = out.withColumn("_h", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.col("_h"))
                         .otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("_r", F.sort_array(F.transform(
        "_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("_lines", F.when(F.instr(text, "\n") > 0, lines).otherwise(F.array().cast("array<string>")))
    cell = lambda s: F.pmod(F.xxhash64(s), F.lit(buckets)).cast("int")
    ends = F.transform(w, lambda x: cell(F.substring(x, 1, 3)) * buckets + cell(F.substring(x, -3, 3)))
    out = out.select(
        *[F.col(c) for c in docs.columns],
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_h", "_r").alias("n_repeat_words"), ends.alias("cells"))
    return out.withColumn("base_failed", (F.col("n_words") < 50)
                          | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(_trusted, _fold) of all good documents."""
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    return good.filter("doc_id is not null and q = 1 and coalesce(t, 0) = 0").select(
        F.col("doc_id").alias("_trusted"), F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("_fold"))


def log_ratios(counted: DataFrame, ids: DataFrame, buckets: int = BUCKETS, shrink: float = SHRINK) -> DataFrame:
    """One row: ``ratios``, the cells' shrunk log ratios, and ``held``, the same
    without the trusted documents of each fold, for ``counted`` (doc_id, cells)."""
    words = counted.join(bounded_broadcast(ids), F.col("doc_id") == F.col("_trusted"), "left").select(
        "_fold", F.explode("cells").alias("cell"))
    by_word = words.groupBy("_fold", "cell").agg(F.count(F.lit(1)).alias("n"))
    grams = by_word.select("_fold", "n", F.explode(F.array(*_ends(F.col("cell"), buckets))).alias("cell"))
    fold = [F.sum(F.when(F.col("_fold") == f, F.col("n")).otherwise(0)) for f in range(FOLDS)]
    counts = grams.groupBy("cell").agg(F.array(*fold).alias("t"), F.sum("n").alias("r"))
    cells = counted.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell"))
    none = F.array(*[F.lit(0).cast("long")] * FOLDS)
    full = cells.join(counts, "cell", "left").select(
        "cell", F.coalesce("t", none).alias("t"), F.coalesce("r", F.lit(0)).alias("r"))
    totals = [F.sum(F.col("t")[f]) for f in range(FOLDS)]
    listed = full.agg(F.array_sort(F.collect_list(F.struct("cell", "t", "r"))).alias("a"),
                      F.array(*totals).alias("nt"), F.sum("r").alias("nr"))

    def ratios(folds: list[int]) -> Column:
        total = sum((F.col("nt")[f] for f in folds), F.lit(0))

        def one(x: Column) -> Column:
            t = sum((x["t"][f] for f in folds), F.lit(0)).cast("double")
            expected = x["r"] * total / F.col("nr")
            z2 = (t - expected) * (t - expected) / (expected + 1)
            kept = F.when(z2 > shrink * shrink, 1 - shrink * shrink / z2).otherwise(0.0)
            return F.log((t + 1) / (expected + 1)) * kept

        return F.transform("a", lambda x: F.when(F.col("nr") > 0, one(x)).otherwise(0.0))

    return listed.select(ratios(list(range(FOLDS))).alias("ratios"), F.array(*[
        ratios([f for f in range(FOLDS) if f != out]) for out in range(FOLDS)]).alias("held"))


def _ends(cell: Column, buckets: int) -> tuple[Column, Column]:
    """The two cells of a number in ``cells``."""
    return F.floor(cell / buckets).cast("int"), F.pmod(cell, F.lit(buckets))


def _score(ratios: Column, buckets: int) -> Column:
    """The mean of ``ratios`` over a row's n-grams."""
    def add(s: Column, c: Column) -> Column:
        a, z = _ends(c, buckets)
        return s + F.get(ratios, a) + F.get(ratios, z)

    total = F.aggregate("cells", F.lit(0.0), add)
    return F.when(F.size("cells") == 0, 0.0).otherwise(total / (2 * F.size("cells")))


def held_out_cut(counted: DataFrame, ids: DataFrame, ratios: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: ``_cut``, the least score that is kept."""
    trusted = counted.filter("n_words >= 50").join(bounded_broadcast(ids), F.col("doc_id") == F.col("_trusted")).select(
        "_fold", "cells")
    scored = with_row(trusted, ratios.select("held")).select(_score(F.get(F.col("held"), F.col("_fold")), buckets).alias("_s"))
    # no task holds all scores
    least = exact_quantiles(materialize(scored, "quality-held-out"), "_s", [CUT_SHARE])
    return least.agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("_cut"))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
          shrink: float = SHRINK, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them) with the base counts,
    ``score`` and ``kept``."""
    keep = list(docs.columns if keep is None else keep)
    clash = {*RESULTS, "cells", "score", "kept", "ratios", "_cut", "_words", "_h", "_r", "_lines", "_trusted", "_fold"}
    if clash & set(docs.columns):
        raise ValueError(f"rename these columns first: {sorted(clash & set(docs.columns))}")
    ids = materialize(trusted_ids(labels), "quality-trusted")
    counted = materialize(measured(docs, buckets=buckets).select(*dict.fromkeys([*keep, "doc_id", *RESULTS, "cells"])),
                          "quality-counts")
    ratios = materialize(log_ratios(counted, ids, buckets, shrink), "quality-ratios")
    cut = materialize(held_out_cut(counted, ids, ratios, buckets), "quality-cut")
    m = with_row(with_row(counted, ratios.select("ratios")), cut).withColumn("score", _score(F.col("ratios"), buckets))
    m = m.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.col("_cut")))
    return m.select(*keep, *RESULTS, "score", "kept")
