"""Benchmark decontamination by template windows.

Words are made canonical one by one: punctuation around them is stripped,
numbers, names (capitalised words) and units become typed placeholders, all
others are lower-cased.  Windows of ``width`` template words with at least
``min_literals`` ordinary words are hashed and joined between benchmark and
documents, so a question with other numbers or names still matches.  A second
reading leaves names as ordinary words, for texts whose capitals were changed;
an item counts under the reading that finds more of it.  The slots (the words
behind the placeholders) of the matched windows must then map one-to-one: a
document holds an item when its windows cover at least ``coverage`` of the item's,
or ``run`` template words of it without a gap (an excerpt, however long the item),
and the slot mapping is consistent to at least ``consistency``.  This is tested
for every alignment (place in the text minus place in the item) on its own, so
that a template's other uses in the text do not count against the item, and for
the first places of all windows together, for items with words put in between.

Items shorter than a window are one window of their own length.  An item without
any window of ``min_literals`` ordinary words (numbers and units for the most part)
is read word by word, without placeholders, in all its windows; only items of fewer
than ``min_literals`` words cannot be found.  Before the join,
documents drop windows that no item can have, by a bitmap of the benchmark's
hashes of fixed size (2**22 cells, whatever the benchmark's size); the join
itself is exact and shuffled, so the benchmark is never broadcast.

Defined cases: null and empty texts hold nothing; repeated rows share their
result, and a doc_id is contaminated when any of its rows is; equal items all
match; an empty benchmark or table finds nothing; extra columns are kept, but
those named like a result fail (ValueError).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, reserve, tidy

CELLS = 1 << 22
# Words that count as numbers or units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion half quarter dozen".split())
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles metre metres meter meters kilometre "
    "kilometres kilometer kilometers mg g kg gram grams kilogram kilograms tonne tonnes lb lbs pound "
    "pounds oz ounce ounces ml l litre litres liter liters gallon gallons second seconds sec minute "
    "minutes min hour hours hr day days week weeks month months year years percent degree degrees "
    "celsius fahrenheit kelvin mph kmh kph watt watts kw volt volts joule joules newton newtons "
    "dollar dollars cent cents euro euros usd eur gbp".split())
_NUMBER = re.compile(r"[-+]?\d[\d.,:/]*(?:st|nd|rd|th|%|[a-z]{1,3})?$")
_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¿¡"
# A template word is 0 (no word), NUM or UNIT, or a hash whose last three bits are NAME or PLAIN.
NUM, UNIT, NAME, PLAIN = 1, 2, 3, 4
EXACT = 5  # the reading of windows with too few ordinary words
READINGS = (NAME, PLAIN, EXACT)  # what a name becomes
_BASE = 0x9E3779B97F4A7C15


def template_of(word: bytes) -> int:
    """The template word of a word of a text."""
    w = word.decode().strip(_STRIP)
    if not w:
        return 0
    low = w.lower()
    if _NUMBER.match(low) or low in NUMBER_WORDS:
        return NUM
    if low in UNITS:
        return UNIT
    kind = NAME if w[0].isupper() and len(w) > 1 and w[1:].islower() else PLAIN
    return xxhash.xxh64_intdigest(low.encode()) & ~7 | kind


class _Templates(dict):
    """Template numbers of words, filled on demand up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = code = template_of(word)
        return code


_KNOWN = _Templates()


def _read(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words, and of the template words: place, text number and code."""
    words, sizes = [], []
    for t in texts:
        w = (t or b"").split()
        words += w
        sizes.append(len(w))
    codes = np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))
    real = np.flatnonzero(codes)
    return words, real, np.repeat(np.arange(len(texts)), sizes)[real], codes[real]


def _exact(words: list[bytes], real: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``codes`` with the words themselves in place of numbers and units."""
    out = codes.copy()
    for j in np.flatnonzero(codes < 8).tolist():
        w = words[real[j]].decode().strip(_STRIP).lower()
        out[j] = xxhash.xxh64_intdigest(w.encode()) & ~7 | PLAIN
    return out


def _windows(codes: np.ndarray, owner: np.ndarray, reading: int, width: int, min_literals: int,
             whole: bool, shown: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows; with ``whole`` only texts of exactly
    ``width`` template words count.  ``shown``: the codes hashed under EXACT."""
    names = codes & np.uint64(7) == NAME
    codes = np.where(names & (codes > 7), np.uint64(NAME) if reading == NAME
                     else codes ^ np.uint64(NAME ^ PLAIN), codes)
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    literals = np.concatenate(([0], np.cumsum(codes > 7)))
    enough = literals[width:] - literals[:n] >= min_literals
    ok = (owner[:n] == owner[width - 1:]) & (~enough if reading == EXACT else enough)
    if reading == EXACT:
        codes = shown & ~np.uint64(7)
    if whole:
        ok &= np.bincount(owner, minlength=owner.max() + 1)[owner[:n]] == width
    h = np.zeros(n, np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(width):
            factor = factor * np.uint64(_BASE) + np.uint64(2 * (16 * j + reading) + width)
            mixed = codes[j:j + n] * factor
            h += mixed ^ (mixed >> np.uint64(29))
        h ^= h >> np.uint64(32)
    at = np.flatnonzero(ok)
    return at, h[at]


def _slots(words: list[bytes], codes: np.ndarray, reading: int) -> list[str]:
    """The words behind a window's placeholders, with their type in front."""
    if reading == EXACT:
        return []
    return [f"{int(c) & 7}{w.decode().strip(_STRIP).lower()}" for w, c in zip(words, codes)
            if c < 8 or (reading == NAME and int(c) & 7 == NAME)]


_FOUND = ("id long, hash long, width int, reading int, slots array<string>, place int, source long, "
          "first boolean")


def _emit(batches: Iterator[pa.RecordBatch], kinds: list[tuple[int, int, bool]], min_literals: int,
          cells: bytes | None) -> Iterator[pa.RecordBatch]:
    """Windows (id, hash, width, reading, slots, place, source, first): every
    place of a hash in a text; ``source`` tells texts of one id apart.
    ``kinds``: the (width, reading, whole) looked for; ``cells``: the bitmap that a hash must hit."""
    marked = np.unpackbits(np.frombuffer(cells, np.uint8), bitorder="little") if cells is not None else None
    for b in tidy(batches):
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            ids, texts = part.column(0), part.column(1).cast(pa.binary()).to_pylist()
            words, real, owner, codes = _read(texts)
            starts, sources, rows = np.searchsorted(owner, np.arange(len(texts))), {}, []
            shown = _exact(words, real, codes) if any(r == EXACT for _, r, _ in kinds) else None
            for width, reading, whole in kinds:
                at, h = _windows(codes, owner, reading, width, min_literals, whole, shown)
                if marked is not None:
                    hit = marked[(h & np.uint64(CELLS - 1)).astype(np.int64)] > 0
                    at, h = at[hit], h[hit]
                seen = set()
                for k, x in zip(at.tolist(), h.astype(np.int64).tolist()):
                    o = int(owner[k])
                    if o not in sources:
                        sources[o] = xxhash.xxh64_intdigest(texts[o]) >> 1
                    rows.append((o, x, width, reading, _slots(
                        [words[j] for j in real[k:k + width]], codes[k:k + width], reading),
                        k - int(starts[o]), sources[o], (o, x) not in seen))
                    seen.add((o, x))
            at, h, width, reading, slots, place, source, first = zip(*rows) if rows else ([],) * 8
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(h, pa.int64()), pa.array(width, pa.int32()),
                 pa.array(reading, pa.int32()), pa.array(slots, pa.list_(pa.string())),
                 pa.array(place, pa.int32()), pa.array(source, pa.int64()), pa.array(first, pa.bool_())],
                names=["id", "hash", "width", "reading", "slots", "place", "source", "first"])


def _longest(places: Column, width: Column) -> Column:
    """The most words in a row that windows at the sorted ``places`` cover."""
    state = "struct<best:int,start:int,last:int>"

    def add(s: Column, p: Column) -> Column:
        start = F.when(p - s["last"] <= width, s["start"]).otherwise(p)
        return F.struct(F.greatest(s["best"], p + width - start).alias("best"), start.alias("start"),
                        p.alias("last")).cast(state)

    first = F.struct(F.lit(0).alias("best"), F.get(places, F.lit(0)).alias("start"),
                     F.get(places, F.lit(0)).alias("last")).cast(state)
    return F.aggregate(places, first, add, lambda s: s["best"])


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_literals: int = 5,
            coverage: float = 0.5, consistency: float = 0.8, run: int = 13) -> DataFrame:
    """(doc_id, item_id, n_windows, coverage, consistency) of the contaminated pairs."""
    sizes = [(w, r, w < width) for w in (width, *range(min_literals, width)) for r in READINGS]
    items = benchmark.select("item_id", "text").mapInArrow(
        lambda it: _emit(it, sizes, min_literals, None), _FOUND)
    items = items.dropDuplicates(["id", "hash", "width", "reading", "place", "source"])
    templated = items.filter(F.col("reading") != EXACT).select(F.col("id").alias("_t")).distinct()
    bare = items.filter(F.col("reading") == EXACT).join(templated, F.col("id").eqNullSafe(F.col("_t")), "left_anti")
    items = items.filter(F.col("reading") != EXACT).unionByName(bare)
    seen = items.select((F.col("hash").bitwiseAND(F.lit(CELLS - 1))).alias("cell"), F.struct("width", "reading").alias("kind"))
    # at most `width` widths and three readings
    cells, parts = bitmap(seen, CELLS, F.collect_set("kind").alias("kinds"))
    kinds = [(w, r, False) for w, r in sorted({(k["width"], k["reading"]) for p in parts for k in p["kinds"]})]
    found = docs.select("doc_id", "text").mapInArrow(
        lambda it: _emit(it, kinds, min_literals, cells), _FOUND)
    n_item = items.groupBy("id", "reading").agg(F.countDistinct("hash").alias("n_item"))
    b = items.join(n_item, ["id", "reading"]).select(
        F.col("id").alias("item_id"), F.col("hash").alias("_h"), F.col("width").alias("_w"),
        F.col("reading").alias("_r"), F.col("slots").alias("_s"), F.col("place").alias("_p"),
        F.col("first").alias("_f"), "n_item")
    hit = found.join(b, (F.col("hash") == F.col("_h")) & (F.col("width") == F.col("_w"))
                     & (F.col("reading") == F.col("_r")))
    # alignments, and (null) the first places of each window
    lines = F.array(F.struct(F.col("source"), (F.col("place") - F.col("_p")).alias("line")))
    none = F.array(F.struct(F.lit(None).cast("long").alias("source"), F.lit(None).cast("int").alias("line")))
    pairs = hit.select(F.col("id").alias("doc_id"), "item_id", "reading", "hash", "n_item", "_p", "_w", "_s", "slots", F.explode(
        F.when(F.col("first") & F.col("_f"), F.concat(lines, none)).otherwise(lines)).alias("at")).select(
        "doc_id", "item_id", "reading", "hash", "n_item", "_p", "_w", "at",
        F.explode_outer(F.arrays_zip("_s", "slots")).alias("slot"))
    measured = pairs.groupBy("doc_id", "item_id", "reading", "n_item", "at").agg(
        F.array_sort(F.collect_set("_p")).alias("_places"), F.max("_w").alias("_w"),
        F.countDistinct("hash").alias("n_windows"), F.countDistinct("slot").alias("_pairs"),
        F.countDistinct("slot._s").alias("_theirs"), F.countDistinct("slot.slots").alias("_ours"))
    passed = measured.select(
        "doc_id", "item_id", "n_windows", (F.col("n_windows") / F.col("n_item")).alias("coverage"),
        F.when(F.col("_pairs") == 0, 1.0).otherwise(
            F.least("_theirs", "_ours") / F.col("_pairs")).alias("consistency"),
        F.when(F.col("at.line").isNotNull(), _longest(F.col("_places"), F.col("_w"))).otherwise(0).alias("_run")
    ).filter(((F.col("coverage") >= coverage) | (F.col("_run") >= run)) & (F.col("consistency") >= consistency))
    best = passed.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("coverage", "consistency", "n_windows")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.coverage", "b.consistency")


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` with ``contaminated``, ``n_items``, ``item_id`` (the item covered
    most, the smallest of equals) and its ``coverage``."""
    reserve(docs, "contaminated", "n_items", "item_id", "coverage", "_id", "_b")
    best = matches(docs, benchmark, **how).groupBy(F.col("doc_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.max(F.struct("coverage", (-F.col("item_id")).alias("neg"))).alias("_b"))
    out = docs.join(best, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return out.select(*[F.col(c) for c in docs.columns],
                      F.col("n_items").isNotNull().alias("contaminated"),
                      F.coalesce("n_items", F.lit(0)).alias("n_items"),
                      (-F.col("_b.neg")).alias("item_id"), F.col("_b.coverage").alias("coverage"))
