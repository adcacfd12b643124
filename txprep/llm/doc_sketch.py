"""Document fingerprints: threshold-scaled sketches, DataFrame functions only.

A sketch keeps every distinct hash of the text's word shingles that lies below a
fixed fraction (1 / ``scale``) of the hash range, and the smallest hash whatever
its size. The threshold doesn't depend on the text, so a sketch of a union is
the union of the sketches (of the smallest hashes, the smaller one): sketches
merge, and documents of very unequal lengths are compared hash by hash.

``likeness`` is the containment of the smaller sketch in the larger one,
``|A n B| / min(|A|, |B|)`` over the hashes below the threshold; if either has
none there, 1 if the smallest hashes agree and else 0.

Defined results: a null text is empty; a text without words has the empty sketch;
two empty sketches are alike (1), an empty and another are not (0); fewer than
``shingle`` words are one shingle; equal texts have equal sketches. For the next
document, ties of the id go by the text's hash, repeated rows follow each other, a
null id comes first and the only document is its own next one; a very long text
is sketched whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, bind, text_or_empty, words

SHINGLE = 5
SCALE = 8
LOW = -(1 << 63)


def threshold(scale: int) -> int:
    """Hashes (signed) below it are kept: the lowest 1 / scale of the range."""
    return LOW + (1 << 64) // scale


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Ascending distinct kept hashes of a text, as an array of longs."""
    hashed = F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))

    def all_hashes(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(h) - (shingle - 1))
        return F.when(F.size(h) >= shingle, F.transform(at, lambda i: F.xxhash64(
            *[F.element_at(h, i + j) for j in range(shingle)]))) \
            .when(F.size(h) > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))) \
            .otherwise(F.array().cast("array<bigint>"))

    def kept(hashes: Column) -> Column:
        return bind(F.array_min(hashes), lambda low: F.sort_array(F.array_distinct(
            F.filter(hashes, lambda x: (x < threshold(scale)) | (x == low)))))

    return bind(bind(hashed, all_hashes), kept)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together."""
    return bind(F.sort_array(F.array_union(a, b)), lambda both: bind(F.element_at(both, 1), lambda low: F.filter(
        both, lambda x: (x < threshold(scale)) | (x == low))))


def likeness(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Containment of the smaller sketch in the larger one, 0 to 1."""
    def below(s: Column) -> Column:
        return F.size(F.filter(s, lambda x: x < threshold(scale)))

    na, nb = below(a), below(b)
    shared = below(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")) \
        .when((na > 0) & (nb > 0), shared / F.least(na, nb).cast("double")) \
        .otherwise((F.element_at(a, 1) == F.element_at(b, 1)).cast("double"))


def as_string(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash, comma-joined."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ",")


def with_next(docs: DataFrame, id_col: str, tie: str, take: str, derive: dict, rows_per_range: int = 1_000,
              max_ranges: int = 50_000) -> DataFrame:
    """``docs`` with the columns of ``derive`` (name: function of ``take``) and
    with ``next_<c>`` for ``take`` and the derived columns: those of the row that
    follows in ascending ``id_col``, then ``tie``; after the last, the first.

    Rows go to ranges of ids (bounds from a quantile sketch of the ids), so one
    shuffle brings neighbours together. An id that fills several ranges, or rows
    without one, are cut further by ``tie``, a uniform hash. What follows a range's
    last row is the first row of the next range: some ``max_ranges`` rows of ids,
    broadcast and looked up. Only rows alike in id and text stay together, and
    Spark sorts and spills them.
    """
    n, ids = docs.agg(F.count("*"), F.count(id_col)).first()
    n_ranges = min(max_ranges, max(1, n // rows_per_range))
    quantiles = [i / n_ranges for i in range(1, n_ranges)]
    found = (docs.agg(F.percentile_approx(id_col, quantiles, 10 * n_ranges)).first()[0] or []) if quantiles else []
    # an id that is several quantiles has ranges of its own
    heavy = {b: c for b, c in Counter(found).items() if c > 1}
    bounds = sorted({*found, *(b + 1 for b in heavy)})
    cuts = {bounds.index(b) + 1: c + 1 for b, c in heavy.items()} | {-1: max(1, n_ranges * (n - ids) // max(n, 1))}
    docs = docs.withColumn("_range", range_code(F.col(id_col), F.col(tie), bounds, cuts))
    inside = Window.partitionBy("_range").orderBy(F.col(id_col).asc_nulls_first(), tie)
    led = docs.withColumns({c: f(F.col(take)) for c, f in derive.items()})
    led = led.select("*", F.lead(F.lit(True)).over(inside).alias("_has"),
                     *[F.lead(c).over(inside).alias(f"next_{c}") for c in (take, *derive)])
    # nulls before ids, as in the window
    firsts = docs.groupBy("_range").agg(F.min(F.struct(
        F.col(id_col).isNotNull(), F.col(id_col).alias("id"), F.col(tie).alias("tie"))).alias("f"))
    by = Window.orderBy("_range")
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = firsts.select("_range", F.coalesce(F.lead("f").over(by), F.first("f").over(every)).alias("f"))
    heads = docs.select(F.col(id_col).alias("_id"), F.col(tie).alias("_tie"), F.col(take).alias("_take")) \
        .join(F.broadcast(follows), F.col("_id").eqNullSafe(F.col("f.id")) & (F.col("_tie") == F.col("f.tie"))) \
        .groupBy("_range").agg(F.first("_take").alias(f"_n_{take}")) \
        .withColumns({f"_n_{c}": f(F.col(f"_n_{take}")) for c, f in derive.items()})
    # the rows are dealt by range already: this join moves only the few heads
    joined = led.join(heads, "_range", "left")
    return joined.withColumns({f"next_{c}": F.when(F.col("_has"), F.col(f"next_{c}")).otherwise(F.col(f"_n_{c}"))
                               for c in (take, *derive)}).drop("_range", "_has", *[f"_n_{c}" for c in (take, *derive)])


def range_code(value: Column, tie: Column, bounds: list, cuts: dict[int, int]) -> Column:
    """A number per range, ascending with (value, tie), nulls first; ``cuts``:
    pieces of a range (by ``tie``, any long) where it has more than one."""
    at = F.when(value.isNull(), F.lit(-1)).otherwise(range_of(value, bounds))
    pieces = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x).cast("int") for kv in cuts.items() for x in kv]), at), F.lit(1))
    piece = F.least(pieces - 1, F.floor((tie / float(1 << 64) + 0.5) * pieces))
    return (at.cast("long") + 1) * (1 << 20) + piece


def range_of(value: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` are not above ``value``; two short
    scans instead of a long one. 0 for null."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(b) for b in bounds[::step]])
    fine = F.array(*[F.array(*[F.lit(b) for b in bounds[i:i + step]]) for i in range(0, len(bounds), step)])
    block = F.size(F.filter(coarse, lambda b: b <= value))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(block, F.lit(1))), lambda b: b <= value))
    return F.when(value.isNull() | (block == 0), F.lit(0)).otherwise((block - 1) * step + inside)


def sketch_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its sketch, that of its edited text (the last
    floor(n / 2) code points give way to the first ones of the next document) and
    the likenesses to the edited text and to the next document."""
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    linked = with_next(base, "doc_id", "tie", "text", {"sketch": sketch})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next_text").substr(F.lit(1), half))
    out = linked.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    out = out.withColumn("edited_sketch", sketch(F.col("edited")))
    return out.select("doc_id", "n_chars", "edited", "sketch", "edited_sketch",
                      likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                      likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
