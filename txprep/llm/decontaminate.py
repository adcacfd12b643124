"""Benchmark decontamination by templates, DataFrame functions only.

Numbers, names and units become typed placeholders, the rest is lower-cased and
split at whatever is neither letter nor digit. Windows of ``WINDOW`` template words of every benchmark
item are hash-joined with those of the documents; a document that holds at least
``least`` of an item's windows is a candidate. For candidates the slots are
checked: along an alignment, each value of the item must stand for one value of
the document, as in a question asked again with other numbers or names. Every
alignment that holds at least ``least`` of the item's windows is tried, and the
ones that most windows agree on; a pair that fails along all of them is no leak.

Few windows are joined: a document that lacks at most a share ``1 - least`` of an
item's windows holds one of any larger share of them, so the rarest ones of each
item are enough to find it, and a window that very many items share is used by
items that have no other. Items with one template are looked up as one. All
later steps are linear in the matched windows: a candidate's text is kept once,
however many items it holds.

The benchmark's windows, and later the candidates' keys, are broadcast only
up to ``BROADCAST_WINDOWS`` rows (counted first); beyond it a shuffle joins them.

Defined results: null texts are empty; a text without words has no windows and
leaks nothing, as item or as document; an item of fewer than ``WINDOW`` words is
one window of all of them, found anywhere in a document; an item's capitalised
first word may be a name or not, as a document marks it inside a sentence only;
repeated items and documents give one row per (``doc_id``, ``item_id``), the best
one; rows that share a ``doc_id`` but not the text are compared each on its own;
null ids are kept; very long texts are compared whole; an empty table on either
side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, bind, text_or_empty, words, written

WINDOW = 5
LEAST = 0.8
#: At 8 bytes a hash and two short keys, far below any broadcast limit.
BROADCAST_WINDOWS = 500_000

#: Units that follow a number.
UNITS = ("km", "cm", "mm", "m", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "s", "sec", "seconds", "min", "minutes", "h",
         "hours", "days", "weeks", "months", "years", "percent", "dollars", "euros", "usd", "eur", "miles", "feet", "inches",
         "meters", "metres", "kilometers", "kilometres", "grams", "kilograms", "liters", "litres", "degrees", "mph")

#: Placeholders of a template: private code points, which texts lose.
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
_UNIT_WORD = "(?i:" + "|".join(UNITS) + r")(?![\p{L}\p{N}])"


def _plain(text: Column) -> Column:
    """``text`` without code points of placeholders."""
    held = text.contains(NAME) | text.contains(NUMBER) | text.contains(UNIT)
    return F.when(held, F.translate(text, NAME + NUMBER + UNIT, "|||")).otherwise(text)


def template(text: Column) -> Column:
    """The template words of a text: lower-cased words, with placeholders for
    names (capitalised words inside a sentence), numbers and units."""
    t = F.regexp_replace(_plain(text), r" (?<=[\p{Ll},;] )\p{Lu}\p{Ll}+", " " + NAME)
    t = F.regexp_replace(t, "[0-9]+", NUMBER)
    t = F.regexp_replace(t, f"({NUMBER} ?){_UNIT_WORD}", f"$1{UNIT}")
    return F.filter(F.split(F.lower(t), rf"[^\p{{L}}\p{{N}}{NAME}-{UNIT}]+"), lambda w: w != "")


def marked(text: Column) -> Column:
    """The words of ``template`` with the slots' values: ``<name=..>``,
    ``<num=..>`` and ``<unit=..>`` for the placeholders."""
    t = F.translate(_plain(text), "<>=", "|||")
    t = F.regexp_replace(t, r" (?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)", " <name=$1>")
    t = F.regexp_replace(t, "([0-9]+)", "<num=$1>")
    t = F.regexp_replace(t, rf"(?<=[0-9]> ?)({_UNIT_WORD})", "<unit=$1>")
    return words(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}<>=]+", " "))


def window_hashes(tokens: Column, window: int = WINDOW) -> Column:
    """A hash per window, in order."""
    def hashed(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(h) - (window - 1))
        return F.when(F.size(h) >= window, F.transform(at, lambda i: F.xxhash64(
            *[F.element_at(h, i + j) for j in range(window)]))) \
            .when(F.size(h) > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))) \
            .otherwise(F.array().cast("array<bigint>"))

    return bind(F.transform(tokens, lambda w: F.xxhash64(w)), hashed)


def short_hashes(tokens: Column, n: int) -> Column:
    """A hash per window of ``n`` words, as ``window_hashes`` gives a text of ``n``."""
    return bind(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= n, F.transform(
        F.sequence(F.lit(1), F.size(h) - (n - 1)), lambda i: F.xxhash64(F.concat_ws(
            " ", *[F.element_at(h, i + j).cast("string") for j in range(n)]))))
        .otherwise(F.array().cast("array<bigint>")))


def doc_hashes(tokens: Column, window: int, short: list[int]) -> dict[int, Column]:
    """The windows of a document for items of ``window`` words or more, and for
    those of each length in ``short``."""
    return {window: window_hashes(tokens, window)} | {n: short_hashes(tokens, n) for n in short}


def _items(bench: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``item_id, item_hash, item_words`` (marked), ``windows``, ``n_words`` (at
    most ``window``) and ``tid`` per distinct item; ``named`` is the first word as
    it is marked inside a sentence, ``named_window`` the first window with it.
    Items with one ``tid`` have the same windows."""
    text = text_or_empty(text_col)
    items = bench.select(F.col(item_col).alias("item_id"), F.xxhash64(text).alias("item_hash"), text.alias("t"))
    items = items.dropDuplicates(["item_id", "item_hash"])
    inside = F.concat(F.lit("a "), F.regexp_replace("t", f"^{SPACE}", ""))
    named = F.slice(marked(inside), 2, window)
    items = items.select(
        "item_id", "item_hash", marked(F.col("t")).alias("item_words"),
        window_hashes(template(F.col("t")), window).alias("windows"), F.get(named, F.lit(0)).alias("named"),
        F.get(window_hashes(F.slice(template(inside), 2, window), window), F.lit(0)).alias("named_window")) \
        .withColumn("n_words", F.least(F.size("item_words"), F.lit(window))).filter("n_words > 0")
    return items.withColumn("tid", F.struct(F.xxhash64("windows", "named_window").alias("a"),
                                            F.xxhash64("named_window", F.lit(1), "windows").alias("b")))


def _rarest(each: DataFrame, least: float) -> DataFrame:
    """``tid, w`` for so many windows of each template that a leak holds one of
    them: those that the fewest templates have."""
    common = each.groupBy("w").agg(F.count_distinct("tid").alias("held"))
    # a window and its other form are one
    ranked = each.join(common, "w").groupBy("tid", "n_windows", "as").agg(F.max("held").alias("held"), F.collect_set("w").alias("ws"))
    place = F.row_number().over(Window.partitionBy("tid").orderBy("held", "as"))
    enough = F.col("n_windows") - F.ceil(F.col("n_windows") * least - 1e-9) + 1
    return ranked.withColumn("place", place).filter(F.col("place") <= enough).select("tid", F.explode("ws").alias("w")).distinct()


def contaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame, window: int = WINDOW, least: float = LEAST,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_windows, n_found, containment, n_slots`` for every
    document and item that leaks into it."""
    checked = leaks(spark, docs, bench, window, least, id_col, text_col, item_col, item_text_col)
    best = F.max(F.struct(F.col("containment"), F.col("n_windows"), F.col("n_found"), F.col("n_slots")))
    return checked.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.n_windows", "b.n_found", "b.containment", "b.n_slots")


def leaks(spark: SparkSession, docs: DataFrame, bench: DataFrame, window: int = WINDOW, least: float = LEAST,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """As ``contaminated``, a row per text and item, with ``doc_hash``, that of
    the text."""
    items = written(spark, _items(bench, item_col, item_text_col, window), "leak-items")
    templates = items.dropDuplicates(["tid"]).select(
        "tid", "n_words", F.size(F.array_distinct("windows")).alias("n_windows"), "windows", "named_window")
    # the first window in both its forms counts as one
    both = F.array_distinct(F.concat(
        F.transform("windows", lambda x, i: F.struct(i.alias("i"), x.alias("w"), x.alias("as"))),
        F.transform(F.slice("windows", 1, 1), lambda x: F.struct(F.lit(0).alias("i"), F.col("named_window").alias("w"), x.alias("as")))))
    each = written(spark, templates.select("tid", "n_words", "n_windows", F.explode(both).alias("x"))
                   .select("tid", "n_words", "n_windows", "x.*"), "leak-windows")
    short = sorted(r[0] for r in templates.filter(F.col("n_words") < window).select("n_words").distinct().collect())  # below window
    rare = _rarest(each, least)
    if each.count() <= BROADCAST_WINDOWS:
        rare = F.broadcast(rare)
    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("doc_hash"), text.alias("text"))
    key = F.struct(F.xxhash64("doc_id").alias("a"), F.col("doc_hash").alias("b")).alias("did")
    held = keyed.select(key, bind(template(F.col("text")), lambda t: F.array_distinct(F.concat(
        *doc_hashes(t, window, short).values()))).alias("w")).select("did", F.explode("w").alias("w"))
    # used several times below, and it takes the pass over all texts
    found = written(spark, held.join(rare, "w").select("did", "tid").distinct(), "leak-candidates")

    wanted = found.select("did").distinct()
    if found.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    texts = keyed.withColumn("did", key).join(wanted, "did", "left_semi").dropDuplicates(["did"])
    texts = written(spark, texts.select("did", "doc_id", "doc_hash", marked(F.col("text")).alias("doc_words"), bind(
        template(F.col("text")), lambda t: F.concat(*[F.transform(h, lambda w, at: F.struct(
            F.lit(n).alias("n_words"), at.alias("at"), w.alias("w"))) for n, h in doc_hashes(t, window, short).items()]))
        .alias("places")), "leak-texts")
    return _check_slots(found, texts, items, each, least)


def _check_slots(found: DataFrame, texts: DataFrame, items: DataFrame, each: DataFrame, least: float) -> DataFrame:
    """The candidates with enough windows whose slots are consistent along one
    of their offsets."""
    pair = ["did", "tid"]
    places = texts.select("did", F.explode("places").alias("p")).select("did", "p.*")
    hits = found.join(each, "tid").join(places, ["did", "n_words", "w"]) \
        .select(*pair, "n_windows", "as", (F.col("at") - F.col("i")).alias("offset"), "i").distinct()
    enough = hits.groupBy(*pair, "n_windows").agg(F.count_distinct("as").alias("n_found")) \
        .filter(F.col("n_found") >= F.col("n_windows") * least - 1e-9)
    # the offsets that enough windows share; each takes a share of them, so trying all stays linear
    offsets = hits.groupBy(*pair, "offset").agg(F.count_distinct("i").alias("n"))
    most = offsets.groupBy(*pair).agg(F.max("n").alias("most"))
    lengths = items.dropDuplicates(["tid"]).select("tid", F.size("item_words").alias("len"), F.size("windows").alias("of"))
    tried = offsets.join(most, pair).join(enough, pair).join(lengths, "tid") \
        .filter(F.col("n") >= F.least(F.col("most"), F.col("of") * least)).select(
            "did", F.struct("tid", "offset", "n", "len", "n_windows", "n_found").alias("r"))
    # the words along each offset, cut from the one row of the document
    asked = tried.groupBy("did").agg(F.collect_list("r").alias("asked"))
    start = F.greatest(F.col("r.offset"), F.lit(0))
    cut = texts.join(asked, "did").select("doc_id", "doc_hash", "did", "doc_words", F.explode("asked").alias("r")).select(
        "doc_id", "doc_hash", "did", "r.*", (start - F.col("r.offset")).alias("skipped"),
        F.slice("doc_words", start + 1, F.greatest(F.lit(0), F.col("r.len") - start + F.col("r.offset"))).alias("doc_words"))
    along = cut.join(items.select("tid", "item_id", "item_hash", "item_words", "named"), "tid")

    def kind(w: Column) -> Column:
        return F.regexp_replace(w, "=[^>]*>", ">")

    def slots() -> Column:
        def compared(w: Column, i: Column) -> Column:
            at = i - F.col("skipped")
            other = F.when(at >= 0, F.get("doc_words", at))
            form = F.when((i == 0) & (kind(other) == kind(F.col("named"))), F.col("named")).otherwise(w)
            return F.struct(form.alias("a"), other.alias("b"))

        return F.filter(F.transform("item_words", compared), lambda s: s["a"].contains("=") & (kind(s["a"]) == kind(s["b"])))

    checked = along.withColumn("slots", slots())
    consistent = F.size(F.array_distinct(F.transform("slots", lambda x: x["a"]))) == F.size(F.array_distinct("slots"))
    best = F.max(F.struct(F.col("n"), (-F.col("offset")).alias("o"), F.size("slots").alias("n_slots")))
    return checked.filter(consistent).groupBy("doc_id", "doc_hash", "item_id", "item_hash", "n_windows", "n_found") \
        .agg(best.alias("b")).select(
            "doc_id", "doc_hash", "item_id", "n_windows", "n_found",
            (F.col("n_found") / F.col("n_windows")).alias("containment"), "b.n_slots")
