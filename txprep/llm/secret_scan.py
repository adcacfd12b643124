"""Secret scans with DataFrame functions only.

Base kinds are regular expressions (``assign``, ``access``, ``hex``); their
matches are leftmost and non-overlapping per kind, and a match that fails its
length test is dropped after it has consumed its text.

The method adds ``entropy_hex`` and ``entropy_b64`` spans. A candidate is a
maximal run of at least ``WINDOW`` characters of the class. A window of
``WINDOW`` characters slides over it; one count per character is kept, the
entering and the leaving character change one count each, and with them the sum
of ``f(c) = c log2 c``. The window's Shannon entropy is
``log2(WINDOW) - sum / WINDOW``; ``f`` is held in integer millionths of a bit, so
the running sum is exact whatever the run's length. Windows that reach the
class's threshold are joined where they overlap or touch. Candidates that match
the allow-list of shapes are suppressed, and so are joined windows that hold a
placeholder word; a placeholder elsewhere in the candidate excuses nothing.
Allow-lists never touch base spans. A run of hex digits ends at any other
character, so that ``KEY=``, ``sig_``, ``path/`` or ``0x`` may stand before it.

Positions come from pairing the matches with the text between them (both in
order) and a running sum of lengths in code points. All of it is a projection:
no shuffle, no Python; a text's work is linear in its length.

Defined results: a null text is empty; an empty text has no spans and the hash
of the empty string; null ids, repeated rows and extra columns pass unchanged;
an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, text_or_empty

#: The base kinds in order, with the group whose length counts.
BASE_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
WINDOW = 24
#: (kind, candidate, alphabet, bits). The most that 24 characters can have is
#: log2(24) = 4.58 bits; random hex has about 3.6, random base64 about 4.2.
ENTROPY_KINDS = (
    ("entropy_hex", r"(?<![0-9a-fA-F])[0-9a-fA-F]{24,}+", "0123456789abcdef", 3.0),
    ("entropy_b64", r"(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]{24,}+",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
#: Spans that are no secrets: with placeholders or alphabets in order.
ALLOW_WORDS = r"(?i)example|placeholder|changeme|dummy|your[_-]|lorem|0123456789|abcdefghij"
#: Candidates that are no secrets: UUIDs, one repeated character, and runs without
#: a digit or without a letter (words and rules; for hex, numbers).
ALLOW_SHAPES = (r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|(.)\1{7}|^[^0-9]+$|^[^A-Za-z]+$")
ALLOW = ALLOW_WORDS + "|" + ALLOW_SHAPES.removeprefix("(?i)")

SCALE = 1_000_000
_BLOCK = 256


def _f_table(n: int) -> Column:
    """f(0..n) in millionths of a bit."""
    return F.array(*[F.lit(0 if c == 0 else round(c * math.log2(c) * SCALE)).cast("long") for c in range(n + 1)])


def running_sums(values: Column) -> Column:
    """Sums of all values before each one, as an array one longer than
    ``values``. Blocks keep the appends short, so a long array stays cheap."""
    def scan(xs: Column, start: Column) -> Column:
        init = F.array(start)
        return F.aggregate(xs, init, lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    def over(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
        return bind(scan(sums, F.lit(0).cast("long")), lambda totals: F.flatten(F.transform(
            blocks, lambda b, i: F.slice(scan(b, F.element_at(totals, i + 1)), 2, _BLOCK))))

    def cut(xs: Column) -> Column:
        n_blocks = F.greatest(F.ceil(F.size(xs) / _BLOCK).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(xs, b * _BLOCK + 1, _BLOCK))

    return F.concat(F.array(F.lit(0).cast("long")), bind(bind(values, cut), over))


def matches(text: Column, pattern: str, group: int) -> Column:
    """Leftmost non-overlapping matches as an array of
    ``(start, end, match, part)``: code points, end exclusive; ``part`` is the
    group that is tested. Null for a text without a match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    part = F.regexp_extract_all(text, F.lit(pattern), group) if group else whole
    # as many gaps as matches: the rest of the text is of no use
    zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("g"), whole.alias("m"),
                          part.alias("p"))

    def placed(z: Column) -> Column:
        steps = F.flatten(F.transform(z, lambda e: F.array(F.length(e["g"]).cast("long"), F.length(e["m"]).cast("long"))))
        return bind(running_sums(steps), lambda sums: F.transform(z, lambda e, i: F.struct(
            F.element_at(sums, 2 * i + 2).alias("start"), F.element_at(sums, 2 * i + 3).alias("end"),
            e["m"].alias("match"), e["p"].alias("part"))))

    return bind(zipped, placed)


def _at_least(least: int):
    return lambda m: F.length(m["part"]) >= least


def base_spans(text: Column) -> list[tuple[str, Column]]:
    """(kind, array of (start, end)) for each base kind."""
    out = []
    for kind, pattern, group, least in BASE_KINDS:
        found = F.when(text.rlike(pattern), matches(text, pattern, group))
        kept = F.filter(found, _at_least(least))
        spans = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
        out.append((kind, F.coalesce(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"))))
    return out


def entropy_runs(candidate: Column, alphabet: str, bits: float, window: int = WINDOW) -> Column:
    """Joined windows of ``candidate`` whose entropy reaches ``bits``, as an
    array of (start, end) in it."""
    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(alphabet), ch))
    return bind(codes, lambda bound: _slide_window(bound, len(alphabet), bits, window))


def _slide_window(codes: Column, symbols: int, bits: float, window: int) -> Column:
    spans = "array<struct<start:bigint,end:bigint>>"
    f = _f_table(window)
    # entropy >= bits  <=>  sum of f <= window * (log2(window) - bits)
    most = math.floor(window * (math.log2(window) - bits) * SCALE)

    def step(acc: Column, i: Column) -> Column:
        enters = F.element_at(codes, i)
        leaves = F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(0))
        same = enters == leaves
        c_in = F.element_at(acc["counts"], enters)
        c_out = F.element_at(acc["counts"], F.greatest(leaves, F.lit(1)))
        gain = F.element_at(f, c_in + 2) - F.element_at(f, c_in + 1)
        loss = F.when(leaves > 0, F.element_at(f, c_out + 1) - F.element_at(f, F.greatest(c_out, F.lit(1)))) \
            .otherwise(F.lit(0).cast("long"))
        total = acc["total"] + F.when(same, F.lit(0).cast("long")).otherwise(gain - loss)
        counts = F.when(same, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, k: c + F.when(
            k + 1 == enters, 1).when(k + 1 == leaves, -1).otherwise(0)))
        start, end = (i - window).cast("long"), i.cast("long")
        hit = (i >= window) & (total <= most)
        joins = hit & (acc["open"]["end"] >= start)
        opened = F.struct(F.when(joins, acc["open"]["start"]).otherwise(start).alias("start"), end.alias("end"))
        closes = hit & ~joins & (acc["open"]["end"] >= 0)
        return F.struct(counts.alias("counts"), total.alias("total"),
                        F.when(hit, opened).otherwise(acc["open"]).alias("open"),
                        F.when(closes, F.array_append(acc["runs"], acc["open"])).otherwise(acc["runs"]).alias("runs"))

    nothing = F.struct(F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))
    first = F.struct(F.array_repeat(F.lit(0), symbols).alias("counts"), F.lit(0).cast("long").alias("total"),
                     nothing.alias("open"), F.array().cast(spans).alias("runs"))
    return F.aggregate(F.sequence(F.lit(1), F.size(codes)), first, step, lambda acc: F.when(
        acc["open"]["end"] >= 0, F.array_append(acc["runs"], acc["open"])).otherwise(acc["runs"]))


def entropy_spans(text: Column, allow: str = ALLOW_SHAPES, allow_words: str = ALLOW_WORDS) -> list[tuple[str, Column]]:
    """(kind, array of (start, end)) for each character class. ``allow`` is
    searched in the candidate, ``allow_words`` in each flagged span of it."""
    out = []
    for kind, pattern, alphabet, bits in ENTROPY_KINDS:
        found = F.filter(F.when(text.rlike(pattern), matches(text, pattern, 0)), lambda m: ~m["match"].rlike(allow))
        folded = (lambda c: F.lower(c)) if kind == "entropy_hex" else (lambda c: c)
        runs = F.flatten(F.transform(found, lambda m: F.transform(
            F.filter(entropy_runs(folded(m["match"]), alphabet, bits), lambda r: ~F.substr(
                m["match"], (r["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int")).rlike(allow_words)),
            lambda r: F.struct((m["start"] + r["start"]).alias("start"), (m["start"] + r["end"]).alias("end")))))
        out.append((kind, F.coalesce(runs, F.array().cast("array<struct<start:bigint,end:bigint>>"))))
    return out


def _joined(spans: list[tuple[str, Column]]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    def tag(order: int, kind: str):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
                                  s["end"].alias("end"))

    tagged = [F.transform(c, tag(order, kind)) for order, (kind, c) in enumerate(spans)]
    ordered = F.array_sort(F.concat(*tagged))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, text_col: str = "text", allow: str = ALLOW_SHAPES,
                 allow_words: str = ALLOW_WORDS) -> DataFrame:
    """``docs`` with ``secret_spans`` (all spans as a string), ``base_spans``
    (the base ones) and a count ``n_<kind>`` per kind."""
    text = text_or_empty(text_col)
    base, extra = base_spans(text), entropy_spans(text, allow, allow_words)
    names = [k for k, _ in base + extra]
    # the arrays first, in one projection, so that counts and strings share them
    found = docs.select("*", *[c.alias(f"_spans_{k}") for k, c in base + extra])
    named = [(k, F.col(f"_spans_{k}")) for k in names]
    return found.select(*[F.col(f"`{c}`") for c in docs.columns],
                        *[F.size(c).cast("long").alias(f"n_{k}") for k, c in named],
                        _joined(named[:len(base)]).alias("base_spans"), _joined(named).alias("secret_spans"))
