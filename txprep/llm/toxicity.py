"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded first: lower case, compatibility forms, homoglyphs of other
scripts and digits or signs that stand for letters become the letters they
imitate, everything else a space. The lexicon holds the folded words, and stems
that words begin with, that labelled training documents show to be toxic,
weighted by their smoothed log-odds; a word counts once, by its heaviest entry.
Exception phrases are pairs of words, one of them with an entry, that occur in
clean documents; a hit inside one doesn't count. The automaton finds entries and
exceptions in one pass over a text. The score is the logistic function of the
logarithm of the weight over the root of the number of words, fitted on the
training rows.

The fit takes at most ``max_train`` labels, those with the smallest hash of
their id, and one text for each: of rows with the same ``doc_id`` the one with
the smallest hash, found by a partial aggregate, so an id on any number of rows
is one row of the fit. Scoring covers every text whole.

Defined results: a null or empty text has no hits; a null label is no label, and
a label or row without an id takes no part in the fit; repeated labels of a
document count once each; without labels of either kind
the lexicon is empty and every score is the smoothed share of toxic labels;
every row, also one without an id or with another's, is scored by its own text,
a very long one whole; an empty table gives no rows; other columns are carried
along, and one with the name of the score is replaced.
"""

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

#: Look-alikes in other scripts, by the Latin letter they imitate.
HOMOGLYPHS = {
    "a": "аαɑ", "b": "ьβв", "c": "сϲ", "d": "ԁ", "e": "еεё", "f": "ƒ", "g": "ɡ", "h": "һн", "i": "іιı", "j": "јϳ",
    "k": "кκ", "l": "ӏ", "m": "м", "n": "ոη", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ",
    "u": "υս", "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ʐ",
}
#: Digits and signs that stand for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}

_TABLE = {ord(x): a for a, xs in HOMOGLYPHS.items() for x in xs} | {ord(k): v for k, v in DIGITS.items()}
# a sign stands for a letter only inside a word; at its end it is punctuation
_SIGN_END = re.compile(r"[!@$]+(?!\w)")
_OTHER = re.compile(r"[\W_]+")
#: Lengths of the stems that may become entries.
STEMS = range(3, 7)
_ZERO_WIDTH = dict.fromkeys([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD])


def fold(text: str) -> str:
    """Folded words of ``text``, one space before, between and after them.

    An ``l`` written as 1 folds to ``i``; lexicon words are folded too, and the
    letter l itself becomes i, so both spellings meet."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(_ZERO_WIDTH))
    text = _SIGN_END.sub(" ", text.lower()).translate(_TABLE).replace("l", "i")
    return f" {_OTHER.sub(' ', text).strip()} "


@dataclass
class Lexicon:
    """Folded entries with weights (``stem*`` for what a word begins with),
    exception phrases, and the fitted curve."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    intercept: float = 0.0
    slope: float = 0.0

    def automaton(self):
        """Values: (length, weights of the word with and without its end)."""
        import ahocorasick
        a = ahocorasick.Automaton()
        for p in self.exceptions:
            a.add_word(f" {p} ", (len(p), 1, 0.0))
        for w, weight in self.weights.items():
            if w.endswith("*"):
                a.add_word(f" {w[:-1]}", (len(w) - 1, 0, weight))
            else:
                a.add_word(f" {w} ", (len(w), 1, weight))
        if len(a):
            a.make_automaton()
        return a


def hits(automaton, folded: str) -> dict[int, float]:
    """The heaviest entry of each word that has one, by the word's place,
    without words inside an exception phrase."""
    if not len(automaton):
        return {}
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, closed, weight) in automaton.iter(folded):
        start = end + 1 - closed - length          # of the entry, without the spaces around it
        if weight:
            found[start] = max(weight, found.get(start, 0.0))
        else:
            spared.append((start, start + length))
    if spared and found:
        inside = np.zeros(len(folded) + 1, dtype=np.int32)
        for s, e in spared:
            inside[s] += 1
            inside[e] -= 1
        inside = np.cumsum(inside)
        found = {s: w for s, w in found.items() if not inside[s]}
    return found


def weigh(automaton, folded: str) -> float:
    """The weight of a folded text: of its hits together."""
    return sum(hits(automaton, folded).values())


def feature(weight: float, n_words: int) -> float:
    """Weight normalised by length. The root of the words, not the words: a few
    hits in a long text still tell, and a chance hit in it tells less."""
    return math.log1p(10.0 * weight / math.sqrt(max(n_words, 20)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope of a one-feature logistic fit, by Newton steps."""
    beta, design = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    for _ in range(40):
        p = 1.0 / (1.0 + np.exp(-design @ beta))
        grad = design.T @ (y - p) - ridge * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _entries(words: set[str]) -> set[str]:
    return words.union(*[{w[:k] + "*" for w in words if len(w) > k} for k in STEMS])


def _folded_entries():
    return lambda folded: _entries(set(folded.split()))


def _counted(make_terms):
    """Documents with each term, by label, summed within a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of = make_terms()
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                (toxic if label else clean).update(terms_of(fold(text)))
            terms = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()),
                                              "t": pa.array([toxic[x] for x in terms], pa.int64()),
                                              "c": pa.array([clean[x] for x in terms], pa.int64())})
    return run


def _pairs_around(lexicon: Lexicon):
    """Pairs of neighbouring words of which one has an entry."""
    def make():
        automaton = lexicon.automaton()

        def terms(folded: str) -> set[str]:
            marked = hits(automaton, folded)
            out, at, before, hot = set(), 1, None, False
            for w in folded.split() if marked else ():
                now = at in marked
                if before is not None and (hot or now):
                    out.add(f"{before} {w}")
                before, hot, at = w, now, at + len(w) + 1
            return out
        return terms
    return make


def _features(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for batch in batches:
            xs = []
            for text in batch.column("text").to_pylist():
                f = fold(text)
                xs.append(feature(weigh(a, f), f.count(" ") - 1))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(xs, pa.float64())], names=["toxic", "x"])
    return run


def fit_lexicon(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, max_words: int = 4_000,
                min_docs: int = 3, min_log_odds: float = 4.0, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "toxic") -> Lexicon:
    """Learn lexicon, exceptions and curve from ``labels`` (already without
    held-out rows). What reaches the driver is bounded by ``max_train`` (one
    number a row) and ``max_words``."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"),
                                                              F.col(label_col).cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(max_train)
    text = text_or_empty(text_col)
    one = docs.select(F.col(id_col).alias("_id"), F.struct(F.xxhash64(text), text.alias("text")).alias("t")) \
        .join(F.broadcast(sample.select("_id").distinct()), "_id", "left_semi").groupBy("_id").agg(F.min("t").alias("t"))
    # read three times; at most max_train rows
    train = written(docs.sparkSession, one.join(F.broadcast(sample), "_id").select("t.text", "toxic"), "toxicity-train")
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        share = (n1 + 0.5) / (n0 + n1 + 1.0)
        return Lexicon({}, intercept=math.log(share / (1 - share)))
    def counts(make_terms) -> DataFrame:
        summed = train.mapInArrow(_counted(make_terms), "term string, t long, c long").groupBy("term").agg(
            F.sum("t").alias("t"), F.sum("c").alias("c"))
        odds = F.log((F.col("t") + 0.5) / (n1 - F.col("t") + 0.5)) \
            - F.log((F.col("c") + 0.5) / (n0 - F.col("c") + 0.5))
        error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
        return summed.withColumn("odds", odds).withColumn("least", odds - 2.33 * error)

    top = counts(_folded_entries).filter((F.col("odds") >= min_log_odds) & (F.col("least") >= min_log_odds / 2)) \
        .orderBy(F.desc("least"), "term").limit(max_words).collect()
    lexicon = Lexicon({r["term"]: float(r["odds"]) for r in top})
    if top:
        near = counts(_pairs_around(lexicon)).filter((F.col("c") >= min_docs) & (F.col("odds") <= 0))
        lexicon.exceptions = [r["term"] for r in near.orderBy("odds", "term").limit(max_words).collect()]
    rows = train.mapInArrow(_features(lexicon), "toxic int, x double").collect()
    lexicon.intercept, lexicon.slope = _logistic(np.array([r["x"] for r in rows]),
                                                 np.array([r["toxic"] for r in rows], dtype=float))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: 0 to 1, higher for toxic texts."""

    @F.pandas_udf("double")
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = lexicon.automaton()
        for texts in series:
            zs = []
            for text in texts:
                f = fold(text)
                zs.append(lexicon.intercept + lexicon.slope * feature(weigh(a, f), f.count(" ") - 1))
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(zs, dtype=float), -500, 500))))

    return docs.withColumn(out, score(text_or_empty(text_col)))
