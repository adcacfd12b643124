"""Language model, sketches, decontamination, toxicity, chat and mixing against
brute force on small and awkward tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward_docs, key, no_docs, prose, sha, words
from pyspark.sql import functions as F

from txprep.llm import brown_lm, chat, decontaminate, doc_sketch, mixing, toxicity
from txprep.llm.queries import tokenizer_path


# ------------------------------------------------------------ language model
def held(col="doc_id"):
    return F.crc32(F.col(col).cast("string")) % 7 == 2


def test_lm_counts_base_and_normalisation(spark):
    docs = awkward_docs(spark)
    got = brown_lm.score_documents(spark, docs, held(), classes=6, core=50, chunk_bytes=20_000).collect()
    rows = [(r.doc_id, words(r.text) + [b""]) for r in docs.select("doc_id", "text").collect()]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter()
    for (_, w), h in zip(rows, out):
        if not h:
            c.update(w)
    n, v = sum(c.values()), len(c)
    want = [(i, h, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
            for (i, w), h in zip(rows, out)]
    assert sorted([(*r[:5], round(r.base_score, 6)) for r in got], key=key) == sorted(want, key=key)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert brown_lm.score_documents(spark, no_docs(spark), held()).count() == 0
    alone = brown_lm.score_documents(spark, docs, F.lit(True))          # no training token
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in alone.collect()} == {(0, 0, 0.0, 0.0)}


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 30, size=(7, 7))
    counts[6, 6] = 0
    m = brown_lm.Model.fit(counts, 100)
    assert np.allclose((10 ** m.step)[:, :5].sum(axis=1) + (10 ** m.step)[:, 6], 1)


def test_exchange_finds_the_classes():
    rng, groups, text, g = random.Random(1), ["abcd", "efgh", "ijkl"], [], 0
    for _ in range(6000):
        text.append(rng.choices(groups[g], [8, 4, 2, 1])[0])
        g = (g + 1) % 3 if rng.random() < 0.8 else rng.randrange(3)
    names = sorted(set(text))
    b = np.zeros((14, 14))
    for x, y in zip(text, text[1:]):
        b[names.index(x), names.index(y)] += 1
    cls = brown_lm.exchange(b, 3).tolist()
    assert [len(set(cls[i:i + 4])) for i in (0, 4, 8)] == [1, 1, 1] and len(set(cls)) == 3


def class_likelihood(table):
    f = lambda x: (x * np.log(np.maximum(x, 1.0))).sum()
    return f(table) - f(table.sum(axis=1)) - f(table.sum(axis=0))


def test_words_go_where_the_likelihood_grows_most():
    rng = np.random.default_rng(7)
    k, width = 5, 7
    table = rng.integers(0, 400, size=(width, width))
    table[:, k] = 0
    p = brown_lm.Placement(table)
    slots = np.array([s for s in range(2 * width) if s not in (k, width + k + 1)])
    for _ in range(40):
        # neighbours of another word, none of the context classes on the wrong side
        counts = rng.integers(0, 60, size=len(slots)) * (rng.random(len(slots)) < 0.5)
        at, n = slots[counts > 0], counts[counts > 0]
        gain = p.gains(at, n).sum(axis=0)
        best = p.choose(gain[None, :], np.array([n[at < width].sum()]), np.array([n[at >= width].sum()]))[0]
        after = []
        for c in range(k):
            t = table.astype(float).copy()
            for s, m in zip(at, n):
                if s < width:
                    t[s, c] += m
                else:
                    t[c, s - width] += m
            after.append(class_likelihood(t))
        assert after[best] == pytest.approx(max(after)) or not len(at)


def plain_scores(rows, held, classes, core):
    """The model in plain Python: counts, exchange, placement, tables, scores."""
    texts = [words(t) + [b""] for _, t in rows]
    train = [w for w, h in zip(texts, held) if not h]
    count = Counter(x for w in train for x in w)
    top = sorted(count, key=lambda w: (-count[w], w))[:core]
    k = len(top)
    classes = max(1, min(classes, k))
    number = {w: i for i, w in enumerate(top)}
    big = np.zeros((k + 2, k + 2))
    for w in train:
        before = k + 1
        for x in w:
            big[before, number.get(x, k)] += 1
            before = number.get(x, k)
    of = dict(zip(top, brown_lm.exchange(big, classes).tolist()))
    to = np.eye(classes + 2)[[*of.values(), classes, classes + 1]]
    table = to.T @ big @ to
    place = brown_lm.Placement(table)
    width = classes + 2
    near = defaultdict(Counter)
    for w in train:
        for i, x in enumerate(w):
            if x not in of or x not in number:
                before = of[w[i - 1]] if i and w[i - 1] in number else None if i else classes + 1
                after = of[w[i + 1]] if i + 1 < len(w) and w[i + 1] in number else None
                if before is not None:
                    near[x][before] += 1
                if after is not None:
                    near[x][width + after] += 1
    for x in count:
        if x not in number:
            s, m = np.array(list(near[x].keys()), int), np.array(list(near[x].values()), int)
            gain = place.gains(s, m).sum(axis=0) if len(s) else np.zeros(classes)
            of[x] = int(place.choose(gain[None, :], np.array([m[s < width].sum()]), np.array([m[s >= width].sum()]))[0])
    cells = np.zeros((classes + 2, classes + 2), np.int64)
    for w in train:
        before, once = classes, False
        for i, x in enumerate(w):
            cells[before, of[x]] += 1
            if count[x] == 1:
                cells[before, classes + 1] += 1
            if i and once:
                cells[classes + 1, of[x]] += 1
            before, once = of[x], count[x] == 1
    model = brown_lm.Model.fit(cells, len(count))
    out = []
    for w in texts:
        before, total = classes, 0.0
        for x in w:
            c = of[x] if x in count else classes + 1
            total += model.step[before, c]
            if x in count:
                total += math.log10(count[x]) - math.log10(max(model.size[c], 1.0))
            before = c
        out.append(total)
    return out


@pytest.mark.parametrize("batch", [60, 10_000])
def test_scores_equal_a_plain_model(spark, batch):
    rng = random.Random(17)
    rows = [(i, " ".join(prose(rng, 1, 6) if j % 2 else "y" + prose(rng, 1, 9) for j in range(rng.randrange(0, 60)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)       # words that fill several batches
    try:
        got = {r.doc_id: r.score for r in brown_lm.score_documents(spark, docs, held(), classes=5, core=20, chunk_bytes=150).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for (i, _), score in zip(rows, plain_scores(rows, out, 5, 20)):
        assert got[i] == pytest.approx(score, abs=1e-6)


def test_lm_beats_its_base_on_held_out_text(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(prose(rng, 1, 5) if j % 2 else "x" + prose(rng, 1, 5) for j in range(200))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    r = brown_lm.score_documents(spark, df, held(), classes=8, core=200).filter("held_out") \
        .agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


# ------------------------------------------------------------ sketches
def test_edited_texts_and_sketches(spark):
    docs = awkward_docs(spark)
    got = doc_sketch.sketch_edits(docs).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    hashes = {t: spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).first()[0] for _, t in texts}
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = []
    for k, (i, t) in enumerate(order):
        n, nxt = len(t), order[(k + 1) % len(order)][1]
        want.append((i, n, sha(t[:n - n // 2] + nxt[:n // 2])))
    assert sorted([(r.doc_id, r.n_chars, sha(r.edited)) for r in got], key=key) == sorted(want, key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert doc_sketch.sketch_edits(no_docs(spark)).count() == 0


def brute_sketch(hashed, text, shingle=5):
    """Distinct hashes of the shingles below the threshold, and the smallest."""
    w = [hashed[x] for x in words(text)]
    s = [tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else []
    return s


def test_sketches_and_likeness_equal_brute_force(spark):
    docs = awkward_docs(spark)
    got = doc_sketch.sketch_edits(docs).collect()
    texts = sorted({r.text or "" for r in docs.select("text").collect()} | {r.edited for r in got})
    # hashes of single words and of shingles, one row each, by the same function of Spark
    word = sorted({x.decode() for t in texts for x in words(t)})
    one = {r.w.encode(): r.h for r in spark.createDataFrame([(w,) for w in word], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    shingles = sorted({s for t in texts for s in brute_sketch(one, t)})
    five = {tuple(r.s): r.h for r in spark.createDataFrame([(list(s),) for s in shingles], "s array<long>").select(
        "s", F.xxhash64(*[F.col("s")[i] for i in range(5)]).alias("h")).collect()}
    short = [t for t in texts if 0 < len(words(t)) < 5]
    few = {r.t: r.h for r in spark.createDataFrame([(t, " ".join(str(one[x]) for x in words(t))) for t in short], "t string, j string")
           .select("t", F.xxhash64("j").alias("h")).collect()}
    below = doc_sketch.threshold(doc_sketch.SCALE)

    def expect(t):
        h = {few[t]} if t in few else {five[s] for s in brute_sketch(one, t)}
        return sorted(x for x in h if x < below or x == min(h))

    def alike(a, b):
        if not a or not b:
            return float(not a and not b)
        x, y = {v for v in a if v < below}, {v for v in b if v < below}
        return len(x & y) / min(len(x), len(y)) if x and y else float(a[0] == b[0])

    sketches = {t: expect(t) for t in texts}
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    hashes = {t: spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).first()[0] for _, t in rows}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = []
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        want.append((i, sketches[t], sketches[edited], alike(sketches[t], sketches[edited]), alike(sketches[t], sketches[nxt])))
    have = [(r.doc_id, list(r.sketch), list(r.edited_sketch), r.near_edited, r.near_next) for r in got]
    assert sorted(have, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))) == \
        sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def test_rows_without_an_id_are_cut_by_their_text(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, id, if(id % 3 = 1, null, 700)) as doc_id", "concat('text number ', id) as text") \
        .withColumn("tie", F.xxhash64("text"))
    out = doc_sketch.with_next(docs, "doc_id", "tie", "text", {}, rows_per_range=100)
    rows = sorted(out.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie))
    assert len(rows) == 3000
    assert all(r.next_text == rows[(k + 1) % 3000].text for k, r in enumerate(rows))
    plan_ranges = docs.select(doc_sketch.range_code(F.col("doc_id"), F.col("tie"), [700, 701], {-1: 10, 1: 10}).alias("r"))
    sizes = [r["count"] for r in plan_ranges.groupBy("r").count().collect()]
    assert max(sizes) < 1000


def test_containment_of_very_unequal_texts_and_merging(spark):
    rng = random.Random(2)
    big = [f"w{rng.randrange(10 ** 6)}" for _ in range(20_000)]
    a, b, other = " ".join(big), " ".join(big[5000:6000]), " ".join(f"v{i}" for i in range(1000))
    row = spark.createDataFrame([(a, b, other, "x y", "x  Y", "")], "a string, b string, o string, s string, t string, e string")
    sk = {c: doc_sketch.sketch(F.col(c)) for c in row.columns}
    near = doc_sketch.likeness
    r = row.select(near(sk["a"], sk["b"]), near(sk["b"], sk["o"]), near(sk["s"], sk["t"]), near(sk["e"], sk["e"]),
                   near(sk["e"], sk["s"]), F.size(sk["a"]),
                   doc_sketch.merge(sk["b"], sk["o"]) == F.filter(F.sort_array(F.array_union(sk["b"], sk["o"])),
                                                                 lambda x: x < doc_sketch.threshold(doc_sketch.SCALE))).first()
    assert r[0] > 0.97 and r[1] == 0 and r[2] == 1 and r[3] == 1 and r[4] == 0
    assert abs(r[5] / 19_996 - 1 / doc_sketch.SCALE) < 0.02 and r[6]


# ------------------------------------------------------------ decontamination
ITEMS = [
    (1, "If Alice has 12 apples and gives 5 to Bob then how many apples are left with her after 12 days"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank every single morning"),
    (3, ""), (4, None), (5, "tiny item"), (2, "the quick brown fox jumps over the lazy dog near the river bank every single morning"),
]


def test_leaks_templates_and_slots(spark):
    filler = prose(random.Random(1), 60)
    docs = [
        (10, f"{filler}. {ITEMS[0][1]} {filler}"),                                    # as it stands
        (11, f"{filler} " + ITEMS[0][1].replace("12", "31").replace("5", "8").replace("Bob", "Carl")),   # other slots, consistent
        (12, f"{filler} " + ITEMS[0][1].replace("12 apples", "31 apples")),           # 12 is 31 here and 12 there
        (13, filler), (14, None), (15, ""), (16, f"{filler} THE QUICK brown fox, jumps over the lazy dog near the river bank every single morning!"),
        (17, "the quick brown fox jumps over the moon and far away from here at night"),
        (10, f"{filler}. {ITEMS[0][1]} {filler}"), (None, ITEMS[1][1]), (18, "a tiny item"), (19, "tiny item"),
    ]
    d = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in docs], "doc_id long, text string, at int, w string, n_found int")
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted([(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, d, b).collect()], key=key)
    assert got == sorted([(10, 1), (11, 1), (16, 2), (None, 2), (18, 5), (19, 5)], key=key)
    assert decontaminate.contaminated(spark, no_docs(spark), b).count() == 0
    assert decontaminate.contaminated(spark, d, b.limit(0)).count() == 0
    awkward = decontaminate.contaminated(spark, awkward_docs(spark), b)
    assert awkward.count() == 0


def test_short_items_are_found_inside_documents(spark):
    items = [(1, "What is the capital of France?"), (2, "tiny item"), (3, "  How many 7 km runs"), (4, "Alice saw the red house of Alice again")]
    docs = [(1, "they asked him What is the capital of France? and he knew it"), (2, "what is the capital of France"),
            (3, "here we quote a tiny item. and go on"), (4, "tiny items only in here, no more"), (5, "tiny item"),
            (6, "so we asked How many 9 km runs he had"), (7, "and then Bob saw the red house of Bob again"),
            (8, "and then Bob saw the red house of Carl again"), (9, "what was the capital city of France then")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_found) for r in decontaminate.contaminated(spark, d, b).collect()}
    assert got == {(1, 1): (2, 2), (2, 1): (2, 2), (3, 2): (1, 1), (5, 2): (1, 1), (6, 3): (1, 1), (7, 4): (4, 4)}


def test_every_alignment_is_tried(spark):
    filler, item = prose(random.Random(1), 40), ITEMS[0][1]
    broken = item.replace("12 apples", "31 apples")             # 12 is 31 here and 12 there
    other = item.replace("12", "31").replace("5", "8").replace("Bob", "Carl")
    half = len(item.split()) // 2
    cut = " ".join([*item.split()[:half], "so", *item.split()[half:]])     # no alignment holds 80 % of the windows
    docs = [(1, f"{filler} {broken} {filler} {item} {filler}"), (2, f"{filler} {broken} {filler} {other}"),
            (3, f"{filler} {item} {filler} {broken}"), (4, f"{filler} {broken} {filler} {broken} {filler}"),
            (5, f"{broken} {filler} " * 5 + item), (6, f"{filler} {cut} {cut} {cut}")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    got = decontaminate.contaminated(spark, d, b, least=0.6).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 1), (3, 1), (5, 1), (6, 1)]
    assert len({r.n_slots for r in got if r.doc_id != 6}) == 1


def template_of(text):
    """Template words and their values, by Python's regular expressions."""
    import regex
    t = text.translate(dict.fromkeys(map(ord, "<>="), "|"))
    t = regex.sub(r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)", r"<name=\1>", t)
    t = regex.sub(r"([0-9]+)", r"<num=\1>", t)
    t = regex.sub(r"(?<=[0-9]> ?)(" + "|".join(decontaminate.UNITS) + r")(?![\p{L}\p{N}])", r"<unit=\1>", t, flags=regex.I)
    marked = regex.sub(r"[^\p{L}\p{N}<>=]+", " ", t.lower()).split()
    return marked, [regex.sub("=[^>]*>", ">", w) for w in marked]


def leaks_by_hand(doc, item, least=0.8, window=5):
    """Whether ``item`` leaks into ``doc``: enough windows, and slots consistent
    along an offset that enough (or most) windows agree on."""
    dm, dt = template_of(doc)
    im, it = template_of(item)
    nm, nt = template_of("a " + item.lstrip())
    n = min(window, len(it))
    if not it:
        return False
    grams = [it[i:i + n] for i in range(len(it) - n + 1)]
    named = nt[1:1 + n]
    at = {}
    found = set()
    for j in range(len(dt) - n + 1):
        for i, g in enumerate(grams):
            if dt[j:j + n] == g or (i == 0 and dt[j:j + n] == named):
                at.setdefault(j - i, set()).add(i)
                found.add(tuple(g))
    if len(found) < least * len({tuple(g) for g in grams}) - 1e-9 or not at:
        return False
    most = max(map(len, at.values()))
    kind = lambda w: w[:w.index("=")] if "=" in w else w
    for offset, hit in at.items():
        if len(hit) < min(most, least * len(grams)):
            continue
        pairs = set()
        for i, w in enumerate(im):
            if 0 <= i + offset < len(dm):
                b = dm[i + offset]
                a = nm[1] if i == 0 and kind(b) == kind(nm[1]) else w
                if "=" in a and kind(a) == kind(b):
                    pairs.add((a, b))
        if len({a for a, _ in pairs}) == len(pairs):
            return True
    return False


def test_leaks_equal_brute_force(spark):
    rng = random.Random(21)
    word = lambda: rng.choice(["alpha", "beta", "Gamma", "Delta", "12", "5 km", "7kg", "and", "of", "said,", "=x", "don't"])
    items = [" ".join(word() for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14]))) for _ in range(40)]
    docs = []
    for k in range(150):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 7)))]
        for _ in range(rng.randrange(0, 3)):
            w = rng.choice(items).split()
            if rng.random() < 0.6:
                old, new = rng.choice(w), word()
                w = [new if x == old and rng.random() < 0.8 else x for x in w]
            parts += [" ".join(w), " ".join(word() for _ in range(rng.randrange(0, 5)))]
        docs.append(" ".join(parts))
    docs += [items[0], "a tiny " + items[1], "\ue000 \ue001 " + items[5]]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, d, b).collect()}
    want = {(i, j) for i, t in enumerate(docs) for j, x in enumerate(items) if leaks_by_hand(t, x)}
    assert got == want and len(want) > 100


def test_a_long_document_with_many_items(spark):
    rng = random.Random(2)
    items = [f"item {i} asks what the painter number {i} did with " + prose(rng, 12, 9000) for i in range(300)]
    doc = " ".join(f"{prose(rng, 100)} {x}." for x in items)
    # one window that all items have, and templates that many items share
    items += [f"how many apples are there if Anna has {i} and takes {i + 1} of them away" for i in range(50)]
    doc += " how many apples are there if Berta has 3 and takes 4 of them away"
    d = spark.createDataFrame([(1, doc), (2, prose(rng, 200))], "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, d, b).collect())
    assert got == [(1, i) for i in range(350)]


def test_shuffled_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    d = spark.createDataFrame([(1, ITEMS[1][1]), (2, "nothing of the kind in here")], "doc_id long, text string")
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark, d, b).collect()] == [(1, 2)]


# ------------------------------------------------------------ toxicity
def test_folding_and_exceptions():
    assert toxicity.fold("1D10T") == toxicity.fold("Іdіоt") == toxicity.fold("i​diot!") == " idiot "
    lex = toxicity.Lexicon({"trash": 5.0, "scum*": 3.0}, ["trash can"])
    a = lex.automaton()
    assert toxicity.weigh(a, toxicity.fold("trash, trash can; TRASH scumbag scum")) == 16.0
    assert toxicity.weigh(a, toxicity.fold("strash mascum")) == 0


def test_toxicity_is_learned_and_held_out(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        w = prose(rng, rng.randrange(20, 300)).split()
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vilegrot", "v1legrot", "Vilegrot!", "muckling"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    cond = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lex = toxicity.fit_lexicon(docs, lab.filter(~cond))
    out = toxicity.score_toxicity(docs, lex).filter(cond).join(lab, "doc_id")
    right = out.filter((F.col("score") >= 0.5) == (F.col("toxic") == 1)).count()
    assert right >= 0.98 * out.count()
    rest = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, lex).filter("doc_id is null or doc_id = 1000").collect()}
    assert len(rest) == 2 and all(s < 0.5 for s in rest.values())
    none = toxicity.fit_lexicon(docs, lab.limit(0))
    assert {round(r.score, 6) for r in toxicity.score_toxicity(docs, none).collect()} == {0.5}
    assert toxicity.score_toxicity(no_docs(spark).drop("score"), lex).count() == 0


def test_fit_takes_one_text_for_a_label(spark, monkeypatch):
    rows = [(1, f"some text number {i}") for i in range(5000)] + [(2, "vilegrot vilegrot"), (3, "plain words"), (3, "plain words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    lab = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: (seen.append(len(x)), (0.0, 1.0))[1])
    toxicity.fit_lexicon(docs, lab, max_train=4)
    assert seen == [4]


def test_toxicity_of_awkward_rows(spark):
    lex = toxicity.Lexicon({"vilegrot": 6.0}, intercept=-2.0, slope=2.0)
    docs = awkward_docs(spark)
    out = toxicity.score_toxicity(docs.withColumn("text", F.concat("text", F.lit(" vilegrot"))), lex)
    assert out.columns == docs.columns
    a = lex.automaton()
    for r in out.collect():
        f = toxicity.fold(r.text or "")
        x = toxicity.feature(toxicity.weigh(a, f), f.count(" ") - 1)
        assert r.score == pytest.approx(1 / (1 + math.exp(2 - 2 * x)))


# ------------------------------------------------------------ chat
def test_chat_round_trip_and_masks(spark):
    hostile = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|> <\\\\|x <|", "<", "|im_end|>", "<|endoftext|>", " \n lead", "",
               None, "🎉 é ﬁ", "a" * 5000 + "\n\n ", "x"]
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|x", None]), rng.choice(hostile), 7, "z")
            for c in [*range(40), None] for t in range(rng.randrange(1, 9))]
    rows += [rows[0], (500, 1, "assistant", "", 7, "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int, mask string")
    got = chat.read_back(chat.format_conversations(df, tokenizer_path())).collect()
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        turns[c].append((t, role or "", text or ""))
    want = []
    for c, ts in turns.items():
        ts.sort()
        loss = "".join(x for _, r, x in ts if r == "assistant")
        want.append((c, len(ts), sha("".join(f"{r}\n{x}\n" for _, r, x in ts)), len(loss), sha(loss)))
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    for h in hostile:
        assert chat.unescape(chat.escape(h or "")) == (h or "") and "<|" not in chat.escape(h or "")
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty, tokenizer_path())).count() == 0


def test_chat_of_a_very_long_conversation(spark):
    long = "word <|im_end|> 日本 " * 20_000
    rows = [(1, t, ["user", "assistant"][t % 2], long if t == 1 else "x") for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.format_conversations(df, tokenizer_path())).first()
    assert r.n_turns == 6 and r.loss_chars == len(long) + 2 and r.loss_sha256 == sha(long + "xx")


# ------------------------------------------------------------ mixing
def water_fill(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: fixed.get(s, level * weight[s]) for s in order}
        fixed.update((s, 3 * sizes[s]) for s in over)


@pytest.mark.parametrize("fan_in", [8, 512])
def test_mix_meets_its_targets(spark, fan_in):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(0, 60)), rng.choice(["big"] * 12 + ["b", "c", None, "é"])) for i in range(1500)]
    rows += [(5000, None, "empty"), (5001, "  ", "empty"), (5002, "one", "tiny"), rows[0], rows[0], (None, "a b c", "b")]
    docs = spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows], "doc_id long, text string, source string, size int, x double, row int")
    got = mixing.mix(spark, docs, fan_in=fan_in).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _ in rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    targets = water_fill(dict(size))
    taken = Counter()
    for r in got:
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 3 and r.source_size == size[r.source]
        assert r.target == pytest.approx(targets[r.source])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(2, 0.01 * t), s
    again = mixing.mix(spark, docs.repartition(5), fan_in=fan_in).collect()
    assert Counter((r.doc_id, r.size, r.copies) for r in got) == Counter((r.doc_id, r.size, r.copies) for r in again)
    copies = mixing.mixed_documents(spark, docs, fan_in=fan_in)
    assert copies.columns == docs.columns
    assert Counter(r.doc_id for r in copies.collect()) == \
        Counter({i: n for i, n in sum((Counter({r.doc_id: r.copies}) for r in got), Counter()).items() if n})
    assert mixing.mix(spark, no_docs(spark)).count() == 0


def test_mix_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mixing.mix(spark, docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _ in rows)
    assert max(r.size for r in got) == 20_000 and all(0 <= r.copies <= 3 for r in got)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    targets = water_fill(dict(size))
    assert all(r.target == pytest.approx(targets[r.source]) for r in got)
    assert mixing.mixed_documents(spark, docs).count() == sum(r.copies for r in got)


def test_hot_content_is_dealt_in_blocks(spark, monkeypatch):
    from txprep.llm import common
    df = spark.createDataFrame([("hot", 1000), ("one", 1), ("none", 0), ("two", 2)], "name string, times long")
    got = common.repeated(df, "times", "i", block=64)
    assert Counter((r.name, r.i) for r in got.collect()) == Counter(
        {("hot", i): 1 for i in range(1, 1001)} | {("one", 1): 1, ("two", 1): 1, ("two", 2): 1})
    rows = [(7, "the same text of six words", "s0")] * 3000 + [(i, prose(random.Random(i), 20), "s1") for i in range(300)]
    docs = spark.createDataFrame([(*r, {"k": 1}, 2) for r in rows], "doc_id long, text string, source string, a map<string, int>, times int")
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    taken = Counter(r.doc_id for r in mixed.collect())
    want = Counter()
    for r in mixing.mix(spark, docs.repartition(6)).collect():
        want[r.doc_id] += r.copies
    assert taken == Counter({i: n for i, n in want.items() if n})


def test_pivotal_rounding_keeps_probabilities(spark):
    rows = [(i, i, "s", 10, 0.3) for i in range(4000)]
    df = spark.createDataFrame(rows, "key long, row long, source string, size long, x double")
    got = mixing.pivotal_rounding(spark, df, len(rows), fan_in=64).collect()
    assert len(got) == 4000 and {r.x for r in got} == {0.0, 1.0}
    assert sum(r.x for r in got) == 1200
    # each eighth of the rows has its share: draws don't follow the order of the rows
    shares = np.array([r.x for r in sorted(got, key=lambda r: r.key)]).reshape(8, -1).mean(axis=1)
    assert (abs(shares - 0.3) < 0.08).all()
