"""Decontamination, spelling variants, periodic runs: brute force, odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.llm import decontamination as D
from reelstar.llm import periodic_runs as R
from reelstar.llm import queries
from reelstar.llm import spelling_variants as V

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination ------------------------------------------------------------

def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def windows(text, n=10):
    words = folded(text)
    return {tuple(words[k:k + n]) for k in range(max(len(words) - n, 0) + 1)} if words else set()


def brute_contamination(texts, items, n=10, slop=2):
    """Per text: words, hit words, items, items with a proximity match."""
    by_first = defaultdict(set)
    for item, text in items:
        for w in windows(text, n):
            by_first[w[0]].add((w, str(item)))
    every = {(w, i) for found in by_first.values() for w, i in found}
    out = []
    for text in texts:
        words = folded(text)
        hit, found, near = set(), set(), set()
        for p, word in enumerate(words):
            for w, item in by_first.get(word, ()):
                if tuple(words[p:p + len(w)]) == w:
                    hit.update(range(p, p + len(w)))
                    found.add(item)
        at = defaultdict(set)
        for p, word in enumerate(words):
            at[word].add(p)
        for w, item in every:
            if item not in near and all(t in at for t in w):
                starts = {p - i + s for i, t in [min(enumerate(w), key=lambda x: len(at[x[1]]))]
                          for p in at[t] for s in range(-slop, slop + 1)}
                if any(all(any(s + i + d in at[t] for d in range(-slop, slop + 1)) for i, t in enumerate(w))
                       for s in starts):
                    near.add(item)
        out.append((len(words), len(hit), sorted(found), len(near)))
    return out


def rows_of(found):
    return sorted((r.doc_id, r.n_words, r.n_hit, r["items"], r.n_near_items, r.contaminated) for r in found.collect())


def test_decontamination_equals_brute_force(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(i, n, h, found, near, h > 0) for (i, _), (n, h, found, near)
            in zip(texts, brute_contamination([t for _, t in texts], items), strict=True)]
    got = D.contamination(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert rows_of(got) == sorted(want)
    assert sum(r[5] for r in want) >= 3
    q = queries.op11_decontamination(spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in q) == sorted(
        (i, n, h, len(found), sha(",".join(found)), h > 0) for i, n, h, found, _, _ in want)


@pytest.mark.parametrize("slop", [0, 2])
def test_decontamination_over_cuts_passes_and_near_phrases(spark, monkeypatch, slop):
    """Small blocks cut every text, and the benchmark takes several passes."""
    monkeypatch.setattr(D, "BLOCK_BYTES", 700)
    monkeypatch.setattr(D, "QUERY_BYTES", 600)
    monkeypatch.setattr(D, "CANDIDATES", 50)
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "日本", "İ"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 14, 30])))) for k in range(3, 14)]
    items += [(14, ""), (15, None), (16, " ,.- "), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (17, "w0 " * 12)]
    texts = []
    for k in range(30):
        words = rng.choices(vocabulary, k=rng.choice([0, 4, 90, 600]))
        for _ in range(rng.randint(0, 4)):
            part = folded(rng.choice(items)[1])
            if rng.random() < 0.5 and len(part) > 4:
                j = rng.randrange(len(part) - 2)
                part[j], part[j + 1] = part[j + 1], part[j]
            at = rng.randint(0, len(words))
            words[at:at] = part
        texts.append((k, rng.choice([" ", "-", ".\n"]).join(words).upper() if k % 3 else " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination([t for _, t in texts], items, slop=slop)
    got = rows_of(D.contamination(docs, bench, slop=slop))
    assert got == [(i, n, h, found, near, h > 0) for (i, _), (n, h, found, near) in zip(texts, want, strict=True)]


def test_phrase_matches_carry_places(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c x a b c"), (2, "a x b c"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "A b C")], "item_id long, text string")
    index = D.build_index(docs, str(tmp_path / "index"))
    got = {r.id: {(m.first, m.end, m.exact) for m in r.matches}
           for r in D.find_phrases(index, items, window=3, slop=1).collect()}
    assert {m for m in got[1] if m[2]} == {(0, 3, True), (4, 7, True)}
    assert got[2] and not any(exact for *_, exact in got[2])
    assert got[3] == set()
    with pytest.raises(ValueError):
        D.find_phrases(index, items, window=D.GAP, slop=1)


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [("q", "long text of many words long text of many words"), ("é", "stands in many documents"),
         (None, "same line stands"), ("none", None)], "item_id string, text string")
    got = rows_of_odd(D.contamination(odd_docs, items))
    assert sum(map(len, got.values())) == odd_docs.count()
    assert got[1] == [(0, 0, [])] and got[2] == [(0, 0, [])]
    assert got[4] == [(8, 6, ["", "é"])] and got[6] == [(9, 6, ["", "é"])] * 2
    assert got[10] == [(600_000, 600_000, ["q"])]
    assert sorted(got[None]) == [(0, 0, []), (8, 6, ["", "é"])]
    assert D.contamination(no_docs, items).count() == 0
    assert {r.n_hit for r in D.contamination(odd_docs, items.limit(0)).collect()} == {0}


def rows_of_odd(found):
    out = defaultdict(list)
    for r in found.collect():
        out[r.doc_id].append((r.n_words, r.n_hit, r["items"]))
    return out


# --- spelling variants ------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_words(texts, delete=True, min_n=3):
    n = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if delete and h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if c >= min_n and len(w) >= 5}


def brute_variants(words):
    drops, wild = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            drops[w[:k] + w[k + 1:]].add(w)
            wild[w[:k], w[k + 1:]].add(w)
    form, count = {}, {}
    for w in words:
        around = set().union(*(wild[w[:k], w[k + 1:]] for k in range(len(w))), drops[w])
        around |= {w[:k] + w[k + 1:] for k in range(len(w))} & words.keys()
        around.discard(w)
        count[w] = len(around)
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], count[w], words[form[w]] if form[w] else None))
    return out


def variant_rows(found):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_spelling_variants_equal_brute_force(spark, texts):
    want = brute_variants(brute_words(texts))
    assert variant_rows(queries.op12_spelling_variants(spark, SF)) == want
    assert sum(r[1] is not None for r in want) > 20


@pytest.mark.parametrize("cell_words", [3, 40])
def test_spelling_variants_in_small_cells(spark, cell_words):
    """Words of few letters: crowded leaves, cells in several blocks, chains."""
    rng = random.Random(5)
    words = {"".join(rng.choices("abeäÿ×", k=rng.randint(5, 7))) for _ in range(400)}
    words |= {"a" * k for k in range(5, 20)} | {"x日" * 3, "x日" * 2 + "x本", "straße", "strasse"}
    words = {w: rng.choice([3, 4, 7, 9, 20, 50, 200]) for w in words} | {"a" * k: 3 * 2 ** k for k in range(5, 20)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variant_rows(V.variants_of(df, cell_words=cell_words)) == brute_variants(words)


def test_near_check_and_moves():
    rng = random.Random(3)
    for _ in range(4000):
        a, b = ("".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(2))
        if a != b and abs(len(a) - len(b)) <= 1:
            assert V.one_edit(a, b) == near(a, b)
    moves = V.steps(3)
    both = {tuple(m) for m in moves} | {tuple(-x for x in m) for m in moves}
    assert len(both) == 2 * len(moves) - 1 == 1 + 3 + 9


def test_spelling_variants_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute_words(rows)
    got = {r.word: r.n for r in V.count_words(odd_docs).filter("n >= 3").collect()}
    assert got == want
    assert variant_rows(V.spelling_variants(odd_docs)) == brute_variants(want)
    assert V.spelling_variants(no_docs).count() == 0
    other = [(1, "Ünïque日äöü×÷ x" + "É" * 9), (None, "a€bcdefg\U0001f600hijkl" * 3)]
    df = spark.createDataFrame(other, "doc_id long, text string")
    for delete in (1, None):
        got = {r.word: r.n for r in V.count_words(df, min_chars=1, delete_one_in=delete).collect()}
        want = Counter()
        for i, text in other:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text):
                w = lower(run)
                h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
                want[w[:h % len(w)] + w[h % len(w) + 1:] if delete else w] += 1
        assert got == {w: n for w, n in want.items() if w}


# --- periodic runs -----------------------------------------------------------------

def brute_runs(s, least=24, periods=3):
    out = []
    for p in range(1, len(s) // periods + 1):
        i = 0
        while i + p < len(s):
            if s[i] != s[i + p]:
                i += 1
                continue
            a = i
            while i + p < len(s) and s[i] == s[i + p]:
                i += 1
            part = s[a:i + p]
            if len(part) >= max(least, periods * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                out.append((a, len(part), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_periodic(text, doc_id):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words) if max(Counter(words).values(), default=0) >= 3 else []
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {k for a, n, p in runs for k in range(a + p, a + n)}
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{a},{n},{p}\n" for a, n, p in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def periodic_rows(found):
    return [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
            for r in found.collect()]


def test_periodic_runs_equal_brute_force(spark, texts):
    want = [(i, *brute_periodic(t, i)) for i, t in texts]
    got = periodic_rows(queries.op13_periodic_runs(spark, SF))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 5


def test_runs_of_symbols_equal_brute_force():
    rng = random.Random(1)
    for _ in range(700):
        s = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.6:
            s = s[:rng.randint(0, 9)] + s[:rng.randint(1, 9)] * rng.randint(2, 9) + s[:5]
        for least, periods in ((2, 2), (5, 3), (24, 3)):
            want = brute_runs(s, least, periods)
            assert R.runs_of_symbols(s, least, periods) == want
            assert R.runs_of_words([b"%d" % x for x in s], least, periods) == want


def test_extensions_are_common_prefixes():
    rng = random.Random(2)
    for _ in range(60):
        s = [rng.randint(1, 2) for _ in range(rng.randint(2, 40))]
        ext = R.Extensions(s)
        assert [k for _, k in sorted((s[k:], k) for k in range(len(s) + 1))] == sorted(
            range(len(s) + 1), key=ext.rank.tolist().__getitem__)
        for _ in range(40):
            a, b = rng.sample(range(len(s)), 2)
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert ext.common(R.np.array([a]), R.np.array([b])).tolist() == [k]


def test_periodic_runs_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("runs", F.lit("odd"))
    found = R.periodic_runs(docs, tail_id="doc_id")
    rows = {}
    for r in found.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert {len(v) for k, v in rows.items() if k not in (6, None)} == {1} and len(rows[6]) == len(rows[None]) == 2
    for i, text in [(1, None), (2, ""), (3, " \t\n\x0b"), (7, "word " * 30), (8, "a b")]:
        r = rows[i][0]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == \
            brute_periodic(text, i)
    long = rows[10][0]
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 600_000, 5)
    assert long.collapsed_sha256 == sha("long text of many words,")
    assert [x.asDict() for x in rows[7][0].runs] == [{"start": 0, "length": 30, "period": 1}]
    assert found.schema["runs"].dataType == T.ArrayType(R._RUN) and rows[7][0]["text `x`"] == "odd"
    assert R.periodic_runs(no_docs, tail_id="doc_id").count() == 0
    with pytest.raises(ValueError):
        R.periodic_runs(docs, keep=["text"], tail_id="doc_id")
