"""Tokenizers, licences, embeddings, URLs, components and the pipeline."""

import math
import re
import tracemalloc
from collections import Counter, defaultdict
from dataclasses import replace
from decimal import Decimal

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.llm import license_scan as L
from reelstar.llm import queries
from reelstar.llm import sentencepiece_codec as C
from reelstar.llm import token_counts as K
from reelstar.llm import url_filter as U
from reelstar.llm.components import connected_components
from reelstar.llm.embedding_dedup import _planes, embedding_dedup, passes_for

SF = "/root/testdata/sf0.001"


# --- components ------------------------------------------------------------

def brute_components(edges):
    part = {}

    def top(x):
        part.setdefault(x, x)
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        part[max(x, y)] = min(x, y)
    return {x: top(x) for x in part}


@pytest.mark.parametrize("shape", ["path", "star", "random", "ties", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(3)
    if shape == "path":
        ids = rng.permutation(200).tolist()
        edges = list(zip(ids, ids[1:], strict=False))
    elif shape == "star":
        edges = [(500, k) for k in range(500)]
    elif shape == "random":
        edges = [tuple(map(int, e)) for e in rng.integers(0, 400, (300, 2))]
    elif shape == "ties":
        edges = [(1, 2), (2, 1), (1, 2), (3, 3), (None, 1), (4, None)]
    else:
        edges = []
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = brute_components([e for e in edges if None not in e and e[0] != e[1]])
    assert {r.node: r.component for r in got.collect()} == want
    assert got.count() == len(want)


# --- sentencepiece and counts ----------------------------------------------

def strange_texts():
    rng = np.random.default_rng(4)
    letters = list("abe tn ▁<>0é日\n\t\U0001f600") + ["  ", "<s>", "<0x0A>", "́"]
    return ["".join(rng.choice(letters, rng.integers(0, 50))) for _ in range(400)] + ["", " ", "  ", "a ", " a", "a  b"]


def test_codec_parity_and_round_trip(spark, piece_model, texts):
    native = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
    given = [t for _, t in texts] + strange_texts()
    codec = C.Codec(piece_model, memo=200)
    ids = [x for k in range(0, len(given), 50) for x in codec.encode([t.encode() for t in given[k: k + 50]])]
    assert [x.tolist() for x in ids] == native.encode(given)
    assert [t.decode() for t in codec.decode(ids)] == native.decode([x.tolist() for x in ids])
    # ids that no text gives: any order of pieces, bytes that are no UTF-8
    rng = np.random.default_rng(5)
    loose = [rng.integers(3, 1000, rng.integers(0, 40)).astype(np.uint32) for _ in range(300)]
    whole = codec.tokenizer.decode_batch([x.tolist() for x in loose], skip_special_tokens=False)
    assert [t.decode() for t in codec.decode(loose)] == whole


def test_segments_of_a_row_have_the_ids_they_have_alone(piece_model):
    """New segments are encoded many to a text, and a worker's codec stays."""
    codec = C.Codec(piece_model)
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abeé日\n<>0\U0001f600"), rng.integers(1, 9))) for _ in range(3 * C.ROW + 5)]
    given = [f" {w}".encode() for w in words]
    assert codec._of_rows(given) == codec._each(given)
    texts = [" ".join(words[:70]).encode(), b"", " ".join(words[60:]).encode()]
    calls, real = [], codec._each
    codec._each = lambda new: calls.append(len(new)) or real(new)
    ids = codec.encode(texts)
    assert sum(calls) == 0 and len(codec.ids_of) == len({*given, b" "})
    assert [len(x) for x in ids] == [len(codec.tokenizer.encode(t.decode(), add_special_tokens=False).ids) for t in texts]
    # where the pieces do not tell the segments apart, each is encoded alone
    codec.opens[:] = False
    assert codec._of_rows(given) == real(given) and sum(calls) == len(given)
    assert C.codec_of(piece_model, 2) is C.codec_of(piece_model, 2)
    assert C.codec_of(piece_model, 2) is not C.codec_of(piece_model, 3)


def test_memos_are_bounded_by_bytes(piece_model):
    codec = C.Codec(piece_model, memo=1 << 20)
    rng = np.random.default_rng(6)
    for _ in range(40):
        batch = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (20_000, 300, 300, 12)]
        ids = codec.encode(batch)
        assert codec.decode(ids) == batch
        for memo in (codec.ids_of, codec.text_of):
            assert sum(len(k) + len(v) for k, v in memo.items() if len(k) <= C.LONGEST) <= (1 << 20) + 21_000 * 8
            assert sum(len(k) > C.LONGEST for k in memo) <= len(batch)


def test_count_of_a_long_unbroken_text_takes_little_memory(piece_model):
    counter = K.Counter(C.parse_model(piece_model))
    text = "▁" + "abcdefghij" * 100_000
    tracemalloc.start()
    score, n = counter(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * len(text)  # the search's own copy of the text, four bytes a character
    # a period's count is settled: the difference of two lengths grows in proportion
    short, longer = counter("▁" + "abcdefghij" * 100)[1], counter("▁" + "abcdefghij" * 200)[1]
    assert n == short + (longer - short) * 999 and score < 0


def test_codec_query_and_decode(spark, odd_docs, no_docs, piece_model):
    got = C.encode_texts(odd_docs, piece_model, with_ids=True, threads=4)
    rows = got.collect()
    assert len(rows) == 14 and all(r.parity in (True, None) for r in rows)
    assert all(r.n_tokens is None and r.parity is None for r in rows if r.text is None)
    assert [r.n_tokens for r in rows if r.doc_id == 2] == [0]
    back = C.decode_ids(got.withColumnRenamed("text", "before"), piece_model)
    assert back.filter(~F.col("text").eqNullSafe(F.col("before"))).count() == 0
    assert C.encode_texts(no_docs, piece_model).count() == 0
    assert queries.op3_sentencepiece(spark, SF).filter("NOT parity OR NOT round_trip").count() == 0


def test_other_models_are_rebuilt(piece_model):
    model = C.parse_model(piece_model)
    assert (model.kind, model.byte_fallback, model.by_segments, len(model.pieces)) == (C.BPE, True, True, 32_000)
    squeezed = C.build(replace(model, squeeze=True))
    plain = C.build(model)
    assert squeezed.encode("  a   b ").ids == plain.encode("a b").ids


def brute_count(model, text):
    """Best (score, tokens) by all segmentations of a short text."""
    pieces = {p: s for p, s, _ in model.pieces}
    unk = min(pieces.values()) - 10
    best = {0: (0.0, ())}
    for end in range(1, len(text) + 1):
        for start in range(end):  # earliest start first; only a better one replaces
            part = text[start:end]
            if part in pieces:
                score = pieces[part]
            elif end - start == 1:
                score = unk
            else:
                continue
            total = best[start][0] + score
            if end not in best or total > best[end][0]:
                best[end] = (total, (*best[start][1], part))
    score, parts = best[len(text)]
    return score, sum(1 if p in pieces else len(p.encode()) for p in parts)


def test_token_counts_match_the_tokenizer(spark, texts, piece_model):
    model = replace(C.parse_model(piece_model), kind=C.UNIGRAM)
    whole = C.build(model)
    got = {r.doc_id: r for r in queries.op7_token_counts(spark, SF).collect()}
    for i, t in texts:
        assert got[i].n_tokens == len(whole.encode(t, add_special_tokens=False).ids)
    odd = strange_texts()
    rows = K.token_counts(spark.createDataFrame([(t,) for t in odd], "text string"), piece_model, memo=2_000).collect()
    for r in rows:
        assert r.n_tokens == len(whole.encode(r.text, add_special_tokens=False).ids)
    counter = K.Counter(model)
    for t in ["▁the", "▁straße", "▁日本x", "zqxj", "▁" * 5 + "a"]:
        assert counter(t) == brute_count(model, t)


def test_token_count_ties_take_the_earliest_start():
    pieces = [("<unk>", 0.0, C.UNKNOWN), ("a", -1.0, 1), ("aa", -2.0, 1), ("aaa", -3.0, 1), ("▁", -1.0, 1), ("b", -9.0, 1)]
    model = C.Model(pieces=pieces, squeeze=False)
    counter = K.Counter(model)
    for t in ["a", "aa", "aaa", "aaaa", "aaaaa", "▁aab", "xy", "axya"]:
        want = C.build(model).model.tokenize(t)
        merged = [k for k, x in enumerate(want) if not (x.value == "<unk>" and k and want[k - 1].value == "<unk>")]
        assert counter(t)[1] == len(merged)


def test_token_counts_odd_rows(odd_docs, no_docs, piece_model):
    rows = K.token_counts(odd_docs, piece_model).collect()
    assert len(rows) == 14
    assert {(r.n_tokens, r.score) for r in rows if r.text is None} == {(None, None)}
    assert [(r.n_tokens, r.score) for r in rows if r.doc_id == 2] == [(0, 0.0)]
    assert K.token_counts(no_docs, piece_model).count() == 0


# --- licences --------------------------------------------------------------

def test_license_scan_matches_sql(spark, duck):
    got = queries.op6_license_scan(spark, SF)
    order = ", ".join(got.columns)
    want = duck.execute(f"SELECT {order} FROM ({queries.ORACLE_SQL['op6_license_scan']})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_license_inheritance_and_odd_rows(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/x.py", "import os"), (3, "a/b/LICENSE", gpl), (4, "z/x.py", "hello"),
        (5, "a/y.py", "first\n" + gpl + "\n" + "other words " * 40), (6, None, mit), (7, "a/b/q", None), (8, "a/b/q", ""),
        (8, "a/b/q", ""), (None, "ab/q", "x"), (9, "a/b/c/d/e", "word " * 1000), (10, "a/COPY", "Licensed under CC BY 4.0."),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("odd"))
    got = sorted((r.doc_id or 0, r.license, r.inherited_from, r.is_license_file) for r in L.license_scan(files).collect())
    assert [g for g in got if g[0] != 5] == [
        (0, None, None, False), (1, "MIT", None, True), (2, "GPL-3.0", "a/b", False), (3, "GPL-3.0", None, True),
        (4, None, None, False), (6, "MIT", None, True), (7, "GPL-3.0", "a/b", False), (8, "GPL-3.0", "a/b", False),
        (8, "GPL-3.0", "a/b", False), (9, "GPL-3.0", "a/b", False), (10, "CC-BY-4.0", None, True)]
    assert ("GPL-3.0", None) in [g[1:3] for g in got if g[0] == 5]
    assert L.license_scan(files.limit(0)).count() == 0


def brute_license(texts, templates=L.TEMPLATES, least=L.THRESHOLD, lines=L.WINDOW_LINES):
    """Per text: minimal windows, best (score, name), whether it is a licence file."""
    def tokens(text):
        return re.findall("[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))

    df = Counter(w for t in texts for w in set(tokens(t)))

    def vector(text):
        return {w: (1 + math.log(c)) * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, c in Counter(tokens(text)).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return round(sum(x * b.get(w, 0) for w, x in a.items()) / norm, 6) if norm else 0

    known = [(name, vector(t)) for name, t in templates]
    out = []
    for t in texts:
        ls, hits, best = (t or "").split("\n"), set(), []
        units = [((a, n), "\n".join(ls[a:a + n])) for a in range(len(ls)) for n in range(1, min(lines, len(ls) - a) + 1)]
        for at, body in [*units, (None, t or "")]:
            v = vector(body)
            found = [(-cosine(v, k), name) for name, k in known if cosine(v, k) >= least]
            best += found
            if found and at:
                hits.add(at)
            file = bool(found)
        least_ones = [h for h in hits if not any(g != h and g[0] >= h[0] and sum(g) <= sum(h) for g in hits)]
        out.append((len(least_ones), min(best)[1] if best else None, -min(best)[0] if best else None, file))
    return out


def test_license_scan_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    prose = ["the harbour opened early", "boats", "", "software for the free world", "a copy of the public notice",
             "any version is permitted", "license plates and general stores", "é 日本", "source and binary stars"]
    mit = next(t for n, t in L.TEMPLATES if n == "MIT" and len(t) > 500)
    bsd = next(t for n, t in L.TEMPLATES if n.startswith("BSD") and len(t) > 500)
    wrap = lambda t, n: "\n".join(" ".join(t.split()[k:k + n]) for k in range(0, len(t.split()), n))
    texts = [None, "", "\n\n", wrap(mit, 12).replace("Copyright.", "Copyright (c) 2021 Jane Roe"),
             wrap(bsd, 14).upper(), "\n".join(prose * 9 + ["Released under the MIT License."] + prose * 9)]
    notices = [t for _, t in L.TEMPLATES if len(t) < 500]
    for k in range(30):
        body = [str(x) for x in rng.choice(prose, rng.integers(0, 14))]
        body[k % 5:k % 5] = ["# " + x for x in wrap(notices[k % len(notices)], 8).split("\n")]
        if k % 3 == 0:
            body += notices[(k + 1) % len(notices):][:1] * 2
        texts.append("\n".join(body))
    files = spark.createDataFrame([(k, f"d{k}/x", t) for k, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r.doc_id: (r.n_notices, r.own_license, r.own_score, r.is_license_file) for r in L.license_scan(files).collect()}
    want = brute_license(texts)
    assert [got[k] for k in range(len(texts))] == want
    assert want[3][1:2] + want[3][3:] == ("MIT", True) and want[4][1:2] + want[4][3:] == ("BSD-3-Clause", True)
    assert want[5][0] == 1 and want[5][1] == "MIT" and not want[5][3]  # a notice in a long text is no licence file
    assert all(w[0] >= 1 for w in want[6:])  # notices wrapped at eight words


# --- embeddings ------------------------------------------------------------

def brute_vectors(rows, least=0.98):
    good = []
    for k, (_, label, v) in enumerate(rows):
        if label is None or not v or None in v or not np.isfinite(v).all() or not np.any(v):
            continue
        x = np.array(v, dtype=np.float64)
        x = x / np.abs(x).max()
        good.append((k, label, x / np.sqrt(x @ x)))
    links, edges = Counter(), []
    for a, (i, p, x) in enumerate(good):
        for j, q, y in good[:a]:
            if p == q and len(x) == len(y) and x @ y >= least:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    part = brute_components(edges)
    return [(rows[k][0], links[k], rows[part.get(k, k)][0]) for k in range(len(rows))]


def test_embeddings_recall_and_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows = []
    for c in rng.normal(size=(30, 16)):
        for n in (0.0, 0.02, 0.05, 0.1, 0.15):
            rows.append((int(rng.integers(0, 2)), (c + n * rng.normal(size=16)).astype("f4").tolist()))
    near = rng.normal(size=16)
    rows += [(0, (near + 0.01 * rng.normal(size=16)).astype("f4").tolist()) for _ in range(300)]  # longer than a window
    rows += [(1, near.astype("f4").tolist())] * 40
    rows += [(0, None), (0, []), (0, [0.0] * 16), (0, [1.0, None]), (1, [float("nan")] * 16), (1, [float("inf")] * 16),
             (None, near.astype("f4").tolist()), (1, [1.0, 2.0]), (1, [2.0, 4.0]), (1, [1e-30] * 3), (1, [1e30] * 3)]
    rows = [(int(i), *r) for i, r in zip(rng.permutation(len(rows)), rows, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("kept", F.lit("odd"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(df, block=32).collect()}
    want = {i: (n, None) for i, n, _ in brute_vectors(rows)}
    least = {}
    for i, _, p in brute_vectors(rows):
        least.setdefault(p, []).append(i)
    comp = {i: min(ids) for ids in least.values() for i in ids}
    assert len(got) == len(rows)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in want.values())
    assert np.mean([got[i][1] == comp[i] for i in got]) > 0.95
    assert all(v[2] == (i == v[1]) for i, v in got.items())
    assert embedding_dedup(df.limit(0)).count() == 0


def test_embeddings_passes_follow_the_key_length():
    assert [passes_for(b) for b in (8, 16)] == [8, 8] and passes_for(16, 1.0) == 8
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * y  # pairs exactly at the threshold
    for bits in (16, 24, 30):
        passes = passes_for(bits)
        assert passes > 8 or bits == 16
        planes = _planes(24, passes, bits, 42)
        same = ((x @ planes > 0) == (y @ planes > 0)).reshape(len(x), passes, bits).all(axis=2).any(axis=1)
        assert same.mean() > 0.94  # on equal keys alone


def test_embeddings_of_other_kinds_and_lengths(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.01]), (3, 0, [1.0, 0.0, 0.0]), (4, 0, [1.0, None, 0.0]), (5, 0, None),
            (6, 0, [1.0, 0.0, 0.02]), (7, 0, []), (8, 0, [0.0, 0.0, 0.0]), (9, 0, [float("nan"), 1.0])]
    for kind in ("double", "float", "decimal(10,4)"):
        given = rows if not kind.startswith("d") or kind == "double" else [r for r in rows if r[0] != 9]
        if kind.startswith("decimal"):
            given = [(i, p, v and [None if c is None else Decimal(str(c)) for c in v]) for i, p, v in given]
        df = spark.createDataFrame(given, f"vec_id long, label int, embedding array<{kind}>")
        got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(df).collect()}
        linked = {1: (1, 1), 2: (1, 1), 3: (1, 3), 6: (1, 3)}
        assert got == {i: linked.get(i, (0, i)) for i, _, _ in given}


def test_embeddings_repeated_rows(spark):
    rows = [(5, 1, [1.0, 0.0]), (5, 1, [1.0, 0.0]), (3, 1, [2.0, 0.0]), (None, 1, [1.0, 0.0]), (9, 2, [1.0, 0.0])]
    got = embedding_dedup(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got) == [
        (0, 3, 3, False), (3, 3, 3, True), (5, 3, 3, False), (5, 3, 3, False), (9, 0, 9, True)]


# --- URLs ------------------------------------------------------------------

def test_url_addresses_keep_the_query_and_resolve_dots(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=%s">'
    pages = [
        (1, "http://a.com/go?u=1", refresh % "http://bad.net/x"), (2, "http://a.com/go?u=2", ""), (3, "http://a.com/go", ""),
        (4, "https://www.a.com/go/?utm_source=mail&u=1#top", ""), (5, "http://bad.net/x", ""),
        (6, "http://c.com/p/q", '<link rel="canonical" href="../x">'), (7, "http://c.com/x", refresh % "http://bad.net/y"),
        (8, "http://c.com/p/./r/../../x/.", ""), (9, "http://bad.net/y", ""), (10, "http://c.com/p/../../x?", ""),
        (11, "http://c.com/.well/..x", ""), (12, "http://c.com/p/x", ""),
    ]
    got = {r.page_id: (r.verdict, r.component) for r in U.url_filter(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {k for k, (v, _) in got.items() if v == "block"} == {1, 4, 5, 6, 7, 8, 9, 10}
    assert got[2][1] == "a.com/go?u=2" and got[3][1] == "a.com/go" and got[11][1] == "c.com/.well/..x"
    assert got[6][1] == got[7][1] == got[8][1] == got[9][1] == got[10][1]


def test_urls_match_sql(spark, duck):
    got = queries.op10_url_filter(spark, SF)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op10_url_filter']})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_urls_rules_aliases_and_odd_rows(spark):
    canon = '<link href="{}" rel="canonical">'
    fresh = "<meta http-equiv='refresh' content='0; url={}'>"
    rows = [
        (1, "http://A.Example.NET/en/x?q#f", None), (2, "https://example.net", ""), (3, "http://example.net/de/", "x"),
        (4, None, None), (5, "no scheme", None), (6, "http://notnet/x", ""), (7, "http://x.org/fr", None),
        (8, "http://x.org/fr/a", None), (9, "://h.com/p", None), (10, "ftp://sub.example.com/de/1?x", None),
        # neutral page whose canonical is blocked; redirect chain to it; allowed alias wins
        (20, "http://c.info/a", canon.format("http://bad.net/z")), (21, "http://bad.net/z", None),
        (22, "http://d.info/b", fresh.format("http://c.info/a?utm=1")),
        (30, "http://e.info/a", canon.format("//bad2.net/y")), (31, "http://bad2.net/y/", None),
        (32, "http://good.org/fr/1", fresh.format("http://e.info/a")), (33, "http://f.info/q/r", canon.format("/s")),
        (34, "http://f.info/s", None), (35, "http://www.f.info/s.html", canon.format("mailto:x@y")), (36, "http://f.info/s", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("odd"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.url_filter(df).collect()}
    assert len(got) == len(rows)
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    # the bare host is the same address as its root, but no rule on "/" fits an empty path
    assert got[2][2:] == (None, "allow") and got[3][2:] == ("net/", "block")
    assert got[4] == ("", "", None, "allow") == got[5] and got[6][2:] == (None, "allow")
    assert got[7][2:] == (None, "allow") and got[8][2:] == ("org/fr/", "allow") and got[9][:2] == ("h.com", "/p")
    assert got[10][2:] == ("example.com/de/", "block")
    assert [got[k][3] for k in (20, 21, 22)] == ["block"] * 3
    assert [got[k][3] for k in (30, 31, 32)] == ["allow", "block", "allow"]
    comp = {r.page_id: r.component for r in U.url_filter(df).collect()}
    assert comp[33] == comp[34] == comp[35] == comp[36] and comp[4] is None
    links = spark.createDataFrame([("http://f.info/s", "http://bad.net/z"), (None, "x"), ("http://k/", None)],
                                  "from_url string, to_url string")
    more = {r.page_id: r.verdict for r in U.url_filter(df, links=links, html_col=None).collect()}
    assert [more[k] for k in (20, 33, 34, 35)] == ["allow", "allow", "block", "block"]
    assert U.url_filter(df.limit(0)).count() == 0


# --- pipeline --------------------------------------------------------------

def test_pipeline_stage_by_stage(spark, duck, texts):
    import corpus_pipeline as pipe
    from reelstar.llm import packing, secret_scan
    from test_text_ops import brute_fingerprint, brute_groups, brute_lines

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(pipe.STAGES)
    assert [n for n, _ in pipe.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "secret_scan", "packing"]
    one = stage["quality_rules"](spark, docs, SF).cache()
    kept = {r.doc_id for r in queries.op8_quality_rules(spark, SF).filter("kept").collect()}
    assert {r.doc_id: r.text for r in one.collect()} == {i: t for i, t in texts if i in kept}
    two = stage["line_dedup"](spark, one, SF).cache()
    want = {i: t for i, _, _, t in brute_lines([(i, t) for i, t in texts if i in kept])}
    assert {r.doc_id: r.text for r in two.collect()} == want
    assert two.filter("n_chars <> char_length(text)").count() == 0
    three = stage["simhash_dedup"](spark, two, SF).cache()
    ids = sorted(want)
    first = {ids[p] for p in brute_groups([brute_fingerprint(want[i]) for i in ids])}
    assert {r.doc_id: r.text for r in three.collect()} == {i: want[i] for i in first}
    four = stage["secret_scan"](spark, three, SF).cache()
    for made in (one, two, three, four):
        assert made.schema.names == docs.schema.names
    left = {r.doc_id: r.text for r in four.collect()}
    assert set(left) == first
    assert not any(secret_scan.base_spans(t, t.encode()) for t in left.values())
    five = stage["packing"](spark, four, SF)
    assert {r.doc_id for r in five.collect()} == first
    whole = pipe.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(map(tuple, whole.select(key).collect())) == Counter(map(tuple, five.select(key).collect()))
    assert packing.WINDOW >= max(r.length for r in five.collect())


def test_pipeline_takes_odd_rows(spark, odd_docs):
    import corpus_pipeline as pipe

    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.lit(None).cast("long")})
    for _, f in pipe.STAGES:
        for given in (docs, docs.limit(0)):
            made = f(spark, given, SF)
            rows = made.collect()
            assert given is docs or rows == []
            if f is not pipe.packing_stage:
                assert made.schema.names == docs.schema.names and {r["kept"] for r in rows} <= {"odd"}
    assert docs.schema["n_chars"].dataType == T.LongType()


def test_native_operators_use_no_python(spark):
    for name in ("op4_line_dedup", "op6_license_scan", "op10_url_filter"):
        plan = getattr(queries, name)(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_components_group_counts(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 100, 2)], "a long, b long")
    groups = defaultdict(list)
    for r in connected_components(edges).collect():
        groups[r.component].append(r.node)
    assert all(sorted(v) == [k, k + 1] for k, v in groups.items())
