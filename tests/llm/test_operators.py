"""Each operator against brute force, and on nulls, empty texts, repeated rows, empty tables and clashing columns."""

import io
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute

VOCAB = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "lam", "mu", "nu", "xi", "omi", "pi", "rho", "sig", "tau", "ups"]


def words(rng, n):
    return " ".join(rng.choice(VOCAB) + str(rng.randrange(30)) for _ in range(n))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(n)]
    for i in range(0, n, 4):
        texts.append(texts[i])
        w = texts[i].split()
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += [None, "", "   \n", "one", "One  two", "ONE two", "ÄÖÜ straße élan", "x" * 3000, words(rng, 9000)]
    return texts


def frame(spark, texts, extra=True):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("fp", "uid", "t", "id", "cell", "row", "root", "k0", "h1", "words", "n")}) if extra else df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_simhash(spark):
    from commlens.llm.simhash import near_duplicates

    texts = corpus()
    got = {r.doc_id: r for r in near_duplicates(frame(spark, texts)).collect()}
    fps = [brute.simhash(t) for t in texts]
    want = brute.components(list(range(len(texts))), fps)
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i].fp & (1 << 64) - 1 == fps[i]
        assert got[i].component_id == want[i]
    assert near_duplicates(empty(spark)).count() == 0
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in near_duplicates(twice).collect()) == [(-1, -1), (-1, 1), (1, 1), (1, 1)]


def test_simhash_large_cells(spark):
    """Clouds around one anchor are compared in blocks."""
    from commlens.llm.simhash import links

    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))) for _ in range(250)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {tuple(sorted((r.u & (1 << 64) - 1, r.v & (1 << 64) - 1))) for r in links(df, 3, cell=16).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        root[find(a)] = find(b)
    own = {}
    for i, c in enumerate(brute.components(fps, fps)):
        own.setdefault(c, set()).add(find(fps[i]))
    assert all(len(v) == 1 for v in own.values()) and len({next(iter(v)) for v in own.values()}) == len(own)


def test_keep_one(spark):
    from commlens.llm.simhash import keep_one

    texts = corpus(2, 24)
    want = {c for c in brute.components(list(range(len(texts))), [brute.simhash(t) for t in texts])}
    df = frame(spark, texts, False).withColumns({c: F.lit(7) for c in ("uid", "__row", "c0", "part", "idx", "root")}).withColumn("tags", F.array(F.struct(F.lit(1).alias("a"))))
    rows = keep_one(df).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want)
    assert all(r.text == texts[r.doc_id] and r["__row"] == r.uid == r.c0 == 7 and r.tags[0].a == 1 for r in rows) and keep_one(df).columns == df.columns


def test_components(spark):
    from commlens.llm.components import components

    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (100, 101), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("length,seed,group", [(40, 10, 4096), (40, 10, 3), (24, 24, 4096), (400, 100, 4096)])
def test_suffix_dedup(spark, length, seed, group):
    from commlens.llm.suffix_dedup import remove_repeats

    rng = random.Random(length + group)
    shared = [words(rng, 90) for _ in range(3)]
    texts = corpus(3, 20)
    for _ in range(12):
        s = rng.choice(shared)
        a, b = sorted(rng.sample(range(len(s)), 2))
        texts.append(words(rng, 12) + s[a:b] + words(rng, 7) + rng.choice(shared)[: rng.randrange(500)])
    texts += ["é" * 300 + " " + "ab" * 250, "ab" * 40 + "é" * 20, "z" * 45, "é" * 19 + "Q" + "é" * 20]
    want = brute.remove_repeats(texts, length)
    got = {r.doc_id: r for r in remove_repeats(frame(spark, texts), length=length, seed=seed, group=group).collect()}
    for i, w in enumerate(want):
        g = got[i]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == w[:4], texts[i]
        assert g.kept_text == w[4].decode("utf-8", "ignore")
    assert remove_repeats(empty(spark)).count() == 0


def test_suffix_dedup_nul_and_ids(spark):
    """NULs beside a repeat, null and repeated ids, and a text cut at another length than the digest."""
    from commlens.llm.suffix_dedup import remove_repeats

    rng = random.Random(31)
    s = words(rng, 120)[:600]
    texts = ["\0" + s, s, s + "\0\0", "\0\0" + s[:450] + "\0", "\0" * 900, words(rng, 50) + s[100:350], words(rng, 40) + s[100:350] + "end", None, None]
    rows = [(None if i % 3 == 2 else i // 2, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, nth int").repartition(2)
    got = {r.nth: r for r in remove_repeats(df, keep=("doc_id", "nth"), text_length=200).collect()}
    assert len(got) == len(texts) and all(got[i].doc_id == k for k, _, i in rows)
    for i, (w, v) in enumerate(zip(brute.remove_repeats(texts, 400), brute.remove_repeats(texts, 200), strict=True)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == w[:4] and got[i].kept_text == v[4].decode("utf-8", "ignore")


def test_tokens_and_packing(spark, tmp_path):
    from tokenizers import Tokenizer

    from commlens.llm.common import tokenizer_path
    from commlens.llm.packing import pack
    from commlens.llm.wavelet import encode_and_read_back

    texts = corpus(4, 20) + ["a <|endoftext|> b", "it's   odd space", "tab\tnew\nline 123.45", "!!! ... 'tis don't", "日本語 テキスト", "ǅ İstanbul ﬁ"]
    tok = Tokenizer.from_file(tokenizer_path())
    want = [brute.token_ids(tok, t) for t in texts]
    df = frame(spark, texts)
    rows = {r.doc_id: r for r in encode_and_read_back(df, tokenizer_path()).collect()}
    at = 0
    for i, ids in enumerate(want):
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), brute.crc(ids)), texts[i]
        at += len(ids)
    pieces = pack(df, tokenizer_path()).collect()
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert sorted(by_doc) == list(range(len(texts)))
    for i, ids in enumerate(want):
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert [p.start for p in own] == list(np.cumsum([0, *[p.length for p in own]])[:-1]) and sum(p.length for p in own) == len(ids)
        assert all(p.doc_tokens == len(ids) and p.ids_crc32 == brute.crc(ids[p.start : p.start + p.length]) for p in own)
    for own in by_seq.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0, *[p.length for p in own]])[:-1]) and sum(p.length for p in own) <= 4096
    assert pack(empty(spark), tokenizer_path()).count() == 0
    assert encode_and_read_back(empty(spark), tokenizer_path()).count() == 0


def test_null_and_repeated_ids(spark):
    from tokenizers import Tokenizer

    from commlens.llm.common import tokenizer_path
    from commlens.llm.packing import pack
    from commlens.llm.quality_rules import judge
    from commlens.llm.wavelet import encode_and_read_back

    rng, tok = random.Random(77), Tokenizer.from_file(tokenizer_path())
    texts = [words(rng, 10 + i) for i in range(30)]
    rows = [(None if i < 5 else 3 if i < 20 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(((r[0] is not None, r[0] or 0), brute.crc(brute.token_ids(tok, r[1]))) for r in rows)
    back = encode_and_read_back(df, tokenizer_path()).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids_crc32) for r in back) == want
    back.sort(key=lambda r: r.start)
    assert [r.start for r in back] == np.cumsum([0, *[r.n_tokens for r in back]])[:-1].tolist() and [(r.doc_id is not None, r.doc_id or 0) for r in back] == [w[0] for w in want]
    pieces = pack(df, tokenizer_path()).collect()
    whole = [((r.doc_id is not None, r.doc_id or 0), r.ids_crc32) for r in pieces if r.length == r.doc_tokens]
    assert len(whole) > 20 and set(whole) <= set(want) and sum(r.length for r in pieces) == sum(r.n_tokens for r in back)
    assert sorted((r.doc_id or -1, r.n_words) for r in judge(df).collect()) == sorted((k or -1, len(t.split())) for k, t in rows)


def test_best_fit(spark):
    from commlens.llm.packing import best_fit_decreasing

    rng = random.Random(3)
    lengths = np.array([rng.randrange(1, 65) for _ in range(500)])
    wins = best_fit_decreasing(lengths, 64)
    assert sorted(i for w in wins for i in w) == list(range(500)) and all(lengths[w].sum() <= 64 for w in wins)
    # The same fit with a plain search for the tightest window.
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, c in enumerate(left) if c >= n]
        if fits:
            i = min(fits, key=lambda i: left[i])
            left[i] -= n
        else:
            left.append(64 - n)
    assert len(wins) == len(left)


def test_tiling(spark):
    from commlens.llm.decontamination import Pattern, contaminated, rolling, tiles

    rng = random.Random(9)
    for _ in range(150):
        doc = np.array([rng.randrange(4) for _ in range(rng.randrange(0, 25))], dtype=np.int64)
        item = np.array([rng.randrange(4) for _ in range(rng.randrange(1, 12))], dtype=np.int64)
        want = brute.tile(doc.tolist(), item.tolist(), 3)
        got = tiles(doc, Pattern(item, 3))
        assert sum(t[2] for t in got) == sum(t[2] for t in want)
    assert len(rolling(np.arange(3), 4)) == 0
    base = words(rng, 40)
    sentences = [words(rng, 12) for _ in range(4)]
    items = [(1, " ".join(sentences)), (2, words(rng, 30)), (3, None), (4, "two words"), (5, "")]
    docs = [(0, f"{base} {' '.join(reversed(sentences))} {base}"), (1, base), (2, None), (3, "these TWO, words here"), (4, " ".join(sentences[:2])), (5, ""), (None, " ".join(sentences))]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("item", F.lit(2))
    for block in (2_000_000, 20):
        got = {(r.doc_id, r.item_id) for r in contaminated(d, b, block_words=block).collect()}
        assert got == {(0, 1), (3, 4), (None, 1)}
    long = spark.createDataFrame([(7, f"{words(rng, 30_000)} {items[0][1]} {words(rng, 30_000)}")] * 2, "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.covered_words) for r in contaminated(long, b.union(b.where("item_id = 1"))).collect()] == [(7, 1, 48)] * 4
    e = spark.createDataFrame([], "doc_id long, text string")
    assert contaminated(e, b).count() == 0 and contaminated(d, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_drop_contaminated(spark):
    from commlens.llm.decontamination import drop_contaminated

    b = spark.createDataFrame([(1, "aa bb cc dd ee ff gg hh")], "item_id long, text string")
    d = spark.createDataFrame([(0, "x aa bb cc dd ee ff gg hh y"), (1, "clean text of words"), (2, None), (None, "aa bb cc dd ee ff gg hh")], "doc_id long, text string")
    assert sorted(r.doc_id for r in drop_contaminated(d, b).collect()) == [1, 2]


def test_language(spark):
    from commlens.llm.language import identify

    rng = random.Random(2)
    base = {"en": "the of and to in that it is was with house water", "de": "der die und den von zu das mit haus wasser straße", "fr": "le les et des est du que dans une pour maison été"}
    rows = [(i, " ".join(rng.choice(base[k].split()) for _ in range(rng.randrange(3, 40))), k) for i, k in enumerate(rng.choice(sorted(base)) for _ in range(300))]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12345 !!!", "fr"), (1003, "the house", None), (None, "der wasser", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.lit(1)).withColumn("t", F.lit("x"))
    got = {r.doc_id: r for r in identify(df).collect()}
    assert len(got) == len(rows)
    for i, _, k in rows[:300]:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1
    assert np.mean([got[i].lang_pred == k for i, _, k in rows[:300]]) > 0.97
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002)) and got[None].lang_pred == "de" and not got[None].held_out
    # lang, source and doc_id are no inputs: another lang for held-out rows changes nothing.
    changed = df.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "xx").otherwise(F.col("lang")))
    assert {r.doc_id: (r.lang_pred, r.score) for r in identify(changed).collect()} == {k: (r.lang_pred, r.score) for k, r in got.items()}
    assert identify(df.limit(0)).count() == 0


def test_language_brute_force(spark):
    """Counts, nearest centroid and floor against plain Python; foreign and random texts are rejected, own ones of any length are not."""
    from commlens.llm.language import counts, identify, size_of, train, unit

    def plain(text, dims):
        t = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
        if not t:
            return None
        c, m, out = [ord(x) for x in f" {t} "], (1 << 32) - 1, [0] * dims
        for i in range(len(c)):
            one = c[i] * 0x9E3779B1 & m
            grams = [one]
            if i + 1 < len(c):
                two = (((one ^ one >> 15) * 0x85EBCA6B & m) + (c[i + 1] * 0xC2B2AE35 & m)) & m
                grams.append(two)
                if i + 2 < len(c):
                    grams.append((((two ^ two >> 13) * 0x27D4EB2F & m) + (c[i + 2] * 0x165667B1 & m)) & m)
            for g in grams:
                out[(g * 0x9E3779B1 & m) >> 32 - (dims.bit_length() - 1)] += 1
        return out

    rng = random.Random(21)
    syllables = {"aa": "ka lo mi tu re san vol", "bb": "sch ein ung tig ver ach zur", "cc": "que oi eau ment é ai nous"}
    word = lambda k: "".join(rng.choice(syllables[k].split()) for _ in range(rng.randrange(1, 4)))
    rows = [(i, " ".join(word(k) for _ in range(int(2 ** rng.uniform(2, 9)))), k) for i, k in enumerate(rng.choice(sorted(syllables)) for _ in range(900))]
    odd = ["".join(rng.choice("qwxyzjfgbdp") for _ in range(900)), " ".join("".join(rng.choice("bcdfghjkpwxyz") for _ in range(6)) for _ in range(150)), "слово и дело " * 30]
    rows += [(5000 + i, t, None) for i, t in enumerate(odd)] + [(6000, "kalo", None), (6001, word("bb"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(df, "doc_id", "text", "lang", 1500, 4, 4096, 0.002, 0.9)
    got = {r.doc_id: r for r in identify(df).collect()}
    for i, text, _ in rows[::30] + rows[-5:]:
        n = np.array(plain(text, 4096))
        assert (counts(text, 4096) == n).all()
        v = np.sqrt(n) * np.array(model.idf, float)
        cos = [float(np.dot(v, c)) / (np.linalg.norm(v) * np.linalg.norm(c)) for c in np.array(model.centroids, float)]
        assert got[i].lang_pred == model.langs[int(np.argmax(cos))] and abs(got[i].score - max(cos)) < 1e-4
        assert got[i].rejected == (max(cos) < model.floors[size_of(n)]) or abs(max(cos) - model.floors[size_of(n)]) < 1e-4
    assert all(got[5000 + i].rejected for i in range(len(odd))) and not got[6000].rejected and not got[6001].rejected
    assert np.mean([got[i].rejected for i, *_ in rows[:900]]) < 0.02
    assert abs(np.linalg.norm(unit(np.ones(4))) - 1) < 1e-9


def test_one_text_or_id_in_most_rows(spark):
    """Null ids and repeated texts don't swell the samples; rows stay whole."""
    from commlens.llm.language import identify
    from commlens.llm.quality_gam import classify

    rng = random.Random(1)
    rows = [(None, "the same words again and again", "en")] * 400 + [(i, words(rng, 30), "en") for i in range(100)] + [(7, "der die das und", "de")] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert identify(df, docs_per_lang=50).count() == 600
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (9, 1)] * 30, "doc_id long, quality int")
    got = classify(df, labels).collect()
    assert len(got) == 600 and len({r.score for r in got if r.doc_id == 7}) == 2


def test_quality_features_brute_force():
    """Bin additions against sums of single lookups, features against plain counts."""
    from commlens.llm.quality_gam import FEATURES, features_of, fit

    rng = random.Random(14)
    for t in ["", "One two.", "A|B|C\n\nA|B|C\nx " * 5, "é! " * 400, words(rng, 900), "SHOUT " * 9000, "\n \t\n", "a b c a b c a b c"]:
        f, w = dict(zip(FEATURES, features_of(t.encode()))), t.encode().split()
        solid = max(1, len(t.encode()) - sum(t.count(c) for c in " \t\n\r\v\f"))
        assert f["log_words"] == pytest.approx(np.log1p(len(w))) and f["exclaims"] == pytest.approx(t.count("!") / max(1, len(w))) and f["upper"] == pytest.approx(sum("A" <= c <= "Z" for c in t) / solid)
        assert f["distinct"] == pytest.approx(len(set(w)) / max(1, len(w))) and f["cells"] == pytest.approx(t.count("|") / max(1, len(w)))
        three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else []
        assert f["repeats"] == pytest.approx((len(three) - len(set(three))) / max(1, len(three) - 1))
        assert all(np.isfinite(list(f.values())))
    x = np.array([[rng.random() for _ in range(4)] for _ in range(400)])
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = fit(x, y, rounds=20, pair_rounds=40)
    b = m.bins(x)
    for i in range(0, 400, 37):
        raw = m.base + sum(t[sum(e < v for e in edges)] for t, edges, v in zip(m.tables, m.edges, x[i])) + sum(t[b[i, p], b[i, q]] for p, q, t in m.pairs)
        assert m.score(x[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-raw)))
    assert np.mean((m.score(x) > 0.5) == y) > 0.9  # an interaction that no single feature shows


def test_quality_classifier(spark):
    from commlens.llm.quality_gam import classify

    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.6
        rows.append((i, (words(rng, 60).capitalize() + ".") if good else " ".join(["BUY!!! $$$ click"] * rng.randrange(5, 30))))
        if i % 2 == 0:
            labels.append((i, int(good), 0))
    rows += [(900, None), (901, ""), (None, "Some text.")]
    labels += [(900, None, None), (None, 1, 0), (5000, 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("x", F.lit(1)).withColumn("held_out", F.lit("a"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("z"))
    got = {r.doc_id: r for r in classify(df, lab).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    own = [(got[i].score, q) for i, q, _ in labels[:200] if got[i].held_out]
    assert np.mean([(s >= 0.5) == bool(q) for s, q in own]) > 0.95
    assert {r.score for r in classify(df, lab.limit(0)).collect()} == {0.5} and classify(df.limit(0), lab).count() == 0


def test_quality_rules(spark, tmp_path):
    import duckdb

    from commlens.llm.quality_rules import judge, oracle

    rng = random.Random(6)
    texts = corpus(5, 40) + ["#*$%& | <>" * 20, "same line\n" * 60, (words(rng, 60) + ". ") * 3, "SHOUT! " * 70, "a|b|c " * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({oracle()})").fetchall())
    got = judge(df.withColumn("words", F.lit(1)).withColumn("lines", F.lit(1))).select(*cols)
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
    assert judge(df.limit(0)).count() == 0


def test_html(spark):
    from commlens.llm.html_wrappers import align, extract

    def page(i, body):
        return f"<html><head><title>T{i}</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li>Home</li></ul></nav><div class='box'>Always the same</div><div id='c'><h1>Head {i}</h1><p>{body}</p></div><footer>© f</footer></body></html>"

    rows = [(i, f"http://a.example/{i}", page(i, f"Body &amp; text   {i}<br>more <b>bold{i}</b>.")) for i in range(12)]
    rows += [(100, None, None), (101, "odd", ""), (102, "http://b.example/x", "<article><p>One &lt;two&gt; <!-- c --> three</p><aside>ad</aside></article>"), (3, "http://a.example/3", rows[3][2]), (None, "http://a.example/9", rows[9][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("id", F.lit(1))
    got = extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i in range(12):
        assert by[i].text == f"Head {i} Body & text {i} more bold{i}." and by[i].n_chars == len(by[i].text)
    assert by[100].text == "" and by[101].text == "" and by[102].text == "One <two> three" and by[None].text == by[9].text
    assert align("0 a\n1 b\n1 c", "0 a\n1 x\n1 c") == (0, 1, -1, 3)
    assert extract(df.limit(0)).count() == 0


def test_html_copies_are_no_template(spark):
    """Nine pages of one story and one of another: both stories stay; so does a new text in a slot that is constant elsewhere."""
    from commlens.llm.html_wrappers import extract

    page = lambda h, p: f"<html><body><div class='c'><h1>{h}</h1><p>{p}</p></div></body></html>"
    rows = [(i, "http://a.example/x", page("Day 1", "One story of many words.")) for i in range(9)] + [(9, "http://a.example/y", page("Day 9", "An article of its own."))]
    rows += [(20 + i, "http://b.example/x", f"<div><p>Shared note.</p><p>Own {i}.</p></div><div class='z'>Same box</div>") for i in range(10)] + [(40, "http://b.example/z", "<div><p>Own 40.</p></div><div class='z'>Not the same</div><div class='only'>Extra</div>")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "Day 1 One story of many words." for i in range(9)) and got[9] == "Day 9 An article of its own."
    assert all(got[20 + i] == f"Own {i}." for i in range(10)) and got[40] == "Own 40. Not the same Extra"


def test_html_deep_and_long(spark):
    from commlens.llm.html_wrappers import extract

    deep = "<div>" * 3000 + "<p>Deep {0}.</p>" + "</div>" * 3000
    rows = [(i, "http://d.example/", deep.format(i)) for i in range(6)] + [(9, "http://d.example/", "<div class='q'><p>Flat.</p></div>"), (10, "http://d.example/", "<p>" + "long word " * 200_000 + "</p>")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Deep {i}." for i in range(6)) and got[9] == "Flat." and got[10] == ("long word " * 200_000).strip()


def test_html_brute_force(spark):
    """Unmarked pages: what a plain count of blocks by their path says is constant is dropped."""
    from commlens.llm.html_wrappers import extract

    rng, pages, blocks = random.Random(3), [], []
    for i in range(30):
        own, html = [], "<html><body>"
        for box in range(4):
            if rng.random() < 0.8 or box == 0:
                html += f"<div class='b{box}'>"
                for tag in sorted(rng.choices(["h2", "p"], k=rng.randrange(1, 4))):
                    text = rng.choice(["Always here", "Always here", f"Words {i} {rng.randrange(99)}"]) if box else "Top"
                    html += f"<{tag}>{text}</{tag}>"
                    own.append(((box, tag), text))
                html += "</div>"
        pages.append((i, "http://c.example/", html + "</body></html>"))
        blocks.append(own)
    on = {}
    for own in blocks:
        for slot in {s for s, _ in own}:
            on.setdefault(slot, [0, {}])[0] += 1
        for slot, text in set(own):
            on[slot][1][text] = on[slot][1].get(text, 0) + 1
    gone = {(s, t) for s, (n, by) in on.items() for t, k in by.items() if n >= 5 and k >= 0.8 * n}
    want = {i: " ".join([t for s, t in own if (s, t) not in gone] or [t for _, t in own]) for i, own in enumerate(blocks)}
    assert gone
    assert {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()} == want


CALL = '<tool_call>{{"id": "{0}", "name": "{1}", "arguments": {2}}}</tool_call>'
RESULT = '<tool_response>{{"id": "{0}", "content": {1}}}</tool_response>'


def test_tool_calls(spark):
    from commlens.llm.tool_calls import canonical, format_chats, valid

    assert canonical({"b": [1.0, 2.5, 1e21, 1e-7, -0.0, True, None], "a": "é\n\"", "\U0001f600": 1, "דּ": 2}) == '{"a":"é\\n\\"","b":[1,2.5,1e+21,1e-7,0,true,null],"\U0001f600":1,"דּ":2}'
    assert valid({"x": 3}, {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 1}}, "additionalProperties": False})
    assert not valid({"x": 3, "y": 1}, {"properties": {"x": {}}, "additionalProperties": False}) and not valid({"x": "3"}, {"properties": {"x": {"type": "number"}}})
    tools = '<tools>[{"name": "add", "parameters": {"type": "object", "required": ["a"], "properties": {"a": {"type": "number"}}}}]</tools>'
    rows = [
        (1, 0, "system", f"You may add. {tools}"), (1, 1, "user", "Add"),
        # c2 needs c1, which is called later; c4 and c5 need each other; c6 needs what nobody calls
        (1, 2, "assistant", "Well " + CALL.format("c2", "add", '{"a": {"$ref": "c1"}}') + CALL.format("c1", "add", '{"a": 2.0}')),
        (1, 3, "tool", RESULT.format("c1", "2") + RESULT.format("c2", '{"z": 1, "a": 2}') + RESULT.format("c1", "3") + RESULT.format("nope", "0")),
        (1, 4, "assistant", CALL.format("c3", "add", '{"b": 1}') + CALL.format("c3", "add", '{"a": 1}') + CALL.format("c4", "add", '{"a": {"$ref": "c5"}}') + CALL.format("c5", "add", '{"a": [{"$ref": "c4"}]}')),
        (1, 5, "assistant", CALL.format("c6", "mul", '{"a": {"$ref": "gone"}}') + "<tool_call>{oops</tool_call>" + '<tool_call>{"name": "add", "arguments": "{\\"a\\": 1}"}</tool_call>'),
        (2, 0, "assistant", CALL.format("c1", "mul", '{"q": 1}')), (2, 1, None, None), (None, 0, "user", "x"), (2, 2, "tool", RESULT.format("c1", '"r"')),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1)).withColumn("id", F.lit(1))
    got = format_chats(df, {"mul": {"type": "object"}}).collect()
    key = [(r.order_turn, r.order_level, r.turn, {"message": 0, "call": 1, "result": 2}[r.kind], r.item) for r in got]
    status = {(r.conv_id, r.kind, r.call_id, r.turn, r.item): r.status for r in got}
    assert sum(r.kind == "message" for r in got) == len(rows)
    assert [status[1, "call", c, 2, i] for c, i in (("c2", 0), ("c1", 1))] == ["ok", "ok"]
    assert [status[1, "result", c, 3, i] for c, i in (("c1", 0), ("c2", 1), ("c1", 2), ("nope", 3))] == ["ok", "ok", "duplicate_result", "orphan"]
    assert [status[1, "call", c, 4, i] for c, i in (("c3", 0), ("c3", 1), ("c4", 2), ("c5", 3))] == ["invalid_arguments", "duplicate_id", "cycle", "cycle"]
    assert status[1, "call", "c6", 5, 0] == "no_result" and status[1, "call", None, 5, 1] == "bad_json" and status[1, "call", None, 5, 2] == "no_id"
    assert status[2, "call", "c1", 0, 0] == "ok" and status[2, "result", "c1", 2, 0] == "ok"
    own = [r for _, r in sorted(zip(key, got), key=lambda x: x[0]) if r.conv_id == 1 and r.turn in (2, 3) and r.kind != "message"]
    assert [(r.kind, r.call_id) for r in own if r.status == "ok"] == [("call", "c1"), ("result", "c1"), ("call", "c2"), ("result", "c2")]
    for r in got:
        assert canonical(json.loads(r.json)) == r.json
    assert format_chats(df.limit(0)).count() == 0


def test_tool_calls_odd_json(spark):
    """Lone surrogates, names and ids that are no strings, deep values, broken schemas: a status each, never a crash."""
    from commlens.llm.tool_calls import format_chats

    deep = '[' * 100_000 + ']' * 100_000
    blocks = [
        (CALL.format("a", "f", '{"x": "\\ud800"}'), "no_result"), (CALL.format("\\udc00", "f", "{}"), "bad_json"), ('<tool_call>{"id": 5, "name": "f", "arguments": {}}</tool_call>', "bad_json"),
        ('<tool_call>{"id": "b", "name": 5, "arguments": {}}</tool_call>', "bad_json"), (CALL.format("c", "f", deep), "bad_json"), (CALL.format("d", "f", '{"x": NaN}'), "bad_json"),
        (CALL.format("e", "f", '{"x": 1e999}'), "bad_json"), (CALL.format("g", "odd", "{}"), "bad_schema"), ("<tool_call>[]</tool_call>", "bad_json"), (CALL.format("h", "f", '{"$ref": "\\ud800"}'), "no_result"),
        (CALL.format("i", "f", '{"x": "é\\u0000\\n"}'), "no_result"), ("<tool_call></tool_call>", "bad_json"),
    ]
    tools = '<tools>[{"name": 7}]</tools><tools>{"name": "z"}</tools><tools>[{"name": "f"}, {"name": "odd", "parameters": ["x"]}]</tools><tools>[{"name": "\\ud800"}]</tools>'
    rows = [(1, 0, "system", tools), *[(1, i + 1, "assistant", b) for i, (b, _) in enumerate(blocks)], (1, 50, "tool", RESULT.format("a\\ud800", "1")), (1, 51, "tool", RESULT.format("zz", deep)), (None, None, None, CALL.format("n", "f", "{}"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.status for r in format_chats(df).collect() if r.kind != "message"}
    assert [got[1, i + 1] for i in range(len(blocks))] == [s for _, s in blocks]
    assert got[1, 50] == "bad_json" and got[1, 51] == "bad_json" and got[None, None] == "unknown_tool"


def test_tool_calls_brute_force(spark):
    """Links, order and status of random conversations against plain Python."""
    from commlens.llm.tool_calls import format_chats

    rng, rows, calls, results = random.Random(12), [], {}, {}
    for conv in range(6):
        for turn in range(12):
            text = ""
            for item in range(rng.randrange(4)):
                own = f"c{rng.randrange(14)}"
                if rng.random() < 0.7:
                    refs = [f"c{rng.randrange(14)}" for _ in range(rng.choice([0, 0, 1, 2]))]
                    text += CALL.format(own, "f", json.dumps({"x": [{"$ref": r} for r in refs]}))
                    calls.setdefault((conv, own), []).append((turn, item, refs))
                else:
                    text += RESULT.format(own, rng.randrange(9))
                    results.setdefault((conv, own), []).append((turn, item))
            rows.append((conv, turn, "assistant", text))
    want, order = {}, {}
    for conv in range(6):
        first = {k: min(v) for (c, k), v in calls.items() if c == conv}
        key, grown = {}, True
        while grown:
            grown = False
            for k, (turn, _, refs) in first.items():
                known = [r for r in refs if r in first]
                if k not in key and all(r in key for r in known):
                    key[k] = max([(turn, 0), *[(key[r][0], key[r][1] + 1) for r in known]])
                    grown = True
        for k, (turn, item, _) in first.items():
            order[conv, turn, item] = key.get(k, (turn, 0))
        for (c, k), v in calls.items():
            for turn, item, _ in v if c == conv else ():
                want[conv, turn, item] = "duplicate_id" if (turn, item) != first[k][:2] else "cycle" if k not in key else "ok" if (conv, k) in results else "no_result"
        for (c, k), v in results.items():
            for at in v if c == conv else ():
                want[conv, *at] = "orphan" if k not in first else "ok" if at == min(v) else "duplicate_result"
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [r for r in format_chats(df, {"f": {}}).collect() if r.kind != "message"]
    assert {(r.conv_id, r.turn, r.item): r.status for r in got} == want and len(got) == len(want)
    assert all((r.order_turn, r.order_level) == order[r.conv_id, r.turn, r.item] for r in got if r.kind == "call" and r.status in ("ok", "no_result"))


def test_pipeline(spark, tmp_path):
    """The stages in order against their brute-force versions, each on what the one before kept."""
    import corpus_pipeline

    rng = random.Random(4)
    base = "the of and to in that it is was with house water"
    texts = [" ".join(rng.choice(base.split()) + rng.choice("abcdefg") for _ in range(rng.randrange(20, 80))) for _ in range(60)]
    item = words(rng, 20)
    passage = words(rng, 80)
    texts += [texts[0], texts[1] + " x", f"{texts[2]} {item}", f"{texts[3]} {passage} end", f"start {passage} {texts[4]}", None, "", "123 456"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        d = stage(spark, d, str(tmp_path))
        if k < 4:
            assert d.columns == docs.columns
        d.write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
        seen.append({r.doc_id for r in d.collect()})
        if name == "repeated_passages":
            rows = {r.doc_id: r for r in d.collect()}
            order = sorted(seen[1])
            for i, w in zip(order, brute.remove_repeats([texts[i] for i in order], corpus_pipeline.PASSAGE_BYTES)):
                assert rows[i].text == w[4].decode("utf-8", "ignore") and rows[i].n_chars == len(rows[i].text)
    assert seen[0] == set(range(len(texts))) - {65, 66, 67}
    keep = sorted(seen[0])
    assert seen[1] == set(brute.components(keep, [brute.simhash(texts[i]) for i in keep]))
    assert seen[2] == seen[1] and seen[2] - seen[3] == {62} and seen[4] == seen[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == d.count()


def test_wavelet_matrix():
    """Access, counting and occurrence lookup from one shard against plain arrays."""
    from commlens.llm import wavelet

    rng = np.random.default_rng(1)
    ids = rng.integers(0, 300, 3000)
    parts = wavelet.encode_shard(ids.astype("<u2"), np.array([1000, 3000]), pa.array([4, 9]), 9)
    m = wavelet.WaveletMatrix(io.BytesIO(b"".join(parts)))
    assert (m.decode() == ids).all() and m.ends.tolist() == [1000, 3000] and m.keys.to_pylist() == [4, 9]
    for i in (0, 1, 63, 64, 1500, 2999):
        assert m.access(i) == ids[i]
    for v in (0, 7, 299):
        for e in (0, 10, 2000, 3000):
            assert m.rank(v, e) == int((ids[:e] == v).sum())
        at = np.flatnonzero(ids == v)
        for k in range(0, len(at), 3):
            assert m.select(v, k) == at[k]
        assert m.count(v) == len(at) and m.occurrences(v) == at.tolist()
