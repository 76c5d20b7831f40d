import hashlib
import pickle
import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import batches, embedding_dedup, fill_middle, jaccard_join, media, packing, queries, repeated_spans, toxicity, whitening
from tidemark.sources.work import Scratch

SF = "/root/testdata/sf0.001"
LONG = "é😀a\n" * 60_000


def same_as_sql(same, spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name])


def cut_plainly(i, t):
    t, h = t or "", hashlib.sha256(("1:" + ("" if i is None else str(i))).encode()).hexdigest()
    h, n = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)], len(t)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    x, y, z = t[:a], t[a:b], t[b:]
    return (n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}")


def test_fill_middle(spark):
    texts = [None, "", "a", "a b\nc\n", "$1\\x ${a} " * 5, "x<P>y", "😀é" * 100, LONG, LONG + "\n", "\r\n", " "] + ["hello $2 world\\ " * k for k in range(1, 40)]
    rows = [(i, t, "mine", 0) for i, t in enumerate(texts)] + [(7, "again", None, None), (7, "again", None, None), (None, "no id here", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _form string, _n int")
    out = fill_middle.fill_middle(df).withColumn("back", fill_middle.restore(F.col("__output"), F.col("__form")))
    got = out.collect()
    assert len(got) == len(rows) and sorted((r["_form"] or "", r["_n"] or 0) for r in got) == sorted((r[2] or "", r[3] or 0) for r in rows)
    for r in got:
        assert (r["__n"], r["__form"], r["__prefix_units"], r["__middle_units"], r["__output"]) == cut_plainly(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["__form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_middle(df.limit(0)).count() == 0


def test_fill_middle_by_words_and_other_marks(spark):
    df = spark.createDataFrame([(i, "one  two three\nfour " * i) for i in range(1, 30)], "doc_id long, text string")
    marks = ("$pre\\", "[suf]", "(mid)")
    out = fill_middle.fill_middle(df, unit=r"\S+\s*+", marks=marks, plain_percent=0).withColumn("back", fill_middle.restore(F.col("_output"), F.col("_form"), marks)).collect()
    assert all(r["_n"] == 4 * r["doc_id"] and r["back"] == r["text"] and r["_form"] != "plain" for r in out)
    for r in out:
        words = re.findall(r"\S+\s*", r["text"])
        a, b = r["_prefix_units"], r["_prefix_units"] + r["_middle_units"]
        x, y, z = ("".join(p) for p in (words[:a], words[a:b], words[b:]))
        assert r["_output"] == (marks[1] + z + marks[0] + x + marks[2] + y if r["_form"] == "spm" else marks[0] + x + marks[1] + z + marks[2] + y)


def test_fill_middle_query(spark, same):
    same_as_sql(same, spark, "op11_fill_in_middle")
    plan = queries.QUERIES["op11_fill_in_middle"](spark, SF)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def removed_plainly(rows, width):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for j in range(len(w) - width + 1 if i is not None else 0):
            key = tuple(w[j : j + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - width + 1 if i is not None else 0):
            if first[tuple(w[j : j + width])] < i:
                gone |= set(range(j, j + width))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,core,seed", [(50, 20, 1), (10, 4, 2), (8, 8, 3), (5, 1, 4)])
def test_repeated_spans_equal_the_plain_ones(spark, window, core, seed):
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(30)}" for _ in range(rng.randint(window // 4 + 1, 3 * window // 2))] for _ in range(12)]
    rows = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 8)):
            words += rng.choice(passages)[rng.randint(0, 3) :] if rng.random() < 0.7 else [f"w{rng.randrange(30)}" for _ in range(rng.randint(1, 30))]
        rows.append((rng.randint(-5, 100) * 3, "  \n\v".join(words)))
    one = " ".join(passages[0] * 4)
    rows += [(None, one), (None, one), (7, None), (8, ""), (9, " \t"), (900, "a " * 300), (901, "a " * 200), (901, "a " * 200), (901, one), (902, "a b " * 200), (903, "b a " * 200), (904, "é x " * 90), (905, "q é x " + "é x " * 90)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, _kept int").repartition(5)
    got = repeated_spans.remove_repeated(df, window=window, core=core).select("doc_id", "__n_words", "__n_removed", "__kept", "_kept").collect()
    assert sorted([tuple(r)[:4] for r in got], key=repr) == removed_plainly(rows, window)
    assert all(r["_kept"] == 1 for r in got)


def test_repeated_spans_of_odd_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_spans.remove_repeated(df).count() == 0
    text = " ".join(f"w{i % 997}x{i % 31}" for i in range(100_000))
    got = {r["doc_id"]: r for r in repeated_spans.remove_repeated(spark.createDataFrame([("b", text), ("a", "start " + text)], "doc_id string, text string")).collect()}
    assert got["a"]["_n_removed"] == 0 and got["b"]["_n_removed"] == 100_000 and got["b"]["_kept"] == ""
    with pytest.raises(ValueError):
        repeated_spans.remove_repeated(df, window=3, core=4)


def test_repeated_spans_query(spark, same):
    same_as_sql(same, spark, "op12_de_bruijn_dedup")


def test_window_hashes_and_least_positions():
    words = np.random.default_rng(1).integers(0, 5, 400).astype(np.uint64)
    for width in (1, 2, 3, 7, 20, 50):
        for kind in (0, 1):
            got = repeated_spans.rolled(words, width, kind)
            runs = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
            assert len(got) == len(runs) and len(set(got.tolist())) == len(set(runs)) == len(set(zip(runs, got.tolist(), strict=True)))
        assert [int(i) for i in repeated_spans.leftmost_least(words, width)] == [i + min(range(width), key=lambda j: (words[i + j], j)) for i in range(len(words) - width + 1)]  # noqa: B023


def eigen_plainly(vectors):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    u = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(u), u.sum(axis=0)
    z = ((u * n - sums) / n).astype(float)
    e, v = np.linalg.eigh(z.T @ z / n)
    return (x * n - sums), n, e[::-1], v[:, ::-1]


def held_against_plain(out, k):
    rows = out.collect()
    z, n, e, v = eigen_plainly([r["embedding"] for r in rows])
    got = np.array([r["_whitened"] for r in rows])
    want = (z.astype(float) / n) @ (v[:, :k] / np.sqrt(e[:k]))
    assert got.shape == want.shape
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-7
    assert [r["_deviation"] for r in rows] == [int((q * q).sum()) for q in z] and {r["_n"] for r in rows} == {n}
    assert np.allclose(rows[0]["_explained"], (e / e.sum())[:k], rtol=1e-10) and rows[0]["_identity_error"] < 1e-8


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    frame = lambda x: spark.createDataFrame([(i, v.astype(float).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    held_against_plain(whitening.whiten(frame(np.repeat(rng.standard_normal((400, 60)) * np.linspace(3, 0.5, 60), 2, axis=0))), 16)
    held_against_plain(whitening.whiten(frame(rng.standard_normal((300, 5)))), 5)
    held_against_plain(whitening.whiten(frame(rng.integers(-9, 9, (200, 3)) @ rng.integers(-3, 3, (3, 70))).where("vec_id >= 0")), 3)  # rank 3 of 70


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 4.5]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (8, []), (9, [0.0, -1.0])]
    df = spark.createDataFrame([(*r, 2) for r in rows], "vec_id long, embedding array<double>, _n int")
    got = whitening.whiten(df).collect()
    assert sorted((r["vec_id"] or 0, r["__n"], r["_n"]) for r in got) == [(0, 3, 2), (1, 3, 2), (1, 3, 2), (9, 3, 2)]
    assert [len(r["_whitened"]) for r in whitening.whiten(df.drop("_n").where("vec_id = 1")).collect()] == [0, 0]
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 3")).count() == 0
    far = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [r["_deviation"] for r in whitening.whiten(far).orderBy("vec_id").collect()][:2] == [None, None]


def test_whitening_query(spark):
    rows = queries.QUERIES["op13_chebyshev_whitening"](spark, SF).collect()
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    z, n, e, v = eigen_plainly([vectors[i] for i in ids])
    assert len(rows) == 16 * len(ids) and {r["component"] for r in rows} == set(range(1, 17))
    got = np.zeros((len(ids), 16))
    at = {i: k for k, i in enumerate(ids)}
    for r in rows:
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert abs(r["explained"] / (e / e.sum())[r["component"] - 1] - 1) < 1e-9
    want = (z.astype(float) / n) @ (v[:, :16] / np.sqrt(e[:16]))
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-7
    assert all(r["identity_error"] < 1e-9 for r in rows[:5])


def test_filtered_subspace_meets_close_eigenvalues():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    e = np.sort(np.concatenate([[50.0, 49.999], 1 + rng.random(198)]))[::-1]
    a = (q * e) @ q.T
    values, vecs, residuals, passes = whitening.leading_pairs(lambda x: a @ x, 200, 16)
    assert np.abs(values / e[:16] - 1).max() < 1e-12 and residuals.max() < 1e-10 and passes < 400
    assert np.abs(a @ vecs - vecs * values).max() < 1e-10


def planted_vectors(spark, n, labels, kind="float"):
    """n pairs with cosines from 0.931 to 0.96 in 64 dimensions, and one that is far from all."""
    rng = np.random.default_rng(5)
    x, r = rng.normal(size=(2, n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r -= (r * x).sum(1, keepdims=True) * x
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    c = rng.uniform(0.931, 0.96, (n, 1))
    rows = np.vstack([x, c * x + np.sqrt(1 - c * c) * r])
    return spark.createDataFrame([(i, v.tolist(), i % n % labels) for i, v in enumerate(rows)], f"vec_id long, embedding array<{kind}>, label int")


def test_near_vectors_just_above_the_threshold(spark):
    frame = planted_vectors(spark, 500, 2)
    exact = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame, exact=True, block=32).collect()}
    assert all(exact[i]["n_links"] == 1 and exact[i]["component_id"] == i % 500 and exact[i]["kept"] == (i < 500) for i in range(1000))
    assert embedding_dedup.near_duplicates(frame, task_values=64_000).where("n_links = 1").count() >= 996


def test_near_vectors_keep_double_precision(spark):
    """A pair whose cosine reaches the threshold in double precision only by more than single precision can tell."""
    t = float(np.float32(0.93))
    up, down = 0.93 + 1e-10, 0.93 - 1e-10
    rows = [(k, [1.0, 0.0], k // 2) if k % 2 == 0 else (k, [c, float(np.sqrt(1 - c * c))], k // 2) for k, c in ((0, t), (1, up), (2, t), (3, down))]
    for exact in (False, True):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        assert {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(frame, exact=exact).collect()} == {0: 1, 1: 1, 2: 0, 3: 0}


def test_near_vectors_without_ids_and_rows(spark):
    frame = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [0.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    for exact in (False, True):
        got = embedding_dedup.near_duplicates(frame, exact=exact).collect()
        assert sorted((r["vec_id"] is None, r["n_links"], r["kept"]) for r in got) == [(False, 0, True), (True, 1, True), (True, 1, True)]
        assert embedding_dedup.near_duplicates(frame.limit(0), exact=exact).count() == 0


def zipped(members):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def test_media_in_containers_and_end_marks():
    wav, pdf = media.to_wav(b"abcd"), b"%PDF-1.4 x startxref 9 %%EOF"
    updated = pdf + b" more startxref 12 %%EOF"
    inner = zipped({"a.wav": wav})
    outer = zipped({"inner.zip": inner, "b.txt": b"PK\x03\x04 no archive", "c.wav": wav})
    assert media.sniff_bytes(updated + wav) == [("pdf", 0, len(updated)), ("wav", len(updated), len(wav))]
    assert media.sniff_bytes(pdf + pdf) == [("pdf", 0, len(pdf)), ("pdf", len(pdf), len(pdf))]
    assert media.sniff_bytes(b"zz" + outer + wav) == [("zip", 2, len(outer)), ("wav", 2 + len(outer), len(wav))]
    got = media.sniff_nested(b"zz" + outer)
    at = 2 + outer.index(inner)
    assert got == [("zip", 2, len(outer), None), ("zip", at, len(inner), 2), ("wav", 2 + outer.index(wav), len(wav), at), ("wav", 2 + outer.rindex(wav), len(wav), 2)]
    assert media.sniff_bytes(b"\xff\xd8\xff\xda\x00\x00" * 200_000 + b"PK\x03\x04" * 200_000 + b"%PDF-1" * 200_000) == []
    assert media.sniff_bytes(media.to_wav(wav)) == [("wav", 0, len(media.to_wav(wav)))]


def test_sniff_keeps_a_callers_columns(spark):
    wav = media.to_wav(b"abcd")
    frame = spark.createDataFrame([(bytearray(wav), "png", "mine", 1), (bytearray(wav), "png", "mine", 1), (None, None, None, 2), (bytearray(b""), "wav", "x", 3)], "blob binary, kind string, Media string, media_type int")
    out = media.sniff(frame, "blob", "kind")
    rows = sorted(out.collect(), key=lambda r: r["media_type"])
    assert [r["Media"] for r in rows] == ["mine", "mine", None, "x"] and [r["_media_type"] for r in rows] == ["wav", "wav", None, None]
    assert [r["_type_corrected"] for r in rows] == [True, True, False, False] and rows[0]["_media"][0]["within"] is None
    assert media.sniff(frame.limit(0), "blob", "kind").count() == 0


def test_digests_are_those_of_the_padded_texts(spark):
    """Every digest against its expected value, from the bytes alone."""
    import zlib

    texts = [(1, "abc"), (2, None), (3, ""), (4, "é" * 96), (5, LONG), (5, LONG), (None, "x\ud800".encode("utf-8", "replace").decode())]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("media", F.lit("mine"))
    want = []
    for i, t in texts:
        b = (t or "").encode()
        full = b + b" " * (-len(b) % 192 if b else 192)
        stored = media.to_wav(full)
        want.append((i, len(b), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]), len(stored), hashlib.sha256(stored).hexdigest()))
    got = media.media_digest(media.text_media(frame)).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:7]) for r in got)


def test_words_in_use_go_to_the_library_once(monkeypatch):
    """A full cache drops no word that texts keep using; before, it kept only those of the texts at hand."""
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    lib = packing._tokenizer(path)

    class Counted:
        sent = 0

        def __getattr__(self, name):
            return getattr(lib, name)

        def encode(self, text, **kw):
            Counted.sent += text.count("xqz")
            return lib.encode(text, **kw)

        def encode_batch_fast(self, texts, **kw):
            Counted.sent += sum(t.count("xqz") for t in texts)
            return lib.encode_batch_fast(texts, **kw)

    monkeypatch.setitem(packing._TOKENIZERS, path, Counted())
    letters = str.maketrans("0123456789", "abcdefghij")
    common = [f"xqz{i}".translate(letters) for i in range(5000)]
    for batch in range(11):
        words = [f"yw{batch * 60_000 + i}".translate(letters) for i in range(60_000)] + common * (batch % 2 == 0)
        packing.encode_texts([" ".join(words)], path)
    assert Counted.sent == len(common)


def test_ids_equal_the_library_whatever_surrounds_plain_words():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    lib, rng = packing._tokenizer(path), random.Random(9)
    odd = ["".join(rng.choice("abSÉéßÀ×÷'ſtLlvE19!?. \t\n\x0b\x0c\r\x85\xa0́“漢😀İ") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    plain = ["".join(rng.choice("abSÉéßÀ×÷'tLlvrEmd19!?. \t\n\x0b\x0c\r") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts = [*odd, *plain, "", " ", "''s'S'LL", "<|endoftext|>a <|", "a\x1cb", "É" * 300 + " x“" + "a" * 300, "W" * 5000]
    for part in (texts, texts[::-1]):
        assert packing.encode_texts(part, path) == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]


def test_other_operators_tasks_drop_word_caches():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    own = batches.handing_back(lambda texts: (packing.encode_texts(t, path) for t in texts), "packing")
    assert [len(x) for x in own(iter([["a b"], ["c"]]))] == [1, 1] and packing._KNOWN and packing._TOKENIZERS
    assert list(own(iter([]))) == [] and packing._KNOWN
    assert list(batches.handing_back(lambda numbers: numbers)(iter([1, 2]))) == [1, 2]
    assert not packing._KNOWN and not packing._TOKENIZERS and not packing._ENDS


def test_reading_an_index_holds_one_copy_of_its_shares():
    rng = np.random.default_rng(3)
    terms = np.arange(200_000), rng.random(200_000) + 1
    rows = [(i, i % 2, (np.sort(rng.choice(200_000, 4000, replace=False)).astype(np.int32), rng.integers(1, 9, 4000).astype(np.int32))) for i in range(200)]
    index = toxicity.ToxicIndex(terms, rows, (100.0, 100.0))
    assert (index.share == index.log[index.tf] * np.repeat(index.idf, np.diff(index.start)) / index.norm[index.example]).all()
    data = pickle.dumps(index)
    tracemalloc.start()
    again = pickle.loads(data)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (again.share == index.share).all() and most < held + len(index.share) * 8


def test_similar_sets_share_as_many_signatures_as_promised():
    rng = np.random.default_rng(4)
    for num, parts, spared in ((80, 3, 1), (90, 3, 1), (90, 4, 2)):
        sign = jaccard_join.PartEnum(num, 100, parts, spared)
        for n in (1, 2, 4, 9, 10, 30, 100, 290, 400, 1110, 3000):
            a = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
            groups = sign.groups(sign.band(n))[0]
            cell = ((jaccard_join._mix(a.view(np.uint64) ^ jaccard_join._GOLD) >> np.uint64(32)) * np.uint64(groups * parts) >> np.uint64(32)).astype(int)
            one_a_cell = np.unique(cell, return_index=True)[1]  # the differences that spoil most groups come first
            for lost in (one_a_cell, one_a_cell[np.argsort(rng.random(len(one_a_cell)))], one_a_cell[np.argsort(cell[one_a_cell] % parts, kind="stable")]):
                for few in (n * (100 - num) // 100, n * (100 - num) // 200, 1):
                    b = np.delete(a, lost[:few])
                    if 100 * len(b) < num * n or not len(b):
                        continue
                    (kept_a, least_a), (kept_b, least_b) = sign.shares(len(a)), sign.shares(len(b))
                    promised = max(kept_a, kept_b) - sign.differences(len(a) + len(b))
                    if len(b) < len(a):
                        assert len(np.intersect1d(sign.signatures(a), sign.signatures(b))) >= promised >= max(least_a, least_b) >= 1


def _passages(n: int) -> list[tuple[int, str]]:
    """``n`` unlike texts that have a sixth of their words in common, and one near copy of every tenth."""
    rng = random.Random(5)
    common = " ".join(f"c{i}" for i in range(200))
    own = [[f"w{d}x{i}" for i in range(1000 + d % 7)] for d in range(n)]
    texts = [f"{common} {' '.join(words)}" for words in own]
    for d in range(0, n, 10):
        at = sorted(rng.sample(range(len(own[d])), 18))
        texts.append(f"{common} {' '.join(w if i not in at else 'y' + w for i, w in enumerate(own[d]))}")
    return list(enumerate(texts))


def test_a_passage_that_unlike_texts_share_makes_no_pairs(spark, monkeypatch):
    write, met = Scratch.write, []

    def spied(self, df):
        path = write(self, df)
        if "few" in df.columns:
            x, y = (self.spark.read.parquet(path).select("sig", "rid", "comp", "few").withColumnsRenamed({"rid": f"{k}r", "comp": f"{k}c", "few": f"{k}f"}) for k in "xy")
            met.append(x.where("xf").join(y, "sig").where("xc <> yc and (not yf or xr < yr)").count())
        return path

    monkeypatch.setattr(Scratch, "write", spied)
    rows = _passages(200)
    got = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: d if d < 200 else (d - 200) * 10 for d, _ in rows}
    assert len(met) == 1 and met[0] < 1000
