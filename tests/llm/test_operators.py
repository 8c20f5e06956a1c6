"""Every operator against a plain version, on awkward rows and on a given table."""

import itertools
import math
import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from textloom.llm import bpe, decontaminate, embeddings, language, sharding, simhash, substring  # noqa: E402
from textloom.llm import token_counts, toxicity, warc  # noqa: E402
from textloom.llm.common import table  # noqa: E402
from textloom.llm.components import components  # noqa: E402

SF = "/root/testdata/sf0.001"
EXTRA = ["_llm_id", "_spans", "l", "n", "fp", "score", "kept_text", "hit_spans", "label", "text_crc32"]


def awkward():
    pick = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(pick.choice(words) for _ in range(60_000))
    part = " ".join(pick.choice(words) for _ in range(60))
    body = " ".join(pick.choice(words) for _ in range(300))
    near = body.replace(" ", "  ", 3).split(" ")
    near[50] = "other"
    texts = [None, None, "", "", " \n\t", "one", "Two words", "!!! ???", "été 日本語 😀 <|endoftext|> x", long]
    texts += [f"a {part} b", f"{part} c {part}", body, body, " ".join(near), body.upper(), long + " tail", "z " * 80]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, "one"), (12, body), (6, f"again {part}")]  # a repeated row, a repeated copy, an id used twice
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.withColumns({c: F.lit("x") for c in EXTRA}).repartition(3)


@pytest.fixture(scope="module")
def given(spark):
    frame = table(spark, SF, "documents").select("doc_id", "text")
    return frame, [tuple(r) for r in frame.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def result(frame):
    return sorted(map(tuple, frame.collect()))


def test_simhash(docs, rows, given):
    assert [simhash.fingerprint(t) for _, t in rows] == [brute.simhash(t) for _, t in rows]
    assert result(simhash.op1(given[0])) == brute.op1(given[1])
    unique = [r for r in rows if r[0] != 6]  # equal ids of different texts may not be told apart
    assert result(simhash.op1(docs.filter("doc_id != 6"))) == brute.op1(unique)


def test_fingerprint_links_and_hot_tries(spark):
    pick = np.random.default_rng(1)
    codes = pick.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    flips = [c ^ np.uint64(sum(1 << int(b) for b in pick.choice(64, k, replace=False))) for k in (1, 3, 4, 5, 6) for c in codes[:40]]
    hot = np.uint64(0xABCDEF0123456789) ^ pick.integers(0, 1 << 12, 400, dtype=np.uint64)
    codes = np.unique(np.concatenate([codes, np.array(flips, np.uint64), hot]))
    want = brute.components(len(codes), [
        (i, j) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 4).tolist() if j > i
    ])
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    where = {int(c): i for i, c in enumerate(codes.view(np.int64))}
    for leaves in (8192, 32):
        links = [(where[r.a], where[r.b]) for r in simhash.fingerprint_links(frame, 4, leaves).collect()]
        assert brute.components(len(codes), links) == want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (129, 100)]
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 31)} | {i: 100 for i in range(101, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_warc(spark, tmp_path):
    big = "<p>é" + "x" * 200
    pages = [(3, "http://a", big), (1, "http://b", big), (2, "u\r\nX: y", "small"), (4, None, "small"), (5, "c", None), (6, "d", ""), (1, "http://b", big), (None, "e", big)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    assert [r[3:5] for r in sorted(map(tuple, warc.op2(frame).collect()), key=str)] == [
        ("response", None), ("response", None), ("response", None), ("revisit", 1), ("response", None), ("response", None), ("response", None), ("revisit", 1)
    ]
    path = str(tmp_path / "archive")
    warc.write_archive(frame, path)
    assert warc.read_payloads(spark, path).count() == 3
    for r in warc.read_archive(spark, path).collect():
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert len(block) == int(fields["Content-Length"]) + 4
        assert fields["WARC-Payload-Digest"] == "sha256:" + brute.sha(bytes(r.payload))
        body = block.split(b"\r\n\r\n", 1)[1][:-4]
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
    ids = [(r.page_id, r.url, r.refers_to, r.record) for r in warc.read_archive(spark, path).collect()]
    assert {u for _, u, _, _ in ids} == {"http://a", "http://b", "u%0D%0AX: y", None, "c", "d", "e"}
    names = [re.search(rb"WARC-Record-ID: (<.*?>)", r)[1] for _, _, _, r in ids]
    assert len(set(names)) == len(ids) - 1  # but for one row that is given twice
    assert {re.search(rb"WARC-Refers-To: (<.*?>)", r)[1] for _, _, to, r in ids if to is not None} <= set(names)
    damaged = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"zzz"))
    damaged.write.parquet(str(tmp_path / "bad/payloads"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_payloads(spark, str(tmp_path / "bad")).collect()
    assert warc.op2(frame.limit(0)).count() == 0


def test_sharding(spark, docs, rows, given, empty):
    for frame, source, shards in ((docs, rows, 4), (given[0], given[1], 40), (docs, rows, 40)):
        got = sharding.balanced_shards(frame, shards).toPandas()
        counts = got.groupby("shard").size().reindex(range(shards), fill_value=0)
        assert len(got) == len(source) and counts.max() - counts.min() <= 1
        for _, slots in got.groupby("shard").slot:
            assert sorted(slots) == list(range(len(slots)))
        want = sorted((i, len((t or "").encode()) + 16, brute.zlib.crc32((t or "").encode())) for i, t in source)
        assert sorted(got[["doc_id", "size", "text_crc32"]].itertuples(index=False, name=None)) == want
    assert sharding.op3(empty).count() == 0


def test_sharding_keeps_copies_together(spark):
    texts = [f"group {i % 30}" if i < 120 else ("hot" if i < 250 else f"own {i}") for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.balanced_shards(frame, 8).toPandas().sort_values("doc_id")
    got["text"] = texts
    spread = got.groupby("text").shard.nunique()
    assert spread["hot"] <= 4 and (spread[[f"group {i}" for i in range(30)]] == 1).mean() > 0.9
    sizes = got.text.value_counts()
    links = sum(n * (n - 1) // 2 for n in sizes)
    inside = sum(n * (n - 1) // 2 for n in got.groupby(["text", "shard"]).size())
    report = sharding.cut_groups(sharding.balanced_shards(frame, 8)).first()
    assert report.n_groups == (sizes > 1).sum() and report.n_needed == (sizes > 50).sum()
    assert (report.n_cut, report.cut_links) == ((spread > 1).sum(), links - inside)


def test_sharding_of_rows_without_ids(spark):
    texts = ["hot"] * 150 + [f"group {i % 20}" for i in range(100)] + [None] * 40
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = sharding.balanced_shards(frame, 8).toPandas()
    assert len(got) == len(texts) and got.groupby("shard").size().between(36, 37).all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert sharding.cut_groups(sharding.balanced_shards(frame.limit(0), 8)).first().n_groups == 0


def test_substring(docs, rows, given, empty):
    assert result(substring.op4(docs)) == brute.op4(rows)
    assert result(substring.op4(given[0])) == brute.op4(given[1])
    assert substring.op4(empty).count() == 0


def test_substring_with_small_windows(spark):
    pick = random.Random(5)
    rows = [(i, " ".join(pick.choice("abc") for _ in range(pick.randrange(40)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = substring.remove_repeats(frame, 8, 3)
    got = kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert result(got) == brute.op4(rows, 8)


def test_embeddings(spark):
    pick = np.random.default_rng(2)
    base = pick.standard_normal((60, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 10] + pick.standard_normal(16) * 0.08 * (i % 7)).tolist(), (i % 10) % 3) for i in range(120)]
    rows += [(300 + i, base[1].tolist(), 1) for i in range(30)] + [(1, base[1].tolist(), 1)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, base[1].tolist(), None), (404, [], 1)]
    rows += [(405, [float("inf")] + [1.0] * 15, 1), (406, [None] * 16, 1), (407, base[1][:8].tolist(), 1), (408, (base[1] * 3).tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cid", F.lit(1))
    want = brute.op5(rows)
    for block in (embeddings.BLOCK, 20):
        embeddings.class_links.__defaults__ = (embeddings.MIN_COSINE, block)
        got = sorted(tuple(r)[:3] for r in embeddings.op5(frame).collect())
        links, found = sum(w[1] for w in want), sum(g[1] for g in got)
        assert [g[0] for g in got] == [w[0] for w in want] and found == links
    embeddings.class_links.__defaults__ = (embeddings.MIN_COSINE, embeddings.BLOCK)
    assert embeddings.op5(frame.limit(0)).count() == 0


def test_pairs_at_the_threshold_share_a_bucket():
    pick = np.random.default_rng(4)
    for dim in (64, 384):
        a = embeddings.units(pick.standard_normal((40_000, dim)))
        side = pick.standard_normal(a.shape)
        side = embeddings.units(side - (side * a).sum(axis=1, keepdims=True) * a)
        b = embeddings.MIN_COSINE * a + math.sqrt(1 - embeddings.MIN_COSINE**2) * side
        missed = (embeddings.bucket_codes(a) != embeddings.bucket_codes(b)).all(axis=1)
        assert missed.mean() < 1e-4


def test_estimates_are_unbiased_and_bounded():
    pick = np.random.default_rng(5)
    dim = 64
    a = embeddings.units(pick.standard_normal((4000, dim)))
    b = embeddings.units(a + 0.05 * pick.standard_normal(a.shape))
    code, factor = embeddings.stored_codes(b)
    signs = (np.unpackbits(code, axis=1, count=dim) * 2.0 - 1) / math.sqrt(dim)
    estimate = ((a @ embeddings.rotation(dim, 0)) * signs).sum(axis=1) / factor
    error = np.sqrt((1 - factor**2) / factor**2 / (dim - 1))
    off = estimate - (a * b).sum(axis=1)
    assert abs(off.mean()) < 0.005 and (np.abs(off) < embeddings.BOUND * error).mean() > 0.999


def test_language_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "bab", "▁ab"])
    chance = np.random.default_rng(0).random((len(pieces) + 1, 2))
    words = ["▁abab", "▁bbab", "▁xab", "▁"]

    def total(word):
        if not word:
            return np.ones(2)
        out = np.zeros(2)
        for n in range(1, len(word) + 1):
            i = pieces.index(word[:n]) if word[:n] in pieces else len(pieces) if n == 1 else None
            if i is not None:
                out = out + chance[i] * total(word[n:])
        return out

    got = language.word_scores(words, language.Lattice(pieces), chance)
    assert np.allclose(got, [np.log(total(w)) for w in words])


def test_language(spark, docs, empty):
    sample = table(spark, "/root/testdata/sf0.01", "documents")
    both = language.op6(sample).join(sample.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(both) > 100 and (both.lang_pred == both.lang).mean() >= 0.95
    model = language.fit(sample.limit(300))
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert got[0, None] == got[2, ""] == got[4, " \n\t"] == got[7, "!!! ???"] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got.values()) and got[6, "Two words"][0] in model["langs"]
    nothing = language.op6(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.op6(empty).count() == 0


def test_decontamination(spark, docs, rows, given):
    items = [(1, " ".join(rows[12][1].split()[20:40])), (10, "one"), (2, "TWO words"), (3, None), (4, ""), (9, "日本語"), (9, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.op7(rows, items)
    assert sum(w[-1] for w in want) >= 7
    assert result(decontaminate.op7(docs, bench)) == want
    split = decontaminate.find_contamination(docs, bench, block_bytes=40)
    assert sorted((r.doc_id, len(r.hit_items)) for r in split.collect()) == sorted((w[0], w[3]) for w in want)
    real = table(spark, SF, "benchmark")
    assert result(decontaminate.op7(given[0], real)) == brute.op7(given[1], [tuple(r) for r in real.collect()])
    assert not any(w[-1] for w in result(decontaminate.op7(docs, bench.limit(0))))


def test_bpe_and_token_counts(docs, rows, given, empty):
    import sentencepiece
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(bpe.tokenizer_path())
    pieces = sentencepiece.SentencePieceProcessor(model_file=token_counts.tokenizer_path())
    odd = ["aaaaa" * 30, "it's I'LL 's", "\x00\x1c\x1f \x85\xa0", "x \n\n  y ", "½²٣ é", " ▁a  b▁ ", "<s></s>"]
    extra = docs.sparkSession.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for frame, source in ((docs, rows), (given[0], given[1]), (extra, list(enumerate(odd)))):
        ids = [(i, whole.encode(t or "", add_special_tokens=False).ids) for i, t in source]
        spelled = [(i, len(x), brute.sha(",".join(map(str, x))), brute.sha(whole.decode(x, skip_special_tokens=False))) for i, x in ids]
        assert result(bpe.op8(frame)) == sorted(spelled)
        counts = [(i, len((t or "").encode()), len(pieces.encode(t or ""))) for i, t in source]
        assert [r[:3] for r in result(token_counts.op10(frame))] == sorted(counts)
        back = bpe.decode_ids(bpe.encode_texts(frame))
        assert result(back) == sorted((i, t or "") for i, t in source)
    assert bpe.op8(empty).count() == token_counts.op10(empty).count() == 0


def test_toxic_segments_are_the_maximal_ones():
    pick = random.Random(9)
    for _ in range(200):
        gains = {i: pick.choice([0.5, 1.0, 2.0]) for i in range(14) if pick.random() < 0.4}
        values = [gains.get(i, -0.25 * 2) for i in range(14)]
        got = toxicity.segments(sorted(gains), [gains[i] for i in sorted(gains)], 0.5)

        def best(lo, hi):  # the best segment, then the same on both sides of it
            spans = [(sum(values[a:b]), -(b - a), -a, a, b) for a, b in itertools.combinations(range(lo, hi + 1), 2)]
            top = max(spans, default=(0,))
            if top[0] <= 0:
                return []
            return best(lo, top[3]) + [top[0]] + best(top[4], hi)

        assert math.isclose(sum(s for s, _, _ in got), sum(best(0, 14)))
        assert len(got) == len(best(0, 14))


def test_toxicity(spark, docs, empty):
    sample, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.op9(sample, labels).join(labels, "doc_id").filter("held_out").toPandas()
    hits = found[found.predicted == 1]
    assert (hits.toxic == 1).mean() > 0.95 and len(hits) > 0.6 * (found.toxic == 1).sum()
    marks = spark.createDataFrame([(0, 1), (2, None), (3, 0), (None, 1), (5, 0), (5, 1)], "doc_id long, toxic int")
    got = toxicity.op9(docs, marks).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in toxicity.op9(docs, marks.limit(0)).collect()} == {0}
    assert toxicity.op9(empty, marks).count() == 0
