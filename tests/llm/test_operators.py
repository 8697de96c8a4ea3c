"""Each operator against a plain version of what it should give, on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sectorlens.llm import langid, mixing, neighbours, pii, queries, sharding, simhash, spm, syncmers, tokenids, topk
from tests.llm.fixtures import DOCS, as_rows, documents, empty, rows, sentences

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE, PIECES = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


# ---------------------------------------------------------------- 1 mixing


def plain_targets(sizes, weights, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rate > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * rate for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_meets_targets(spark):
    docs = documents(spark, clashing=True)
    got = mixing.mix_plan(docs).collect()
    sizes = Counter()
    for _, text, _, source, _ in rows():
        sizes[source] += len(WORD.findall(text or ""))
    want = plain_targets(dict(sizes), (1, 2, 3), 3)
    assert len(got) == len(rows())
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == math.floor(want[s]) for s in sizes)
    again = mixing.mix_plan(docs.repartition(3))
    assert as_rows(again.drop("source")) == sorted((tuple(r[c] for c in again.drop("source").columns) for r in got), key=str)


def test_mix_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 4)
    docs = documents(spark)
    split = as_rows(mixing.mix_plan(docs))
    monkeypatch.undo()
    assert split == as_rows(mixing.mix_plan(docs))


def test_mixed_documents_follow_the_plan(spark):
    docs = documents(spark, clashing=True, some=[r for r in rows() if r[0] != 5 and r[0] is not None])
    plan = {r["doc_id"]: r for r in mixing.mix_plan(docs).collect()}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    for i, r in plan.items():
        if r["size"]:
            assert abs(times[i] - r["taken"] / r["size"]) <= 0.5 + 1e-9, (i, times[i], r)


def test_mix_of_nothing(spark):
    assert mixing.mix_plan(empty(spark)).count() == 0
    assert mixing.mix_documents(empty(spark)).count() == 0
    blank = documents(spark, some=[(1, None, None, "a", 0), (2, " ", None, None, 0)])
    assert as_rows(mixing.mix_plan(blank).select("doc_id", "size", "target", "taken")) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


# ---------------------------------------------------------------- 2 token ids


@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


def test_segments_hold_the_ids_in_order(spark, byte_bpe, tmp_path):
    docs = documents(spark, clashing=True)
    tokenids.write_token_ids(docs, f"file://{tmp_path}/t", BYTE_BPE, 2)
    got = tokenids.read_token_ids(spark, f"file://{tmp_path}/t").orderBy("start").collect()
    want = Counter()
    for doc_id, text, *_ in rows():
        ids = np.array(byte_bpe.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)


def test_one_document_is_read_by_its_offset(byte_bpe):
    texts = ["one two", "", "three"]
    ids = [np.array(byte_bpe.encode(t).ids + [2], "<u2") for t in texts]
    import zstandard

    dictionary = b""
    frames = [zstandard.ZstdCompressor().compress(x.tobytes()) for x in ids]
    data = tokenids.pack([7, None, 9], frames, 2, hashlib.sha256(dictionary).digest())
    segment = tokenids.Segment(data, dictionary)
    assert segment.ids(2).tolist() == ids[2].tolist() and segment.valid.tolist() == [1, 0, 1]
    with pytest.raises(ValueError):
        tokenids.Segment(data, b"another")


def test_words_encode_as_in_the_whole_text(byte_bpe):
    pick = random.Random(1)
    alphabet = ["a", "B", " ", " ", "\n", "'s", "1", "é", "!", "\t", "日", "  ", "don't", "<|endoftext|>"]
    texts = ["".join(pick.choices(alphabet, k=pick.randint(0, 12))) for _ in range(3000)]
    got = tokenids.encode_texts(texts, BYTE_BPE, 4)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == byte_bpe.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_are_those_of_the_library(spark, byte_bpe, tmp_path):
    assert byte_bpe.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    pick = random.Random(12)
    parts = ["a", " ", "one", "<|endoftext|>", "<|endoftext|", "endoftext", "|>", "\n", "é", ".", "  "]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y"] + ["".join(pick.choices(parts, k=pick.randint(1, 9))) for _ in range(2000)]
    for text, ids in zip(texts, tokenids.encode_texts(texts, BYTE_BPE, 4)):
        assert np.frombuffer(ids, "<u4").tolist() == byte_bpe.encode(text, add_special_tokens=False).ids, repr(text)
    docs = documents(spark, some=[(i, t, None, None, 1) for i, t in enumerate(texts[:40])])
    tokenids.write_token_ids(docs, f"file://{tmp_path}/t", BYTE_BPE, 2)
    for r in tokenids.read_token_ids(spark, f"file://{tmp_path}/t").collect():
        ids = np.array(byte_bpe.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_dictionary_learns_from_long_and_nameless_documents(spark):
    """Only documents beyond a piece, all with null ids: there is a dictionary, and it shortens such documents."""
    import zstandard

    some = [(None, sentences(i, 9000), None, None, 1) for i in range(12)]
    assert all(len(r[1]) > tokenids.DICTIONARY_PIECE for r in some)
    data = tokenids.train_dictionary(documents(spark, some=some), BYTE_BPE, 2, 2)
    assert data
    one = tokenids.encode_texts([sentences(99, 60)], BYTE_BPE, 2)[0]
    plain, shared = (zstandard.ZstdCompressor(level=1, dict_data=d).compress(one) for d in (None, zstandard.ZstdCompressionDict(data)))
    assert len(shared) < len(plain)


def test_no_token_ids(spark, tmp_path):
    tokenids.write_token_ids(empty(spark), f"file://{tmp_path}/t", BYTE_BPE, 2)
    assert tokenids.read_token_ids(spark, f"file://{tmp_path}/t").count() == 0


# ---------------------------------------------------------------- 3 language


def test_language_of_every_text(spark):
    docs = documents(spark, clashing=True)
    got = {(r["doc_id"], r["lang_pred"]): r for r in langid.identify(docs).collect()}
    und = {k[0] for k in got if k[1] == "und"}
    assert und == {100, 101, 102, 106, None}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 3 == 1) for r in got.values())
    assert all(0 <= r["score"] <= 1 for r in got.values())
    cc = [got[i, "cc"] for i in range(40, 60) if (i, "cc") in got]
    assert len(cc) == 20


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs, "doc_id").filter("held_out and lang is not null")
    n = found.count()
    assert n > 200 and found.filter("lang = lang_pred").count() / n > 0.97


ALPHABETS = ["ab cd ef gi", "zu vo wy xa", "ñi öl ür ßé"]


@pytest.mark.parametrize("ids", ["none", "one"])
def test_no_language_is_lost_over_its_ids(spark, ids):
    """A language whose rows all have a null id, or all the same one of a learnable fold, is learnt."""
    learnable = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 3 != 1]
    for same in [None] if ids == "none" else learnable[:4]:
        some = [(i, sentences(i, 12, ALPHABETS[0]), "en", None, None) for i in range(1500)]
        some += [(same, sentences(10_000 + i, 12, ALPHABETS[1]), "zz", None, None) for i in range(8000)]
        got = langid.identify(documents(spark, some=some)).groupBy("doc_id", "lang_pred").count()
        assert got.filter("lang_pred = 'zz'").agg({"count": "sum"}).first()[0] == 8000


def test_language_of_one_text_many_times(spark):
    some = [(i, sentences(i, 12, ALPHABETS[0]), "en", None, None) for i in range(50)]
    some += [(None, sentences(1, 12, ALPHABETS[1]), "zz", None, None)] * 5000
    got = langid.identify(documents(spark, some=some))
    assert got.filter("lang_pred = 'zz'").count() == 5000


def test_more_languages_than_a_handful(spark):
    pick = random.Random(3)
    some = []
    for k in range(401):
        word = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=9))
        some += [(3 * k + i, f"{word} {word}", f"l{k:03d}", None, None) for i in range(3)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(documents(spark, some=some)).collect()}
    learnt = {r[2] for r in some if zlib.crc32(str(r[0]).encode()) % 3 != 1}
    right = [got[r[0]] == r[2] for r in some if r[2] in learnt]
    # two rows a language and three passes are little to learn from; none is lost
    assert len(learnt) > 350 and set(got.values()) <= learnt and sum(right) / len(right) > 0.7


def plain_grams(text):
    """Counts of hashed 1- to 3-grams, and the letters they come from."""
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    letters = re.sub(" +", " ", letters)
    counts = Counter()
    for k in (1, 2, 3):
        for i in range(len(letters) - k + 1):
            h = ord(letters[i])
            for c in letters[i + 1 : i + k]:
                h = (h * 2246822519 + ord(c)) % 2**32
            counts[((h * 2654435761 % 2**32) ^ ((h >> 15) * 3266489917 % 2**32)) >> 19] += 1
    return counts


def plain_ftrl(rows, labels, classes, alpha=0.3, beta=1.0, l1=0.02, l2=0.05, epochs=3):
    z, n = {}, {}

    def weight(f, k):
        x = z.get((f, k), 0.0)
        if abs(x) <= l1:
            return 0.0
        return -(x - math.copysign(l1, x)) / ((beta + math.sqrt(n.get((f, k), 0.0))) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            row = rows[i] | {"bias": 1.0}
            w = {(f, k): weight(f, k) for f in row for k in range(classes)}
            logit = [sum(v * w[f, k] for f, v in row.items()) for k in range(classes)]
            e = [math.exp(x - max(logit)) for x in logit]
            for k in range(classes):
                error = e[k] / sum(e) - (labels[i] == k)
                for f, v in row.items():
                    g, old = v * error, n.get((f, k), 0.0)
                    z[f, k] = z.get((f, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[f, k]
                    n[f, k] = old + g * g
    return lambda f, k: weight(f, k)


def test_model_equals_plain_numbers(spark):
    """Counts, TF-IDF, FTRL weights and temperature of a small table, each by the book."""
    some = [(i, sentences(i, 4 + i % 5, ALPHABETS[i % 3]), f"l{i % 3}", None, None) for i in range(0, 60)]
    learnt = [r for r in some if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    model = langid.fit(documents(spark, some=some))
    counts = {r[0]: plain_grams(r[1]) for r in learnt}
    for r in learnt:
        got = langid.text_counts(r[1])
        assert {int(f): int(got[f]) for f in np.flatnonzero(got)} == counts[r[0]]
    idf = {f: math.log((1 + len(learnt)) / (1 + sum(f in c for c in counts.values()))) + 1 for f in set().union(*counts.values())}
    for f, x in idf.items():
        assert abs(model.idf[f] - x) < 1e-5

    def vector(c):
        v = {f: math.log1p(n) * idf[f] for f, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {f: x / norm for f, x in v.items()}

    def drawn(r):  # the hash of id and text that orders the sample
        seed = 42
        for data in ((29).to_bytes(4, "little"), r[0].to_bytes(8, "little"), r[1].encode()):
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed >> 1

    train, kept = [], []
    for lang in ("l0", "l1", "l2"):
        mine = sorted((r for r in learnt if r[2] == lang), key=drawn)
        for nth, r in enumerate(mine, 1):
            (kept if nth % 5 == 0 else train).append((vector(counts[r[0]]), int(lang[1])))
    weight = plain_ftrl([v for v, _ in train], [k for _, k in train], 3)
    assert model.languages == ["l0", "l1", "l2"]
    for f in idf:
        for k in range(3):
            assert abs(model.weights[f, k] - weight(f, k)) < 1e-4
    assert all(abs(model.bias[k] - weight("bias", k)) < 1e-4 for k in range(3))

    def loss(t):
        total = 0.0
        for v, label in kept:
            logit = [(sum(x * weight(f, k) for f, x in v.items()) + weight("bias", k)) / t for k in range(3)]
            e = [math.exp(x - max(logit)) for x in logit]
            total -= math.log(e[label] / sum(e) + 1e-12)
        return total

    steps = [0.05 * 400 ** (i / 120) for i in range(121)]
    assert loss(model.temperature) <= min(map(loss, steps)) + 1e-6
    got = {r["doc_id"]: r for r in langid.predict(documents(spark, some=some), model).collect()}
    for r in some[:20]:
        v = vector({f: n for f, n in plain_grams(r[1]).items() if f in idf} or plain_grams(r[1])) if set(plain_grams(r[1])) <= set(idf) else None
        if v is None:
            continue
        logit = [(sum(x * weight(f, k) for f, x in v.items()) + weight("bias", k)) / model.temperature for k in range(3)]
        e = [math.exp(x - max(logit)) for x in logit]
        best = max(range(3), key=lambda k: e[k])
        assert got[r[0]]["lang_pred"] == f"l{best}" and abs(got[r[0]]["score"] - e[best] / sum(e)) < 1e-3


def test_nothing_to_learn(spark):
    assert langid.identify(empty(spark)).count() == 0
    unknown = documents(spark, some=[(0, "some text", None, "a", 1)])
    assert as_rows(langid.identify(unknown)) == [(0, False, "und", 0.0)]


def test_accepted_keeps_columns_and_clear_texts(spark):
    docs = documents(spark, clashing=True)
    kept = langid.accepted(docs, 0.5)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {100, 101, 102, 106} and set(range(40, 60)) <= ids


def test_elastic_net_makes_exact_zeros():
    rows_ = [(np.array([i % 2]), np.array([1.0])) for i in range(50)]
    w, _ = langid.ftrl(rows_, np.arange(50) % 2, 2, 8)
    assert w[0, 0] > 0 > w[0, 1] and not w[2:].any()


def test_temperature_flattens_overconfidence():
    logits = np.array([[9.0, 0], [9, 0], [9, 0], [0, 9]])
    assert langid.fit_temperature(logits, np.array([0, 0, 1, 1])) > 2


# ---------------------------------------------------------------- 4 pieces


@pytest.fixture(scope="module")
def model():
    return spm.Pieces(PIECES)


def awkward_text(pick, n):
    pool = ["a", "e", "th", "ing", " ", "  ", "    ", "\n", "日", "é", "🙂", "1", "▁", "xx", "aaaa", "ion", "er", ".", "\t", "zq"]
    return "".join(pick.choices(pool, k=n))


def test_scan_equals_the_library(model):
    pick = random.Random(4)
    for i in range(400):
        text = awkward_text(pick, pick.randint(1, 300))
        if i % 3 == 0:
            text = text.replace(" ", "").replace("▁", "")
        if not text:
            continue
        assert spm.encode_giant(model, text, pick.choice([64, 70, 128])) == model.sp.encode(text), repr(text)


def test_words_of_ordinary_texts(model):
    pick = random.Random(5)
    texts = [awkward_text(pick, pick.randint(0, 40)) for _ in range(2000)]
    for text, ids in zip(texts, model.encode_whole(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == model.sp.encode(text), repr(text)


def test_products_are_associative():
    random_ = np.random.default_rng(0)
    m = [np.where(random_.random((3, 3)) < 0.6, random_.integers(-9, 0, (3, 3)).astype(float), -np.inf) for _ in range(7)]
    step = m[0]
    for k, product in enumerate(spm.prefix_products(m)):
        step = m[0] if k == 0 else spm.times(step, m[k])
        assert np.array_equal(product, step)


def test_encode_table(spark, model):
    docs = documents(spark, clashing=True)
    got = spm.encode(docs, PIECES, chunk=256)
    assert Counter((r["row"]["doc_id"], tuple(r["ids"])) for r in got.collect()) == Counter(
        (d, tuple(model.sp.encode(t or ""))) for d, t, *_ in rows()
    )
    back = spm.decode(got, PIECES, [got["row.doc_id"], got["row.text"]], "doc_id long, text string")
    assert all(r["decoded"] == (r["text"] or "").replace("▁", " ") for r in back.collect())
    assert spm.encode(empty(spark), PIECES).count() == 0


# ---------------------------------------------------------------- 5 quality


def test_quality_votes(spark):
    marked = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(i, 1, 0) for i in range(40, 60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, clashing=True)
    got = neighbours.score_quality(docs, marked).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["score"] > 0.5 for r in got if r["doc_id"] in range(40, 60))
    none = neighbours.score_quality(docs, marked.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert neighbours.score_quality(empty(spark), marked).count() == 0


def test_votes_are_those_of_the_nearest():
    random_ = np.random.default_rng(2)
    v = neighbours._unit(random_.standard_normal((60, 5)))
    voters = neighbours.Voters(None, None, v[:40], (np.arange(40) % 2).astype(float), np.where(np.arange(40) % 2, 2.0, 1.0), 0.5)
    got = neighbours.votes(v[40:], voters)
    for x, s in zip(v[40:], got):
        near = sorted(range(40), key=lambda i: -(x @ v[i]))[: neighbours.NEIGHBOURS]
        w = [max(0, x @ v[i]) * voters.weights[i] for i in near]
        assert s == pytest.approx(sum(a for a, i in zip(w, near) if i % 2) / sum(w))


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = neighbours.score_quality(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    bad, good = got[got.quality == 0].score.to_numpy(), got[got.quality == 1].score.to_numpy()
    area = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert len(bad) > 50 and area > 0.9, area


# ---------------------------------------------------------------- 6 sharding


def test_shards_are_whole_even_and_gapless(spark, tmp_path):
    docs = documents(spark, clashing=True)
    sharding.write_shards(docs, f"file://{tmp_path}/s", 8, bucket_bytes=2000)
    got = spark.read.parquet(f"file://{tmp_path}/s").collect()
    assert Counter((r["record"]["doc_id"], r["record"]["text"], r["record"]["shard"]) for r in got) == Counter(
        (d, t, None if d is None else str(d)) for d, t, *_ in rows()
    )
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(slots) == 8 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shuffled(docs.repartition(2), 8, bucket_bytes=2000).collect()
    place = lambda rs: sorted(((r["record"]["doc_id"], r["record"]["text"], r["shard"], r["slot"]) for r in rs), key=str)
    assert place(got) == place(again)
    other = sharding.shuffled(docs, 8, seed=24, bucket_bytes=2000).collect()
    assert place(got) != place(other)


DOCS_NAMES = [c.split()[0] for c in DOCS.split(", ")]


class Mersenne:
    """The generator behind Spark's ``shuffle`` (MT19937, seeded by an array), and its bounded draws."""

    def __init__(self, seed):
        self.bits = np.random.MT19937()
        self.bits._legacy_seeding(np.array([seed >> 32, seed & 0xFFFFFFFF], np.uint32))

    def below(self, n):
        while True:
            drawn = int(self.bits.random_raw()) >> 1
            if n & (n - 1) == 0:
                return n * drawn >> 31
            value = drawn % n
            if drawn - value + n - 1 < 1 << 31:
                return value


def fisher_yates(n, generator):
    """Inside out: where each place's record comes from."""
    taken = [0] * n
    for i in range(n):
        j = generator.below(i + 1)
        taken[i] = taken[j]
        taken[j] = i
    return taken


@pytest.mark.parametrize("bucket_bytes", [10**9, 900])
def test_two_passes_by_hand(spark, bucket_bytes):
    """Scatter by hash, order inside the bucket, Fisher-Yates with the task's generator, cut into shards."""
    some = [(i % 190, sentences(i % 170, 6), "aa", f"s{i}", i) for i in range(200)]
    docs = documents(spark, some=some)
    total = sum(len((t or "").encode()) + 1 for _, t, *_ in some)
    buckets = max(1, math.ceil(total / bucket_bytes))
    keyed = docs.withColumn("order", F.xxhash64(F.lit(23), "doc_id", "text")).withColumn("own", F.xxhash64(F.lit(23), *DOCS_NAMES))
    keyed = keyed.withColumn("bucket", F.pmod("order", F.lit(buckets)).cast("int")).withColumn("task", F.pmod(F.hash("bucket"), F.lit(buckets)))
    tasks = defaultdict(lambda: defaultdict(list))
    for r in keyed.collect():
        tasks[r["task"]][r["bucket"]].append((r["order"], r["own"], r["n_chars"]))
    laid = {}
    for task, held in tasks.items():
        generator = Mersenne(23 + task)
        for bucket in sorted(held):
            ordered = [n for *_, n in sorted(held[bucket])]
            laid[bucket] = [ordered[i] for i in fisher_yates(len(ordered), generator)]
    line = [n for bucket in sorted(laid) for n in laid[bucket]]
    cuts = [k * len(line) // 8 for k in range(9)]
    want = {n: (k, i - cuts[k]) for k in range(8) for i, n in enumerate(line) if cuts[k] <= i < cuts[k + 1]}
    got = {r["record"]["n_chars"]: (r["shard"], r["slot"]) for r in sharding.shuffled(docs, 8, bucket_bytes=bucket_bytes).collect()}
    assert got == want


def test_rows_that_differ_in_other_columns_keep_their_order(spark):
    some = [(1, "same", "aa", f"s{i}", i) for i in range(60)]
    place = lambda df: {r["record"]["n_chars"]: r["slot"] for r in sharding.shuffled(df, 2, bucket_bytes=10**6).collect()}
    one = place(documents(spark, some=some))
    assert one == place(documents(spark, some=some[::-1]).repartition(3)) and len(one) == 60


def test_buckets_grow_beyond_a_number_of_them(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MOST_BUCKETS", 3)
    plan = sharding.shuffled(documents(spark), 4, bucket_bytes=10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and ", 3), REPARTITION_BY_NUM" in plan


def test_order_is_shuffled(spark):
    docs = documents(spark, some=[(i, "t", None, None, 1) for i in range(4000)])
    got = sharding.shuffled(docs, 1, bucket_bytes=1000).select("record.doc_id", "slot").collect()
    a, b = np.array([r["doc_id"] for r in got]), np.array([r["slot"] for r in got])
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.1
    assert sharding.shuffled(empty(spark), 8).count() == 0


def test_copies_equal_in_id_and_text_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_A_ROW", 7)
    some = [(None, "the same text", "aa", "src0", 13)] * 600 + [(None, "the same text", "bb", None, i % 200) for i in range(300)] + rows()
    docs = documents(spark, some=some).withColumn("tags", F.create_map(F.lit("k"), F.col("lang")))
    sharded = sharding.shuffled(docs, 4, bucket_bytes=1000)
    got = sharded.collect()
    whole = lambda r: str((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], r["tags"]))
    assert Counter(whole(r["record"]) for r in got) == Counter(whole(r) for r in docs.collect())
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 4
    # a copy stands beside others and not in one block of copies: a bucket holds few of them
    order = [r["record"]["text"] == "the same text" for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(order) == 900 and min(sum(order[i::4]) for i in range(4)) > 0
    spread = sharding.numbered(docs, F.xxhash64(F.lit(23), "doc_id", "text"), 23, 250.0)
    spread = spread.filter("record.text = 'the same text'").groupBy(F.pmod("order", F.lit(10)).alias("b")).count().collect()
    assert len(spread) == 10 and max(r["count"] for r in spread) < 150
    place = lambda rs: Counter((whole(r["record"]), r["shard"], r["slot"]) for r in rs)
    assert place(got) == place(sharding.shuffled(docs.repartition(3), 4, bucket_bytes=1000).collect())


# ---------------------------------------------------------------- 7 top-k


def plain_top(vectors, k, every):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, w) in enumerate(usable):
        if q is None or q % every:
            continue
        scored = [(-sum(a * b for a, b in zip(w, v)), math.inf if c is None else c) for m, (c, v) in enumerate(usable) if m != n]
        out += [(q, r + 1, None if c == math.inf else c, -s) for r, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_segments_fall_in_impact_and_bound_the_rest():
    pick = np.random.default_rng(4)
    rows_ = np.floor(pick.normal(0, 60, (50, 9))).astype(np.int64)
    for share in (0.0, 0.2, 1.0):
        segments = topk.impact_segments(rows_, share)
        levels = [(abs(int(x)) + topk.LEVEL - 1) // topk.LEVEL for _, r, d, _ in segments for x in rows_[r, d]]
        assert levels == sorted(levels, reverse=True) and len(levels) == np.count_nonzero(rows_)
        assert all((np.abs(rows_[r, d] - v) <= topk.LEVEL / 2).all() for _, r, d, v in segments)
    assert len(topk.impact_segments(rows_, 1.0)) == 1 < len(topk.impact_segments(rows_, 0.2)) <= 5
    assert topk.impact_segments(np.zeros((3, 2), np.int64)) == []
    index = topk.BlockIndex(rows_, np.arange(50))
    assert len(index.left) == len(index.segments) and (index.left[-1] <= topk.LEVEL / 2 * 3).all()
    queries = rows_[:10]
    for k in (1, 5, 60):
        possible = index.possible(queries, k)
        scores = rows_ @ queries.T
        for q in range(10):
            best = np.argsort(-scores[:, q], kind="stable")[: k + 1]
            assert possible[q, best].all()


def test_index_is_shuffled_once_for_all_packs(spark, monkeypatch):
    """Many packs of queries ask the same index; none of them moves it."""
    pick = random.Random(3)
    vectors = [(i, [pick.gauss(0, 0.2) for _ in range(6)]) for i in range(120)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "PACK_BYTES", 6 * 8 * 7)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 30)
    built = []
    packed = topk._packed
    monkeypatch.setattr(topk, "_packed", lambda *a: built.append(1) or packed(*a))
    exact = [(i, [float(np.float32(x)) for x in v]) for i, v in vectors]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table, 5, 2).collect()]
    assert sorted(got, key=str) == plain_top(exact, 5, 2) and len(built) == 1


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    pick = random.Random(8)
    vectors = [(i, [pick.gauss(0, 0.2) for _ in range(12)]) for i in range(80)]
    vectors += [(i, [0.25] * 12) for i in range(80, 95)]  # ties
    vectors += [(10, vectors[10][1]), (20, vectors[3][1]), (None, vectors[20][1]), (96, None), (97, [None] * 12), (98, [math.nan] * 12), (100, [0.0] * 12), (110, [1.0, math.inf])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as vector", "3 as block")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table, 5, 10).collect()]
    assert sorted(got, key=str) == plain_top(exact, 5, 10)


def test_top_k_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), 5, 50).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema), 5, 50).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [-2.0])], schema)
    assert as_rows(topk.top_k(two, 5, 50)) == [(0, 1, 1, -131072)]


# ---------------------------------------------------------------- 8 fingerprints


def plain_anchors(text):
    """Word hashes, and (position, hash) of the three-word anchors."""

    def h(*xs):
        seed = 42
        for x in xs:
            data = x.encode() if isinstance(x, str) else int(x).to_bytes(8, "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed - (1 << 64) if seed >> 63 else seed

    w = [h(x) for x in re.findall(r"[^\x20\x09-\x0D]{1,16}", text)]
    mers = [(i, h(*w[i : i + 3]) & 0xFFFFFFFF) for i in range(len(w) - 2) if min(w[i], w[i + 2]) <= w[i + 1]]
    return [x & 0xFFFFFFFF for x in w], mers


def plain_text(found):
    words, mers = found
    return "".join(f"{x:08x}" for x in words) + ("/" if mers else "") + ",".join(f"{i}:{x:08x}" for i, x in mers)


def plain_likeness(a, b):
    def cells(found, moved=0):
        words, mers = found
        return {(x, (i + moved) // 32) for i, x in [*enumerate(words), *mers]}

    def dice(x, y):
        return 1.0 if not x and not y else 2 * len(x & y) / (len(x) + len(y))

    best = dice(cells(a), cells(b))
    common = {x for _, x in a[1]} & {x for _, x in b[1]}
    if common:
        first = lambda found: next(i for i, x in found[1] if x == min(common))
        best = max(best, dice(cells(a), cells(b, first(a) - first(b))))
    return best


def likeness_of(spark, pairs):
    found = spark.createDataFrame(pairs, "a string, b string").withColumn("n", F.monotonically_increasing_id())
    x, y = syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))
    found = found.select("n", x.alias("x"), y.alias("y"))
    return [r["like"] for r in found.select("n", syncmers.likeness(F.col("x"), F.col("y")).alias("like")).orderBy("n").collect()]


def test_fingerprints(spark):
    docs = documents(spark, clashing=True)
    got = sorted(syncmers.fingerprints(docs).collect(), key=str)
    order = sorted(((d, t or "") for d, t, *_ in rows()), key=lambda x: (x[0] is None, -(x[0] or 0), xxhash.xxh64_intdigest(x[1].encode(), 42) ^ (1 << 63)))
    want = []
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, b, c = plain_anchors(t), plain_anchors(edited), plain_anchors(nxt)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_text(a), plain_text(b), plain_likeness(a, b), plain_likeness(a, c)))
    assert [tuple(r) for r in got] == sorted(want, key=str)


def test_only_texts_without_words_have_empty_fingerprints(spark):
    pick = random.Random(8)
    some = [(i, " ".join(pick.choices(["ab", "cd", "ef", "gh", "ij", "kl"], k=n)), None, None, 1) for i, n in enumerate([*range(30)] * 8)]
    for r in syncmers.fingerprints(documents(spark, some=some)).collect():
        words = some[r["doc_id"]][1].split()
        assert (r["fingerprint"] == "") == (not words) and len(r["fingerprint"].split("/")[0]) == 8 * len(words)


def test_half_of_a_text_is_seen_at_any_length(spark):
    pick = random.Random(9)
    word = lambda: f"w{pick.randrange(10**11, 10**12)}"
    some = [(i, " ".join(word() for _ in range(n)), None, None, 1) for i, n in enumerate([*range(2, 61)] * 4)]
    for r in syncmers.fingerprints(documents(spark, some=some)).collect():
        assert r["near_edited"] > 0.1 and r["near_next"] == 0


def test_a_word_less_is_alike_at_every_length(spark):
    pick = random.Random(10)
    word = lambda: f"w{pick.randrange(10**11, 10**12)}"
    pairs, plain = [], []
    for n in range(1, 61):
        for _ in range(6):
            words = [word() for _ in range(n)]
            gone = pick.randrange(n)
            pairs.append((" ".join(words), " ".join(words[:gone] + words[gone + 1 :])))
            plain.append((n, plain_likeness(plain_anchors(pairs[-1][0]), plain_anchors(pairs[-1][1]))))
    got = likeness_of(spark, pairs)
    assert got == [x for _, x in plain]
    for (n, _), x in zip(plain, got):
        assert x > 0.8 if n >= 12 else x >= 0.3 or n == 1
    assert likeness_of(spark, [(a, a) for a, _ in pairs]) == [1.0] * len(pairs)


def test_likeness_is_positional(spark):
    pick = random.Random(11)
    text = lambda n: [f"w{pick.randrange(10**8)}" for _ in range(n)]
    passage, head, left, right = text(12), text(200), text(150), text(150)
    pairs = [
        (passage, passage * 500), (left + right, right + left), (left + right, head + left + right), (left, right),
        (left + right, left + head[:1] + right), ([], []), ([], left), (["a"], ["a"]), (["a"], ["b"]),
    ]
    pairs = [(" ".join(a), " ".join(b)) for a, b in pairs]
    got = likeness_of(spark, pairs)
    assert got == [plain_likeness(plain_anchors(a), plain_anchors(b)) for a, b in pairs]
    repeated, swapped, behind, other, inserted, none, empty_, same, different = got
    assert repeated < 0.05 and 0.3 < swapped < 0.7 and behind > 0.75 and other == 0 and inserted > 0.9
    assert (none, empty_, same, different) == (1.0, 0.0, 1.0, 0.0)


def test_two_fingerprints_a_document(spark):
    """A document's own anchors are handed to its predecessor; only the edited text's are found besides."""
    plan = syncmers.fingerprints(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 2


def test_ranges_do_not_matter(spark):
    docs = documents(spark)
    one = syncmers.with_next(docs, {}).select("doc_id", "text", "next_text")
    many = syncmers.with_next(docs, {}, range_bytes=800).select("doc_id", "text", "next_text")
    assert as_rows(one) == as_rows(many)
    assert syncmers.fingerprints(empty(spark)).count() == 0
    single = syncmers.fingerprints(documents(spark, some=[(1, "only one", None, None, 1)])).collect()
    assert single[0]["near_next"] == 1.0


# ---------------------------------------------------------------- 9 personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def valid(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(digits)))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    kinds = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    found = [(k, m.start(), m.end()) for k, p in kinds.items() for m in p.finditer(text) if valid(k, m.group())]
    return sorted(found, key=lambda s: (s[1], list(kinds).index(s[0]), s[2]))


def test_base_spans_are_those_of_the_patterns():
    pick = random.Random(6)
    pool = ["a", ".", "@", "b-c", "x.yz", "1", "23", "255", "4111 1111 1111 1111", "4111111111111111", "+1 ", "(5", "-", " ", " ", "_", "%", "é", "0", "+44", "\n", "300", "¹", "٣"]
    for _ in range(6000):
        text = "".join(pick.choices(pool, k=pick.randint(1, 25)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 100_000, "1." * 100_000, "+1 " * 70_000, "@" * 200_000):
        pii.base_spans(text)
        pii.tokens(text)


def test_personal_data_table(spark):
    docs = documents(spark, clashing=True)
    got = pii.detect(docs, [docs.doc_id], "doc_id long").collect()
    assert len(got) == len(rows())
    for r in got:
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
    hit = next(r for r in got if r["doc_id"] == 108)
    assert [s["kind"] for s in hit["base"]] == ["email", "ip", "phone", "card"]
    clean = [r for r in got if r["doc_id"] in range(60)]
    assert not any(r["spans"] for r in clean)
    assert pii.detect(empty(spark), ["doc_id"], "doc_id long").count() == 0


def test_masking(spark):
    docs = documents(spark, clashing=True)
    kept = pii.redact(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows())
    text = next(r["text"] for r in kept.collect() if r["doc_id"] == 108)
    assert text.startswith("mail <EMAIL> or <IP> or <PHONE> or <CARD>")


def test_rare_active_documents_teach_the_field(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 5)
    plain = [(i, sentences(i, 3), None, None, 1) for i in range(3000)]
    rare = [(i, f"call +1 ({200 + i % 700}) 555-{1000 + i % 9000} today", None, None, 1) for i in range(5000, 5010)]
    unknown = [(None, f"mail ann{i}@x.org now", None, None, 1) for i in range(10)]
    for some in (plain + rare, plain + unknown):
        w = pii.fit(documents(spark, some=some))
        assert np.count_nonzero(w["unary"][:, 1:])
    assert not np.count_nonzero(pii.fit(documents(spark, some=plain[:20]))["unary"][:, 1:])


def test_stretches_that_pass_alone_are_taught():
    graph = pii.Graph()
    graph.add(0, "page 3 or +1 (269) 555-3296 4012888888881881, paid 4111 1111 1111 1111 5500 0000 0000 0004", [], teach=True)
    assert graph.gold == [0, *[4] * 3, *[3] * 9]


def skip_chain_model():
    texts = [f"write ann{i}.b@mail{i % 7}.org or call +1 ({200 + i}) 555-{1000 + i} today, {i} times" for i in range(150)]
    texts += [f"again jo{i}@mail{i % 5}.net and then jo{i}@mail{i % 5}.net, page {i} of 12.5" for i in range(80)]
    graph = pii.Graph()
    for i, t in enumerate(texts):
        graph.add(i, t, pii.base_spans(t))
    return pii.learn(graph)


def test_skip_links_carry_labels_to_distant_tokens():
    w = skip_chain_model()
    assert w["skip"][0] > 0
    text = "call +1 (555) 555-2485 " + "word " * 200 + "or 555-2485 again"
    alone = "word " * 200 + "or 555-2485 again"

    def phone(t):
        graph = pii.Graph()
        graph.add(0, t, pii.base_spans(t))
        return pii.marginals(graph, w)[-1, 4]

    assert phone(text) > phone(alone)


def test_repeats_of_a_base_span_are_found_however_many():
    w = skip_chain_model()
    w["unary"][:, 0] += 1.5  # by its shape alone the token is outside
    again = "word " * 9 + "or 555-2485 "
    text = "call +1 (555) 555-2485 now " + again * 60
    (base, spans), (_, alone) = pii.find_spans([text, again * 60], w)
    assert len(base) == 1 and alone == []
    assert len(spans) == 61 and {(k, text[a:b]) for k, a, b in spans[1:]} == {("phone", "555-2485")}


def test_labels_under_base_spans_are_given():
    w = {"unary": np.zeros((pii.FEATURES, pii.LABELS)), "chain": np.zeros((pii.LABELS, pii.LABELS)), "skip": np.array([3.0, 2.0])}
    w["unary"][0, 0] = 9.0
    graph = pii.Graph()
    text = "of 10.0.0.1 and 4.5"
    graph.add(0, text, pii.base_spans(text))
    p = pii.marginals(graph, w)
    assert p[0, 2] > 0.999 and p[1, 0] > 0.99


def test_neighbours_that_spoil_each_other_are_both_found():
    texts = [f"call +1 ({200 + i}) 555-{1000 + i} today, {i} times" for i in range(100)]
    texts += [f"page {i} of 12.5, paid by {c} in full" for i, c in enumerate(["4111111111111111", "4012888888881881"] * 40)]
    graph = pii.Graph()
    for i, t in enumerate(texts):
        graph.add(i, t, pii.base_spans(t))
    for i in range(40):  # beside an address, the card's digits are one failing match with the address's last part
        t = f"from 10.2.{i}.7 4111111111111111 at {i}"
        graph.add(200 + i, t, pii.base_spans(t), teach=True)
    w = pii.learn(graph)
    ((base, spans),) = pii.find_spans(["to 10.20.30.40 4012888888881881 now"], w)
    assert base == [("ip", 3, 14)] and spans == [*base, ("card", 15, 31)]
    text = "or +1 (269) 555-3296 4012888888881881 and +1 (269) 555-3296 4012888888881882"
    (base, spans), (_, clean) = pii.find_spans([text, "of 2001 2002 and 4012888888881882, version 4.0"], w)
    assert base == [] and clean == []
    assert spans == [("phone", 3, 20), ("card", 21, 37), ("phone", 42, 59)]
    assert pii.masked(text, spans) == "or <PHONE> <CARD> and <PHONE> 4012888888881882"


def test_grouped_cards_side_by_side_are_both_found():
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881", "3782 8224 6310 005"]
    graph = pii.Graph()
    for i in range(120):
        t = f"page {i} of 12.5, paid by {cards[i % 4]} in full" if i % 2 else f"call +1 ({200 + i}) 555-{1000 + i} today, {i} times"
        graph.add(i, t, pii.base_spans(t))
    w = pii.learn(graph)
    pair, three = f"paid by {cards[0]} {cards[1]} now", f"paid by {cards[0]} {cards[1]} {cards[2]} now"
    further, none = f"paid by {cards[0]} 2024 1111 now", "paid by 4111 1111 1111 1112 5500 0000 0000 0005 now"
    found = pii.find_spans([pair, three, further, none], w)
    assert all(base == [] for base, _ in found)
    assert [spans for _, spans in found] == [
        [("card", 8, 27), ("card", 28, 47)], [("card", 8, 27), ("card", 28, 47), ("card", 48, 67)], [("card", 8, 27)], [],
    ]
    assert pii.masked(pair, found[0][1]) == "paid by <CARD> <CARD> now"


def test_messages_on_a_tree_are_exact():
    w = {"unary": np.random.default_rng(1).standard_normal((pii.FEATURES, pii.LABELS)), "chain": np.random.default_rng(2).standard_normal((pii.LABELS, pii.LABELS)), "skip": np.array([0.7, 0.3])}
    graph = pii.Graph()
    graph.add(0, "12 34 56.7", [])
    unary = graph.features() @ w["unary"]
    assert graph.chain == [(0, 1), (1, 2)]
    weight = np.exp(unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None] + w["chain"][:, :, None] + w["chain"][None])
    want = np.stack([weight.sum((1, 2)), weight.sum((0, 2)), weight.sum((0, 1))]) / weight.sum()
    assert np.allclose(pii.marginals(graph, w, rounds=60), want, atol=1e-6)


# ---------------------------------------------------------------- 10 near duplicates


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints, most=4):
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                label[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_table(spark):
    base = sentences(77, 120).split()
    near = [(200 + i, " ".join(base[:i] + ["Changed"] + base[i + 1 :]), None, None, None) for i in range(0, 60, 3)]
    some = rows() + near + [(300 + i, "  Copy me  ONCE more please ", None, None, None) for i in range(30)]
    got = simhash.near_duplicates(documents(spark, clashing=True, some=some).repartition(7)).collect()
    prints = [plain_fingerprint(t) for _, t, *_ in some]
    roots = plain_components(prints)
    lowest = {}
    for (d, *_), r in zip(some, roots):
        if d is not None:
            lowest[r] = min(d, lowest.get(r, d))
    want = Counter((d, p, lowest.get(r)) for (d, *_), p, r in zip(some, prints, roots))
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want


@pytest.mark.parametrize("cell_rows", [5, 2048])
def test_every_link_is_found(spark, cell_rows):
    pick = random.Random(9)
    prints = [pick.getrandbits(64) for _ in range(150)]
    for p in prints[:60]:
        q = p
        for _ in range(pick.randint(1, 8)):
            for b in pick.sample(range(64), pick.randint(1, 4)):
                q ^= 1 << b
            prints.append(q)
    prints = sorted(set(prints))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(i, signed(p)) for i, p in enumerate(prints)], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.near_classes(table, cell_rows=cell_rows).collect()}
    roots = plain_components(prints)
    lowest = {}
    for i, r in enumerate(roots):
        lowest.setdefault(r, i)
    assert got == {signed(p): lowest[r] for p, r in zip(prints, roots)}


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4, 5, 6])
def test_every_link_is_found_at_any_distance(spark, most):
    pick = random.Random(most)
    prints = {pick.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(3):
            q = p
            for b in pick.sample(range(64), pick.randint(1, 8)):
                q ^= 1 << b
            prints.add(q)
    prints |= {0, 2**64 - 1, 3, 0x5555555555555555, 0xAAAAAAAAAAAAAAAA}
    prints = sorted(prints)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = plain_components(prints, most)
    for groups in (None, most + 2, most + 4):
        found = simhash.links(table, most, 16, groups).collect()
        place = {signed(p): i for i, p in enumerate(prints)}
        assert all((prints[place[r["a"]]] ^ prints[place[r["b"]]]).bit_count() <= most for r in found) or most > 0
        label = list(range(len(prints)))
        for _ in range(len(prints)):
            before = list(label)
            for r in found:
                a, b = place[r["a"]], place[r["b"]]
                label[a] = label[b] = min(label[a], label[b])
            if label == before:
                break
        assert [label[i] == label[j] for i in range(len(prints)) for j in range(i)] == [roots[i] == roots[j] for i in range(len(prints)) for j in range(i)]


def test_counts_bound_the_distance():
    pick = random.Random(2)
    prints = np.array([pick.getrandbits(64) for _ in range(400)], np.uint64)
    counts = simhash._counts(prints)
    for i in range(0, 398, 2):
        places = [[(int(p) >> 2 * k & 3).bit_count() for k in range(32)] for p in prints[i : i + 2]]
        manhattan = sum(abs(a - b) for a, b in zip(*places))
        assert int(np.bitwise_count(counts[i] ^ counts[i + 1])) == manhattan <= (int(prints[i]) ^ int(prints[i + 1])).bit_count()


def test_more_fingerprints_get_more_groups(spark):
    """Candidates of a fingerprint fall with the number of groups; the chosen number grows with the table."""
    sizes = [simhash.groups_for(n, 4) for n in (1000, 250_000, 10**7, 10**8, 10**9)]
    assert sizes == sorted(sizes) and sizes[0] == 6 and sizes[1] < sizes[-2] < sizes[-1]
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4, groups=4)
    pick = random.Random(7)
    table = spark.createDataFrame([(pick.getrandbits(63),) for _ in range(4000)], "fp long")
    met = []
    for groups in (5, 6, 7, 8):
        rows_ = simhash._cells(table, 4, groups).groupBy("cell").count()
        met.append(rows_.selectExpr("sum(count * (count - 1)) / 4000 AS candidates").first()[0])
    assert met[0] > 2 * met[1] > 4 * met[2] > 8 * met[3]


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark, clashing=True)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    roots = plain_components([plain_fingerprint(t) for _, t, *_ in rows()])
    ids = [r["doc_id"] for r in kept.collect()]
    want = []
    for root in set(roots):
        group = [d for (d, *_), r in zip(rows(), roots) if r == root]
        want.append(min((d for d in group if d is not None), default=None))
    assert sorted(map(str, ids)) == sorted(map(str, want))


def test_no_near_duplicates(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each(empty(spark)).count() == 0
