"""SentencePiece lattices, toxicity, packing and fingerprints."""
import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import imatch, packing, pieces, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 0.5) for i, t in rows],
                                 "doc_id long, text string, fingerprint string, length int, score double")


def every_way(v, word):
    """All segmentations of a word: (score, ids)."""
    ways = [[(0.0, ())]] + [[] for _ in word]
    edges = v.edges(word)
    for end in range(1, len(word) + 1):
        for a, b, ids, s in edges:
            if b == end:
                ways[end] += [(x + s, w + ids) for x, w in ways[a]]
    return sorted(ways[-1], key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["the cat", "aaaa bb", "Ünïcödé 漢\U0001f600 x", "a\nb  c", " lead", "x"])
def test_n_best_against_all(text):
    v = pieces.vocabulary(MODEL)
    whole = v.model.normalize(text)
    want = every_way(v, whole)
    got = v.encode(text, 6)
    assert np.allclose([s for s, _ in got], [s for s, _ in want[:6]])
    assert len({tuple(i.tolist()) for _, i in got}) == len(got) == min(6, len(want))
    assert all(v.decode(i.tolist()) == text for _, i in got)
    assert {(round(s, 6), tuple(i.tolist())) for s, i in got} <= {(round(s, 6), i) for s, i in want}


def test_n_best_of_long_texts():
    rng = random.Random(4)
    v = pieces.vocabulary(MODEL)
    words = ["then", "that", "oneing", "a", "tion.\n", "schön", "blestion"]
    for n in (3, 80, 300):
        text = " ".join(rng.choice(words) for _ in range(n))
        chosen = v.words.findall(v.model.normalize(text))
        lists = [every_way(v, w)[:6] for w in chosen]
        sums = [0.0]
        for ways in lists:
            sums = sorted((a + s for a, (s, _) in itertools.product(sums, ways)), reverse=True)[:6]
        assert np.allclose([s for s, _ in v.encode(text, 6)], sums)


def test_encode_and_decode(spark):
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "x"), (1, "hello world"), (4, "a " * 5000), (5, "\x00<s>")]
    got = pieces.encode(frame(spark, rows), MODEL, n=3)
    assert got.where("not round_trip").count() == 0
    assert got.where("rank = 1").count() == len(rows)
    texts = {(r.doc_id, r.text) for r in pieces.decode(got, MODEL).collect()}
    assert texts == {(i, t or "") for i, t in rows}
    r = got.where("doc_id = 1 and rank = 1").first()
    assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_pieces == len(r.ids)
    assert pieces.encode(frame(spark, []), MODEL).collect() == []


def made_up(n, seed=0):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgk" for b in ("an", "or", "ist", "el", "um")]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if bad:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["idiotic", "rotten", "vile"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = made_up(1500)
    extra = [(5000, None), (5001, ""), (None, "vile"), (7, rows[7][1]), (5002, "vile " * 30000)]
    marks = spark.createDataFrame(labels + [(None, 1), (9999, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score_documents(frame(spark, rows + extra), marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert r.held_out == held
    judged = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(judged) > 200 and sum(a == b for a, b in judged) / len(judged) > 0.99
    clean = toxicity.keep_clean(frame(spark, rows), marks)
    assert clean.columns == ["doc_id", "text", "fingerprint", "length", "score"]
    assert abs(clean.count() - sum(1 - y for _, y in labels)) < 10


def plain_ftrl(rows, labels, alpha, beta, l1, l2, epochs, min_rows, seed):
    """FTRL-proximal, a coordinate at a time."""
    often = {f for f, n in collections.Counter(f for r in rows for f in r).items() if n >= min_rows} | {"intercept"}
    z, n, w = collections.Counter(), collections.Counter(), {}

    def weight(f):
        bound = 0 if f == "intercept" else l1
        if abs(z[f]) <= bound:
            return 0.0
        return -(z[f] - math.copysign(bound, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    order, draw = np.arange(len(rows)), np.random.RandomState(seed)
    for _ in range(epochs):
        draw.shuffle(order)
        for i in order:
            own = [f for f in [*rows[i], "intercept"] if f in often]
            w = {f: weight(f) for f in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[i]
            for f in own:
                rate = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / alpha
                z[f] += g - rate * w[f]
                n[f] += g * g
    return {f: x for f in often if (x := weight(f)) or f == "intercept"}


def test_ftrl_against_a_plain_one():
    rng = random.Random(8)
    # Features that share their lowest 22 bits are told apart.
    pool = [(rng.randrange(1 << 40) << 22) + (7 if k < 30 else rng.randrange(1 << 22)) for k in range(120)]
    rows = [sorted(set(rng.choices(pool, k=12))) for _ in range(200)]
    labels = np.array([float(bool({pool[0], pool[1], pool[40]} & set(r))) for r in rows])
    model = toxicity.ftrl([np.array(r, np.uint64) for r in rows], labels, l1=0.7, min_rows=15, epochs=3)
    want = plain_ftrl(rows, labels, 2.0, 1.0, 0.7, 1.0, 3, 15, 0)
    assert np.isclose(model.intercept, want.pop("intercept"))
    assert sorted(model.hashes.tolist()) == sorted(want) and 3 < len(want) < 110
    assert np.allclose(model.weights, [want[h] for h in model.hashes.tolist()])


def test_toxicity_features():
    text = "One two, THREE two"
    words = ["one", "two", "three", "two"]
    assert len(toxicity.features(text)) == 4 + 4 + 3 + 2  # words, stems, pairs, pairs over one word
    single = {w: toxicity.features(w) for w in words}
    assert {h for f in single.values() for h in f.tolist()} <= set(toxicity.features(text).tolist())
    assert len(np.unique(toxicity.features(text))) == 3 + 3 + 3 + 2


def test_toxicity_fit_is_bounded(spark):
    rows, labels = made_up(400)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, rows + [rows[0]] * 50)
    whole = toxicity.fit(docs, marks)
    assert np.allclose(whole.weights, toxicity.fit(frame(spark, rows), marks).weights)  # repeated rows count once
    less = toxicity.fit(docs, marks, max_features=12_000)
    assert 0 < len(less.hashes) and not np.array_equal(less.hashes, whole.hashes)
    assert len(toxicity.fit(docs, marks, max_features=10).hashes) == 0


def test_toxicity_without_labels(spark):
    rows, _ = made_up(10)
    for labels in ([], [(1, 0), (2, 0)]):
        marks = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert toxicity.score_documents(frame(spark, rows), marks).count() == 10
    assert toxicity.score_documents(frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int")).collect() == []


def test_held_out_labels_are_not_read(spark):
    rows, labels = made_up(600)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    schema = "doc_id long, toxic int"
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score_documents(frame(spark, rows), spark.createDataFrame(x, schema)).collect())
            for x in (labels, turned))
    assert a == b


def test_chunks_tokenize_as_whole_texts():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(BYTE_BPE)
    whole.encode_special_tokens = True
    texts = ["", " ", "a", "Hello world", " lead", "trail ", "two  spaces", "three   x", "a\nb c", "a \nb", "\n a", "don't  's 's",
             "tab\tx y", "nbsp\u00a0 x \u00a0y", "\u2003 a b", "x \x1c y \x85 z", "漢 字 é", "1 2 3,4 .5", "a" * 300, "<|endoftext|> a",
             "\x00 a \x00", "end of line \n\n next"]
    rng = random.Random(1)
    texts += ["".join(rng.choice([" ", "  ", "a", "B", ".", "'s", "\n", "\u00a0", "9", "é"]) for _ in range(40)) for _ in range(300)]
    got = packing.tokenizer(BYTE_BPE).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_chunk_cache_is_bounded_in_bytes(monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(packing, "CACHE_BYTES", 3 << 20)
    whole = Tokenizer.from_file(BYTE_BPE)
    whole.encode_special_tokens = True
    rng = random.Random(2)
    long_chunk = "".join(rng.choice("abcdefgh") for _ in range(1 << 20))
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 12))) + rng.choice(["", ",", ".", "\n"])
                      for _ in range(60_000)), long_chunk + "x " + long_chunk, "", "a b\nc, d."]
    made = packing.ChunkTokenizer(BYTE_BPE)
    sizes = []
    for text in texts * 2:
        assert made.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
        sizes.append(made.at.bytes + 4 * made.ids.n)
    most = packing.CACHE_BYTES + packing.GROUP_CHUNKS * 300 + 8 * len(long_chunk)
    assert max(sizes) <= most


def test_best_fit_and_bounds():
    rng = random.Random(9)
    for trial in range(60):
        c = rng.choice([10, 30, 100])
        sizes = sorted((rng.randrange(1, c + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
        where, offset, bins = packing.best_fit(sizes, c)
        fill = [0] * bins
        for s, b, o in zip(sizes, where, offset):
            assert o == fill[b]
            fill[b] += s
        assert max(fill) <= c

        def fewest(rest, open_bins, best):
            if len(open_bins) >= best:
                return best
            if not rest:
                return len(open_bins)
            for k in {b: i for i, b in enumerate(open_bins)}.values():
                if open_bins[k] + rest[0] <= c:
                    best = min(best, fewest(rest[1:], open_bins[:k] + [open_bins[k] + rest[0]] + open_bins[k + 1:], best))
            return min(best, fewest(rest[1:], open_bins + [rest[0]], best))

        least = fewest(sizes, [], bins)
        bound = packing.lower_bound(np.bincount(sizes, minlength=c + 1))
        assert bound <= least <= bins
    assert packing.lower_bound(np.bincount([51] * 7, minlength=101)) == 7  # by threshold, not by volume
    assert packing.lower_bound(np.bincount([34] * 9, minlength=101)) == 5  # by parts
    assert packing.lower_bound(np.zeros(11, np.int64)) == 0


def test_packing(spark, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(packing, "BUCKET_ROWS", 64)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "x", "y1", "..."]) for _ in range(rng.randrange(1, 40)))) for i in range(300)]
    rows += [(400, None), (401, ""), (None, "no id"), (5, rows[5][1]), (402, "long " * 1000)]
    docs = frame(spark, rows)
    got = packing.pack_documents(docs, BYTE_BPE, length=32).collect()
    whole = Tokenizer.from_file(BYTE_BPE)
    want = []
    for i, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 32 or 32
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 32)], range(first, len(ids) + 1, 32))):
            want.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) <= 32
    bound = packing.lower_bound(np.bincount([w[3] for w in want], minlength=33))
    assert bound <= len(places) <= 1.01 * bound + 1  # each bucket, and then the whole, is near its bound
    placed = spark.createDataFrame(got)
    built = packing.sequences(placed, packing.pieces(docs, BYTE_BPE, 32, keep_ids=True)).collect()
    assert len(built) == len(places) and sum(len(r.ids) for r in built) == sum(w[3] for w in want)
    assert packing.pack_documents(frame(spark, []), BYTE_BPE).collect() == []


def test_exchange_goes_on_with_many_buckets(spark, monkeypatch):
    """Far more buckets than rounds of halving could bring to one: it ends at the bound or when large buckets save nothing."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 16)
    rng = random.Random(6)
    rows = [(i, 0, 0, rng.randrange(1, 101), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df, 100).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.length) for r in got} == {(r[0], r[3]) for r in rows}
    fill = collections.defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for places in fill.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 100
    bound = packing.lower_bound(np.bincount([r[3] for r in rows], minlength=101))
    one = packing.best_fit(sorted((r[3] for r in rows), reverse=True), 100)[2]
    assert bound <= len(fill) <= 1.1 * one  # full bins of small buckets stay as they are


def test_imatch(spark):
    rng = random.Random(8)
    words = [f"{a}{b}{c}{d}" for a in "bcdfgklmnp" for b in ("an", "or", "ist", "el", "um") for c in ("", "en", "ly", "a") for d in "xyzw"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(30, 200)))) for i in range(60)]
    rows += [(100, rows[3][1]), (101, None), (102, ""), (103, "é漢 \U0001f600"), (None, "no id"), (104, rows[4][1]), (104, rows[4][1]),
             (200, " ".join(words * 300))]
    got = imatch.fingerprint_documents(frame(spark, rows), band=(0.05, 7.0)).collect()
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    import hashlib
    want = []
    for k, (known, i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        n = len(t) // 4
        edited = t[:len(t) - n] + after[:n]
        want.append((i if known else None, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(want, key=key)
    of = {r.doc_id: r for r in got}
    assert of[3].fingerprint == of[100].fingerprint and of[101].fingerprint == of[102].fingerprint
    assert of[101].near_edited == 1.0 and of[102].near_edited == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    normal = [r for r in got if r.doc_id is not None and r.doc_id < 60]
    assert sum(r.near_edited for r in normal) > 2 * sum(r.near_next for r in normal)
    texts = dict(rows)
    for r in normal:
        if r.edited_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest():
            assert r.near_edited == 1.0
    assert imatch.fingerprint_documents(frame(spark, [])).collect() == []
    assert imatch.fingerprint_documents(frame(spark, [(1, "alone here")])).first().near_next == 1.0


def plain_imatch(rows, band):
    """Fingerprints and likenesses of rows (id, text) in order, from the rule: {id: (parts, edited parts, near edited, near next)}."""
    import xxhash
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    number = lambda x, seed: xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed)

    def terms(text):
        return {signed(xxhash.xxh64_intdigest(w, 42)) & ~1 for w in re.findall(r"[^\W_]+", text.lower())}

    def subsets(term):
        found, used, seed, places = [], 64, 0, []
        for b in range(3, 14):
            for _ in range(imatch.PER_RATE):
                if used + b > 64:
                    seed, used = seed + 1, 0
                places.append((seed, used, b))
                used += b
        for k, (seed, used, b) in enumerate(places):
            h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), number(term, 42))
            if not h >> used & (1 << b) - 1:
                found.append(k)
        return found

    texts = {t for _, t in rows}
    df = collections.Counter(x for t in texts for x in terms(t))
    lexicon = {x: own for x, n in df.items() if band[0] <= math.log(len(texts) / n) <= band[1] and (own := subsets(x))}

    def parts(text):
        own = sorted(x for x in terms(text) if x in lexicon)
        if not own:
            return [f"{xxhash.xxh64_intdigest(text, 42):016X}".lstrip("0") or "0"]
        out = []
        for k in range(11 * imatch.PER_RATE):
            h = 42
            for x in own:
                if k in lexicon[x]:
                    h = number(sum(1 << b for b in lexicon[x]), number(x, h))
            out.append("-" * 6 if h == 42 else f"{h:016X}"[:6])
        return out

    def like(a, b):
        pairs = [(x, y) for x, y in zip(a, b) if (x, y) != ("-" * 6, "-" * 6)]
        return 1.0 if a == b else 0.0 if len(a) != len(b) else sum(x == y for x, y in pairs) / len(pairs)

    out = {}
    for k, (i, t) in enumerate(rows):
        after, n = rows[(k + 1) % len(rows)][1], len(t) // 4
        own, edited = parts(t), parts(t[:len(t) - n] + after[:n])
        out[i] = own, edited, like(own, edited), like(own, parts(after))
    return out


@pytest.mark.parametrize("broadcast", [imatch.BROADCAST_TERMS, 0])
def test_imatch_against_the_rule(spark, monkeypatch, broadcast):
    """Fingerprints and likenesses by a broadcast lexicon, and by one that is joined."""
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", broadcast)
    rng = random.Random(5)
    words = [f"w{k}x" for k in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 90)))) for i in range(60)]
    rows += [(70, rows[4][1]), (71, ""), (72, "only unknown here"), (73, rows[5][1] + " more")]
    band = (0.5, 3.5)
    want = plain_imatch(rows, band)
    for r in imatch.fingerprint_documents(frame(spark, rows), band=band).collect():
        parts, edited, near_edited, near_next = want[r.doc_id]
        assert [p.upper() for p in r.fingerprint] == [p.upper() for p in parts]
        assert [p.upper() for p in r.edited_fingerprint] == [p.upper() for p in edited]
        assert r.near_edited == pytest.approx(near_edited) and r.near_next == pytest.approx(near_next)
    assert sum(len(p) > 1 for p, *_ in want.values()) > 40 and any(0 < w[2] < 1 for w in want.values())


def test_imatch_copies_keep_their_terms(spark):
    """A text copied to a third of all rows and more is as like to its edited text as any other."""
    import hashlib
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(rng.sample(words, 40))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    got = {r.doc_id: r for r in imatch.fingerprint_documents(frame(spark, rows)).collect()}
    assert len(got) == 100
    assert all(len(r.fingerprint) == len(imatch.RATES) * imatch.PER_RATE for r in got.values())
    assert got[100].fingerprint == got[0].fingerprint == got[139].fingerprint
    assert got[139].edited_sha256 != hashlib.sha256(rows[0][1].encode()).hexdigest() and got[139].near_edited > 0
    assert imatch.distinct_texts(frame(spark, rows)).count() == 60


def test_imatch_fingerprint_is_of_sorted_distinct_terms(spark):
    """Order and repeats of terms, case and punctuation don't change a fingerprint."""
    rows = [(i, f"common w{i % 7} x{i % 5} y{i % 3} z{i}") for i in range(40)]
    rows += [(50, "common w1 x1 y1 rare"), (51, "Y1, x1 w1! x1 COMMON other")]
    got = {r.doc_id: r.fingerprint for r in imatch.fingerprint_documents(frame(spark, rows), band=(0.5, 3.0)).collect()}
    assert got[50] == got[51] != got[2]
