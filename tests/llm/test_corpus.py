"""Line frequencies, importance resampling and the Merkle manifest, against plain statements of their rules."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import importance, linequality, merkle
from tidemark.llm.ranking import numbered

SCHEMA = ("doc_id long, text string, source string, lang string, n_chars int, host string, uid long, g string, idx long, "
          "key string, part int, row long, words int, h long")


def frame(spark, rows):
    """Rows of (doc_id, text, source, lang, n_chars) beside columns that have the operators' own names."""
    return spark.createDataFrame([(*r, "x", 1, "g", 2, "k", 3, 4, 5, 6) for r in rows], SCHEMA)


AWKWARD = [(1, None, "a", "en", None), (2, "", "a", None, 0), (None, "x y", None, "en", 3), (3, "Ünï 漢\U0001f600\n\n#|", "b", "", 9),
           (3, "Ünï 漢\U0001f600\n\n#|", "b", "", 9), (4, "w " * 30_000, "a", "dé", 60_000), (None, "x y", None, "en", 3)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_lines(rows, min_docs, share, depleted):
    texts = defaultdict(set)
    docs = defaultdict(set)
    for _, t, host, *_ in rows:
        docs[host].add(t or "")
        for line in (t or "").split("\n"):
            if words_of(line):
                texts[host, " ".join(words_of(line)).lower()].add(t)
    common = {(h, x) for (h, x), ts in texts.items() if len(ts) > min_docs and len(ts) > share * len(docs[h])}
    out = []
    for i, t, host, *_ in rows:
        t = t or ""
        words = words_of(t)
        windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        under = {k + j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if words_of(x)]
        gone = sum(len(words_of(x)) for x in lines if (host, " ".join(words_of(x)).lower()) in common)
        failed = len(words) < 20 or 100 * len(under) > 30 * len(words)
        out.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                    len(under), failed, gone, not failed and gone <= depleted * len(words)))
    return out


def made_lines(n, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices(["the", "Of", "and", "mé", "x#", "<b>", "to"], k=rng.randrange(1, 9))) for _ in range(60)]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool[:10] if rng.random() < 0.5 else pool) for _ in range(rng.randrange(0, 9))]
        own = [" ".join(f"{rng.randrange(10**6):x}" for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(3))]
        rows.append((i, "\n".join(lines + own), rng.choice(["a", "a", "b", None]), "en", 1))
    return rows + [(n, *rows[0][1:])] * 30


def test_line_frequencies(spark):
    rows = made_lines(150, 3) + AWKWARD
    got = linequality.judge(frame(spark, rows), min_docs=4, share=0.1, depleted=0.4)
    want = brute_lines(rows, 4, 0.1, 0.4)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert {r[-1] for r in want} == {True, False} and any(not r[6] and not r[-1] for r in want)
    assert linequality.judge(frame(spark, [])).collect() == []


def test_clean_texts_have_no_common_lines(spark):
    rows = made_lines(120, 5) + [(None, "own " * 25, "a", None, 1)]
    limits = dict(min_docs=4, share=0.1, depleted=0.9)
    got = Counter(map(tuple, linequality.clean(frame(spark, rows), **limits).collect()))
    want = Counter()
    for (i, t, host, *_), r in zip(rows, brute_lines(rows, 4, 0.1, 0.9)):
        if r[-1]:
            texts = defaultdict(set)
            for _, u, h, *_ in rows:
                for line in u.split("\n"):
                    texts[h, " ".join(words_of(line)).lower()].add(u)
            docs = len({u for _, u, h, *_ in rows if h == host})
            kept = [x for x in t.split("\n") if not words_of(x)
                    or not (len(s := texts[host, " ".join(words_of(x)).lower()]) > 4 and len(s) > 0.1 * docs)]
            want[i, "\n".join(kept)] += 1
    assert got == want and len(want) > 3


def test_copies_count_as_one_document(spark):
    one = " ".join(f"w{k}" for k in range(40))
    rows = [(i, one, "a", "en", 1) for i in range(100)] + [(100 + i, f"{one}\n{i}", "b", "en", 1) for i in range(100)]
    got = {r.doc_id: r.kept for r in linequality.judge(frame(spark, rows)).collect()}
    assert all(got[i] for i in range(100)) and not any(got[100 + i] for i in range(100))


@pytest.mark.parametrize("text", ["a a a a a a a a a", "a b c d e f g h a b c d e f g h", "a b c d e f g h", "", "x " * 100])
def test_repeated_words(text):
    words = text.encode().split()
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    under = {k + j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(8)}
    assert linequality.repeated_words(words) == len(under)


def brute_importance(rows, target, percent):
    def features(t):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return len(words), [zlib.crc32(x.encode()) % 10000 for x in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    s, t = (Counter(x for r in table for x in features(r[1])[1]) for table in (rows, target))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    out = []
    for r in rows:
        n, f = features(r[1])
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((k for k, r in enumerate(out) if r[1] >= 20),
                   key=lambda k: (-out[k][4], out[k][0] is None, out[k][0] or 0, out[k][2]))
    rank = {k: i + 1 for i, k in enumerate(order[:len(order) * percent // 100])}
    return [(*out[k][:1], *out[k][2:], rank.get(k)) for k in range(len(out))]


@pytest.mark.parametrize("percent", [0, 25, 100])
def test_importance(spark, percent):
    rng = random.Random(percent)
    words = ["the", "Cat", "dög", "42", "x-y", "run", "漢字"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(5, 60))), "s", "en", 1) for i in range(150)] + AWKWARD
    rows += [rows[7]] * 40
    target = [(i, " ".join(rng.choices(words[:3], k=30)), "s", "en", 1) for i in range(10)]
    got = importance.resample(frame(spark, rows), frame(spark, target), percent=percent)
    assert Counter(map(tuple, got.collect())) == Counter(brute_importance(rows, target, percent))
    assert importance.resample(frame(spark, []), frame(spark, target)).collect() == []
    assert len(importance.resample(frame(spark, rows[:5]), frame(spark, [])).collect()) == 5


def test_quickselect_finds_every_place(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(k % 7, k) for k in range(300)], "a long, b long").select(F.struct("a", "b").alias("k"))
    order = sorted((k % 7, k) for k in range(300))
    for k in (1, 2, 150, 299, 300):
        assert tuple(importance.kth(rows, "k", k, pivots=3, seed=k)) == order[k - 1]


def test_places_in_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), rng.randrange(50), k) for k in range(500)]
    df = spark.createDataFrame(rows, "grp string, x long, _seq long").repartition(7)
    got, sizes = numbered(df, ["x", "_seq"], "test", "grp")
    want = {r: i for g in "ab" for i, r in enumerate(sorted(x for x in rows if x[0] == g))}
    assert {tuple(r)[:3]: r.idx for r in got.collect()} == want
    assert {r.grp: r.n for r in sizes.collect()} == Counter(r[0] for r in rows)


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(level):
    levels = [level]
    while len(level) > 1:
        level = [H("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
        levels.append(level)
    return levels


def brute_manifest(rows):
    """From rows of (doc_id, text, source, lang, n_chars)."""
    def leaf(r, more=0):
        i, text, source, lang, n = r
        fields = (i, source, lang, None if n is None else n + more, text)
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    trunk = tree([trees[g][-1][0] for g in names])
    out = []
    for a, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            siblings = [(levels[k][at >> k ^ 1] if at >> k ^ 1 < len(levels[k]) else None, at >> k & 1)
                        for levels, at in ((trees[g], i), (trunk, a)) for k in range(len(levels) - 1)]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            d = leaf(r, int(bad))
            for s, left in siblings:
                d = H(d if s is None else s + d if left else d + s)
            out.append((r[0], leaf(r), trees[g][-1][0], trunk[-1][0], H("".join(s for s, _ in siblings if s)), d,
                        d == trunk[-1][0]))
    return out


@pytest.mark.parametrize("n", [1, 2, 64, 65, 129, 700])
def test_merkle(spark, n):
    rng = random.Random(n)
    rows = [(i, f"text {i}", "s", rng.choice(["en"] * 5 + ["de", None, "ü"]) if n > 1 else "en", i) for i in range(n)]
    if n == 65:  # in one tree
        rows = [(*r[:3], "en", r[4]) for r in rows]
    if n == 129:
        rows += AWKWARD + [rows[5]] * 20
    got = [tuple(r) for r in merkle.tampered_manifest(frame(spark, rows)).collect()]
    want = brute_manifest(rows)
    assert Counter(got) == Counter(want)
    assert n < 64 or {r[-1] for r in want} == {True, False}


def test_merkle_levels_between_are_not_stored(spark):
    from pyspark.sql import functions as F
    nodes = spark.range(5000).select(F.lit("a").alias("g"), F.col("id").alias("idx"), F.sha2(F.col("id").cast("string"), 256).alias("digest"),
                                     F.lit(13).alias("height"), F.lit("p").alias("payload"))
    stored = merkle.build(nodes, 5000, 13, "test")
    assert [s.count() for s in stored] == [5000, 79, 2, 1]


def test_merkle_of_nothing(spark):
    assert merkle.tampered_manifest(frame(spark, [])).collect() == []
