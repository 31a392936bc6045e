"""SimHash, substring dedup and components against brute force."""
import hashlib
import random
import re

import pytest
import xxhash

from tidemark.llm import components, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, fp string, th string, `start` int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def reach(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(3)
    n, links = 300, [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(40)]
    links += [(7, x) for x in range(200, 260)] + [(5, 5)]
    pairs = {frozenset(p) for p in links}
    want = reach(n, lambda a, b: frozenset((a, b)) in pairs)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert [got.get(x, x) for x in range(n)] == want
    empty = spark.createDataFrame([], "u long, v long")
    assert components.components(empty).collect() == []


@pytest.mark.parametrize("bucket", [32, 2])
def test_simhash_links(spark, monkeypatch, bucket):
    """Crowded fingerprints, with and without the pivot way."""
    monkeypatch.setattr(simhash, "PAIR_BUCKET", bucket)
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for seed in list(fps)[:8]:
        for _ in range(25):
            x = seed
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, 1, 3, (1 << 64) - 1, (1 << 63)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    classes = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = components.components(simhash.links(classes).select("u", "v"))
    got = {r.node: r.root for r in found.collect()}
    want = reach(len(signed), lambda a, b: ((signed[a] ^ signed[b]) & ((1 << 64) - 1)).bit_count() <= 2)
    assert [got.get(x, x) for x in signed] == [signed[w] for w in want]


def test_near_duplicates(spark):
    rng = random.Random(5)
    base = [f"Word{rng.randrange(400)}" for _ in range(300)]
    rows = [(i, " ".join(base[:i] + ["new"] + base[i + 1:])) for i in range(20, 60)]
    rows += [(100, ""), (101, None), (102, " \t\n"), (103, "one"), (104, "ONE"), (105, "two words"), (3, "one"),
             (None, "one"), (None, "only here and twice"), (103, "one"), (9, "a b c d " * 4000), (8, "ä ö\u00a0ü É")]
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = reach(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(((i, f, least.get(r)) for (i, _), f, r in zip(rows, fps, roots)), key=key)
    kept = simhash.keep_one(frame(spark, rows)).collect()
    assert len(kept) == len(set(roots)) and set(kept[0].asDict()) == {"doc_id", "text", "fp", "th", "start"}
    assert {r.doc_id for r in kept if r.doc_id is not None} == set(least.values())
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.keep_one(frame(spark, [])).collect() == []


def brute_cut(rows, window):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k:k + window])] = min(i, first.get(tuple(w[k:k + window]), i))
    out = []
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_substring(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "Ж", "a|b"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [text(n) for n in (12, 13, 14, 20, 45, 80)]
    rows = []
    for i in range(70):
        words = text(rng.randrange(40))
        for p in rng.sample(passages, rng.randrange(4)):
            a = rng.randrange(3)
            words += p[a:len(p) - rng.randrange(3)] + text(rng.randrange(6))
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    rows += [(200, None), (201, ""), (202, "the " * 90), (1, "the " * 50), (203, rows[3][1]), (204, rows[3][1]),
             (None, rows[3][1]), (None, rows[4][1]), (205, rows[5][1]), (205, rows[5][1]), (206, " ".join(text(5000))),
             (207, rows[3][1].replace(" ", "\t"))]
    want = brute_cut(rows, 12)
    got = substring.deduplicate(frame(spark, rows), window=12, phrase=4).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert (sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=key)
            == sorted((w[:4] for w in want), key=key))
    assert sum(w[2] for w in want) > 1000
    cut = substring.cut_texts(frame(spark, rows), size_col=None, window=12, phrase=4).collect()
    texts = sorted(((r.doc_id, WORD.findall(r.text or "")) for r in cut), key=key)
    assert texts == sorted(((w[0], WORD.findall(w[4])) for w in want), key=key)
    untouched = {(i, t) for (i, t), w in zip(rows, want) if not w[2]}
    assert untouched <= {(r.doc_id, r.text) for r in cut}
    assert substring.deduplicate(frame(spark, [])).collect() == []


def test_substring_frees_what_it_has_used(spark, monkeypatch):
    """Of the staged steps only what the result is read from stays on disk, and no shuffle files of their writes."""
    import os
    import time

    from tidemark import session

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    monkeypatch.setattr(session, "_SCRATCH", [])
    before = shuffles()
    passage = " ".join(f"p{k}" for k in range(30))
    out = substring.deduplicate(frame(spark, [(k, f"a{k} {passage} b{k}") for k in range(20)]), window=12, phrase=4)
    left = [p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in session._SCRATCH if os.path.exists(session.local_path(p))]
    assert sorted(left) == ["tidemark-substring-base", "tidemark-substring-changed"]
    for _ in range(50):                                            # executors remove them on their own
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before
    assert spark.conf.get(session._END_SHUFFLES, None) in (None, "false")
    assert sorted((r.doc_id, r.n_removed) for r in out.collect()) == [(0, 0), *((k, 30) for k in range(1, 20))]


def test_automaton_decides(spark):
    """Windows are found by the automaton's occurrences: all that recur with its phrases, none without them."""
    rng = random.Random(21)
    texts = [[b"w%d" % rng.randrange(40) for _ in range(rng.randrange(60, 160))] for _ in range(30)]
    for t in texts[10:]:
        t[30:55] = rng.choice(texts[:10])[10:35]
    hashes = substring.WordHashes()
    values = [hashes.of(t) for t in texts]
    window, phrase = 20, 4
    carried = [set(substring.anchor_phrases(v, window, phrase)) for v in values]
    often = {p for p in set().union(*carried) if sum(p in c for c in carried) > 1}

    def located(phrases):
        automaton = substring.automaton_of(phrases)
        found = {}
        for k, v in enumerate(values):
            for anchor, _, start, own in substring.runs(v, automaton, window, phrase):
                for i, h in enumerate(own.tolist()):
                    found.setdefault((anchor, h), set()).add((k, start + i))
        return {frozenset(places) for places in found.values() if len({k for k, _ in places}) > 1}

    every = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - window + 1):
            every.setdefault(tuple(t[i:i + window]), set()).add((k, i))
    want = {frozenset(p) for p in every.values() if len({k for k, _ in p}) > 1}
    assert located(often) == want and len(want) > 30
    assert located(set().union(*carried)) == want           # more phrases change nothing
    assert located(set()) == set()
    some = located(set(sorted(often)[::2]))
    assert some < want
    # Every occurrence is found, also where it is no anchor.
    one = sorted(often)[0]
    automaton = substring.automaton_of([one])
    for v in values:
        numbers = v.astype("<u4").tobytes()
        assert substring.occurrences(automaton, v, phrase).tolist() == [
            i for i in range(len(v) - phrase + 1) if numbers[4 * i:4 * (i + phrase)] == one]


def test_anchor_is_the_windows_own(spark):
    """Equal windows have equal anchors wherever they stand."""
    rng = random.Random(2)
    words = [b"%d" % rng.randrange(3) for _ in range(400)]
    values = substring.WordHashes().of(words)
    at, grams = substring.anchor_positions(values, 10, 3)
    own = {}
    for k, p in enumerate(at.tolist()):
        assert k <= p <= k + 7
        assert own.setdefault(tuple(words[k:k + 10]), p - k) == p - k
    spans = substring.span_hashes(values, 10)
    assert len({(tuple(words[k:k + 10]), int(s)) for k, s in enumerate(spans)}) == len(set(spans.tolist()))
