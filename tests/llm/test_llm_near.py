"""Operator 7: alignment and components against brute force, recall on planted copies."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_fixtures import SF01, awkward, docs, word_text
from netsieve.llm import near, queries
from netsieve.llm.common import load
from test_llm_words import plain


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def mutate(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(f"new{rng.randrange(10**6)}" if x < share else w)
        if x > 1 - share / 3:
            out.append(f"ins{rng.randrange(10**6)}")
    return out


def test_word_edits_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 14))]
        b = mutate(rng, a, 0.4) if rng.random() < 0.5 else [rng.randrange(6) for _ in range(rng.randrange(0, 14))]
        ids = {w: i for i, w in enumerate(dict.fromkeys([*a, *b]))}
        x, y = (np.array([ids[w] for w in s], np.uint32) for s in (a, b))
        want = edits(a, b)
        for most in (0, 2, 5, 20):
            assert near.word_edits(x, y, most) == min(want, most + 1)


def components(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        up[find(a)] = find(b)
    return find


def test_components_match_union_find(spark):
    rng = random.Random(6)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(60)] + [(300, 300 + i) for i in range(1, 50)]
    links = [(a, b) for a, b in links if a != b]
    node = lambda x: (hash(("n", x)) % 10**9, x)
    df = spark.createDataFrame([(node(a), node(b)) for a, b in links], "node struct<a:long,b:long>, centre struct<a:long,b:long>")
    got = {r["node"]["b"]: r["root"]["b"] for r in near.components(df).collect()}
    find = components(links)
    assert set(got) == {x for e in links for x in e}
    assert {frozenset(x for x in got if got[x] == g) for g in set(got.values())} == {
        frozenset(x for x in got if find(x) == f) for f in {find(x) for x in got}}


def test_occurrence_labels_and_order():
    a, b, c = "p q r s t u v w x y z", "p q r s t u v w x y z", "v w x y z p q r s t u"
    words, first, dig = near.content(pa.array([a, b, c, a.upper() + "!"]))
    s = near.order_sketches(words, first)
    assert (s[:, 0] == s[:, 1]).all() and (s[:, 0] == s[:, 3]).all() and dig[0, 0] == dig[0, 3] != dig[0, 2]
    assert (s[:, 0] == s[:, 2]).mean() < 0.5
    sh, at = near.labelled_kmers(*near.content(pa.array(["a a a a a a a a", "a a a a a a"]))[:2])
    assert len(set(sh.tolist())) == 4 and set(sh[at[1]:].tolist()) <= set(sh[:at[1]].tolist())


def test_classes_match_brute_force(spark):
    rng = random.Random(11)
    texts, family = [], []
    for f in range(12):
        base = word_text(rng, rng.randrange(60, 400), 3000).split()
        for _ in range(rng.randrange(1, 5)):
            texts.append(" ".join(mutate(rng, base, 0.04)))
            family.append(f)
        texts += [texts[-1]] * 2
        family += [f] * 2
    passage = word_text(rng, 60)
    texts += [word_text(rng, 150, 3000) + " " + passage + " " + word_text(rng, 150, 3000) for _ in range(25)]
    family += [100 + i for i in range(25)]
    got = {r["doc_id"]: r for r in near.classes(docs(spark, texts)).collect()}
    words = [plain(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if abs(len(words[i]) - len(words[j])) < 90 and family[i] == family[j]
             and 1 - edits(words[i], words[j]) / max(len(words[i]), len(words[j])) >= near.SIMILARITY]
    find = components(links)
    for i in range(len(texts)):
        same = [j for j in range(len(texts)) if find(j) == find(i)]
        assert (got[i]["class_id"], got[i]["class_size"]) == (min(same), len(same)), (i, same)


def test_recall_of_close_pairs_on_the_table(spark):
    text = {r["doc_id"]: r["text"] for r in load(spark, SF01, "documents").collect()}
    cls = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op7_near_duplicates"](spark, SF01).collect()}
    assert set(cls) == set(text)
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, w in ((i, plain(t)) for i, t in text.items())}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    close = set()
    for i, s in sets.items():
        for j in {j for x in s if len(by[x]) < 50 for j in by[x] if j < i}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                close.add((i, j))
    assert len(close) > 20
    assert sum(cls[i] == cls[j] for i, j in close) >= 0.98 * len(close)
    # a class hangs together by alignment, so its members share most words
    for i, j in ((i, j) for i, j in cls.items() if i != j):
        a, b = plain(text[i]), plain(text[j])
        assert len(set(a) & set(b)) >= 0.5 * min(len(set(a)), len(set(b)))


def test_near_edges_and_dedup(spark):
    d = docs(spark, awkward())
    got = near.classes(d).collect()
    assert len(got) == len(awkward())
    kept = near.near_dedup(d)
    assert kept.columns == d.columns
    left = [r["text"] for r in kept.collect()]
    assert len(left) == len({r["rk"] for r in got if r["first"]})
    assert sum((t or "").lower().startswith(awkward()[6]) for t in left) == 1
    assert near.classes(d.where("false")).count() == 0 and near.near_dedup(d.where("false")).count() == 0


def counted_steps(monkeypatch):
    """Rows that go into alignments, units and parts, by step."""
    n = {}

    def watch(name, column=None):
        step = getattr(near, name)

        def run(rows, words):
            # a text is a neighbour once, however many large buckets it is in
            n[name] = n.get(name, 0) + (rows.select("node").distinct() if name == "neighbours" else rows).count()
            return step(rows, words)
        monkeypatch.setattr(near, name, run)
    for name in ("verified", "compared", "neighbours"):
        watch(name)
    return n


def classes_of(spark, texts, parts=3):
    src = docs(spark, texts, parts).select("doc_id", "text")
    return {r["doc_id"]: r["class_id"] for r in near.classes(src).collect()}


def test_a_hot_group_is_linear(spark, monkeypatch):
    """Near copies, loose copies and unlike texts of one passage: the rows of all steps together at most
    double, about, where the texts do (buckets pass from one step to another as they grow), and a text is
    aligned a bounded number of times."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(40)]
    kinds = {"near": lambda i: changed(rng, base, 3), "loose": lambda i: changed(rng, base, 6),
             "passage": lambda i: [f"u{i}x{k}" for k in range(15)] + base[:25]}
    for kind, make in kinds.items():
        seen = []
        for size in (250, 500):
            with monkeypatch.context() as m:
                m.setattr(near, "CHUNK", 64)
                m.setattr(near, "WINDOW", 32)
                n = counted_steps(m)
                got = classes_of(spark, [" ".join(map(str, make(i))) for i in range(size)])
                seen.append(dict(n))
            if kind == "near":
                assert set(got.values()) == {0}
            if kind == "passage":
                assert len(set(got.values())) == size
        print(kind, seen)
        assert sum(seen[1].values()) <= 2.2 * sum(seen[0].values()) + 500, (kind, seen)
        assert seen[1].get("verified", 0) <= 20 * 500, (kind, seen)
        if kind == "near":
            assert seen[1]["verified"] <= 2 * 500


def test_loose_copies_reach_their_components(spark, monkeypatch):
    """Texts that are similar to some of the group only: the classes of all pairs by brute force."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(40)]
    texts = [[str(x) for x in changed(rng, base, 6)] for _ in range(300)]
    links = [(i, j) for i in range(300) for j in range(i) if edits(texts[i], texts[j]) <= int(0.2 * max(len(texts[i]), len(texts[j])) + 1e-9)]
    find = components(links)
    for chunk in (512, 64):
        monkeypatch.setattr(near, "CHUNK", chunk)
        monkeypatch.setattr(near, "WINDOW", chunk // 2)
        got = classes_of(spark, [" ".join(t) for t in texts])
        together = sum(got[i] == got[j] for i, j in links)
        assert together >= 0.95 * len(links)
        assert all(find(i) == find(c) for i, c in got.items())


def test_places_beyond_24_bits(monkeypatch):
    """The second minimum of a text with more k-mers than a place can hold."""
    rng = np.random.default_rng(3)
    words, first = rng.integers(0, 2**62, 5000).astype(np.uint64), np.array([0, 3000, 5000])
    want = near.order_sketches(words, first)
    v = rng.integers(0, 2**40, 5000).astype(np.uint64) << np.uint64(24)
    pos = np.concatenate([np.arange(3000), np.arange(2000)]).astype(np.uint64) >> np.uint64(3)
    least = np.minimum.reduceat(v | pos, first[:-1])
    at = near._slots(v | pos, least, first[:-1], np.array([3, 3], np.uint64))
    assert at.tolist() == [int(v[:3000].argmin()), 3000 + int(v[3000:].argmin())] and want.shape[1] == 2


def test_dedup_is_stable_and_takes_any_column_name(spark):
    text = word_text(random.Random(3), 50)
    rows_ = [(1, text, "a", "k1", 5), (1, text, "b", "k2", 6), (1, text, "c", None, 7), (2, text + " more", "d", "k", 8), (9, None, "e", "k", 9)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, _keep string, _rk string, _row int")
    got = [sorted(map(tuple, near.near_dedup(df.repartition(k)).collect()), key=repr) for k in (1, 3, 5)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 2 and near.near_dedup(df).columns == df.columns


def test_long_alignments_are_the_edit_distance():
    rng = random.Random(4)
    for n in (1, 40, 90, 150):
        for share in (0.1, 0.3, 0.9):
            a = [rng.randrange(50) for _ in range(n)]
            b = [rng.randrange(50) if rng.random() < share else x for x in a if rng.random() > share / 4] or [1]
            want = edits(a, b)
            for most in (30, 60, 200):
                assert near.word_edits(np.array(a, np.uint32), np.array(b, np.uint32), most) == min(want, most + 1)
            d = near.word_counts(np.array(a, np.uint32)).astype(int) - near.word_counts(np.array(b, np.uint32))
            assert max(d[d > 0].sum(), -d[d < 0].sum()) <= want


def test_near_copies_among_texts_of_shared_passages(spark, monkeypatch):
    """Every bucket's centre is another text: copies must be found among its other members."""
    monkeypatch.setattr(near, "CHUNK", 64)                    # several chunks a bucket
    rng = random.Random(8)
    passages = [word_text(rng, 60, 3000).split() for _ in range(20)]
    bases = [sum(rng.sample(passages, 6), []) for _ in range(700)]
    copies = [mutate(rng, b, 0.06) for b in bases[:100]]
    texts = [" ".join(t) for t in bases + copies]
    assert all(1 - edits(a, b) / max(len(a), len(b)) >= near.SIMILARITY for a, b in zip(bases[:12], copies[:12]))
    got = {r["doc_id"]: r["class_id"] for r in near.classes(docs(spark, texts)).collect()}
    assert sum(got[i] == got[700 + i] for i in range(100)) >= 98
    # nothing unlike is joined: with few links between bases, most stay alone
    assert len(set(got.values())) >= 600


def test_hubs_and_their_copies(spark):
    rng = random.Random(9)
    shared = word_text(rng, 300, 3000).split()
    hubs = [shared + word_text(rng, 110, 3000).split() for _ in range(12)]
    texts = [" ".join(mutate(rng, h, 0.02)) for h in hubs for _ in range(100)]
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in near.classes(docs(spark, texts)).collect()}
    assert got == {i: (i - i % 100, 100) for i in range(1200)}


def changed(rng, words, n_edits):
    out = [[w] for w in words]
    for i in rng.sample(range(len(words)), n_edits):
        new = rng.randrange(10**9, 2 * 10**9)
        out[i] = rng.choice([[new], [new], [], [words[i], new]])
    return sum(out, [])


def shared_bucket(pairs):
    words = [w for p in pairs for w in p]
    sk, at = near.all_sketches(np.array([x * 0x9E3779B97F4A7C15 % 2**64 for w in words for x in w], np.uint64),
                               np.cumsum([0, *map(len, words)]))
    sets = [set(enumerate(sk[a:b].tolist())) for a, b in zip(at[:-1], at[1:])]
    return sum(bool(a & b) for a, b in zip(sets[::2], sets[1::2])) / len(pairs)


def test_recall_at_the_threshold_of_the_link_rule():
    rng = random.Random(12)
    for n in (5, 8, 12, 20, 40, 50, 100, 400):
        pairs = []
        while len(pairs) < 300:
            a = [rng.randrange(10**9) for _ in range(n)]
            b = changed(rng, a, int(0.2 * n + 1e-9))
            if near.similar(np.array(a), np.array(b)):
                pairs.append((a, b))
        assert shared_bucket(pairs) >= 0.97, (n, shared_bucket(pairs))


def test_recall_of_every_similar_pair_on_the_table(spark):
    docs = {r["doc_id"]: plain(r["text"]) for r in load(spark, SF01, "documents").collect()}
    cls = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op7_near_duplicates"](spark, SF01).collect()}
    number: dict = {}
    words = {i: np.array([number.setdefault(x, len(number)) for x in w], np.uint32) for i, w in docs.items()}
    ids = [i for i in words if len(words[i])]
    size = np.array([len(words[i]) for i in ids])
    counts = np.stack([near.word_counts(words[i]) for i in ids]).astype(np.int32)
    similar = []
    for x, i in enumerate(ids):
        d = counts[x] - counts[:x]
        far = np.maximum(np.maximum(d, 0).sum(axis=1), np.maximum(-d, 0).sum(axis=1))
        for y in np.flatnonzero(far <= 0.2 * np.maximum(size[x], size[:x]) + 1e-9):
            if near.similar(words[i], words[ids[y]]):
                similar.append((i, ids[y]))
    assert len(similar) > 20
    assert sum(cls[i] == cls[j] for i, j in similar) >= 0.99 * len(similar)


def test_links_that_the_orders_miss_are_found(spark, monkeypatch):
    """Similar pairs among unlike texts of one large passage are linked without any help of the orders."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(25)]
    texts = [base + [f"u{i}x{k}" for k in range(15)] for i in range(120)]
    texts += [t[:25] + [f"w{i}" if k == i % 15 else x for k, x in enumerate(t[25:])] for i, t in enumerate(texts[:40])]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = near.sketched(docs)
    found = rows.select(F.lit(1).cast("long").alias("bucket"), "node", "n_words")
    words = near.candidate_words(docs, rows.select("node"))
    monkeypatch.setattr(near, "CHUNK", 64)
    monkeypatch.setattr(near, "star_rounds", lambda found, *a, **k: near.open_members(found, None))
    monkeypatch.setattr(near, "neighbours", lambda large, words: large.select("node", "centre").where("false"))
    got = near.bucket_links(found, words).label
    assert got is not None and got.count() == 80 and got.select("root").distinct().count() == 40


def test_first_of_several_is_labelled_as_an_only_one():
    sh, at = near.labelled_kmers(np.array([5, 7, 5, 7, 5, 7], np.uint64), np.array([0, 4, 6]), 2)
    twice, once = (set(sh[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
    assert len(twice) == 3 and once < twice


def test_texts_meet_once_a_unit():
    """A text goes to the units of blocks where it has an open partner, once each, and to no other."""
    row = lambda block, i, comp, n: [block, i, i, comp, comp, n]
    x = np.array([row(2, 1, 1, 100), row(2, 2, 2, 90), row(1, 3, 1, 100), row(1, 4, 4, 300), row(3, 5, 5, 100)], np.int64)
    got = sorted(tuple(r[[0, 1, 3]].tolist()) for r in near.meeting(x))
    assert got == [(1, 2, 2), (1, 2, 3), (1, 3, 3), (1, 3, 5), (2, 2, 1), (2, 2, 2), (2, 3, 1), (2, 3, 2), (2, 3, 5)]
    (b,) = near._packed([near.meeting(x)] * 3)
    assert [np.frombuffer(r.as_py(), np.int64).reshape(-1, 6).shape[0] for r in b.column(2)] == [2, 2, 2, 3]


def test_marks_of_many_texts_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 9, n).astype(np.uint32) for n in (1, 2, 30, 5, 70, 1, 12)]
    monkeypatch.setattr(near, "MARK_WORDS", 40)
    for x, (words, pairs) in zip(texts, near.all_marks(texts), strict=True):
        for k, got in ((1, words), (2, pairs)):
            want, _ = near.labelled_kmers(x.astype(np.uint64), np.array([0, len(x)]), k)
            assert got.tolist() == want.tolist()


def test_a_text_is_aligned_with_many_at_once(monkeypatch):
    """The same links as one alignment a pair, by a few common alignments."""
    rng = random.Random(4)
    base = list(range(60))
    group = [np.array([hash(w) % 2**31 for w in changed(rng, base, rng.choice((3, 9, 12, 14)))], np.uint32) for _ in range(120)]
    a, others = group[0], group[1:]
    far = [edits(a.tolist(), x.tolist()) for x in others]
    assert near.edits_to(a, others).tolist() == far
    want = [i for i, x in enumerate(others) if far[i] <= int(0.2 * max(len(a), len(x)) + 1e-9)]
    assert 0 < len(want) < len(others)
    marks = list(near.all_marks(group))
    single = []
    monkeypatch.setattr(near, "similar", lambda *a, f=near.similar, **k: single.append(1) or f(*a, **k))
    assert list(near.each_similar(a, others, lambda i: True, (marks[0], marks[1:]))) == want
    assert len(single) <= 6
    for name, value in (("LONG", 59), ("AT_ONCE", 10_000)):
        with monkeypatch.context() as m:
            m.setattr(near, name, value)
            assert list(near.each_similar(a, others, lambda i: True, (marks[0], marks[1:]))) == want
    assert list(near.each_similar(a, others, lambda i: i != want[0], (marks[0], marks[1:]))) == want[1:]


def test_word_counts_rule_out_pairs_before_texts_are_sent():
    """Texts of a word that is rare to each go to a unit only where their word counts leave a pair open."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 2**31, rng.integers(90, 130)).astype(np.uint32) for _ in range(400)]
    for i in range(30):                                          # near copies of the first ones
        texts[300 + i] = np.where(rng.random(len(texts[i])) < 0.1, 7, texts[i]).astype(np.uint32)
    size, counts = np.array([len(t) for t in texts]), np.stack([near.word_counts(t) for t in texts])
    i = np.arange(len(texts))
    x = np.stack([i % 9, i, i, i // 2, i // 2, size], axis=1)
    want = set()
    for p, q in near.open_pairs(i, i, size, x[:, 3:5], counts):
        for a, b in zip(p.tolist(), q.tolist()):
            want |= {(*sorted((a % 9, b % 9)), c) for c in (a, b)}
    got = near.meeting(x, np.minimum(counts, 255).astype(np.uint8))
    assert sorted(want) == sorted(map(tuple, got[:, [0, 1, 3]].tolist()))
    assert {300, 0, 329, 29} <= set(got[:, 3].tolist()) and 10 * len(got) < len(near.meeting(x))
    low = near.meeting(x, np.minimum(counts, 1).astype(np.uint8))    # cut off, a pair may only be left open
    assert want <= set(map(tuple, low[:, [0, 1, 3]].tolist()))


def test_sketches_do_not_depend_on_what_is_made_at_once(monkeypatch):
    rng = np.random.default_rng(6)
    n = [0, 3, 700, 1, 0, 90, 2500, 40, 0]
    words, first = rng.integers(0, 2**63, sum(n), dtype=np.uint64), np.concatenate([[0], np.cumsum(n)])
    want = near.order_sketches(words, first)
    for at_once in (1, 64, 800):
        monkeypatch.setattr(near, "CACHED", at_once)
        assert np.array_equal(near.order_sketches(words, first), want)
