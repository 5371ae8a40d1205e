"""Operator 7, near-duplicate classes by Order MinHash and banded alignment.

Each of BANDS sketches of a document takes the ORDER smallest of its occurrence-labelled
3-word k-mers under one hash and keeps their text order (short texts have BANDS more, of 2-word
k-mers: few of their longer ones outlive an edit), so a match hints at a small edit distance,
not only at shared content.  Texts that share a sketch are a bucket; two texts are linked if a
banded alignment of their words gives an edit similarity (1 - word edits / words of the longer
one) of at least SIMILARITY.  Classes are the connected components of the links, over distinct
texts, so a link is sought only between two texts that are not yet in one component:

1. Every text is aligned with the smallest text of one of its buckets; then with those of its large
   buckets (of more than CHUNK texts), where components differ still.
2. A smaller bucket that has several components after that is worked off in one task: all pairs of
   different components that a lower bound of the edits leaves open.
3. The texts of larger ones (a passage that many unlike texts share) are put in order of their
   further minima, PASSES times with other hashes, half of them without the k-mers that a text has
   in common with the smallest text of its largest bucket; texts within WINDOW of each other in an
   order are compared like those of a small bucket.  Each step takes a text a bounded number of
   times, whatever the size of its groups.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import fresh, mix, pieces, prepare, row_key, shingles, stored, text_bytes, word_hashes, word_spans

KMER_WORDS = 5                   # of labelled_kmers, where none is given
SKETCH_WORDS = 3                 # of a k-mer of the sketches
SHORT_WORDS = 2                  # of a k-mer of the further sketches of short texts
SHORT = 40                       # words up to which a text is short
ORDER = 2
BANDS = 48
SIMILARITY = 0.8
BAND_EDITS = 24                  # edits up to which the band is followed diagonal by diagonal
CHUNK = 512                      # texts of a bucket up to which all its open pairs are compared
UNIT_WORDS = 1 << 20             # words of texts on one side of a unit of comparisons
BUDGETS = (1,)                   # smallest texts that a text is aligned with in the first rounds
FEW = 200_000                    # digests up to which they are broadcast to pick words without a shuffle
LINKS_A_TASK = 50_000
ROWS_A_TASK = 20_000             # rows of ids in a task, about, of the steps between the comparisons
SMALL = 50_000                   # rows of ids up to which a table is broadcast to its join
MARK_WORDS = 1 << 16             # words of texts whose marks are made at once
CACHED = 1 << 16                 # k-mers of texts that are sketched at once
LONG = 2048                      # words up to which a text is aligned with several others at once
AT_ONCE = 1 << 24                # distinct words of a text, times words of the others it is aligned with at once
TEXTS_A_TASK = 1024              # rows of texts to align in a task, about: they are small and take long
PASSES = 8                       # orders in which the texts of larger buckets become neighbours
DEPTH = 8                        # minima of a text by which it is put in order
WINDOW = 256                     # texts before it that a text is compared with
SLOTS = 1 << 18                  # hashed words whose frequency orders the words of a text
COUNTS = 128                     # hashed word counts of a text, for the lower bound
BLOOM_BITS = 1 << 25             # 4 MB on the driver and each worker, whatever the input
_U = np.uint64
_ODD = np.random.default_rng(7).integers(1, 2**63, (BANDS, 2), dtype=np.uint64) | _U(1)
_TOP = ~_U(0xFFFFFF)


def content(arr: pa.Array):
    """(word hashes, word offsets, 2 x n digest) of texts.  The digest is of the word
    sequence, or of the bytes where a text has no word."""
    buf, off = text_bytes(arr)
    start, end = word_spans(buf, off)
    words, first = word_hashes(buf, start, end), np.searchsorted(start, off, side="left")
    n = len(arr)
    dig = np.zeros((2, n), np.uint64)
    at = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    with np.errstate(over="ignore"):
        for i, c in enumerate((0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)):
            x = mix(words * _U(c) + at.astype(np.uint64) * _U(0xA24BAED4963EE407))
            acc = np.concatenate([[_U(0)], np.cumsum(x, dtype=np.uint64)])
            dig[i] = mix(acc[first[1:]] - acc[first[:-1]] + np.diff(first).astype(np.uint64))
    for d in np.flatnonzero(np.diff(first) == 0):
        import hashlib
        dig[:, d] = np.frombuffer(hashlib.md5(b"no words:" + buf[off[d]:off[d + 1]].tobytes()).digest(), np.uint64)
    return words, first, dig.view(np.int64)


def labelled_kmers(words: np.ndarray, first: np.ndarray, k: int = KMER_WORDS):
    """Hashes of (k-mer, number of earlier occurrences in its text), and offsets."""
    sh, sh_first = shingles(words, first, k)
    doc = np.repeat(np.arange(len(sh_first) - 1), np.diff(sh_first)).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = mix(sh + doc * _U(0x9E3779B97F4A7C15))
        s = np.sort(key)
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        if len(twice):
            at = np.flatnonzero(np.isin(key, twice))
            o = at[np.argsort(key[at], kind="stable")]
            new = np.concatenate([[True], key[o][1:] != key[o][:-1]])
            idx = np.arange(len(o))
            occ = idx - np.maximum.accumulate(np.where(new, idx, 0))
            o, occ = o[occ > 0], occ[occ > 0]            # the first of several is labelled as an only one
            sh = sh.copy()
            sh[o] = mix(sh[o] + occ.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    return sh, sh_first


def order_sketches(words: np.ndarray, first: np.ndarray, k: int = SKETCH_WORDS) -> np.ndarray:
    """BANDS x texts sketch hashes (columns of texts without words are meaningless)."""
    sh, sh_first = labelled_kmers(words, first, k)
    has = np.diff(sh_first) > 0
    starts = sh_first[:-1][has]
    out = np.zeros((BANDS, len(has)), np.uint64)
    if not len(starts):
        return out
    n = np.diff(sh_first)[has]
    # 24 bits hold a place, or that of a run of places where a text has more
    wide = np.array([max(0, int(x - 1).bit_length() - 24) for x in n], np.uint64)
    pos = (np.arange(len(sh)) - np.repeat(starts, n)).astype(np.uint64) >> np.repeat(wide, n)
    ends, rows, i = starts + n, np.flatnonzero(has), 0
    while i < len(starts):                                       # as many texts at once as a core's cache holds
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CACHED, side="right")))
        at = slice(int(starts[i]), int(ends[j - 1]))
        out[:, rows[i:j]] = _least_two(sh[at], pos[at], starts[i:j] - starts[i], wide[i:j])
        i = j
    return out


def _least_two(sh: np.ndarray, pos: np.ndarray, starts: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Hashes of the two least k-mers of each text under each band, in text order."""
    out = np.empty((BANDS, len(starts)), np.uint64)
    v, t = np.empty_like(sh), np.empty_like(sh)
    with np.errstate(over="ignore"):
        for j in range(BANDS):
            np.bitwise_xor(sh, _ODD[j, 0], out=v)
            np.multiply(v, _ODD[j, 1], out=v)
            np.right_shift(v, _U(31), out=t)
            np.bitwise_xor(v, t, out=v)
            np.multiply(v, _U(0x94D049BB133111EB), out=v)
            np.bitwise_and(v, _TOP, out=v)
            np.bitwise_or(v, pos, out=v)
            a = np.minimum.reduceat(v, starts)
            v[_slots(v, a, starts, wide)] = _U(2**64 - 1)
            b = np.minimum.reduceat(v, starts)
            swap = (a & ~_TOP) > (b & ~_TOP)                     # keep text order
            x, y = np.where(swap, b, a) & _TOP, np.where(swap, a, b) & _TOP
            out[j] = mix(x * _U(0x9E3779B97F4A7C15) + mix(y) + _U(j))
    return out


def _slots(v: np.ndarray, least: np.ndarray, starts: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Where the least value of each text stands; in a very long one its place is a run's."""
    at = starts + ((least & ~_TOP) << wide).astype(np.int64)
    for i in np.flatnonzero(wide):
        at[i] += int((v[at[i]:at[i] + (1 << int(wide[i]))] == least[i]).argmax())
    return at


def all_sketches(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketch hashes of every text, one text after the other, and offsets: BANDS, for a short text
    2 * BANDS, without words none."""
    n = np.diff(first)
    some, short = n > 0, (n > 0) & (n <= SHORT)
    off = np.concatenate([[0], np.cumsum(BANDS * some + BANDS * short)])
    out = np.zeros(off[-1], np.uint64)
    band = np.arange(BANDS)
    out[off[:-1][some][:, None] + band] = order_sketches(words, first)[:, some].T
    few = order_sketches(words[np.repeat(short, n)], np.concatenate([[0], np.cumsum(n[short])]), SHORT_WORDS)
    out[off[:-1][short][:, None] + BANDS + band] = few.T
    return out, off


def word_edits(a: np.ndarray, b: np.ndarray, most: int, marks=None) -> int:
    """Word edit distance of two hash sequences if at most ``most``, else ``most + 1``.

    A banded alignment: only diagonals within ``most`` edits are followed, each to its
    furthest reach per number of edits.  Multiset differences, lower bounds, go first (``marks`` are
    the :func:`word_marks` of both, where known); a pair that BAND_EDITS edits do not settle is
    aligned a whole column of bits at a time.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    if n and m:
        least = least_edits(n, m, most, *(marks or (word_marks(a), word_marks(b))))
        if least > most:
            return most + 1
    # a diagonal costs about as much as two columns, and more of them are followed each time
    band = min(BAND_EDITS, isqrt(max(n, m) // 2))
    if n and m and least > band:
        return min(_column_edits(a.tolist(), b.tolist()), most + 1)

    def reach(i: int, j: int) -> int:
        step = 16
        while i < n and j < m:
            k = min(step, n - i, m - j)
            ne = a[i:i + k] != b[j:j + k]
            p = int(ne.argmax())
            if ne[p]:
                return i + p
            i, j, step = i + k, j + k, step * 4
        return i

    goal = m - n
    f = {0: reach(0, 0)}
    if f.get(goal) == n:
        return 0
    for d in range(1, most + 1):
        if d > band and n and m:
            return min(_column_edits(a.tolist(), b.tolist()), most + 1)
        g = {}
        slack = most - d
        # a diagonal too far from the goal for the edits left cannot lead to it
        for k in range(max(-d, goal - slack), min(d, goal + slack) + 1):
            i = max(f.get(k, -2) + 1, f.get(k - 1, -2), f.get(k + 1, -2) + 1)
            if i < 0:
                continue
            i = min(i, n, m - k)
            if i + k < 0:
                continue
            g[k] = reach(i, i + k)
        if g.get(goal) == n:
            return d
        f = g
    return most + 1


def word_marks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled words, and pairs of neighbouring words, of a text."""
    return next(all_marks([x]))


def all_marks(texts):
    """:func:`word_marks` of each text; those of about MARK_WORDS words are made at once, as a short text
    costs little more than its share of them."""
    size = np.cumsum([0, *map(len, texts)])
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(size, size[i] + MARK_WORDS, side="right")) - 1)
        x, at = np.concatenate(texts[i:j]).astype(np.uint64), size[i:j + 1] - size[i]
        yield from zip(*[np.split(marks, first[1:-1]) for marks, first in (labelled_kmers(x, at, k) for k in (1, 2))])
        i = j


def least_edits(n: int, m: int, most: int, marks_a: tuple, marks_b: tuple) -> int:
    """A lower bound of the edits between texts of n and m words, by their :func:`word_marks`; the second
    part of it only where the first is ``most`` or less."""
    least = max(n, m) - _in_common(marks_a[0], marks_b[0])
    # an edit breaks two pairs of neighbouring words at most
    if least <= most and min(n, m) > 1:
        least = max(least, (max(n, m) - _in_common(marks_a[1], marks_b[1])) // 2)
    return least


def _in_common(a: np.ndarray, b: np.ndarray) -> int:
    s = np.sort(np.concatenate([a, b]))
    return int(np.count_nonzero(s[1:] == s[:-1]))


def _column_edits(a: list, b: list) -> int:
    """Edit distance, the rows of a column of the alignment as bits of one number (a, b not empty)."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    up, down = every, 0
    for y in b:
        eq = where.get(y, 0)
        level = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (every & ~(level | up)), up & level
        plus, minus = (plus << 1 | 1) & every, minus << 1 & every
        up, down = minus | (every & ~(level | plus)), plus & level
    return len(b) + up.bit_count() - down.bit_count()


def edits_to(a: np.ndarray, others: list) -> np.ndarray:
    """Edit distances of ``a`` to each of ``others`` (none empty): :func:`_column_edits` with the others
    as the rows of one column, a free bit after each that takes its carry."""
    size = np.array([len(x) for x in others])
    starts = np.concatenate([[0], np.cumsum(size + 1)])
    words, column = np.unique(a, return_inverse=True)
    text = np.concatenate(others)
    bit = np.arange(len(text)) + np.repeat(np.arange(len(others)), size)
    row = np.minimum(np.searchsorted(words, text), len(words) - 1)
    hit = words[row] == text
    at = np.zeros((len(words) + 2, starts[-1]), bool)
    at[row[hit], bit[hit]] = True
    at[-2, bit] = at[-1, starts[:-1]] = True
    *where, every, first = (int.from_bytes(x.tobytes(), "little") for x in np.packbits(at, axis=1, bitorder="little"))
    up, down = every, 0
    for c in column.tolist():
        eq = where[c]
        level = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (every & ~(level | up)), up & level
        plus, minus = (plus << 1 | first) & every, minus << 1 & every
        up, down = minus | (every & ~(level | plus)), plus & level
    more, less = (np.unpackbits(np.frombuffer(x.to_bytes(-(-int(starts[-1]) // 8), "little"), np.uint8), bitorder="little")[:starts[-1]] for x in (up, down))
    return len(a) + np.add.reduceat(more.astype(np.int64) - less, starts[:-1])


def each_similar(a: np.ndarray, others: list, still, marks: tuple):
    """Places of the ``others`` that are similar to ``a``, in order; a place for which ``still`` does not
    hold when its turn comes is passed over.  ``marks``: :func:`word_marks` of a, and of each other."""
    most = [int((1 - SIMILARITY) * max(len(a), len(x)) + 1e-9) for x in others]
    at, step = 0, 8
    while at < len(others):
        some = [i for i in range(at, min(at + step, len(others)))
                if still(i) and least_edits(len(a), len(others[i]), most[i], marks[0], marks[1][i]) <= most[i]]
        at, step = at + step, 2 * step
        while some:
            n = total = 0
            while n < len(some) and max(len(a), len(others[some[n]])) <= LONG and len(a) * (total + len(others[some[n]])) <= AT_ONCE:
                total += len(others[some[n]])
                n += 1
            now, some = some[:max(1, n)], some[max(1, n):]
            if len(now) > 1:
                yield from [i for i, d in zip(now, edits_to(a, [others[i] for i in now]).tolist()) if d <= most[i]]
            elif still(now[0]) and similar(a, others[now[0]], marks=(marks[0], marks[1][now[0]])):
                yield now[0]


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY, marks=None) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - threshold) * longer + 1e-9)
    return longer > 0 and word_edits(a, b, most, marks) <= most


def few_tasks(df: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """``df``, of ``rows`` rows at most, in tasks of about ``each`` rows where it would be in more.  Not
    for the result of a sort-merge join, which holds its memory for each partition until the task ends."""
    return df.coalesce(max(1, -(-rows // each)))


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, of ids only, to be broadcast to a join if it (or what bounds it) has few rows."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= SMALL else df


def _node(a, b) -> F.Column:
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b")).alias("node")


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, rk (row key), node (content digest), n_words, bands`` of every row."""
    def run(batches):
        for b in pieces(batches, "text"):
            words, first, dig = content(b.column(2))
            sk, at = all_sketches(words, first)
            n = np.diff(first)
            bands = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sk.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dig[0]), pa.array(dig[1]),
                                              pa.array(n, pa.int64()), bands], names=["doc_id", "rk", "a", "b", "n_words", "bands"])

    src = docs.select(F.col("doc_id"), row_key("doc_id", "text").alias("rk"), F.col("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, rk string, a long, b long, n_words long, bands array<long>")
    return out.select("doc_id", "rk", _node("a", "b"), "n_words", "bands")


def members(nodes: DataFrame) -> DataFrame:
    """``bucket, node, n_words``: every distinct text in each sketch bucket of at least two."""
    b = nodes.select("node", "n_words", F.posexplode("bands").alias("j", "v")).select(
        F.xxhash64("j", "v").alias("bucket"), "node", "n_words")
    several = stored(b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "near-buckets")
    return b.join(several, "bucket", "left_semi")


def open_members(found: DataFrame, label: DataFrame | None) -> DataFrame:
    """``bucket, n, node, n_words, comp, centre, c_words, c_comp``: the members of the buckets that
    hold more than one component, with the bucket's size and its smallest text."""
    found = found.select("bucket", "node", "n_words")
    rows = found.count()
    if label is None:
        found = found.withColumn("comp", F.col("node"))
    else:
        k = label.select(F.col("node").alias("k"), "root")
        found = stored(found.join(small(k), F.col("node") == F.col("k"), "left")
                       .select("bucket", "node", "n_words", F.coalesce("root", "node").alias("comp")), "near-comps")
    per = (found.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"),
                                       F.min(F.struct("node", "n_words", "comp")).alias("c")).where("lo != hi")
           .select("bucket", "n", F.col("c.node").alias("centre"), F.col("c.n_words").alias("c_words"), F.col("c.comp").alias("c_comp")))
    return found.join(small(stored(few_tasks(per, rows), "near-mixed")), "bucket")


def to_centres(found: DataFrame) -> DataFrame:
    """``node, centre, shared`` (buckets): texts with the smallest texts of their buckets, where the
    components differ and the lengths allow a link."""
    near_size = F.abs(F.col("n_words") - F.col("c_words")) <= (1 - SIMILARITY) * F.greatest("n_words", "c_words") + 1e-9
    return (found.where((F.col("comp") != F.col("c_comp")) & near_size)
            .groupBy("node", "centre").agg(F.count(F.lit(1)).alias("shared")))


def joined(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, root``: the components ``label`` after ``links`` too."""
    if label is None:
        return components(links)
    k = label.select(F.col("node").alias("k"), "root")
    k = small(k)
    ends = (links.join(k, F.col("node") == F.col("k"), "left").select(F.coalesce("root", "node").alias("node"), "centre")
            .join(k, F.col("centre") == F.col("k"), "left").select("node", F.coalesce("root", "centre").alias("centre"))
            .where("node != centre").distinct())
    ends = stored(few_tasks(ends, links.count()), "near-ends")
    if ends.isEmpty():
        return label
    up = components(ends).select(F.col("node").alias("r"), F.col("root").alias("top"))
    # roots without a row of their own are texts that had no link before
    every = label.unionByName(up.select(F.col("r").alias("node"), F.col("r").alias("root"))
                              .join(label.select(F.col("node").alias("k")), F.col("node") == F.col("k"), "left_anti"))
    return stored(every.join(up, F.col("root") == F.col("r"), "left").select("node", F.coalesce("top", "root").alias("root")), "near-label")


class _Links:
    """The links found so far and their components."""

    def __init__(self):
        self.parts: list = []
        self.label = None

    def add(self, links: DataFrame) -> None:
        if not links.isEmpty():
            self.parts.append(links)
            self.label = joined(self.label, links)


def star_rounds(found: DataFrame, words: DataFrame, so_far: _Links, budgets=BUDGETS) -> DataFrame:
    """Link texts to the smallest texts of their buckets, no pair twice and none inside a component;
    returns the members of the buckets that still hold several components."""
    tried = None
    for budget in [*budgets, None]:
        found = stored(open_members(found, so_far.label), "near-open")
        # the other pairs of smaller buckets are compared by :func:`compared`
        pairs = to_centres(found if budget is not None else found.where(F.col("n") > CHUNK))
        if tried is not None:
            pairs = pairs.join(tried, ["node", "centre"], "left_anti")
        if budget is not None:
            w = Window.partitionBy("node").orderBy(F.desc("shared"), "centre")
            pairs = pairs.withColumn("i", F.row_number().over(w)).where(F.col("i") <= budget)
        pairs = stored(few_tasks(pairs.select("node", "centre"), found.count()), "near-pairs")
        if not pairs.isEmpty():
            so_far.add(stored(verified(pairs, words), "near-verified"))
            tried = pairs if tried is None else tried.unionByName(pairs)
    return open_members(found, so_far.label)


def order_keys(x: np.ndarray, y: np.ndarray | None) -> list[bytes]:
    """Keys of a text ``x`` in PASSES orders: its DEPTH smallest k-mers under a hash an order, the
    smallest first; in the second half without the k-mers of ``y``."""
    kmers = [labelled_kmers(w.astype(np.uint64), np.array([0, len(w)]), SKETCH_WORDS)[0] for w in (x, y) if w is not None]
    own = kmers[0][~np.isin(kmers[0], kmers[1])] if y is not None else kmers[0]
    out = []
    for j in range(PASSES):
        k = kmers[0] if j < PASSES // 2 else own
        h = mix(k ^ _ODD[j, 1])
        out.append((np.sort(np.partition(h, DEPTH)[:DEPTH] if len(h) > DEPTH else h) >> _U(32)).astype(">u4").tobytes())
    return out


def neighbours(large: DataFrame, words: DataFrame) -> DataFrame:
    """``node, centre``: links among the texts of large buckets that are neighbours in one of PASSES
    orders by further minima (see the module's docstring).  A task holds WINDOW texts of at most
    UNIT_WORDS words together, and one more."""
    hot = large.groupBy("node").agg(F.first("n_words").alias("n_words"), F.first("comp").alias("comp"), F.max(F.struct("n", "centre")).alias("top"))
    hot = stored(few_tasks(hot.select("node", F.col("top.centre").alias("centre"), "n_words", "comp"), large.count()), "near-hot")
    ids = [F.col("node.a").alias("a"), F.col("node.b").alias("b"), F.col("comp.a").alias("ca"), F.col("comp.b").alias("cb")]

    def keyed(batches):
        for b in batches:
            col = {c: b.column(c) for c in b.schema.names}
            keys = [order_keys(np.frombuffer(x.as_buffer(), np.uint32), None if s.as_py() else np.frombuffer(y.as_buffer(), np.uint32))
                    for x, y, s in zip(col["x"], col["y"], col["itself"])]
            row = pa.array(np.repeat(np.arange(b.num_rows), PASSES))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(PASSES, dtype=np.int32), b.num_rows)), pa.array([k for ks in keys for k in ks], pa.binary()),
                                              *[col[c].take(row) for c in ("a", "b", "ca", "cb", "n_words")]],
                                             names=["order", "place", "a", "b", "ca", "cb", "n_words"])

    j = _with_words(hot, words).select(*ids, "n_words", "x", "y", (F.col("node") == F.col("centre")).alias("itself"))
    placed = stored(j.mapInArrow(keyed, "order int, place binary, a long, b long, ca long, cb long, n_words long"), "near-places")
    w = _some(words, hot).select(F.col("node.a").alias("wa"), F.col("node.b").alias("wb"), "words")
    tasks = _tasks(placed)
    rows = (small(placed).join(w, (F.col("a") == F.col("wa")) & (F.col("b") == F.col("wb"))).drop("wa", "wb")
            .repartitionByRange(tasks, "order", "place", "a", "b").coalesce(tasks).sortWithinPartitions("order", "place", "a", "b"))

    def slide(batches):
        near_by = _Neighbours()
        for b in batches:
            col = {c: b.column(c) for c in b.schema.names}
            links = []
            texts = [np.frombuffer(w.as_buffer(), np.uint32).copy() for w in col["words"]]
            for order, a, c, ca, cb, text, marks in zip(*[col[x].to_pylist() for x in ("order", "a", "b", "ca", "cb")], texts, all_marks(texts)):
                links += near_by.meet(order, (a, c), (ca, cb), text, marks)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([int(x[c]) for x in links], pa.int64()) for c in range(4)], names=["a", "b", "c", "d"])

    return few_tasks(_ends(rows.select("order", "a", "b", "ca", "cb", "words").mapInArrow(slide, "a long, b long, c long, d long")), tasks * TEXTS_A_TASK)


class _Neighbours:
    """The last WINDOW texts of an order, at most UNIT_WORDS words together, and what is joined."""

    def __init__(self):
        self.up: dict = {}
        self.start(None)

    def start(self, order) -> None:
        self.order, self.total, self.held = order, 0, []
        self.size = np.zeros(0, np.int64)
        self.counts = np.zeros((0, COUNTS), np.int32)

    def root(self, c):
        while self.up.get(c, c) != c:
            c = self.up[c]
        return c

    def meet(self, order, node: tuple, comp: tuple, text: np.ndarray, marks: tuple) -> list[tuple]:
        """Links of a text to those before it; then it is one of them."""
        if order != self.order:
            self.start(order)
        n, counts = len(text), word_counts(text).astype(np.int32)
        longer = np.maximum(self.size, n)
        most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
        d = self.counts - counts
        more = np.maximum(d, 0).sum(axis=1)
        links = []
        near = [self.held[i] for i in np.flatnonzero((np.abs(self.size - n) <= most) & (np.maximum(more, more - d.sum(axis=1)) <= most)).tolist()]
        for i in each_similar(text, [x[2] for x in near], lambda i: self.root(comp) != self.root(near[i][1]), (marks, [x[3] for x in near])):
            p, q = self.root(comp), self.root(near[i][1])
            if p != q:
                self.up[p] = q
                links.append((*node, *near[i][0]))
        self.held.append((node, comp, text, marks))
        self.size, self.counts = np.append(self.size, n), np.concatenate([self.counts, counts[None]])
        self.total += n
        drop = 0
        while len(self.held) - drop > WINDOW or (self.total > UNIT_WORDS and len(self.held) - drop > 1):
            self.total -= len(self.held[drop][2])
            drop += 1
        if drop:
            self.held, self.size, self.counts = self.held[drop:], self.size[drop:], self.counts[drop:]
        return links


def _ends(links: DataFrame) -> DataFrame:
    """Links as columns a, b, c, d -> distinct ``node, centre``."""
    x, y = F.struct("a", "b"), F.struct(F.col("c").alias("a"), F.col("d").alias("b"))
    return links.select(F.greatest(x, y).alias("node"), F.least(x, y).alias("centre")).distinct()


def word_counts(words: np.ndarray) -> np.ndarray:
    """Words per hash slot; one edit changes a side's surplus by at most 1."""
    return np.minimum(np.bincount(words % COUNTS, minlength=COUNTS), 0xFFFF).astype(np.uint16)


def open_pairs(own: np.ndarray, other: np.ndarray, size: np.ndarray, comp: np.ndarray, counts: np.ndarray):
    """Pairs (i of own, j of other) of different components that neither the lengths nor the
    word counts rule out at SIMILARITY; i < j where both sides are the same rows."""
    same = own is other
    for at in range(0, len(own), 64):
        i = own[at:at + 64]
        longer = np.maximum(size[i][:, None], size[other][None])
        ok = np.abs(size[i][:, None] - size[other][None]) <= (1 - SIMILARITY) * longer + 1e-9
        ok &= (comp[i][:, None] != comp[other][None]).any(axis=2)
        if same:
            ok &= np.arange(at, at + len(i))[:, None] < np.arange(len(other))[None]
        p, q = np.nonzero(ok)
        most = ((1 - SIMILARITY) * longer[p, q] + 1e-9).astype(np.int64)
        p, q = i[p], other[q]
        for k in range(0, len(p), 8192):
            x, y = p[k:k + 8192], q[k:k + 8192]
            d = counts[x].astype(np.int32) - counts[y]
            more = np.maximum(d, 0).sum(axis=1)
            left = np.maximum(more, more - d.sum(axis=1)) <= most[k:k + 8192]
            yield x[left], y[left]


def _units(m: DataFrame, parts: F.Column) -> DataFrame:
    """Members dealt by hash into ``parts`` chunks of their bucket, each chunk sent to every unit
    (bucket, lo, hi) of two chunks that it is in; one unit where there is one chunk."""
    return (m.withColumn("parts", parts.cast("int")).withColumn("own", F.pmod(F.xxhash64("node", "bucket"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))


UNIT = ["bucket", "lo", "hi"]


def _by_unit(batches, read):
    """The rows of whole units, one unit at a time, from batches in order of their units; ``read``
    makes a tuple of arrays of a batch, the unit's key first."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        new = read({c: b.column(c) for c in b.schema.names})
        held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
        cut = np.flatnonzero((held[0][1:] != held[0][:-1]).any(axis=1)) + 1
        for s, e in zip([0, *cut[:-1].tolist()], cut.tolist()):
            yield tuple(x[s:e] for x in held)
        if len(cut):                                             # the last unit may go on
            held = tuple(x[cut[-1]:] for x in held)
    if held is not None:
        yield held


def _sides(key: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two chunks of a unit (the same array for one)."""
    left = np.flatnonzero(own == key[0, 1])
    return left, left if key[0, 1] == key[0, 2] else np.flatnonzero(own == key[0, 2])


def _several(col: dict, *names) -> np.ndarray:
    return np.stack([np.asarray(col[x]).astype(np.int64) for x in names], axis=1)


def _flat(m: DataFrame) -> list:
    return ["bucket", "lo", "hi", "own", F.col("node.a").alias("a"), F.col("node.b").alias("b"), "n_words",
            F.col("comp.a").alias("ca"), F.col("comp.b").alias("cb")]


def compared(m: DataFrame, words: DataFrame) -> DataFrame:
    """``node, centre``: links that join the components of each bucket as far as its texts allow.

    Texts with a partner that lengths and hashed word counts leave open are found first, from the
    counts alone; then those meet with their words, and inside a unit a pair is aligned only while
    its ends are not joined.  A unit holds a bucket, or two chunks of one of more than CHUNK texts or
    UNIT_WORDS words, so a task holds a bounded number of words (or two very long texts)."""
    @F.arrow_udf("binary")
    def counted(x: pa.Array) -> pa.Array:
        return pa.array([word_counts(np.frombuffer(p.as_buffer(), np.uint32)).tobytes() for p in x], pa.binary())

    counts = words.select(F.col("node").alias("w"), counted("words").alias("counts"))
    u = _units(m.select("bucket", "n", "node", "n_words", "comp").join(counts, F.col("node") == F.col("w")), F.ceil(F.col("n") / F.lit(CHUNK)))

    def read_counts(col):
        return (_several(col, *UNIT), np.asarray(col["own"]), _several(col, "a", "b", "ca", "cb"), np.asarray(col["n_words"]),
                np.frombuffer(text_bytes(col["counts"])[0].tobytes(), np.uint16).reshape(-1, COUNTS))

    def mark(batches):
        for key, own, ids, size, counts in _by_unit(batches, read_counts):
            hit = np.zeros(len(key), bool)
            for x, y in open_pairs(*_sides(key, own), size, ids[:, 2:], counts):
                hit[x] = hit[y] = True
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[hit, 0]), *[pa.array(np.ascontiguousarray(ids[hit, i])) for i in range(4)], pa.array(size[hit])],
                                                 names=["bucket", "a", "b", "ca", "cb", "n_words"])

    rows = m.count()
    marked = (few_tasks(u.select(*_flat(u), "counts").repartition(*UNIT), rows, TEXTS_A_TASK).sortWithinPartitions(*UNIT)
              .mapInArrow(mark, "bucket long, a long, b long, ca long, cb long, n_words long"))
    marked = stored(few_tasks(marked.distinct().select("bucket", _node("a", "b"), F.struct(F.col("ca").alias("a"), F.col("cb").alias("b")).alias("comp"),
                                                       "n_words"), rows), "near-marked")
    rows = marked.count()
    size = few_tasks(marked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("all_words")), rows)
    w = _some(words, marked).select(F.col("node").alias("w"), "words")
    u = _units(small(marked.join(small(size, rows), "bucket"), rows).join(w, F.col("node") == F.col("w")),
               F.greatest(F.ceil(F.col("n") / F.lit(CHUNK)), F.ceil(F.col("all_words") / F.lit(UNIT_WORDS))))

    return linked_units(u.select(*_flat(u), "words"), _tasks(marked))


def _tasks(rows: DataFrame) -> int:
    return max(1, -(-rows.count() // TEXTS_A_TASK))


def linked_units(u: DataFrame, tasks: int) -> DataFrame:
    """``node, centre``: links between the two sides of each unit (rows as of :func:`_flat`, and words)
    that join components; a pair is aligned only while its ends are not joined."""
    def read_words(col):
        text = np.empty(len(col["words"]), object)
        text[:] = [np.frombuffer(x.as_py(), np.uint32) for x in col["words"]]
        return _several(col, *UNIT), np.asarray(col["own"]), _several(col, "a", "b", "ca", "cb"), np.asarray(col["n_words"]), text

    def link(batches):
        for key, own, ids, size, text in _by_unit(batches, read_words):
            counts, marks = np.stack([word_counts(t) for t in text]), list(all_marks(text))
            up: dict = {}

            def root(c):
                while up.get(c, c) != c:
                    c = up[c]
                return c

            comp = list(map(tuple, ids[:, 2:].tolist()))
            links = []
            for x, y in open_pairs(*_sides(key, own), size, ids[:, 2:], counts):
                for js in np.split(np.arange(len(x)), np.flatnonzero(x[1:] != x[:-1]) + 1):
                    if not len(js):
                        continue
                    i, js = int(x[js[0]]), y[js].tolist()
                    for k in each_similar(text[i], [text[j] for j in js], lambda k: root(comp[i]) != root(comp[js[k]]), (marks[i], [marks[j] for j in js])):
                        p, q = root(comp[i]), root(comp[js[k]])
                        if p != q:
                            up[p] = q
                            links.append((*ids[i, :2], *ids[js[k], :2]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([int(x[c]) for x in links], pa.int64()) for c in range(4)], names=["a", "b", "c", "d"])

    # coalesced, as a session may deal them to many more partitions
    links = u.repartition(tasks, *UNIT).coalesce(4 * tasks).sortWithinPartitions(*UNIT).mapInArrow(link, "a long, b long, c long, d long")
    return few_tasks(_ends(links), tasks * TEXTS_A_TASK)


def rarest(x: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Hashes of the rarest (word, number of its earlier occurrences) of a text: texts within the edits
    that SIMILARITY allows have all but that many in common, so they share one of these."""
    h, _ = labelled_kmers(x.astype(np.uint64), np.array([0, len(x)]), 1)
    o = np.lexsort((h, often[(h % _U(SLOTS)).astype(np.int64)]))
    return h[o[:int((1 - SIMILARITY) * len(x) + 1e-9) + 1]]


def remaining(large: DataFrame, words: DataFrame, label: DataFrame | None) -> DataFrame:
    """``node, centre``: every link left among the texts of large buckets (of open_members).

    Texts meet in buckets of their rarest words, where lengths, components and hashed word counts rule
    out most pairs before any text is sent.  Each text stands in one block of at most about CHUNK
    texts or UNIT_WORDS words of its largest bucket; two blocks are a unit for those of their texts that
    meet with a pair left open.  So a text goes once to each unit, however many words it shares there,
    and only to those where it may have a link; the other pairs cost a comparison of COUNTS bytes."""
    hot = stored(few_tasks(large.select("node", "n_words").distinct(), large.count()), "near-rest")
    n_hot = hot.count()
    texts = _some(words, hot).select(F.col("node").alias("w"), "words")
    texts = stored(small(hot).join(texts, F.col("node") == F.col("w")).select("node.a", "node.b", "n_words", "words"), "near-rest-words")

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            for x in b.column(0):
                h, _ = labelled_kmers((w := np.frombuffer(x.as_buffer(), np.uint32)).astype(np.uint64), np.array([0, len(w)]), 1)
                np.add.at(total, (h % _U(SLOTS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    slots = texts.select("words").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    got = few_tasks(slots, SLOTS).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[np.asarray(got["slot"])] = np.asarray(got["n"])
    shared = words.sparkSession.sparkContext.broadcast(often)

    def rare(batches):
        for b in batches:
            each = [rarest(np.frombuffer(x.as_buffer(), np.uint32), shared.value).view(np.int64) for x in b.column(3)]
            row = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in each]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *each])), *[b.column(i).take(row) for i in range(3)]],
                                             names=["bucket", "a", "b", "n_words"])

    met = stored(texts.mapInArrow(rare, "bucket long, a long, b long, n_words long").select("bucket", _node("a", "b"), "n_words"), "near-rarest")
    n_met = met.count()
    several = few_tasks(met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), n_met)
    m = open_members(met.join(stored(several, "near-several"), "bucket", "left_semi"), label).select("bucket", "node", "n_words", "comp")
    home = large.groupBy("node").agg(F.max(F.struct("n", "centre")).alias("top"), F.first("n_words").alias("n_words"))
    home = stored(few_tasks(home.select(F.col("node").alias("t"), F.col("top.centre").alias("home"), "n_words"), n_hot), "near-homes")
    size = home.groupBy(F.col("home").alias("h")).agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)), F.ceil(F.sum("n_words") / F.lit(UNIT_WORDS))).alias("parts"))
    block = home.join(small(size, n_hot), F.col("home") == F.col("h")).select("t", F.xxhash64("home", F.pmod(F.xxhash64("t"), F.col("parts"))).alias("block"))

    @F.arrow_udf("binary")
    def counted(x: pa.Array) -> pa.Array:
        return pa.array([np.minimum(word_counts(np.frombuffer(p.as_buffer(), np.uint32)), 255).astype(np.uint8).tobytes() for p in x], pa.binary())

    counts = texts.select(_node("a", "b"), counted("words").alias("counts"))
    block = stored(small(block, n_hot).join(counts, F.col("t") == F.col("node")).select("t", "block", "counts"), "near-blocks")
    m = m.join(small(block), F.col("node") == F.col("t")).select("bucket", "block", "n_words", "node.a", "node.b", F.col("comp.a").alias("ca"), F.col("comp.b").alias("cb"), "counts")

    def read_rows(col):
        return (_several(col, "bucket"), _several(col, "block", "a", "b", "ca", "cb", "n_words"),
                np.frombuffer(text_bytes(col["counts"])[0].tobytes(), np.uint8).reshape(-1, COUNTS))

    def pack(batches):
        held, n = [], 0
        for _, x, counts in _by_unit(batches, read_rows):
            held.append(meeting(x, counts))
            n += len(held[-1])
            if n > 1 << 20:
                held = [np.unique(np.concatenate(held), axis=0)]
                n = len(held[0])
        yield from _packed(held)

    def merge(batches):
        for key, rows in _by_unit(batches, lambda col: (_several(col, "lo", "hi"), np.array([x.as_py() for x in col["rows"]], object))):
            x = np.unique(np.concatenate([np.frombuffer(r, np.int64).reshape(-1, 6) for r in rows]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), v)) for v in (0, *key[0].tolist())] + [pa.array(np.ascontiguousarray(x[:, i])) for i in range(6)],
                                             names=["bucket", "lo", "hi", "own", "a", "b", "ca", "cb", "n_words"])

    packed = (few_tasks(m.repartition("bucket"), n_met).sortWithinPartitions("bucket").mapInArrow(pack, "lo long, hi long, rows binary"))
    packed = few_tasks(packed.repartition("lo", "hi"), n_met).sortWithinPartitions("lo", "hi")
    u = stored(packed.mapInArrow(merge, "bucket long, lo long, hi long, own long, a long, b long, ca long, cb long, n_words long"), "near-units")
    w = texts.select(F.col("a").alias("wa"), F.col("b").alias("wb"), "words")
    return linked_units(small(u).join(w, (F.col("a") == F.col("wa")) & (F.col("b") == F.col("wb"))).drop("wa", "wb"), _tasks(u))


def meeting(x: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """Rows (lo, hi, *row) of the texts of a bucket, once for each unit of two blocks in which a text has
    a partner that lengths, components and ``counts`` (hashed word counts, cut off at any value) leave
    open; ``x`` has a row (block, a, b, ca, cb, n_words) a text."""
    o = np.argsort(x[:, 5], kind="stable")
    size, comp, block = x[o, 5], x[o, 3:5], x[o, 0]
    counts = None if counts is None else counts[o]
    units = [np.zeros((0, 3), np.int64)]
    for at in range(0, len(x), 256):
        own = np.arange(at, min(at + 256, len(x)))
        # in order of length, the partners of a text that is not the longer one follow it
        other = np.arange(at, np.searchsorted(size, size[own[-1]] / SIMILARITY + 1, side="right"))
        ok = size[other][None] - size[own][:, None] <= (1 - SIMILARITY) * size[other][None] + 1e-9
        ok &= other[None] > own[:, None]
        ok &= (comp[own][:, None] != comp[other][None]).any(axis=2)
        p, q = np.nonzero(ok)
        p, q = own[p], other[q]
        for k in range(0, len(p), 8192):
            a, b = p[k:k + 8192], q[k:k + 8192]
            if counts is not None:
                d = counts[a].astype(np.int16) - counts[b]
                more = np.maximum(d, 0).sum(axis=1, dtype=np.int64)
                left = np.maximum(more, more - d.sum(axis=1, dtype=np.int64)) <= ((1 - SIMILARITY) * size[b] + 1e-9).astype(np.int64)
                a, b = a[left], b[left]
            lo, hi = np.minimum(block[a], block[b]), np.maximum(block[a], block[b])
            units.append(np.unique(np.concatenate([np.stack([lo, hi, a], axis=1), np.stack([lo, hi, b], axis=1)]), axis=0))
    got = np.concatenate(units)
    if len(units) > 2:
        got = np.unique(got, axis=0)
    return np.concatenate([got[:, :2], x[o[got[:, 2]]]], axis=1)


def _packed(held: list):
    """Distinct rows of :func:`meeting`, one record a unit."""
    x = np.unique(np.concatenate([np.zeros((0, 8), np.int64), *held]), axis=0)
    cut = np.flatnonzero((x[1:, :2] != x[:-1, :2]).any(axis=1)) + 1
    units = np.split(x, cut) if len(x) else []
    for at in range(0, len(units), 64):
        some = units[at:at + 64]
        yield pa.RecordBatch.from_arrays([pa.array([int(u[0, i]) for u in some], pa.int64()) for i in range(2)]
                                         + [pa.array([np.ascontiguousarray(u[:, 2:]).tobytes() for u in some], pa.binary())], names=["lo", "hi", "rows"])


def bucket_links(found: DataFrame, words: DataFrame) -> _Links:
    """All links of the buckets ``found`` (see the module's docstring)."""
    so_far = _Links()
    left = stored(star_rounds(found, words, so_far), "near-left")
    so_far.add(stored(compared(left.where(F.col("n") <= CHUNK), words), "near-compared"))
    large = stored(open_members(left.where(F.col("n") > CHUNK).select("bucket", "node", "n_words"), so_far.label), "near-large")
    if not large.isEmpty():
        so_far.add(stored(neighbours(large, words), "near-neighbours"))
        left = stored(open_members(large.select("bucket", "node", "n_words"), so_far.label), "near-last")
        if not left.isEmpty():
            so_far.add(stored(remaining(left, words, so_far.label), "near-remaining"))
    return so_far


def _bloom_slots(a: F.Column, b: F.Column) -> list:
    return [F.pmod(F.xxhash64(a, b, F.lit(i)), F.lit(BLOOM_BITS)) for i in range(2)]


def _bloom(nodes: DataFrame) -> np.ndarray:
    """Bit map of node digests; the driver gets at most BLOOM_BITS / 64 words.  It only spares
    shuffling words of documents without candidates; the join behind it is exact."""
    slot = nodes.select(F.explode(F.array(*_bloom_slots(F.col("node.a"), F.col("node.b")))).alias("s"))
    words = (slot.select(F.shiftright("s", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit"))
             .groupBy("w").agg(F.bit_or("bit").alias("bits")))
    words = few_tasks(words, BLOOM_BITS // 64).toArrow()
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    out[np.asarray(words["w"])] = np.asarray(words["bits"])
    return out


def candidate_words(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, words`` (32-bit hashes) of the distinct texts in ``nodes`` (and a few more)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_bloom(nodes))

    @F.arrow_udf("boolean")
    def maybe(s0: pa.Array, s1: pa.Array) -> pa.Array:
        bits = shared.value
        ok = np.ones(len(s0), bool)
        for s in (np.asarray(s0), np.asarray(s1)):
            ok &= (bits[s >> 6] >> (s & 63)) & 1 == 1
        return pa.array(ok)

    def run(batches):
        seen = set()
        for b in pieces(batches, "text"):
            words, first, dig = content(b.column(0))
            short = (words >> _U(32)).astype(np.uint32)
            keep = []
            for i, key in enumerate(zip(dig[0].tolist(), dig[1].tolist())):
                if key not in seen and first[i + 1] > first[i]:
                    seen.add(key)
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(dig[0][keep]), pa.array(dig[1][keep]),
                                              pa.array([short[first[i]:first[i + 1]].tobytes() for i in keep], pa.binary())],
                                             names=["a", "b", "words"])

    w = docs.select("text").mapInArrow(run, "a long, b long, words binary")
    w = w.where(maybe(*_bloom_slots(F.col("a"), F.col("b"))))
    return stored(w.groupBy("a", "b").agg(F.first("words").alias("words")).select(_node("a", "b"), "words"), "near-words")


def _some(words: DataFrame, nodes: DataFrame, column: str = "node") -> DataFrame:
    """The words of ``nodes``: where these are few they are broadcast, so that the others are not
    shuffled for nothing."""
    ids, rows = nodes.select(F.col(column).alias("some")).distinct(), nodes.count()
    if rows > FEW and ids.limit(FEW + 1).count() > FEW:
        return words
    return words.join(F.broadcast(few_tasks(ids, rows)), F.col("node") == F.col("some"), "left_semi")


def _with_words(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (node, centre) and the words of both, as ``x`` and ``y``."""
    few = pairs.count() <= SMALL
    w = (words if few else _some(words, pairs)).select(F.col("node").alias("wn"), F.col("words").alias("x"))
    c = _some(words, pairs, "centre").select(F.col("node").alias("wc"), F.col("words").alias("y"))
    both = (F.broadcast(pairs) if few else pairs).join(w, F.col("node") == F.col("wn")).drop("wn").join(c, F.col("centre") == F.col("wc")).drop("wc")
    # a few pairs are dealt out again: a common centre has many, other tasks next to none
    return both.repartition(_tasks(pairs)) if few else both


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (node, centre) whose texts are similar enough."""
    @F.arrow_udf("boolean")
    def close(x: pa.Array, y: pa.Array) -> pa.Array:
        texts = [np.frombuffer(t.as_buffer(), np.uint32) for pair in zip(x, y) for t in pair]
        marks = all_marks(texts)
        return pa.array([similar(a, b, marks=(next(marks), next(marks))) for a, b in zip(texts[::2], texts[1::2])], pa.bool_())

    return _with_words(pairs, words).where(close("x", "y")).select("node", "centre")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node: connected components by rounds of contraction.

    Each round gives every node its smallest neighbour (or itself), replaces the ends of
    links by those, and drops loops; node digests are random, so links shrink geometrically.
    Every round is written, so a lost executor repeats one round at most."""
    rows = 2 * links.count()                                 # links only get fewer
    kept = lambda df, tag: stored(few_tasks(df, rows, LINKS_A_TASK), tag)
    both = kept(links.select(F.col("node").alias("u"), F.col("centre").alias("v"))
                .unionByName(links.select(F.col("centre").alias("u"), F.col("node").alias("v"))).distinct(), "near-links")
    label = None
    while True:
        up = kept(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "near-up")
        if label is None:
            label = up.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            label = kept(label.join(up, label["root"] == up["u"], "left")
                         .select("node", F.coalesce("p", "root").alias("root")), "near-label")
        a = up.select(F.col("u").alias("k"), F.col("p").alias("pu"))
        b = up.select(F.col("u").alias("k"), F.col("p").alias("pv"))
        both = kept(both.join(a, F.col("u") == F.col("k")).select("pu", "v")
                    .join(b, F.col("v") == F.col("k")).select(F.col("pu").alias("u"), F.col("pv").alias("v"))
                    .where("u != v").distinct(), "near-links")
        if both.isEmpty():
            # trees of smallest neighbours: follow the last pointers to their roots
            while True:
                top = label.select(F.col("node").alias("k"), F.col("root").alias("r2"))
                nxt = kept(label.join(top, F.col("root") == F.col("k"), "left")
                           .select("node", F.coalesce("r2", "root").alias("new"), "root"), "near-label")
                done = nxt.where("new != root").isEmpty()
                label = nxt.select("node", F.col("new").alias("root"))
                if done:
                    return label


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, n_links, first, rk``.

    ``class_id`` is the smallest doc_id of the class (null only if all are null), ``n_links``
    the links of the document's text among those that hold its class together, ``first`` true
    for one row key (rk) of the class.  Equal word sequences are one text (texts without words:
    equal bytes; null is empty).  Repeated rows share one rk; other columns are not read; an
    empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(sketched(src), "near-rows")
    pick = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rk")
    nodes = stored(rows.groupBy("node").agg(F.min(pick).alias("top"), F.count(F.lit(1)).alias("copies"),
                                            F.first("n_words").alias("n_words"), F.first("bands").alias("bands")), "near-nodes")
    found = stored(members(nodes), "near-members")
    words = candidate_words(src, found.select("node").distinct())
    linked = bucket_links(found, words)
    none = nodes.select("node", F.col("node").alias("centre")).where("false")
    links = none
    for part in linked.parts:
        links = links.unionByName(part)
    root = none.withColumnRenamed("centre", "root") if linked.label is None else linked.label
    degree = (links.select("node").unionByName(links.select(F.col("centre").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    n, linked_texts = rows.count(), 0 if linked.label is None else linked.label.count()
    degree = few_tasks(degree, linked_texts)
    placed = (nodes.select("node", "top", "copies").join(small(root.withColumnRenamed("node", "k"), linked_texts), F.col("node") == F.col("k"), "left")
              .drop("k").join(small(degree.withColumnRenamed("node", "k"), linked_texts), F.col("node") == F.col("k"), "left")
              .select("node", "top", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    placed = stored(placed, "near-placed")
    group = stored(few_tasks(placed.groupBy("root").agg(F.min("top").alias("lead"), F.sum("copies").alias("class_size")), n), "near-groups")
    by_node = stored(placed.join(group.withColumnRenamed("root", "k"), F.col("root") == F.col("k"))
                     .select(F.col("node").alias("k"), "n_links", "lead", "class_size"), "near-classes")
    return (rows.select("doc_id", "rk", "node").join(by_node, F.col("node") == F.col("k"))
            .select("doc_id", F.col("lead.doc_id").alias("class_id"), "class_size", "n_links",
                    (F.col("rk") == F.col("lead.rk")).alias("first"), "rk"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one document of each class kept: the one with the smallest
    doc_id (null last), then row key.

    Of rows that repeat in doc_id and text one stays, the one whose columns as JSON have the
    smallest SHA-256, so reruns agree.  Null, empty and wordless texts are equal only to the same
    bytes (null to empty); an empty table gives an empty result; columns of any name pass through.
    """
    keep = stored(classes(docs).where("first").select(F.col("rk").alias(fresh("_keep", docs.columns))).distinct(), "near-keep")
    rk, row, order = (fresh(c, docs.columns) for c in ("_rk", "_row", "_order"))
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row_key("doc_id", F.coalesce("text", F.lit(""))).alias(rk), every.alias(row),
                        F.sha2(F.to_json(every), 256).alias(order))
    one = (keyed.join(keep, F.col(rk) == F.col(keep.columns[0]), "left_semi")
           .groupBy(rk).agg(F.min_by(row, order).alias(row)))
    return one.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
