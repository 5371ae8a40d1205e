"""Operator 4, benchmark decontamination with suffix arrays of the training words.

Documents are cut into shards of whole texts; each shard gets a suffix array over its word
hashes, and every suffix of every benchmark item is located in it by binary search, one
word of depth at a time.  The interval of a 10-word prefix gives all its occurrences; runs
of occurrences on one diagonal are the verbatim matches and their places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import fresh, prepare, stored, trim, words_of

WINDOW_WORDS = 10
SHARD_WORDS = 400_000            # a longer text is a shard of its own
BLOCK_BYTES = 16 * 1024 * 1024   # benchmark text broadcast at once
_U = np.uint64


def suffix_array(h: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of ``h`` (0 ends a text and sorts first), exact for the first ``depth``
    words: prefix doubling, re-sorting only suffixes that still tie."""
    n = len(h)
    sa = np.argsort(h)
    hs = h[sa]
    new = np.empty(n, bool)
    new[:1] = True
    np.not_equal(hs[1:], hs[:-1], out=new[1:])
    idx = np.arange(n)
    start = np.maximum.accumulate(np.where(new, idx, 0))
    rank = np.empty(n + 1, np.int64)
    rank[sa] = start
    rank[n] = 0
    alone = new & np.append(new[1:], True)
    u = np.flatnonzero(~alone & (hs != 0))
    step = 1
    while step < depth and len(u):
        p = sa[u]
        key = (rank[p].astype(np.uint64) << _U(32)) | rank[np.minimum(p + step, n)].astype(np.uint64)
        o = np.argsort(key)
        p, key = p[o], key[o]
        sa[u] = p
        new = np.empty(len(u), bool)
        new[:1] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        rank[p] = np.maximum.accumulate(np.where(new, u, 0))
        u = u[~(new & np.append(new[1:], True))]
        step *= 2
    return sa


def _narrow(word, sa, lo, hi, depth, target):
    """Sub-interval of each [lo, hi) of the suffix order whose word at ``depth`` is the
    target (binary search; all suffixes of an interval agree on the words before)."""
    bounds = []
    for upper in (False, True):
        a, b = lo.copy(), hi.copy()
        for _ in range(int((hi - lo).max(initial=0)).bit_length()):
            mid = (a + b) >> 1
            w = word[sa[np.minimum(mid, len(sa) - 1)] + depth]
            right = (w <= target) if upper else (w < target)
            go = a < b
            a = np.where(go & right, mid + 1, a)
            b = np.where(go & ~right, mid, b)
        bounds.append(a)
    return bounds


class TestSuffixes:
    """Word hashes of a block of benchmark items and the start of every suffix."""

    __test__ = False

    def __init__(self, item_ids: list[list[str]], texts: pa.Array, window: int):
        self.items = item_ids                                  # of each text, all that have it
        self.words, self.first = words_of(texts)
        self.words = np.where(self.words == 0, _U(1), self.words)
        n = np.diff(self.first)
        self.item_of = np.repeat(np.arange(len(n)), n)
        self.left = np.repeat(self.first[1:], n) - np.arange(len(self.words))   # suffix length
        k = np.minimum(n, window)[self.item_of]
        self.need = np.where(self.left >= k, k, 0)             # window length; 0: no window
        self.depth = int(n.max(initial=0))


def locate(tests: TestSuffixes, h: np.ndarray, sa: np.ndarray):
    """Binary search of every test suffix in one shard.

    Returns (lo, hi, longest): the interval of the suffix's window (empty where it does not
    occur) and the length of its longest verbatim match in the shard."""
    m = len(tests.words)
    lo, hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
    longest = np.zeros(m, np.int64)
    if m == 0 or len(h) == 0:
        return lo, hi, longest
    word = np.concatenate([h, np.zeros(tests.depth + 1, np.uint64)])
    hs = h[sa]
    act = np.arange(m)
    a = np.searchsorted(hs, tests.words, side="left")
    b = np.searchsorted(hs, tests.words, side="right")
    d = 1
    while True:
        on = a < b
        act, a, b = act[on], a[on], b[on]
        longest[act] = d
        at = tests.need[act] == d
        lo[act[at]], hi[act[at]] = a[at], b[at]
        on = tests.left[act] > d
        act, a, b = act[on], a[on], b[on]
        if not len(act):
            return lo, hi, longest
        a, b = _narrow(word, sa, a, b, d, tests.words[act + d])
        d += 1


def _expand(lo, hi):
    """(query number, position in the order) of every member of the intervals."""
    n = hi - lo
    q = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return q, at


def shard_matches(tests: TestSuffixes, texts: pa.Array):
    """Occurrences of the test windows in one shard of texts.

    Returns word counts per text, merged hit intervals (text, start, end) in words of the
    text, and maximal verbatim matches (text, item, text word, item word, words)."""
    words, first = words_of(texts)
    n_docs = len(first) - 1
    n_words = np.diff(first)
    none = np.zeros((0, 3), np.int64), np.zeros((0, 5), np.int64)
    if not len(words) or not len(tests.words):
        return n_words, *none
    h = np.zeros(len(words) + n_docs, np.uint64)               # a 0 behind every text
    doc = np.repeat(np.arange(n_docs), n_words)
    h[np.arange(len(words)) + doc] = np.where(words == 0, _U(1), words)
    sa = suffix_array(h, tests.depth)
    lo, hi, _ = locate(tests, h, sa)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return n_words, *none
    text_first = first[:-1] + np.arange(n_docs)                # text starts in h
    # hit words: each distinct window interval once
    _, one = np.unique(np.stack([lo[found], tests.need[found]]), axis=1, return_index=True)
    one = found[one]
    q, at = _expand(lo[one], hi[one])
    p = sa[at]
    cover = np.bincount(p, minlength=len(h) + 1) - np.bincount(p + tests.need[one][q], minlength=len(h) + 1)[:len(h) + 1]
    hit = np.cumsum(cover)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    s, e = edge[0::2], edge[1::2]                              # a 0 is never hit: no run leaves its text
    d = np.searchsorted(text_first, s, side="right") - 1
    hits = np.stack([d, s - text_first[d], e - text_first[d]], axis=1)
    # matches: consecutive windows of one item on one diagonal
    q, at = _expand(lo[found], hi[found])
    p, sfx = sa[at], found[q]
    item = tests.item_of[sfx]
    o = np.lexsort((p, p - sfx, item))
    p, sfx, item = p[o], sfx[o], item[o]
    same = (np.diff(p) == 1) & (np.diff(sfx) == 1) & (np.diff(item) == 0)
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    tail = np.append(head[1:], len(p)) - 1
    d = np.searchsorted(text_first, p[head], side="right") - 1
    length = p[tail] - p[head] + tests.need[sfx[tail]]
    return n_words, hits, np.stack([d, item[head], p[head] - text_first[d], sfx[head] - tests.first[item[head]], length], axis=1)


class _Blocks:
    """The benchmark in blocks of about BLOCK_BYTES of distinct texts, each with the list of its
    item ids.  Repeated rows and texts are one, so a block grows with no item's repeats; one block
    at a time is collected, broadcast and released."""

    def __init__(self, benchmark: DataFrame, window: int):
        b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.texts = stored(b.groupBy("text").agg(F.array_sort(F.collect_set("item_id")).alias("ids")), "benchmark-texts")
        self.window = window
        total = self.texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.n = max(1, -(-total // BLOCK_BYTES))

    def __len__(self):
        return self.n

    def __iter__(self):
        for k in range(self.n):
            part = self.texts.where(F.pmod(F.xxhash64("text"), F.lit(self.n)) == k) if self.n > 1 else self.texts
            t = part.toArrow()
            texts = pa.concat_arrays(t["text"].cast(pa.large_string()).chunks) if t.num_rows else pa.array([], pa.large_string())
            yield TestSuffixes(t["ids"].to_pylist(), texts, self.window)


def _shards(batches, at: int):
    """Consecutive record batches of about SHARD_WORDS words (whole texts), as tables."""
    held, n = [], 0
    for b in batches:
        i = 0
        while i < b.num_rows:
            t = b.column(at)
            size = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(t), 0))[i:])])
            # a word takes about six bytes
            j = i + max(1, int(np.searchsorted(size, max(1, 6 * SHARD_WORDS - n), side="right")) - 1)
            j = min(j, b.num_rows)
            held.append(b.slice(i, j - i))
            n += int(size[j - i])
            i = j
            if n >= 6 * SHARD_WORDS or i < b.num_rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)
    held = None
    trim()


def _scan(df: DataFrame, text: str, tests: TestSuffixes, out: str, finish) -> DataFrame:
    """Add to each row the matches of one block of tests; ``finish(table, n_words, hits,
    matches, tests)`` makes the rows of schema ``out``."""
    shared = df.sparkSession.sparkContext.broadcast(tests)
    at = df.columns.index(text)

    def run(batches):
        t = shared.value
        for table in _shards(batches, at):
            col = table.column(at).cast(pa.large_string())
            yield from finish(table, *shard_matches(t, pa.concat_arrays(col.chunks)), t).to_batches()

    return df.mapInArrow(run, out)


def _union_length(iv: np.ndarray) -> int:
    """Words in the union of (start, end) intervals."""
    if not len(iv):
        return 0
    iv = iv[np.argsort(iv[:, 0], kind="stable")]
    reach = np.maximum.accumulate(iv[:, 1])
    prev = np.concatenate([[0], reach[:-1]])
    return int(np.maximum(0, reach - np.maximum(iv[:, 0], prev)).sum())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with ``n_words, n_hit, longest`` (longest verbatim match in words) and
    ``items`` (distinct item ids with occurring windows) added, under names from
    :func:`contamination_names` that clash with no column of ``docs``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one.
    Null or wordless texts and items match nothing; repeated items count once (a null
    item_id is the empty string); repeated rows are each reported; an empty benchmark hits
    nothing; other columns pass through.  No shuffle: the benchmark is broadcast in blocks
    of measured size, and with several blocks the rows are written between passes.
    """
    prepare(docs.sparkSession)
    names = contamination_names(docs.columns)
    blocks = _Blocks(benchmark, window)
    carry = [fresh("_hits", docs.columns), fresh("_items", docs.columns), fresh("_longest", docs.columns)]
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    types = docs.schema
    df = docs
    for k, tests in enumerate(blocks):
        final = k == len(blocks) - 1
        width = len(docs.columns)

        def finish(table, n_words, hits, matches, tests, final=final, first=k == 0):
            n = table.num_rows
            cut = np.searchsorted(hits[:, 0], np.arange(n + 1))
            iv = [hits[a:b, 1:] for a, b in zip(cut[:-1], cut[1:])]
            ids: list[set] = [set() for _ in range(n)]
            longest = np.zeros(n, np.int64)
            if len(matches):
                np.maximum.at(longest, matches[:, 0], matches[:, 4])
                for d, i in np.unique(matches[:, :2], axis=0).tolist():
                    ids[d].update(tests.items[i])
            if not first:
                old_iv, old_ids, old_long = (table.column(width + i).to_pylist() for i in range(3))
                iv = [np.concatenate([x, np.frombuffer(o, np.int64).reshape(-1, 2)]) for x, o in zip(iv, old_iv)]
                ids = [x | set(o) for x, o in zip(ids, old_ids)]
                longest = np.maximum(longest, np.array(old_long, np.int64))
            kept = [table.column(i) for i in range(width)]
            items = pa.array([sorted(x) for x in ids], pa.list_(pa.string()))
            if final:
                cols = [pa.array(n_words, pa.int64()), pa.array([_union_length(x) for x in iv], pa.int64()),
                        pa.array(longest, pa.int64()), items]
                return pa.table(kept + cols, names=[f.name for f in types.fields] + names)
            cols = [pa.array([x.astype(np.int64).tobytes() for x in iv], pa.binary()), items, pa.array(longest, pa.int64())]
            return pa.table(kept + cols, names=[f.name for f in types.fields] + carry)

        add = (f"`{names[0]}` long, `{names[1]}` long, `{names[2]}` long, `{names[3]}` array<string>" if final
               else f"`{carry[0]}` binary, `{carry[1]}` array<string>, `{carry[2]}` long")
        df = _scan(df, "text", tests, f"{base}, {add}", finish)
        if not final:
            df = stored(df, "decontaminate")
    return df


def contamination_names(columns) -> list[str]:
    return [fresh(c, columns) for c in ("n_words", "n_hit", "longest", "items")]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark window occurs: null and wordless texts
    stay, repeated rows stay or go together, with an empty benchmark all stay; an empty table gives
    an empty result; columns of any name pass through."""
    n_hit = contamination_names(docs.columns)[1]
    return contamination(docs, benchmark, window).where(F.col(n_hit) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Maximal verbatim matches of at least a window: ``doc_id, item_id, doc_word,
    item_word, n_words`` (word positions from 0).

    Null or wordless texts and items match nothing; of items that repeat in id and text one
    counts (a null item_id is the empty string); repeated documents each match; an empty table on
    either side gives an empty result; other columns are not read."""
    prepare(docs.sparkSession)
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def finish(table, n_words, hits, matches, tests):
        ids = [tests.items[i] for i in matches[:, 1].tolist()]
        row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])        # a match for each item of the text
        m = matches[row]
        return pa.table([table.column(0).take(pa.array(m[:, 0])), pa.array([y for x in ids for y in x], pa.string()),
                         *[pa.array(m[:, c], pa.int64()) for c in (2, 3, 4)]],
                        names=["doc_id", "item_id", "doc_word", "item_word", "n_words"])

    parts = [_scan(src, "text", t, f"doc_id {kind}, item_id string, doc_word long, item_word long, n_words long", finish)
             for t in _Blocks(benchmark, window)]
    if len(parts) > 1:                                         # written, so that each block is released
        parts = [stored(p, "verbatim") for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest`` per row."""
    c = contamination(docs.select("doc_id", "text"), benchmark, window)
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"), "longest")
