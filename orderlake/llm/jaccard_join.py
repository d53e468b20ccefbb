"""N-gram Jaccard join with prefix trees.

1. Every text becomes its set of word 4-gram hashes.  Equal sets are one node
   from here on, so exact copies cost nothing more.
2. Candidates come from a prefix filter over a global order of the hashes (hash
   order, hashes held by many sets last): sets as similar as asked share one
   of their first hashes.  In each group that shares such a hash, sketches of
   the sets rule out pairs that are far apart; what may link is joined to
   families (connected components; no pair is ever written out).
3. Each family's sets are put in one order (most shared hashes first) and
   stored in a trie.  All sets of the family are run down the trie together:
   a shared path is counted once, and a subtree is left as soon as the lengths
   that remain can't reach the overlap asked.  A family too large for one task
   is cut into blocks and joined block by block.
4. Links become components, named by their smallest document.

What is exact: sets (up to 64-bit hash collisions), the similarity of each
pair that the trie compares, and the prefix of sets of up to about 150 hashes
(115 at 80 %).  Longer sets use the first SLOTS hashes only; each of those
differs from its partner's with a chance of at most 0.15 (0.2 at 80 %), so a
link is missed with a chance of less than 1e-12.  The constants are set for
80 % and more.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbytes as B
from orderlake.llm.common import checkpoint, groups, map_arrow, per_key

N = 4
PERCENT = 85
#: Hashes of a set that candidates look at, and those that count towards its sketch.
SLOTS, SKETCH = 24, 48
#: A hash in more sketches than this goes last in the order.
HOT = 64
#: Sketches with fewer ordinary hashes than this link through hot hashes too.  Sets with fewer than 12 of 48 need it;
#: a partner that similar has 30 or more with a chance of about 1e-12 only.  Below 85 % partners differ in more hashes:
#: at 80 % that chance is about 2e-10 for 30, and less than 1e-13 for 36.
HIGH, HIGH_BELOW_85 = 30, 36
#: Hashes two long sets' sketches must share to stay candidates (at 85 % about 40 of 48 are shared, at 80 % 38; fewer
#: than 16 with a chance of less than 1e-12 at either).
SKETCH_SHARED = 16
#: Hashes in one trie block, and identifiers in one broadcast (beyond it the texts are joined by a shuffle).
BLOCK = 500_000
BROADCAST_IDS = 250_000
#: Edges or nodes that a task of a round of ``components`` holds at least: with fewer, every shuffle would be mostly small files.
ROUND_ROWS = 100_000


def shingle_sets(texts: list[bytes], n: int = N) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams; of a shorter text, its whole sequence as one."""
    for a, b in B.chunks(texts):
        words, _, _, first = B.word_hashes(texts[a:b], B.SPACE)
        grams = B.gram_hashes(words, n).view(np.int64)
        for i in range(b - a):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= n:
                yield np.unique(grams[lo : hi - n + 1])
            elif hi > lo:
                yield B.gram_hashes(words[lo:hi], hi - lo)[:1].view(np.int64) + (hi - lo)
            else:
                yield np.zeros(0, np.int64)


def _raw(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _sid(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def signatures(rows: DataFrame, n: int) -> DataFrame:
    """doc_id, n, sid (the set's name), toks (its SKETCH smallest hashes) from (doc_id, text); further columns are kept."""
    more = rows.columns[2:]

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, name, toks = [], [], []
            for s in shingle_sets(_raw(batch.column(1)), n):
                size.append(len(s))
                name.append(_sid(s))
                toks.append(s[:SKETCH])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.array(toks, pa.list_(pa.int64())), *batch.columns[2:]],
                ["doc_id", "n", "sid", "toks", *more],
            )

    kept = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in more)
    return map_arrow(rows, sign, "doc_id long, n long, sid binary, toks array<long>" + kept)


def _packed(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` in as few partitions as its rows fill."""
    held = checkpoint(df)
    return held.coalesce(max(1, -(-held.count() // ROUND_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b); the root is the smallest node it reaches.

    Each round hooks every node to its smallest neighbour and contracts the
    edges.  Nodes are random names, so rounds grow with the logarithm of the
    longest path.
    """
    e = _packed(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    out = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = _packed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")))
        if out is None:
            out = hook.select("node", F.col("up").alias("root"))
        else:
            out = out.join(hook.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        left = e.join(hook.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(hook.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        e = _packed(left.where("ua != ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct())
        out = _packed(out)
        if e.isEmpty():
            return out


def _prefix_rows(reps: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sid, token) rows of the prefixes that some other set shares: ordinary ones, and hot ones."""
    tokens = reps.select("sid", F.explode("toks").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token", (F.col("c") > HOT).alias("hot"))
    found = tokens.join(shared, "token").groupBy("sid").agg(F.collect_list(F.struct("token", "hot")).alias("shared"))
    rows = reps.join(found, "sid")
    hots = F.array_sort(F.transform(F.filter("shared", lambda x: x["hot"]), lambda x: x["token"]))
    rows = rows.select("sid", "n", "toks", hots.alias("hots"), F.transform(F.filter("shared", lambda x: ~x["hot"]), lambda x: x["token"]).alias("warm"))
    rows = rows.withColumn("rest", F.array_except("toks", "hots"))
    exact = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rows = rows.withColumn("slots", F.least(exact, F.lit(SLOTS)).cast("int"))
    last = F.element_at("rest", F.least(F.size("rest"), F.col("slots")))
    rows = rows.withColumn("warm", F.when(F.size("rest") > 0, F.filter("warm", lambda t: t <= last)).otherwise(F.array().cast("array<long>")))
    # Sets known in full fill their prefix with hot hashes; of larger ones, those made mostly of hot hashes use them too.
    # From 80 % on, a set of up to 0.8 * SKETCH has only partners known in full.
    short = F.col("slots") - F.size("rest")
    high = HIGH if percent >= 85 else HIGH_BELOW_85
    fill = F.when((F.col("n") > 0.8 * SKETCH) & (F.size("rest") < high), F.lit(SLOTS)).when((F.col("n") <= SKETCH) & (short > 0), short).otherwise(F.lit(0))
    rows = rows.withColumn("hots", F.slice("hots", F.lit(1), fill))
    return rows.select("sid", F.explode("warm").alias("token")), rows.select("sid", F.explode("hots").alias("token"))


def _near(sizes: np.ndarray, sketches: list[bytes], percent: int) -> Iterator[tuple[int, int]]:
    """Edges that join the members of a small group whose sizes and sketches allow a link."""
    m = len(sizes)
    values = [np.frombuffer(s, np.int16) for s in sketches]
    flat = np.concatenate(values)
    names, inverse = np.unique(flat, return_inverse=True)
    inc = np.zeros((m, len(names)), np.float32)
    inc[np.repeat(np.arange(m), [len(v) for v in values]), inverse] = 1
    both = inc @ inc.T
    large, small = np.maximum.outer(sizes, sizes), np.minimum.outer(sizes, sizes)
    # Sketches are cut to 16 bits; chance equals can only raise the count, doubles in one sketch lower it by a few at most.
    need = np.where(large > SKETCH, SKETCH_SHARED - 2, np.ceil(large * percent / 100) - 2)
    ok = (both >= need) & (100 * small >= percent * large)
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(np.triu(ok, 1)), strict=True):
        a, b = find(int(i)), find(int(j))
        if a != b:
            root[max(a, b)] = min(a, b)
            yield int(i), int(j)


def families(reps: DataFrame, percent: int) -> DataFrame:
    """(sid, family) of the sets that may link to another."""
    warm, hot = _prefix_rows(reps, percent)
    warm, hot = checkpoint(warm), checkpoint(hot)
    # Hashes with the same holders are one group.
    lists = warm.groupBy("token").agg(F.array_sort(F.collect_list("sid")).alias("sids")).where(F.size("sids").between(2, 4 * HOT))
    lists = lists.groupBy("sids").agg(F.min("token").alias("token"))
    cut = F.transform("toks", lambda t: (F.pmod(t, F.lit(65536)) - 32768).cast("short"))
    sketch = reps.select("sid", "n", cut.alias("sketch"))
    members = lists.select("token", F.explode("sids").alias("sid")).join(sketch, "sid")

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, bytes]] = set()
        for t in groups(batches, ["token"]):
            sid = t.column("sid").to_pylist()
            sketches = [np.array(s, np.int16).tobytes() for s in t.column("sketch").to_pylist()]
            for i, j in _near(t.column("n").to_numpy(), sketches, percent):
                seen.add((sid[i], sid[j]))
            if len(seen) > 100_000:
                yield _edges(seen)
                seen = set()
        yield _edges(seen)

    near = map_arrow(members.repartition("token").sortWithinPartitions("token"), link, "a binary, b binary")
    # Larger groups: every holder is joined to the smallest one; the trie tells them apart.
    big = warm.join(warm.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 4 * HOT).select("token"), "token", "left_semi")
    wide = hot.unionByName(big)
    star = wide.join(per_key(wide, ["token"], F.min("sid").alias("a")), "token").select("a", F.col("sid").alias("b"))
    return components(near.unionByName(star)).select(F.col("node").alias("sid"), F.col("root").alias("family"))


def _edges(pairs: Iterable[tuple[bytes, bytes]]) -> pa.RecordBatch:
    pairs = list(pairs)
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])


class Trie:
    """Sets in one global order, stored as a trie of their sorted order and common prefix lengths."""

    STEP = 24

    def __init__(self, sets: list[np.ndarray], tree: np.ndarray, queries: np.ndarray, percent: int):
        self.percent, self.tree, self.queries = percent, tree, queries
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values, inverse, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.lexsort((values, -df))
        rank = np.empty(len(values), np.int32)
        rank[order] = np.arange(len(values), dtype=np.int32)
        cut = int((df > 1).sum())  # hashes of one set only come last and match nothing
        ranks = rank[inverse]
        del values, inverse, order, rank
        keep = ranks < cut
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[keep]
        ranks = ranks[keep]
        ranks = ranks[np.lexsort((ranks, owner))]
        first = np.searchsorted(owner, np.arange(len(sets) + 1))
        paths = [ranks[first[i] : first[i + 1]] for i in range(len(sets))]
        # Postings of the queries, by rank.
        number = np.full(len(sets), -1)
        number[queries] = np.arange(len(queries))
        mine = number[owner] >= 0
        r, q = ranks[mine], number[owner[mine]].astype(np.int32)
        by_rank = np.argsort(r, kind="stable")
        self.holders = q[by_rank]
        self.begin = np.searchsorted(r[by_rank], np.arange(cut + 1))
        self.qsizes = self.sizes[queries]
        self.place = np.array(sorted(tree, key=lambda i: paths[i].astype(">u4").tobytes()), np.int64)
        self.paths = [paths[i] for i in self.place]
        self.lcp = np.zeros(len(tree) + 1, np.int64)
        for k in range(1, len(tree)):
            a, b = self.paths[k - 1], self.paths[k]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.lcp[k] = differ[0] if len(differ) else n
        self.number = number

    def counted(self, ranks: np.ndarray) -> np.ndarray:
        """For each query, how many of the given hashes it holds."""
        lo, n = self.begin[ranks], self.begin[ranks + 1] - self.begin[ranks]
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.holders[at], minlength=len(self.queries)).astype(np.int32)

    def need(self, size: int) -> np.ndarray:
        """Least overlap of each query with a set of this size."""
        return -(-self.percent * (self.qsizes + size) // (100 + self.percent))

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """(set, queries that link to it), as indices of the sets given."""
        leaf_sizes = self.sizes[self.place]
        lengths = np.array([len(p) for p in self.paths], np.int64)
        stack = [(0, len(self.paths), 0, np.zeros(len(self.queries), np.int32))]
        while stack:
            lo, hi, depth, overlap = stack.pop()
            if hi - lo == 1:
                path, size, own = self.paths[lo], int(leaf_sizes[lo]), int(self.number[self.place[lo]])
                need = self.need(size)
                fits = (100 * np.minimum(self.qsizes, size) >= self.percent * np.maximum(self.qsizes, size)).astype(bool)
                if own >= 0:
                    fits[own] = False
                while fits.any():
                    fits &= overlap + (len(path) - depth) >= need
                    if depth >= len(path) or not fits.any():
                        break
                    step = path[depth : depth + self.STEP]
                    overlap = overlap + self.counted(step)
                    depth += len(step)
                found = np.flatnonzero(fits)
                if len(found):
                    yield int(self.place[lo]), self.queries[found]
                continue
            common = int(self.lcp[lo + 1 : hi].min())
            if common > depth:
                overlap = overlap + self.counted(self.paths[lo][depth:common])
                depth = common
                # The longest rest below, against the smallest set below.
                if not (overlap + int(lengths[lo:hi].max()) - depth >= self.need(int(leaf_sizes[lo:hi].min()))).any():
                    continue
            cuts = [lo, *(lo + 1 + np.flatnonzero(self.lcp[lo + 1 : hi] == common)).tolist(), hi]
            stack += [(a, b, depth, overlap) for a, b in zip(cuts, cuts[1:], strict=False)]


def trie_components(sets: list[np.ndarray], tree: np.ndarray, queries: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Labels of the components that links between tree and queries make."""
    label = np.arange(len(sets))
    for s, found in Trie(sets, tree, queries, percent).links():
        old = np.unique(np.append(label[found], label[s]))
        if len(old) > 1:
            label[np.isin(label, old)] = old[0]
    return label


def link_families(docs: DataFrame, reps: DataFrame, fams: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) edges between sets of a family that link, enough to connect them."""
    weight = F.col("n")
    sized = reps.select("sid", "n", "rep").join(fams, "sid")
    blocks = per_key(sized, ["family"], F.ceil(F.sum(weight) / BLOCK).cast("int").alias("blocks"))
    sized = checkpoint(sized.join(blocks, "family"))
    wanted = sized.select(F.col("rep").alias("wanted"), "sid", "family", "blocks")
    if sized.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("wanted"))).select("text", "sid", "family", "blocks")

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sets = [], []
            for i, (s, sid) in enumerate(zip(shingle_sets(_raw(batch.column(0)), n), batch.column(1).to_pylist(), strict=True)):
                if _sid(s) == sid:  # an identifier may have other texts too
                    keep.append(i)
                    sets.append(s.tobytes())
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(3), pa.array(sets, pa.binary())], ["sid", "family", "blocks", "members"])

    loaded = map_arrow(texts, load, "sid binary, family binary, blocks int, members binary")
    block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    pairs = loaded.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "members")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["family", "i", "j"]):
            # A text may be there twice (repeated rows): one of each set is enough.
            rows = {s: (b, m) for s, b, m in zip(t.column("sid").to_pylist(), t.column("block").to_pylist(), t.column("members").to_pylist(), strict=True)}
            if len(rows) < 2:
                continue
            sids = list(rows)
            sets = [np.frombuffer(m, np.int64) for _, m in rows.values()]
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            at = np.array([b for b, _ in rows.values()])
            tree, queries = np.flatnonzero(at == j), np.flatnonzero(at == i)
            if not len(tree) or not len(queries):
                continue
            label = trie_components(sets, tree, queries, percent)
            yield _edges([(sids[int(r)], sids[k]) for k, r in enumerate(label) if r != k])
        yield _edges([])

    keys = ["family", "i", "j"]
    return map_arrow(pairs.repartition(*keys).sortWithinPartitions(*keys), join, "a binary, b binary")


def _linked(rows: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of the rows, their sets (sid, rep, n, toks), and (node, root) of the sets that link to another."""
    sig = checkpoint(signatures(rows, n))
    classes = sig.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("toks").alias("toks"))
    reps = checkpoint(classes)
    return sig, reps, components(link_families(rows, reps, families(reps, percent), n, percent))


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Words are runs without ``[\\x20\\x09-\\x0D]``, A-Z in lower case.  Null
    texts and texts without words have the empty set and link to nothing;
    their component is their own doc_id.  Null identifiers link like others
    but never name a component that has another; rows that repeat an
    identifier count each for its own text.  An empty table gives no rows;
    extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig, reps, linked = _linked(rows, n, percent)
    own = sig.select("doc_id", "n", "sid")
    named = linked.join(reps.select(F.col("sid").alias("node"), "rep"), "node")
    best = per_key(named, ["root"], F.min("rep").alias("component_id"))
    named = named.join(best, "root").select(F.col("node").alias("sid"), "component_id")
    whole = reps.select("sid", "rep").join(named, "sid", "left").select("sid", F.coalesce("component_id", "rep").alias("component_id"))
    return own.join(whole, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that name their component, all columns kept.

    Rows without an identifier stay.  An identifier that is there more than
    once goes only if all its rows would.
    """
    found = jaccard_components(docs, n, percent).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min((F.col("component_id") != F.col("doc_id")).cast("int")).alias("go"))
    gone = checkpoint(found.where("go = 1").select(F.col("doc_id").alias("_gone")))
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def one_per_component(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept.

    The row with the smallest identifier stays; one without an identifier
    only if no other has one.  Each row is decided by identifier and text
    digest, so rows that repeat an identifier are told apart, and of rows that
    repeat both, one stays.  Rows without words are copies of nothing and all
    stay.  Only rows that go, or that repeat both, are joined to the texts.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    digest = F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), digest.alias("digest"))
    sig, _, linked = _linked(rows, n, percent)
    own = sig.where("sid IS NOT NULL").select("doc_id", "digest", "sid").join(linked.withColumnRenamed("node", "sid"), "sid", "left")
    own = own.select("doc_id", "digest", F.coalesce("root", "sid").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("i"), F.col("digest").alias("d")))
    best = per_key(own, ["root"], first.alias("best"), F.count(F.lit(1)).alias("c")).where("c > 1").select("root", "best")
    stays = F.col("doc_id").eqNullSafe(F.col("best.i")) & (F.col("digest") == F.col("best.d"))
    many = checkpoint(own.join(best, "root").groupBy("doc_id", "digest").agg(F.min(stays).alias("stays"), F.count(F.lit(1)).alias("c")))

    def keys(found: DataFrame) -> tuple[DataFrame, int]:
        found = found.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
        size = found.count()
        return (F.broadcast(found) if size <= BROADCAST_IDS else found), size

    gone, _ = keys(many.where("NOT stays"))
    twice, repeats = keys(many.where("stays AND c > 1"))
    same = lambda k: docs["doc_id"].cast("long").eqNullSafe(k["_id"]) & (digest == k["_digest"])
    out = docs.join(gone, same(gone), "left_anti")
    if not repeats:
        return out
    marked = docs.join(twice, same(twice)).dropDuplicates(["_id", "_digest"]).select(*docs.columns)
    return out.join(twice, same(twice), "left_anti").unionByName(marked)
