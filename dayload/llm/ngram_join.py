"""Set-similarity join of documents by a prefix tree over their word n-grams.

A document's set holds the hashes of its distinct n-word shingles under one
global order: shingles that few places hold come first (by hash), those that
very many hold last, by count.  Two sets can reach the threshold only if they
share one of their first ``|s| - ceil(t |s|) + 1`` members, their prefix.

1. Equal sets become one node, known by its smallest document id.
2. Prefix members go to buckets, packed; what comes out are the members that
   two or more nodes share, one row for each such node.  A member that a task
   finds shared by itself sends one row on, whatever the number of nodes.
3. Each node is compared exactly with the smallest node of its shared members,
   so that a large family of near copies becomes one component at linear cost.
4. Nodes of different components that share a member meet in prefix trees: the
   rest of each prefix is stored in a trie, a probe walks the shared paths once
   and leaves a subtree as soon as the lengths that remain can't reach the
   overlap needed.  Large groups are cut into blocks that meet in pairs.
   Pairs within a component are skipped (they can't change it).
5. Pairs whose signatures differ in more bits than the threshold lets the sets
   differ in members are out; the sets of the pairs left are built again from
   their texts and compared exactly, and components are taken again.

A prefix keeps the upper ``KEPT`` bytes of each member's key, a tail ``HALF`` of
them.  Members that become equal by that only add candidates: equal values of a
tail are numbered, so that two tails share at least as many as before.

No link between different texts is lost: step 4 visits every pair of nodes in
different components that shares a prefix member.

Defined results: a text that is null or has no words has an empty set, links
with nothing and is its own component; fewer than n words are one shingle, the
whole sequence; a row with a null id takes no part and its component is null;
rows that share an id are one vertex (each keeps its own set size); repeated
rows give repeated results; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_bits, bucket_of, by_bucket, count_locally, each_bucket, heavy_hashes, partitions, payload_batches, saved, scatter, whole_groups
from .components import components
from .words import Words, batches_of, gram_starts, grams, hashed, mix, text_buffer

#: Words of a shingle; the similarity as a fraction of whole numbers.
SHINGLE, ABOVE, OF = 4, 85, 100
#: Prefix members that a task groups together before it sends them.
CHUNK_MEMBERS = 2_000_000
#: Nodes of one shared member that meet in one tree; larger groups are cut into blocks of about this size.
BLOCK = 1000
#: log2 of the bits (2 MB) by which texts that no pair needs are passed over.
FILTER_BITS = 24
#: Nodes of a shared member up to which hopeless ones are dropped before prefixes are sent; trees drop the others.
FEW = 64


def _sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    h = hashed(words)
    g = grams(h, n)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            yield np.unique(g[a:b - n + 1])
        else:
            yield grams(h[a:b], b - a) if b > a else g[:0]


def _ordered(s: np.ndarray, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A set in the global order: unsigned keys, heavy members above all others."""
    key = s >> np.uint64(1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        held = hot[at] == s
        key = np.where(held, (np.uint64(1) << np.uint64(63)) | (rank[at] << np.uint64(40)), key)
    return np.sort(key)


def prefix_length(n: int, above: int, of: int) -> int:
    return n - -(-above * n // of) + 1


def _heavy(rows: DataFrame, n: int, bits: int) -> np.ndarray:
    def count(batches):
        held, size = [], 0

        def parts():
            nonlocal held, size
            for batch in batches:
                for _, _, w in batches_of(batch, "text", lower=True):
                    g = grams(hashed(w), n)[gram_starts(w, n)]
                    held.append(g)
                    size += len(g)
                    if size > 2 * CHUNK_MEMBERS:
                        yield from count_locally(held, bits, 2)
                        held, size = [], 0
            yield from count_locally(held, bits, 2)

        yield from payload_batches(parts())

    return heavy_hashes(rows.select("text").mapInArrow(count, "bucket int, payload binary"))


PARTS = ["high", "low", "marks"]  # of a node: the halves of its prefix's members, and its signature
#: Bytes of a member's key that a prefix keeps, in two halves; the first one tells heavy members apart.
KEPT, HALF = 6, 3


def halves(prefix: np.ndarray) -> tuple[bytes, bytes]:
    """The upper ``KEPT`` bytes of sorted keys as two columns of ``HALF`` bytes each, in the same order; equal members stay equal."""
    raw = np.ascontiguousarray(prefix.astype(">u8")).view(np.uint8).reshape(-1, 8)
    return raw[:, HALF - 1::-1].tobytes(), raw[:, KEPT - 1:HALF - 1:-1].tobytes()


def _whole(half: bytes | np.ndarray) -> np.ndarray:
    """The numbers of a column of ``HALF`` bytes each."""
    out = np.zeros((len(half) // HALF, 4), np.uint8)
    out[:, :HALF] = np.frombuffer(half, np.uint8).reshape(-1, HALF)
    return out.view("<u4").ravel()


def tail_codes(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sorted members of tails, one after the other from ``first`` on; equal ones of a tail are numbered and stay sorted."""
    code = _whole(data)
    again = np.zeros(len(code), bool)
    again[1:] = code[1:] == code[:-1]
    again[first[(first > 0) & (first < len(code))]] = False
    if not again.any():
        return code << np.uint32(8)
    at = np.arange(len(code))
    number = at - np.maximum.accumulate(np.where(again, 0, at))
    if number.max() < 256:
        return code << np.uint32(8) | number.astype(np.uint32)
    return code.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)


def signature(s: np.ndarray) -> bytes:
    """The members hashed into about four bits each; a power of two bytes, so signatures fold onto each other."""
    bits = max(64, 1 << (4 * max(1, len(s)) - 1).bit_length())
    held = np.zeros(bits, np.uint8)
    held[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(held).tobytes()


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the members that only one of two sets has, from their signatures: bits that differ."""
    while len(a) > len(b):
        a = a[:len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] | b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def set_prefixes(rows: DataFrame, n: int, above: int, of: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set, and the ``PARTS`` of a node."""
    spark = rows.sparkSession
    heavy = _heavy(rows, n, bucket_bits(spark))
    by = np.argsort(heavy)
    order = spark.sparkContext.broadcast((heavy[by], by.astype(np.uint64)))

    def run(batches):
        hot, rank = order.value
        for batch in batches:
            sizes, one, two, high, low, marks = [], [], [], [], [], []
            for _, _, w in batches_of(batch, "text", lower=True):
                for s in _sets(w, n):
                    sizes.append(len(s))
                    one.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(mix(s ^ np.uint64(0x5BF03635)).sum(dtype=np.uint64).view(np.int64)))
                    prefix = _ordered(s, hot, rank)[:prefix_length(len(s), above, of)] if len(s) else s
                    upper, lower = halves(prefix)
                    high.append(upper)
                    low.append(lower)
                    marks.append(signature(s))
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                                   *(pa.array(x, pa.binary()) for x in (high, low, marks))], names=["doc_id", "n_shingles", "fp_a", "fp_b", *PARTS])

    return rows.mapInArrow(run, f"doc_id long, n_shingles long, fp_a long, fp_b long, {', '.join(c + ' binary' for c in PARTS)}")


_MEMBER = ["<u8", "<i8", "<u4", "<u4", "u1"]


def shared_members(nodes: DataFrame) -> DataFrame:
    """(token, rep, n, pos) for each prefix member that two or more nodes hold."""
    bits = bucket_bits(nodes.sparkSession)

    def send(batches):
        held, size = [], 0

        def flush():
            if not held:
                return
            token, rep, n, pos = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((rep, token))
            token, rep, n, pos = (a[order] for a in (token, rep, n, pos))
            first = np.r_[True, token[1:] != token[:-1]]
            group = np.cumsum(first) - 1
            many = (np.bincount(group) > 1)[group]
            to = bucket_of(mix(token), bits)
            one = np.ones(len(token), np.uint8)
            yield from scatter(to[first], [token[first], rep[first], n[first], pos[first], many[first].astype(np.uint8)])
            rest = ~first
            for b, p in scatter(to[rest], [token[rest], rep[rest], n[rest], pos[rest], one[rest]]):
                yield -1 - b, p

        def parts():
            nonlocal held, size
            for batch in batches:
                for rep, n, high, low in zip(*(batch.column(c).to_pylist() for c in ("rep", "n", "high", "low"))):
                    t = _whole(high).astype(np.uint64) << np.uint64(8 * HALF) | _whole(low)
                    held.append((t, np.full(len(t), rep, np.int64), np.full(len(t), n, np.uint32), np.arange(len(t), dtype=np.uint32)))
                    size += len(t)
                if size > CHUNK_MEMBERS:
                    yield from flush()
                    held, size = [], 0
            yield from flush()

        yield from payload_batches(parts())

    def receive(batches):
        for b, (token, rep, n, pos, many) in each_bucket(batches, _MEMBER):
            if b >= 0:
                order = np.argsort(token, kind="stable")
                token, rep, n, pos, many = (a[order] for a in (token, rep, n, pos, many))
                cut = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
                sizes = np.diff(np.r_[cut, len(token)])
                keep = np.repeat((sizes > 1) | (np.maximum.reduceat(many, cut) > 0), sizes)
                token, rep, n, pos = (a[keep] for a in (token, rep, n, pos))
            if len(token):
                yield pa.record_batch([pa.array(token.view(np.int64)), pa.array(rep), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))],
                                      names=["token", "rep", "n", "pos"])

    return by_bucket(nodes.select("rep", "n", "high", "low").mapInArrow(send, "bucket int, payload binary"), receive, "token long, rep long, n int, pos int")


def _not_refuted(pairs: DataFrame, nodes: DataFrame, above: int, of: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in no more bits than the threshold lets their sets differ in members."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "n", "m"))):
                # J >= t needs |A - B| + |B - A| <= (1 - t) / (1 + t) * (|A| + |B|)
                keep.append(differing(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) * (of + above) <= (of - above) * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sides = (pairs.join(nodes.select(F.col("rep").alias("b"), F.col("n").alias("m"), F.col("marks").alias("y")), "b")
             .join(nodes.select(F.col("rep").alias("a"), "n", F.col("marks").alias("x")), "a").where(_alike_in_size(above, of)))
    return sides.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each id, of fixed size: a text whose bit is unset isn't wanted."""
    size = 1 << FILTER_BITS

    def mark(batches):
        held = np.zeros(size, bool)
        for batch in batches:
            held[(mix(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        yield from payload_batches((i, np.packbits(x).tobytes()) for i, x in enumerate(np.split(held, 64)) if x.any())

    def join(batches):
        now, total = None, None
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(p.as_buffer(), np.uint8)
                if b != now:
                    if now is not None:
                        yield next(payload_batches([(now, total.tobytes())]))
                    now, total = b, x.copy()
                else:
                    total |= x
        if now is not None:
            yield next(payload_batches([(now, total.tobytes())]))

    out = np.zeros((64, size // 512), np.uint8)
    for r in by_bucket(ids.mapInArrow(mark, "bucket int, payload binary"), join, "bucket int, payload binary").collect():
        out[r["bucket"]] = np.frombuffer(bytes(r["payload"]), np.uint8)
    return out.ravel()


def _verified(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, n: int, above: int, of: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    pairs = saved(_not_refuted(pairs, nodes, above, of), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    bits = rows.sparkSession.sparkContext.broadcast(_id_filter(wanted))

    def build(batches):
        for batch in batches:
            at = (mix(batch.column("doc_id").to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            batch = batch.filter(pa.array(bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 > 0))
            sets = [s.tobytes() for _, _, w in batches_of(batch, "text", lower=True) for s in _sets(w, n)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["id", "members"])

    sets = rows.where("doc_id is not null").mapInArrow(build, "id long, members binary")
    sets = saved(sets.join(wanted, "id", "left_semi"), "sets")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and of * both >= above * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
              .join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a"))
    return joined.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def _alike_in_size(above: int, of: int):
    return F.lit(of) * F.least("n", "m") >= F.lit(above) * F.greatest("n", "m")


class PrefixTree:
    """Ordered member lists in a trie whose paths are split only where sets part.

    A set is (rep, size, component, place, tail): ``tail`` is what its prefix
    holds after the member that all sets of the tree share, at ``place``.  A
    node knows the sizes, rests and components below it; a set that shares its
    path with no other hangs as a leaf with the rest of its members.
    """

    def __init__(self) -> None:
        # children by member, sets that end here, smallest and largest size below, largest rest below, components below
        self.root = [{}, [], 1 << 60, 0, 0, set()]

    @staticmethod
    def _note(node: list, entry: tuple, depth: int) -> None:
        size = entry[1]
        node[2] = min(node[2], size)
        node[3] = max(node[3], size)
        node[4] = max(node[4], size - entry[3] - 1 - depth)
        if len(node[5]) < 2:
            node[5].add(entry[2])

    def add(self, entry: tuple) -> None:
        node, tail, depth = self.root, entry[4], 0
        self._note(node, entry, 0)
        while depth < len(tail):
            children, t = node[0], tail[depth]
            child = children.get(t)
            depth += 1
            if child is None:
                children[t] = (entry, depth, frozenset(tail[depth:]))
                return
            if isinstance(child, tuple):  # a second set on this path
                held = child[0]
                child = children[t] = [{}, [], 1 << 60, 0, 0, set()]
                self._note(child, held, depth)
                if depth < len(held[4]):
                    child[0][held[4][depth]] = (held, depth + 1, frozenset(held[4][depth + 1:]))
                else:
                    child[1].append(held)
            node = child
            self._note(node, entry, depth)
        node[1].append(entry)

    def probe(self, entry: tuple, above: int, of: int) -> Iterator[tuple]:
        """The sets of other components that could reach the threshold with ``entry``."""
        _, size, component, place, tail = entry
        whole, stop, members, both = size - place - 1, len(tail), frozenset(tail), above + of
        least, most = -(-above * size // of), of * size // above
        stack = [(self.root, 1, 0)]  # node, members shared so far, tail members passed
        while stack:
            node, shared, at = stack.pop()
            if len(node[5]) == 1 and component in node[5]:
                continue
            if node[3] < least or node[2] > most:
                continue
            if (shared + min(whole - at, node[4])) * both < above * (size + max(node[2], least)):
                continue
            for other in node[1]:
                if other[2] != component and self._reaches(entry, other, shared, above, of):
                    yield other
            for t, child in node[0].items():
                if isinstance(child, tuple):
                    other = child[0]
                    n = other[1]
                    if n < least or n > most or other[2] == component:
                        continue
                    needed = above * (size + n)
                    if (shared + min(whole - at, n - other[3] - child[1])) * both < needed:
                        continue
                    met = shared + (t in members) + len(members & child[2])
                    unseen = max(whole - stop, n - other[3] - 1 - len(other[4]))  # beyond the shorter reach of the two prefixes
                    if (met + unseen) * both >= needed and self._reaches(entry, other, met, above, of):
                        yield other
                else:
                    i = bisect_left(tail, t, at)
                    hit = i < stop and tail[i] == t
                    stack.append((child, shared + hit, i + hit))

    @staticmethod
    def _reaches(x: tuple, y: tuple, shared: int, above: int, of: int) -> bool:
        """Whether the members seen, and at best all the unseen ones, are enough."""
        n, m = x[1], y[1]
        if of * min(n, m) < above * max(n, m):
            return False
        need = -(-above * (n + m) // (above + of))
        end_x, end_y = (x[4][-1] if x[4] else -1), (y[4][-1] if y[4] else -1)
        last = min(end_x, end_y)
        rest_x = n - x[3] - 1 - bisect_right(x[4], last)
        rest_y = m - y[3] - 1 - bisect_right(y[4], last)
        return shared + min(rest_x, rest_y) >= need


def tree_pairs(group: list[tuple], blocks: list[int], above: int, of: int) -> Iterator[tuple[int, int]]:
    """Pairs (smaller id, larger id) of a group that may reach the threshold; sets of one block pair only across blocks if there are two."""
    two = len(set(blocks)) > 1
    tree = PrefixTree()
    low = min(blocks)
    if two:
        for e, b in zip(group, blocks):
            if b == low:
                tree.add(e)
    for e, b in zip(group, blocks):
        if two and b == low:
            continue
        for o in tree.probe(e, above, of):
            if o[0] != e[0]:
                yield (min(o[0], e[0]), max(o[0], e[0]))
        if not two:
            tree.add(e)


def _with_partner(entries: DataFrame, above: int, of: int, few: int = FEW) -> DataFrame:
    """Without the entries of small groups that no other entry of the group could link with, by sizes and places alone."""

    def could(e, f):
        n, m = e["n"], f["n"]
        rest = F.least(n - e["pos"], m - f["pos"])
        return (e["component"] != f["component"]) & (F.least(n, m) * of >= F.greatest(n, m) * above) & (rest * (above + of) >= (n + m) * above)

    fields = ["rep", "n", "pos", "component"]
    small = entries.where(F.col("held") <= few).groupBy("token", "held").agg(F.collect_list(F.struct(*fields)).alias("g"))
    kept = small.select("token", "held", F.filter("g", lambda e: F.exists("g", lambda f: could(e, f))).alias("g")).where("size(g) > 1")
    kept = kept.select("token", "held", F.inline("g"))
    return entries.where(F.col("held") > few).select("token", "held", *fields).union(kept)


def tree_candidates(entries: DataFrame, nodes: DataFrame, above: int, of: int, block: int = BLOCK) -> DataFrame:
    """Pairs of nodes of different components that share a member and pass the trees' bounds; entries: token, rep, n, pos, component."""
    sizes = entries.groupBy("token").agg(F.count("*").alias("held"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = entries.join(sizes.select("token", "held"), "token")
    mixed = _with_partner(mixed, above, of)
    parts = F.ceil(F.col("held") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("rep"), parts).cast("int")
    mixed = mixed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    unit = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other"))
    tails = nodes.select("rep", "n", "high")
    dealt = (mixed.withColumn("unit", unit).select("unit", "token", "rep", "n", "pos", "component", "own", "other")
             .join(tails, ["rep", "n"]).select("unit", "token", "rep", "n", "pos", "component", "own", "other",
                                               F.expr(f"substring(high, {HALF} * (pos + 1) + 1)").alias("tail")))

    def meet(batches):
        for table in whole_groups(batches, "unit"):
            unit = table.column("unit").to_numpy()
            cols = [table.column(c).to_pylist() for c in ("token", "rep", "n", "component", "pos", "own", "other")]
            data, first = text_buffer(table.column("tail"))
            first //= HALF
            codes = tail_codes(data, first)
            cut = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]).tolist()
            found = set()
            for lo, hi in zip(cut, [*cut[1:], len(unit)]):
                if hi - lo < 2:
                    continue
                by_token: dict[tuple, list[int]] = {}
                for i in range(lo, hi):
                    by_token.setdefault((cols[0][i], min(cols[5][i], cols[6][i]), max(cols[5][i], cols[6][i])), []).append(i)
                for key, at in by_token.items():
                    if len({cols[3][i] for i in at}) < 2:
                        continue
                    group = [(cols[1][i], cols[2][i], cols[3][i], cols[4][i], codes[first[i]:first[i + 1]].tolist()) for i in at]
                    blocks = [cols[5][i] for i in at]
                    if key[1] != key[2] and len(set(blocks)) < 2:
                        continue
                    found.update(tree_pairs(group, blocks, above, of))
            a, b = zip(*sorted(found)) if found else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    spread = dealt.repartition(partitions(entries.sparkSession), "unit").sortWithinPartitions("unit")
    return spread.mapInArrow(meet, "a long, b long").distinct()


def linked_documents(docs: DataFrame, n: int = SHINGLE, above: int = ABOVE, of: int = OF, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row (see the module's text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = saved(set_prefixes(rows, n, above, of), "prefixes")
    fp = ["fp_a", "fp_b", "n_shingles"]
    whole = known.where("doc_id is not null and n_shingles > 0")
    nodes = saved(whole.groupBy(*fp).agg(F.min(F.struct("doc_id", *PARTS)).alias("x"))
                  .select(*fp, F.col("x.doc_id").alias("rep"), F.col("n_shingles").cast("int").alias("n"), *[f"x.{c}" for c in PARTS]), "nodes")
    members = saved(shared_members(nodes), "members")

    # each node against the smallest node of each of its shared members
    hubs = members.groupBy("token").agg(F.min(F.struct("rep", "n")).alias("hub")).select("token", F.col("hub.rep").alias("a"), F.col("hub.n").alias("m"))
    stars = members.join(hubs, "token").where("rep <> a").where(_alike_in_size(above, of)).select("a", F.col("rep").alias("b")).distinct()
    links = _verified(stars, rows, nodes, n, above, of)

    classes = whole.select("doc_id", *fp).distinct().join(nodes.select(*fp, "rep"), fp).select("doc_id", "rep")
    # a document with several rows may stand in several classes
    several = classes.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    ids = whole.groupBy("doc_id").agg(F.min(F.struct(*fp)).alias("x"), F.max(F.struct(*fp)).alias("y")).where("x <> y").select("doc_id")
    several = several.join(ids.withColumnRenamed("doc_id", "a"), "a", "left_semi")
    links = saved(links.union(several), "links")
    first = saved(components(links), "components")

    placed = members.join(first, members.rep == first.v, "left").select("token", "rep", "n", "pos", F.coalesce("component", "rep").alias("component"))
    more = _verified(tree_candidates(saved(placed, "placed"), nodes, above, of), rows, nodes, n, above, of)
    merged = more.join(first.select(F.col("v").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        first.select(F.col("v").alias("b"), F.col("component").alias("cb")), "b", "left")
    merged = saved(merged.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), "merged")
    final = components(merged.union(first.select(F.col("v").alias("a"), F.col("component").alias("b"))))

    reps = nodes.select(*fp, "rep").join(final, F.col("rep") == F.col("v"), "left").select(*fp, F.coalesce("component", "rep").alias("component_id"))
    inside = whole.select("doc_id", *fp).join(reps, fp).select("doc_id", "n_shingles", "component_id")
    outside = known.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return inside.union(outside)
