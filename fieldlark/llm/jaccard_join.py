"""Exact Jaccard self-join over word shingles with set-relation skipping.

The plan, for a threshold t on whole texts:

1. Equal sets become one class (a 128-bit digest of the sorted set); the class's smallest id represents it.
2. Representatives that share a min-hash gather under a leader, one comparison each. The overlap with the leader is the
   *computed answer* from which the answers of the leader's near copies are derived: 1 - Jaccard is a metric, so
   |d(x, L) - d(m, L)| and d(x, L) + d(m, L) bound d(x, m) without looking at x and m.
3. An inverted index over prefixes (the rarest shingles first, by a fixed-size count sketch over all texts) yields every
   pair that can reach t. A near copy stands in a list only once, as its leader's entry. Lists are cut into blocks in size
   order and blocks, and entries by position, are skipped when no pair of theirs can reach t.
4. Leaders' pairs are compared exactly. Only where the bounds leave a pair of clusters open are their members compared, a few first, then, where
   these don't link the clusters, all in blocks, where each overlap is derived from that of a highly similar set and the shingles in
   which the two differ.

Nothing is capped: long lists take the path of joined blocks, and every skipped pair is excluded by a bound.
A text that is null, empty or without words has no shingles and links with nothing. Equal sets are linked. Ids are taken
as unique; rows of a null id are left out. Repeated rows of one id count once (its class with the most shingles). A very long text
is hashed in pieces. An empty table gives no rows. Extra columns are not read, whatever their names.

5. Links are counted within the components: their classes lie in blocks, by bands of sizes of which only neighbours can
link, and every block meets those of its band and of the next. Overlaps follow from one computed overlap for each text
and block. Only counts leave a task, no pairs. The comparisons grow with the square of a component's classes of like size.

Components and n_links are exact. n_links says with how many other classes (different sets) a class links; exact copies
share a class, and its links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as T
from ._spark import components, hot_join, small, spread, stored

#: Counters of the frequency sketch (a power of two) and the pieces in which it is summed.
COUNTERS, PIECES = 1 << 20, 64
#: Entries of a list that are compared within a task; a longer list is cut into blocks of that many.
BLOCK = 256
#: Members of open clusters in a block at most, shingles of a block, and members of each that are compared first.
MEMBERS, SHINGLES, PROBE = 64, 1 << 19, 8
#: Classes of a block when links are counted.
COUNTED = 512
#: Min-hash keys under which a representative looks for a leader.
KEYS = 4
_EPS = 1e-9
_KEY_SEEDS = (np.arange(1, KEYS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def _profile(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, digest) of every text, and this task's share of the frequency sketch."""
    counts, task, mask = np.zeros(COUNTERS, np.int64), None, np.uint64(COUNTERS - 1)
    for batch in batches:
        ids, n, digest, held, waiting = batch.column(0), [], [], [], 0
        task = ids[0].as_py() if task is None and len(ids) else task
        for s in T.shingle_sets(batch.column(1), k=k):
            n.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            held.append(s)
            waiting += len(s)
            if waiting > COUNTERS:
                counts += np.bincount((np.concatenate(held) & mask).astype(np.int64), minlength=COUNTERS)
                held, waiting = [], 0
        if waiting:
            counts += np.bincount((np.concatenate(held) & mask).astype(np.int64), minlength=COUNTERS)
        null = pa.nulls(len(n), pa.int32())
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int32()), pa.array(digest, pa.binary()), null, null], names=["doc_id", "n", "digest", "piece", "part"])
    if counts.any():
        share = [x.tobytes() for x in np.split(counts.astype(np.uint32), PIECES)]
        none = pa.nulls(PIECES, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none.cast(pa.int32()), pa.array(share, pa.binary()), pa.array(range(PIECES), pa.int32()), pa.array([(task or 0) % 61] * PIECES, pa.int32())], names=["doc_id", "n", "digest", "piece", "part"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One array of counts for each piece of a task's partial sketches; the dict holds the whole sketch at most."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, share in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(share, np.uint32)
            total[piece] = total[piece] + x if piece in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["piece", "share"])


def _sketch(profile: DataFrame) -> np.ndarray:
    """Counts of all shingles in COUNTERS buckets: the shares are summed in two steps, the driver gets 4 MB."""
    shares = profile.where("piece is not null").select("piece", F.col("digest").alias("share"), "part")
    schema = "piece int, share binary"
    once = shares.repartition("piece", "part").select("piece", "share").mapInArrow(_summed, schema)
    twice = once.repartition("piece").mapInArrow(_summed, schema)
    counts = np.zeros((PIECES, COUNTERS // PIECES), np.uint32)
    for piece, share in twice.collect():  # PIECES rows of COUNTERS / PIECES counters
        counts[piece] += np.frombuffer(share, np.uint32)
    return counts.ravel()


def _prefixes(batches: Iterator[pa.RecordBatch], k: int, t: float, sketch) -> Iterator[pa.RecordBatch]:
    """Digest, id, size, the prefix in order of frequency, and the min-hash keys of every text with shingles."""
    counts, mask = sketch.value, np.uint64(COUNTERS - 1)
    for batch in batches:
        out: list[tuple] = []
        for i, s in zip(batch.column(0).to_pylist(), T.shingle_sets(batch.column(1), k=k), strict=True):
            if len(s) and i is not None:
                order = np.argsort(counts[(s & mask).astype(np.int64)], kind="stable")  # ties: by hash
                p = len(s) - math.ceil(t * len(s) - _EPS) + 1
                keys = [T.mix(s ^ seed).min().astype(np.int64).item() for seed in _KEY_SEEDS]
                out.append((hashlib.blake2b(s.tobytes(), digest_size=16).digest(), i, len(s), s[order[:p]].tobytes(), keys))
        d, i, n, p, m = zip(*out, strict=True) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array(i, pa.int64()), pa.array(n, pa.int32()), pa.array(p, pa.binary()), pa.array(m, pa.list_(pa.int64()))], names=["digest", "id", "n", "prefix", "keys"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index entries (token, leader, least and largest size, least position); near copies of a batch share one entry."""
    for batch in batches:
        leader, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        token = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        size = np.array([len(x) for x in token])
        if not len(size):
            continue
        tok, who, many = np.concatenate(token), np.repeat(leader, size), np.repeat(n, size)
        pos = np.concatenate([np.arange(x, dtype=np.int32) for x in size])
        order = np.lexsort((who, tok))
        tok, who, many, pos = tok[order], who[order], many[order], pos[order]
        head = np.flatnonzero(np.concatenate(([True], (tok[1:] != tok[:-1]) | (who[1:] != who[:-1]))))
        for lo in range(0, len(head), 200_000):
            h = head[lo : lo + 200_000]
            end = head[lo + len(h)] if lo + len(h) < len(head) else len(tok)
            cut = slice(h[0], end)
            at = h - h[0]
            values = [tok[h], who[h], np.minimum.reduceat(many[cut], at), np.maximum.reduceat(many[cut], at), np.minimum.reduceat(pos[cut], at)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in values], names=["token", "leader", "lo", "hi", "pos"])


def _may_reach(lo1, hi1, pos1, lo2, hi2, pos2, t: float):
    """Length and position filter, optimistic over the sizes lo..hi of an entry's members."""
    rest = np.minimum(hi1 - pos1, hi2 - pos2) + _EPS
    return (lo1 * t <= hi2 + _EPS) & (lo2 * t <= hi1 + _EPS) & (rest >= t / (1 + t) * (lo1 + lo2.astype(np.float64)))


def _lists(batches: Iterator[pa.RecordBatch], t: float) -> Iterator[pa.RecordBatch]:
    """Pairs of leaders from lists of up to BLOCK entries; longer lists leave as entries with a block number.

    Rows come sorted by token and least size. Only the last token's rows are carried over from batch to batch.
    """
    names = ["a", "b", "block", "token", "lo", "hi", "pos"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def pairs(c):
        tok, a, b = c[0], [], []
        live = np.arange(len(tok))
        for d in range(1, BLOCK + 1):
            live = live[live + d < len(tok)]
            live = live[tok[live] == tok[live + d]]
            if not len(live):
                break
            i, j = live, live + d
            ok = (c[1][i] != c[1][j]) & _may_reach(c[2][i], c[3][i], c[4][i], c[2][j], c[3][j], c[4][j], t)
            a.append(np.minimum(c[1][i[ok]], c[1][j[ok]]))
            b.append(np.maximum(c[1][i[ok]], c[1][j[ok]]))
        if a and sum(map(len, a)):
            p = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(p[0]), pa.array(p[1]), *(pa.nulls(p.shape[1], x) for x in kinds[2:])], names=names)

    def blocks(c, first):
        block = (first + np.arange(len(c[0]))) // BLOCK
        yield pa.RecordBatch.from_arrays([pa.array(c[1]), pa.nulls(len(c[0]), pa.int64()), pa.array(block.astype(np.int32)), pa.array(c[0]), *(pa.array(x) for x in c[2:5])], names=names)

    carry, gone, long_token = None, 0, None
    for batch in batches:
        c = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        if not len(c[0]):
            continue
        if carry is not None:
            c = [np.concatenate(x) for x in zip(carry, c, strict=True)]
        heads = np.flatnonzero(np.concatenate(([True], c[0][1:] != c[0][:-1])))
        ends = np.append(heads[1:], len(c[0]))
        if long_token is not None:  # the first run goes on with it, or it is over
            if c[0][0] == long_token:
                yield from blocks([x[: ends[0]] for x in c], gone)
                gone += int(ends[0])
                c, heads, ends = [x[ends[0] :] for x in c], heads[1:] - ends[0], ends[1:] - ends[0]
            if len(heads):
                long_token = None
        if not len(heads):
            carry = None
            continue
        if ends[-1] - heads[-1] > BLOCK:  # surely long: need not wait for its end
            long_token, gone = c[0][-1], int(ends[-1] - heads[-1])
            carry = None
        else:
            carry = [x[heads[-1] :] for x in c]
        size = ends - heads
        if carry is not None:
            heads, ends, size = heads[:-1], ends[:-1], size[:-1]
        for h, e in zip(heads[size > BLOCK], ends[size > BLOCK], strict=True):
            yield from blocks([x[h:e] for x in c], 0)
        keep = np.repeat((size > 1) & (size <= BLOCK), size)
        keep = np.concatenate((keep, np.zeros(len(c[0]) - len(keep), bool)))
        yield from pairs([x[keep] for x in c])
    if carry is not None:
        yield from pairs(carry)


def _candidates(entries: DataFrame, t: float) -> DataFrame:
    """Distinct pairs (a, b) of leaders with a common token that pass the filters."""
    by_token = entries.repartition("token").sortWithinPartitions("token", "lo")
    found = stored(by_token.mapInArrow(lambda b: _lists(b, t), "a long, b long, block int, token long, lo int, hi int, pos int"))
    pairs = found.where("block is null").select("a", "b")
    blocked = found.where("block is not null").select("token", "block", F.col("a").alias("leader"), "lo", "hi", "pos")
    if blocked.limit(1).count():
        # block skipping: a pair of blocks is opened only if its sizes fit, and what is left of the largest sets after the least positions
        ranges = blocked.groupBy("token", "block").agg(F.min("lo").alias("bl"), F.max("hi").alias("bh"), F.max(F.col("hi") - F.col("pos")).alias("rest"))
        other = ranges.select("token", *(F.col(c).alias(f"{c}2") for c in ("block", "bl", "bh", "rest")))
        fit = ranges.join(other, "token").where(
            f"block <= block2 and bl * {t} <= bh2 and bl2 * {t} <= bh and least(rest, rest2) + 1e-9 >= {t / (1 + t)} * (bl + bl2)"
        ).select("token", "block", "block2")
        right = blocked.select("token", *(F.col(c).alias(f"{c}2") for c in ("block", "leader", "lo", "hi", "pos")))
        opened = spread(blocked.join(fit, ["token", "block"]))
        joined = opened.join(spread(right), ["token", "block2"]).where(
            f"leader <> leader2 and (block < block2 or leader < leader2) and lo * {t} <= hi2 and lo2 * {t} <= hi"
            f" and least(hi - pos, hi2 - pos2) + 1e-9 >= {t / (1 + t)} * (lo + lo2)"
        )
        pairs = pairs.unionAll(joined.select(F.least("leader", "leader2").alias("a"), F.greatest("leader", "leader2").alias("b")))
    return pairs.distinct()


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = pa.array([s.tobytes() for s in T.shingle_sets(batch.column(1), k=k)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], sets], names=["id", *batch.schema.names[2:], "set"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact overlaps of the pairs' sets."""
    for batch in batches:
        inter, na, nb = [], [], []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
            inter.append(int((y[at] == x).sum()) if len(y) else 0)
            na.append(len(x))
            nb.append(len(y))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (inter, na, nb))], names=["a", "b", "inter", "na", "nb"])


def _compared(docs: DataFrame, pairs: DataFrame, k: int, t: float) -> DataFrame:
    """(a, b, linked, d): the pairs with their exact Jaccard distance. Each b's set is sent once for each a of its."""
    num, den = _ratio(t)

    def with_sets(ids: DataFrame, extra: str) -> DataFrame:
        return docs.join(small(ids), "id").select("id", "text", *([extra] if extra else [])).mapInArrow(lambda x: _sets(x, k), f"id long, {extra + ' array<long>, ' if extra else ''}set binary")

    pairs = stored(pairs)
    left = with_sets(pairs.select(F.col("a").alias("id")).distinct(), "").select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    wanted = stored(pairs.select(F.col("b").alias("id"), "a"))
    right = docs.join(small(wanted.select("id").distinct()), "id", "left_semi").select("id", "text").mapInArrow(lambda x: _sets(x, k), "id long, set binary")
    right = right.join(small(wanted), "id").select("a", F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = right.join(left, "a").select("a", "b", "set_a", "set_b")
    found = both.mapInArrow(_compare, "a long, b long, inter long, na long, nb long")
    union = F.col("na") + F.col("nb") - F.col("inter")
    return stored(found.select("a", "b", (F.col("inter") * den >= union * num).alias("linked"), (1 - F.col("inter") / union).alias("d")))


def _overlaps(hosts: list[np.ndarray], guests: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each guest its overlaps with all hosts.

    The first host's overlap with a guest is computed; the others' follow from it by the shingles in which they differ
    from the first, so that a guest costs one look-up of its shingles for all hosts together.
    """
    base = hosts[0]
    lost, new = [np.setdiff1d(base, s, True) for s in hosts], [np.setdiff1d(s, base, True) for s in hosts]
    key = np.concatenate([*lost, *new])
    host = np.repeat(np.tile(np.arange(len(hosts)), 2), [len(x) for x in (*lost, *new)])
    sign = np.repeat([-1.0, 1.0], [sum(map(len, lost)), sum(map(len, new))])
    order = np.argsort(key, kind="stable")
    key, host, sign = key[order], host[order], sign[order]
    for x in guests:
        lo, hi = np.searchsorted(key, x, "left"), np.searchsorted(key, x, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield len(np.intersect1d(base, x, True)) + np.bincount(host[at], sign[at], len(hosts)).astype(np.int64)


def _tally(num: int, den: int):
    def once(table: pa.Table) -> dict[int, np.ndarray]:
        """The sets by id; of rows that share an id the largest."""
        out: dict[int, np.ndarray] = {}
        for i, x in zip(table["id"].to_pylist(), table["set"].to_pylist(), strict=True):
            if i not in out or len(x) > 8 * len(out[i]):
                out[i] = np.frombuffer(x, np.uint64)
        return out

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """How many classes of the other block each class links with; a block that meets itself counts for its guests alone."""
        hosts, guests = once(left), once(right)
        own = np.fromiter(hosts, np.int64, len(hosts))
        size, by_host, by_guest = np.array([len(x) for x in hosts.values()]), np.zeros(len(hosts), np.int64), []
        if len(hosts):
            for i, x, shared in zip(guests, guests.values(), _overlaps([*hosts.values()], [*guests.values()]), strict=True):
                linked = (shared * den >= (size + len(x) - shared) * num) & (own != i)
                by_guest.append(int(linked.sum()))
                by_host += linked
        _, _, up, x, y = (v.as_py() for v in key)
        ids, n = ([*hosts, *guests], [*by_host.tolist(), *by_guest]) if len(hosts) and (up or x != y) else ([*guests], by_guest)
        return pa.table([pa.array(ids[: len(n)], pa.int64()), pa.array(n, pa.int64())], names=["id", "n"])

    return run


def _derive(num: int, den: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """A link, if there is one, of each guest with a host of the block."""
        out: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            ids = left["id"].to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in left["set"].to_pylist()]
            size, others = np.array([len(s) for s in sets]), [np.frombuffer(x, np.uint64) for x in right["set"].to_pylist()]
            for i, x, shared in zip(right["id"].to_pylist(), others, _overlaps(sets, others), strict=True):
                linked = np.flatnonzero((shared * den >= (size + len(x) - shared) * num) & (np.array(ids) != i))
                if len(linked):
                    out.append((ids[linked[0]], i))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _opened(docs: DataFrame, member: DataFrame, unsure: DataFrame, k: int, t: float, probe: int | None = None) -> DataFrame:
    """Links (a, b) between members of clusters that the bounds leave open.

    Of each pair the larger cluster is the host. Its members stay in blocks; members of the other cluster that are far
    enough from their leader to reach the host are its guests, in blocks too, and every block of hosts meets every
    block of guests. With `probe` only that many members of either side meet, those farthest from their leaders.
    """
    near = 1 - t + 1e-9
    if "n" not in member.columns:
        member = member.withColumn("n", F.lit(1))  # sizes unknown: blocks go by members alone
    size = stored(member.groupBy("leader").agg(F.count("*").alias("size")))
    sizes = [size.select(F.col("leader").alias(x), F.col("size").alias(f"n{x}")) for x in "ab"]
    pairs = unsure.join(small(sizes[0]), "a").join(small(sizes[1]), "b")
    first = F.col("na") >= F.col("nb")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    pairs = stored(pairs.select(pick("a", "b").alias("host"), pick("b", "a").alias("guest"), "d", pick("r1", "r2").alias("rh"), pick("r2", "r1").alias("rg")))
    of_host = pairs.groupBy("host").agg((F.min(F.col("d") - F.col("rg")) - near).alias("need"))
    hosts = member.join(small(stored(of_host)), F.col("leader") == F.col("host")).where("d >= need").select("host", "id", "n", "d")
    own = member.select(F.col("leader").alias("guest"), "id", "n", F.col("d").alias("dm"))
    guests = spread(own).join(small(pairs), "guest").where(F.col("dm") >= F.col("d") - F.col("rh") - near).groupBy("host", "id").agg(F.first("n").alias("n"), F.max("dm").alias("d"))
    if probe:
        rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("d"), "id"))  # Spark limits the groups before it shuffles them
        hosts, guests = (df.withColumn("rank", rank).where(F.col("rank") <= probe) for df in (hosts, guests))
    hosts, guests = stored(hosts.select("host", "id", "n")), stored(guests.select("host", "id", "n"))
    parts = F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n") / SHINGLES)).cast("int")
    plan = small(stored(hosts.groupBy("host").agg(parts.alias("hb")).join(guests.groupBy("host").agg(parts.alias("gb")), "host")))
    ids = small(stored(hosts.select("id").union(guests.select("id")).distinct()))
    sets = stored(docs.join(ids, "id", "left_semi").select("id", "text").mapInArrow(lambda x: _sets(x, k), "id long, set binary"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sets.join(small(stored(hosts.join(plan, "host").select("host", "id", F.pmod(F.xxhash64("id"), "hb").cast("int").alias("x"), each("gb").alias("y")))), "id")
    right = sets.toDF("id", "set").join(small(stored(guests.join(plan, "host").select("host", "id", each("hb").alias("x"), F.pmod(F.xxhash64("id"), "gb").cast("int").alias("y")))), "id")
    left, right = left.select("host", "x", "y", "id", "set"), right.toDF("id", "set", "host", "x", "y").select("host", "x", "y", "id", "set")
    return left.groupBy("host", "x", "y").cogroup(right.groupBy("host", "x", "y")).applyInArrow(_derive(*_ratio(t)), "a long, b long").distinct()


def _apart(pairs: DataFrame, root: DataFrame) -> DataFrame:
    """The pairs (a, b) that no path of links connects yet."""
    ra, rb = (small(root).select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    return stored(pairs.join(ra, "a", "left").join(rb, "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select(*pairs.columns))


def _counted(docs: DataFrame, reps: DataFrame, root: DataFrame, k: int, t: float) -> DataFrame:
    """(class_id, n_links): with how many other classes each class of the components (node, root) links; stored.

    A component of two classes has one link. In larger ones blocks of classes meet: a band of sizes is as wide as the
    threshold allows two sets to differ, so that each block meets those of its own band and of the next alone.
    """
    ids = stored(root.select(F.col("node").alias("id"), "root").unionAll(root.select(F.col("root").alias("id"), "root").distinct()))
    member = stored(reps.select("id", "n").join(small(ids), "id").groupBy("id").agg(F.max("n").alias("n"), F.first("root").alias("root")))
    member = stored(hot_join(member, member.groupBy("root").agg(F.count("*").alias("classes")), "root"))
    width = max(-math.log(t), 0.01) * (1 + 1e-6)  # a little wider, so that rounded logarithms part no two sets that fit
    many = member.where("classes > 2").select("id", "n", "root", F.floor(F.log("n") / width).cast("int").alias("band"))
    plan = stored(many.groupBy("root", "band").agg(F.greatest(F.ceil(F.count("*") / COUNTED), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("blocks")))
    above, below = (plan.select("root", (F.col("band") - step).alias("band"), F.col("blocks").alias(name)) for step, name in ((1, "above"), (-1, "below")))
    plan = stored(plan.join(above, ["root", "band"], "left").join(below, ["root", "band"], "left").fillna(0, ["above", "below"]))
    placed = small(stored(many.join(small(plan), ["root", "band"]).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))))
    sets = stored(docs.join(placed.select("id"), "id", "left_semi").select("id", "text").mapInArrow(lambda x: _sets(x, k), "id long, set binary"))
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.col(n)), lambda i: i < F.col(n))
    at = lambda band, up, x, y: F.struct((F.col("band") + band).alias("low"), F.lit(up).alias("up"), x.alias("x"), y.alias("y"))
    own = F.col("own")
    left = F.concat(F.transform(F.sequence("own", F.col("blocks") - 1), lambda i: at(0, 0, own, i)), F.transform(upto("above"), lambda i: at(0, 1, own, i)))
    right = F.concat(F.transform(F.sequence(F.lit(0), "own"), lambda i: at(0, 0, i, own)), F.transform(upto("below"), lambda i: at(-1, 1, i, own)))
    where = ["root", "low", "up", "x", "y"]
    named = sets.join(placed, "id")
    sides = [named.select("id", "set", "root", F.inline(spots)).select(*where, "id", "set").toDF(*where, "id", "set") for spots in (left, right)]
    found = sides[0].groupBy(*where).cogroup(sides[1].groupBy(*where)).applyInArrow(_tally(*_ratio(t)), "id long, n long")
    found = found.unionAll(member.where("classes = 2").select("id", F.lit(1).cast("long").alias("n")))
    return stored(found.groupBy(F.col("id").alias("class_id")).agg(F.sum("n").alias("n_links")))


def _ratio(t: float) -> tuple[int, int]:
    num, den = round(t * 100), 100
    if abs(num / den - t) > 1e-12:
        raise ValueError("the threshold is taken in hundredths")
    return num, den


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8, links: bool = True) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest id reachable by links), class_id (smallest id of an
    equal set) and n_links (with how many other classes its class links; copies are not expanded). Without `links` that column is left out.

    No text, empty text or no word: n_shingles 0 and the document's own id as component. Empty input: no rows.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    spark = docs.sparkSession
    t = threshold
    profile = stored(docs.mapInArrow(lambda b: _profile(b, k), "doc_id long, n int, digest binary, piece int, part int"))
    sketch = spark.sparkContext.broadcast(_sketch(profile))
    rows = profile.where("piece is null").groupBy("doc_id").agg(F.max(F.struct("n", "digest")).alias("x")).select("doc_id", "x.n", "x.digest")
    prefixes = docs.mapInArrow(lambda b: _prefixes(b, k, t, sketch), "digest binary, id long, n int, prefix binary, keys array<long>")
    reps = stored(prefixes.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("keys").alias("keys")))

    # leaders: of the representatives that share a min-hash the smallest; one comparison for each representative
    keyed = reps.select("id", F.posexplode("keys").alias("slot", "key"))
    least = keyed.groupBy("slot", "key").agg(F.min("id").alias("leader"), F.count("*").alias("c")).where("c > 1").select("slot", "key", "leader")
    star = hot_join(keyed, least, ["slot", "key"]).where("leader < id").groupBy("id").agg(F.min("leader").alias("leader"))
    near = _compared(docs, star.select(F.col("leader").alias("a"), F.col("id").alias("b")), k, t)
    # a representative that itself joined a leader still leads its own near copies: its entries are in the lists
    linked = near.where("linked").select(F.col("b").alias("id"), F.col("a").alias("leader"), "d")
    linked = stored(linked)
    member = reps.join(small(linked), "id", "left").select(F.coalesce("leader", "id").alias("leader"), "n", "prefix", "id", F.coalesce("d", F.lit(0.0)).alias("d"))

    root0 = components(linked.select(F.col("id").alias("a"), F.col("leader").alias("b")))
    # a leader stands for those that joined it, itself included; lists hold leaders only
    entries = member.select("leader", "n", "prefix").mapInArrow(_entries, "token long, leader long, lo int, hi int, pos int")
    # a leader that joined another has its own prefix under that other's name; it must also stand for its members' bound
    pairs = _candidates(entries, t)
    root0 = stored(root0)
    ra, rb = (root0.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    pairs = pairs.join(small(ra), "a", "left").join(small(rb), "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")
    far = _compared(docs, pairs, k, t)

    edges = linked.select(F.col("leader").alias("a"), F.col("id").alias("b")).unionAll(far.where("linked").select("a", "b"))
    radius = linked.groupBy("leader").agg(F.max("d").alias("r"))
    r1, r2 = radius.select(F.col("leader").alias("a"), F.col("r").alias("r1")), radius.select(F.col("leader").alias("b"), F.col("r").alias("r2"))
    bound = far.where("not linked").join(r1, "a", "left").join(r2, "b", "left").fillna(0.0, ["r1", "r2"]).where(f"r1 + r2 > 0 and d - r1 - r2 <= {1 - t + 1e-9}")
    unsure = stored(bound.select("a", "b", "d", "r1", "r2"))
    edges = stored(edges)
    root = stored(components(edges))
    # a few members of either side first: only components are asked for, so a pair of clusters with one link is done
    for probe in (PROBE, None):
        unsure = _apart(unsure, root)
        if not unsure.limit(1).count():
            break
        edges = stored(edges.unionAll(_opened(docs, member, unsure, k, t, probe)))
        root = stored(components(edges))

    label = reps.select(F.col("id").alias("class_id"), "digest").join(small(root.withColumnRenamed("node", "class_id")), "class_id", "left")
    n_links = []
    if links:
        label = label.join(small(_counted(docs, reps, root, k, t)), "class_id", "left")
        n_links = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    label = label.select("digest", "class_id", F.coalesce("root", "class_id").alias("component_id"), *n_links)
    out = hot_join(rows, label, "digest", "left")
    own = F.col("n") == 0
    return out.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        *([F.when(own, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links")] if links else []),
    )


def op3_jaccard_components(spark, sf_dir: str) -> DataFrame:
    from ._spark import table

    return jaccard_components(table(spark, sf_dir, "documents"))
