"""Near-duplicate classes by min-max hashing.

1. Every distinct shingle set is a node, named by its smallest document id.
2. Under each permutation both the minimum and the maximum of a set's hashes are kept,
   so that half as many hash evaluations give as many signature values; runs of values
   are band keys.
3. In each bucket every member is paired with the bucket's smallest node. A member is
   compared on full sets with the one that it shares most buckets with; links found make
   first components, and the other pairs are compared where they join components.
4. Buckets that still span several components are compared in blocks of bounded size, of
   different components only, by signature first; pairs that may link are confirmed on
   full sets.
5. Components are closed by alternating large-star and small-star steps.

Nothing is capped: blocks replace one large group by many bounded ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_table, checkpointed, in_filter, written

#: Words of a shingle; percent of the union that the intersection of linked sets reaches.
WORDS, PERCENT = 3, 85
#: Permutations (two values each) and values of a band. At similarity 0.85, 32 bands of 6
#: values miss a pair with probability 3e-7.
PERMUTATIONS, BAND = 96, 6
#: Probability with which a pair at the asked similarity may be missed at most, and values of a band at most.
MISS, BAND_MOST = 1e-6, 16
#: Standard errors by which a signature may underestimate a pair that is still confirmed.
ERRORS = 4.5
#: Members of a block; two blocks are compared at a time.
BLOCK = 256
#: Words whose hashes a worker remembers.
CACHE_WORDS = 1 << 16
#: Sets of at most so many shingles are compared whole in a block.
SMALL = 1024
#: Links of a partition while components are closed: few links take few tasks and files.
LINKS = 50_000
#: Shingles hashed at a time, and rows that a task holds sets of.
CHUNK, ROWS = 1 << 14, 256

_M = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= CACHE_WORDS:
            return xxh64_intdigest(word)
        self[word] = found = xxh64_intdigest(word)
        return found


_words = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of the whole sequence, if it is shorter."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, found), dtype=np.uint64, count=len(found))
    n = min(words, len(h))
    code = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        code = _mixed(code * _M + h[i : len(h) - n + 1 + i])
    return np.unique(code)


def permutations(count: int = PERMUTATIONS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 63, size=(2, count), dtype=np.uint64)
    return (draw[0] << np.uint64(1)) | np.uint64(1), draw[1]


def signatures(sets: list[np.ndarray], factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets, 2 * permutations): minima and maxima; all sets must hold something."""
    out = np.empty((len(sets), 2 * len(factors)), dtype=np.uint64)
    out[:, ::2], out[:, 1::2] = np.iinfo(np.uint64).max, 0
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= CHUNK):
            size += len(sets[to])
            to += 1
        if to == at + 1:
            pieces = [sets[at][i : i + CHUNK] for i in range(0, len(sets[at]), CHUNK)]
        else:
            pieces = [np.concatenate(sets[at:to])]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at : to - 1]])]).astype(np.int64)
        for flat in pieces:
            for j in range(len(factors)):
                h = flat * factors[j] + offsets[j]
                low, high = out[at:to, 2 * j], out[at:to, 2 * j + 1]
                np.minimum(low, np.minimum.reduceat(h, starts), out=low)
                np.maximum(high, np.maximum.reduceat(h, starts), out=high)
        at = to
    return out


def banding(percent: int = PERCENT, miss: float = MISS) -> tuple[int, int]:
    """Permutations and values of a band: the longest band that misses a pair at ``percent`` with probability ``miss`` at most.

    More permutations are taken where even bands of one value would miss more.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    share, count = percent / 100, PERMUTATIONS
    while (1 - share) ** (2 * count) > miss:
        count += PERMUTATIONS
    return count, max(b for b in range(1, BAND_MOST + 1) if (1 - share**b) ** (2 * count // b) <= miss)


def band_keys(values: np.ndarray, band: int = BAND) -> np.ndarray:
    """(sets, bands): one 64-bit key for each run of ``band`` values."""
    bands = values.shape[1] // band
    grouped = values[:, : bands * band].reshape(len(values), bands, band)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), grouped.shape[:2]).copy()
    for i in range(band):
        key = _mixed(key * _M + grouped[:, :, i])
    return key


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sketch(docs: DataFrame, key: str, text: str, words: int = WORDS, count: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """id, n_shingles, set_hash (two longs as text), band keys and a signature of 8 bits a value of every row."""
    factors, offsets = permutations(count)

    def of(frames: Iterable) -> Iterator:
        import pandas as pd
        from xxhash import xxh3_128_hexdigest

        for whole in frames:
            for at in range(0, len(whole), ROWS):
                frame = whole.iloc[at : at + ROWS]
                sets = [shingle_set(t if isinstance(t, str) else None, words) for t in frame[key + "_text"]]
                full = [i for i, s in enumerate(sets) if len(s)]
                values = signatures([sets[i] for i in full], factors, offsets) if full else np.empty((0, 2 * len(factors)), np.uint64)
                keys, small = _signed(band_keys(values, band)), (_mixed(values) >> np.uint64(56)).astype(np.uint8)
                bands: list = [None] * len(sets)
                marks: list = [None] * len(sets)
                for j, i in enumerate(full):
                    bands[i], marks[i] = keys[j], small[j].tobytes()
                yield pd.DataFrame(
                    {
                        "id": frame[key].astype("Int64").to_numpy(dtype=object, na_value=None),
                        "n_shingles": np.array([len(s) for s in sets], dtype=np.int64),
                        "set_hash": [xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                        "bands": bands,
                        "mark": marks,
                    }
                ).astype({"id": "Int64"})

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(key + "_text"))
    return rows.mapInPandas(of, "id long, n_shingles long, set_hash string, bands array<long>, mark binary")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """id and sorted shingle hashes of the wanted ids, from their texts."""

    def of(frames: Iterable) -> Iterator:
        import pandas as pd
        from xxhash import xxh3_128_hexdigest

        for frame in frames:
            for at in range(0, len(frame), ROWS):
                part = frame.iloc[at : at + ROWS]
                sets = [shingle_set(t if isinstance(t, str) else None, words) for t in part["text"]]
                yield pd.DataFrame({"id": part["id"], "set_hash": [xxh3_128_hexdigest(s.tobytes()) for s in sets], "shingles": list(map(_signed, sets))})

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(in_filter(F.col("id"), bit_table(wanted, "id")))
    sets = rows.mapInPandas(of, "id long, set_hash string, shingles array<long>")
    return sets.join(wanted.select("id"), "id", "left_semi").dropDuplicates(["id", "set_hash"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return pairs.join(a, "a").join(b, "b").where(100 * shared >= percent * union).select("a", "b").distinct()


def components(links: DataFrame, steps: int = 50) -> DataFrame:
    """id and component (smallest id reachable) of every id in links (a, b).

    Alternates large-star and small-star steps over checkpointed edges until they are
    stars; the driver sees a count and a sum for each step.
    """
    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    state, n = None, edges.count()
    for _ in range(steps):
        parts = -(-2 * n // LINKS) or 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(parts)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")).coalesce(parts)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
        down = large.distinct().coalesce(parts)
        low = down.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
        small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").coalesce(parts)
        edges = checkpointed(small.where("u > v").distinct().coalesce(parts))
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if state == now:
            break
        state, n = now, now["n"]
    else:
        raise RuntimeError("components didn't settle")
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _may_link(n_a, n_b, percent: int):
    """Sizes alone allow the similarity."""
    return (100 * F.least(n_a, n_b)) >= (percent * F.greatest(n_a, n_b))


def compact_sets(sets: DataFrame) -> DataFrame:
    """id and ``small``: sorted 32-bit hashes of sets of at most ``SMALL`` shingles, null for larger ones.

    Ids that stand for several sets have null as well.
    """

    def of(frames: Iterable) -> Iterator:
        import pandas as pd

        for whole in frames:
            for at in range(0, len(whole), ROWS):
                frame = whole.iloc[at : at + ROWS]
                small = [np.unique((x.view(np.uint64) >> np.uint64(32)).astype("<u4")).tobytes() if len(x) <= SMALL else None for x in frame["shingles"]]
                yield pd.DataFrame({"id": frame["id"], "small": small})

    rows = sets.select("id", "shingles").mapInPandas(of, "id long, small binary")
    return rows.groupBy("id").agg(F.when(F.count(F.lit(1)) == 1, F.first("small")).alias("small"))


def shared_counts(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """(left, right): sizes of intersections of sorted 32-bit sets, by products of membership tables."""
    both = [np.frombuffer(x, "<u4") for x in (*left, *right)]
    values, place, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    number = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    row, number = row[number >= 0], number[number >= 0]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(number.max(initial=-1)) + 1, 4096):
        some = (number >= at) & (number < at + 4096)
        table = np.zeros((len(both), 4096), dtype=np.float32)
        table[row[some], number[some] - at] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def dealt_blocks(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of members (bucket, id, component, ...) for each pair (i, j) of blocks that they have to be compared in; ``own`` is i or j.

    A component of more than ``block`` members in a bucket is dealt to blocks of its own,
    smaller ones share blocks. Blocks of one component never meet, so a stray member
    beside a component of m makes m + m / block rows.
    """
    size = F.count(F.lit(1))
    comps = members.groupBy("bucket", "component").agg(size.alias("c"))
    shared = comps.where(F.col("c") <= block).groupBy("bucket").agg(F.sum("c").alias("small"))
    comps = comps.join(shared, "bucket", "left").select(
        "bucket", "component", F.when(F.col("c") > block, F.col("component")).alias("group"), F.ceil(F.when(F.col("c") > block, F.col("c")).otherwise(F.col("small")) / block).cast("int").alias("blocks")
    )
    groups = comps.groupBy("bucket", "group").agg(F.max("blocks").alias("other_blocks")).withColumnRenamed("group", "other_group")
    rows = members.join(comps, ["bucket", "component"]).join(groups, "bucket")
    rows = rows.where(F.col("group").isNull() | ~F.col("group").eqNullSafe(F.col("other_group")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
    own = F.xxhash64("group", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("own", own).withColumn("other", F.xxhash64("other_group", "other"))
    return rows.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n_shingles", "mark", "small", "component")


def block_pairs(members: DataFrame, values: int, percent: int = PERCENT, block: int = BLOCK, errors: float = ERRORS) -> DataFrame:
    """Pairs (a, b) of members (bucket, id, n_shingles, mark, small, component) across components that may link.

    Each pair of blocks that ``dealt_blocks`` gives is one bounded group, compared in
    numpy: by size, by signature, and where both sets are small by their 32-bit hashes,
    which can only overstate what they share (but for one collision within a set,
    allowed for). A signature of n values falls ``ERRORS`` standard errors short of a
    linked pair's similarity with a probability of about 3e-6 (one side of the normal
    distribution); such a pair is lost unless another bucket's first member links both.
    """
    share = percent / 100
    least = share - errors * (share * (1 - share) / values) ** 0.5
    rows = dealt_blocks(members, block)

    def compare(i, j, own, ids, sizes, comps, marks, small):
        """Places (k, m) of pairs that may link."""
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(left) or not len(right):
            return np.empty((0, 2), np.int64)
        a, b = sizes[left][:, None], sizes[right][None, :]
        may = (comps[left][:, None] != comps[right][None, :]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
        if i == j:
            may &= ids[left][:, None] < ids[right][None, :]
        row, col = np.nonzero(may)
        near = np.concatenate([(marks[left[row[x]]] == marks[right[col[x]]]).mean(axis=1) for x in (slice(y, y + 65536) for y in range(0, max(1, len(row)), 65536))]) >= least
        row, col = row[near], col[near]
        if len(row):
            rows, cols = np.unique(row), np.unique(col)
            have = [np.array([small[x] is not None for x in side], dtype=bool) for side in (left[rows], right[cols])]
            some = shared_counts([small[x] or b"" for x in left[rows]], [small[x] or b"" for x in right[cols]])
            r, c = np.searchsorted(rows, row), np.searchsorted(cols, col)
            shared = some[r, c] + 1
            near = ~have[0][r] | ~have[1][c] | (100 * shared >= percent * (sizes[left[row]] + sizes[right[col]] - shared))
            row, col = row[near], col[near]
        return np.stack([left[row], right[col]], axis=1)

    def of(frames: Iterable) -> Iterator:
        import pandas as pd

        def pairs(frame, ends):
            marks = np.frombuffer(b"".join(frame["mark"]), dtype=np.uint8).reshape(len(frame), -1) if len(frame) else None
            own, ids, sizes, comps = (frame[c].to_numpy() for c in ("own", "id", "n_shingles", "component"))
            first, second, small = frame["i"].to_numpy(), frame["j"].to_numpy(), frame["small"].to_numpy()
            out, start = [np.empty((0, 2), np.int64)], 0
            for end in ends:
                at = slice(start, end)
                out.append(start + compare(first[start], second[start], own[at], ids[at], sizes[at], comps[at], marks[at], small[at]))
                start = end
            x = ids[np.concatenate(out)]
            return pd.DataFrame({"a": x.min(axis=1), "b": x.max(axis=1)}).drop_duplicates()

        left = None
        for frame in frames:
            frame = frame if left is None else pd.concat([left, frame], ignore_index=True)
            key = frame[["bucket", "i", "j"]].to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            done = int(ends[-1]) if len(ends) else 0
            left = frame.iloc[done:].reset_index(drop=True)
            if done:
                yield pairs(frame.iloc[:done], ends)
        if left is not None and len(left):
            yield pairs(left, [len(left)])

    group = ["bucket", "i", "j"]
    return rows.repartition(*group).sortWithinPartitions(*group).mapInPandas(of, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row a document: key, n_shingles, component_id (smallest key reachable), kept.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a set holds the distinct
    shingles of ``words`` words, or the whole sequence of fewer. Sets without an element
    link with nothing. Rows that share a key count as one document; rows with a null
    key link with nothing, have a null component and are kept. Other columns are not used.
    """
    count, band = banding(percent)
    base = written(sketch(docs, key, text, words, count, band), "sketch")
    full = base.where("id is not null and n_shingles > 0")
    nodes = written(full.groupBy("set_hash").agg(F.min_by(F.struct("id", "n_shingles", "bands", "mark"), "id").alias("x")).select("set_hash", "x.*"), "nodes")
    banded = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("last > pivot").select("bucket", "pivot")
    members = written(banded.join(shared, "bucket"), "members")
    sets = written(full_sets(docs, members.select("id").distinct(), key, text, words), "sets")
    stars = members.where(F.col("id") > F.col("pivot")).groupBy(F.col("pivot").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    for x in ("a", "b"):
        stars = stars.join(nodes.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}")), x)
    stars = checkpointed(stars.where(_may_link(F.col("n_a"), F.col("n_b"), percent)).select("a", "b", "shared"))
    best = stars.groupBy("b").agg(F.max_by("a", F.struct(F.col("shared"), -F.col("a"))).alias("a")).select("a", "b")
    first = checkpointed(confirmed(best, sets, percent))
    # rows of one key are one document, whatever their sets
    same = full.groupBy("set_hash").agg(F.min("id").alias("node"))
    twice = full.select("id", "set_hash").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    alike = full.join(twice, "id", "left_semi").join(same, "set_hash").select(F.col("id").alias("a"), F.col("node").alias("b"))
    first = first.union(alike)
    found = written(components(first), "components")
    # the other pairs of stars need a look only where they join components
    apart = stars.select("a", "b")
    for x in ("a", "b"):
        apart = apart.join(found.select(F.col("id").alias(x), F.col("component").alias(f"c_{x}")), x, "left")
    apart = apart.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b").join(best, ["a", "b"], "left_anti")
    more = checkpointed(confirmed(apart, sets, percent))
    if more.take(1):
        first = first.union(more)
        found = written(components(first), "components")
    grouped = members.select("bucket", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_buckets = grouped.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("bucket")
    rest = checkpointed(grouped.join(open_buckets, "bucket", "left_semi"))
    small = compact_sets(sets.join(rest.select("id").distinct(), "id", "left_semi"))
    rest = rest.join(nodes.select("id", "n_shingles", "mark").join(small, "id", "left"), "id")
    pairs = written(block_pairs(rest, 2 * count, percent), "pairs")
    second = checkpointed(confirmed(pairs.join(stars.select("a", "b"), ["a", "b"], "left_anti"), sets, percent))
    final = written(components(reduce(DataFrame.union, [first, second])), "components") if second.take(1) else found
    classes = same.join(final.withColumnRenamed("id", "node"), "node", "left").select("set_hash", F.coalesce("component", "node").alias("component"))
    rows = base.select("id", "n_shingles", "set_hash")
    # rows without a set need no class, and would be one key of the join
    out = rows.where("set_hash is not null").join(classes, "set_hash", "left").select("id", "n_shingles", "component")
    out = out.union(rows.where("set_hash is null").select("id", "n_shingles", F.lit(None).cast("long")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
