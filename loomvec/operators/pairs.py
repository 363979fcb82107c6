"""Cosine statistics over unordered pairs, and nearest and farthest pairs.

Vectors are dealt to blocks; each pair of blocks is one task-sized group that numpy
multiplies, so that no row is made for a pair that isn't returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .order import numbered_ids
from .scratch import saved

BLOCK = 512
#: Vectors that rows are grouped around at most, and blocks whose bounds one task compares.
PIVOTS, BOUNDS = 4096, 1024
#: Room for rounding of angles and of sums in another order.
ROOM = 1e-7


#: Rows of two regions that one task multiplies at most, regions that are made of fewer rows, and scores that are held at once.
REGION, REGIONS, SCORES = 16_384, 24, 1 << 22


@dataclass(frozen=True)
class TopPairs:
    """The pairs (a, b, cosine), and how many pairs of blocks were multiplied and ruled out."""

    pairs: DataFrame
    visited: int
    skipped: int


def _units(column) -> np.ndarray:
    m = np.array(column.tolist(), dtype=float)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _kind(rows: DataFrame, vector: str) -> str:
    """Floats are moved as they are; all sums are in double precision."""
    return "array<float>" if dict(rows.dtypes)[vector] == "array<float>" else "array<double>"


def _matrix(column) -> np.ndarray:
    """Vectors of an Arrow column of lists of one length."""
    flat = column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=float).reshape(len(column), -1)


def regions_of(rows: int, blocks: int) -> int:
    """Regions that rows in blocks are dealt to; each row is sent that many times where all regions meet."""
    return max(1, min(blocks, max(REGIONS, -(-rows // REGION))))


def _united(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _best(keys: tuple, units: tuple, k: int, sign: float, least: float):
    """The k best pairs of two sides (or of one with itself) that reach ``least``; of equal ones those with the larger (smaller) keys."""
    import pandas as pd

    same = keys[0] is keys[1]
    rank = (sign * units[0]) @ units[1].T
    # few pairs reach a bound: keys are compared for those only
    at = np.flatnonzero(rank >= least) if np.isfinite(least) else np.arange(rank.size)
    r, c = np.divmod(at, rank.shape[1])
    held = keys[0][r] < keys[1][c] if same else keys[0][r] != keys[1][c]
    at, r, c = at[held], r[held], c[held]
    score = rank.ravel()[at]
    good = np.isfinite(score)
    if good.sum() > k:
        good &= score >= np.partition(score[good], good.sum() - k)[good.sum() - k]
    r, c, score = r[good], c[good], score[good]
    a, b = np.minimum(keys[0][r], keys[1][c]), np.maximum(keys[0][r], keys[1][c])
    first = np.lexsort((-sign * b, -sign * a, -score))[:k]
    return pd.DataFrame({"a": a[first], "b": b[first], "cosine": sign * score[first]}).astype({"a": "int64", "b": "int64", "cosine": "float64"})


def _blocks(rows: DataFrame, key: str, vector: str, block: int, k: int, sign: float) -> tuple[DataFrame, float]:
    """key, vector and block, and the k-th best cosine (times ``sign``) among the pivots.

    Rows go to the nearest of some pivots, at most about ``block`` of them together. Pivots
    are a bounded draw of rows by hash; they decide how tight blocks and the first bound
    are, never what is found. A pivot that most rows are near to has many blocks.
    """
    import pandas as pd

    tagged = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(vector).cast(_kind(rows, vector)).alias("vector"))
    kind = _kind(rows, vector)
    wanted = min(PIVOTS, 2 * -(-tagged.count() // block))
    drawn = tagged.orderBy(F.xxhash64("key"), "key").limit(wanted).collect() if wanted else []
    pivots = _units(pd.Series([r["vector"] for r in drawn])) if drawn else np.zeros((1, 1))
    numbers = np.array([r["key"] for r in drawn], dtype=np.int64)
    known = _best((numbers, numbers), (pivots, pivots), k, sign, -np.inf) if drawn else []

    def near(frames):
        for frame in frames:
            frame["pivot"] = (_units(frame["vector"]) @ pivots.T).argmax(axis=1).astype(np.int32) if len(frame) else np.empty(0, np.int32)
            yield frame

    hashed = tagged.withColumn("hash", F.pmod(F.xxhash64("key"), F.lit(1 << 30)).cast("long"))
    placed = saved(hashed.mapInPandas(near, f"key long, vector {kind}, hash long, pivot int"), "pivots")
    counts = np.zeros(max(1, len(drawn)), np.int64)
    for r in placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["pivot"]] = r["n"]
    many = np.maximum(1, -(-counts // block))
    first = np.cumsum(many) - many

    def numbered(frames):
        for frame in frames:
            p = frame["pivot"].to_numpy()
            frame["block"] = (first[p] + frame["hash"].to_numpy() % many[p]).astype(np.int32)
            yield frame[["key", "vector", "block"]]

    return placed.mapInPandas(numbered, f"key long, vector {kind}, block int"), sign * known["cosine"].iloc[-1] if len(known) == k else -np.inf


def top_pairs(rows: DataFrame, key: str, vector: str, k: int, farthest: bool = False, block: int = BLOCK) -> TopPairs:
    """The k pairs of largest (smallest) cosine; ties by keys, largest (smallest) first.

    Rows are dealt to blocks around pivots, each with a centre and the largest angle to it.
    The pairs of pivots and those within blocks give a first bound; two blocks meet only if the angles between
    their centres and around them allow a pair that reaches it. Exact for any data: where
    nothing can be ruled out, as in vectors without structure, all pairs of blocks are
    multiplied, and the work grows with the square of the rows. Rows with a null key or
    vector take no part; of equal keys no pair is made.
    """
    if k < 1:
        raise ValueError("at least one pair must be asked for")
    sign = -1.0 if farthest else 1.0
    dealt, bound = _blocks(rows, key, vector, block, k, sign)
    dealt = saved(dealt, "blocks")

    def own(frame):
        import pandas as pd

        keys, units = frame["key"].to_numpy(), _units(frame["vector"])
        out = _best((keys, keys), (units, units), k, sign, -np.inf)
        centre = units.mean(axis=0)
        centre = centre / max(np.linalg.norm(centre), 1e-12)
        about = pd.DataFrame({"block": frame["block"].iloc[:1].to_numpy(), "centre": [centre.tolist()], "angle": [float(np.arccos(np.clip(units @ centre, -1, 1)).max())]})
        both = pd.concat([out, about], ignore_index=True)
        both["centre"] = both["centre"].astype(object).where(both["centre"].notna(), None)
        return both.astype({"a": "Int64", "b": "Int64", "block": "Int32"})

    inside = saved(dealt.groupBy("block").applyInPandas(own, "a long, b long, cosine double, block int, centre array<double>, angle double"), "inside")
    way = F.asc if farthest else F.desc
    best = lambda frame: frame.orderBy(way("cosine"), way("a"), way("b")).limit(k)
    first = inside.where("a is not null").select("a", "b", "cosine")
    reached = best(first).select("cosine").collect()  # k numbers
    least = max(bound, sign * reached[-1]["cosine"] if len(reached) == k else -np.inf) - ROOM

    balls = inside.where("block is not null").select("block", "centre", "angle")
    n = balls.count()
    groups = max(1, -(-n // BOUNDS))
    numbers = F.sequence(F.lit(0), F.lit(groups - 1))
    half = F.floor(F.col("block") / BOUNDS).cast("int")
    met = balls.withColumn("other", F.explode(numbers)).select(F.least(half, "other").alias("i"), F.greatest(half, "other").alias("j"), half.alias("half"), "block", "centre", "angle")

    def allowed(frame):
        import pandas as pd

        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        left, right = frame[frame["half"] == i], frame[frame["half"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"i": [], "j": []}).astype("int32")
        between = np.arccos(np.clip(np.array(left["centre"].tolist()) @ np.array(right["centre"].tolist()).T, -1, 1))
        around = left["angle"].to_numpy()[:, None] + right["angle"].to_numpy()[None, :] + ROOM
        most = -np.cos(np.minimum(np.pi, between + around)) if farthest else np.cos(np.maximum(0, between - around))
        a, b = left["block"].to_numpy(), right["block"].to_numpy()
        r, c = np.nonzero((most + ROOM >= least) & (a[:, None] < b[None, :]))
        return pd.DataFrame({"i": a[r], "j": b[c]}).astype("int32")

    kept = saved(met.groupBy("i", "j").applyInPandas(allowed, "i int, j int"), "meetings")
    visited = kept.count()

    # Neighbouring blocks form regions, and one task multiplies what may meet of two of
    # them: a block is sent once for each region that it meets, not once for each block.
    wide, most_scores = max(1, n // max(1, regions_of(dealt.count(), n))), SCORES
    region = lambda c: F.floor(F.col(c) / wide).cast("int")

    def visit(left, right):
        import pyarrow as pa

        def sorted_side(table):
            order = np.argsort(table["block"].to_numpy(), kind="stable")
            table = table.take(pa.array(order))
            return table["block"].to_numpy(), table["key"].to_numpy(), _united(_matrix(table["vector"])) if len(table) else np.zeros((0, 1))

        meets = left.filter(left["vector"].is_null())
        (blocks, keys, units), (others, other_keys, other_units) = sorted_side(left.filter(left["vector"].is_valid())), sorted_side(right)
        bound, found = least, []
        pair = np.stack([meets["block"].to_numpy(), meets["key"].to_numpy()], axis=1) if len(meets) else np.zeros((0, 2), np.int64)
        for i in np.unique(pair[:, 0]):
            mine = slice(np.searchsorted(blocks, i), np.searchsorted(blocks, i, side="right"))
            theirs = np.flatnonzero(np.isin(others, pair[pair[:, 0] == i, 1]))
            step = max(1, most_scores // max(1, mine.stop - mine.start))
            for at in range(0, len(theirs), step):
                some = theirs[at : at + step]
                whole = some[-1] - some[0] + 1 == len(some)
                some = slice(some[0], some[-1] + 1) if whole else some
                found.append(_best((keys[mine], other_keys[some]), (units[mine], other_units[some]), k, sign, bound))
                reached_here = np.sort(sign * np.concatenate([f["cosine"].to_numpy() for f in found]))[::-1]
                if len(reached_here) >= k:
                    bound = max(bound, reached_here[k - 1])
        columns = {c: np.concatenate([f[c].to_numpy() for f in found]) if found else [] for c in ("a", "b", "cosine")}
        out = pa.table({"a": pa.array(columns["a"], pa.int64()), "b": pa.array(columns["b"], pa.int64()), "cosine": pa.array(columns["cosine"], pa.float64())})
        held = np.asarray(out["cosine"].to_numpy()) * sign >= bound
        return out.filter(pa.array(held))

    regions = kept.withColumns({"p": region("i"), "q": region("j")})

    def side(name: str):
        need = regions.select("p", "q", F.col(name).alias("block")).distinct()
        return dealt.join(need, "block").select(*(F.col(c).alias(c) for c in ("p", "q", "block", "key", "vector")))

    # a row without a vector says which other block a block meets
    said = regions.select("p", "q", F.col("i").alias("block"), F.col("j").cast("long").alias("key"), F.lit(None).cast(_kind(rows, vector)).alias("vector"))
    across = side("i").unionByName(said).groupBy("p", "q").cogroup(side("j").groupBy("p", "q")).applyInArrow(visit, "a long, b long, cosine double")
    return TopPairs(best(first.unionByName(across)), visited, n * (n - 1) // 2 - visited)


def block_top(rows: DataFrame, key: str, vector: str, k: int, farthest: bool = False, block: int = BLOCK) -> DataFrame:
    """The pairs of ``top_pairs``."""
    return top_pairs(rows, key, vector, k, farthest, block).pairs


def cosine_statistics(pairs: DataFrame, threshold: float = 0.995, digits: int = 6) -> DataFrame:
    c: Column = F.col("cosine")
    points = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    p = F.percentile(c, F.array(*map(F.lit, points)))
    out = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.expr("percentile_disc(0.5) within group (order by cosine)").alias("median"), F.avg((c >= threshold).cast("double")).alias("collapsed"), p.alias("p"))
    named = [F.round(n, digits).alias(n) for n in ("min", "max", "mean", "median", "collapsed")]
    return out.select("pairs", *named, *(F.round(F.col("p")[i], digits).alias(f"p{int(x * 100)}") for i, x in enumerate(points)))


#: Vectors up to which all pairs are looked at, pairs that are drawn beyond, and the share of near-equal pairs that means collapse.
EXACT_MOST, DRAWN, COLLAPSE = 1000, 20_000, 0.99


def cosine_report(rows: DataFrame, key: str, vector: str, threshold: float = 0.995, seed: int = 0, digits: int = 6) -> DataFrame:
    """Statistics of cosines with ``method`` (exact or sampled), ``vectors`` and a ``warning`` where the vectors have collapsed.

    Up to ``EXACT_MOST`` vectors all pairs are taken; beyond, ``DRAWN`` distinct pairs drawn
    by position with a fixed seed, so that the work doesn't grow with the square.
    """
    n = rows.count()
    if n <= EXACT_MOST:
        out = all_pairs_statistics(rows, key, vector, threshold, digits)
    else:
        drawn = drawn_pairs(rows, key, DRAWN, seed)
        for x in ("a", "b"):
            drawn = drawn.join(rows.select(F.col(key).alias(x), F.col(vector).alias(f"v{x}")), x)
        out = cosine_statistics(drawn.select(V.cosine(F.col("va"), F.col("vb")).alias("cosine")), threshold, digits)
    warning = F.when(F.col("collapsed") > COLLAPSE, "nearly all vectors point the same way")
    return out.withColumns({"vectors": F.lit(n).cast("long"), "method": F.lit("exact" if n <= EXACT_MOST else "sampled"), "warning": warning})


def drawn_pairs(keys: DataFrame, key: str, most: int, seed: int = 0) -> DataFrame:
    """At most ``most`` distinct pairs a < b of distinct integer keys, drawn from three times as many draws.

    Draw d takes the places that SHA-256 of seed, d and side gives; equal places and
    repeats are dropped, and the first ``most`` stay. The work grows with keys plus draws.
    """
    placed = numbered_ids(keys.select(F.col(key).alias("key")), "key")
    n = F.broadcast(keys.agg(F.count(F.lit(1)).alias("n")))
    place = lambda side: (F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"), F.lit(side)), 256), 1, 15), 16, 10).cast("long") % F.col("n") + 1)
    draws = keys.sparkSession.range(3 * most).join(n, F.col("n") > 1).select("id", F.least(place("a"), place("b")).alias("i"), F.greatest(place("a"), place("b")).alias("j")).where("i < j")
    kept = draws.groupBy("i", "j").agg(F.min("id").alias("id")).orderBy("id").limit(most)
    for x, y in (("i", "a"), ("j", "b")):
        kept = kept.join(placed.select(F.col("place").alias(x), F.col("key").alias(y)), x)
    return kept.select("a", "b")


#: Bins of [-1, 1], and of each bin that holds a wanted rank.
BINS = 1 << 16


def all_pairs_statistics(rows: DataFrame, key: str, vector: str, threshold: float = 0.995, digits: int = 6, block: int = BLOCK) -> DataFrame:
    """``cosine_statistics`` of all pairs, by block sums and histograms; percentiles to 2 / ``BINS`` ** 2."""
    total_rows, most_scores = rows.count(), SCORES // 8
    n = regions_of(total_rows, max(1, -(-total_rows // block)))
    tagged = rows.select(F.col(key).alias("key"), F.col(vector).cast(_kind(rows, vector)).alias("vector"), F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("own"))
    dealt = tagged.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "vector")

    def histogram(wanted=None):
        """Counts of bins, or counts and sums of finer bins of the wanted ones; bin -1 has the least, largest, sum and count from the threshold of all."""
        held = None if wanted is None else np.isin(np.arange(BINS), wanted)

        def scores(table):
            i, j = table["i"][0].as_py(), table["j"][0].as_py()
            own, keys = table["own"].to_numpy(), table["key"].to_numpy()
            units = _united(_matrix(table["vector"]))
            (a, b), (left, right) = (np.flatnonzero(own == i), np.flatnonzero(own == j)), (units[own == i], units[own == j])
            step = max(1, most_scores // max(1, len(b)))
            for at in range(0, len(a) if len(b) else 0, step):
                c = left[at : at + step] @ right.T
                c = c[keys[a[at : at + step]][:, None] < keys[b][None, :]] if i == j else c.ravel()
                if len(c):
                    x = np.clip((c + 1) / 2, 0, 1) * BINS
                    with np.errstate(invalid="ignore"):
                        yield c, x, np.clip(x.astype(np.int64), 0, BINS - 1)

        def of(table):
            import pyarrow as pa

            counts, low, high, sums, above, found = np.zeros(BINS, np.int64), np.inf, -np.inf, 0.0, 0, []
            for c, x, at in scores(table):
                if held is None:
                    counts += np.bincount(at, minlength=BINS)
                    low, high, sums, above = np.minimum(low, c.min()), np.maximum(high, c.max()), sums + c.sum(), above + int((c >= threshold).sum())
                    continue
                inside = np.flatnonzero(held[at])
                c, x, at = c[inside], x[inside], at[inside]
                bins, where, n_each = np.unique(at * BINS + np.minimum(((x - at) * BINS).astype(np.int64), BINS - 1), return_inverse=True, return_counts=True)
                found.append((bins, n_each, np.bincount(where, weights=c, minlength=len(bins))))
            if held is None:
                bins = np.flatnonzero(counts)
                rest = [None] * len(bins)
                out = [[-1, *bins], [0, *counts[bins]], [low, *rest], [high, *rest], [sums, *rest], [above, *rest]]
            else:
                bins, where = np.unique(np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64), return_inverse=True)
                each = lambda k: np.bincount(where, weights=np.concatenate([f[k] for f in found]), minlength=len(bins)) if found else np.empty(0)
                none = [None] * len(bins)
                out = [bins, each(1).astype(np.int64), none, none, each(2), none]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            return pa.table({c: pa.array(v, t) for c, v, t in zip(("bin", "n", "low", "high", "sum", "above"), out, kinds, strict=True)})

        found = dealt.groupBy("i", "j").applyInArrow(of, "bin long, n long, low double, high double, sum double, above long")
        return found.groupBy("bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("sum").alias("sum"), F.sum("above").alias("above")).orderBy("bin").toPandas()

    points = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    names = ["min", "max", "mean", "median", "collapsed", *(f"p{int(x * 100)}" for x in points)]
    coarse = histogram()
    about, coarse = coarse[coarse["bin"] < 0], coarse[coarse["bin"] >= 0]
    total, values = int(coarse["n"].sum()), [None] * len(names)
    if total:
        ends = np.cumsum(coarse["n"].to_numpy())
        places = [x * (total - 1) for x in points]
        ranks = sorted({(total + 1) // 2 - 1, *(int(p) for p in places), *(min(int(p) + 1, total - 1) for p in places)})
        held = np.searchsorted(ends, ranks, side="right")
        fine = histogram(np.unique(coarse["bin"].to_numpy()[held]))
        value = {}
        for r, h in zip(ranks, held, strict=True):
            part = fine[fine["bin"] // BINS == coarse["bin"].iloc[h]]
            k = np.searchsorted(np.cumsum(part["n"].to_numpy()), r - (ends[h] - coarse["n"].iloc[h]), side="right")
            value[r] = float(part["sum"].iloc[k] / part["n"].iloc[k])
        between = [value[int(p)] + (p - int(p)) * (value[min(int(p) + 1, total - 1)] - value[int(p)]) for p in places]
        values = [float(about["low"].iloc[0]), float(about["high"].iloc[0]), float(about["sum"].iloc[0] / total), value[(total + 1) // 2 - 1], float(about["above"].iloc[0] / total), *between]
    out = rows.sparkSession.createDataFrame([(total, *values)], "pairs long, " + ", ".join(f"{x} double" for x in names))
    return out.select("pairs", *(F.round(x, digits).alias(x) for x in names))
